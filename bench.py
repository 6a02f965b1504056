"""Benchmark: the OLAP catalogue plus the loads.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line.

* ``queries`` (the headline): each OLAP key over the loaded warehouse, as the
  reference runs its queries over its loaded tables.  One warm-up, then the
  median of ``$BENCH_REPS`` (default 3) runs.  A run executes the whole plan
  into Spark's ``noop`` sink, so the time is Spark's work, not Python's
  conversion of result rows.
* ``extra.queries_from_raw``: the same keys computed from the raw tables
  (lineitem joined to orders on every run), as the driver's checks call them.
* ``extra``: warehouse load, line-grain fact load, streaming enrichment
  (10 micro-batches), full against incremental refresh of an aggregate table.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise.plans import queries as Q  # noqa: E402
from shelfwise.plans.catalog import OLAP  # noqa: E402
from shelfwise.session import build_session, new_scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "3"))
EXTRA = os.environ.get("BENCH_EXTRA", "1") != "0"


def sf_of(path: str):
    m = re.search(r"sf([0-9.]+)$", path)
    return float(m.group(1)) if m else path


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def median_run(fn, reps: int = REPS, warm: bool = True) -> float:
    if warm:
        fn()
    return statistics.median(timed(fn) for _ in range(reps))


def driver_memory() -> str:
    """Half of the machine's memory, between 2 and 16 GiB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError):
        total = 8 << 30
    return f"{max(2, min(16, int(total / 2 / (1 << 30))))}g"


def main() -> None:
    spark = build_session(master=f"local[{CPUS}]", app="shelfwise-bench",
                          shuffle_partitions=max(CPUS, 8),
                          extra={"spark.driver.memory": driver_memory()})
    from shelfwise.plans.warehouse import WarehouseStar, load_warehouse
    from shelfwise.sources.star import build_star

    star = build_star(spark, SF_DIR)
    n_lines = star.t.lineitem.count()

    # load the warehouse (dense keys, dimensions, line-grain fact); the first
    # load warms the JVM up, the second is timed and then queried
    load_warehouse(build_star(spark, SF_DIR), new_scratch(spark, "bench_warehouse"))
    root = new_scratch(spark, "bench_warehouse")
    t0 = time.perf_counter()
    load_warehouse(build_star(spark, SF_DIR), root)
    t_wh = time.perf_counter() - t0
    wh = WarehouseStar(spark, root)

    queries = {}
    for name in OLAP:
        fn = getattr(Q, name)
        queries[name] = round(median_run(lambda: run_noop(fn(wh))), 3)

    extra = {"warehouse_load_sec": round(t_wh, 3),
             "warehouse_load_lines_per_sec": round(n_lines / t_wh)}
    if EXTRA:
        from shelfwise.plans.aggregates import AggregateTable
        from shelfwise.plans.fact import fact_rows_line, write_fact

        raw = {}
        for name, run in OLAP.items():
            raw[name] = round(median_run(lambda: run_noop(run(spark, SF_DIR))), 3)
        extra["queries_from_raw"] = raw
        extra["queries_from_raw_total"] = round(sum(raw.values()), 3)

        # batch fact load at line grain from raw tables: keys, joins, write
        def load():
            s = build_star(spark, SF_DIR)
            write_fact(fact_rows_line(s), new_scratch(spark, "bench_fact"), "year")
        t_load = median_run(load, 1, warm=False)
        extra["fact_load_line_sec"] = round(t_load, 3)
        extra["fact_load_line_rows_per_sec"] = round(n_lines / t_load)

        # streaming enrichment: 10 ranges staged first (not timed), then one
        # availableNow query that takes them as about 10 micro-batches
        import math

        from shelfwise.streaming import jobs as SJ
        from shelfwise.streaming.runner import StreamRun, run_available, stage_ranges
        s_star = build_star(spark, SF_DIR)
        s_root = new_scratch(spark, "bench_stream")
        srun = StreamRun(f"{s_root}/source", f"{s_root}/checkpoint")
        staged = SJ.staged_time(s_star)
        n_files = stage_ranges(spark, staged, "time_id", 10, srun.source)
        t0 = time.perf_counter()
        progress, _ = run_available(
            spark, staged.schema, srun.source, srun.checkpoint,
            SJ.enrich_sink(s_star, f"{s_root}/fact"), max(1, math.ceil(n_files / 10)))
        srun.progress.extend(progress)
        t_stream = time.perf_counter() - t0
        extra["stream_enrich_sec"] = round(t_stream, 3)
        extra["stream_enrich_batches"] = srun.batches
        extra["stream_enrich_rows_per_sec"] = round(n_lines / t_stream)
        rates = [p for p in srun.progress if (getattr(p, "numInputRows", 0) or 0) > 0]
        if rates:
            extra["stream_processed_rows_per_sec_median"] = round(statistics.median(
                float(p.processedRowsPerSecond or 0.0) for p in rates))

        # aggregate table: full rebuild against one incremental batch (a tenth)
        table = AggregateTable(spark, new_scratch(spark, "bench_mv"),
                               ["supplier_id", "supplier_name", "month"], ["monthly_sales"])
        t_full = median_run(lambda: table.refresh_full(Q.supplier_month(wh.lines, wh)), 1)
        tenth = wh.lines_filtered(F.col("order_id") % 10 == 0)
        t_inc = median_run(lambda: table.apply_batch(Q.supplier_month(tenth, wh), 1), 1)
        extra["mv_refresh_full_sec"] = round(t_full, 3)
        extra["mv_refresh_incremental_batch_sec"] = round(t_inc, 3)
        extra["mv_read_sec"] = round(median_run(lambda: run_noop(table.read()), 1), 3)

    total = round(sum(queries.values()), 3)
    print(json.dumps({"metric": "olap_catalogue_total_sec", "value": total, "unit": "sec",
                      "queries": queries, "sf": sf_of(SF_DIR), "cpus": CPUS,
                      "reps": REPS, "extra": extra}))
    spark.stop()


if __name__ == "__main__":
    main()

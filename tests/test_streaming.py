"""Streaming semantics: arrival order, replayed batches, batch sizes."""

from pyspark.sql import functions as F

from shelfwise.streaming import jobs as S
from shelfwise.streaming.runner import run_ranges


def test_batches_arrive_in_ordinal_order(spark, star, scratch):
    root = scratch("ingest")
    S.stream_microbatch_ingest(star, root, n_ranges=3)
    stored = spark.read.parquet(f"{root}/lines")
    spans = (stored.groupBy("batch_id").agg(F.min("row_id").alias("lo"),
                                           F.max("row_id").alias("hi"))
             .orderBy("batch_id").collect())
    assert len(spans) == 3
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))
    rejects = spark.read.parquet(f"{root}/rejects")
    assert rejects.count() == 1215


def test_replayed_enrich_batch_changes_nothing(spark, star, scratch):
    root = scratch("replay")
    fact_path = f"{root}/fact"
    sink = S.enrich_sink(star, fact_path)
    lines = S.staged_time(star)
    first = lines.where(F.col("time_id") <= 20000)
    second = lines.where(F.col("time_id") > 20000)
    sink(first, 0)
    sink(second, 1)
    before = spark.read.parquet(fact_path).count()
    sink(second, 1)  # the same batch again, as after a failure
    after = spark.read.parquet(fact_path)
    assert after.count() == before == 60000
    assert after.drop("batch_id").distinct().count() == 60000


def test_dimension_ignores_arrival_order(spark, star, scratch):
    """Ranges staged last-first: the dimension still equals batch first-wins."""
    from shelfwise.plans.dimensions import dim_customer
    got = S.stream_dim_incremental(star, scratch("dim_rev"), n_ranges=3, descending=True)
    want = dim_customer(star)
    assert got.count() == want.count() == 1500
    assert got.exceptAll(want).count() == 0


def test_replayed_dimension_batch_changes_nothing(spark, star, scratch):
    root = scratch("dim")
    got = S.stream_dim_incremental(star, root, n_ranges=2)
    before = sorted(got.collect())
    raw = S.parse_stream(S.staged_raw(star))
    total = raw.agg(F.max("row_id")).first()[0]
    S.dim_sink(root)(raw.where(F.col("row_id") > total // 2), 1)  # batch 1 again
    assert sorted(S.read_dim(spark, root).collect()) == before


def test_dimension_log_is_folded(spark, star, scratch):
    """A fold leaves the dimension as it is, also when later files arrive first
    and when a folded batch is replayed."""
    from shelfwise.plans.dimensions import dim_customer
    root = scratch("dim_fold")
    raw = S.parse_stream(S.staged_raw(star)).persist()
    total = raw.agg(F.max("row_id")).first()[0]
    bounds = [total * k // 5 for k in range(6)]
    parts = [raw.where((F.col("row_id") > a) & (F.col("row_id") <= b)) for a, b in zip(bounds, bounds[1:])]
    sink = S.dim_sink(root, compact_every=2)
    for batch_id, part in enumerate(reversed(parts)):
        sink(part, batch_id)
    table = S.dim_table(spark, root)
    assert table.current()[1] == {"main": 3}
    assert table.rows().count() < spark.read.parquet(table.partials).count()
    want = sorted(dim_customer(star).collect())
    assert sorted(S.read_dim(spark, root).collect()) == want
    for batch_id in (1, 4):
        sink(parts[4 - batch_id], batch_id)
        assert sorted(S.read_dim(spark, root).collect()) == want
    raw.unpersist()


def test_first_batches_without_rows(spark, scratch):
    """Batches that hold no row at all leave a table that later batches fill."""
    from shelfwise.plans.aggregates import AggregateTable
    t = AggregateTable(spark, scratch("empty"), ["k"], ["v"], compact_every=2)
    row = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v long").selectExpr(
        "k", "cast(v AS decimal(38,2)) AS v")
    for batch_id in range(3):
        t.apply_batch(row.where("k = 'none'"), batch_id)
    t.apply_batch(row, 3)
    assert [tuple(r) for r in t.read().selectExpr("k", "int(v)").collect()] == [("a", 3)]


def test_rows_per_batch(spark, star, scratch):
    root = scratch("rpb")
    outer = S.number_rows(star.customer_dim.select("customer_id", "product_id"),
                          ["customer_id"], "row_id")
    seen = []

    def sink(batch, batch_id):
        seen.append(batch.count())

    run = run_ranges(spark, outer, "row_id", None, root, sink, rows_per_batch=400)
    assert seen == [400, 400, 400, 300]
    assert run.batches == 4


def test_rate_report_has_one_row_per_batch(spark, star, scratch):
    rep = S.stream_rate_report(star, scratch("rate"))
    rows = rep.collect()
    assert len(rows) == S.N_RANGES
    assert sum(r.input_rows for r in rows) == 60000


def test_stream_fact_compat_audit(spark, star, scratch):
    root = scratch("fact_compat")
    fact = S.stream_fact_compat(star, root, n_ranges=3)
    assert fact.count() == 1500
    audit = spark.read.parquet(f"{root}/audit").collect()
    assert len(audit) == 3
    assert sum(r.attempted for r in audit) == 1500
    assert all(r.loaded == r.read_back == r.attempted and r.rejected == 0 for r in audit)


def test_continuous_run_equals_batch(spark, star, scratch):
    from shelfwise.plans.fact import fact_load_line
    run, path = S.run_enrich(star, scratch("cont"), n_ranges=4, continuous=True)
    assert run.batches >= 2
    stored = spark.read.parquet(path).drop("stream", "batch_id")
    batch = fact_load_line(star)
    assert stored.count() == batch.count() and stored.exceptAll(batch).count() == 0


def test_replayed_ingest_batch_keeps_its_ids(spark, star, scratch):
    root = scratch("ingest_replay")
    S.stream_microbatch_ingest(star, root, n_ranges=3)
    lines = f"{root}/lines"
    before = sorted(spark.read.parquet(lines).select("time_id", "row_id").collect())
    raw = S.parse_stream(S.staged_raw(star))
    total = raw.agg(F.max("row_id")).first()[0]
    lo = round(total / 3)
    sink = S.ingest_sink(star, root)
    sink(raw.where((F.col("row_id") > lo) & (F.col("row_id") <= round(2 * total / 3))), 1)
    after = sorted(spark.read.parquet(lines).select("time_id", "row_id").collect())
    assert after == before
    ids = [r.time_id for r in after]
    assert ids == list(range(1, len(ids) + 1))


def test_paced_stream_and_console_echo(spark, star, scratch, capsys):
    """K2 pacing (processingTime trigger) and A7 console echo of loaded rows."""
    from shelfwise.streaming.runner import stage_ranges, start_paced
    root = scratch("paced")
    staged = S.staged_time(star)
    stage_ranges(spark, staged, "time_id", 2, f"{root}/source")
    stream = spark.readStream.schema(staged.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{root}/source")
    q = start_paced(stream, S.enrich_sink(star, f"{root}/fact", echo=3),
                    f"{root}/checkpoint", "1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{root}/fact").count() == 60000
    out = capsys.readouterr().out
    assert "total_sale" in out and "only showing top 3 rows" in out


def test_csv_stream_rejects_broken_lines(spark, star, scratch):
    from shelfwise.session import local_path
    from shelfwise.sources.csv import write_csv
    from shelfwise.sources.raw import transaction_csv_rows
    from tests.test_csv_load import BROKEN_TXN
    root = scratch("csv_stream")
    landing = f"{root}/landing"
    write_csv(transaction_csv_rows(star), landing)
    with open(local_path(landing) + "/zz-broken.csv", "w") as fh:
        fh.write(BROKEN_TXN)
    S.ingest_csv_stream(spark, landing, root, files_per_batch=1)
    from shelfwise.sources.journal import Journal
    assert len(Journal(spark, f"{root}/ids").numbers()) >= 2
    lines = spark.read.parquet(f"{root}/lines")
    rejects = spark.read.parquet(f"{root}/rejects")
    assert lines.count() == 58785 + 0
    reasons = sorted(r.reason for r in rejects.where(F.col("order_id").isin(1, 2, 3, 4)
                                                      | F.col("order_id").isNull()).collect())
    assert "malformed line" in reasons and "gender longer than 10" in reasons
    assert rejects.count() == 1215 + 5
    ids = sorted(r.time_id for r in lines.select("time_id").collect())
    assert ids == list(range(1, len(ids) + 1))

"""Stored tables: switched together, kept bounded, and measures that do not add up."""

import math
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import queries as Q
from shelfwise.plans.aggregates import STORED, AggregateTable, FirstWinsTable, TableSet, order_slices, prune
from shelfwise.plans.measures import MomentTable, SketchTable
from shelfwise.session import local_path
from shelfwise.streaming.control import RateControl



def files_below(root):
    return sum(len(f) for _, _, f in os.walk(local_path(root)))


def small(spark, rows):
    return spark.createDataFrame(rows, "k string, v double").selectExpr("k", "CAST(v AS decimal(38,2)) AS v")


def read(table):
    return {r.k: float(r.v) for r in table.read().collect()}


# ---- one consistent refresh --------------------------------------------------

def test_a_reader_between_the_writes_sees_one_set(star, spark, scratch, monkeypatch):
    tables = TableSet(spark, scratch("set"))
    with pytest.raises(ValueError):
        tables.snapshot()
    tables.refresh(star)
    old = tables.snapshot()
    assert set(old) == set(STORED)
    seen = []
    plain = AggregateTable.write_version

    def watched(self, df):
        seen.append(tables.snapshot())   # a reader while the next versions are written
        path = plain(self, df)
        seen.append(tables.snapshot())
        return path

    monkeypatch.setattr(AggregateTable, "write_version", watched)
    paths = tables.refresh(star)
    assert len(seen) == 6 and all(s == old for s in seen)
    new = tables.snapshot()
    assert {n: s["path"] for n, s in new.items()} == paths
    assert not {s["path"] for s in new.values()} & {s["path"] for s in old.values()}
    for name, (query, _, _) in STORED.items():
        want = getattr(Q, query)(star)
        for at in (old, new):
            assert tables.read(name, at).exceptAll(want).count() == 0
    # what no entry kept reaches is deleted
    assert tables.prune(1) == 3
    for name in STORED:
        assert tables.read(name).count() > 0
        assert not os.path.exists(local_path(old[name]["path"]))


def test_a_refresh_that_breaks_off_changes_nothing(star, spark, scratch, monkeypatch):
    tables = TableSet(spark, scratch("broken"))
    tables.refresh(star)
    old, left = tables.snapshot(), [1]
    plain = AggregateTable.write_version

    def fails(self, df):
        if not left:
            raise RuntimeError("lost")
        left.pop()
        return plain(self, df)

    monkeypatch.setattr(AggregateTable, "write_version", fails)
    with pytest.raises(RuntimeError):
        tables.refresh(star)
    assert tables.snapshot() == old


# ---- retention ---------------------------------------------------------------

def test_files_stay_bounded_over_a_hundred_batches(spark, scratch):
    root = scratch("retained")
    t = AggregateTable(spark, root, ["k"], ["v"], compact_every=5, retain=2)
    want, counts = {}, []
    for b in range(100):
        rows = [(f"k{b % 7}", float(b)), ("all", 1.0)]
        t.apply_batch(small(spark, rows).coalesce(1), b)
        for k, v in rows:
            want[k] = want.get(k, 0) + v
        counts.append(files_below(root))
    assert read(t) == want
    assert max(counts[50:]) <= max(counts[:30]) and len(t.written()) <= 10 and len(t.journal.numbers()) == 2
    for b in (0, 50, 94):   # folded long ago, their partials deleted
        t.apply_batch(small(spark, [("all", 1000.0)]), b)
    assert read(t) == want


def test_prune_leaves_what_a_kept_entry_reaches(spark, scratch):
    t = AggregateTable(spark, scratch("kept"), ["k"], ["v"])
    for b in range(3):
        t.apply_batch(small(spark, [("a", 1.0)]), b, "one")
    t.compact()
    before = t.current()
    t.apply_batch(small(spark, [("a", 1.0)]), 3, "one")
    t.apply_batch(small(spark, [("b", 1.0)]), 0, "two")
    t.compact()
    assert prune([t], 2) == 3      # the batches that both entries cover
    assert sorted(t.written()) == [("one", 3), ("two", 0)]
    # a reader of the entry before still finds its base and the batches behind it
    assert spark.read.parquet(before[0]).count() == 1
    assert read(t) == {"a": 4.0, "b": 1.0}
    assert prune([t], 1) == 3 and read(t) == {"a": 4.0, "b": 1.0}


def test_a_slower_fold_does_not_undo_a_newer_version(spark, scratch, monkeypatch):
    t = AggregateTable(spark, scratch("slow"), ["k"], ["v"])
    t.apply_batch(small(spark, [("a", 1.0)]), 0)
    plain = AggregateTable.write_version

    def overtaken(self, df):
        monkeypatch.setattr(AggregateTable, "write_version", plain)
        path = plain(self, df)
        t.apply_batch(small(spark, [("a", 5.0)]), 1)
        t.compact()   # covers batch 1 too
        return path

    monkeypatch.setattr(AggregateTable, "write_version", overtaken)
    assert t.compact() is None
    assert t.current()[1] == {"main": 1} and read(t) == {"a": 6.0}


def test_first_wins_logs_are_pruned_too(spark, scratch):
    t = FirstWinsTable(spark, scratch("first"), ["k"], ["v"], compact_every=3, retain=2, order=["o"])
    rnd, best = random.Random(0), {}
    for b in range(20):
        rows = [(rnd.choice("abc"), rnd.random(), f"{b}-{i}") for i in range(4)]
        t.offer(spark.createDataFrame(rows, "k string, o double, v string"), b)
        for k, o, v in rows:
            best[k] = min(best.get(k, (9, "")), (o, v))
    assert {r.k: r.v for r in t.read().collect()} == {k: v for k, (_, v) in best.items()}
    assert len(t.written()) <= 6


# ---- distinct counts ---------------------------------------------------------

def test_sketches_merge_within_their_error(spark, scratch):
    t = SketchTable(spark, scratch("sketch"), ["k"], ["v"], compact_every=2, log_size=12)
    rows = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "CAST(1 AS decimal(38,2)) AS v", "id % 20000 AS x")
    for b in range(5):  # batches that overlap in what they count
        t.apply_batch(t.sketched(rows.where((F.col("x") % 5 == b) | (F.col("x") % 5 == (b + 1) % 5)), "x"), b)
    got = {r.k: (r.n, float(r.v)) for r in t.estimates("n").collect()}
    want = {r.k: r.n for r in rows.groupBy("k").agg(F.countDistinct("x").alias("n")).collect()}
    assert got.keys() == want.keys()
    for k, n in want.items():
        assert abs(got[k][0] - n) <= max(1, 4 * t.error * n)
    assert sum(v for _, v in got.values()) == 120_000  # sums add up as ever


def test_a_sketch_does_not_grow_with_what_it_counts(spark, scratch):
    sizes = []
    for n in (20_000, 400_000):
        t = SketchTable(spark, scratch("size"), ["k"], [], log_size=10)
        t.apply_batch(t.sketched(spark.range(n).selectExpr("'a' AS k", "id AS x"), "x"), 0)
        row = t.read().first()
        sizes.append(len(row.sketch))
        assert abs(t.estimates("n").first().n - n) < 4 * t.error * n
    assert sizes[1] <= 1.5 * sizes[0]


# ---- moments -----------------------------------------------------------------

def test_moments_follow_changing_totals(spark, scratch):
    t = MomentTable(spark, scratch("moments"), ["k"], "v")
    rnd, totals = random.Random(1), {}
    assert t.moments() == (0, 0.0, None)
    for b in range(6):
        rows = {f"k{rnd.randrange(12)}": round(rnd.uniform(-50, 1e7), 2) for _ in range(6)}
        stream = "one" if b % 3 else "two"   # two streams take turns
        t.apply_batch(small(spark, list(rows.items())), b, stream)
        for k, v in rows.items():
            totals[k] = totals.get(k, 0) + v
        n, mean, sd = t.moments()
        assert n == len(totals) and mean == pytest.approx(statistics.fmean(totals.values()), rel=1e-12)
        assert sd == pytest.approx(statistics.stdev(totals.values()), rel=1e-9)
        t.apply_batch(small(spark, list(rows.items())), b, stream)   # replayed
        assert t.moments() == (n, mean, sd)
    assert {r.k: float(r.v) for r in t.read().collect()} == pytest.approx(totals)
    far = {r.k for r in t.outliers(1.0).collect()}
    assert far == {k for k, v in totals.items() if abs(v - mean) > sd}


def test_a_batch_without_rows_keeps_the_moments(spark, scratch):
    t = MomentTable(spark, scratch("none"), ["k"], "v")
    t.apply_batch(small(spark, [("a", 1.0), ("b", 3.0)]), 0)
    t.apply_batch(small(spark, [("a", 1.0)]).limit(0), 1)
    t.apply_batch(small(spark, [("a", 2.0)]), 2)
    assert t.moments() == (2, 3.0, 0.0) and t.outliers(0.5).collect() == []


def test_moments_of_another_stream_in_between(spark, scratch, monkeypatch):
    """A batch whose change was worked out on totals that another stream has changed since."""
    t = MomentTable(spark, scratch("between"), ["k"], "v")
    t.apply_batch(small(spark, [("a", 1.0)]), 0, "one")
    plain, once = MomentTable._change, []

    def overtaken(self, added, marks):
        change = plain(self, added, marks)
        if not once:
            once.append(1)
            t.apply_batch(small(spark, [("a", 10.0)]), 0, "two")
        return change

    monkeypatch.setattr(MomentTable, "_change", overtaken)
    t.apply_batch(small(spark, [("a", 100.0), ("b", 1.0)]), 1, "one")
    n, mean, sd = t.moments()
    assert (n, mean) == (2, 56.0) and sd == pytest.approx(statistics.stdev([111, 1]))


# ---- rate control ------------------------------------------------------------

def test_the_limit_follows_the_service_rate_within_bounds():
    c = RateControl(seconds=10, least=2, most=64, limit=8, smooth=1.0)
    assert c.heard(8, 1.0, 1.0) == 16        # fast: at most doubled
    assert c.heard(16, 1.0, 1.0) == 32 and c.heard(32, 1.0, 1.0) == 64 and c.heard(64, 1.0, 1.0) == 64
    assert c.heard(64, 64.0, 1.0) == 32      # slow: at most halved
    assert c.heard(32, 32.0, 3.0) == 16 and c.falls_behind
    assert c.heard(16, 16.0, 0.5) == 10 and c.heard(10, 10.0, 0.5) == 10 and not c.falls_behind
    assert c.heard(3, 0.1, 0.5) == 10        # a batch that was not full raises nothing
    assert c.heard(10, 1000.0, 0.5) == 5 and c.heard(5, 1000.0, 0.5) == 3 and c.heard(3, 1000.0, 0.5) == 2
    assert c.heard(2, 1000.0, 0.5) == 2
    assert RateControl(seconds=1, least=4, most=8, limit=100).limit == 8


@pytest.mark.parametrize("slow", [True, False])
def test_a_slow_sink_lowers_and_a_fast_one_raises_the_limit(spark, scratch, slow):
    import time

    from shelfwise.streaming.control import file_source, run_controlled
    root = scratch("controlled")
    for k in range(20):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(f"{root}/in")
    seen = []

    def sink(batch, batch_id):
        rows = batch.collect()
        seen.append(len(rows) // 10)
        assert {"file", "landed_at"} < set(batch.columns)
        if slow:
            time.sleep(0.8 * len(rows) / 10)

    schema = spark.range(1).schema
    control = RateControl(seconds=0.9 if slow else 60.0, most=16, limit=4)
    n = run_controlled(spark, file_source(spark, schema, f"{root}/in"), sink, f"{root}/cp", f"{root}/rates", control)
    assert sum(seen) == 20 and n == len(seen)
    rates = spark.read.parquet(f"{root}/rates").orderBy("batch_id").collect()
    assert [r.files for r in rates] == seen and [r.input_rows for r in rates] == [10 * s for s in seen]
    assert all(r.file_limit >= r.files for r in rates)
    if slow:
        assert seen[0] == 4 and seen[-1] == 1 and control.limit == 1
    else:
        assert seen[:2] == [4, 8] and control.limit >= 8
    # a later run goes on from the stored rates
    again = RateControl(seconds=1.0, most=16, limit=4).resume(spark, f"{root}/rates")
    assert again.limit == control.limit and again.served == pytest.approx(control.served)
    for k in range(20, 22):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(f"{root}/in")
    again = RateControl(seconds=0.9 if slow else 60.0, most=16, limit=9)
    run_controlled(spark, file_source(spark, schema, f"{root}/in"), sink, f"{root}/cp", f"{root}/rates", again)
    assert sum(seen) == 22 and not math.isnan(again.served)


def test_a_fixed_part_of_the_time_does_not_shrink_batches_to_nothing():
    def driven(fixed, per_file, limit, batches=12):
        c = RateControl(seconds=5.0, most=24, limit=limit)
        for _ in range(batches):
            c.heard(c.limit, fixed + per_file * c.limit, 1.0, 1000 * c.limit)
        return c
    c = driven(8.0, 0.5, 4)     # the fixed part alone takes longer than wanted: files get as much time as it does
    assert c.limit in (15, 16) and c.fixed == pytest.approx(8.0)
    assert driven(3.0, 0.5, 8).limit in (5, 6)  # 3 s of the fixed part, 6 files in as much time
    assert driven(0.0, 1.0, 16).limit == 5   # without one as before


def test_batches_of_empty_files_change_no_limit_and_lose_no_row(spark, scratch):
    from shelfwise.streaming.control import file_source, run_controlled
    from shelfwise.streaming.progress import timed_sink
    root, rows = scratch("empty_files"), spark.range(30).select("id", (F.col("id") % 3).alias("k"))
    for low in (0, 10, 20):
        for part in ("id < 0", f"id >= {low} AND id < {low + 10}"):
            rows.coalesce(1).where(part).write.mode("append").parquet(f"{root}/in")
    names = spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("name"))

    def sink(batch, batch_id):
        found = batch.join(names, "k", "left").persist()  # a shuffled join: Spark drops its sides when one is empty
        found.where("name IS NOT NULL").select("id").write.mode("append").parquet(f"{root}/out")
        found.where("name IS NULL").select("id").write.mode("append").parquet(f"{root}/rest")
        found.unpersist()

    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        run_controlled(spark, file_source(spark, rows.schema, f"{root}/in"), timed_sink(sink, f"{root}/times"),
                       f"{root}/cp", f"{root}/rates", RateControl(seconds=60.0, most=1, limit=1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out").collect()) == list(range(30))
    rates = spark.read.parquet(f"{root}/rates").orderBy("batch_id").collect()
    assert [r.input_rows for r in rates] == [0, 10] * 3 and all(r.next_limit == 1 and r.seconds < 30 for r in rates)
    assert [r.input_rows for r in spark.read.parquet(f"{root}/times").orderBy("batch_id").collect()] == [0, 10] * 3


def test_slices_of_the_moment_table_equal_q5(star, spark, scratch):
    t = MomentTable(spark, scratch("q5"), ["product_id", "product_name"], "total_sales")
    for b, lines in enumerate(order_slices(star)):
        t.apply_batch(Q.product_totals(lines, star), b)
    want = Q.q5_sigma_anomaly(star)
    got = t.outliers(2.0).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

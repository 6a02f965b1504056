"""Steps whose input is expensive compute it once, with the results of the plain form."""

import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shelfwise.functions import parse_order_date
from shelfwise.operators.surrogate import dense_key
from shelfwise.plans import aggregates as A
from shelfwise.plans import fact as FT
from shelfwise.plans import ingest as I
from shelfwise.plans import queries as Q
from shelfwise.session import local_path
from shelfwise.sources.staging import write_range
from shelfwise.sources.star import build_star
from shelfwise.streaming import jobs as S
from tests.helpers import plan_text


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_staged_rows_are_computed_once_and_keyed_the_same(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def looked_at(x):
        seen.add(1)
        return x

    rows = spark.range(1000).repartition(4).select(looked_at("id").alias("x"), (F.col("id") % 3).alias("rest"))
    keyed = {(r.x, r.key) for r in dense_key(rows, ["x"], "key", staged=True, where="rest > 0").collect()}
    assert seen.value == 1000
    assert keyed == {(x, k) for k, x in enumerate((x for x in range(1000) if x % 3), 1)}


def test_an_order_date_is_cut_without_a_second_regular_expression(spark):
    cases = {" 4/7/19 22:30 ": dt.datetime(2019, 4, 7, 22, 30), "4/7/19 22:30\n": dt.datetime(2019, 4, 7, 22, 30),
             "4/7/19  22:30": None, "4/7/1922:30": None, "4-7-19 22:30": None, "a/b/cc d:e": None, "2/29/23 1:1": None}
    df = spark.createDataFrame([(s,) for s in cases], "s string").select("s", parse_order_date("s").alias("t"))
    assert {r.s: r.t for r in df.collect()} == cases
    assert "split(" not in plan_text(df)


def test_good_lines_are_chosen_behind_their_parsing(star):
    got = I.dim_time(star)
    good, _ = I.split_transactions(star)
    assert same(got.select("order_id", "product_id", F.col("order_date").alias("order_ts"), "qty"),
                good.select("order_id", "product_id", "order_ts", "qty"))
    assert got.agg(F.min("time_id"), F.max("time_id"), F.count_distinct("time_id")).first() == (1, *[good.count()] * 2)


def test_the_compat_fact_joins_order_lines_once_and_reads_its_batch_back(star, scratch):
    back = FT.fact_readback_semi(star, scratch("back"))
    assert "lineitem" not in plan_text(back)     # the batch is not computed anew to be compared with
    assert same(back, FT.fact_load_compat(star))
    assert same(star.first_products, star.customer_dim.select("customer_id", "product_id"))


def test_the_set_of_aggregates_sums_the_lines_once(star, spark, scratch):
    class Counted:
        asked = 0

        def __getattr__(self, name):
            if name == "lines":
                Counted.asked += 1
            return getattr(star, name)

    tables = A.TableSet(spark, scratch("once"))
    tables.refresh(Counted())
    assert Counted.asked == 1
    for name, (query, _, _) in A.STORED.items():
        assert same(tables.read(name), getattr(Q, query)(star))


def test_landing_slices_hold_every_line_once_in_files_by_size(star, spark, scratch, monkeypatch):
    from shelfwise.sources.csv import CSV_OPTIONS
    from shelfwise.sources.raw import transaction_csv_rows
    from shelfwise.streaming import warehouse as SW
    monkeypatch.setattr(SW, "FILE_BYTES", 20_000)
    root = scratch("slices")
    files = SW._landing_slices(star, root, again=F.col("ord_order_id") % 40 == 0)
    read = {n: spark.read.options(**CSV_OPTIONS).csv(f"{root}/in/{n}").withColumn("file", F.input_file_name())
            for n in files}
    assert list(files) == ["load", "first", "second", "again"] and files["load"] > 3 and files["again"] == 2
    for name, df in read.items():
        assert df.select("file").distinct().count() == files[name]
        assert df.groupBy("Order ID").agg(F.count_distinct("file").alias("n")).where("n > 1").count() == 0
    rows = [df.drop("file") for df in read.values()]
    want = transaction_csv_rows(star).fillna("")
    assert same(rows[0].union(rows[1]).union(rows[2]).fillna(""), want)
    assert same(rows[3], rows[1].where("`Order ID` % 40 = 0"))


def test_only_rows_with_a_fault_are_written_out_as_text(spark, scratch):
    from shelfwise.plans.load import typed_transactions_csv
    path = scratch("faults")
    spark.createDataFrame([("Order ID,Order Date,ProductID,CustomerID,CustomerName,Gender,Quantity Ordered",),
                           ("1,4/7/97 10:00,1,5,Ann,F,2",), ("x,4/7/97 10:00,1,5,Ann,F,2",), ("1,4/7/97",)],
                          "value string").coalesce(1).write.text(path)
    typed = typed_transactions_csv(spark, path)
    typed.write.parquet(f"{path}_typed")
    rows = {r.reason: r.text for r in spark.read.parquet(f"{path}_typed").collect()}
    assert rows == {None: None, "malformed line": "1,4/7/97", "non-numeric id or quantity":
                    '{"order_id":"x","order_date_text":"4/7/97 10:00","product_id":"1","customer_id":"5",'
                    '"customer_name":"Ann","gender":"F","quantity":"2"}'}


def test_the_key_of_landed_lines_is_that_of_all_columns(star):
    got = star.landed_lines
    assert same(got, star.time_dim.select(*got.columns))
    assert dict(got.dtypes) == dict(star.time_dim.select(*got.columns).dtypes)


def test_the_product_lookup_of_a_stream_is_made_anew_only_for_other_products(star, spark, scratch, monkeypatch):
    root, made = scratch("dims"), []
    tables = f"{root}/tables"
    for name in ("supplier", "nation"):
        getattr(star.t, name).write.parquet(f"{tables}/{name}.parquet")
    star.t.part.where("p_partkey < 1000").write.parquet(f"{tables}/part.parquet")
    monkeypatch.setattr(S, "product_lookup", lambda star: made.append(1) or FT.product_lookup(star))
    sink = S.enrich_sink(build_star(spark, tables), f"{root}/fact")
    lines = star.landed_lines.where("time_id <= 2000").repartition(4)
    known = lines.where("product_id < 1000").count()

    def stored(batch, path="fact"):
        return spark.read.parquet(f"{root}/{path}").where(F.col("batch_id") == batch)

    sink(lines, 0)
    sink(lines, 1)
    assert len(made) == 1 and [stored(b).count() for b in (0, 1)] == [known] * 2 and known < 2000
    assert len(stored(1).inputFiles()) < int(spark.conf.get("spark.sql.shuffle.partitions"))  # files follow the rows
    star.t.part.where("p_partkey >= 1000").write.mode("append").parquet(f"{tables}/part.parquet")
    sink(lines, 2)
    assert len(made) == 2 and stored(2).count() == 2000 and stored(1, "fact_rejects").count() == 2000 - known
    assert same(stored(2).drop("stream", "batch_id"), FT.judged_lines(star, lines).select(*FT.FACT_KEYS, "total_sale"))


def test_a_landed_file_can_be_shared_by_tasks(spark, scratch):
    rows, at = spark.range(1, 1_200_001, numPartitions=1).select("id", F.xxhash64("id").alias("x")), scratch("landed")
    write_range(rows, "id", 0, 1_200_000, at)
    [file] = glob.glob(f"{local_path(at)}/*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 1

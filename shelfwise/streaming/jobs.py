"""Streaming jobs (K1-K6).  Each job stages its input from the test tables in
ordinal ranges, runs one micro-batch per range and returns what it stored, so
the stored result can be compared with the batch query.

Inside ``foreachBatch`` the dimensions are re-read from their tables every
batch (a stream-static join whose static side stays fresh; the enrichment prepares its
lookup again only when their files changed, ``stream_fact_compat`` prepares its own once).  Every write replaces only
its own (stream, batch id) partition, so a batch replayed after a failure leaves
the same result, and streams with checkpoints of their own can share a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import calendar_columns, parse_order_date, to_int
from ..operators.surrogate import dense_key
from ..plans.aggregates import AggregateTable, FirstWinsTable
from ..plans.fact import (FACT_KEYS, FACT_LINE, LINE_REJECT, compat_lookup, fact_rows_compat,
                          judged_lines, product_lookup)
from ..plans.ingest import reject_reason
from ..plans.queries import supplier_month
from ..schemas import by_batch
from ..session import new_scratch
from ..sources.paths import read_parquet_if_exists, remove_folder
from ..sources.raw import RAW_ORDER, raw_transactions
from ..sources.staging import number_rows
from ..sources.star import Star
from .buffer import buffer_rows, buffered
from .claims import reserve_ids
from .progress import timed_sink
from .runner import StreamRun, batch_partition_write, in_batch, persist_by_size, run_ranges, run_staged

N_RANGES = 4


def _read_or_none(spark, path: str) -> DataFrame | None:
    return read_parquet_if_exists(spark, path)


# ---- K1: micro-batch ingest with cleansing and rejects ---------------------

def parse_stream(raw: DataFrame) -> DataFrame:
    """Typed columns and a reject reason; plain column expressions only."""
    df = raw.select(
        "row_id", *RAW_ORDER,
        to_int("order_id_text").alias("order_id"),
        F.col("ord_line_number").alias("line_number"),
        "order_date_text",
        parse_order_date("order_date_text").alias("order_date"),
        to_int("product_id_text").alias("product_id"),
        to_int("customer_id_text").alias("customer_id"),
        "customer_name", "gender",
        to_int("quantity_text", "int").alias("qty"))
    return df.withColumn("reason", reject_reason("order_date"))


def staged_raw(star: Star) -> DataFrame:
    return number_rows(raw_transactions(star), RAW_ORDER, "row_id", staged=True)


def stream_microbatch_ingest(star: Star, root: str, n_ranges: int = N_RANGES) -> DataFrame:
    """Raw transactions as a stream: parse, split off rejects, and append the
    good lines with a dense ``time_id`` that continues from the largest id
    stored by earlier batches (AUTO_INCREMENT on a stream).  A replayed batch
    sees only the batches before it, so it gets the same ids again."""
    spark = star.spark
    run_ranges(spark, staged_raw(star), "row_id", n_ranges, root, ingest_sink(star, root),
               parse_stream)
    return spark.read.parquet(f"{root}/lines").select(
        "time_id", "order_id", "order_date", "hour", "minute", "day", "year", "quarter",
        "month", "qty", "product_id", "customer_id")


def key_and_store(good: DataFrame, rejects: DataFrame, order_cols, root: str, batch_id: int,
                  stream: str, shape, lines: str = "lines", first: tuple[str, ...] = ()) -> DataFrame:
    """Append good lines with dense ids that continue from earlier batches, and rejects.

    The batch claims its range of ids in the journal ``<root>/ids`` before it writes a
    line, so ids are unique whatever streams share the table, and a replayed batch gets
    its ids again (see ``claims.reserve_ids``).  Returns the lines as written."""
    spark = good.sparkSession
    good_path, keys_path = f"{root}/{lines}", f"{root}/keys/{stream}/{batch_id}"
    keyed = dense_key(good, order_cols, "time_id", path=keys_path)
    n = spark.read.parquet(keys_path).count()  # from the files' footers
    before = reserve_ids(spark, f"{root}/ids", stream, batch_id, n) - 1
    keyed = shape(keyed.withColumn("time_id", F.col("time_id") + F.lit(before)))
    batch_partition_write(keyed, good_path, batch_id, "product_id", stream, first)
    # with the schema at hand, as the first batch may hold no good line
    written = (spark.read.schema(by_batch(keyed.schema)).parquet(good_path)
               .where(in_batch(stream, batch_id)))
    batch_partition_write(rejects, f"{root}/rejects", batch_id, stream=stream)
    return written.drop("stream", "batch_id")


def ingest_sink(star: Star, root: str, stream: str = "main"):
    """foreachBatch body of the ingest stream (see ``stream_microbatch_ingest``)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            cal = calendar_columns("order_date")
            good = batch.where(F.col("reason").isNull()).select(
                *RAW_ORDER, "row_id", "order_id", "line_number", "order_date",
                *[cal[k].alias(k) for k in ("hour", "minute", "day", "year", "quarter", "month")],
                "qty", "product_id", "customer_id")
            bad = batch.where(F.col("reason").isNotNull()).select(
                "row_id", "order_id", "line_number", "order_date_text", "reason")
            key_and_store(good, bad, RAW_ORDER, root, batch_id, stream,
                          lambda keyed: keyed.drop(*RAW_ORDER))
        finally:
            batch.unpersist()

    return sink


# ---- K4 / C6: enrichment of order lines into the fact ----------------------

def staged_time(star: Star) -> DataFrame:
    return star.landed_lines


class ProductLookup:
    """The product lookup of a star's tables, prepared once as a table, and again as soon as
    the files of those tables are others: a batch reads what a fresh read of them would give."""

    def __init__(self, star: Star):
        self.star, self.path, self.schema, self.states = star, None, None, None

    def read(self) -> DataFrame:
        spark = self.star.spark
        states = self.star.t.states("part", "supplier", "nation")
        if states != self.states:
            path, lookup = new_scratch(spark, "product_lookup"), product_lookup(self.star.refreshed())
            lookup.write.parquet(path)
            before, self.path, self.schema, self.states = self.path, path, lookup.schema, states
            if before:
                remove_folder(spark, before)
        return spark.read.schema(self.schema).parquet(self.path)


def enrich_sink(star: Star, fact_path: str, echo: int = 0, stream: str = "main"):
    """foreachBatch body: order lines -> fact rows of this batch, and beside them
    (``<fact_path>_rejects``) the lines that make none, with the reason.

    The dimensions are looked at in every batch; their lookup is made anew when they changed.
    It is joined by a shuffle, which spreads the lines of few files over all cores, and hashed, as
    neither side is needed in the order of the products before it is written.

    With ``echo`` > 0 the rows just written are read back by their batch
    partition and the first ``echo`` are printed (the reference prints every
    loaded row; off by default)."""
    prepared = ProductLookup(star)

    def sink(batch: DataFrame, batch_id: int) -> None:
        judged = persist_by_size(judged_lines(star, batch, prepared.read().hint("shuffle_hash")))
        try:
            batch_partition_write(judged.where("reason IS NULL").select(*FACT_LINE).drop("year"),
                                  fact_path, batch_id, sort_by="product_id", stream=stream)
            batch_partition_write(judged.where("reason IS NOT NULL").select(*LINE_REJECT),
                                  f"{fact_path}_rejects", batch_id, stream=stream)
        finally:
            judged.unpersist()
        if echo:
            (star.spark.read.parquet(fact_path).where(in_batch(stream, batch_id))
             .show(echo, truncate=False))
    return sink


def start_enrichment(star: Star, source: str, fact_path: str, checkpoint: str,
                     files_per_batch: int = 10, interval: str = "1 second"):
    """Production form of K1/K2/K4: a paced stream over a landing folder of
    keyed order-line files, enriched into the fact.  Returns the query."""
    from .runner import start_paced
    schema = staged_time(star).schema
    stream = (star.spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_batch).parquet(source))
    return start_paced(stream, enrich_sink(star, fact_path), checkpoint, interval)


def run_enrich(star: Star, root: str, n_ranges: int = N_RANGES,
               continuous: bool = False, sink=None) -> tuple[StreamRun, str]:
    """Enrichment over staged order lines: one availableNow run per range, or
    (``continuous``) all ranges staged first and one run over them."""
    fact_path = f"{root}/fact"
    runner = run_staged if continuous else run_ranges
    run = runner(star.spark, staged_time(star), "time_id", n_ranges, root,
                 sink or enrich_sink(star, fact_path))
    return run, fact_path


def stream_enrich_fact(star: Star, root: str) -> DataFrame:
    run, fact_path = run_enrich(star, root)
    return star.spark.read.parquet(fact_path).drop("stream", "batch_id")


def stream_rate_report(star: Star, root: str) -> DataFrame:
    """Batches and their input rows from the stored table of rates (seconds and
    rows per second are there too, and differ from run to run)."""
    rates = f"{root}/rates"
    run_enrich(star, root, sink=timed_sink(enrich_sink(star, f"{root}/fact"), rates))
    return star.spark.read.parquet(rates).select("batch_id", "input_rows")


# ---- K6: first-wins dimension on a stream ----------------------------------

DIM_VALUES = ["customer_name", "gender", "product_id"]


def dim_table(spark, root: str, compact_every: int | None = None) -> FirstWinsTable:
    return FirstWinsTable(spark, f"{root}/customer_dim", ["customer_id"], DIM_VALUES,
                          compact_every, order=RAW_ORDER)


def dim_sink(root: str, name: str = "main", compact_every: int | None = None):
    """foreachBatch body of the first-wins customer dimension.

    Each batch keeps its own winners (first in the total order), then writes
    only those that are new or earlier than what earlier batches stored for the
    key: the stored table holds every row that can still win, and reading takes
    the earliest per key.  The result equals the batch first-wins whatever
    order the files arrive in; a replayed batch compares only with earlier
    batches and rewrites its own partition, or changes nothing once
    ``compact_every`` batches have been folded with it."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        dim_table(batch.sparkSession, root, compact_every).offer(
            batch.where(F.col("customer_id").isNotNull()), batch_id, name)
    return sink


def read_dim(spark, root: str) -> DataFrame:
    """The dimension: the earliest stored row of every key."""
    return dim_table(spark, root).read().select("customer_id", *DIM_VALUES)


def stream_dim_incremental(star: Star, root: str, n_ranges: int = N_RANGES,
                           descending: bool = False) -> DataFrame:
    """Raw transactions streamed into the first-wins customer dimension."""
    spark = star.spark
    run_ranges(spark, staged_raw(star), "row_id", n_ranges, root, dim_sink(root, compact_every=2),
               parse_stream, descending=descending)
    return read_dim(spark, root)


# ---- I5 on a stream: incremental aggregate refresh -------------------------

def stream_mv_refresh(star: Star, root: str, n_ranges: int = N_RANGES) -> DataFrame:
    spark = star.spark
    table = AggregateTable(spark, f"{root}/supplier_month",
                           ["supplier_id", "supplier_name", "month"], ["monthly_sales"],
                           compact_every=2)

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.apply_batch(supplier_month(batch, star.refreshed()), batch_id)

    run_ranges(spark, staged_time(star), "time_id", n_ranges, root, sink)
    return table.read()


def stream_q9_line(star: Star, root: str, n_ranges: int = N_RANGES) -> DataFrame:
    """Q9 (top customers with distinct products) refreshed batch by batch.

    COUNT DISTINCT does not add up across batches; revenue per distinct
    (customer, product, year) does, so that table is refreshed incrementally
    and Q9 reads it: distinct products are its rows per customer."""
    from ..plans.queries import customer_product_year, q9_from_pairs
    spark = star.spark
    table = AggregateTable(spark, f"{root}/customer_product_year",
                           ["customer_id", "product_id", "year"], ["revenue"],
                           compact_every=2)

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.apply_batch(customer_product_year(batch, star.refreshed()), batch_id)

    run_ranges(spark, staged_time(star), "time_id", n_ranges, root, sink)
    return q9_from_pairs(table.read(), star)


def stream_q9_sketch(star: Star, root: str, n_ranges: int = N_RANGES) -> DataFrame:
    """Q9 from a table of one row per (customer, year): sales, and a sketch of the products.

    The exact form (``stream_q9_line``) stores a row per (customer, product, year); this one's size does
    not depend on how many products a customer buys.  Counts up to some hundreds come out
    exact, larger ones within the sketch's error (``SketchTable.error``)."""
    from ..plans.measures import SketchTable
    from ..plans.queries import customer_product_year, q9_ranked
    spark = star.spark
    table = SketchTable(spark, f"{root}/customer_year", ["customer_id", "year"], ["revenue"], compact_every=2)

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.apply_batch(table.sketched(customer_product_year(batch, star.refreshed()), "product_id"), batch_id)

    run_ranges(spark, staged_time(star), "time_id", n_ranges, root, sink)
    totals = table.estimates("unique_products").where(F.col("year") == params.YEAR)
    return q9_ranked(totals.select("customer_id", "unique_products", F.col("revenue").alias("total_sales")), star)


def stream_q5_sigma(star: Star, root: str, n_ranges: int = N_RANGES) -> DataFrame:
    """Q5 refreshed batch by batch: product totals, and the moments of all totals kept beside them."""
    from ..plans.measures import MomentTable
    from ..plans.queries import product_totals
    spark = star.spark
    table = MomentTable(spark, f"{root}/product_totals", ["product_id", "product_name"], "total_sales")

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.apply_batch(product_totals(batch, star.refreshed()), batch_id)

    run_ranges(spark, staged_time(star), "time_id", n_ranges, root, sink)
    return table.outliers(params.SIGMA).orderBy("product_id")


def stream_controlled(star: Star, root: str, n_files: int = 24) -> DataFrame:
    """The fact from a stream whose batch size follows its rates: all lines, whatever sizes came out."""
    from .control import RateControl, file_source, run_controlled
    from .runner import stage_ranges
    staged = staged_time(star)
    stage_ranges(star.spark, staged, "time_id", n_files // N_RANGES, f"{root}/source")
    run_controlled(star.spark, file_source(star.spark, staged.schema, f"{root}/source"),
                   enrich_sink(star, f"{root}/fact"), f"{root}/checkpoint", f"{root}/rates",
                   RateControl(seconds=5.0, most=n_files, limit=4))
    return star.spark.read.parquet(f"{root}/fact").drop("stream", "batch_id")


# ---- K5 / C7: keyed buffer of the outer relation ---------------------------

def stream_rows_by_key(star: Star, root: str, n_ranges: int = N_RANGES) -> DataFrame:
    """The outer relation (customer dimension rows) streamed in batches into the
    keyed buffer: every row under its key, with its place in the stream."""
    path = f"{root}/rows_by_key"
    outer = number_rows(star.customer_dim.select("customer_id", "product_id"),
                        ["customer_id"], "position")

    def sink(batch: DataFrame, batch_id: int) -> None:
        buffer_rows(batch, path, batch_id)

    run_ranges(star.spark, outer, "position", n_ranges, root, sink)
    return buffered(star.spark, path)


# ---- C6 + A5 + A6 + A8: the reference's own pipeline -----------------------

def stream_fact_compat(star: Star, root: str, n_ranges: int = N_RANGES) -> DataFrame:
    """The outer relation (customer dimension rows) streamed in batches into the
    compat fact.  The lookup (price, first line and first store of a product) is
    written once as one table and re-read by every batch; each batch writes its
    fact rows, reads them back by the 4-part key and appends its counts
    (attempted, loaded, rejected, read back) to an audit table."""
    spark = star.spark
    fact_path, audit_path = f"{root}/fact", f"{root}/audit"
    compat_lookup(star).write.mode("overwrite").parquet(f"{root}/lookup")
    outer = number_rows(star.customer_dim.select("customer_id", "product_id"),
                        ["customer_id"], "row_id")

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("customer_id", "product_id").persist()
        try:
            fact, rejects = fact_rows_compat(star, rows, spark.read.parquet(f"{root}/lookup"))
            batch_partition_write(fact, fact_path, batch_id, sort_by="product_id")
            written = spark.read.parquet(fact_path).where(in_batch("main", batch_id))
            back = written.join(fact.select(*FACT_KEYS), FACT_KEYS, "left_semi")
            n = F.count(F.lit(1))
            audit = rows.agg(n.alias("attempted")).select(
                "attempted",
                written.select(n).scalar().alias("loaded"),
                rejects.select(n).scalar().alias("rejected"),
                back.select(n).scalar().alias("read_back"))
            batch_partition_write(audit, audit_path, batch_id)
        finally:
            rows.unpersist()

    run_ranges(spark, outer, "row_id", n_ranges, root, sink)
    return spark.read.parquet(fact_path).drop("stream", "batch_id")


# ---- K1 on the reference's own file format ----------------------------------

def csv_ingest_sink(root: str, stream: str = "main"):
    """foreachBatch body for transaction CSV files: type and check every line
    (all columns of the batch are materialised, so malformed-line detection
    sees the whole line), append good lines with dense ids that continue from
    earlier batches, keep rejects with all their text and a reason."""
    from .. import schemas as SC
    from ..plans.load import TXN_ORDER, line_columns, rename_transactions, type_transactions

    def sink(batch: DataFrame, batch_id: int) -> None:
        typed = type_transactions(rename_transactions(batch)).persist()
        try:
            bad = typed.where(F.col("reason").isNotNull()).select(
                "order_id", "order_date_text", "text", "reason")
            key_and_store(line_columns(typed), bad, TXN_ORDER, root, batch_id, stream,
                          lambda keyed: SC.conform(keyed, SC.TIME_DIM))
        finally:
            typed.unpersist()
    return sink


def ingest_csv_stream(spark, landing: str, root: str, files_per_batch: int = 1,
                      stream: str = "main", sink=None, columns=None, multiline: bool = False):
    """Transaction CSV files landing in ``landing`` (header, the reference's
    column names in any order, the same in all files), taken ``files_per_batch``
    files per micro-batch, until the folder is drained (availableNow).  Each
    ``stream`` name has a checkpoint of its own under ``root``.  A batch also has the columns
    ``file`` and ``block`` (where a row was read); ``columns``: other header names."""
    from ..schemas import TRANSACTION_CSV_COLUMNS
    from ..sources.csv import CORRUPT, CSV_OPTIONS, header_schema
    schema = header_schema(spark, landing, columns or TRANSACTION_CSV_COLUMNS, multiline)
    source = (spark.readStream.schema(schema)
              .options(**CSV_OPTIONS).option("mode", "PERMISSIVE").option("multiLine", multiline)
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("maxFilesPerTrigger", files_per_batch).csv(landing)
              .select("*", F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block")))
    q = (source.writeStream.foreachBatch(sink or csv_ingest_sink(root, stream))
         .option("checkpointLocation", f"{root}/checkpoint/{stream}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# fixed values: order-date bounds of the three landing files of the CSV stream test
LANDING_BOUNDS = ("1997-01-01", "1999-01-01")


def stream_csv_ingest(star: Star, root: str, n_files_per_range: int | None = None) -> DataFrame:
    """The given tables written as transaction CSV files (the reference's
    format, with its unreadable dates) into a landing folder: three date
    ranges, appended one after another, so later files hold later orders.
    The stream takes about a third of the files per micro-batch."""
    import math

    from ..schemas import TRANSACTION_CSV_COLUMNS
    from ..sources.csv import CSV_OPTIONS
    spark = star.spark
    raw = raw_transactions(star)
    names = ("order_id_text", "order_date_text", "product_id_text", "customer_id_text",
             "customer_name", "gender", "quantity_text")
    landing = f"{root}/landing"
    lo, hi = (F.lit(b + " 00:00:00").cast("timestamp_ntz") for b in LANDING_BOUNDS)
    d = F.col("ord_order_date")
    for cond in (d < lo, (d >= lo) & (d < hi), d >= hi):
        part = raw.where(cond).select(*[F.col(c).alias(h)
                                        for c, h in zip(names, TRANSACTION_CSV_COLUMNS)])
        part.write.mode("append").options(**CSV_OPTIONS).csv(landing)
    n_files = len(spark.read.text(landing).inputFiles())
    ingest_csv_stream(spark, landing, root, max(1, math.ceil(n_files / 3)))
    return spark.read.parquet(f"{root}/lines").drop("stream", "batch_id")

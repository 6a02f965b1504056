"""Streams of files into the warehouse that the queries read.

Transaction files: each micro-batch is typed and keyed, its lines go to ``time_dim`` and
on to ``sales_fact`` (or ``fact_rejects``), and its customers are offered to the customer
dimension.  Master files: suppliers, products and stores are offered to their
dimensions, and lines that waited for one of the products become facts
(``fact_late``).  The layout, the checks and the first-wins order are those of a load, so
a dimension is the same whatever order loads and files arrive in.

A stream writes to one version of the warehouse and keeps its checkpoint there.  A
reload makes a new version without the streamed lines; the next run, or the run that the
reload overtook, then reads the landed files anew into it.  A file enters a version
once: files of the load, and files that another stream took, are left out.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans import queries as Q
from ..plans.fact import LINE_REJECT, REASON_RANGE, judged_lines
from ..plans.load import (TXN_ORDER, line_columns, load_csv_warehouse, member_rows, rejected_rows, rename_master,
                          rename_transactions, row_place, type_master, type_transactions, winners)
from ..plans.warehouse import (DIMENSIONS, LOAD, WarehouseStar, current_version, dimension, late_lines, read_batches)
from ..sources.csv import write_csv
from ..sources.paths import exists, folder_bytes, read_parquet_if_exists, remove_folder
from ..sources.raw import master_csv_rows, transaction_csv_rows
from .claims import claim_files
from .constraints import check_batch, seed_filter
from .jobs import LANDING_BOUNDS, ingest_csv_stream, key_and_store
from .runner import batch_partition_write, before_batch, in_batch

MASTER_DIMENSIONS = ("supplier", "product", "store")


class BatchAudit:
    """Rows that a batch brought, stored, rejected and found stored already, per table.

    Counted from what the batch holds in its cache and has written, so an empty branch of a plan
    that is never run leaves no count open."""

    def __init__(self, base: str, batch_id: int, stream: str):
        self.base, self.batch_id, self.stream = base, batch_id, stream
        self.rows: list[tuple] = []
        #: A dimension holds this batch in its base version: its audit was written before that.
        self.replayed = False

    def note(self, table: str, attempted: int, loaded: int, rejected: int) -> None:
        self.rows.append((table, attempted, loaded, rejected, attempted - loaded - rejected))

    def judged(self, table: str, rows: DataFrame) -> None:
        """``rows`` with a reason are rejected, all others loaded."""
        got = rows.agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad")).first()
        self.note(table, got.n, got.n - got.bad, got.bad)

    def write(self, spark: SparkSession) -> None:
        if not self.replayed:
            batch_partition_write(spark.createDataFrame(self.rows, S.LOAD_AUDIT).coalesce(1),
                                  f"{self.base}/load_audit", self.batch_id, stream=self.stream)


def _offer(spark: SparkSession, names: tuple[str, ...], rows: DataFrame, audit: BatchAudit) -> None:
    """Store the members that a batch brings to dimensions and that are new, or come before what is
    stored for them."""
    usable = {name: F.coalesce(member_rows(name), F.lit(False)) for name in names}
    seen = rows.agg(F.count(F.lit(1)).alias("n"),
                    *[F.count_if(~ok).alias(name) for name, ok in usable.items()]).first()
    for name, ok in usable.items():
        table = dimension(spark, audit.base, name)
        own = S.conform(winners(name, rows.where(ok)), DIMENSIONS[name][0])
        if table.offer(own, audit.batch_id, audit.stream, fold=False):
            stored = read_parquet_if_exists(spark, table.partials)
            n = 0 if stored is None else stored.where(in_batch(audit.stream, audit.batch_id)).count()
            audit.note(name, seen.n, n, seen[name])
        else:
            audit.replayed = True


def _own_files(typed: DataFrame, base: str, batch_id: int, stream: str) -> DataFrame:
    """The rows of files that no load and no other stream has brought into this version."""
    spark = typed.sparkSession
    loaded = read_batches(spark, base, "landed").where(F.col("stream") == LOAD).select("file")
    # at most as many names as a batch may have files
    files = [r.file for r in typed.select("file").distinct().join(loaded, "file", "left_anti").collect()]
    return typed.where(F.col("file").isin(claim_files(spark, f"{base}/claims", stream, batch_id, files)))


def _signature(spark: SparkSession, base: str) -> tuple:
    """Changes with every batch and fold of the product dimension."""
    table = dimension(spark, base, "product")
    return tuple(sorted(table.written())), tuple(table.journal.numbers())


def _settle(wh: WarehouseStar, waiting: DataFrame, audit: BatchAudit) -> None:
    """Rejected lines ``waiting`` whose product is there by now become facts (``fact_late``)."""
    spark, base, batch_id, stream = wh.spark, wh.base, audit.batch_id, audit.stream
    if late_lines(spark, base) is not None:
        others = read_batches(spark, base, "fact_late").where(before_batch(stream, batch_id))
        waiting = waiting.join(others.select("time_id"), "time_id", "left_anti")
    judged = judged_lines(wh, waiting).persist()
    try:
        audit.judged("late_line", judged)
        batch_partition_write(S.conform(judged.where("reason IS NULL"), S.SALES_FACT), f"{base}/fact_late", batch_id,
                              stream=stream, first=("year",))
    finally:
        judged.unpersist()


def transaction_sink(spark: SparkSession, root: str, stream: str, base: str | None = None, checked: bool = False):
    """foreachBatch body: one batch of transaction lines into the version ``base`` (the
    current one of ``root`` by default).  ``checked``: its keys are checked too (``constraints``)."""
    base = base or current_version(spark, root)
    if checked:
        seed_filter(WarehouseStar(spark, root, base=base))

    def sink(batch: DataFrame, batch_id: int) -> None:
        wh, audit = WarehouseStar(spark, root, base=base), BatchAudit(base, batch_id, stream)
        known = _signature(spark, base)
        everything = type_transactions(rename_transactions(batch)).persist()
        try:
            typed = _own_files(everything, base, batch_id, stream) if "file" in batch.columns else everything
            _offer(spark, ("customer",), typed, audit)
            audit.judged("time", typed)
            lines = key_and_store(line_columns(typed), rejected_rows(stream, "order_id", typed), TXN_ORDER,
                                  base, batch_id, stream, lambda keyed: S.conform(keyed, S.TIME_DIM), "time_dim",
                                  ("year",))
            judged = judged_lines(wh, lines).persist()
            try:
                audit.judged("sales_fact", judged)
                batch_partition_write(S.conform(judged.where("reason IS NULL"), S.SALES_FACT), f"{base}/sales_fact",
                                      batch_id, "product_id", stream, ("year",))
                batch_partition_write(judged.where("reason IS NOT NULL").select(*LINE_REJECT),
                                      f"{base}/fact_rejects", batch_id, stream=stream)
            finally:
                judged.unpersist()
            if checked:
                check_batch(wh, lines, batch_id, stream)
            if _signature(spark, base) != known:  # a product may have come while the lines were judged
                own = read_batches(spark, base, "fact_rejects").where(in_batch(stream, batch_id))
                _settle(wh, own, audit)
            audit.write(spark)
            dimension(spark, base, "customer").fold_if_due(batch_id, stream)
        finally:
            everything.unpersist()
    return sink


def master_sink(spark: SparkSession, root: str, stream: str, base: str | None = None):
    """foreachBatch body: one batch of master rows into the dimensions of the version ``base``."""
    base = base or current_version(spark, root)

    def sink(batch: DataFrame, batch_id: int) -> None:
        wh, audit = WarehouseStar(spark, root, base=base), BatchAudit(base, batch_id, stream)
        typed = type_master(rename_master(batch.withColumn("row_ord", row_place("file", "block")))).persist()
        try:
            _offer(spark, MASTER_DIMENSIONS, typed, audit)
            batch_partition_write(rejected_rows(stream, "product_id", typed), f"{base}/rejects", batch_id,
                                  stream=stream)
            brought = typed.where(member_rows("product")).select("product_id").distinct()
            waiting = (read_batches(spark, base, "fact_rejects").where(F.col("reason") != REASON_RANGE)
                       .join(brought, "product_id", "left_semi"))
            _settle(wh, waiting, audit)
            audit.write(spark)
            for name in MASTER_DIMENSIONS:
                dimension(spark, base, name).fold_if_due(batch_id, stream)
        finally:
            typed.unpersist()
    return sink


#: The name under which the sink of transaction lines was first offered.
warehouse_sink = transaction_sink


def _drain(spark: SparkSession, landing: str, root: str, files_per_batch: int, stream: str, sink, **options) -> None:
    """Drain a folder into the current version; again if a load has made a new one meanwhile."""
    while True:
        base = current_version(spark, root)
        ingest_csv_stream(spark, landing, base, files_per_batch, stream, sink(spark, root, stream, base), **options)
        if current_version(spark, root) == base:
            return


def stream_into_warehouse(spark: SparkSession, landing: str, root: str, files_per_batch: int = 10,
                          stream: str = "landing", checked: bool = False) -> None:
    """Drain a folder of transaction CSV files into the warehouse at ``root``.

    ``files_per_batch`` bounds a micro-batch.  Run again when more files have
    landed, or after a reload: the checkpoint of ``stream`` in each version knows the files
    that this version has.  ``checked``: repeated lines, and lines of products and customers
    that no dimension has, are noted in ``violations``."""
    _drain(spark, landing, root, files_per_batch, stream, partial(transaction_sink, checked=checked))


def stream_master_into_warehouse(spark: SparkSession, landing: str, root: str, files_per_batch: int = 10,
                                 stream: str = "master", multiline: bool = False) -> None:
    """Drain a folder of master CSV files into the dimensions of the warehouse at ``root``.

    A dimension takes the row that comes first by file name and place in the file, as in a
    load of all the files, whatever order they arrive in.  Facts keep the price that their
    product had when they were made."""
    _drain(spark, landing, root, files_per_batch, stream, master_sink, columns=S.MASTER_CSV_COLUMNS,
           multiline=multiline)


def audit_totals(spark: SparkSession, root: str, stream: str | None = None) -> dict[str, dict[str, int]]:
    """Rows attempted, loaded, rejected and repeated per table of the current version, over all batches
    (of one stream)."""
    audit = read_batches(spark, current_version(spark, root), "load_audit")
    if stream is not None:
        audit = audit.where(F.col("stream") == stream)
    names = S.LOAD_AUDIT.fieldNames()[1:]
    return {r.table_name: {n: r[n] for n in names} for r in
            audit.groupBy("table_name").agg(*[F.sum(n).alias(n) for n in names]).collect()}


# ---- registered forms --------------------------------------------------------

#: Bytes of a slice's staged lines for each of its landing files; there are two files at least.
FILE_BYTES = 4_000_000


def _landing_slices(star, root: str, again: Column | None = None) -> dict[str, int]:
    """The given tables as CSV files: all master rows, and transactions in three ranges of dates; the number of
    files by slice.  ``again``: lines of the second range that land once more, in a folder of their own.

    Lines are joined and put into text once, and a slice has as many files as its size asks for, so that they
    are written and read side by side."""
    spark = star.spark
    write_csv(master_csv_rows(star), f"{root}/in/master")
    lo, hi = (F.lit(b + " 00:00:00").cast("timestamp_ntz") for b in LANDING_BOUNDS)
    day = F.col("ord_order_date")
    named = F.when(day < lo, "load").when(day < hi, "first").when(day >= hi, "second")
    names = [named] if again is None else [named, F.when((named == "first") & again, "again")]
    rows = transaction_csv_rows(star, more={"slice": F.explode(F.array_compact(F.array(*names)))})
    staged, schema, files = f"{root}/slices", rows.drop("slice").schema, {}
    rows.write.mode("overwrite").partitionBy("slice").parquet(staged)
    for name in ("load", "first", "second", "again")[:len(names) + 2]:
        path = f"{staged}/slice={name}"
        there = exists(spark, path)  # a slice may have no line
        lines = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
        files[name] = max(2, folder_bytes(spark, path) // FILE_BYTES if there else 0)
        write_csv(lines.repartition(files[name], "Order ID"), f"{root}/in/{name}")  # an order is in one file
    remove_folder(spark, staged)
    return files


def loaded_and_streamed(star, root: str) -> WarehouseStar:
    """The given tables through CSV files: the earliest orders by a load, two
    later ranges by a stream in two batches each."""
    return _load_and_stream(star.spark, root, _landing_slices(star, root))


def _load_and_stream(spark: SparkSession, root: str, files: dict[str, int]) -> WarehouseStar:
    wh = f"{root}/warehouse"
    load_csv_warehouse(spark, f"{root}/in/master", f"{root}/in/load", wh)
    for name in ("first", "second"):
        stream_into_warehouse(spark, f"{root}/in/{name}", wh, -(-files[name] // 2), name)
    return WarehouseStar(spark, wh)


def stream_then_q4(star, root: str) -> DataFrame:
    """Q4 over a warehouse that a load and two streams have filled."""
    return Q.q4_quarter_pivot(loaded_and_streamed(star, root))


def stream_then_q9(star, root: str) -> DataFrame:
    """Q9 (line grain) over a warehouse that a load and two streams have filled."""
    return Q.q9_line(loaded_and_streamed(star, root))


def reload_then_stream(star, root: str) -> DataFrame:
    """A load, two streams, a reload and the same streams again: every line's fact once."""
    files = _landing_slices(star, root)
    _load_and_stream(star.spark, root, files)
    return _load_and_stream(star.spark, root, files).sales_fact.select("product_id", "customer_id", "store_id", "total_sale", "year")


def _master_in_parts(star, root: str) -> None:
    """Master rows in two folders: products with odd ids, and the others in two files."""
    rows = master_csv_rows(star)
    even = F.col("productID").cast("long") % 2 == 0
    place = F.col("productID").cast("long")
    for name, part, files in (("others", even, 2), ("some", ~even, 1)):
        write_csv(rows.where(part).repartitionByRange(files, place).sortWithinPartitions(place), f"{root}/in/{name}")


def late_products(star, root: str) -> DataFrame:
    """A load that lacks half of the products, a stream of lines, then a stream of the other
    products: the facts of all lines."""
    spark, wh = star.spark, f"{root}/warehouse"
    files = _landing_slices(star, root)
    _master_in_parts(star, root)
    load_csv_warehouse(spark, f"{root}/in/some", f"{root}/in/load", wh)
    stream_into_warehouse(spark, f"{root}/in/first", wh, files["first"], "first")
    stream_master_into_warehouse(spark, f"{root}/in/others", wh, 1)
    stream_into_warehouse(spark, f"{root}/in/second", wh, files["second"], "second")
    return WarehouseStar(spark, wh).sales_fact.select("product_id", "customer_id", "store_id", "total_sale", "year")


def stream_master_dims(star, root: str) -> DataFrame:
    """Suppliers, products and stores of a warehouse that got half of the master rows by a load and
    the other half by a stream: one row per member."""
    spark, wh = star.spark, f"{root}/warehouse"
    _master_in_parts(star, root)
    write_csv(transaction_csv_rows(star), f"{root}/in/load")
    load_csv_warehouse(spark, f"{root}/in/others", f"{root}/in/load", wh)
    stream_master_into_warehouse(spark, f"{root}/in/some", wh, 1)
    out, star = None, WarehouseStar(spark, wh)
    for name, table, of, ref in (("supplier", star.supplier, "supplier_id", F.lit(None)),
                                 ("product", star.product, "product_id", F.col("supplier_id")),
                                 ("store", star.store_dim, "store_id", F.lit(None))):
        part = table.select(F.lit(name).alias("dimension"), F.col(of).cast("long").alias("id"),
                            F.col(f"{name}_name").alias("name"), ref.cast("long").alias("supplier_id"))
        out = part if out is None else out.unionByName(part)
    return out


def stream_constraints(star, root: str) -> DataFrame:
    """Checked streams into a warehouse that lacks half of the products, with some lines landing
    twice: violating keys by constraint."""
    spark, wh = star.spark, f"{root}/warehouse"
    files = _landing_slices(star, root, again=F.col("ord_order_id") % 40 == 0)
    _master_in_parts(star, root)
    load_csv_warehouse(spark, f"{root}/in/some", f"{root}/in/load", wh)
    for name in ("first", "second", "again"):
        stream_into_warehouse(spark, f"{root}/in/{name}", wh, -(-files[name] // 2), name, checked=True)
    found = read_batches(spark, current_version(spark, wh), "violations")
    return found.groupBy("constraint").agg(F.countDistinct("key").alias("violations"))

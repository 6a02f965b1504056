"""Stored aggregate tables (I1-I6): the reference's "materialised" views.

A view that MySQL recomputes on every read becomes a parquet table here.

* Full refresh: recompute, write to a new version folder, then name it in the next
  entry of the table's journal.  Readers never see a half-written table and
  a job never reads and overwrites the same path in one plan.
* Incremental refresh: each batch of new order lines is aggregated on its own
  and written to ``partials/stream=S/batch_id=N`` (dynamic partition overwrite,
  so a replayed batch replaces itself, and two streams never replace each
  other's).  Reading regroups the base version and the partials that it does not
  cover; SUM is additive, so this equals a full rebuild.  ``compact`` folds the
  partials into a new base version.
* An entry notes the last batch of every stream that a version covers: those
  partials are no longer read, and a replay of such a batch changes nothing.
* Several tables may share one journal (``TableSet``): an entry then names a version
  of each, so that they are switched together.
* Retention: ``prune`` deletes what no entry kept can reach: versions that only older
  entries name, and partials that every version kept covers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import first_wins, improving_rows
from ..operators.olap import money, qty_by_product
from ..sources.journal import Journal
from ..sources.paths import remove_folder, subfolders
from ..streaming.runner import batch_partition_write, before_batch


def _covers(newer: dict[str, int], older: dict[str, int]) -> bool:
    return all(newer.get(stream, -1) >= last for stream, last in older.items())


@dataclass
class AggregateTable:
    """A stored aggregate (SUM measures by ``keys``) under ``root``.

    ``compact_every``: fold the partials into a new base version once that
    many batches have been written since the base, so reads never regroup an
    ever-growing log.  ``retain``: after a fold, keep what the newest so many
    journal entries reach and delete the rest (None: keep all).  ``versions``, ``name``: a
    journal shared with other tables, and this table's name in it.  ``schema``: of
    a base version, which then need not be looked up in its files."""
    spark: SparkSession
    root: str
    keys: list[str]
    measures: list[str]
    compact_every: int | None = None
    retain: int | None = None
    versions: str | None = None
    name: str = "table"
    schema: StructType | None = None

    # ---- layout ----------------------------------------------------------
    @property
    def journal(self) -> Journal:
        return Journal(self.spark, self.versions or f"{self.root}/_versions")

    @property
    def partials(self) -> str:
        return f"{self.root}/partials"

    def current(self) -> tuple[str | None, dict[str, int]]:
        """(base version path, last batch id that it covers of each stream)."""
        state = (self.journal.last() or {}).get(self.name)
        if state is None and self.versions is None:  # a table of a set, opened by its folder alone
            folder, _, name = self.root.rstrip("/").rpartition("/")
            state = (Journal(self.spark, f"{folder}/_versions").last() or {}).get(name)
        return (None, {}) if state is None or "marks" not in state else (state["path"], dict(state["marks"]))

    def written(self) -> list[tuple[str, int]]:
        """(stream, batch id) of every partial, from the folder names."""
        out = []
        for s in subfolders(self.spark, self.partials):
            if s.startswith("stream="):
                out += [(unquote(s[7:]), int(b[9:])) for b in subfolders(self.spark, f"{self.partials}/{s}")
                        if b.startswith("batch_id=")]
        return out

    def logged(self) -> dict[str, int]:
        """Last batch id of each stream in the base version or the partials."""
        _, marks = self.current()
        for stream, batch in self.written():
            marks[stream] = max(batch, marks.get(stream, batch))
        return marks

    # ---- full refresh ----------------------------------------------------
    def write_version(self, df: DataFrame) -> str:
        """Write ``df`` to a new version folder that no reader sees yet."""
        path = f"{self.root}/v={uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        return path

    def refresh_full(self, df: DataFrame, covers: dict[str, int] | None = None) -> str:
        """Replace the table by ``df``, a rebuild from all lines.

        ``covers``: last batch of each stream whose lines ``df`` holds; by default
        every batch applied so far.  Later batches are added to it."""
        covers = self.logged() if covers is None else covers
        path = self.write_version(df)
        self.journal.append(lambda last: {**(last or {}), self.name: {"path": path, "marks": covers}})
        return path

    # ---- incremental refresh ---------------------------------------------
    def apply_batch(self, partial: DataFrame, batch_id: int, stream: str = "main", fold: bool = True) -> bool:
        """Add one batch of ``stream``; streams with checkpoints of their own
        need names of their own.  False: a replay of a batch that the base version
        holds, which changes nothing.  ``fold``: fold the log when it is due."""
        if batch_id <= self.current()[1].get(stream, -1):
            return False
        batch_partition_write(partial, self.partials, batch_id, stream=stream)
        if fold:
            self.fold_if_due(batch_id, stream)
        return True

    def fold_if_due(self, batch_id: int, stream: str = "main") -> None:
        if self.compact_every and batch_id - self.current()[1].get(stream, -1) >= self.compact_every:
            self.compact()

    def _regroup(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.keys).agg(
            *[money(F.sum(m)).alias(m) for m in self.measures])

    def _stored(self, wanted=None) -> tuple[DataFrame | None, DataFrame | None]:
        """(base version, the partials that it does not cover); ``wanted`` filters
        the partials by stream and batch_id."""
        base_path, marks = self.current()
        base = None
        if base_path is not None:
            reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
            base = reader.parquet(base_path)
        log = None
        if any(batch > marks.get(stream, -1) for stream, batch in self.written()):
            log = self.spark.read.parquet(self.partials)
            for stream, last in marks.items():
                log = log.where((F.col("stream") != stream) | (F.col("batch_id") > last))
            if wanted is not None:
                log = log.where(wanted)
            log = log.drop("stream", "batch_id")
        return base, log

    def rows(self, wanted=None) -> DataFrame | None:
        """All stored rows that count, not yet regrouped; None where there is no table."""
        parts = [p for p in self._stored(wanted) if p is not None]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def read(self, upto: dict[str, int] | None = None) -> DataFrame:
        """The table; ``upto`` leaves out later batches."""
        wanted = None
        if upto is not None:
            wanted = F.lit(False)
            for stream, last in upto.items():
                wanted |= (F.col("stream") == stream) & (F.col("batch_id") <= last)
        base, log = self._stored(wanted)
        if base is None and log is None:
            raise ValueError(f"aggregate table at {self.root} is empty")
        if log is None:
            return base
        return self._regroup(log if base is None else base.unionByName(log))

    def compact(self) -> str | None:
        """Fold base + partials into a new base version, if there are any partials.

        If another writer has switched to a version that covers more in the meantime,
        that one stays."""
        upto = self.logged()
        if not upto:
            return None
        path = self.write_version(self.read(upto))

        def switched(last: dict | None) -> dict | None:
            state = (last or {}).get(self.name)
            if state is not None and not _covers(upto, state["marks"]):
                return None
            return {**(last or {}), self.name: {"path": path, "marks": upto}}

        if self.journal.append(switched) is None:
            remove_folder(self.spark, path)
            return None
        if self.retain:
            prune([self], self.retain)
        return path


def prune(tables: Iterable[AggregateTable], keep: int = 2) -> int:
    """Delete what the newest ``keep`` entries of the tables' journal do not reach.

    ``tables``: all tables of one journal.  A version that an older entry names and no kept
    one does, and a partial that the versions of all kept entries cover, can be in no
    result any more; a replay of such a batch is still ignored, as the marks stay.  A
    reader that planned on an older version must be done, so keep two entries at
    least.  Folders that no entry has named yet are left: they may be in the making.
    Returns the number of folders deleted."""
    tables, gone = list(tables), 0
    journal = tables[0].journal
    entries = [journal.read(n) for n in journal.numbers()]
    kept, old = entries[-max(1, keep):], entries[:-max(1, keep)]
    for t in tables:
        states = [e[t.name] for e in kept if t.name in e]
        reached = {s["path"] for s in states}
        for path in {e[t.name]["path"] for e in old if t.name in e} - reached:
            remove_folder(t.spark, path)
            gone += 1
        for stream, batch in t.written():
            if states and all(batch <= s["marks"].get(stream, -1) for s in states) and len(states) == len(kept):
                remove_folder(t.spark, f"{t.partials}/stream={stream}/batch_id={batch}")
                gone += 1
    journal.prune(keep)  # last, so that a prune that was cut off can be run again
    return gone


@dataclass
class FirstWinsTable(AggregateTable):
    """A stored first-wins dimension: per key the values (``measures``) of the row
    that comes first in ``order``, whichever batch brought it."""
    order: list[str] = field(default_factory=list)

    def _regroup(self, df: DataFrame) -> DataFrame:
        return first_wins(df, self.keys, self.order, self.measures, keep_order=True)

    def offer(self, candidates: DataFrame, batch_id: int, stream: str = "main", fold: bool = True) -> bool:
        """Store the rows of a batch that can still win: new keys, and rows earlier
        than all that other batches have stored for their key.  False: a replay of a batch
        that the base version holds."""
        if batch_id <= self.current()[1].get(stream, -1):
            return False
        own = self._regroup(candidates)
        stored = self.rows(before_batch(stream, batch_id))
        if stored is not None:
            own = improving_rows(own, stored, self.keys, self.order)
        return self.apply_batch(own, batch_id, stream, fold)


# the reference's three stored aggregates: name -> (query, group keys, measures)
STORED = {
    "store_analysis": ("q6_store_product_mv", ["store_id", "product_id"], ["store_total"]),
    "supplier_performance": ("q8_supplier_month_mv",
                             ["supplier_id", "supplier_name", "month"], ["monthly_sales"]),
    "customer_store_sales": ("q10_entity_month_mv_compat",
                             ["id", "entity_type", "entity_id", "month"], ["monthly_sales"]),
}


class MonthlyLines:
    """A star whose order lines are sums by product and month (``qty``); all else is as in the star."""

    def __init__(self, star, lines: DataFrame):
        self._star, self.lines = star, lines

    def __getattr__(self, name: str):
        return getattr(self._star, name)


class TableSet:
    """Stored aggregates under ``root`` that are switched together.

    One journal names a version of every table; a refresh writes all new versions and then
    appends one entry.  A reader takes one entry (``snapshot``) and reads all
    tables by it, so it sees either the old ones or the new ones."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple] | None = None):
        self.spark, self.root, self.tables = spark, root, tables or STORED

    @property
    def journal(self) -> Journal:
        return Journal(self.spark, f"{self.root}/_versions")

    def table(self, name: str) -> AggregateTable:
        _, keys, measures = self.tables[name]
        return AggregateTable(self.spark, f"{self.root}/{name}", keys, measures,
                              versions=f"{self.root}/_versions", name=name)

    def refresh(self, star) -> dict[str, str]:
        """Recompute every table; returns the new version path of each.

        The quantities by product and month, from which all tables of ``STORED`` follow, are summed once for
        them, after the marks of what they cover were taken."""
        from . import queries as Q
        fresh, monthly = {}, f"{self.root}/_monthly/{uuid.uuid4().hex}"
        covers = {name: self.table(name).logged() for name in self.tables}
        if self.tables is STORED:
            sums = qty_by_product(star.lines, ["month"]).withColumnRenamed("sum_qty", "qty")
            sums.write.mode("overwrite").parquet(monthly)
            star = MonthlyLines(star, self.spark.read.schema(sums.schema).parquet(monthly))
        for name, (query, _, _) in self.tables.items():
            fresh[name] = {"path": self.table(name).write_version(getattr(Q, query)(star)), "marks": covers[name]}
        remove_folder(self.spark, monthly)
        self.journal.append(lambda last: {**(last or {}), **fresh})
        return {name: state["path"] for name, state in fresh.items()}

    def snapshot(self) -> dict[str, dict]:
        """One entry of the journal: path and marks of every table."""
        entry = self.journal.last()
        if entry is None:
            raise ValueError(f"no table of the set at {self.root} has been written")
        return entry

    def read(self, name: str, snapshot: dict[str, dict] | None = None) -> DataFrame:
        """The version of a table that ``snapshot`` (by default the newest) names."""
        return self.spark.read.parquet((snapshot or self.snapshot())[name]["path"])

    def prune(self, keep: int = 2) -> int:
        return prune([self.table(name) for name in self.tables], keep)


def refresh_all(star, root: str) -> dict[str, str]:
    """Full refresh of the three stored aggregates (the body of the daily
    events): each is recomputed and written as a new version, then one journal entry
    switches to all three.  Returns the new version path of each.  Scheduling is the
    caller's."""
    return TableSet(star.spark, root).refresh(star)


# ---- registered forms ------------------------------------------------------

def mv_refresh_full(star, root: str) -> DataFrame:
    """Q8's table refreshed twice (the second run switches the version), read."""
    from .queries import q8_supplier_month_mv
    t = AggregateTable(star.spark, root, ["supplier_id", "supplier_name", "month"],
                       ["monthly_sales"])
    t.refresh_full(q8_supplier_month_mv(star))
    t.refresh_full(q8_supplier_month_mv(star))
    return t.read()


# fixed values: order-date bounds of the three slices of the incremental test
SLICE_BOUNDS = ("1997-01-01", "1999-01-01")


def order_slices(star) -> list[DataFrame]:
    lo, hi = (F.lit(b + " 00:00:00").cast("timestamp_ntz") for b in SLICE_BOUNDS)
    d = F.col("order_date")
    return [star.lines_filtered(d < lo),
            star.lines_filtered((d >= lo) & (d < hi)),
            star.lines_filtered(d >= hi)]


def mv_refresh_incremental(star, root: str) -> DataFrame:
    """Q8's table built from three slices of order lines as three batches,
    with a compaction after the second; read back regrouped."""
    from .queries import supplier_month
    t = AggregateTable(star.spark, root, ["supplier_id", "supplier_name", "month"],
                       ["monthly_sales"])
    for i, lines in enumerate(order_slices(star)):
        t.apply_batch(supplier_month(lines, star), i)
        if i == 1:
            t.compact()
    return t.read()


def mv_refresh_mixed(star, root: str) -> DataFrame:
    """Q8's table by increments of two streams, a full rebuild over the lines so
    far, and an increment and a replay after it."""
    from .queries import supplier_month
    t = AggregateTable(star.spark, root, ["supplier_id", "supplier_name", "month"],
                       ["monthly_sales"])
    first, second, third = order_slices(star)
    t.apply_batch(supplier_month(first, star), 0, "early")
    t.apply_batch(supplier_month(second, star), 0, "late")
    t.refresh_full(supplier_month(first.unionByName(second), star))
    t.apply_batch(supplier_month(second, star), 0, "late")   # replayed
    t.apply_batch(supplier_month(third, star), 1, "late")
    return t.read()


def refresh_set(star, root: str) -> DataFrame:
    """The three stored aggregates refreshed twice as one set and read by one snapshot: each
    group of each table (its keys joined by '/') and its sales."""
    tables = TableSet(star.spark, root)
    tables.refresh(star)
    tables.refresh(star)
    tables.prune(1)
    now, out = tables.snapshot(), None
    for name, (_, keys, measures) in STORED.items():
        part = tables.read(name, now).select(
            F.lit(name).alias("table_name"), F.concat_ws("/", *keys).alias("cell"), F.col(measures[0]).alias("sales"))
        out = part if out is None else out.unionByName(part)
    return out

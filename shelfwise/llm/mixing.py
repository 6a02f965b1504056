"""Mixing sources to target weights by pivotal dependent rounding.

Every text is one unit whose mass is its number of words.  A source whose
target is ``f`` times its size gives each of its units ``floor(f)`` copies and
a further one with probability ``f - floor(f)``.  Pivotal rounding decides
those further copies: two units meet, mass moves at random from one to the
other (up or down with the odds that keep every expectation) until one of the
two probabilities is 0 or 1, that unit is decided, and the other one goes on.
The words taken are kept at each meeting, so a source ends within one unit of
its target.

The meetings form a reduction tree: units of a source are dealt by hash into
blocks of about ``FAN``, a block is folded by ``reduce`` over its array, large units
first, and the one residual of each block goes on to the next level.  A hot source is
only more blocks.  Which unit is left at the end is chance, and it may be a large one; so
a source then settles towards its target: units that make up for what is over (or
missing) give their further copy back (or get one), and ``SETTLE`` times the unit
whose size is nearest to the rest does, if that helps.  Everything is DataFrame functions; the random numbers are hashes of the units'
keys, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.surrogate import dense_key
from .common import WORD_PATTERN, fresh, row_hash, stored, uniform

FAN = 256
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
_EDGE = 1e-9
#: Rounds in which one unit of a source may change sides at the end.
SETTLE = 3


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, units, source_size, target) for every source, NULL being one.

    Sources in code point order, NULL last, take ``weights`` in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's
    size and the excess is shared by weight among the others until none is
    above.  A source without words has target 0.
    """
    sums = (sizes.groupBy("source").agg(F.count(F.lit(1)).alias("units"),
                                        F.sum("size").alias("source_size"))
            .withColumn("last", F.col("source").isNull()))
    ranked = dense_key(sums, ["last", "source"], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = stored(ranked.select("source", "units", "source_size", weight.alias("weight")),
                     "mix_sources")
    cap = F.col("source_size") * F.lit(float(most))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while True:  # each round caps one more source at least
        under = F.col("weight") * F.lit(level) <= cap
        row = sources.agg(F.sum(F.when(under, F.col("weight"))).alias("weight"),
                          F.sum(F.when(~under, cap)).alias("capped"),
                          F.count(F.when(under, 1)).alias("n")).first()
        if not row.weight or row.n == before:
            break
        before, level = row.n, (share * total - (row.capped or 0.0)) / row.weight
    return sources.select("source", "units", "source_size",
                          F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


#: One meeting: ``acc.cur`` is the unit carried so far, ``x`` the next one.
#: ``fix`` says who is decided (cur or x), ``val`` how, ``p`` what the other has now.
_MEETING = f"""
(acc, x) -> element_at(transform(transform(array(named_struct(
    'a', acc.cur.size, 'b', x.size, 'p', acc.cur.p, 'q', x.p,
    'u', (xxhash64(acc.cur.id, acc.cur.h, x.id, x.h) & {(1 << 53) - 1}) / {float(1 << 53)!r}D)),
  t -> CASE
    WHEN t.p <= {_EDGE!r}D OR t.p >= 1 - {_EDGE!r}D
      THEN named_struct('fix', true, 'val', int(t.p > 0.5D), 'p', t.q)
    WHEN t.q <= {_EDGE!r}D OR t.q >= 1 - {_EDGE!r}D
      THEN named_struct('fix', false, 'val', int(t.q > 0.5D), 'p', t.p)
    WHEN t.u * (least((1 - t.p) * t.a, t.q * t.b) + least(t.p * t.a, (1 - t.q) * t.b))
         < least(t.p * t.a, (1 - t.q) * t.b) THEN
      CASE WHEN (1 - t.p) * t.a <= t.q * t.b
           THEN named_struct('fix', true, 'val', 1, 'p', t.q - (1 - t.p) * t.a / t.b)
           ELSE named_struct('fix', false, 'val', 0, 'p', t.p + t.q * t.b / t.a) END
    ELSE
      CASE WHEN t.p * t.a <= (1 - t.q) * t.b
           THEN named_struct('fix', true, 'val', 0, 'p', t.q + t.p * t.a / t.b)
           ELSE named_struct('fix', false, 'val', 1, 'p', t.p - (1 - t.q) * t.b / t.a) END
    END),
  r -> named_struct(
    'cur', IF(r.fix,
        named_struct('r', x.r, 'id', x.id, 'h', x.h, 'size', x.size, 'base', x.base, 'p', r.p),
        named_struct('r', acc.cur.r, 'id', acc.cur.id, 'h', acc.cur.h, 'size', acc.cur.size,
                     'base', acc.cur.base, 'p', r.p)),
    'done', concat(acc.done, array(IF(r.fix,
        named_struct('id', acc.cur.id, 'h', acc.cur.h, 'size', acc.cur.size, 'base', acc.cur.base,
                     'copies', acc.cur.base + r.val),
        named_struct('id', x.id, 'h', x.h, 'size', x.size, 'base', x.base, 'copies', x.base + r.val)))))), 1)
"""


def pivotal_copies(units: DataFrame, most_units: int) -> DataFrame:
    """(source, id, h, size, base, copies) of units (source, n, id, h, size, base, p) by the reduction tree.

    ``n`` is the number of units of the source, ``most_units`` the largest n.
    """
    decided = []
    while True:
        level = len(decided)
        blocks = F.ceil(F.col("n") / FAN)
        dealt = (units.withColumn("n", blocks).withColumn("r", -F.col("size"))
                 .groupBy("source", F.pmod(F.xxhash64("id", "h", F.lit(level)), "n").alias("block"))
                 .agg(F.max("n").alias("n"),
                      F.sort_array(F.collect_list(F.struct("r", "id", "h", "size", "base", "p")))
                      .alias("units")))
        folded = stored(dealt.select("source", "n", F.expr(
            "reduce(slice(units, 2, size(units)), named_struct('cur', units[0], 'done', "
            "cast(array() AS array<struct<id: bigint, h: bigint, size: double, base: int, copies: int>>)), "
            f"{_MEETING})").alias("f")), "mix_level")
        decided.append(folded.select("source", F.explode("f.done").alias("d")).select("source", "d.*"))
        units = folded.select("source", "n", "f.cur.id", "f.cur.h", "f.cur.size", "f.cur.base", "f.cur.p")
        most_units = -(-most_units // FAN)
        if most_units <= 1:
            break
    out = units.select("source", "id", "h", "size", "base", (
        F.col("base") + (uniform("id", "h", F.lit("last")) < F.col("p")).cast("int")).alias("copies"))
    for d in decided:
        out = out.union(d)
    return out


def settled(decisions: DataFrame, sources: DataFrame, rounds: int = SETTLE) -> DataFrame:
    """``decisions`` (source, id, h, size, base, copies, moving) nearer to the targets.

    First, of a source's moving units that are no larger than its error and can change sides, as many do, chosen
    by hash, as make up for it on average.  Then, in each round, the one unit whose size is
    nearest to the error left changes sides, if that makes the error smaller."""
    named = sources.select(F.col("source").alias("of"), "target")
    for k in range(rounds + 1):
        errors = (decisions.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
                  .join(named, F.col("source").eqNullSafe(F.col("of")))
                  .select("of", (F.col("taken") - F.col("target")).alias("over")))
        can = F.when(F.col("over") > 0, F.col("copies") > F.col("base")).otherwise(F.col("copies") == F.col("base"))
        able = (decisions.where("moving").join(errors, F.col("source").eqNullSafe(F.col("of"))).where(can)
                .select("of", "over", "id", "h", "size"))
        if k == 0:
            small = able.where(F.col("size") <= F.abs("over"))
            room = small.groupBy(F.col("of").alias("in")).agg(F.sum("size").alias("room"))
            turned = (small.join(room, F.col("of").eqNullSafe(F.col("in")))
                      .where(uniform("id", "h", F.lit("settle")) < F.abs("over") / F.col("room")))
        else:
            left = F.abs(F.abs("over") - F.col("size"))
            turned = (able.where(left < F.abs("over")).groupBy("of")
                      .agg(F.min(F.struct(left, "id", "h")).alias("m")).select("of", "m.id", "m.h"))
        turned = turned.select("of", F.col("id").alias("turned_id"), F.col("h").alias("turned_h"))
        same = (F.col("source").eqNullSafe(F.col("of")) & F.col("id").eqNullSafe(F.col("turned_id"))
                & (F.col("h") == F.col("turned_h")))
        decisions = stored(decisions.join(turned, same, "left").withColumn("copies", F.when(
            F.col("turned_h").isNull(), F.col("copies")).otherwise(2 * F.col("base") + 1 - F.col("copies")))
            .drop("of", "turned_id", "turned_h"), "mix_settled")
    return decisions


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        most: float = MOST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, sources, decisions) for the rows of ``docs`` (doc_id, source, text).

    decisions has one row (id, h, copies) per distinct (doc_id, text, source),
    ``h`` being their row_hash: repeated rows are one unit and share its copies.
    A text without words, or NULL, has size 0 and is copied by its own draw.  Only a text's size is
    looked at, so a very long one costs one pass over it; it may be most of what its source is off by.
    """
    sizes = stored(docs.select("doc_id", "source", row_hash("text", "source").alias("h"),
                               F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0))
                               .cast("long").alias("size")), "mix_sizes")
    sources = stored(source_targets(sizes, weights, share, most), "mix_targets")
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    distinct = sizes.groupBy("source", "doc_id", "h").agg(F.sum("size").cast("double").alias("size"))
    named = sources.withColumnRenamed("source", "of")
    units = stored(distinct.join(named, F.col("source").eqNullSafe(F.col("of")))
                   .select("source", F.col("units").alias("n"), F.col("doc_id").cast("long").alias("id"),
                           "h", "size", F.floor(factor).cast("int").alias("base"),
                           (factor - F.floor(factor)).alias("p")), "mix_units")
    moving = (F.col("size") > 0) & (F.col("p") > _EDGE) & (F.col("p") < 1 - _EDGE)
    alone = units.where(~moving).select("source", "id", "h", "size", "base", (
        F.col("base") + (uniform("id", "h", F.lit("alone")) < F.col("p")).cast("int")).alias("copies"))
    most_units = sources.agg(F.max("units")).first()[0] or 0
    decided = pivotal_copies(units.where(moving), most_units)
    decisions = settled(alone.withColumn("moving", F.lit(False)).union(decided.withColumn("moving", F.lit(True))),
                        sources)
    return sizes, sources, decisions.select("id", "h", "copies")


def mixed_words(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, copies and taken words.

    NULL texts have size 0, a NULL source is a source of its own, and rows equal in doc_id, text and source
    have the same copies (see :func:`mix`).  Empty ``docs`` give no rows; other columns are not read."""
    sizes, sources, decisions = mix(docs, **options)
    named = sources.withColumnRenamed("source", "of").drop("units")
    decided = decisions.select("id", F.col("h").alias("dh"), "copies")
    return (sizes.join(named, F.col("source").eqNullSafe(F.col("of")))
            .join(decided, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("dh")))
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it was given copies (0, 1 or 2)."""
    _, _, decisions = mix(docs, **options)
    h, i, n = fresh(docs, "_h", "_id", "_copies")
    decided = decisions.select(F.col("id").alias(i), F.col("h").alias(i + "h"),
                               F.col("copies").alias(n)).where(F.col(n) > 0)
    # shuffled at any size: a broadcast of a row per document is one for small inputs only
    return (docs.withColumn(h, row_hash("text", "source"))
            .join(decided.hint("merge"), F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(h) == F.col(i + "h")))
            .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns))

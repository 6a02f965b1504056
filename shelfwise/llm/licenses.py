"""License scans: Dice coefficient over word bigrams against licence templates.

Units are the lines of a text, the whole text (if it has several lines) and its
passages: runs of consecutive pieces, the pieces being the lines cut at sentence
ends.  A unit is normalised (lower case, everything but letters and digits is a
space) and reduced to its distinct word bigrams.  With ``a`` and ``b`` bigrams the
coefficient is ``2 * shared / (a + b)``, which reaches ``t`` only if
``a`` lies between ``b * t / (2 - t)`` and ``b * (2 - t) / t`` and ``shared`` is
at least the first of these.  So a text meets a template only if it holds one of
the template's ``marks`` and then that many of its bigrams, and a passage is
formed only of pieces that share bigrams with the template.  DataFrame functions
only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import TEXTS

THRESHOLD = 0.8

#: One-sentence notices, and the titles, notices and texts of the licences.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or "
               "neighboring rights to this work.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the "
               "Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the "
                      "terms of the GNU General Public License as published by the Free Software "
                      "Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
           "without fee is hereby granted, provided that the above copyright notice and this permission "
           "notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
} | TEXTS


def _bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def admissible(size: int, threshold: float) -> range:
    """Sizes that can reach the threshold with a template of ``size`` bigrams.

    One size more on either side guards against rounding; the coefficient decides.
    """
    return range(max(1, math.floor(size * threshold / (2 - threshold))),
                 math.ceil(size * (2 - threshold) / threshold) + 1)


def needed(size: int, threshold: float) -> int:
    """Bigrams of a template of ``size`` bigrams that a matching unit shares at least."""
    return max(1, math.ceil(size * threshold / (2 - threshold) - 1e-9))


def marks(templates: list[list[str]], threshold: float) -> list[str]:
    """Words of which a text holds one at least if a unit of it matches a template.

    For each template, all its bigrams but ``needed - 1`` at most hold one of the
    words.  Long words that serve many templates are taken first.
    """
    chosen: list[str] = []
    open_ = [(set(own), len(own) - needed(len(own), threshold) + 1) for own in templates]
    while open_ := [(own, left) for own, left in open_ if left > 0]:
        gains: dict[str, int] = {}
        for own, left in open_:
            touched: dict[str, int] = {}
            for word in (w for gram in own for w in set(gram.split())):
                touched[word] = touched.get(word, 0) + 1
            for word, n in touched.items():
                gains[word] = gains.get(word, 0) + min(n, left)
        best = max(gains, key=lambda w: (gains[w] * len(w) ** 2, w))
        chosen.append(best)
        open_ = [(rest, left - (len(own) - len(rest))) for own, left in open_
                 for rest in [{g for g in own if best not in g.split()}]]
    return chosen


def _let(value: Column, then) -> Column:
    """``then(value)``, the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _spans(owner: Column) -> Column:
    """(line, at, n) of the runs of equal ``owner.line`` and ``owner.piece``; ``at`` counts from 1."""
    def cut(o: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(o)),
                         lambda k: (k == 1) | (F.get(o, k - 1) != F.get(o, k - 2)))
        return _let(first, lambda at: F.transform(at, lambda s, x: F.struct(
            F.get(o, s - 1)["line"].alias("line"), s.alias("at"),
            (F.coalesce(F.get(at, x + 1), F.size(o) + 1) - s).alias("n"))))
    return _let(owner, cut)


def _words(text: Column) -> Column:
    """Words of a text in order: (line, piece, word), lines from 1; a text's pieces differ."""
    cut = F.regexp_replace(F.lower(text), r"[.!?:;]+(?=\s)", "\u0001")
    plain = F.regexp_replace(cut, "[^\\p{L}\\p{N}\n\u0001]+", " ")  # line and sentence ends stay
    return F.flatten(F.transform(F.split(plain, "\n"), lambda line, k: F.flatten(F.transform(
        F.split(line, "\u0001"), lambda piece, j: F.transform(
            F.filter(F.split(piece, " "), lambda w: w != ""),
            lambda w: F.struct((k + 1).alias("line"), j.alias("piece"), w.alias("word")))))))


def _dice(shared: Column, size: Column, size_template: Column) -> Column:
    return F.lit(2.0) * shared / (size + size_template)


def _lines(lines: Column, grams: Column, t: Column, threshold: float) -> Column:
    """Lines that reach the threshold with template ``t``."""
    def scored(span: Column) -> Column:
        own = F.slice(grams, span["at"], span["n"] - 1)
        return F.struct(span["line"].alias("unit"), span["at"].alias("at"),
                        (span["at"] + span["n"]).alias("stop"),
                        F.size(F.array_intersect(own, t["template"])).alias("n_shared"))

    def sized(u: Column) -> Column:
        n = F.size(F.array_distinct(F.slice(grams, u["at"], u["stop"] - u["at"] - 1)))
        return F.struct(u["unit"], n.alias("n_bigrams"), u["n_shared"], u["at"], u["stop"],
                        _dice(u["n_shared"], n, t["n_template"]).alias("dice"))

    near = F.filter(F.transform(lines, scored), lambda u: u["n_shared"] >= t["needed"])
    return F.filter(F.transform(near, sized), lambda u: u["dice"] >= threshold)


def _passages(pieces: Column, grams: Column, t: Column, covered: Column, threshold: float) -> Column:
    """Best passages of a text for template ``t`` that do not overlap the lines ``covered``.

    A passage begins and ends with a piece that shares a bigram, within it or with
    its neighbours (without it the coefficient were no lower), and has ``t.most`` bigrams at most, repeats counted.
    """
    hits = F.filter(F.transform(pieces, lambda p: F.struct(
        p["line"].alias("line"), p["at"].alias("at"), (p["at"] + p["n"]).alias("stop"),
        F.size(F.array_intersect(F.slice(grams, F.greatest(p["at"] - 1, F.lit(1)), p["n"] + 1),
                                 t["template"])).alias("h"))), lambda p: p["h"] > 0)
    free = F.filter(hits, lambda p: ~F.exists(covered, lambda c: (c["at"] < p["stop"]) & (p["at"] < c["stop"])))

    def ends(start: Column, x: Column, all_: Column) -> Column:  # a piece has a word at least
        return F.filter(F.slice(all_, x + 1, t["most"] + 1), lambda e: (
            (e["stop"] - start["at"] - 1 <= t["most"])
            & ~F.exists(covered, lambda c: (c["at"] < e["stop"]) & (start["at"] < c["stop"]))))

    def scored(start: Column, end: Column) -> Column:
        own = F.slice(grams, start["at"], end["stop"] - start["at"] - 1)
        shared, n = F.size(F.array_intersect(own, t["template"])), F.size(F.array_distinct(own))
        return F.struct((-_dice(shared, n, t["n_template"])).alias("rank"), n.alias("n_bigrams"),
                        start["at"].alias("at"), end["stop"].alias("stop"),
                        (-start["line"]).alias("unit"), shared.alias("n_shared"))

    def from_start(start: Column, x: Column, all_: Column) -> Column:
        reach = F.aggregate(ends(start, x, all_), F.lit(0), lambda acc, e: acc + e["h"])
        return _let(start, lambda s: F.filter(
            F.transform(F.when(reach >= t["needed"], ends(s, x, all_)), lambda e: scored(s, e)),
            lambda c: c["rank"] <= -threshold))

    found = _let(free, lambda all_: F.flatten(F.filter(
        F.transform(all_, lambda s, x: from_start(s, x, all_)), lambda c: c.isNotNull())))
    empty = F.slice(found, 1, 0)
    best = F.aggregate(F.array_sort(found), empty, lambda kept, c: F.when(
        F.exists(kept, lambda k: (k["at"] < c["stop"]) & (c["at"] < k["stop"])), kept)
        .otherwise(F.concat(kept, F.array(c))))
    return F.transform(best, lambda c: F.struct(c["unit"], c["n_bigrams"], c["n_shared"], c["at"], c["stop"],
                                                (-c["rank"]).alias("dice")))


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Every match: doc_id, unit, license_id, n_bigrams, n_shared, dice.

    ``unit`` numbers the lines (ended by \\n) from 1; 0 is the whole text; -k is a
    passage that begins in line k.  All templates that reach the threshold are
    given.  Passages are given where neither the whole text nor a line in them
    matches the template, and of overlapping ones the one that matches best.  NULL
    and empty texts, and units of fewer than two words, match nothing; repeated
    rows repeat.
    """
    spark = docs.sparkSession
    owns = {name: own for name, text in sorted(templates.items()) if (own := _bigrams(text))}
    listed = [(name, len(own), needed(len(own), threshold), admissible(len(own), threshold)[-1], own)
              for name, own in owns.items()]
    # bounded by the number and sizes of the templates
    known = F.broadcast(spark.createDataFrame(
        listed, "license_id string, n_template int, needed int, most int, template array<string>"))
    vocabulary = F.broadcast(spark.createDataFrame(
        [(sorted({g for own in owns.values() for g in own}),)], "vocabulary array<string>"))
    held = F.lit(False)
    for word in marks(list(owns.values()), threshold):
        held = held | F.contains(F.col("low"), F.lit(word))

    said = F.transform("words", lambda w: w["word"])
    grams = _let(said, lambda w: F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b)))
    owner = F.transform("words", lambda w: F.struct(w["line"].alias("line"), w["piece"].alias("piece")))
    in_line = F.transform("words", lambda w: F.struct(w["line"].alias("line"), F.lit(0).alias("piece")))
    read = (docs.select("doc_id", "text", F.lower("text").alias("low")).where(held)
            .select("doc_id", F.contains("text", F.lit("\n")).alias("several"), _words(F.col("text")).alias("words"))
            .where(F.size("words") > 1)
            .select("doc_id", "several", _spans(owner).alias("pieces"), _spans(in_line).alias("lines"),
                    grams.alias("grams")))
    met = (read.crossJoin(vocabulary)
           .withColumn("near", F.array_intersect("vocabulary", "grams"))
           .withColumn("size", F.size(F.array_distinct("grams")))
           .join(known, F.size(F.array_intersect("near", "template")) >= F.col("needed")))

    t = {c: F.col(c) for c in ("n_template", "needed", "most", "template")}
    shared = F.size(F.array_intersect("near", "template"))
    whole = F.struct(F.lit(0).alias("unit"), F.col("size").alias("n_bigrams"), shared.alias("n_shared"),
                     F.lit(1).alias("at"), (F.size("grams") + 2).alias("stop"),
                     _dice(shared, F.col("size"), t["n_template"]).alias("dice"))
    whole = F.filter(F.array(whole), lambda u: F.col("several") & (u["dice"] >= threshold))
    found = _let(whole, lambda w: _let(
        _lines(F.col("lines"), F.col("grams"), t, threshold), lambda ls: _let(
            F.concat(w, ls), lambda both: F.concat(both, _passages(
                F.col("pieces"), F.col("grams"), t, both, threshold)))))
    # outer: the optimizer would compute the list once more to see that it is not empty
    return (met.select("doc_id", "license_id", F.explode_outer(found).alias("u")).where("u IS NOT NULL")
            .select("doc_id", "u.unit", "license_id", "u.n_bigrams", "u.n_shared", "u.dice"))


def oracle(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB statement for :func:`license_matches` over ``documents``."""
    rows = ", ".join("({}, {})".format(*(f"'{x}'" for x in (k, v.replace("'", "''"))))
                     for k, v in sorted(templates.items()))
    grams = ("list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))")
    words = "string_split(trim(regexp_replace(lower({t}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    return f"""
WITH template(license_id, body) AS (VALUES {rows}),
t AS (SELECT license_id, {grams.format(w="w")} AS grams
      FROM (SELECT license_id, {words.format(t="body")} AS w FROM template)),
line AS (SELECT doc_id, string_split(text, chr(10)) AS ls, text FROM documents),
unit AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS unit, unnest(ls) AS body FROM line
         UNION ALL SELECT doc_id, 0, text FROM line WHERE len(ls) > 1),
u AS (SELECT doc_id, unit, {grams.format(w="w")} AS grams
      FROM (SELECT doc_id, unit, {words.format(t="body")} AS w FROM unit) WHERE len(w) > 1),
m AS (SELECT doc_id, unit, license_id, len(u.grams) AS n_bigrams, len(t.grams) AS n_template,
             len(list_intersect(u.grams, t.grams)) AS n_shared
      FROM u JOIN t ON len(u.grams) BETWEEN floor(len(t.grams) * {threshold} / {2 - threshold})
                                        AND ceil(len(t.grams) * {2 - threshold} / {threshold}))
SELECT doc_id, CAST(unit AS INTEGER) AS unit, license_id, CAST(n_bigrams AS INTEGER) AS n_bigrams,
       CAST(n_shared AS INTEGER) AS n_shared, 2.0 * n_shared / (n_bigrams + n_template) AS dice
FROM m WHERE 2.0 * n_shared / (n_bigrams + n_template) >= {threshold}
"""

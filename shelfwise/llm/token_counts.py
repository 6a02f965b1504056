"""Token counts by offset-mapped attribution.

A document is its fields joined by line ends, and each field is cut into sections, by default
its paragraphs.  The whole document is encoded once.  Its tokens' character spans are joined to
the sections' spans by binary search on the section starts; a token inside one
section counts there, and one that crosses a boundary is allocated by a rule:

* ``majority``: to the section that holds most of its characters, of equals
  the earlier one;
* ``start``: to the section of its first character;
* ``split``: to every section it touches, by its share of characters.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows
from .tokenizing import encoder

RULES = ("majority", "start", "split")
SECTION_CHARS = 1000
_LINE = re.compile(r"\n+(?=.)", re.S)


def paragraphs(text: str) -> list[int]:
    """Starts of a text's paragraphs: its lines; blank ones belong to the line before them."""
    return [0, *(m.end() for m in _LINE.finditer(text))]


def even_sections(text: str, size: int = SECTION_CHARS) -> list[int]:
    """Starts of sections of ``size`` code points; an empty text has one section."""
    return list(range(0, max(1, len(text)), size))


def allocate(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray,
             rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) per section, for spans sorted by start.

    A crossing token counts as crossing in the section where it begins.
    """
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, np.maximum(ends - 1, starts), "right") - 1
    across = np.flatnonzero(first != last)
    tokens = np.bincount(np.delete(first, across), minlength=len(sections)).astype(float)
    for t in across:
        edges = [starts[t], *sections[first[t] + 1:last[t] + 1], ends[t]]
        shares = np.diff(edges)
        if rule == "split":
            tokens[first[t]:last[t] + 1] += shares / shares.sum()
        else:
            tokens[first[t] + (int(shares.argmax()) if rule == "majority" else 0)] += 1
    return tokens, np.bincount(first[across], minlength=len(sections))


def field_tokens(docs: DataFrame, tokenizer: str, fields: Sequence[str] = ("text",),
                 sections: Callable[[str], list[int]] = paragraphs, rule: str = "majority") -> DataFrame:
    """One row per section: doc_id, field, section, start, n_chars, n_tokens, n_crossing.

    ``sections`` gives the ascending starts of a field's sections, the first one 0; ``start`` is
    a section's place in its field, and the line end behind a field belongs to its last section.
    NULL fields are empty; an empty field has one section.  Every row of ``docs`` is
    counted, repeated ones and those without an id too.  A document is encoded whole, in
    one task, in time and memory that grow with it.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")

    def count(batches: Iterator[list]) -> Iterator[list[tuple]]:
        enc = encoder(tokenizer)
        for ids, *columns in batches:
            values = [[v or "" for v in c] for c in columns]
            rows, texts = [], list(map("\n".join, zip(*values)))
            for doc, parts, spans in zip(ids, zip(*values), enc.token_spans(texts)):
                at, begin, named = 0, [], []
                for field, part in zip(fields, parts):
                    starts = sections(part)
                    begin += [at + s for s in starts]
                    ends = [*starts[1:], len(part)]
                    named += [(field, k, s, e - s) for k, (s, e) in enumerate(zip(starts, ends))]
                    at += len(part) + 1
                tokens, crossing = allocate(*spans, np.array(begin, dtype=np.int64), rule)
                rows += [(doc, *n, t, c) for n, t, c in zip(named, tokens.tolist(), crossing.tolist())]
            yield rows

    return map_rows(docs.select(F.col("doc_id").cast("long"), *[F.col(f).cast("string") for f in fields]), count,
                    "doc_id long, field string, section int, start long, n_chars long, n_tokens double, "
                    "n_crossing long")

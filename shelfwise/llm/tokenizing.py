"""Encoding of whole texts with a ``tokenizers`` file, one distinct word at a time.

The ids always come from the tokenizers library.  For a tokenizer that lower-cases
and whose pre-tokenizer drops white space, so that no token spans it (such as
word_bpe_49k), encoding a text equals encoding its lower-cased words one after
another.  Whether a tokenizer is one of these is looked up in what its normaliser and
pre-tokenizer do; with any other one whole texts are encoded one by one.  For these, a group of texts is split in Arrow, its distinct words are looked up
among those that the worker has met, and the tokens are gathered with numpy.  The
store is bounded and is emptied when full; it changes the time taken, never the
ids.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = b"\t\n\v\f\r"
#: ASCII white space as a space; for Latin-1 also lower case, one to one.
_SPACED = bytes(32 if c in _BLANK else c for c in range(256))
_LATIN = bytes(c + 32 if 65 <= c <= 90 or 192 <= c <= 222 and c != 215 else _SPACED[c] for c in range(256))
_LETTERS = frozenset(bytes([c]) for c in [*range(97, 123), *range(223, 247), *range(248, 256)])
_STOPS = frozenset(bytes([c]) for c in b".,!?;:")
#: A group of texts ends after so many characters.
_GROUP = 4_000_000


def word_wise(tokenizer) -> bool:
    """Whether a text's ids are those of its lower-cased words one after another.

    The normaliser must lower-case and act within words, and the pre-tokenizer must drop
    ASCII white space, so that no token holds or spans it."""
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
        return False

    def pieces(text: str) -> list[str]:
        return [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text))]

    for blank in (" ", "\t", "\n", "\v", "\f", "\r", " \n ", "  "):
        for a, b in (("AbC", "dE."), ("12", "x3"), ("\u00c9t\u00e9", "\u0301a"), ("it's", "'s")):
            if pieces(f"{blank}{a}{blank}{b}{blank}") != pieces(a.lower()) + pieces(b.lower()):
                return False
            both = tokenizer.encode(f"{a}{blank}{b}", add_special_tokens=False).ids
            if both != [i for w in (a.lower(), b.lower()) for i in tokenizer.encode(w, add_special_tokens=False).ids]:
                return False
    return True


class WordEncoder:
    """Ids (and character spans) of texts; see the module's docstring."""

    def __init__(self, path: str, most: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.word_wise = word_wise(self.tokenizer)
        self.most = most
        #: By what is asked for and the words' coding: word -> little-endian uint32
        #: ids, or the int32 (start, end) of its tokens.
        self.known: dict[tuple[str, str], dict[bytes, bytes]] = {}

    def _look_up(self, words: list[bytes], what: str, coding: str) -> list[bytes]:
        """Tokens of distinct words; a Latin word and the stop behind it are kept apart."""
        known = self.known.setdefault((what, coding), {})
        if len(known) > self.most:
            known.clear()
        cores = words if coding != "latin-1" else [
            w[:-1] if w[-1:] in _STOPS and w[-2:-1] in _LETTERS else w for w in words]
        found = list(map(known.get, cores))
        if None in found or not known:
            missing = {w for w, f in zip(cores, found) if f is None} | _STOPS - known.keys()
            e = self.tokenizer.encode([w.decode(coding, "replace") for w in missing], is_pretokenized=True,
                                      add_special_tokens=False)
            cut = np.searchsorted(np.array(e.word_ids, dtype=np.int64), np.arange(len(missing) + 1))
            flat, size = (np.array(e.ids, "<u4"), 4) if what == "ids" else (np.array(e.offsets, "<i4"), 8)
            flat, cut = flat.tobytes(), (size * cut).tolist()
            for k, w in enumerate(missing):
                known[w] = flat[cut[k]:cut[k + 1]]
            found = [known[w] if f is None else f for w, f in zip(cores, found)]
        if coding != "latin-1":
            return found
        if what == "ids":
            return [f if c is w else f + known[w[-1:]] for w, c, f in zip(words, cores, found)]
        return [f if c is w else f + np.array([len(c), len(w)], "<i4").tobytes()
                for w, c, f in zip(words, cores, found)]

    def _gather(self, texts: list[bytes], what: str, coding: str):
        """(tokens, their number by text, words' places by token) of spaced-out texts."""
        words = pc.split_pattern(pa.array(texts, pa.binary()), b" ")
        of_text = np.diff(words.offsets.to_numpy())
        coded = words.values.dictionary_encode()
        distinct, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found = self._look_up(distinct, what, coding)
        size = 4 if what == "ids" else 8
        count = np.array([len(f) for f in found], dtype=np.int64) // size
        begin, n = (np.cumsum(count) - count)[index], count[index]
        before = np.cumsum(n) - n
        at = np.repeat(begin - before, n) + np.arange(int(n.sum()))
        tokens = np.frombuffer(b"".join(found), "<u4" if what == "ids" else "<i8")[at]
        by_text = np.add.reduceat(np.append(n, 0), np.append(0, np.cumsum(of_text)[:-1])) if len(texts) else n
        if what == "ids":
            return tokens, by_text, None
        wide = np.array([len(w.decode(coding, "replace")) for w in distinct], dtype=np.int64)[index] + 1
        place = np.cumsum(wide) - wide
        first = np.cumsum(of_text) - of_text
        return tokens, by_text, np.repeat(place - np.repeat(place[first], of_text), n)

    def _groups(self, texts: list[str]) -> Iterator[list[str]]:
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= _GROUP:
                yield group
                group, size = [], 0
        if group:
            yield group

    def _each(self, texts: list[str], what: str) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        for group in self._groups(texts):
            out, coded = [None] * len(group), {"latin-1": ([], []), "utf-8": ([], [])}
            for k, t in enumerate(group):
                if not self.word_wise or any(s in t for s in self.specials):  # encoded as it is
                    e = self.tokenizer.encode(t, add_special_tokens=False)
                    out[k] = ((np.array(e.ids, "<u4"), None) if what == "ids" else
                              (np.array(e.offsets, "<i4").reshape(-1, 2).view("<i8")[:, 0], 0))
                    continue
                try:
                    raw, coding = t.encode("latin-1").translate(_LATIN), "latin-1"
                except UnicodeEncodeError:
                    raw, coding = t.encode("utf-8", "replace").translate(_SPACED), "utf-8"
                coded[coding][0].append(k)
                coded[coding][1].append(raw)
            for coding, (numbers, raw) in coded.items():
                if raw:
                    tokens, n, places = self._gather(raw, what, coding)
                    end = np.cumsum(n).tolist()
                    for k, a, b in zip(numbers, [0, *end], end):
                        out[k] = tokens[a:b], None if places is None else places[a:b]
            yield from out

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each whole text as little-endian uint32 (None: no ids)."""
        for tokens, _ in self._each([t or "" for t in texts], "ids"):
            yield tokens.tobytes()

    def token_spans(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Start and end (code points) of every token of each whole text."""
        for tokens, place in self._each(texts, "spans"):
            pairs = np.ascontiguousarray(tokens).view("<i4").reshape(-1, 2).astype(np.int64)
            yield pairs[:, 0] + place, pairs[:, 1] + place


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder for one tokenizer file; lives as long as the worker."""
    return WordEncoder(path)

"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole:

    <turn ROLE>
    TEXT</turn>

with ``\\``, ``<`` and ``>`` inside roles and texts escaped by a backslash, so
no text can pass for a control string and the output can be parsed back.  The
rendered text is encoded once with offsets, and each assistant text's character
span is intersected with the sorted token spans by binary search.

A conversation is one unit, however long: it is rendered, encoded and masked whole, in one
task, whose memory and time grow with it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows

_BODY = r"([^\\<>]*(?:\\.[^\\<>]*)*)"
_TURN = re.compile(rf"<turn {_BODY}>\n{_BODY}</turn>\n", re.S)


def escape(text: str) -> str:
    return re.sub(r"([\\<>])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns and the spans of the assistant's texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<turn {escape(role)}>\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}</turn>\n")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted text; the exact inverse of :func:`render`."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # spans keep their white space
    return t


def _byte_signs() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be
    seen, else the next free one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {**{chr(b): b for b in seen}, **{chr(256 + k): b for k, b in enumerate(rest)}}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of every token of a byte-level tokenizer, by id; special tokens are their text."""
    t, signs = _tokenizer(path), _byte_signs()
    out = [b""] * t.get_vocab_size()
    for token, i in t.get_vocab().items():
        out[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode("utf-8")
    return out


def align(spans: list[tuple[int, int]], offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first token, past last token, lead, trail) of each span.

    The tokens are those that share a character with the span; ``lead`` and ``trail`` are the
    characters of theirs before and behind it.
    """
    out = []
    for a, b in spans:
        lo = int(np.searchsorted(offsets[:, 1], a, "right"))
        hi = max(lo, int(np.searchsorted(offsets[:, 0], b, "left")))
        around = (max(0, a - int(offsets[lo, 0])), max(0, int(offsets[hi - 1, 1]) - b)) if lo < hi else (0, 0)
        out.append((lo, hi, *around))
    return out


def formatted(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """Formatted conversations, one row each.

    conv_id, n_turns, text, ids, and per assistant turn loss_first, loss_last (tokens) and
    loss_lead, loss_trail (characters of these tokens outside of the turn's text).  Turns are in
    order of turn (NULLs first), equal ones by role and text; NULL roles and
    texts are empty.  Rows without a conv_id make up one conversation.
    """
    def run(batches: Iterator[list]) -> Iterator[list[tuple]]:
        tok, key, turns = _tokenizer(tokenizer), None, []

        def flush() -> tuple:
            text, spans = render(turns)
            e = tok.encode(text, add_special_tokens=False)
            loss = align(spans, np.array(e.offsets, dtype=np.int64).reshape(-1, 2))
            return (key, len(turns), text, e.ids, *([x[k] for x in loss] for k in range(4)))

        for ids, roles, texts in batches:
            rows = []
            for conv, role, text in zip(ids, roles, texts):
                if turns and conv != key:
                    rows.append(flush())
                    turns = []
                key = conv
                turns.append((role or "", text or ""))
            yield rows
        if turns:
            yield [flush()]

    dealt = (conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
             .sortWithinPartitions("conv_id", "turn", "role", "text"))
    return map_rows(dealt.select("conv_id", "role", "text"), run,
                    "conv_id long, n_turns int, text string, ids array<int>, loss_first array<int>, "
                    "loss_last array<int>, loss_lead array<int>, loss_trail array<int>")


def masked_texts(ids: list[int], first: list[int], last: list[int], lead: list[int], trail: list[int],
                 pieces: list[bytes]) -> Iterator[str]:
    """The texts under a loss mask, read from the tokens alone."""
    for lo, hi, a, b in zip(first, last, lead, trail):
        covered = b"".join(pieces[i] for i in ids[lo:hi]).decode("utf-8")
        yield unescape(covered[a:len(covered) - b])


def conversation_digests(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """What formatted conversations say when they are read back from their ids.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.  The turns are
    parsed from the decoded ids, and the text under the loss mask is that of the masked tokens.
    """
    def run(batches: Iterator[list]) -> Iterator[list[tuple]]:
        pieces = token_bytes(tokenizer)
        for conversation in batches:
            rows = []
            for conv, ids, *mask in zip(*conversation):
                text = b"".join(pieces[i] for i in ids).decode("utf-8")
                said = parse(text)
                turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, body in said:
                    turns.update(f"{role}\n{body}\n".encode("utf-8"))
                for masked in masked_texts(ids, *mask, pieces):
                    chars += len(masked)
                    loss.update(masked.encode("utf-8"))
                rows.append((conv, len(said), turns.hexdigest(), chars, loss.hexdigest(), len(text)))
            yield rows

    return map_rows(conversations.select("conv_id", "ids", "loss_first", "loss_last", "loss_lead", "loss_trail"), run,
                    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                    "loss_sha256 string, formatted_chars long")

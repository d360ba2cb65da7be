"""Counts that describe a document: words, symbols, repeated words and lines.

One Arrow column function over whole texts; every count is exact (equal words and
lines are told by 64-bit hashes). Null and empty texts count as no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift.llm import texts as T

COUNTS = (
    "n_chars",
    "n_words",
    "word_chars",
    "n_symbols",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_distinct_words",
    "n_echo_words",
    "n_repeat_words",
    "n_lines",
    "n_dup_lines",
)


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(x) for x in characters]] = True
    return out


_SYMBOLS = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGITS = _table("0123456789")
_MARKS = _table("!?")
_POINT = (np.arange(256) & 0xC0) != 0x80


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Set flags in each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts keys, and where a new key begins in it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, np.append(True, ordered[1:] != ordered[:-1])


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Different keys of each owner; keys of different owners differ."""
    if not len(keys):
        return np.zeros(n, np.int64)
    order, new = _runs(keys)
    return np.bincount(owner[order[new]], minlength=n)


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """All counts, by name."""
    data, offsets = T.flat(texts)
    n = len(texts)
    starts, ends, first = T.words(data, offsets)
    inside = ~T.WHITE[data]
    points = _POINT[data]
    out = {
        "n_chars": _per_text(points, offsets),
        "n_words": np.diff(first),
        "word_chars": _per_text(points & inside, offsets),
        "n_symbols": _per_text(_SYMBOLS[data], offsets),
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_digits": _per_text(_DIGITS[data], offsets),
        "n_marks": _per_text(_MARKS[data], offsets),
    }
    seed = T.mix(np.arange(1, n + 1, dtype=np.uint64))
    rolling = T.Rolling(data)
    owner = np.repeat(np.arange(n), np.diff(first))
    word = rolling.of(starts, ends) + seed[owner] if len(starts) else np.empty(0, np.uint64)
    out["n_distinct_words"] = _distinct(word, owner, n)
    echo = np.zeros(len(word), bool)
    echo[1:] = word[1:] == word[:-1]
    out["n_echo_words"] = _per_text(echo, first)
    out["n_repeat_words"] = _per_text(_in_repeats(word, owner), first)
    edges = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1)))
    edges = edges[edges < len(data)]
    stops = np.append(edges[1:], len(data)) if len(edges) else edges
    trimmed = stops - (data[stops - 1] == 10) if len(edges) else stops
    holder = np.searchsorted(offsets, edges, "right") - 1
    used = np.searchsorted(starts, trimmed) > np.searchsorted(starts, edges)
    edges, trimmed, holder = edges[used], trimmed[used], holder[used]
    line = rolling.of(edges, trimmed) + seed[holder] if len(edges) else np.empty(0, np.uint64)
    out["n_lines"] = np.bincount(holder, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - _distinct(line, holder, n)
    return out


def _in_repeats(word: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Words that stand in a window of three words found twice or more in their text."""
    inside = np.zeros(len(word), bool)
    if len(word) < 3:
        return inside
    same = owner[2:] == owner[:-2]
    step = np.uint64(0x9E3779B97F4A7C15)
    three = T.mix((word[:-2] * step + word[1:-1]) * step + word[2:])
    place = np.flatnonzero(same)
    if not len(place):
        return inside
    order, new = _runs(three[place])
    many = np.diff(np.append(np.flatnonzero(new), len(order))) > 1
    place = place[order[many[np.cumsum(new) - 1]]]
    for k in range(3):
        inside[place + k] = True
    return inside


def describe(text: Column | str) -> Column:
    """A struct of all counts of a text column, each a long."""

    @F.arrow_udf(", ".join(f"{x} bigint" for x in COUNTS))
    def described(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from counted(parts)

    return described(text)


def counted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``describe`` for batches of texts; when they end, the worker gives back its free memory."""
    for texts in parts:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        found = [counts(x.column(0)) for x in T.slices(batch, "text")] or [counts(texts)]
        columns = [pa.array(np.concatenate([x[c] for x in found]).astype(np.int64)) for c in COUNTS]
        yield pa.StructArray.from_arrays(columns, list(COUNTS))
    T.give_back()


def shares(stats: str = "") -> dict[str, Column]:
    """Ratios of the counts, by name; all are 0 for a document without words."""
    at = f"{stats}." if stats else ""
    words = F.greatest(F.col(f"{at}n_words"), F.lit(1))
    chars = F.greatest(F.col(f"{at}word_chars"), F.lit(1))
    lines = F.greatest(F.col(f"{at}n_lines"), F.lit(1))
    return {
        "word_length": F.col(f"{at}word_chars") / words,
        "symbols_per_word": F.col(f"{at}n_symbols") / words,
        "upper_share": F.col(f"{at}n_upper") / chars,
        "digit_share": F.col(f"{at}n_digits") / chars,
        "marks_per_word": F.col(f"{at}n_marks") / words,
        "distinct_share": F.col(f"{at}n_distinct_words") / words,
        "echo_share": F.col(f"{at}n_echo_words") / words,
        "repeat_share": F.col(f"{at}n_repeat_words") / words,
        "dup_line_share": F.col(f"{at}n_dup_lines") / lines,
    }

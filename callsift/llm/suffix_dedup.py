"""Removes long passages that stand more than once, byte for byte.

A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere,
in the same text or another. Comparing every such window with every other would
need each text many times over, so windows are first dealt out by what they contain:

* The key of a window is the smallest hash of its 50-byte substrings. Equal windows
  have equal keys, and neighbouring windows mostly share theirs, so a text falls
  into runs of windows, about 75 in a run, that are described by three numbers:
  key, hash of all bytes of the run, number of windows.
* Runs that stand twice or more as a whole are found by counting those numbers; all
  their windows repeat. One copy of each is enough for what follows.
* Only runs whose key stands in different runs, or that repeat within themselves, are
  looked at byte by byte, grouped by key: a suffix array of their windows, extended
  with common-prefix lengths, is scanned with a stack. Each interval of suffixes with
  a common prefix of at least ``length`` bytes is a repeat, and it is maximal where
  its suffixes have different bytes on their left; such a group comes with all its
  occurrences. The occurrences give the windows that repeat.

A key whose runs are too many for one task (a frequent short line has other text
around it each time) is dealt out once more, by the hash of each window; windows of
one hash are equal, so counting them is exact for any number.

Null and empty texts keep what they have. Equal documents remove each other.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.llm import texts as T

LENGTH = 200
GRAM = 50
#: Different runs of one key that one task compares byte by byte.
GROUP_RUNS = 4_000
#: Suffixes of more bytes together are ordered by ranks, not by comparing them.
_SORT_BYTES = 1 << 22
_SLICE = 1 << 20
_STEP = 1 << 16


class Repeat(NamedTuple):
    """A maximal repeat: its length, and the range of the suffix array that begins with it.

    The range gives all occurrences without listing them, as the repeats of a
    periodic text have too many in all.
    """

    length: int
    first: int
    stop: int


class Suffixes(NamedTuple):
    """Suffixes in order: text and start of each, and its common prefix with the one before."""

    text: np.ndarray
    start: np.ndarray
    common: np.ndarray


def suffix_array(texts: list[bytes], text: np.ndarray, start: np.ndarray) -> Suffixes:
    """The enhanced suffix array of the suffixes that start at these places."""
    size = np.array([len(x) for x in texts], np.int64)
    if (size[text] - start).sum() <= _SORT_BYTES:
        keys = [texts[i][p:] for i, p in zip(text.tolist(), start.tolist(), strict=True)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    else:
        edge, rank = _ranks_of(texts, size)
        order = np.argsort(rank[edge[text] + start], kind="stable")
    text, start = text[order], start[order]
    common = np.zeros(len(order), np.int32)
    for at in range(1, len(order), _STEP):
        a, p = text[at - 1 : at + _STEP].tolist(), start[at - 1 : at + _STEP].tolist()
        found = [_common(texts[a[k]], p[k], texts[a[k + 1]], p[k + 1]) for k in range(len(a) - 1)]
        common[at : at + len(found)] = found
    return Suffixes(text, start, common)


def _ranks_of(texts: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins, and the order of all suffixes, by doubling the compared prefix."""
    edge = np.append(0, np.cumsum(size + 1))
    codes = np.zeros(edge[-1], np.int64)  # 0 ends a text
    for x, at in zip(texts, edge[:-1].tolist(), strict=True):
        codes[at : at + len(x)] = np.frombuffer(x, np.uint8).astype(np.int64) + 1
    left = np.repeat(edge[1:], np.diff(edge)) - np.arange(edge[-1])
    rank, step = np.unique(codes, return_inverse=True)[1], 1
    while step < size.max(initial=0) + 1:
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:] + 1
        after[left <= step] = 0
        found = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1]
        if found.max() == rank.max():
            break
        rank, step = found, step * 2
    return edge[:-1], rank


def _common(x: bytes, p: int, y: bytes, q: int) -> int:
    """Length of the common prefix of x[p:] and y[q:]."""
    most = min(len(x) - p, len(y) - q)
    if x[p : p + most] == y[q : q + most]:
        return most
    low, high = 0, most  # x[p:p+low] agrees, x[p:p+high] doesn't
    while high - low > 1:
        middle = (low + high) // 2
        if x[p + low : p + middle] == y[q + low : q + middle]:
            low = middle
        else:
            high = middle
    return low


def maximal_repeats(texts: list[bytes], suffixes: Suffixes, length: int) -> Iterator[Repeat]:
    """Maximal repeats of at least ``length`` bytes in a suffix array, inner ones first.

    Intervals of the array are closed from a stack when the common prefix falls below
    theirs. An interval is left-diverse if two of its suffixes follow different bytes,
    or one begins its text.
    """
    stack: list[tuple[int, int, set[int]]] = []  # prefix length, first suffix, left bytes
    n = len(suffixes.text)
    for block in range(0, n, _STEP):
        some = slice(block, block + _STEP)
        text, start = suffixes.text[some].tolist(), suffixes.start[some].tolist()
        following = [*suffixes.common[block + 1 : block + _STEP + 1].tolist(), 0]
        for k, (i, p) in enumerate(zip(text, start, strict=True), block):
            here = following[k - block]
            first, left = k, {texts[i][p - 1] if p else -1}
            while stack and stack[-1][0] > here:
                size, first, seen = stack.pop()
                seen |= left
                if len(seen) > 1 or -1 in seen:
                    yield Repeat(size, first, k + 1)
                left = seen
            if stack and stack[-1][0] == here:
                stack[-1][2].update(left)
            elif here >= length:
                stack.append((here, first, left))


def _beginnings(texts: list[bytes], group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The (text, start) at which a maximal repeat can begin, in order.

    These are windows that stand twice or more in their group of texts and that don't
    always follow the same window. Told by hashes, which never misses one; equality of
    the bytes is the suffix array's matter.
    """
    size = np.array([len(x) for x in texts], np.int64)
    edge = np.cumsum(size) - size
    n = size - length + 1
    owner = np.repeat(np.arange(len(texts)), n)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    value = T.Rolling(np.frombuffer(b"".join(texts), np.uint8)).every(length)[edge[owner] + start]
    value += T.mix(group.astype(np.uint64) + np.uint64(1))[owner]
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    count = np.diff(np.append(first, len(order)))
    kind = np.empty(len(order), np.int64)
    kind[order] = np.repeat(np.arange(len(first)), count)
    before = np.append(-1, kind[:-1])
    before[start == 0] = -1
    low = np.minimum.reduceat(before[order], first)
    high = np.maximum.reduceat(before[order], first)
    at = np.flatnonzero(((count > 1) & ((low != high) | (low < 0)))[kind])
    return owner[at], start[at]


def repeated_windows(groups: list[list[bytes]], length: int) -> list[list[list[tuple[int, int]]]]:
    """For each text of each group the ranges of windows that stand elsewhere in the group.

    Texts have ``length`` bytes at least.
    """
    group = np.repeat(np.arange(len(groups)), [len(x) for x in groups])
    text, start = _beginnings([x for some in groups for x in some], group, length)
    bounds = np.searchsorted(group[text], np.arange(len(groups) + 1))
    base = np.searchsorted(group, np.arange(len(groups)))
    return [
        _ranges(some, text[a:b] - first, start[a:b], length)
        for some, a, b, first in zip(groups, bounds[:-1].tolist(), bounds[1:].tolist(), base.tolist(), strict=True)
    ]


def _ranges(texts: list[bytes], text: np.ndarray, start: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """Ranges of windows that repeats cover; each suffix counts with its longest repeat."""
    if len(text) < 2:
        return [[] for _ in texts]
    suffixes = suffix_array(texts, text, start)
    covered = np.zeros(len(text), np.int64)
    skip = array("q", range(len(text) + 1))  # the next suffix from here without a repeat yet
    for size, first, stop in maximal_repeats(texts, suffixes, length):
        path, k = [], first
        while k < stop:
            if skip[k] == k:
                covered[k] = size
                skip[k] = k + 1
            path.append(k)
            k = skip[k]
        for x in path:
            skip[x] = k
    found = np.flatnonzero(covered)
    found = found[np.lexsort((suffixes.start[found], suffixes.text[found]))]
    who, a = suffixes.text[found], suffixes.start[found]
    b = a + covered[found] - length + 1
    shift = who * (max(map(len, texts)) + 1)  # ranges of different texts lie apart
    end = np.maximum.accumulate(b + shift)
    new = np.flatnonzero(np.append(True, (a + shift)[1:] > end[:-1])) if len(found) else found
    last = np.append(new[1:], len(found)) - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for i, p, q in zip(who[new].tolist(), a[new].tolist(), (end[last] - shift[last]).tolist(), strict=True):
        out[i].append((p, q))
    return out


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    blocks = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Runs(NamedTuple):
    """Runs of neighbouring windows with one key, in the bytes of a slice of texts."""

    text: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray
    content: np.ndarray
    repeats: np.ndarray


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Runs:
    """The runs of each text; ``start`` counts from the beginning of the text.

    ``repeats`` is true where the key's substring stands twice in a run, without
    which no two windows of the run are equal.
    """
    none = np.empty(0, np.int64)
    if len(data) < length:
        return Runs(none, none, none, none, none, none.astype(bool))
    rolling = T.Rolling(data)
    grams = rolling.every(gram)
    width = length - gram + 1
    keys = _window_min(grams, width)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(keys)]
    whole = np.zeros(len(keys) + 1, np.int8)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(whole, offsets[long], 1)
    np.add.at(whole, offsets[long + 1] - length + 1, -1)
    whole = np.cumsum(whole[:-1], dtype=np.int8).astype(bool)
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new & whole)
    # windows of a text that are whole come first, so a run ends before the next one or there
    stop = np.append(np.flatnonzero(new), len(keys))
    stop = stop[np.searchsorted(stop, first, "right")]
    stop = np.minimum(stop, offsets[owner[first] + 1] - length + 1)
    content = rolling.of(first, stop - 1 + length) ^ T.mix((stop - first).astype(np.uint64))
    return Runs(
        owner[first],
        first - offsets[owner[first]],
        stop - first,
        keys[first].view(np.int64),
        content.view(np.int64),
        np.isin(keys[first], _close_keys(grams, keys, whole, width)),
    )


def _close_keys(grams: np.ndarray, keys: np.ndarray, whole: np.ndarray, width: int) -> np.ndarray:
    """Keys that stand at two neighbouring places among those that are a window's key.

    Two equal windows of one run hold their key at two places, and no other key
    stands between them.
    """
    none = np.uint64(np.iinfo(np.uint64).max)
    shown = np.full(len(grams) + width - 1, none)
    shown[width - 1 : width - 1 + len(keys)] = np.where(whole, ~keys, none)
    at = np.flatnonzero(grams == ~_window_min(shown, width))  # largest key of the windows that hold a place
    here = grams[at]
    return np.unique(here[1:][here[1:] == here[:-1]])


_RUN = "text_hash bigint, start int, windows int, key bigint, content bigint, repeats boolean"


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text_hash, text): what tells rows apart; equal rows are treated alike."""
    words = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("id"), F.xxhash64(words).alias("text_hash"), words.alias("text"))


def find_runs(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The runs of all texts of (id, text_hash, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in T.slices(batch, "text", _SLICE):
                found = runs(*T.flat(some.column("text")), length, gram)
                at = pa.array(found.text)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("id").take(at),
                        some.column("text_hash").take(at),
                        pa.array(found.start.astype(np.int32)),
                        pa.array(found.windows.astype(np.int32)),
                        pa.array(found.key),
                        pa.array(found.content),
                        pa.array(found.repeats),
                    ],
                    ["id", "text_hash", "start", "windows", "key", "content", "repeats"],
                )

    return rows.mapInArrow(lambda b: T.giving_back(find(b)), f"id {dict(rows.dtypes)['id']}, {_RUN}")


def _compare(length: int):
    """Ranges of repeated windows of each run; input in order of keys."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
        key, contents, texts = None, [], []
        for batch in batches:
            for k, c, x in zip(*(batch.column(n).to_pylist() for n in ("key", "content", "bytes")), strict=True):
                if k != key:
                    if contents:
                        yield key, contents, texts
                    key, contents, texts = k, [], []
                contents.append(c)
                texts.append(x)
        if contents:
            yield key, contents, texts

    def compared(held: list[tuple[int, list[int], list[bytes]]]) -> pa.RecordBatch:
        keys, contents, spans = [], [], []
        for (key, names, _), found in zip(held, repeated_windows([x for _, _, x in held], length), strict=True):
            for name, ranges in zip(names, found, strict=True):
                if ranges:
                    keys.append(key)
                    contents.append(name)
                    spans.append([{"first": a, "stop": b} for a, b in ranges])
        kind = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(contents, pa.int64()), pa.array(spans, kind)], ["key", "content", "spans"]
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in groups(batches):
            held.append(group)
            size += sum(map(len, group[2]))
            if size >= _SLICE:
                yield compared(held)
                held, size = [], 0
        if held:
            yield compared(held)

    return compare


def _dealt_by_window(large: DataFrame, length: int) -> DataFrame:
    """Spans of runs whose key has too many, from counts of equal windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in T.slices(batch, "bytes", 1 << 16):
                data, offsets = T.flat(some.column("bytes"))
                n = np.diff(offsets) - length + 1
                at = np.repeat(np.arange(len(n)), n)
                first = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                value = T.Rolling(data).every(length)[offsets[at] + first]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("key").take(pa.array(at)),
                        some.column("content").take(pa.array(at)),
                        pa.array(first.astype(np.int32)),
                        pa.array(value.view(np.int64)),
                    ],
                    ["key", "content", "first", "value"],
                )

    every = large.select("key", "content", "bytes").mapInArrow(lambda b: T.giving_back(windows(b)), "key bigint, content bigint, first int, value bigint")
    twice = every.groupBy("key", "value").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    span = F.struct(F.col("first"), (F.col("first") + 1).alias("stop"))
    return every.join(twice, ["key", "value"]).groupBy("key", "content").agg(F.collect_list(span).alias("spans"))


def repeated_spans(docs: DataFrame, key: str, text: str, save, length: int = LENGTH, gram: int = GRAM, most: int = GROUP_RUNS) -> DataFrame:
    """(id, text_hash, spans): byte ranges of each text that stand elsewhere too.

    ``save(df, name)`` writes a table that is read several times and returns it.
    Ranges are (first, stop), may overlap, and are as many as a text has runs.
    """
    rows = _identified(docs, key, text)
    found = find_runs(rows, length, gram)
    keys = found.groupBy("key").agg(F.count("*").alias("n"), F.max("repeats").alias("r")).where("n > 1 or r").select("key")
    shared = save(found.join(keys, "key"), "shared-runs")
    kinds = shared.groupBy("key", "content").agg(
        F.count("*").alias("n"),
        F.first("id").alias("id"),
        F.first("text_hash").alias("text_hash"),
        F.first("start").alias("start"),
        F.first("windows").alias("windows"),
        F.max("repeats").alias("repeats"),
    )
    kinds = save(kinds, "run-kinds")
    whole = kinds.where("n > 1").select(
        "key", "content", F.array(F.struct(F.lit(0).alias("first"), F.col("windows").alias("stop"))).alias("spans")
    )
    per_key = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.max("repeats").alias("r"), F.min("n").alias("least"))
    looked = per_key.where("least = 1 and (kinds > 1 or r)").select("key", "kinds")
    named = kinds.join(looked, "key").select("key", "content", "kinds", "id", "text_hash", "start", "windows")
    cut = F.expr(f"substring(encode(text, 'UTF-8'), start + 1, windows + {length - 1})")
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    compared = save(
        rows.alias("a").join(named.alias("b"), same).select("key", "content", "kinds", cut.alias("bytes")), "run-bytes"
    )
    small = compared.where(F.col("kinds") <= most).repartition("key").sortWithinPartitions("key")
    schema = "key bigint, content bigint, spans array<struct<first:int,stop:int>>"
    by_bytes = small.select("key", "content", "bytes").mapInArrow(lambda b, compare=_compare(length): T.giving_back(compare(b)), schema)
    by_hash = _dealt_by_window(compared.where(F.col("kinds") > most), length)
    partly = by_bytes.unionByName(by_hash).join(whole.select("key", "content"), ["key", "content"], "left_anti")
    marks = whole.unionByName(partly)
    ranges = F.transform(
        "spans",
        lambda x: F.struct(
            (F.col("start") + x["first"]).alias("first"), (F.col("start") + x["stop"] + F.lit(length - 1)).alias("stop")
        ),
    )
    placed = shared.join(marks, ["key", "content"]).select("id", "text_hash", F.explode(ranges).alias("span"))
    return placed.groupBy("id", "text_hash").agg(F.collect_list("span").alias("spans"))


def remove_repeats(docs: DataFrame, key: str, text: str, save, length: int = LENGTH, gram: int = GRAM, most: int = GROUP_RUNS) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes) and ``removed`` (ranges of bytes that went).

    A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
    else, as the input stands. A null text is empty. Rows that repeat an id and text
    are different places, so they remove each other. Columns called ``kept`` or
    ``removed`` are replaced.
    """
    spans = repeated_spans(docs, key, text, save, length, gram, most)
    names = [c for c in docs.columns if c.lower() not in ("kept", "removed")]
    words = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    held = docs.select(*[F.col(f"`{c}`") for c in names], F.xxhash64(words).alias("_hash"))
    joined_ = held.alias("a").join(
        spans.alias("b"),
        F.col(f"a.`{key}`").eqNullSafe(F.col("b.id")) & (F.col("a._hash") == F.col("b.text_hash")),
        "left",
    )

    @F.arrow_udf("kept binary, removed array<struct<first:int,stop:int>>")
    def cut(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))
        for texts, ranges in parts:
            kept, removed = [], []
            for x, some in zip(texts.cast(pa.large_binary()).to_pylist(), ranges.to_pylist(), strict=True):
                gone = joined([(r["first"], r["stop"]) for r in some or ()])
                edges = [0, *[e for r in gone for e in r], len(x)]
                kept.append(b"".join(x[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append([{"first": a, "stop": b} for a, b in gone])
            yield pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(removed, kind)], ["kept", "removed"])
        T.give_back()

    out = joined_.select(*[F.col(f"a.`{c}`") for c in names], cut(F.coalesce(F.col(f"a.`{text}`"), F.lit("")), F.col("b.spans")).alias("_cut"))
    return out.select(*[F.col(f"`{c}`") for c in names], "_cut.kept", "_cut.removed")


def as_text(kept: Column | str) -> Column:
    """Bytes as text; characters that a cut has left incomplete are dropped, null is empty."""

    @F.arrow_udf("string")
    def decoded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in parts:
            yield pa.array([(x or b"").decode("utf-8", "ignore") for x in some.to_pylist()], pa.string())
        T.give_back()

    return decoded(kept)

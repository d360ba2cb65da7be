"""Records of JSON arrays, read by many tasks.

A file that is one array cannot be cut at line ends. Here Spark's text reader cuts it
behind closing braces, wherever these stand. Whether a split begins within a string, and
how deep, follows from all splits before it: the first pass gives, for either start, by how
much a split changes the depth and whether it turns "inside a string" round; these
are composed in file order. The second pass then knows each split's start and cuts the
records of its array. A record that reaches over splits comes out in pieces, at most
two a split, which are put together.

Elements that are no objects are passed over. Whatever follows the end of the array is ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callsift.sources.shared_dir import written
from callsift.sources.splits import before, read_pieces, scanned, summaries, with_states

_QUOTE, _BACKSLASH = b'"\\'
_OPEN, _CLOSE = b"{}"
_BRACE, _NOTHING = (pa.scalar(x, pa.large_binary()) for x in (b"}", b""))


def _bytes(values: pa.Array) -> np.ndarray:
    """Fragments with the brace that the reader has cut away."""
    whole = pc.binary_join_element_wise(values.cast(pa.large_binary()), _BRACE, _NOTHING)
    if not len(whole):
        return np.empty(0, np.uint8)
    ends = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, whole.offset * 8)
    return np.frombuffer(whole.buffers()[2], np.uint8)[ends[0] : ends[-1]]


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets, their steps in depth, quotes before each, and quotes in all."""
    quote = data == _QUOTE
    slash = data == _BACKSLASH
    if slash.any():
        plain = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        at = np.flatnonzero(quote)
        at = at[at > 0]
        # An odd number of backslashes right before it makes a quote part of the string.
        quote[at[(at - 1 - plain[at - 1]) % 2 == 1]] = False
    quotes = np.flatnonzero(quote)
    opens = (data == _OPEN) | (data == ord("["))
    place = np.flatnonzero(opens | (data == _CLOSE) | (data == ord("]")))
    return place, np.where(opens[place], 1, -1), np.searchsorted(quotes, place), len(quotes)


def _change(state: dict, parts: Iterator[pa.Array]) -> Iterator[pa.RecordBatch]:
    """What a split does to the depth if it begins outside or inside a string."""
    depth, turned = [0, 0], 0
    for part in parts:
        _, step, quotes, n = _marks(_bytes(part))
        inside = (quotes + turned) % 2
        for start in (0, 1):
            depth[start] += int(step[inside == start].sum())
        turned = (turned + n) % 2
    values = [[state["source"]], [state["chunk"]], [depth[0]], [depth[1]], [turned]]
    yield pa.RecordBatch.from_pydict(dict(zip(["source", "chunk", "outside", "inside", "turned"], values, strict=True)))


def _cut(whole: bool):
    """Records that lie within a split, or the pieces of the others."""

    def cut(state: dict, parts: Iterator[pa.Array]) -> Iterator[pa.RecordBatch]:
        inside, depth = state["starts_inside"], state["starts_at"]
        # Bytes of the record that is open; a split may begin within one.
        held: list[bytes] = [b""] if depth > 1 else []
        opened, nth = False, 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
            n = len(rows)
            values = [pa.array([state["source"]] * n, pa.string()), pa.array([state["chunk"]] * n, pa.int64())]
            values += [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]
            values[-1] = values[-1].cast(pa.string())
            return pa.RecordBatch.from_arrays(values, ["source", "chunk", "nth", "opens", "closes", "text"])

        for part in parts:
            data = _bytes(part)
            place, step, quotes, n = _marks(data)
            outside = (quotes + inside) % 2 == 0
            depths = depth + np.cumsum(np.where(outside, step, 0))
            mark = data[place]
            starts = place[outside & (mark == _OPEN) & (depths == 2)]
            ends = place[outside & (mark == _CLOSE) & (depths == 1)] + 1
            rows, at = [], 0
            for end in ends.tolist():
                if not held:
                    at = int(starts[np.searchsorted(starts, at)])
                    opened = True
                if opened == whole:
                    rows.append((nth, opened, True, b"".join([*held, data[at:end].tobytes()])))
                held, opened, at, nth = [], False, end, nth + 1
            later = starts[np.searchsorted(starts, at) :]
            if held or len(later):
                opened = opened or not held
                held.append(data[at if held else int(later[0]) :].tobytes())
            if len(place):
                depth = int(depths[-1])
            inside = (inside + n) % 2
            yield batch(rows)
        # At the end of the array the brace that was added closes nothing.
        if held and not whole:
            yield batch([(nth, opened, False, b"".join(held))])

    return cut


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """(source, chunk, nth, text): the objects of JSON arrays; the first three are their order."""
    pieces = read_pieces(spark, path, "}")
    changes = summaries(pieces, _change, "outside bigint, inside bigint, turned bigint", "array-splits")
    inside = (before(F.col("turned"), ["source"]) % 2).cast("int")
    begun = changes.withColumn("starts_inside", inside)
    depth = F.when(F.col("starts_inside") == 0, F.col("outside")).otherwise(F.col("inside"))
    states = begun.select("*", before(depth, ["source"]).alias("starts_at"))
    states = written(states.select("source", "chunk", "starts_inside", "starts_at"), "array-states")
    schema = "source string, chunk bigint, nth bigint, opens boolean, closes boolean, text string"
    known = with_states(pieces, states)
    records = scanned(known, _cut(True), schema).select("source", "chunk", "nth", "text")
    parts = written(scanned(known, _cut(False), schema), "array-pieces")
    order = Window.partitionBy("source").orderBy("chunk", "nth")
    # At most two rows a split.
    record = F.sum(F.col("opens").cast("int")).over(order)
    ids = parts.select("source", "chunk", "nth", record.alias("record"))
    piece = F.struct("chunk", "nth", "text")
    joined = (
        parts.join(ids, ["source", "chunk", "nth"])
        .groupBy("source", "record")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("closes").alias("closes"))
        .where("closes")
    )
    texts = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    whole = joined.select("source", F.col("pieces")[0]["chunk"].alias("chunk"), F.col("pieces")[0]["nth"].alias("nth"), texts.alias("text"))
    return records.unionByName(whole)

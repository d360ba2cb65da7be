"""Text files read where they stand, split by split, in two passes.

What a line or a fragment means may depend on all that stands before it in its file. The
first pass reduces each file split to one small row; these rows are composed in file order
(``summaries``). The second pass reads the splits again, each with what it must know
(``with_states``), and no line is shuffled or sorted.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.operators.scan import BROADCAST_ROWS
from callsift.sources.shared_dir import written

#: What comes of the runs of values of one split: batches of further columns.
Scan = Callable[[dict, Iterator[pa.Array]], Iterator[pa.RecordBatch]]
_SPLIT = ["source", "chunk"]


def read_pieces(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """(source, chunk, place, value): texts between separators; lines where none is given.

    ``chunk`` is the byte offset of the split in its file; within a split rows keep their order.
    """
    options = {"lineSep": separator} if separator else {}
    return spark.read.text(path, **options).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def scanned(pieces: DataFrame, scan: Scan, schema: str) -> DataFrame:
    """``scan`` over each split: its known columns, then its values batch by batch."""
    known = [c for c in pieces.columns if c not in ("place", "value")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = _runs(batches, known)
        split = next(rest, None)
        while split is not None:
            state, first = split
            after = []

            def values(state=state, first=first, after=after) -> Iterator[pa.Array]:
                yield first
                for other, part in rest:
                    if any(other[c] != state[c] for c in _SPLIT):
                        after.append((other, part))
                        return
                    yield part

            left = values()
            yield from scan(state, left)
            for _ in left:  # what the scan has not asked for
                pass
            split = after[0] if after else None

    return pieces.select(*known, "value").mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], known: list[str]) -> Iterator[tuple[dict, pa.Array]]:
    """Parts of batches that belong to one split, with the split's columns."""
    for batch in batches:
        start, n = 0, batch.num_rows
        while start < n:
            state = {c: batch.column(k)[start].as_py() for k, c in enumerate(known)}
            stop = _same(batch, start, [known.index(c) for c in _SPLIT])
            yield state, batch.column(len(known)).slice(start, stop - start)
            start = stop


def _same(batch: pa.RecordBatch, start: int, columns: list[int]) -> int:
    """Where the run of rows alike in some columns ends; splits lie one after another."""
    wanted = [batch.column(k)[start] for k in columns]
    low, high = start, batch.num_rows
    while high - low > 1:
        middle = (low + high) // 2
        if all(batch.column(k)[middle] == x for k, x in zip(columns, wanted, strict=True)):
            low = middle
        else:
            high = middle
    return high


def summaries(pieces: DataFrame, scan: Scan, schema: str, name: str) -> DataFrame:
    """One row a split, written: the first pass."""
    return written(scanned(pieces, scan, f"source string, chunk bigint, {schema}"), name)


def with_states(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces with what their split must know.

    As many states as there are splits; they are broadcast where they were counted to
    be few. Beyond, rows are brought to their state and put in order again.
    """
    if states.count() <= BROADCAST_ROWS:
        return pieces.join(F.broadcast(states), _SPLIT)
    joined = pieces.join(states, _SPLIT).repartition(*_SPLIT)
    return joined.sortWithinPartitions(*_SPLIT, "place")


def before(value: Column, by: list[str]) -> Column:
    """Sum of a value over all earlier splits, 0 for the first."""
    from pyspark.sql import Window

    window = Window.partitionBy(*by).orderBy(*_SPLIT)
    return F.coalesce(
        F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )

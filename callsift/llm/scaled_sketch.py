"""Document fingerprints: threshold-scaled sketches of shingle hashes.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Sketches
of the same fraction can be merged, and intersections estimate likeness and
containment without bias even when one document is a thousand times longer than the
other, as the kept share is the same for both. A document with shingles of which
none falls below the threshold keeps its smallest hash, so only documents without
words have an empty sketch.

Only DataFrame functions are used. Null and empty texts, and texts without words,
have an empty sketch; two empty sketches are alike (1), an empty and another one are
not (0). A text of fewer than five words is one shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FRACTION = 1 / 8
WIDTH = 5
#: Consecutive ids that one window holds at most.
CELL = 256
_FAN = 1024


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all shingles of ``width`` words; ASCII letters count as lower case."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    none = F.array().cast("array<bigint>")

    def shingles(hashes: Column) -> Column:
        n = F.size(hashes)
        every = F.transform(
            F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])
        )
        return F.when(n >= width, every).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(none)

    hashed = F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w))
    return _let(hashed, shingles)


def _threshold(fraction: float) -> int:
    return min(int(fraction * 2**64) - 2**63, 2**63 - 1)


def sketch(text: Column, fraction: float = FRACTION, width: int = WIDTH) -> Column:
    """The sorted distinct hashes that a text keeps."""
    return _let(shingle_hashes(text, width), lambda h: _kept(h, fraction))


def _kept(hashes: Column, fraction: float) -> Column:
    low = F.filter(hashes, lambda x: x < F.lit(_threshold(fraction)))
    least = F.filter(F.array(F.array_min(hashes)), lambda x: x.isNotNull())
    return _let(low, lambda x: F.when(F.size(x) > 0, F.array_sort(F.array_distinct(x))).otherwise(least))


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two documents together, from theirs."""
    return _let(F.array_union(a, b), lambda h: _kept(h, fraction))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two documents."""
    both = F.size(F.array_intersect(a, b))
    return _let(
        both, lambda n: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(n / (F.size(a) + F.size(b) - n))
    ).cast("double")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a)).cast("double")


def fingerprint(kept: Column) -> Column:
    """A sketch as text."""
    return F.array_join(F.transform(kept, lambda x: F.lower(F.hex(x))), ".")


def _next_cells(cells: DataFrame, span: int) -> DataFrame:
    """(cell, next): the following cell that exists; the last one is followed by the first.

    ``cells`` has distinct values in ``cell``, over a range of ``span`` numbers. A
    window holds ``_FAN`` neighbouring numbers at most; what lies beyond is found
    among groups of that size, in the same way.
    """
    if span <= _FAN:
        order = Window.partitionBy(F.lit(0)).orderBy("cell")
        whole = Window.partitionBy(F.lit(0))
        return cells.select("cell", F.coalesce(F.lead("cell").over(order), F.min("cell").over(whole)).alias("next"))
    wide = cells.withColumn("wide", F.floor(F.col("cell") / _FAN).cast("bigint"))
    inner = wide.withColumn("inner", F.lead("cell").over(Window.partitionBy("wide").orderBy("cell")))
    firsts = wide.groupBy("wide").agg(F.min("cell").alias("first"))
    after = _next_cells(firsts.select(F.col("wide").alias("cell")), span // _FAN + 2)
    begin = after.join(firsts.withColumnRenamed("wide", "next"), "next").select(F.col("cell").alias("wide"), "first")
    return inner.join(begin, "wide").select("cell", F.coalesce("inner", "first").alias("next"))


def with_next(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``df`` with ``next_<column>``: the values of the row that follows by an integer key.

    The last row is followed by the first; a single row by itself. A null key stands
    before all others. Rows that share a key follow one another by a hash of the
    columns. Rows cross the network once, by ranges of ``CELL`` ids; a range whose
    ids repeat holds as many rows as they have.
    """
    bounds = df.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    low = bounds["low"] if bounds["low"] is not None else 0
    high = bounds["high"] if bounds["high"] is not None else 0
    place = F.coalesce(F.col(key), F.lit(low - 1))
    cell = F.floor(place / CELL).cast("bigint") if high < 2**52 and low > -(2**52) else F.shiftright(place, 8)
    held = df.withColumn("_cell", cell).withColumn("_place", place)
    order = Window.partitionBy("_cell").orderBy("_place", F.xxhash64(*columns))
    rows = held.withColumn("_rank", F.row_number().over(order))
    for c in columns:
        rows = rows.withColumn(f"_lead_{c}", F.lead(c).over(order))
    rows = rows.withColumn("_more", F.lead(F.lit(True)).over(order))
    cells = held.select(F.col("_cell").alias("cell")).distinct()
    after = _next_cells(cells, (high - low) // CELL + 3)
    firsts = rows.where("_rank = 1").select(F.col("_cell").alias("next"), *[F.col(c).alias(f"_first_{c}") for c in columns])
    begin = after.join(firsts, "next").drop("next").withColumnRenamed("cell", "_cell")
    joined = rows.join(begin, "_cell")
    found = [
        F.when(F.col("_more"), F.col(f"_lead_{c}")).otherwise(F.col(f"_first_{c}")).alias(f"next_{c}") for c in columns
    ]
    return joined.select(*df.columns, *found)


def half_replaced(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as much from the beginning of another."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(following, F.lit(1), half))

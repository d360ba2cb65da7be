"""Running sums over ordered groups, also when one group holds most rows.

A window keeps a whole group in one task. Groups that count up to ``TARGET_ROWS``
rows are left to plain windows. Larger groups are cut into ranges of their whole
order; each range is summed on its own, and the sums of earlier ranges are added
from a small table. Results are the same either way.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.sources.shared_dir import checkpoint_root

TARGET_ROWS = 2_000_000
BROADCAST_ROWS = 100_000
_CHUNK = "_chunk"
_ORDER = "_order_key_{}"
_QUANTILES = 256


def join_checked(
    left: DataFrame, right: DataFrame, keys: list[str], rows: int, how: str = "left"
) -> DataFrame:
    """Join with ``right`` broadcast only if its counted ``rows`` stay small.

    Beyond the bound the join is an ordinary shuffle join, which adaptive
    execution splits where a key is skewed.
    """
    if rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return left.join(right, keys, how)


def _join_cells(left: DataFrame, cells: DataFrame, by: list[str], rows: int, how: str = "left") -> DataFrame:
    """``join_checked`` where a null key is a group of its own."""
    names = {c: f"_cell_{i}" for i, c in enumerate(by)}
    right = cells.withColumnsRenamed(names)
    if rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    same = reduce(Column.__and__, [left[c].eqNullSafe(right[n]) for c, n in names.items()])
    return left.join(right, same, how).drop(*names.values())


@dataclass(frozen=True)
class OrderedGroups:
    """Rows of ``df`` in groups of ``keys``, ordered by ``order`` inside each.

    ``order_keys`` names the helper columns that a group was cut by.
    """

    df: DataFrame
    keys: list[str]
    order: list[Column]
    order_keys: list[str]
    chunks: int = 0

    def running(self, **sums: Column) -> OrderedGroups:
        """Add one column per entry: its sum over all rows up to this one."""
        by = [*self.keys, _CHUNK] if self.chunks else self.keys
        frame = (
            Window.partitionBy(*by)
            .orderBy(*self.order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        local = self.df.select(
            "*", *[F.sum(c).over(frame).alias(n) for n, c in sums.items()]
        )
        if self.chunks:
            # Kept, as both the totals and the rows are read from it.
            local = self._add_earlier_chunks(local.checkpoint(), sums)
        return replace(self, df=local)

    def where(self, condition: Column) -> OrderedGroups:
        return replace(self, df=self.df.where(condition))

    def with_columns(self, **columns: Column) -> OrderedGroups:
        return replace(self, df=self.df.withColumns(columns))

    def rows(self) -> DataFrame:
        return self.df.drop(_CHUNK, *self.order_keys)

    def _add_earlier_chunks(
        self, local: DataFrame, sums: dict[str, Column]
    ) -> DataFrame:
        by = [*self.keys, _CHUNK]
        totals = (
            local.where(F.col(_CHUNK) > 0)
            .groupBy(*by)
            .agg(*[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()])
        )
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy(_CHUNK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        offsets = totals.select(
            *by, *[F.sum(f"_total_{n}").over(earlier).alias(f"_before_{n}") for n in sums]
        )
        joined = _join_cells(local, offsets, by, self.chunks)
        kept = [c for c in local.columns if c not in sums]
        return joined.select(
            *kept,
            *[
                (F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0))).alias(n)
                for n in sums
            ],
        )


def ordered_groups(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    order_keys: list[Column],
    target_rows: int | None = None,
    count: bool = True,
) -> OrderedGroups:
    """Groups ready for running sums.

    ``order_keys`` are whole numbers that order the rows as ``order`` does; where
    one is null its row comes last. One counting pass over ``keys`` finds the large
    groups; without any, the plan is a plain window. Large groups are cut at
    quantiles of the first key in which their rows differ. The rows at a quantile
    are a cell of their own, so a burst at one instant is left alone with itself
    and cut by the next key, however far the others are spread. Cells are cut until
    none is large. Rows alike in every key are cut anywhere, as they may stand in any
    order. Groups known to be short need no ``count``.
    """
    target = target_rows or TARGET_ROWS
    names = [_ORDER.format(i) for i in range(len(order_keys))]
    keyed = df.withColumns(
        {n: k.cast("long") for n, k in zip(names, order_keys, strict=True)}
        | {_CHUNK: F.lit(0).cast("long")}
    )
    chunks = 0
    if count and _has_large(keyed, [*keys, _CHUNK], target):
        checkpoint_root(df.sparkSession)
        # Rows that tie in every key may follow one another in any order: their place in
        # the stored table cuts them too.
        place = _ORDER.format(len(names))
        keyed = keyed.withColumn(place, F.monotonically_increasing_id()).checkpoint()
        names = [*names, place]
        first = True
        while True:
            # Kept in the shared folder, so that later passes do not count again.
            cells = _cells(keyed, keys, names, target, first).checkpoint()
            found = cells.agg(F.count("*"), F.count_if("_large")).first()
            if not found[1]:
                break
            cells = _with_cuts(keyed, keys, names, cells, found[1]).checkpoint()
            keyed = _split(keyed, keys, names, cells, found[0])
            chunks = cells.agg(F.sum("_pieces")).first()[0]
            first = False
    return OrderedGroups(keyed, keys, order, names, chunks)


def _has_large(df: DataFrame, by: list[str], target: int) -> bool:
    sizes = df.groupBy(*by).agg(F.count("*").alias("_rows"))
    return (sizes.agg(F.max("_rows")).first()[0] or 0) > target


def _cells(
    df: DataFrame, keys: list[str], names: list[str], target: int, first: bool
) -> DataFrame:
    """Cells of cut groups: whether over ``target`` rows, the key to cut by, how often."""
    rows = df if first else df.where(F.col(_CHUNK) > 0)
    ranges = [
        F.struct(
            F.lit(i).alias("_key"),
            F.min(n).alias("_low"),
            F.max(n).alias("_high"),
            F.count(n).alias("_given"),
        )
        for i, n in enumerate(names)
    ]
    sizes = rows.groupBy(*keys, _CHUNK).agg(
        F.count("*").alias("_rows"), F.array(*ranges).alias("_ranges")
    )
    differs = F.filter(
        "_ranges",
        lambda r: (r["_high"] > r["_low"])
        | ((r["_given"] > 0) & (r["_given"] < F.col("_rows"))),
    )
    large = F.col("_rows") > target
    return (sizes.where(large) if first else sizes).select(
        *keys,
        _CHUNK,
        large.alias("_large"),
        F.when(large, F.get(differs, F.lit(0))["_key"]).alias("_key"),
        F.ceil(F.col("_rows") / F.lit(target // 2 or 1)).alias("_spread"),
    )


def _key_value(names: list[str]) -> Column:
    return F.get(F.array(*names), F.col("_key"))


def _with_cuts(
    df: DataFrame, keys: list[str], names: list[str], cells: DataFrame, large: int
) -> DataFrame:
    """``cells`` with the values to cut at, the number of pieces and the first one's chunk.

    The values are approximate quantiles, but each stands in some row. Pieces are the
    rows before a value, those at it and so on, and last the rows without the key.
    """
    by = [*keys, _CHUNK]
    cut = cells.where("_large").select(*by, "_key", "_spread")
    shares = [i / _QUANTILES for i in range(1, _QUANTILES)]
    quantiles = (
        _join_cells(df, cut, by, large, "inner")
        .select(*by, "_spread", _key_value(names).alias("_value"))
        .groupBy(*by)
        .agg(
            F.percentile_approx("_value", shares, 10_000).alias("_quantiles"),
            F.first("_spread").alias("_n"),
        )
    )
    step = F.greatest(F.lit(1), F.floor(F.lit(_QUANTILES) / F.col("_n")))
    some = F.filter("_quantiles", lambda _, i: (i + 1) % step == 0)
    cuts = quantiles.select(*by, F.array_sort(F.array_distinct(some)).alias("_cuts"))
    pieces = F.when(F.col("_key").isNull(), 1).otherwise(2 * F.size("_cuts") + 2)
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(_CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        _join_cells(cells, cuts, by, large)
        .select(*by, "_key", "_cuts", pieces.cast("long").alias("_pieces"))
        .withColumn("_base", 1 + F.coalesce(F.sum("_pieces").over(earlier), F.lit(0)))
    )


def _split(
    df: DataFrame, keys: list[str], names: list[str], cells: DataFrame, count: int
) -> DataFrame:
    """Rows with the chunk of their piece; chunks of a group are numbered from 1 anew."""
    joined = _join_cells(df, cells, [*keys, _CHUNK], count).withColumn(
        "_value", _key_value(names)
    )
    value = F.col("_value")
    # The number of cuts before the value, by bisection.
    strides = [_QUANTILES >> i for i in range(1, _QUANTILES.bit_length())]
    before = F.aggregate(
        F.array(*[F.lit(s) for s in strides]),
        F.lit(0),
        lambda at, s: F.when(F.get("_cuts", at + s - 1) < value, at + s).otherwise(at),
    )
    at_cut = F.coalesce(F.get("_cuts", before) == value, F.lit(False)).cast("int")
    piece = (
        F.when(F.col("_key").isNull(), 0)
        .when(value.isNull(), F.col("_pieces") - 1)
        .otherwise(2 * before + at_cut)
    )
    chunk = F.when(F.col("_base").isNull(), 0).otherwise(F.col("_base") + piece)
    return joined.select(
        *[c for c in df.columns if c != _CHUNK], chunk.cast("long").alias(_CHUNK)
    )

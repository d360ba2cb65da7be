"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows fall into cells by a hash of their id. A matrix of exact counts says how many
rows of each cell go to each shard: drawn from the multivariate hypergeometric
distribution, as in dealing cards without replacement, so shard sizes are exact and
every assignment is equally likely. Each cell is permuted by itself and cut by its
row of the matrix; after the exchange each shard is permuted again.

All random values are hashes of the row and a seed, so a task that runs again
repeats its result. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a cell or of a part of a shard that one window sorts, about.
CELL_ROWS = 50_000
#: The window of values that a draw can take reaches so many deviations around its mode.
_REACH = 12


def _uniform(seed: int, *parts: Column) -> Column:
    """A number from 0 to below 1, from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11) * F.lit(2.0**-53)


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """Marked items among ``drawn`` ones of ``total``, ``marked`` of which are marked.

    The exact distribution by inversion of a uniform ``u``: weights follow from
    ratios, starting at the mode, upwards and then downwards, until they vanish in
    double precision.
    """
    n = {"total": total, "marked": marked, "drawn": drawn}
    given = F.struct(*[x.cast("double").alias(k) for k, x in n.items()], u.alias("u"))
    return _let(given, _with_mode)


def _with_mode(g: Column) -> Column:
    least = F.greatest(F.lit(0.0), g["drawn"] + g["marked"] - g["total"])
    most = F.least(g["drawn"], g["marked"])
    mode = F.floor((g["drawn"] + 1) * (g["marked"] + 1) / (g["total"] + 2)).cast("double")
    mode = F.least(most, F.greatest(least, mode))
    reach = F.ceil(F.sqrt(g["drawn"] * g["marked"] / F.greatest(g["total"], F.lit(1.0))) * _REACH + 40)
    fixed = F.struct(
        *[g[x].alias(x) for x in ("total", "marked", "drawn", "u")],
        mode.alias("mode"),
        F.least(most - mode, reach).cast("int").alias("up"),
        F.least(mode - least, reach).cast("int").alias("down"),
    )
    return _let(fixed, lambda c: _let(c["u"] * _walk(c, F.lit(-1.0))["sum"], lambda t: _found(c, _walk(c, t))))


def _found(c: Column, state: Column) -> Column:
    return _let(state["found"], lambda x: F.when(x < 0, c["mode"]).otherwise(x).cast("bigint"))


def _walk(c: Column, target: Column) -> Column:
    """Sums weights from the mode outwards; ``found`` is where the sum passes the target."""

    def ratio(x: Column) -> Column:
        """Weight of x + 1 by weight of x."""
        rest = c["total"] - c["marked"] - c["drawn"]
        return (c["marked"] - x) * (c["drawn"] - x) / ((x + 1) * (rest + x + 1))

    def step(state: Column, x: Column, weight: Column) -> Column:
        passes = (state["found"] < 0) & (target >= 0) & (state["sum"] + weight > target)
        return F.struct(
            weight.alias("weight"),
            (state["sum"] + weight).alias("sum"),
            F.when(passes, x).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"), F.lit(-1.0).alias("found"))
    rising = F.aggregate(
        F.sequence(F.lit(0), c["up"]),
        start,
        lambda s, k: _let(
            F.when(k == 0, F.lit(1.0)).otherwise(s["weight"] * ratio(c["mode"] + k - 1)),
            lambda w: step(s, c["mode"] + k, w),
        ),
    )
    fresh = _let(rising, lambda s: F.struct(F.lit(1.0).alias("weight"), s["sum"].alias("sum"), s["found"].alias("found")))
    falling = F.when(c["down"] > 0, F.sequence(F.lit(1), c["down"])).otherwise(F.array().cast("array<int>"))
    return F.aggregate(
        falling,
        fresh,
        lambda s, k: _let(s["weight"] / ratio(c["mode"] - k), lambda w: step(s, c["mode"] - k, w)),
    )


def matrix(cells: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (cell, ``ends``): how many rows of each cell go to the shards up to each one.

    ``cells`` has the columns cell and n. Shard sizes differ by one at most. The
    draws depend on one another only through what is left in each shard, so they are
    one fold over the cells; its state and result are a few numbers a cell.
    """
    ordered = F.array_sort(F.collect_list(F.struct("cell", F.col("n").cast("bigint").alias("n"))))
    one = cells.agg(ordered.alias("cells"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"))
    sizes = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda k: F.floor(F.col("rows") / shards).cast("bigint") + F.when(k < F.col("rows") % shards, 1).otherwise(0),
    )

    def dealt(left: Column, cell: Column) -> Column:
        """Rows of one cell for each shard."""
        start = F.struct(
            F.array().cast("array<bigint>").alias("counts"),
            cell["n"].alias("drawn"),
            F.aggregate(left, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        )

        def deal(state: Column, k: Column) -> Column:
            u = _uniform(seed, cell["cell"], k)
            draw = hypergeometric(u, state["total"], F.element_at(left, k), state["drawn"])
            return _let(
                draw,
                lambda x: F.struct(
                    F.concat(state["counts"], F.array(x)).alias("counts"),
                    (state["drawn"] - x).alias("drawn"),
                    (state["total"] - F.element_at(left, k)).alias("total"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, deal)["counts"]

    def next_cell(state: Column, cell: Column) -> Column:
        return _let(
            dealt(state["left"], cell),
            lambda counts: F.struct(
                F.zip_with(state["left"], counts, lambda a, b: a - b).alias("left"),
                F.concat(state["out"], F.array(F.struct(cell["cell"].alias("cell"), counts.alias("counts")))).alias("out"),
            ),
        )

    start = F.struct(
        sizes.alias("left"), F.array().cast("array<struct<cell:int,counts:array<bigint>>>").alias("out")
    )
    drawn = one.select(F.explode(F.aggregate("cells", start, next_cell)["out"]).alias("one"))
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda k: F.aggregate(F.slice("one.counts", F.lit(1), k), F.lit(0).cast("bigint"), lambda a, x: a + x),
    )
    return drawn.select("one.cell", ends.alias("ends"))


def uniform_shards(df: DataFrame, key: str, shards: int = 8, seed: int = 11, rows: int | None = None) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Every assignment with shard sizes at most one apart is equally likely. ``key``
    names the row id; rows that share it, null included, are told apart by their
    other columns, and equal rows are interchangeable. Columns of ``df`` that are
    called ``shard``, ``slot`` or begin with ``_s_`` are replaced. An empty table
    stays empty. ``rows`` is the number of rows, where it is known.
    """
    taken = {"shard", "slot"}
    names = [c for c in df.columns if c.lower() not in taken and not c.startswith("_s_")]
    rows = df.count() if rows is None else rows
    cells = max(1, -(-rows // CELL_ROWS), min(64, -(-rows // 512)))
    parts = max(1, -(-cells // shards))
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    keyed = df.select(
        *[F.col(f"`{c}`") for c in names],
        F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), F.lit(cells)).cast("int").alias("_s_cell"),
        F.xxhash64(F.lit(seed + 1), F.col(f"`{key}`"), row).alias("_s_first"),
        F.xxhash64(F.lit(seed + 2), F.col(f"`{key}`"), row).alias("_s_second"),
    )
    deal = matrix(keyed.groupBy(F.col("_s_cell").alias("cell")).agg(F.count("*").alias("n")), shards, seed + 3)
    local = Window.partitionBy("_s_cell").orderBy("_s_first", "_s_second")
    sent = (
        keyed.withColumn("_s_at", F.row_number().over(local))
        .join(deal.withColumnRenamed("cell", "_s_cell"), "_s_cell")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("_s_at"))))
        .withColumn("_s_part", F.pmod(F.shiftrightunsigned("_s_second", 20), F.lit(parts)).cast("int"))
        .drop("ends", "_s_at", "_s_cell")
    )
    sizes = sent.groupBy("shard", "_s_part").agg(F.count("*").alias("_s_n"))
    earlier = Window.partitionBy("shard").orderBy("_s_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_s_part", F.coalesce(F.sum("_s_n").over(earlier), F.lit(0)).alias("_s_before"))
    again = Window.partitionBy("shard", "_s_part").orderBy("_s_second", "_s_first")
    return (
        sent.withColumn("_s_at", F.row_number().over(again))
        .join(offsets, ["shard", "_s_part"])
        .withColumn("slot", F.col("_s_before") + F.col("_s_at") - 1)
        .select(*[F.col(f"`{c}`") for c in names], F.col("shard").cast("int").alias("shard"), "slot")
    )

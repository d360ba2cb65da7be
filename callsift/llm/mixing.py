"""Mixing sources to target weights by Pfair scheduling.

Rows of a source form blocks of ``block_rows``, and a slot of the mix holds one block.
A source of share w releases its block i at slot floor(i / w), and the block is due
before slot ceil((i + 1) / w). In each slot the released block with the earliest
deadline goes next (ties: the smaller index). Shares are whole parts of 2^40 that add
up to it, so every block meets its deadline, and a source is always less than one
block off its share; shares differ from the weights as given by one part, that of the
largest source by one part a source.

Blocks are scheduled, not rows: the schedule is folded in frames of slots from one row of
source states, and rows then join their block. The fold is one task: 0.15 ms a block with 20
sources were measured, and time grows with the number of sources. ``block_rows`` decides how
many blocks there are, so choose it by the table: at 256 rows a billion rows take
ten minutes of it, at 16,384 rows some seconds.

Sources that have run out take part no more. Slots in which no block is released are
skipped by the fold and stay empty; no row is dropped and none is repeated.

Only DataFrame functions are used. Rows of a source are numbered in cells of a hash
of the row, so one source, and one id, may hold any share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 1024
#: Rows of a block.
BLOCK_ROWS = 256
#: Weights are whole parts of two to this power.
_BITS = 40
#: Blocks of a frame of the fold.
_FRAME = 128
#: A schedule of so many blocks at most is broadcast.
BROADCAST_BLOCKS = 200_000
_NAMES = ("index", "block", "release", "deadline", "slot")
_BLOCKS = "array<struct<index:int,block:bigint,release:bigint,deadline:bigint,slot:bigint>>"
#: A table of so many sources at most is broadcast.
BROADCAST_SOURCES = 20_000
#: Rows of one source that one window numbers, about.
CELL_ROWS = 20_000
_WIDTH = 1024


def power_weights(df: DataFrame, source: str, exponent: float) -> DataFrame:
    """Weight of each source: its number of rows to the power ``exponent``."""
    counts = df.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    return counts.select("source", F.pow(F.col("n").cast("double"), F.lit(exponent)).alias("weight"))


def quotas(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """The share of each source.

    Returns (source, index, quota, units): ``quota`` is the exact number of
    slots in a period, mostly no whole number; ``units`` is the same of 2^40 slots,
    where it is whole, adds up and is one at least. Sources whose
    weight is null, not finite or not positive weigh as one slot of a period, or of
    as many slots as there are sources if these are more.
    """
    every = Window.partitionBy(F.lit(0))
    given = (F.col("weight") > 0) & (F.col("weight") < float("inf"))
    clean = weights.withColumn("weight", F.when(given, F.col("weight").cast("double")).otherwise(0.0))
    # Divided by the largest first, so that the sum stays finite.
    clean = clean.withColumn("weight", F.coalesce(F.try_divide("weight", F.max("weight").over(every)), F.lit(0.0)))
    shared = clean.withColumns(
        {"sources": F.count("*").over(every), "all": F.sum("weight").over(every), "none": F.count_if(F.col("weight") == 0).over(every)}
    )
    slot = 1 / F.greatest(F.lit(period), F.col("sources"))
    share = (
        F.when(F.col("all") == 0, 1 / F.col("sources"))
        .when(F.col("weight") == 0, slot)
        .otherwise(F.col("weight") / F.col("all") * (1 - F.col("none") * slot))
    )
    whole = shared.withColumn("units", F.greatest(F.lit(1), F.floor(share * 2.0**_BITS)).cast("long"))
    falling = Window.partitionBy(F.lit(0)).orderBy(F.desc("units"), "source")
    # What rounding leaves goes to the largest source: some parts of 2^40.
    rest = F.when(F.row_number().over(falling) == 1, F.lit(2**_BITS) - F.sum("units").over(every)).otherwise(0)
    leaves = whole.withColumn("units", F.col("units") + rest)
    return leaves.select(
        "source",
        (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source")) - 1).cast("int").alias("index"),
        (F.col("units") * (period / 2.0**_BITS)).alias("quota"),
        "units",
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _at(index, step, more, units, left, done, release, part) -> Column:
    """A source before its block ``done``: ``release`` is floor(done / w), ``part`` what the
    division leaves; 1 / w is ``step`` and ``more`` parts of ``units``."""
    over = part + more >= units
    following = release + step + over.cast("long")
    rest = part + more - F.when(over, units).otherwise(F.lit(0).cast("long"))
    fields = {
        "index": index, "step": step, "more": more, "units": units, "left": left, "done": done, "release": release,
        "following": following, "rest": rest, "due": following + (rest > 0).cast("long"),
    }
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _advanced(x: Column) -> Column:
    """A source after one of its blocks."""
    kept = [x[k] for k in ("index", "step", "more", "units")]
    return _at(*kept, x["left"] - 1, x["done"] + 1, x["following"], x["rest"])


def earliest_deadlines(sources: DataFrame) -> DataFrame:
    """(index, block, release, deadline, slot) of every block of sources (index, units, blocks).

    A fold over frames of ``_FRAME`` blocks, each a fold over its blocks. Its state is the next
    slot, the block chosen last and, for each source with blocks left, the number of those done with the window of the
    next one.
    """
    zero = F.lit(0).cast("long")
    step = F.call_function("div", F.lit(2**_BITS), F.col("units"))
    first = _at(F.col("index"), step, F.lit(2**_BITS) % F.col("units"), F.col("units"), F.col("blocks"), zero, zero, zero)
    one = sources.where("blocks > 0").select(first.alias("x")).agg(F.collect_list("x").alias("s"))
    one = one.where(F.size("s") > 0).withColumn("total", F.aggregate("s", zero, lambda n, x: n + x["left"]))
    none = F.array().cast(_BLOCKS)

    def following(state: Column) -> Column:
        """The state after the block that it names, with the block chosen next."""
        last = state["last"]
        states = F.transform(state["s"], lambda y: F.when(y["index"] == last["index"], _advanced(y)).otherwise(y))

        def at(s: Column, slot: Column) -> Column:
            def window(y: Column) -> Column:
                fields = {"due": y["due"], "index": y["index"], "block": y["done"], "release": y["release"], "slot": slot}
                return F.when(y["release"] <= slot, F.struct(*[v.alias(k) for k, v in fields.items()]))

            return F.struct((slot + 1).alias("t"), s.alias("s"), F.array_min(F.transform(s, window)).alias("last"))

        def chosen(s: Column) -> Column:
            slot = F.greatest(state["t"], F.array_min(F.transform(s, lambda y: y["release"])))
            return _let(slot, lambda x: at(s, x))

        return _let(F.filter(states, lambda y: y["left"] > 0), chosen)

    # Lists grow beside the state and not in it: they take the block, or frame, of the step before.
    def next_block(acc: Column, _: Column) -> Column:
        last = acc["state"]["last"]
        block = F.struct(*[last[x].alias(y) for x, y in zip(("index", "block", "release", "due", "slot"), _NAMES, strict=True)])
        return F.struct(following(acc["state"]).alias("state"), F.concat(acc["out"], F.array(block)).alias("out"))

    def next_frame(acc: Column, frame: Column) -> Column:
        blocks = F.sequence(F.lit(1).cast("long"), F.least(F.lit(_FRAME).cast("long"), F.col("total") + 1 - frame * _FRAME))
        start = F.struct(acc["now"]["state"].alias("state"), none.alias("out"))
        return F.struct(
            F.aggregate(blocks, start, next_block).alias("now"), F.concat(acc["frames"], F.array(acc["now"]["out"])).alias("frames")
        )

    last = F.lit(None).cast("struct<due:bigint,index:int,block:bigint,release:bigint,slot:bigint>")
    # The first step has no block to take yet, so there is one step more than blocks.
    start = F.struct(
        F.struct(F.struct(zero.alias("t"), F.col("s").alias("s"), last.alias("last")).alias("state"), none.alias("out")).alias("now"),
        F.array().cast(f"array<{_BLOCKS}>").alias("frames"),
    )
    frames = F.sequence(zero, F.call_function("div", F.col("total"), F.lit(_FRAME)))
    every = lambda x: F.concat(x["frames"], F.array(x["now"]["out"]))
    folded = one.select(F.aggregate(frames, start, next_frame, every).alias("frames"))
    return folded.select(F.explode("frames").alias("frame")).select(F.inline("frame")).where("index is not null")


def running_before(counts: DataFrame, cell: str, group: list[str], to: str) -> DataFrame:
    """For each (group, cell) the rows of earlier cells, in two levels of sums.

    Cells are numbers from 0. Windows hold ``_WIDTH`` cells, or one row for each
    ``_WIDTH`` cells.
    """
    wide = counts.withColumn("_wide", F.floor(F.col(cell) / _WIDTH))
    inner = Window.partitionBy(*group, "_wide").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    tops = wide.groupBy(*group, "_wide").agg(F.sum("n").alias("_n"))
    outer = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_wide").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*group, "_wide", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_top"))
    here = F.coalesce(F.sum("n").over(inner), F.lit(0))
    return (
        wide.withColumn("_here", here)
        .join(tops, [*group, "_wide"])
        .select(*group, cell, (F.col("_here") + F.col("_top")).alias(to))
    )


def schedule(
    df: DataFrame,
    key: str,
    source: str,
    weights: DataFrame,
    block_rows: int = 1,
    period: int = PERIOD,
    seed: int = 5,
    rows: int | None = None,
) -> DataFrame:
    """``df`` with its place in the mix.

    Adds ``block`` (from 0 within its source), ``release`` and ``deadline`` (slots
    between which the block may stand: its source is less than one block off its
    share there), ``slot`` and ``in_block``; sorting by (slot, in_block) gives the mix. ``weights`` has the columns source and weight, a row for
    each source of ``df``; a null source is a source of its own. Rows of a source
    follow one another in an order by hash; equal rows are interchangeable. Columns
    of those names, and names that begin with ``_m_``, are replaced.
    """
    made = {"block", "release", "deadline", "slot", "in_block"}
    names = [c for c in df.columns if c.lower() not in made and not c.startswith("_m_")]
    rows = df.count() if rows is None else rows
    cells = max(1, -(-rows // CELL_ROWS), min(256, -(-rows // 256)))
    quota = quotas(weights, period).select(*[F.col(c).alias(f"_m_{c}") for c in ("source", "index", "units")])
    sources = weights.count()
    if sources <= BROADCAST_SOURCES:
        quota = F.broadcast(quota)
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    hashed = F.xxhash64(F.lit(seed), row)
    keyed = (
        df.select(
            *[F.col(f"`{c}`") for c in names],
            F.pmod(hashed, F.lit(cells)).cast("int").alias("_m_cell"),
            F.xxhash64(F.lit(seed + 1), F.col(f"`{key}`")).alias("_m_order"),
        )
        .join(quota, F.col(f"`{source}`").eqNullSafe(F.col("_m_source")))
        .drop("_m_source")
    )
    counts = keyed.groupBy("_m_index", "_m_units", "_m_cell").agg(F.count("*").alias("n"))
    before = running_before(counts.drop("_m_units"), "_m_cell", ["_m_index"], "_m_before")
    blocks = counts.groupBy(F.col("_m_index").alias("index"), F.col("_m_units").alias("units")).agg(
        F.ceil(F.sum("n") / block_rows).cast("long").alias("blocks")
    )
    planned = earliest_deadlines(blocks).withColumnsRenamed({"index": "_m_index", "block": "_m_block"})
    if rows // block_rows + sources <= BROADCAST_BLOCKS:
        planned = F.broadcast(planned)
    within = Window.partitionBy("_m_index", "_m_cell").orderBy("_m_order", F.xxhash64(row))
    return (
        keyed.withColumn("_m_at", F.row_number().over(within))
        .join(before, ["_m_index", "_m_cell"])
        .withColumn("_m_at", F.col("_m_before") + F.col("_m_at") - 1)
        .withColumn("_m_block", F.floor(F.col("_m_at") / block_rows))
        .drop("release", "deadline", "slot")
        .join(planned, ["_m_index", "_m_block"])
        .select(
            *[F.col(f"`{c}`") for c in names],
            F.col("_m_block").alias("block"),
            "release",
            "deadline",
            "slot",
            (F.col("_m_at") % block_rows).alias("in_block"),
        )
    )


def positions(scheduled: DataFrame, period: int = PERIOD) -> DataFrame:
    """``scheduled`` with ``position``: its gapless place in the mix, from 0."""
    cell = scheduled.withColumn("_m_cell", F.floor(F.col("slot") / period))
    counts = cell.groupBy("_m_cell").agg(F.count("*").alias("n"))
    within = Window.partitionBy("_m_cell").orderBy("slot", "in_block")
    return (
        cell.withColumn("_m_at", F.row_number().over(within))
        .join(running_before(counts, "_m_cell", [], "_m_before"), "_m_cell")
        .withColumn("position", F.col("_m_before") + F.col("_m_at") - 1)
        .drop("_m_cell", "_m_at", "_m_before")
    )


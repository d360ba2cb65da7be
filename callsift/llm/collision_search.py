"""Approximate nearest neighbours by counting collisions in query-centred windows.

Vectors are scaled into the unit ball and given one more component that puts them on the
unit sphere; for a unit query the largest inner product is then the smallest distance.
Each of ``PROJECTIONS`` random directions has one sorted array of all vectors' projections.
Around a query's own projection a window is opened in each array. A vector within
the window collides; one that collides in at least half of the arrays is
verified by its inner product. Then all windows grow by some levels (virtual rehashing: a
wider window holds the narrower one, so only what is new is counted), until they are so wide
that a vector at the distance of the last neighbour found so far would have collided
often enough with probability ``CERTAINTY``.

Rows are dealt to tiles of about ``TILE`` vectors, each with its own arrays, and queries to
groups; a task searches one tile for one group and gives the best of the tile, from
which the best of all are taken. The work is that of all pairs of groups and tiles, which
a stated query set against all rows needs; what a task holds is bounded.

Vectors that are null, zero, hold a null or a component that is no finite number, have no
id, or are not of the length that most have, take no part. Rows of the same id are
different rows: each is a query, and each a candidate for the other. Ties of scores go
to the smaller id. Equal vectors get equal scores.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.llm.vector_rows import best, dealt, dimension, finite, matrix, parts

#: Vectors of a tile and queries of a group, about.
TILE = 1 << 14
GROUP = 1 << 12
PROJECTIONS = 64
#: Collisions that make a candidate.
ENOUGH = PROJECTIONS // 2
#: Chance that a vector as near as the last neighbour is verified; nearer ones have a better one.
CERTAINTY = 0.92
#: First half-width of the windows and how levels grow; distances lie between 0 and 2.
WIDTH, GROWTH = 0.3, 1.06
#: Levels that the windows grow at once, unless fewer are needed.
STRIDE = 4
_SEED = 13


@lru_cache
def reach(projections: int, enough: int, certainty: float) -> float:
    """Half-width, in distances, at which a vector collides often enough with this chance."""

    def chance(p: float) -> float:
        return sum(math.comb(projections, k) * p**k * (1 - p) ** (projections - k) for k in range(enough, projections + 1))

    low, high = 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (low, p) if chance(p) >= certainty else (p, high)
    return NormalDist().inv_cdf((1 + high) / 2)


def widths() -> list[float]:
    """Half-widths of all levels, up to one at which even the farthest vector is certain enough."""
    out, most = [WIDTH], 2 * reach(PROJECTIONS, ENOUGH, CERTAINTY)
    while out[-1] < most:
        out.append(out[-1] * GROWTH)
    return out


class Tile:
    """Sorted projections of some vectors."""

    def __init__(self, vectors: np.ndarray, longest: float):
        n, d = vectors.shape
        self.vectors, self.longest = vectors, longest
        unit = vectors / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        self._axes = np.random.default_rng(_SEED).standard_normal((PROJECTIONS, d + 1))
        places = self._axes[:, :d] @ unit.T + self._axes[:, d:] * rest
        order = np.argsort(places, axis=1)
        self._sorted = np.take_along_axis(places, order, axis=1)
        self._order = order.astype(np.uint16 if n <= 1 << 16 else np.int64)
        self._unit = unit.astype(np.float32)
        self._reach = reach(PROJECTIONS, ENOUGH, CERTAINTY)
        self._widths = widths()

    def search(self, queries: np.ndarray, own: np.ndarray, most: int, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the places of its nearest vectors, and the inner products.

        ``own`` is the place of the query's own row in this tile, or -1.
        """
        size = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        unit = queries / size[:, None]
        at = unit @ self._axes[:, :-1].T
        wide = np.array(self._widths)
        low = np.empty((len(wide), PROJECTIONS, len(queries)), np.int64)
        high = np.empty_like(low)
        for k, line in enumerate(self._sorted):
            low[:, k] = np.searchsorted(line, at[:, k] - wide[:, None], "left")
            high[:, k] = np.searchsorted(line, at[:, k] + wide[:, None], "right")
        for k, query in enumerate(queries):
            yield self._nearest(query, unit[k].astype(np.float32), size[k] * self.longest, low[:, :, k], high[:, :, k], own[k], most, ids)

    def _nearest(self, query, unit, scale, low, high, own, most, ids) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.vectors)
        counts = np.zeros(n, np.int64)
        waiting = np.ones(n, bool)
        if own >= 0:
            waiting[own] = False
        wanted = min(most, int(waiting.sum()))
        # Single-precision products screen; who may be among the best is computed again.
        slack = np.float32((len(query) + 8) * 2.4e-7)
        known, rough = np.empty(0, np.int64), np.empty(0, np.float32)
        rows, last = list(self._order), None
        level, top = 0, len(self._widths) - 1
        while True:
            a, b = low[level].tolist(), high[level].tolist()
            if last is None:
                new = [row[x:y] for row, x, y in zip(rows, a, b, strict=True)]
            else:
                new = [row[x:y] for row, x, y in zip(rows, a, last[0], strict=True)] + [row[x:y] for row, x, y in zip(rows, last[1], b, strict=True)]
            last = a, b
            counts += np.bincount(np.concatenate(new), minlength=n)
            found = np.flatnonzero((counts >= ENOUGH) & waiting)
            if level == top and len(known) + len(found) < wanted:
                found = np.flatnonzero(waiting)
            if len(found):
                waiting[found] = False
                products = np.take(self._unit, found, axis=0) @ unit
                known, rough = np.concatenate((known, found)), np.concatenate((rough, products))
                if len(known) > most:
                    least = np.partition(rough, len(rough) - most)[len(rough) - most]
                    kept = rough >= least - slack
                    known, rough = known[kept], rough[kept]
            needed = top
            if len(known) >= wanted:
                least = np.partition(rough, len(rough) - wanted)[len(rough) - wanted] if wanted else 1.0
                needed = bisect_left(self._widths, self._reach * math.sqrt(max(0.0, 2 - 2 * float(least))))
            if level >= min(needed, top):
                break
            level = min(level + STRIDE, needed, top)
        scores = (self.vectors[known] * query).sum(axis=1)
        order = np.lexsort((ids[known], -scores))[:most]
        return known[order], scores[order]


def nearest(df: DataFrame, key: str, vector: str, queries: Column, most: int, write) -> DataFrame:
    """(query_row, query_id, rank, vec_id, score): the nearest rows of each query row.

    ``queries`` says which rows are queries. ``write`` keeps a table where all executors
    can read it; rows get their numbers there. ``query_row`` tells query rows of one id apart.
    """
    rows = df.where(F.col(key).isNotNull() & finite(vector)).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = write(rows.where(F.exists("vector", lambda x: x != 0)), "collision-rows")
    d = dimension(rows, "vector")
    rows = rows.where(F.size("vector") == d)
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    facts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks"), F.max(size).alias("longest")).first()
    tiles, groups = parts(facts["n"], TILE), parts(facts["asks"], GROUP)
    longest = float(facts["longest"] or 1.0)
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    tiled = rows.select("row", "id", "vector", dealt("row", tiles).alias("tile"), everywhere.alias("group"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    asked = rows.where("asks").select("row", "id", "vector", everywhere.alias("tile"), dealt("row", groups, 1).alias("group"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "vec_id", "row", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        number, ids = left.column("row").to_numpy(), left.column("id").to_numpy()
        tile = Tile(matrix(left.column("vector")), longest)
        order = np.argsort(number)
        asked_row = right.column("row").to_numpy()
        at = np.minimum(np.searchsorted(number, asked_row, sorter=order), len(number) - 1)
        own = np.where(number[order[at]] == asked_row, order[at], -1)
        found = list(tile.search(matrix(right.column("vector")), own, most, ids))
        places = np.concatenate([x for x, _ in found])
        times = [len(x) for x, _ in found]
        asked_id = right.column("id").to_numpy()
        values = [np.repeat(asked_row, times), np.repeat(asked_id, times), ids[places], number[places], np.concatenate([s for _, s in found])]
        return pa.table([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names)

    schema = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score double"
    found = tiled.groupBy("tile", "group").cogroup(asked.groupBy("tile", "group")).applyInArrow(search, schema)
    order = [F.desc("score"), F.col("vec_id"), F.col("row")]
    return best(found, ["query_row", "query_id"], order, most, "rank").select("query_row", "query_id", "rank", "vec_id", "score")

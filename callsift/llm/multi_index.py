"""Hard negatives by an inverted multi-index over whole-number vectors.

The two halves of every vector are quantised by a codebook each; a pair of codewords is a
cell. By Cauchy and Schwarz no vector of a cell has a larger inner product with an anchor
than the sum of two half bounds: the product of the anchor's half with the codeword, plus
the half's length times the radius of the codeword (its farthest member). Both bound lists
are sorted once for an anchor, and a heap visits cells by their falling sum (multi-sequence).
A search stops where the next sum cannot change its answer: the fifth positive, or for each
positive the fifth negative of its window, is certified, or the window's lower end is passed.
So answers are exact, whatever the codebooks are; these are fitted on a sample of at most
about ``SAMPLE`` rows and every row is indexed.

Rows lie in tiles of about ``TILE`` rows of neighbouring cells; a cell with more rows is
spread over several tiles by a hash of the row number. Anchors are sent to the tiles whose
best cell may still hold an answer: first to one tile, whose fifth positive is a floor for
the others, then with the floors of their positives' windows. A task holds a tile and a
group of anchors.

Vectors are given as 64-bit numbers whose inner products fit into 64 bits. Rows without
label, id or vector, of another length than most, or with a component beyond ``LARGEST`` in
size take no part. Rows of one id are different rows: both may be anchors, and each may be
the other's positive. Ties of scores go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.vector_rows import best, dealt, dimension, matrix, parts

#: Codewords of a half.
CODES = 16
SAMPLE = 20_000
TILE = 1 << 14
GROUP = 1 << 12
LARGEST = 1 << 28
#: Rows of cells that are scored together.
TOGETHER = 512
#: A negative scores at least this many hundredths of its positive, and at most as much.
LEAST = 80
POSITIVES, NEGATIVES = 5, 5
_ROW = ["row", "id", "label", "vector"]


def codebook(sample: np.ndarray, codes: int = CODES, rounds: int = 10, seed: int = 11) -> np.ndarray:
    """Centres of a sample (k-means); at least one, at most ``codes``."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    rng = np.random.default_rng(seed)
    centres = np.unique(sample, axis=0)
    centres = centres[np.sort(rng.permutation(len(centres))[:codes])].astype(np.float64)
    for _ in range(rounds):
        code, _ = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, sample)
        sizes = np.bincount(code, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the distance to it, a little rounded up."""
    apart = (centres**2).sum(axis=1) - 2 * points @ centres.T
    code = apart.argmin(axis=1)
    distance = np.sqrt(((points - centres[code]) ** 2).sum(axis=1))
    return code, distance * (1 + 1e-9)


class Index:
    """Two codebooks and the radius of each codeword."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray]):
        self.books, self.radii = books, radii

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and half, the largest product with a member of each codeword."""
        cut, out = self.books[0].shape[1], []
        for half, book, radius in zip((anchors[:, :cut], anchors[:, cut:]), self.books, self.radii, strict=True):
            size = np.sqrt((half**2).sum(axis=1))
            out.append((half @ book.T + size[:, None] * radius) * 1.0 + 1e-6 + 1e-9 * size[:, None] * (np.abs(book).sum(axis=1) + radius))
        return out[0], out[1]


class Tile:
    """Some rows, ordered by cell."""

    def __init__(self, rows: pa.Table, index: Index):
        self._index = index
        i, j = rows.column("i").to_numpy(), rows.column("j").to_numpy()
        order = np.lexsort((rows.column("row").to_numpy(), j, i))
        self.row, self.id, self.label = (rows.column(c).to_numpy()[order] for c in ("row", "id", "label"))
        self._vectors = matrix(rows.column("vector"), np.int64)[order]
        i, j = i[order], j[order]
        starts = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        ends = np.append(starts[1:], len(i))
        self._cells = {(a, b): (x, y) for a, b, x, y in zip(i[starts].tolist(), j[starts].tolist(), starts.tolist(), ends.tolist(), strict=True)}
        self._codes = np.unique(i), np.unique(j)
        self._most = int(np.abs(self._vectors).max(initial=0))
        self._floats = None

    def _products(self, places: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products; in doubles where these hold every sum exactly."""
        if self._most * int(np.abs(anchor).max(initial=0)) * len(anchor) < 1 << 53:
            if self._floats is None:
                self._floats = self._vectors.astype(np.float64)
            return (self._floats[places] @ anchor.astype(np.float64)).astype(np.int64)
        return self._vectors[places] @ anchor

    def visits(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Places and scores of rows by falling bounds of their cells, and the bound of all that follow.

        The last bound is minus infinity.
        """
        first, second = (x[0][codes] for x, codes in zip(self._index.bounds(anchor[None, :].astype(np.float64)), self._codes, strict=True))
        order_a, order_b = np.argsort(-first), np.argsort(-second)
        first, second = first[order_a].tolist(), second[order_b].tolist()
        code_a, code_b = self._codes[0][order_a].tolist(), self._codes[1][order_b].tolist()
        heap = [(-first[0] - second[0], 0, 0)]
        some, held = [], 0
        while heap:
            _, a, b = heapq.heappop(heap)
            if b + 1 < len(second):
                heapq.heappush(heap, (-first[a] - second[b + 1], a, b + 1))
            if b == 0 and a + 1 < len(first):
                heapq.heappush(heap, (-first[a + 1] - second[0], a + 1, 0))
            span = self._cells.get((code_a[a], code_b[b]))
            if span:
                some.append(np.arange(*span))
                held += span[1] - span[0]
            if held >= TOGETHER and heap:
                places = np.concatenate(some)
                yield places, self._products(places, anchor), -heap[0][0]
                some, held = [], 0
        places = np.concatenate([*some, np.empty(0, np.int64)])
        yield places, self._products(places, anchor), -np.inf

    def _first(self, places: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        return np.lexsort((self.row[places], self.id[places], -scores))[:most]

    def positives(self, row: int, label: int, anchor: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """The first other rows of the label; those below the floor need not be given."""
        places, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for found, products, rest in self.visits(anchor):
            fit = (self.label[found] == label) & (self.row[found] != row)
            places, scores = np.concatenate((places, found[fit])), np.concatenate((scores, products[fit]))
            order = self._first(places, scores, POSITIVES)
            places, scores = places[order], scores[order]
            if rest < floor or len(scores) == POSITIVES and scores[-1] > rest:
                break
        return places, scores

    def negatives(self, label: int, anchor: np.ndarray, wanted: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each positive's score, not below 0, the first rows of other labels in its window."""
        places, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        lowest = min(wanted)
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(wanted)
        for found, products, rest in self.visits(anchor):
            fit = (self.label[found] != label) & (100 * products >= LEAST * lowest) & (products <= max(wanted))
            places, scores = np.concatenate((places, found[fit])), np.concatenate((scores, products[fit]))
            for k, top in enumerate(wanted):
                if out[k] is None:
                    inside = np.flatnonzero((100 * scores >= LEAST * top) & (scores <= top))
                    order = inside[self._first(places[inside], scores[inside], NEGATIVES)]
                    if 100 * rest < LEAST * top or len(order) == NEGATIVES and scores[order[-1]] > rest:
                        out[k] = places[order], scores[order]
            if None not in out:
                break
        return out


def usable(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(row, id, label, vector): the rows that take part, numbered; to be written before use."""
    small = F.coalesce(F.forall(vector, lambda x: F.abs(x) <= LARGEST), F.lit(False)) & (F.size(vector) > 0)
    return df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & small).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<bigint>").alias("vector"),
    )


def indexed(rows: DataFrame, write) -> tuple[DataFrame, Index, list[tuple[int, int, int, int]]]:
    """Rows with their cells (i, j) and tile, the index, and (i, j, first tile, tiles) of each cell."""
    d = dimension(rows, "vector")
    rows = rows.where(F.size("vector") == d)
    count = rows.count()
    chosen = rows.where(F.pmod(F.xxhash64("row", F.lit(2)), F.lit(parts(count, SAMPLE))) == 0)
    sample = np.array([x["vector"] for x in chosen.select("vector").orderBy("vector").collect()], np.float64).reshape(-1, max(d, 1))
    cut = d // 2
    books = codebook(sample[:, :cut]), codebook(sample[:, cut:])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(3))
            if not len(points):
                continue
            (i, far_i), (j, far_j) = nearest(points[:, :cut], books[0]), nearest(points[:, cut:], books[1])
            values = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(far_i), pa.array(far_j)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *values], [*_ROW, "i", "j", "far_i", "far_j"])

    schema = "row bigint, id bigint, label bigint, vector array<bigint>, i int, j int, far_i double, far_j double"
    cells = write(rows.select(*_ROW).mapInArrow(coded, schema), "multi-index")
    # As many rows as there are cells, CODES * CODES at most.
    known = cells.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("far_i").alias("far_i"), F.max("far_j").alias("far_j")).orderBy("i", "j").collect()
    radii = tuple(np.zeros(len(book)) for book in books)
    plan, tile, held = [], 0, 0
    for x in known:
        radii[0][x["i"]], radii[1][x["j"]] = max(radii[0][x["i"]], x["far_i"]), max(radii[1][x["j"]], x["far_j"])
        own = parts(x["n"], TILE)
        if held and held + x["n"] > TILE:
            tile, held = tile + 1, 0
        plan.append((x["i"], x["j"], tile, own))
        if own > 1:
            tile += own
        else:
            held += x["n"]
    spark = rows.sparkSession
    where = F.broadcast(spark.createDataFrame(plan, "i int, j int, first int, tiles int"))
    placed = cells.join(where, ["i", "j"]).withColumn("tile", F.col("first") + F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))
    return placed.select(*_ROW, "i", "j", "tile"), Index(books, radii), plan


def routed(anchors: DataFrame, index: Index, plan: list[tuple[int, int, int, int]], only_best: bool) -> DataFrame:
    """Anchors once for each tile that may hold a row at or above their ``floor``.

    The anchor's best tile gets it where ``only_best``, all others where not. Cells of one
    tile count by their best bound; a cell's tiles are alike.
    """
    cells = np.array(plan or np.empty((0, 4)), np.int64).reshape(-1, 4)
    tile = np.concatenate([np.arange(first, first + tiles) for _, _, first, tiles in plan] or [np.empty(0, np.int64)])
    cell = np.repeat(np.arange(len(cells)), cells[:, 3])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(cells):
                continue
            names = batch.schema.names
            first, second = index.bounds(matrix(batch.column(names.index("vector"))))
            bound = first[:, cells[:, 0]] + second[:, cells[:, 1]]
            floor = batch.column(names.index("floor")).to_numpy()
            home = tile[np.searchsorted(cell, bound.argmax(axis=1))]
            for k in range(batch.num_rows):
                tiles = home[k : k + 1] if only_best else np.setdiff1d(tile[bound[k, cell] >= floor[k]], home[k : k + 1])
                if len(tiles):
                    row = batch.take(pa.array(np.full(len(tiles), k)))
                    yield pa.RecordBatch.from_arrays([*row.columns, pa.array(tiles.astype(np.int32))], [*names, "tile"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields) + ", tile int"
    return anchors.mapInArrow(sent, schema)


def _visit(rows: DataFrame, anchors: DataFrame, groups: int, index: Index, answer, schema: str) -> DataFrame:
    """Tiles and groups of anchors together; ``answer(tile, anchor table)`` gives columns."""
    spread = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = anchors.withColumn("group", dealt("row", groups, 1))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = answer(Tile(left, index), right) if left.num_rows and right.num_rows else None
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.table([pa.array(columns[c] if columns else [], pa.int64()) for c in names], names)

    return spread.groupBy("tile", "group").cogroup(asked.groupBy("tile", "group")).applyInArrow(search, schema)


def _positives(tile: Tile, asked: pa.Table) -> dict[str, list]:
    out = {"row": [], "other": [], "id": [], "score": []}
    vectors = matrix(asked.column("vector"), np.int64)
    for k, (row, label, floor) in enumerate(zip(*[asked.column(c).to_pylist() for c in ("row", "label", "floor")], strict=True)):
        places, scores = tile.positives(row, label, vectors[k], floor)
        out["row"] += [row] * len(places)
        out["other"] += tile.row[places].tolist()
        out["id"] += tile.id[places].tolist()
        out["score"] += scores.tolist()
    return out


def _negatives(tile: Tile, asked: pa.Table) -> dict[str, list]:
    out = {"row": [], "score": [], "other": [], "id": [], "negative_score": []}
    vectors = matrix(asked.column("vector"), np.int64)
    for k, (row, label, wanted) in enumerate(zip(*[asked.column(c).to_pylist() for c in ("row", "label", "wanted")], strict=True)):
        for score, (places, scores) in zip(wanted, tile.negatives(label, vectors[k], wanted), strict=True):
            out["row"] += [row] * len(places)
            out["score"] += [score] * len(places)
            out["other"] += tile.row[places].tolist()
            out["id"] += tile.id[places].tolist()
            out["negative_score"] += scores.tolist()
    return out


def hard_negatives(rows: DataFrame, is_anchor, write) -> DataFrame:
    """(anchor_row, anchor_id, positive_row, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` is a written table of ``usable``; ``is_anchor`` is a condition on its columns.
    """
    placed, index, plan = indexed(rows, write)
    d = sum(x.shape[1] for x in index.books)
    anchors = rows.where(F.size("vector") == d).where(is_anchor).withColumn("floor", F.lit(float("-inf")))
    groups = parts(anchors.count(), GROUP)
    schema = "row bigint, other bigint, id bigint, score bigint"
    order = [F.desc("score"), F.col("id"), F.col("other")]
    near = write(best(_visit(placed, routed(anchors, index, plan, True), groups, index, _positives, schema), ["row"], order, POSITIVES, "nth"), "near-positives")
    # A floor holds only where the first tile has as many positives as are wanted.
    floors = near.where(F.col("nth") == POSITIVES).select("row", F.col("score").cast("double").alias("floor"))
    lowest = anchors.drop("floor").join(floors, "row", "left").fillna(float("-inf"), ["floor"])
    more = _visit(placed, routed(lowest, index, plan, False), groups, index, _positives, schema)
    positives = write(best(near.drop("nth").unionByName(more), ["row"], order, POSITIVES, "nth"), "positives")

    # Below 0 a window holds nothing: its lower end lies above its upper end.
    wanted = positives.where("score >= 0").groupBy("row").agg(F.sort_array(F.collect_set("score")).alias("wanted"))
    asking = anchors.drop("floor").join(wanted, "row").withColumn("floor", F.col("wanted")[0] * LEAST / 100)
    asking = write(asking.select(*_ROW, "wanted", "floor"), "windows")
    schema = "row bigint, score bigint, other bigint, id bigint, negative_score bigint"
    everywhere = routed(asking, index, plan, True).unionByName(routed(asking, index, plan, False))
    found = _visit(placed, everywhere, groups, index, _negatives, schema)
    order = [F.desc("negative_score"), F.col("negative_id"), F.col("other")]
    ranked = best(found.withColumnRenamed("id", "negative_id"), ["row", "score"], order, NEGATIVES, "rank")
    named = positives.select("row", "score", F.col("other").alias("positive_row"), F.col("id").alias("positive_id"))
    named = named.join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return named.join(ranked, ["row", "score"]).select(
        F.col("row").alias("anchor_row"),
        "anchor_id",
        "positive_row",
        "positive_id",
        "rank",
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )

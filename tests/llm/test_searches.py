"""Searches over vectors and the alignment of tokenizers against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from callsift.llm import collision_search, multi_index, token_alignment, vector_rows
from callsift.llm.queries import REGISTRY
from callsift.sources.shared_dir import written

FIRST, SECOND = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _vectors(n: int = 700, d: int = 12) -> list[tuple]:
    rng = np.random.default_rng(5)
    points = rng.normal(size=(n, d))
    points[: n // 3] = points[0]  # a third of all rows are copies
    rows = [(k, [float(x) for x in p.astype(np.float32)], int(rng.integers(0, 10))) for k, p in enumerate(points)]
    rows += [rows[40], rows[100], rows[140]]  # repeated rows
    odd = [None, [], [0.0] * d, [None] + [1.0] * (d - 1), [math.nan] + [1.0] * (d - 1), [math.inf] + [1.0] * (d - 1), [1.0] * (d + 1)]
    rows += [(10_000 + 100 * k, v, 1) for k, v in enumerate(odd)]
    return [*rows, (20_000, rows[1][1], None), (None, rows[2][1], 3)]


def _fine(rows: list[tuple], d: int = 12, zero: bool = False) -> list[tuple]:
    def fine(v) -> bool:
        return v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))

    return [x for x in rows if x[0] is not None and fine(x[1])]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(_vectors(), SCHEMA)


def _tables(spark, tmp_path_factory, name: str, df) -> str:
    folder = str(tmp_path_factory.mktemp("tables"))
    df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_hard_negatives(spark, vectors, tmp_path_factory, monkeypatch):
    folder = _tables(spark, tmp_path_factory, "embeddings", vectors.withColumn("row", F.lit("own")).withColumn("tile", F.lit(1)))
    rows = [(k, [math.floor(256 * x) for x in v], (y + 1) % 10 if k % 7 == 0 else y) for k, v, y in _fine(_vectors(), zero=True) if y is not None]
    expected = collections.Counter()
    for at, (anchor, v, label) in enumerate(rows):
        if anchor % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), k, y) for j, (k, w, y) in enumerate(rows) if j != at]
        for score, positive, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fit = sorted(x for x in scored if x[2] != label and 80 * -score <= 100 * -x[0] <= 100 * -score)
            expected.update((anchor, positive, n, k, -score, -s) for n, (s, k, _) in enumerate(fit[:5], 1))
    for tile in (1 << 14, 90):  # the second cuts the cell of the copies
        monkeypatch.setattr(multi_index, "TILE", tile)
        found = REGISTRY["op11_hard_negatives"](spark, folder)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert collections.Counter(map(tuple, found.collect())) == expected


def test_hard_negatives_of_large_numbers(spark):
    rows = [(k, [((k * 37 + i * 11) % 19 - 9) * (1 << 23) for i in range(4)], k % 3) for k in range(60)]
    rows += [(900, [1 << 40, 0, 0, 0], 0)]  # beyond the largest component
    df = written(multi_index.usable(spark.createDataFrame(rows, "k bigint, v array<bigint>, y int"), "k", "v", "y"), "large")
    found = multi_index.hard_negatives(df, F.col("id") == 5, written).collect()
    v = {k: x for k, x, _ in rows}
    assert found
    for x in found:
        assert x["positive_score"] == sum(a * b for a, b in zip(v[5], v[x["positive_id"]], strict=True))
        assert x["negative_score"] == sum(a * b for a, b in zip(v[5], v[x["negative_id"]], strict=True))


def test_multi_index_stops_early():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, size=(12, 8))
    points = (centres[np.arange(2400) % 12] + rng.integers(-5, 6, size=(2400, 8))).astype(np.int64)
    books = multi_index.codebook(points[:, :4]), multi_index.codebook(points[:, 4:])
    (i, far_i), (j, far_j) = (multi_index.nearest(x, book) for x, book in zip((points[:, :4], points[:, 4:]), books, strict=True))
    radii = [np.zeros(len(b)) for b in books]
    np.maximum.at(radii[0], i, far_i)
    np.maximum.at(radii[1], j, far_j)
    index = multi_index.Index(books, tuple(radii))
    table = pa.table({"row": np.arange(2400), "id": np.arange(2400), "label": np.arange(2400) % 2, "vector": pa.array(list(points)), "i": i, "j": j})
    tile = multi_index.Tile(table, index)
    assert (points @ points[0] <= (index.bounds(points[:1])[0][0][i] + index.bounds(points[:1])[1][0][j])).all()
    seen = 0
    visits = tile.visits

    def counted(anchor):
        nonlocal seen
        for x in visits(anchor):
            seen += len(x[0])
            yield x

    tile.visits = counted
    places, scores = tile.positives(0, 0, points[0], -np.inf)
    assert scores.tolist() == sorted((points[2::2] @ points[0]).tolist(), reverse=True)[:5]
    assert seen < 1200


def test_nearest(spark, vectors, tmp_path_factory, monkeypatch):
    folder = _tables(spark, tmp_path_factory, "embeddings", vectors.withColumn("row", F.lit("own")).withColumn("tile", F.lit(1)))
    rows = _fine(_vectors())
    points = np.array([x[1] for x in rows])
    ids = np.array([x[0] for x in rows])
    for tile in (1 << 14, 200):
        monkeypatch.setattr(collision_search, "TILE", tile)
        found = collections.defaultdict(list)
        for x in REGISTRY["op13_nearest"](spark, folder).orderBy("query_id", "rank").collect():
            found[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
        assert set(found) == {k for k in ids.tolist() if k % 20 == 0}
        hits, wanted = 0, 0
        for at in np.flatnonzero(ids % 20 == 0):
            scores = (points * points[at]).sum(axis=1)
            scores[at] = -np.inf
            top = sorted(zip((-scores).tolist(), ids.tolist(), strict=True))[:20]
            own = found[int(ids[at])]
            times = int((ids == ids[at]).sum())
            assert len(own) == 20 * times
            assert {x[0] for x in own} == set(range(1, 21))
            for _, k, score in own:
                assert any(math.isclose(score, s, rel_tol=1e-12) for s in (points[ids == k] @ points[at]).tolist())
            if times == 1:
                assert [(-s, k) for _, k, s in own] == sorted((-s, k) for _, k, s in own)
                # Copies tie: the smaller ids come first.
                hits += len({k for _, k in top} & {k for _, k, _ in own})
                wanted += len({k for _, k in top})
        assert hits >= 0.9 * wanted


def test_nearest_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], 1), (20, [-1.0, 0.5], 1), (3, [2.0, 2.0], 1)], SCHEMA)
    found = collision_search.nearest(few, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20, written)
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in found.collect()) == [
        (0, 1, 3, 6.0),
        (0, 2, 20, 0.0),
        (20, 1, 0, 0.0),
        (20, 2, 3, -1.0),
    ]
    empty = spark.createDataFrame([], SCHEMA)
    assert collision_search.nearest(empty, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20, written).count() == 0
    rows = written(multi_index.usable(empty.withColumn("v", F.transform("embedding", lambda x: F.floor(x))), "vec_id", "v", "label"), "none")
    assert multi_index.hard_negatives(rows, F.col("id") % 100 == 0, written).count() == 0


def test_recall_on_random_vectors():
    rng = np.random.default_rng(8)
    points = rng.normal(size=(4000, 64))
    points *= rng.uniform(0.5, 2.0, size=(4000, 1))
    tile = collision_search.Tile(points, float(np.linalg.norm(points, axis=1).max()))
    asked = np.arange(0, 4000, 80)
    ids = np.arange(4000)
    hits = 0
    for at, (places, _) in zip(asked, tile.search(points[asked], asked, 20, ids), strict=True):
        scores = points @ points[at]
        scores[at] = -np.inf
        hits += len(set(np.argsort(-scores)[:20]) & set(places.tolist()))
    assert hits >= 0.9 * 20 * len(asked)


def test_dimension(spark):
    df = spark.createDataFrame([([1.0],), ([1.0, 2.0],), ([1.0, 2.0],), (None,)], "v array<double>")
    assert vector_rows.dimension(df.where("v is not null"), "v") == 2


def test_align_finds_common_ends():
    rng = random.Random(1)
    for _ in range(400):
        end = rng.randint(1, 60)
        a, b = (sorted({end, *rng.sample(range(1, end + 1), rng.randint(0, end - 1))}) for _ in range(2))
        if rng.random() < 0.3:
            a = b
        runs, groups, links_a, links_b = token_alignment.align(a, b)
        ends = [(i + k + 1, j + k + 1) for i, j, n in runs for k in range(n)] + groups
        assert sorted(ends) == [(a.index(x) + 1, b.index(x) + 1) for x in sorted(set(a) & set(b))]
        links = [(i + k, j + k) for i, j, n in runs for k in range(n)] + list(zip(links_a, links_b, strict=True))
        spans_a, spans_b = (list(zip([0, *x[:-1]], x, strict=True)) for x in (a, b))
        assert sorted(links) == [(i, j) for i, x in enumerate(spans_a) for j, y in enumerate(spans_b) if max(x[0], y[0]) < min(x[1], y[1])]


def _texts() -> list[str | None]:
    rng = random.Random(3)
    some = ["tokenization", "naïve", "日本語", "2024-05-06", "<|endoftext|>", "<s>", "x" * 300, "don't", "\t", "  ", "🙂", "\n\n", "a▁b", "<0x41>"]
    texts = [None, "", " ", "\n", "▁", "one", "<|endoftext|> and </s>", "q" * 30_000]
    return texts + [" ".join(rng.choice(some) for _ in range(rng.randint(1, 60))) for _ in range(60)]


def test_token_alignment(spark, tmp_path_factory, monkeypatch):
    rows = [*enumerate(_texts()), (None, "one null id"), (9, "again"), (9, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("block", F.lit("own")).withColumn("n", F.lit(1))
    folder = _tables(spark, tmp_path_factory, "documents", df)
    first, second = token_alignment.byte_level(FIRST), token_alignment.pieces(SECOND)
    counts, docs = collections.Counter(), []
    for k, text in rows:
        a, b = (v.encode([text])[0] if text else [] for v in (first, second))
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(v.table[x] for x in ids) != whole for v, ids in ((first, a), (second, b))):
            docs.append((k, [], [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(v.table[x]) for x in ids]).tolist() for v, ids in ((first, a), (second, b)))
        spans_a, spans_b = ([(x, *s) for x, *s in zip(ids, [0, *e[:-1]], e, strict=True)] for ids, e in ((a, ends_a), (b, ends_b)))
        cuts = [0, *sorted(set(ends_a) & set(ends_b))]
        groups = [[[x for x, s, e in spans if s >= low and e <= high] for spans in (spans_a, spans_b)] for low, high in zip(cuts, cuts[1:], strict=False)]
        links = [(x, y) for x, s, e in spans_a for y, t, f in spans_b if max(s, t) < min(e, f)]
        counts.update(links)
        docs.append((k, a, b, groups, links))
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    expected = collections.Counter()
    for k, a, b, groups, links in docs:
        shown = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
        expected[k, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest] += 1
    assert sum(not x[1] for x in docs) > 2
    for most in (1 << 21, 100):  # the second makes many blocks
        monkeypatch.setattr(token_alignment, "BLOCK_LINKS", most)
        found = REGISTRY["op12_token_alignment"](spark, folder)
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert collections.Counter(map(tuple, found.select(columns).collect())) == expected


def test_both_byte_level_libraries_agree():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(FIRST)
    library.encode_special_tokens = True
    texts = [x for x in _texts() if x]
    texts += [f"a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)}. " for c in range(1, 0x3000)]
    wanted = [x.ids for x in library.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]
    assert token_alignment.byte_level(FIRST).encode(texts) == wanted


def test_groups_give_ids_and_ends(spark):
    df = spark.createDataFrame([(1, "tokenization of naïve words"), (2, None)], "doc_id bigint, text string")
    rows = {x["doc_id"]: x for x in token_alignment.groups(df, "doc_id", "text", FIRST, SECOND).collect()}
    first, second = token_alignment.byte_level(FIRST), token_alignment.pieces(SECOND)
    x = rows[1]
    ends_a, ends_b = (np.cumsum([len(v.table[k]) for k in ids]) for v, ids in ((first, x["a_ids"]), (second, x["b_ids"])))
    assert ends_a[np.array(x["a_ends"]) - 1].tolist() == ends_b[np.array(x["b_ends"]) - 1].tolist()
    assert len(x["link_a"]) == len(x["link_b"]) > 0
    assert rows[2]["a_ids"] == [] and rows[2]["link_b"] == []


def test_alignment_of_no_documents(spark, tmp_path_factory):
    folder = _tables(spark, tmp_path_factory, "documents", spark.createDataFrame([], "doc_id bigint, text string"))
    assert REGISTRY["op12_token_alignment"](spark, folder).count() == 0

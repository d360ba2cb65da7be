"""Each operator on small tables: nulls, empty and long texts, ties, clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from callsift.llm import byte_bpe, doc_stats, jaccard_join, mixing, quality_qda, scaled_sketch, sharding, suffix_dedup, token_file, warc
from callsift.sources.shared_dir import new_folder, written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _rows() -> list[tuple]:
    rng = random.Random(4)
    word = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def prose(n: int) -> list[str]:
        return [rng.choice(word) for _ in range(n)]

    base, passage = prose(120), " ".join(prose(60))
    texts = [None, None, "", "", "one two", "One TWO", "é", " ".join(base), " ".join(base)]
    for k in range(12):  # near copies of many degrees
        some = list(base)
        for at in rng.sample(range(120), k):
            some[at] = rng.choice(word) + "x"
        texts.append(" ".join(some))
    texts += [" ".join(prose(80)) + "\n" + passage + "\n" + " ".join(prose(50)) for _ in range(6)]
    texts += ["same same " * 200, "q" * 3000, " ".join(prose(4000)), "end"]
    rows = [(k, x, "en", None if k % 9 == 0 else f"s{min(k % 5, 2)}", None) for k, x in enumerate(texts)]
    return [*rows, rows[7], rows[-2], (None, " ".join(base), None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _clash(df, *names):
    return df.select("*", *[F.lit("own").alias(x) for x in names])


def test_mix(docs, empty):
    weights = mixing.power_weights(docs, "source", 0.7)
    placed = mixing.positions(mixing.schedule(_clash(docs, "slot", "block"), "doc_id", "source", weights, period=64), 64)
    rows = placed.select("doc_id", "source", "slot", "release", "deadline", "position", "block").collect()
    assert sorted(r["position"] for r in rows) == list(range(len(_rows())))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert len({r["slot"] for r in rows}) == len(rows)
    assert mixing.schedule(empty, "doc_id", "source", mixing.power_weights(empty, "source", 0.7)).count() == 0


def test_mix_stays_within_a_block(spark):
    df = spark.range(900).select(F.col("id"), F.when(F.col("id") < 600, "a").when(F.col("id") < 800, "b").otherwise("c").alias("s"))
    weights = spark.createDataFrame([("a", 6.0), ("b", 2.0), ("c", 1.0)], "source string, weight double")
    quota = {r["source"]: r["quota"] for r in mixing.quotas(weights, 64).collect()}
    rows = mixing.schedule(df, "id", "s", weights, period=64).orderBy("slot").collect()
    placed = collections.Counter()
    for k, row in enumerate(rows[:800], 1):
        placed[row["s"]] += 1
        assert row["slot"] == k - 1
        assert all(abs(placed[s] - k * quota[s] / 64) < 1 for s in quota)
    assert sum(quota.values()) == 64


@pytest.mark.parametrize("shares", [
    [1000.0] + [184.0] * 19,  # one source of many rows
    [199.0] + [1.0] * 199,  # half of the mix, among 200 sources
    [2000.0] + [1.0] * 1500,  # more sources than a period has slots
    [0.37 * 0.8**k for k in range(24)],
    [3.0, 2.9, 1.0, 1e-3, 1e-4],
    [0.0007, 0.0142, 1.0, 2.0, 0.9836],
])
def test_mix_keeps_to_the_real_weights(spark, shares):
    total, slots = sum(shares), 12_000
    rows = [(k, math.ceil(slots * w / total) + 2) for k, w in enumerate(shares)]
    df = spark.createDataFrame(rows, "s int, n int").select("s", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    df = df.withColumn("id", F.col("s") * 100_000 + F.col("i"))
    weights = spark.createDataFrame(list(enumerate(shares)), "source int, weight double")
    units = {r["source"]: r["units"] for r in mixing.quotas(weights).collect()}
    whole = sum(units.values())
    found = mixing.schedule(df, "id", "s", weights).orderBy("slot").collect()
    assert len(found) == sum(n for _, n in rows) and all(r["release"] <= r["slot"] < r["deadline"] for r in found)
    assert [r["slot"] for r in found[:slots]] == list(range(slots))
    most = collections.Counter()
    for r in found[:slots]:  # a source is furthest off just before and just after its own blocks
        w = shares[r["s"]] / total
        most[r["s"]] = max(most[r["s"]], abs(r["block"] - r["slot"] * w), abs(r["block"] + 1 - (r["slot"] + 1) * w))
        assert abs(r["block"] * whole - r["slot"] * units[r["s"]]) < whole  # exactly, by the whole parts that are scheduled
        assert abs((r["block"] + 1) * whole - (r["slot"] + 1) * units[r["s"]]) < whole
    assert max(most.values()) < 1 + 1e-6


def test_mix_goes_by_earliest_deadlines(spark):
    """Against a plain scheduler, with blocks of several rows and sources that run out."""
    rng = random.Random(6)
    shares, counts = [5.0, 1.0, 0.25, 3.0], [900, 400, 3, 50]
    rows = [(s * 1000 + k, f"s{s}") for s, n in enumerate(counts) for k in range(n)]
    rng.shuffle(rows)
    weights = spark.createDataFrame([(f"s{s}", w) for s, w in enumerate(shares)], "source string, weight double")
    units = {r["index"]: r["units"] for r in mixing.quotas(weights).collect()}
    total = sum(units.values())
    want, done, slot = [], [0] * 4, 0
    left = [-(-n // 7) for n in counts]
    while any(left):
        open_ = [s for s in range(4) if left[s]]
        slot = max(slot, min(done[s] * total // units[s] for s in open_))
        due, s = min((-(-(done[s] + 1) * total // units[s]), s) for s in open_ if done[s] * total // units[s] <= slot)
        want.append((f"s{s}", done[s], slot, done[s] * total // units[s], due))
        done[s], left[s], slot = done[s] + 1, left[s] - 1, slot + 1
    found = mixing.schedule(spark.createDataFrame(rows, "id bigint, s string"), "id", "s", weights, block_rows=7)
    got = found.groupBy("s", "block", "slot", "release", "deadline").agg(F.count("*").alias("n")).orderBy("slot").collect()
    assert [(r["s"], r["block"], r["slot"], r["release"], r["deadline"]) for r in got] == want
    assert sum(r["n"] for r in got) == len(rows) and all(r["n"] <= 7 for r in got)
    assert found.select("slot", "in_block").distinct().count() == len(rows)


def test_mix_of_weights_that_are_none(spark):
    weights = spark.createDataFrame([("a", 3.0), ("b", None), ("c", -1.0), ("d", float("nan")), (None, 1.0)], "source string, weight double")
    quota = {r["source"]: r["quota"] for r in mixing.quotas(weights, 64).collect()}
    assert quota == pytest.approx({"a": 45.75, "b": 1, "c": 1, "d": 1, None: 15.25})
    zero = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "source string, weight double")
    assert [r["quota"] for r in mixing.quotas(zero, 64).collect()] == [32, 32]


def test_archives(spark, docs, empty):
    pages = _clash(docs.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html")), "payload")
    warc.register(spark)
    for compress in ("true", "false"):
        folder = new_folder(spark, "test-warc")
        rows = warc.records(pages, "page_id", "url", "html", least=100)
        rows.write.format("warc").option("compress", compress).mode("append").save(folder)
        back = warc.read(spark, folder).collect()
        assert len(back) == len(_rows())
        keeper = {}
        for k, x, *_ in _rows():
            if x and len(x.encode()) >= 100:
                keeper[x] = max(keeper.get(x, -1), -1 if k is None else k)
        for row in back:
            name = re.findall(r"\d+", row["record_id"] or "")
            if row["record_type"] == "response":
                assert hashlib.sha1(row["payload"]).hexdigest() == row["payload_digest"].split(":")[1]
                assert len(row["payload"]) == row["payload_bytes"]
            else:
                text = _rows()[int(name[0])][1]
                assert keeper[text] > int(name[0]) and row["refers_to"] == f"<urn:page:{keeper[text]}>"
        only = warc.read(spark, folder, ["record_id", "record_type"]).where("record_type = 'revisit'")
        assert only.count() == sum(r["record_type"] == "revisit" for r in back) > 0
    folder = new_folder(spark, "test-warc")
    none = empty.select("doc_id", "lang", "text")
    warc.records(none, "doc_id", "lang", "text").write.format("warc").mode("append").save(folder)
    assert warc.read(spark, folder).count() == 0


def test_quality_scores(spark, docs, empty):
    names = list(quality_qda.features())

    def shown(df):
        stats = df.select("doc_id", doc_stats.describe("text").alias("s")).select("doc_id", "s.*")
        return stats.select("doc_id", *[v.alias(k) for k, v in quality_qda.features().items()])

    table = shown(docs)
    labels = docs.select("doc_id", F.when(F.col("text").contains("same"), 0).otherwise(1).alias("q")).where("doc_id > 6").distinct()
    model = quality_qda.fit(table.join(labels, "doc_id"), names, "q")
    scores = model.score(table, "score").collect()
    assert len(scores) == len(_rows()) and all(0 <= r["score"] <= 1 for r in scores)
    one_class = quality_qda.fit(table.join(labels.where("q = 1"), "doc_id"), names, "q")
    assert one_class.score(table, "score").select("score").distinct().collect()[0][0] == 1.0
    nothing = quality_qda.fit(table.join(labels.where("false"), "doc_id"), names, "q")
    assert nothing.score(shown(empty), "score").count() == 0 and nothing.share == 0.5


def test_held_out_quality(spark):
    from callsift.llm.queries import op3_quality

    sf = "/root/testdata/sf0.01"
    found = op3_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) >= 0.9 * len(found)


def _sets() -> dict[int, frozenset]:
    out = {}
    for k, x, *_ in _rows():
        words = WORD.findall((x or "").encode().lower())
        whole = [tuple(words[j : j + 5]) for j in range(len(words) - 4)] or ([tuple(words)] if words else [])
        if k is not None:
            out[k] = frozenset(whole)
    return out


def test_jaccard_components(spark, docs, empty):
    sets = _sets()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 4 * both >= 3 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = jaccard_join.link(_clash(docs, "cls", "n"), "doc_id", "text", written).collect()
    assert len(found) == len(_rows())
    for row in found:
        if row["id"] is not None:
            assert (row["n_shingles"], row["component_id"]) == (len(sets[row["id"]]), find(row["id"]))
    kept = jaccard_join.one_of_each(docs, "doc_id", "text", written)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {find(k) for k in sets} | {None}
    assert jaccard_join.link(empty, "doc_id", "text", written).count() == 0


def test_one_row_of_each_group_also_of_repeated_and_null_ids(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    near, c = a.replace("a30", "other"), " ".join(f"c{k}" for k in range(60))
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (1, near, "x"), (2, near, "x"), (None, a, "x")]  # one group
    rows += [(None, b, "x"), (None, b, "x"), (None, b + " more", "x")]  # of null ids only
    rows += [(1, c, "x"), (3, "", "x"), (3, "", "x"), (None, None, "x")]  # alone, and without words
    docs = spark.createDataFrame([(k, x, s, s, None) for k, x, s in rows], SCHEMA)
    kept = jaccard_join.one_of_each(docs, "doc_id", "text", written).collect()
    found = collections.Counter((r["doc_id"], r["text"]) for r in kept)
    assert found[1, a] + found[1, near] == 1 and (2, near) not in found and (None, a) not in found
    assert found[None, b] + found[None, b + " more"] == 1
    assert (found[1, c], found[3, ""], found[None, None], len(kept)) == (1, 2, 1, 6)


def test_all_jaccard_links(spark, empty):
    def shingles(x):
        words = WORD.findall((x or "").encode().lower())
        return frozenset([tuple(words[j : j + 5]) for j in range(len(words) - 4)] or ([tuple(words)] if words else []))

    base = _rows()[7][1].split(" ")  # near copies that are all alike: components need few of their links
    near = [(100 + k, " ".join([*base[:at], f"other{k}", *base[at + 1 :]]), None, None, None) for k, at in enumerate(range(5, 115, 8))]
    rows = [*_rows(), *near]
    docs = spark.createDataFrame(rows, SCHEMA)
    sets = [(k, shingles(x)) for k, x, *_ in rows]
    wanted, pairs = collections.Counter(), set()
    for i, (k, a) in enumerate(sets):
        near = [j for j, (_, b) in enumerate(sets) if i != j and a and 4 * len(a & b) >= 3 * len(a | b)]
        wanted[k, len(a), len(near)] += 1
        pairs |= {frozenset([a, sets[j][1]]) for j in near if sets[j][1] != a}
    found = jaccard_join.link_counts(docs, "doc_id", "text", written).collect()
    assert collections.Counter((r["id"], r["n_shingles"], r["n_links"]) for r in found) == wanted
    members, linked = jaccard_join.similar_classes(docs, "doc_id", "text", written)
    of = {r["cls"]: dict(sets)[r["id"]] for r in members.where("id is not null").collect()}
    links = [(r["a"], r["b"]) for r in linked.collect()]
    assert len(links) == len(pairs) > 90 and {frozenset([of[a], of[b]]) for a, b in links} == pairs
    assert jaccard_join.link_counts(empty, "doc_id", "text", written).count() == 0


@pytest.mark.parametrize("most", [4000, 1])
def test_repeated_passages(spark, docs, empty, most):
    data = [(x or "").encode() for _, x, *_ in _rows()]
    seen = collections.Counter(x[p : p + 60] for x in data for p in range(len(x) - 59))
    wanted = []
    for x in data:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - 59):
            if seen[x[p : p + 60]] > 1:
                gone[p : p + 60] = True
        wanted.append(bytes(np.frombuffer(x, np.uint8)[~gone]))
    left = suffix_dedup.remove_repeats(_clash(docs, "kept", "id"), "doc_id", "text", written, 60, 20, most)
    assert sorted(bytes(r["kept"]) for r in left.collect()) == sorted(wanted)
    none = suffix_dedup.remove_repeats(empty, "doc_id", "text", written)
    assert none.select(suffix_dedup.as_text("kept")).count() == 0


def test_shards(spark, docs, empty):
    rows = sharding.uniform_shards(_clash(docs, "shard", "slot"), "doc_id", 8).collect()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == len(_rows()) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    assert sharding.uniform_shards(empty, "doc_id").count() == 0


def test_hypergeometric_draws(spark):
    from math import comb

    draws = spark.range(4000).select(
        sharding.hypergeometric((F.col("id") + 0.5) / 4000, F.lit(30), F.lit(12), F.lit(10)).alias("x")
    )
    counts = {r["x"]: r["count"] for r in draws.groupBy("x").count().collect()}
    for x in range(11):
        assert abs(counts.get(x, 0) / 4000 - comb(12, x) * comb(18, 10 - x) / comb(30, 10)) < 0.001


def test_bytes_round_trip(spark, docs, empty):
    for df in (_clash(docs, "ids"), _clash(empty, "ids")):
        ids = df.select("text", byte_bpe.encode("text", RANKS, public_tokenizers.PATTERN).alias("tokens"))
        for row in ids.select("text", "tokens", byte_bpe.decode("tokens", RANKS).alias("back")).collect():
            assert bytes(row["back"]) == (row["text"] or "").encode()


def test_round_trip_in_one_worker_equals_encode_then_decode(spark, docs, empty):
    for df in (_clash(docs, "ids"), _clash(empty, "ids")):
        both = df.select("text", byte_bpe.round_trip("text", RANKS, public_tokenizers.PATTERN).alias("both"))
        ids = df.select(byte_bpe.encode("text", RANKS, public_tokenizers.PATTERN).alias("ids"))
        apart = sorted(tuple(r["ids"]) for r in ids.collect())
        rows = both.select("text", "both.ids", "both.bytes").collect()
        assert sorted(tuple(r["ids"]) for r in rows) == apart
        assert all(bytes(r["bytes"]) == (r["text"] or "").encode() for r in rows)
    plan = both.select("both.*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_sketches(spark, docs, empty):
    text = F.coalesce("text", F.lit(""))
    kept = docs.select("doc_id", text.alias("text"), scaled_sketch.sketch(text).alias("s"))
    pairs = scaled_sketch.with_next(kept, "doc_id", ["text", "s"])
    rows = pairs.select("doc_id", "text", "next_text", "s", scaled_sketch.likeness(F.col("s"), F.col("s")).alias("own")).collect()
    assert len(rows) == len(_rows()) and all(r["own"] == 1 for r in rows)
    assert all((r["s"] == []) == (not r["text"].strip()) for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[10]["next_text"] == by_id[11]["text"]
    far = spark.createDataFrame([(5, "a"), (-(10**12), "b"), (10**15, "c"), (None, "d"), (7, "e")], "k bigint, t string")
    after = {r["t"]: r["next_t"] for r in scaled_sketch.with_next(far, "k", ["t"]).collect()}
    assert after == {"d": "b", "b": "a", "a": "e", "e": "c", "c": "d"}
    assert scaled_sketch.with_next(empty, "doc_id", ["text"]).count() == 0
    whole, part = " ".join(f"w{k}" for k in range(4000)), " ".join(f"w{k}" for k in range(800))
    one = spark.createDataFrame([(whole, part)], "a string, b string")
    one = one.select(*[scaled_sketch.sketch(F.col(c)).alias(c) for c in "ab"])
    assert one.select(scaled_sketch.containment(F.col("b"), F.col("a"))).first()[0] == 1.0
    assert one.select(scaled_sketch.merged(F.col("a"), F.col("b")) == F.col("a")).first()[0]


def test_token_files(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    for df in (docs, empty):
        encoded = written(df.select("doc_id", token_file.encode("text", path, public_tokenizers.PATTERN, 0).alias("ids")), "test-ids")
        folder = new_folder(spark, "test-tokens")
        token_file.write(encoded, "doc_id", "ids", folder, 3)
        rows = token_file.starts(token_file.read(spark, folder)).orderBy("file", "place").collect()
        assert len(rows) == df.count()
        ids = [r["doc_id"] for r in rows]
        assert ids == sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda k: (k is not None, k or 0))
        at = 0
        for r in rows:
            assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"] and bytes(r["ids"][-4:]) == b"\0" * 4
            at += r["n_tokens"]
        want = sorted(zlib.crc32(token_file.unfold(bytes(r["ids"])).astype("<u4").tobytes()) for r in encoded.collect())
        assert sorted(zlib.crc32(bytes(r["ids"])) for r in rows) == want


def test_pipeline_stages(spark, docs, empty, tmp_path):
    folder = str(tmp_path)
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    for df in (_clash(docs, "slot", "kept", "rule"), empty):
        now = df
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = written(stage(spark, now, folder), f"test-stage-{k}")
            if k < len(corpus_pipeline.STAGES) - 1:
                assert now.columns == corpus_pipeline.COLUMNS
        assert {r["doc_id"] for r in now.collect()} <= {r[0] for r in _rows()}
    assert len(corpus_pipeline.STAGES) == 5


def test_mixed_stage_keeps_all_rows_in_order(spark, docs, tmp_path):
    mixed = corpus_pipeline.mixed_sources(spark, docs, str(tmp_path))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))


def test_result_tells_the_place_in_the_mix(spark, docs, tmp_path):
    many = docs.where("doc_id is not null").withColumn("n_chars", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(40))))
    many = many.withColumns({"doc_id": F.col("doc_id") * 100 + F.col("n_chars"), "text": F.lit("a b"), "source": F.concat(F.lit("s"), F.col("doc_id") % 3)})
    mixed = corpus_pipeline.mixed_sources(spark, many, str(tmp_path)).collect()
    for folder, most in (("whole", 0), ("split", 7)):  # files of 1 to 7 rows, or of uneven sizes
        path = str(tmp_path / folder)
        ordered = spark.createDataFrame(mixed, SCHEMA).coalesce(1).select("*", F.monotonically_increasing_id().alias("at"))
        cells = ordered.repartitionByRange(5, F.sqrt("at")).sortWithinPartitions("at").drop("at")
        cells.write.option("maxRecordsPerFile", most).parquet(path)
        found = corpus_pipeline.token_ids(spark, spark.read.parquet(path), "").orderBy("position").collect()
        assert [r["position"] for r in found] == list(range(len(mixed)))
        assert [r["doc_id"] for r in found] == [r["doc_id"] for r in mixed]

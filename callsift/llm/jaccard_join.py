"""N-gram Jaccard join: documents that share most of their word shingles, linked.

Two sets with a Jaccard similarity of t or more share one of the first
n - ceil(t n) + 1 tokens of each, under any one order of all tokens. Several orders
hold at once here: candidates must share a prefix token under every one of them, so
the filters are intersected before a pair is verified.

* Equal sets are one class from the start, known by its hash; only classes are
  joined, however many copies there are.
* The first order puts rare tokens first, so that tokens of frequent passages hardly
  ever reach a prefix. Its counts cover all documents and are kept in a table of
  fixed size by hash; any order gives the same links.
* Tokens of a prefix that no other class of a fitting size has are dropped. They bound
  what a class can share, and so the sizes of its partners.
* The other orders put rare tokens first too, by bands of their counts and seeded
  hashes, so each takes other tokens of a passage into the prefix. Candidates must meet
  under all of them, within the still shorter prefixes that the sizes of the two sets
  allow; only of pairs that do are the sets fetched and intersected.
* Links are wanted as connected components. First each class is tested against the hub
  it shares most prefix tokens with, then against a few more hubs if they are still in
  other components. In the end every pair that could still join two components is
  tested, so no link between components is missed, and a large group of near copies
  costs a few tests a class instead of one a pair.

Words are ``[^\\x20\\x09-\\x0D]+``, ASCII letters in lower case; shingles are told by
64-bit hashes. Documents without words, null and empty texts link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.llm import texts as T

WIDTH = 5
SIMILARITY = 0.75
#: Steps of ``token_counts`` in a doubling of a count.
STEPS = 1 << 10
#: Seeds of the orders, and how many steps of the count are a band. The first one lists candidates.
ORDERS = ((0, 1), (0x51ED270B, STEPS), (0x2545F491, 2 * STEPS))
#: Orders by hash that tokens take their hubs from.
HUB_ORDERS = 8
#: Rows (two numbers each) of a table that may be broadcast, once they are counted.
BROADCAST_ROWS = 100_000
#: The table of token counts has so many cells, in blocks of ``_BLOCK``.
CELLS = 1 << 22
_BLOCK = 1 << 11
_SEEN = 1 << 16


def prefix_length(n: int, t: Fraction) -> int:
    """Tokens of a set of n of which a similar set has one, under any order."""
    return n - -(-t.numerator * n // t.denominator) + 1


def class_of(tokens: np.ndarray) -> int:
    """A hash of a whole set, given as sorted tokens."""
    power = T._power("base", T._BASE, len(tokens))[: len(tokens)]
    return int(T.mix(np.array([(tokens * power).sum(dtype=np.uint64)]))[0].view(np.int64))


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _first(tokens: np.ndarray, counts: np.ndarray, order: tuple[int, int], p: int) -> np.ndarray:
    """Where the first ``p`` of some tokens under an order are, in that order."""
    seed, band = order
    return np.lexsort((T.mix(tokens ^ np.uint64(seed)), counts[_cells(tokens)] // band))[:p]


def classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row (id, n, cls) for each document, and rows (block, counts) of token counts."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, small = np.zeros(CELLS, np.int32), zstandard.ZstdCompressor()
        kind = None
        names = ["id", "n", "cls", "block", "counts"]
        for batch in batches:
            kind = batch.schema.field("id").type
            for some in T.slices(batch, "text"):
                size, cls = [], []
                for tokens in T.shingle_sets(some.column("text"), WIDTH):
                    np.add.at(counts, _cells(tokens), 1)
                    size.append(len(tokens))
                    cls.append(class_of(tokens) if len(tokens) else None)
                none = pa.nulls(len(size))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array(size, pa.int64()), pa.array(cls, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                    names,
                )
        if kind is None or not counts.any():
            return
        blocks = counts.astype("<i4", copy=False).reshape(-1, _BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        none = pa.nulls(len(used))
        packed = [small.compress(blocks[k].tobytes()) for k in used]
        yield pa.RecordBatch.from_arrays(
            [none.cast(kind), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())],
            names,
        )

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: T.giving_back(describe(b)), f"id {kind}, n bigint, cls bigint, block int, counts binary")


def token_counts(described: DataFrame) -> np.ndarray:
    """How many sets have a token of each cell, in steps of its logarithm: a table of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total, large = None, np.zeros(_BLOCK, np.int64), zstandard.ZstdDecompressor()
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                block = k
                total += np.frombuffer(large.decompress(raw), "<i4")
        if block is not None:
            packed = (np.log2(total + 1.0) * STEPS).astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"])

    blocks = described.where("block is not null").select("block", "counts")
    summed = blocks.groupBy("block").applyInArrow(add, "block int, counts binary")
    out = np.zeros((CELLS // _BLOCK, _BLOCK), np.uint16)
    for row in summed.collect():  # CELLS numbers at most
        out[row["block"]] = np.frombuffer(row["counts"], "<u2")
    return out.reshape(-1)


def prefixes(docs: DataFrame, text: str, counts: np.ndarray, t: Fraction) -> DataFrame:
    """(token, cls, n, last): prefix tokens of each class under the first order.

    ``last`` is the count of the last one, by which prefixes end sooner or later.

    A task leaves out classes it has seen lately, so copies hardly repeat rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, np.zeros(_SEEN, np.int64)
        for batch in batches:
            for some in T.slices(batch, "text"):
                token, cls, size, last = [np.empty(0, np.uint64)], [], [], []
                for tokens in T.shingle_sets(some.column("text"), WIDTH):
                    if not len(tokens):
                        continue
                    name = class_of(tokens)
                    if seen[name % _SEEN] == name:
                        continue
                    seen[name % _SEEN] = name
                    first = tokens[_first(tokens, counts, ORDERS[0], prefix_length(len(tokens), t))]
                    token.append(first)
                    last.append(counts[_cells(first[-1:])][0])
                    cls.append(name)
                    size.append(len(tokens))
                each = [len(x) for x in token[1:]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(token).view(np.int64)),
                        pa.array(np.repeat(np.array(cls, np.int64), each)),
                        pa.array(np.repeat(np.array(size, np.int64), each)),
                        pa.array(np.repeat(np.array(last, np.int32), each)),
                    ],
                    ["token", "cls", "n", "last"],
                )

    return docs.select(F.col(text).alias("text")).mapInArrow(lambda b: T.giving_back(find(b)), "token bigint, cls bigint, n bigint, last int")


def profiles(docs: DataFrame, counts: np.ndarray, t: Fraction) -> DataFrame:
    """(cls, tokens, n, p0, p1, ...): sets and their prefixes under all orders, in order.

    ``docs`` has the columns cls and text; a class may come more than once. A prefix holds 32 bits of each token, which
    can only let more pairs pass.
    """
    names = [f"p{k}" for k in range(len(ORDERS))]
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for some in T.slices(batch, "text"):
                expected = some.column("cls").to_pylist()
                cls, sets, size, parts = [], [], [], [[] for _ in ORDERS]
                for want, tokens in zip(expected, T.shingle_sets(some.column("text"), WIDTH), strict=True):
                    if not len(tokens) or class_of(tokens) != want:
                        continue
                    cls.append(want)
                    sets.append(tokens.view(np.int64))
                    size.append(len(tokens))
                    p = prefix_length(len(tokens), t)
                    for out, order in zip(parts, ORDERS, strict=True):
                        first = tokens[_first(tokens, counts, order, p)]
                        out.append((first & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32))
                columns = [pa.array(x, pa.list_(pa.int32())) for x in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(size, pa.int64()), *columns],
                    ["cls", "tokens", "n", *names],
                )

    schema = "cls bigint, tokens array<bigint>, n bigint, " + ", ".join(f"{x} array<int>" for x in names)
    return docs.select("cls", "text").mapInArrow(lambda b: T.giving_back(find(b)), schema)


def _sized(rows: DataFrame, t: Fraction) -> DataFrame:
    """The rows (token, cls, n, last) with ``most``, the largest size of a similar set.

    ``rows`` holds the prefix tokens that stand in another prefix of a fitting size too. Of two
    classes, take that whose prefix ends first in the order: what it shares with the
    other one among its prefix stands in both prefixes. So it shares n minus its
    tokens that are in no other prefix at most, and as similar sets share t / (1 + t)
    of their sizes together, that bounds the other's size.
    """
    num, den = t.numerator, t.denominator
    least = F.ceil(F.col("n") * num / den)
    room = least - 1 + F.col("shared")  # n - prefix + shared
    held = rows.groupBy("cls").agg(F.count("*").alias("shared"))
    most = F.floor(room * (num + den) / num).cast("bigint") - F.col("n")
    return rows.join(_counted(held), "cls").select("token", "cls", "n", "last", most.alias("most"))


def _pair_fits(a: str, b: str, t: Fraction) -> Column:
    """Whether sizes allow a pair; ``a`` and ``b`` are structs (n, last, most)."""
    na, la, ma = (F.col(f"{a}.{x}") for x in ("n", "last", "most"))
    nb, lb, mb = (F.col(f"{b}.{x}") for x in ("n", "last", "most"))
    return _sizes_fit(na, nb, t) & (((la <= lb) & (nb <= ma)) | ((lb <= la) & (na <= mb)))


def _reaches(a: str, t: Fraction) -> Column:
    """Whether sizes allow a pair of ``a`` and any set within the ranges n_min to most_max.

    For a range of one set this is ``_pair_fits``.
    """
    n, last, most = (F.col(f"{a}.{x}") for x in ("n", "last", "most"))
    fits = (n * t.denominator >= F.col("n_min") * t.numerator) & (F.col("n_max") * t.denominator >= n * t.numerator)
    first = (last <= F.col("last_max")) & (F.col("n_min") <= most)
    second = (F.col("last_min") <= last) & (n <= F.col("most_max"))
    return fits & (first | second)


def _sizes_fit(a: Column, b: Column, t: Fraction) -> Column:
    """Sets of these sizes can be similar."""
    return F.least(a, b) * t.denominator >= F.greatest(a, b) * t.numerator


def _counted(df: DataFrame) -> DataFrame:
    """A table of a few numbers a row, to be broadcast where a count allows it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _sides(profile: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """These columns of a profile for the left and for the right class of a pair."""
    return tuple(profile.select(F.col("cls").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in columns]) for s in "ab")


_PREFIXES = ["n", *[f"p{k}" for k in range(len(ORDERS))]]


def _meet(t: Fraction) -> Column:
    """Whether the prefixes of a pair share a token under every order.

    Of sets with a_n and b_n tokens that must share ``least``, all but least - 1 make
    the prefix.
    """
    num, den = t.numerator, t.denominator
    least = F.ceil((F.col("a_n") + F.col("b_n")) * num / (num + den)).cast("bigint")

    def prefix(side: str, k: int) -> Column:
        return F.slice(f"{side}_p{k}", 1, F.greatest(F.col(f"{side}_n") - least + 1, F.lit(0)).cast("int"))

    met = F.lit(True)
    for k in range(len(ORDERS)):
        met = met & F.arrays_overlap(prefix("a", k), prefix("b", k))
    return met


def filtered(pairs: DataFrame, profile: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (a, b) whose prefixes meet under all orders."""
    left, right = _sides(profile, _PREFIXES)
    return _counted(pairs).join(left, "a").join(right, "b").where(_meet(t)).select("a", "b")


def verified(pairs: DataFrame, profile: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (a, b) that are similar, by their whole sets."""
    left, right = _sides(profile, ["tokens"])
    right = right.join(_counted(pairs.select("b").distinct()), "b", "left_semi")
    both = left.join(_counted(pairs), "a").join(right, "b")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    counted = both.select("a", "b", shared.alias("shared"), (F.size("a_tokens") + F.size("b_tokens")).alias("sum"))
    similar = F.col("shared") * t.denominator >= (F.col("sum") - F.col("shared")) * t.numerator
    return counted.where(similar).select("a", "b")


def components(edges: DataFrame, save) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes with edges.

    Alternates two steps that hang the neighbours of each node on its smallest one,
    until nothing changes; each step is one grouping and one join.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def state(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return row["n"], row["s"]

    def save_edges(pairs: DataFrame) -> DataFrame:
        return save(pairs.where("u <> v").select("u", "v").distinct(), "edges")

    now = save_edges(edges.toDF("u", "v"))
    was = None
    while (here := state(now)) != was:
        was = here
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        hung = large.join(least(large), "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(hung.select("u", F.col("m").alias("v")))
        now = save_edges(small)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots


def _relabelled(labels: DataFrame, links: DataFrame, save) -> DataFrame:
    """(cls, size, copies, comp) after components that links join have become one."""
    a = labels.select(F.col("cls").alias("a"), F.col("comp").alias("ca"))
    b = labels.select(F.col("cls").alias("b"), F.col("comp").alias("cb"))
    edges = links.join(a, "a").join(b, "b").where("ca <> cb").select("ca", "cb")
    roots = components(edges, save).withColumnRenamed("node", "comp")
    joined = labels.join(roots, "comp", "left")
    return save(joined.select("cls", "size", "copies", F.coalesce("root", "comp").alias("comp")), "labels")


def _hub_pairs(rows: DataFrame, t: Fraction, nearest: bool) -> DataFrame:
    """Each class with the hubs of each of its tokens, as far as they are in other components.

    With ``nearest`` it is one hub a class: that of most of its tokens. Of a token's hubs one is the class with the most copies, the other the first one in an order by
    hash. Tokens use a few such orders, so the classes of a large group of near
    copies, which share most tokens, meet a few hubs each.
    """
    weights = [F.col("copies"), F.xxhash64(F.pmod("token", F.lit(HUB_ORDERS)), "cls")]
    hubs = rows.groupBy("token").agg(
        F.array(*[F.max(F.struct(w.alias("weight"), "cls", "size", "comp")) for w in weights]).alias("hubs")
    )
    pairs = rows.join(hubs.select("token", F.explode("hubs").alias("hub")), "token")
    pairs = pairs.withColumn("other", F.col("hub.size")).where((F.col("comp") != F.col("hub.comp")) & _pair_fits("size", "other", t))
    if nearest:
        met = pairs.groupBy("cls", F.col("hub.cls").alias("hub")).agg(F.count("*").alias("k"))
        pairs = met.groupBy("cls").agg(F.max(F.struct("k", "hub"))["hub"].alias("hub")).select("cls", F.struct(F.col("hub").alias("cls")).alias("hub"))
    return pairs.select(F.col("cls").alias("a"), F.col("hub.cls").alias("b")).distinct()


def _open_classes(rows: DataFrame, t: Fraction) -> DataFrame:
    """(a, sa, other): each class with every other component it may still have a link into.

    Of two components at a token, the classes of one look for links among the members
    of the other; the largest one at the token is always the other. Classes that no
    set there can match, by the ranges of their sizes, are left out.
    """
    at = rows.groupBy("token", "comp").agg(
        F.count("*").alias("k"), *[f(f"size.{x}").alias(f"{x}_{f.__name__}") for x in ("n", "last", "most") for f in (F.min, F.max)]
    )
    main = at.groupBy("token").agg(F.max(F.struct("k", "comp"))["comp"].alias("main"), F.count("*").alias("comps"))
    main = main.where("comps > 1").select("token", "main")
    apart = rows.join(main, "token").where("comp <> main").select("token", "cls", "size", "comp")
    others = at.join(main, "token").withColumnRenamed("comp", "other").drop("k")
    open_ = (F.col("other") == F.col("main")) | (F.col("comp") < F.col("other"))
    wanted = apart.join(others, "token").where(open_ & (F.col("comp") != F.col("other")) & _reaches("size", t))
    return wanted.select(F.col("cls").alias("a"), F.col("size").alias("sa"), "other").distinct()


def _open_pairs(wanted: DataFrame, labels: DataFrame, profile: DataFrame, t: Fraction) -> DataFrame:
    """The pairs of such classes and members of those components that pass every filter.

    Sizes and the prefixes of all orders are compared within the join, so that
    only pairs for verification leave it.
    """
    left, right = _sides(profile, _PREFIXES)
    members = labels.select(F.col("cls").alias("b"), F.col("size").alias("sb"), F.col("comp").alias("other"))
    members = members.join(right, "b")
    pairs = _counted(wanted).join(left, "a").join(members, "other").where(_pair_fits("sa", "sb", t) & _meet(t))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _prepared(docs: DataFrame, key: str, text: str, save, t: Fraction) -> tuple:
    """Sets, their classes, labels of the classes that may have links, prefix tokens, and
    functions that return the profiles of some classes and which of some pairs are similar."""
    described = save(classes(docs, key, text), "sets")
    sets = described.where("block is null").select("id", "n", "cls")
    counts = token_counts(described)
    rows = prefixes(docs, text, counts, t).repartition("token")
    rows = rows.groupBy("token", "cls", "n", "last").agg(F.count("*").alias("_k"))
    # Of all sizes at a token the next smaller and the next larger one fit first.
    by_size = Window.partitionBy("token").orderBy("n")
    smaller, larger = (_sizes_fit(F.col("n"), f("n", 1, 0).over(by_size), t) for f in (F.lag, F.lead))  # no set has size 0
    rows = rows.withColumn("_fits", smaller | larger)
    rows = save(rows.where("_fits").select("token", "cls", "n", "last"), "shared-tokens")
    rows = save(_sized(rows, t), "sized-tokens")

    grouped = sets.where("cls is not null").groupBy("cls").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    size = F.struct("n", "last", "most")
    used = rows.groupBy("cls").agg(F.max(size).alias("size")).join(grouped, "cls")
    used = save(used.select("cls", "size", "copies", F.col("cls").alias("comp"), "id"), "labels")
    narrow = rows.select("token", "cls", size.alias("size"))
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def profiled(named: DataFrame) -> DataFrame:
        wanted = _counted(save(named.distinct().join(used, "cls").select("cls", F.col("id").alias("_id")), "wanted"))
        return save(profiles(texts.join(wanted, F.col("id").eqNullSafe(F.col("_id"))), counts, t), "profiles")

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = save(pairs, "pairs")
        profile = profiled(pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))))
        close = save(filtered(pairs, profile, t), "candidates")
        return save(verified(close, profile, t).distinct(), "links")

    return sets, grouped, used.drop("id"), narrow, profiled, linked


def similar_classes(docs: DataFrame, key: str, text: str, save, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """All links: (id, n_shingles, cls) for each row, and every pair (a, b) of similar classes.

    Two rows are linked if they are of one class, or their classes are a pair, ``a``
    below ``b``. Unlike in ``link``, every candidate pair of classes is verified, so a
    large group of near copies costs as many tests as it has pairs of classes.
    """
    t = Fraction(similarity).limit_denominator(1000)
    sets, _, _, narrow, _, linked = _prepared(docs, key, text, save, t)
    left = narrow.select("token", F.col("cls").alias("a"), F.col("size").alias("sa"))
    right = narrow.select("token", F.col("cls").alias("b"), F.col("size").alias("sb"))
    pairs = left.join(right, "token").where((F.col("a") < F.col("b")) & _pair_fits("sa", "sb", t))
    return sets.withColumnRenamed("n", "n_shingles"), linked(pairs.select("a", "b").distinct())


def link_counts(docs: DataFrame, key: str, text: str, save, similarity: float = SIMILARITY) -> DataFrame:
    """(id, n_shingles, cls, n_links) for each row: how many other rows it is linked with."""
    sets, pairs = similar_classes(docs, key, text, save, similarity)
    copies = sets.where("cls is not null").groupBy("cls").agg(F.count("*").alias("copies"))
    both = pairs.select(F.col("a").alias("cls"), F.col("b").alias("other"))
    both = both.unionByName(pairs.select(F.col("b").alias("cls"), F.col("a").alias("other")))
    others = both.join(copies.withColumnRenamed("cls", "other"), "other").groupBy("cls").agg(F.sum("copies").alias("others"))
    links = copies.join(others, "cls", "left").select("cls", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return sets.join(links, "cls", "left").select("id", "n_shingles", "cls", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def link(docs: DataFrame, key: str, text: str, save, similarity: float = SIMILARITY) -> DataFrame:
    """(id, n_shingles, component_id, cls) for each row: the smallest id it is linked with.

    Ids that are null take no part in the minimum; a component of null ids has a null
    component. Rows that share an id are rows of their own. ``save(df, name)`` writes
    a table that is read several times and returns it. Only links that components
    need are tested; ``similar_classes`` has them all.
    """
    t = Fraction(similarity).limit_denominator(1000)
    sets, grouped, labels, narrow, profiled, linked = _prepared(docs, key, text, save, t)

    def placed() -> DataFrame:
        return narrow.join(_counted(labels.select("cls", "copies", "comp")), "cls")

    for nearest in (True, False):
        found = linked(_hub_pairs(placed(), t, nearest))
        if not found.isEmpty():
            labels = _relabelled(labels, found, save)
    wanted = save(_open_classes(placed(), t), "open-classes")
    inside = labels.join(wanted.select(F.col("other").alias("comp")).distinct(), "comp", "left_semi").select("cls")
    profile = profiled(wanted.select(F.col("a").alias("cls")).unionByName(inside))
    pairs = save(_open_pairs(wanted, labels, profile, t), "open-pairs")
    found = save(verified(pairs, profile, t).distinct(), "links")
    if not found.isEmpty():
        labels = _relabelled(labels, found, save)

    least = grouped.join(labels.select("cls", "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    roots = least.groupBy("comp").agg(F.min("id").alias("component_id"))
    named = least.select("cls", "comp").join(roots, "comp").select("cls", "component_id")
    return sets.join(named, "cls", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        "cls",
    )


def one_of_each(docs: DataFrame, key: str, text: str, save, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id.

    Among rows of that id, and if all ids are null, it is the one with the smallest
    hash of its text, and of equal ids and texts the first by all columns. Documents
    without words are in no group and all stay.
    """
    unit = F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text"))
    named = docs.select(unit.alias("_unit"), F.col(f"`{text}`").alias("_text"))
    linked = link(named, "_unit", "_text", save, similarity).where("cls is not null")
    times = linked.groupBy("id", "component_id").agg(F.count("*").alias("k"))
    # Of the units that stay those with several rows are kept apart, as one row each.
    again = F.col("id") == F.col("component_id")
    marked = save(times.where(~again | (F.col("k") > 1)).select(F.col("id").alias("_marked"), again.alias("_again")), "marked")
    units = docs.select(*[F.col(f"`{c}`") for c in docs.columns], unit.alias("_unit"))
    same = F.col("_unit").eqNullSafe(F.col("_marked"))
    kept = units.join(marked, same, "left_anti").drop("_unit")
    repeated = marked.where("_again")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    ones = units.join(repeated, same).groupBy("_unit").agg(F.min(row).alias("_row")).select("_row.*")
    return kept.unionByName(ones)

"""Alignment of two tokenizers' tokens of the same text, and how often ids are linked.

Both token sequences of a text are given by their end offsets in bytes. Where both end
at the same byte the text is cut into groups. Two walkers go through the end arrays;
the difference of their indices is the current shift (the diagonal). From a cut on the
arrays are compared at that shift over stretches of doubling length up to the first
difference; what was equal is a run of one-to-one groups and is jumped as a whole. What follows a run is one irregular group: it is resolved by a small
merge of both arrays up to the next common end, which sets the new shift.

Tokens are linked where their bytes overlap. How often a pair of ids is linked in the
corpus is counted in blocks of documents: a block holds its different pairs once, with
numbers, so what is shuffled follows the different pairs of a block and not its links.
Frequent pairs are one row a block; totals go back to the blocks by equality joins,
which Spark may split. Nothing is broadcast and nothing passes through the driver.

Texts are handled whole. A null or empty text has no tokens, and neither has a text
that one of the tokenizers does not give back byte for byte. Repeated rows are aligned
and counted row by row. A null key is kept as it is. Of the input only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text tokenized at a time; a longer text stands alone.
SLICE_BYTES = 1 << 20
#: Links of a block, unless one document has more.
BLOCK_LINKS = 1 << 21
#: Bytes of the first stretch that is compared; an end takes four.
_PROBE = 32
#: A pair of ids as one number: the second id times this, plus the first.
PAIR = 1 << 32


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]], list[int], list[int]]:
    """Groups of two ascending arrays of ends above 0 with the same last value.

    Gives the runs of one-to-one groups as (first a, first b, length), the irregular
    groups as (end a, end b), exclusive, and the links within irregular groups as two
    lists of indices.
    """
    runs, groups, links_a, links_b = [], [], [], []
    of_a, of_b = (memoryview(np.ascontiguousarray(x, "<u4")) for x in (ends_a, ends_b))
    raw_a, raw_b = of_a.tobytes(), of_b.tobytes()
    number = int.from_bytes
    i = j = 0
    n = len(of_a)
    while i < n:
        first, width, at_a, at_b = i, _PROBE, 4 * i, 4 * j
        while i < n:
            # Both stretches as one number each; the lowest bit that differs tells the first end that does.
            apart = number(raw_a[at_a : at_a + width], "little") ^ number(raw_b[at_b : at_b + width], "little")
            if apart:
                i += ((apart & -apart).bit_length() - 1) >> 5
                break
            i, at_a, at_b, width = i + width // 4, at_a + width, at_b + width, 2 * width
        i = min(i, n)
        if i > first:
            runs.append((first, j, i - first))
            j += i - first
        if i == n:
            break
        a, b = of_a[i], of_b[j]
        while True:
            links_a.append(i)
            links_b.append(j)
            if a < b:
                i += 1
                a = of_a[i]
            elif b < a:
                j += 1
                b = of_b[j]
            else:
                break
        i, j = i + 1, j + 1
        groups.append((i, j))
    return runs, groups, links_a, links_b


class Aligned:
    """One text's tokens under both tokenizers, their groups and links."""

    def __init__(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray):
        self.a, self.b = a, b
        runs, groups, links_a, links_b = align(np.cumsum(size_a), np.cumsum(size_b))
        runs = np.array(runs, np.int64).reshape(-1, 3)
        length = runs[:, 2]
        along = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        run_a, run_b = np.repeat(runs[:, 0], length) + along, np.repeat(runs[:, 1], length) + along
        groups = np.array(groups, np.int64).reshape(-1, 2)
        #: Where each group ends, as numbers of tokens; ascending.
        self.group_a = np.sort(np.concatenate((run_a + 1, groups[:, 0])))
        self.group_b = np.sort(np.concatenate((run_b + 1, groups[:, 1])))
        #: Tokens that are linked.
        self.link_a = np.concatenate((run_a, np.array(links_a, np.int64)))
        self.link_b = np.concatenate((run_b, np.array(links_b, np.int64)))

    def pairs(self) -> np.ndarray:
        """Each link as one number."""
        return self.b[self.link_b].astype(np.int64) * PAIR + self.a[self.link_a]


class Vocabulary:
    """Ids of texts by one tokenizer, and the bytes of each id."""

    def __init__(self, encode, table: list[bytes]):
        self.encode, self.table = encode, table
        self.sizes = np.array([len(x) for x in table] or [0], np.int64)


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters stand for themselves; the other bytes have characters from
    U+0100 on, in order.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(0x100 + k): x for k, x in enumerate(rest)}


def _ranked(file: dict) -> bool:
    """The merges of a tokenizer file follow one another as the ids of what they make."""
    model, steps = file["model"], [file["normalizer"], file["pre_tokenizer"]]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    made = [model["vocab"]["".join(x.split(" ") if isinstance(x, str) else x)] for x in model["merges"]]
    usual = steps[0] is None and plain | steps[1] == steps[1] | plain and model["type"] == "BPE" and not model.get("dropout")
    return usual and all(x < y for x, y in zip(made, made[1:], strict=False))


@cache
def byte_level(path: str) -> Vocabulary:
    """A byte-level file of the tokenizers library; one a worker process.

    Where the ids of merged tokens rise with the merges, a merge's rank is its id, and the
    tiktoken library gives the same ids from the same file in a third of the time.
    """
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    of, added = _byte_level(), {x["content"] for x in parts["added_tokens"]}
    table = [b""] * tokenizer.get_vocab_size()
    for token, k in tokenizer.get_vocab().items():
        table[k] = token.encode() if token in added else bytes(of[c] for c in token)
    if _ranked(parts):
        ranks = {x: k for k, x in enumerate(table) if x not in {t.encode() for t in added}}
        plain = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(texts: list[str]) -> list[list[int]]:
            return [plain.encode_ordinary(" " + x) for x in texts]

    else:

        def encode(texts: list[str]) -> list[list[int]]:
            return [x.ids for x in tokenizer.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]

    return Vocabulary(encode, table)


@cache
def pieces(path: str) -> Vocabulary:
    """A model of the sentencepiece library, which adds the leading space itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        table.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode())

    def encode(texts: list[str]) -> list[list[int]]:
        return model.encode(texts, num_threads=1)

    return Vocabulary(encode, table)


def aligned(texts: list[str | None], first: Vocabulary, second: Vocabulary) -> Iterator[Aligned | None]:
    """Each text's alignment; None for texts without tokens."""
    given = [x for x in texts if x]
    ids = iter(zip(given, first.encode(given), second.encode(given), strict=True)) if given else iter(())
    for x in texts:
        if not x:
            yield None
            continue
        text, a, b = next(ids)
        whole = (" " + text).encode()
        if b"".join(map(first.table.__getitem__, a)) != whole or b"".join(map(second.table.__getitem__, b)) != whole:
            yield None
            continue
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        size_a, size_b = first.sizes[a], second.sizes[b]
        if not size_a.all() or not size_b.all():  # a token without bytes overlaps nothing
            yield Aligned(a[size_a > 0], b[size_b > 0], size_a[size_a > 0], size_b[size_b > 0])
        else:
            yield Aligned(a, b, size_a, size_b)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of rows of about ``SLICE_BYTES`` of text, with the place of the first."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = int(sizes[start - 1]) if start else 0
        stop = max(start + 1, bisect_left(sizes, before + SLICE_BYTES))
        yield start, texts.slice(start, stop - start).to_pylist()
        start = stop


def groups(docs: DataFrame, key: str, text: str, first_path: str, second_path: str) -> DataFrame:
    """(key, a_ids, b_ids, a_ends, b_ends, link_a, link_b): the alignment of each document.

    ``a_ends`` and ``b_ends`` say after how many tokens each group ends; ``link_a`` and
    ``link_b`` are the places of linked tokens. Documents without tokens have empty lists.
    """
    columns = ["a_ids", "b_ids", "a_ends", "b_ends", "link_a", "link_b"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(first_path), pieces(second_path)
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                rows = [[], [], [], [], [], []]
                for x in aligned(texts, first, second):
                    parts = (x.a, x.b, x.group_a, x.group_b, x.link_a, x.link_b) if x else [np.empty(0, np.int64)] * 6
                    for row, part in zip(rows, parts, strict=True):
                        row.append(part)
                lists = [pa.array(x, pa.list_(pa.int64())).cast(pa.list_(pa.int32())) for x in rows]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *lists], [key, *columns])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{c} array<int>" for c in columns)
    return docs.select(key, text).mapInArrow(found, schema)


@cache
def _written(first_path: str, second_path: str) -> list[str]:
    """Each id in decimal with each of the signs that may follow: first the one table, then the other."""
    sides = ((byte_level(first_path), ",|"), (pieces(second_path), ",;"))
    return [f"{k}{sign}" for side, signs in sides for k in range(len(side.table)) for sign in signs]


def _shown(x: Aligned, written: list[str], second: int) -> str:
    """``a1,a2|b1;a3|b2,b3``: the groups in order; ``second`` is where the second ids begin."""
    last_a, last_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
    last_a[x.group_a - 1] = last_b[x.group_b - 1] = 1
    group_of_a, group_of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    at_a = np.arange(len(x.a)) + np.append(0, x.group_b)[group_of_a]
    at_b = np.arange(len(x.b)) + x.group_a[group_of_b]
    code = np.empty(len(x.a) + len(x.b), np.int64)
    code[at_a] = 2 * x.a + last_a
    code[at_b] = second + 2 * x.b + last_b
    return "".join(map(written.__getitem__, code.tolist()))[:-1]


_BLOCK = (
    "block bigint, keys binary, counts binary, links binary, docs array<struct<key:{kind},n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>"
)


def blocks(docs: DataFrame, key: str, text: str, first_path: str, second_path: str) -> DataFrame:
    """Blocks of aligned documents: their figures, links, and different pairs with counts.

    ``keys`` are the different pairs of ids of a block (64-bit), ``counts`` how many links
    of the block are such (32-bit), ``links`` for each link the place of its pair in
    ``keys`` (32-bit, compressed), in the order of the documents. The block numbers hold
    for one run of the query, so the result is to be written before it is used.
    """
    kind = docs.schema[key].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyspark import TaskContext

        schema = None
        number = TaskContext.get().partitionId() << 32
        first, second = byte_level(first_path), pieces(second_path)
        shown_as = _written(first_path, second_path)
        rows, pairs, held = [], [], 0

        def block() -> pa.RecordBatch:
            found = pa.array(np.concatenate(pairs) if pairs else np.empty(0, np.int64)).dictionary_encode()
            places = found.indices.to_numpy()
            keys = found.dictionary.to_numpy()
            counts = np.bincount(places, minlength=len(keys)).astype("<i4")
            links = zstandard.ZstdCompressor(level=1).compress(places.astype("<i4").tobytes())
            values = [[number], [keys.astype("<i8").tobytes()], [counts.tobytes()], [links], [rows]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, schema, strict=True)], ["block", "keys", "counts", "links", "docs"])

        for batch in batches:
            ids = batch.column(0)
            if schema is None:
                doc = pa.struct([("key", ids.type), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string())])
                schema = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(doc)]
            for start, texts in _slices(batch.column(1)):
                for k, x in zip(ids.slice(start, len(texts)).to_pylist(), aligned(texts, first, second), strict=True):
                    if x is None:
                        rows.append({"key": k, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""})
                        continue
                    if held and held + len(x.link_a) > BLOCK_LINKS:
                        yield block()
                        number += 1
                        rows, pairs, held = [], [], 0
                    shown = hashlib.sha256(_shown(x, shown_as, 2 * len(first.table)).encode()).hexdigest()
                    rows.append({"key": k, "n_a": len(x.a), "n_b": len(x.b), "n_groups": len(x.group_a), "n_links": len(x.link_a), "groups_sha256": shown})
                    pairs.append(x.pairs())
                    held += len(x.link_a)
        if rows:
            yield block()

    return docs.select(key, text).mapInArrow(packed, _BLOCK.format(kind=kind))


def _pairs(found: DataFrame) -> DataFrame:
    """(block, pair, n): the different pairs of each block."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                pair, n = np.frombuffer(keys, "<i8"), np.frombuffer(counts, "<i4").astype(np.int64)
                where = pa.array(np.full(len(pair), block, np.int64))
                for at in range(0, len(pair), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([where[part], pa.array(pair[part]), pa.array(n[part])], ["block", "pair", "n"])

    return found.select("block", "keys", "counts").mapInArrow(unpacked, "block bigint, pair bigint, n bigint")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, n, best): how often ids are linked in all blocks.

    ``best`` tells that no other id is linked with the second one more often.
    """
    totals = _pairs(found).groupBy("pair").agg(F.sum("n").alias("n"))
    totals = totals.select("pair", (F.col("pair") % PAIR).cast("int").alias("a_id"), F.floor(F.col("pair") / PAIR).cast("int").alias("b_id"), "n")
    highest = totals.groupBy("b_id").agg(F.max("n").alias("highest"))
    return totals.join(highest, "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("highest")).alias("best"))


def link_figures(found: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row a document.

    ``found`` is a written table of ``blocks``, ``counts`` of ``pair_counts``.
    """
    kind = found.schema["docs"].dataType.elementType["key"].dataType.simpleString()
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, keys, links = (left.column(c)[0] for c in ("docs", "keys", "links"))
        docs = docs.values
        figures = {c: docs.field(c).to_numpy(zero_copy_only=False) for c in columns[:4]}
        order = np.argsort(pair := right.column("pair").to_numpy())
        at = order[np.searchsorted(pair, np.frombuffer(keys.as_py(), "<i8"), sorter=order)] if len(pair) else order
        n, best = right.column("n").to_numpy()[at], right.column("best").to_numpy()[at].astype(np.int64)
        places = np.frombuffer(zstandard.ZstdDecompressor().decompress(links.as_py()), "<i4")
        ends = np.append(0, np.cumsum(figures["n_links"]))
        for name, values in (("n_best", best), ("count_sum", n)):
            sums = np.append(0, np.cumsum(values[places]))
            figures[name] = sums[ends[1:]] - sums[ends[:-1]]
        return pa.table([docs.field("key"), *[pa.array(figures[c]) for c in columns], docs.field("groups_sha256")], [key, *columns, "groups_sha256"])

    known = _pairs(found).select("block", "pair").join(counts.select("pair", "n", "best"), "pair")
    schema = f"`{key}` {kind}, " + ", ".join(f"{c} bigint" for c in columns) + ", groups_sha256 string"
    held = found.select("block", "keys", "links", "docs")
    return held.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(summed, schema)

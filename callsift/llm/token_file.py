"""Token ids in files of variable-length bytes with separate control bytes.

Ids are replaced by their frequency rank, so common ids take one byte. Each rank is
stored in one to four bytes; the lengths of four ranks share a control byte, and
control bytes stand apart from data bytes, so a block is decoded with table lookups:
a control byte gives four lengths, and a running sum gives the places of the bytes.

A folder holds ``ranks.bin`` (the id of each rank, 32-bit) and data files. A file is
a run of blocks; a block holds whole documents: a header (magic, documents, ids,
data bytes), a bit a document that it has an id, document ids, lengths, control bytes
and data bytes. Files in order of
their names, and documents in files, ascend by document id; ids of the same value
keep the order in which they were sorted.

Null texts are empty. Every document ends with the end id, so none is without ids.
"""

from __future__ import annotations

import posixpath
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from callsift.llm.byte_bpe import Pieces
from callsift.llm.warc import Files, FilesWriter, listed, opened

MAGIC = b"RVB2"
#: Ids of a block, unless one document has more.
BLOCK_IDS = 1 << 18
PARTITION_BYTES = 32 << 20
_HEADER = struct.Struct("<4sIQQ")

_CODES = np.arange(256)
#: Lengths of the four values of each control byte.
LENGTHS = np.stack([(_CODES >> (2 * k) & 3) + 1 for k in range(4)], axis=1).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    raw = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The values of ``pack``."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.zeros((n, 4), np.uint8)
    raw[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return raw.reshape(-1).view("<u4")


#: Bytes of new chunks that the library gets as one text.
_TOGETHER = 16 << 10
#: Chunks of a generation of the cache. The library takes far longer for a chunk than a
#: lookup, and a worker's texts bring new words for long: two generations of this many
#: chunks of at most ``byte_bpe.LONG`` bytes stay near 120 MB a worker.
CACHED = 300_000


class Library(Pieces):
    """The tokenizers library behind the cache of chunks.

    New chunks are put together to texts, as the library works on each call and each result
    far longer than on a chunk. The ids of a chunk are told by the bytes of tokens.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        super().__init__(pattern, None, CACHED)
        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        #: Strings that the library takes for tokens of their own before it splits a text.
        self._added = [x.content for x in added.values()]
        tokens = self._tokenizer.get_vocab(with_added_tokens=False)
        self._size = np.zeros(max(tokens.values(), default=-1) + 1, np.int64)
        for token, k in tokens.items():
            self._size[k] = len(token)  # a character stands for each byte

    def _alone(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<i4").tobytes() for x in found]

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks; those that begin and end plainly are encoded after one another."""
        out: list[bytes | None] = [None] * len(chunks)
        plain = [k for k, x in enumerate(chunks) if len(x) > 1 and x[0] == 0x20 and 0x20 < x[1] < 0x7F and 0x20 < x[-1] < 0x7F]
        ends = np.cumsum([len(chunks[k]) for k in plain])
        cuts = [0, *np.flatnonzero(np.diff(ends // _TOGETHER)) + 1, len(plain)]
        groups = [plain[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
        texts = [b"".join([chunks[k] for k in some]).decode() for some in groups]
        for some, text, found in zip(groups, texts, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<i4")
            at = np.cumsum(self._size[ids])
            ends = np.cumsum([len(chunks[k]) for k in some])
            last = np.searchsorted(at, ends)
            # Where tokens don't end with the chunks, each chunk is encoded alone.
            if any(x in text for x in self._added) or last[-1] != len(ids) - 1 or (at[last] != ends).any():
                continue
            raw, stops = ids.tobytes(), (4 * (last + 1)).tolist()
            for k, a, b in zip(some, [0, *stops], stops, strict=False):
                out[k] = raw[a:b]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(rest, self._alone([chunks[k].decode() for k in rest]), strict=True):
            out[k] = ids
        return out

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text; texts with added tokens go to the library whole."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        marks = [pc.fill_null(pc.match_substring(texts, x), False).to_numpy(zero_copy_only=False) for x in self._added]
        marked = np.flatnonzero(np.logical_or.reduce(marks)) if marks else np.empty(0, np.int64)
        if not len(marked):
            return super().encode(texts)
        whole = dict(zip(marked.tolist(), self._alone(texts.take(pa.array(marked)).to_pylist()), strict=True))
        rest = iter(super().encode(texts.filter(pa.array(~np.isin(np.arange(len(texts)), marked)))))
        return [whole[k] if k in whole else next(rest) for k in range(len(texts))]


@cache
def _library(path: str, pattern: str) -> Library:
    """One a worker process."""
    return Library(path, pattern)


def encode(text: Column | str, path: str, pattern: str, end_id: int) -> Column:
    """Compressed little-endian ids of each text and the end id, by the tokenizers library.

    The library encodes each different chunk of a batch; a text's ids are those of its
    chunks. Added tokens of the file are found in texts as the library does
    when loaded: their strings give their ids.
    """

    @F.arrow_udf("binary")
    def encoded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library, last = _library(path, pattern), np.array([end_id], "<i4")
        small = zstandard.ZstdCompressor(level=3)
        for texts in parts:
            out = []
            for ids in library.encode(texts):
                values = np.append(np.frombuffer(ids, "<i4"), last).astype("<u4")
                narrow = values.astype("<u2") if not len(values) or values.max() <= 0xFFFF else values
                out.append(bytes([narrow.itemsize]) + small.compress(narrow.tobytes()))
            yield pa.array(out, pa.binary())

    return encoded(text)


def unfold(blob: bytes) -> np.ndarray:
    """Ids of an ``encode`` value."""
    raw = zstandard.ZstdDecompressor().decompress(blob[1:])
    return np.frombuffer(raw, "<u2" if blob[0] == 2 else "<u4").astype(np.uint32)


def _added(total: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """Counts of ids with those of some more."""
    here = np.bincount(np.concatenate([np.empty(0, np.uint32), *parts]), minlength=len(total))
    here[: len(total)] += total
    return here


def frequencies(encoded: DataFrame, column: str) -> DataFrame:
    """(id, n): how often each id stands in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            some, held = [], 0
            for blob in batch.column(0):
                some.append(unfold(blob.as_py()))
                held += len(some[-1])
                if held >= BLOCK_IDS:
                    total, some, held = _added(total, some), [], 0
            total = _added(total, some)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    partial = encoded.select(column).mapInArrow(count, "id bigint, n bigint")
    return partial.groupBy("id").agg(F.sum("n").alias("n"))


def ranked(counts: DataFrame) -> np.ndarray:
    """Ids by falling frequency; as many as the vocabulary has used ids, at most."""
    rows = counts.orderBy(F.desc("n"), "id").collect()
    return np.array([row["id"] for row in rows], "<u4")


@cache
def _ranks(folder: str) -> np.ndarray:
    fs, path = opened(folder)
    with fs.open_input_stream(posixpath.join(path, "ranks.bin"), compression=None) as file:
        return np.frombuffer(file.read(), "<u4")


class TokenWriter(FilesWriter):
    """Rows (doc_id, blob), sorted within partitions that ascend, to one file each."""

    suffix = ".rvb"

    def name(self) -> str:
        """Names sort as partitions do."""
        from pyspark import TaskContext

        context = TaskContext.get()
        return f"{self.job}-{context.partitionId():08d}-{context.taskAttemptId():012d}{self.suffix}"

    def rows_to(self, rows: Iterator, out) -> None:
        ids = _ranks(self.folder)
        rank = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
        rank[ids] = np.arange(len(ids))
        keys, parts, held = [], [], 0
        for doc_id, blob in rows:
            values = rank[unfold(blob)]
            if keys and held + len(values) > BLOCK_IDS:
                self._block(keys, parts, out)
                keys, parts, held = [], [], 0
            keys.append(doc_id)
            parts.append(values)
            held += len(values)
        self._block(keys, parts, out)

    def _block(self, keys: list, parts: list[np.ndarray], out) -> None:
        values = np.concatenate(parts)
        control, data = pack(values)
        out.write(_HEADER.pack(MAGIC, len(keys), len(values), len(data)))
        out.write(np.packbits([k is not None for k in keys]).tobytes())
        out.write(np.array([k or 0 for k in keys], "<i8").tobytes())
        out.write(np.array([len(x) for x in parts], "<u8").tobytes())
        out.write(control)
        out.write(data)


class TokenReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def partitions(self) -> list[Files]:
        out, some, size = [], [], 0
        for k, info in enumerate(listed(self.folder, (".rvb",))):
            if some and size + info.size > PARTITION_BYTES:
                out.append(Files(tuple(some)))
                some, size = [], 0
            some.append(f"{k}:{info.path}")
            size += info.size
        return [*out, Files(tuple(some))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.folder)
        ids = _ranks(self.folder)
        for numbered in partition.paths:
            k, _, path = numbered.partition(":")
            place = 0
            with fs.open_input_file(path) as file:
                while head := file.read(_HEADER.size):
                    magic, docs, n, size = _HEADER.unpack(head)
                    if magic != MAGIC:
                        raise ValueError(f"not a token file: {path}")
                    known = np.unpackbits(np.frombuffer(file.read(-(-docs // 8)), np.uint8), count=docs)
                    keys = pa.array(np.frombuffer(file.read(8 * docs), "<i8"), mask=known == 0)
                    lengths = np.frombuffer(file.read(8 * docs), "<u8").astype(np.int64)
                    values = ids[unpack(file.read(-(-n // 4)), file.read(size), n)]
                    yield _documents(int(k), place, keys, lengths, values)
                    place += docs


def _documents(file: int, place: int, keys: pa.Array, lengths: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """The documents of a block; ids as little-endian bytes."""
    ends = np.append(0, np.cumsum(lengths))
    raw = values.astype("<u4").tobytes()
    blobs = [raw[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    n = len(keys)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, file, np.int32)),
            pa.array(np.arange(place, place + n, dtype=np.int64)),
            keys,
            pa.array(lengths),
            pa.array(blobs, pa.binary()),
        ],
        ["file", "place", "doc_id", "n_tokens", "ids"],
    )


class TokenSource(DataSource):
    """Format ``ranked_tokens``: writes (doc_id, blob), reads documents in file order."""

    @classmethod
    def name(cls) -> str:
        return "ranked_tokens"

    def schema(self) -> str:
        return "file int, place bigint, doc_id bigint, n_tokens bigint, ids binary"

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options)

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options)


def write(encoded: DataFrame, key: str, column: str, folder: str, files: int) -> None:
    """Writes an ``encode`` column as files in ascending order of an integer key.

    ``encoded`` is read three times (counts, range bounds, rows), so it should be a
    written table. Null keys come first and stay null.
    """
    ids = ranked(frequencies(encoded, column))
    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(posixpath.join(path, "ranks.bin"), compression=None) as out:
        out.write(ids.tobytes())
    encoded.sparkSession.dataSource.register(TokenSource)
    keyed = encoded.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("blob"))
    ordered = keyed.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    ordered.write.format("ranked_tokens").mode("append").save(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(file, place, doc_id, n_tokens, ids): every document; (file, place) is the order."""
    spark.dataSource.register(TokenSource)
    return spark.read.format("ranked_tokens").load(folder)


def starts(read_back: DataFrame) -> DataFrame:
    """``read_back`` with ``start``: ids of all documents before, in the order of the files.

    Sums run within runs of 1,024 documents of a file, then over the runs of a file,
    then over the files.
    """
    from pyspark.sql import Window

    def before(columns: list[str], by: str) -> Window:
        return Window.partitionBy(*columns).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)

    rows = read_back.withColumn("_run", F.floor(F.col("place") / 1024))
    runs = rows.groupBy("file", "_run").agg(F.sum("n_tokens").alias("_n"))
    files = runs.groupBy("file").agg(F.sum("_n").alias("_all"))
    files = files.select("file", F.coalesce(F.sum("_all").over(before([F.lit(0)], "file")), F.lit(0)).alias("_file"))
    runs = runs.join(files, "file").select(
        "file", "_run", (F.col("_file") + F.coalesce(F.sum("_n").over(before(["file"], "_run")), F.lit(0))).alias("_base")
    )
    here = F.coalesce(F.sum("n_tokens").over(before(["file", "_run"], "place")), F.lit(0))
    return rows.withColumn("_here", here).join(runs, ["file", "_run"]).withColumn("start", F.col("_base") + F.col("_here")).drop("_run", "_here", "_base")

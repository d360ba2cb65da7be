"""Byte-level BPE: encoding with a rank queue on a hierarchical bitmap, and decoding.

Merges of one pre-token are taken from buckets, one for each merge rank, that hold
positions of a linked list of tokens. A two-level bitmap marks the ranks whose
bucket is not empty; finding its first set bit gives the next rank. Entries whose
pair has changed since they were put in are skipped. A pre-token of n bytes costs
O(n log n) at worst, so very long ones do no harm.

Most pre-tokens of a corpus repeat. Texts are cut into chunks between single blanks or
line ends, on their bytes; equal chunks are found by a dictionary and encoded once a
run, and short ones are kept in a cache that is bounded in bytes. Patterns must not let
a pre-token reach over such a cut (``chunk_starts``).

Null texts are empty; empty texts have no ids. Texts of any length, ties between
equal ranks (the leftmost pair first) and repeated rows need no special case.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift.llm import texts as T

#: Chunks of a generation of the cache.
CACHED = 60_000
#: Bytes of text, and chunks of it, that are looked up together.
TOGETHER, RUN = 8 << 20, 1 << 19
#: Pre-tokens of more bytes are merged one by one, and chunks of more bytes are not kept.
LONG = 64
_SHIFT = 9


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, get = len(piece), ranks.get
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    pair = [-1] * n
    buckets: dict[int, list[int]] = {}
    marks: dict[int, int] = {}
    top, mask = 0, (1 << _SHIFT) - 1

    def put(rank: int, at: int) -> None:
        nonlocal top
        pair[at] = rank
        bucket = buckets.get(rank)
        if bucket:
            heappush(bucket, at)
            return
        buckets[rank] = [at]
        word = rank >> _SHIFT
        marks[word] = marks.get(word, 0) | 1 << (rank & mask)
        top |= 1 << word

    for at in range(n - 1):
        rank = get(piece[at : at + 2])
        if rank is not None:
            put(rank, at)
    while top:
        word = (top & -top).bit_length() - 1
        low = marks[word]
        rank = word << _SHIFT | (low & -low).bit_length() - 1
        bucket = buckets[rank]
        at = heappop(bucket)
        if not bucket:
            marks[word] = low = low & (low - 1)
            if not low:
                top &= top - 1
        if pair[at] != rank:
            continue
        gone = after[at]
        end = after[at] = after[gone]
        pair[at] = pair[gone] = -1
        if end < n:
            before[end] = at
            rank = get(piece[at : after[end]])
            if rank is not None:
                put(rank, at)
        left = before[at]
        if left >= 0:
            rank = get(piece[left:end])
            if rank is None:
                pair[left] = -1
            else:
                put(rank, left)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Merger:
    """Merges many short pre-tokens at once, with the same queue.

    All pre-tokens share one linked list and one set of buckets. A step takes from
    the bucket of the lowest rank the leftmost position in each pre-token, so each
    pre-token sees its merges in its own order; the others stay in the bucket.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self._ids = max(ranks.values(), default=0) + 1
        self._single = np.full(256, self._ids, np.int64)
        pairs = {}
        for token, rank in ranks.items():
            if len(token) == 1:
                self._single[token[0]] = rank
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * (self._ids + 1) + right] = rank
        self._keys = np.array(sorted(pairs), np.int64)
        self._ranks = np.array([pairs[x] for x in self._keys.tolist()] or [-1], np.int64)
        self._keys = np.append(self._keys, np.iinfo(np.int64).max)
        self._ranks = np.append(self._ranks, -1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make, or -1."""
        key = left * (self._ids + 1) + right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers."""
        if not pieces:
            return []
        size = np.array([len(x) for x in pieces], np.int64)
        token = self._single[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(token)
        token = np.append(token, self._ids)  # position n stands for no token
        word = np.repeat(np.arange(len(pieces)), size)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        last = np.cumsum(size)[size > 0]
        after[last - 1] = n
        before[np.append(0, last[:-1])] = n
        pair = np.append(self._rank(token[:n], token[after[:n]]), -1)
        alive = np.ones(n, bool)
        buckets: dict[int, list[np.ndarray]] = {}
        marks: dict[int, int] = {}
        top, mask = 0, (1 << _SHIFT) - 1

        def put(at: np.ndarray) -> None:
            nonlocal top
            order = np.argsort(pair[at], kind="stable")
            at = at[order]
            rank = pair[at]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for some, r in zip(np.split(at, cuts), rank[np.append(0, cuts)].tolist(), strict=True):
                if r in buckets:
                    buckets[r].append(some)
                    continue
                buckets[r] = [some]
                marks[r >> _SHIFT] = marks.get(r >> _SHIFT, 0) | 1 << (r & mask)
                top |= 1 << (r >> _SHIFT)

        first = np.flatnonzero(pair >= 0)
        if len(first):
            put(first)
        while top:
            group = (top & -top).bit_length() - 1
            low = marks[group]
            rank = group << _SHIFT | (low & -low).bit_length() - 1
            marks[group] = low = low & (low - 1)
            if not low:
                top &= top - 1
            some = buckets.pop(rank)
            at = np.unique(np.concatenate(some)) if len(some) > 1 else some[0]
            at = at[pair[at] == rank]
            if not len(at):
                continue
            here = word[at]
            lead = np.append(True, here[1:] != here[:-1])
            later, at = at[~lead], at[lead]
            gone = after[at]
            end = after[gone]
            token[at] = rank
            after[at] = end
            before[end] = at
            alive[gone] = False
            pair[gone] = -1
            pair[at] = self._rank(token[at], token[end])
            left = before[at]
            left = left[left < n]
            pair[left] = self._rank(token[left], token[after[left]])
            new = np.concatenate((later, at, left))
            new = new[pair[new] >= 0]
            if len(new):
                put(new)
        out = token[:n][alive].astype("<i4").tobytes()
        ends = (np.cumsum(np.bincount(word[alive], minlength=len(pieces))) * 4).tolist()
        return [out[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


#: White space of more than one byte in UTF-8.
_WIDE = [chr(x).encode() for x in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_NARROW = np.zeros(256, bool)
_NARROW[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: Letters, digits and other visible characters of ASCII; the apostrophe is of no kind.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = [0 if x == "'" else 1 if x.isalpha() else 2 if x.isdigit() else 3 for x in map(chr, range(0x21, 0x7F))]


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes are part of white space."""
    space = _NARROW[data]
    for lead in {x[0] for x in _WIDE}:
        at = np.flatnonzero(data == lead)
        for x in _WIDE if len(at) else ():
            if x[0] == lead:
                here = at[at + len(x) <= len(data)]
                for k in range(1, len(x)):
                    here = here[data[here + k] == x[k]]
                for k in range(len(x)):
                    space[here + k] = True
    return space


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the chunks of some texts begin, given as UTF-8 bytes and offsets.

    Texts are cut before a single blank or line end that stands between characters
    that are no white space, and between ASCII characters of different kinds. There a
    pre-token ends, for patterns whose pre-tokens hold letters, digits or others, at most
    one blank and no line end before them, and letters after an apostrophe: chunks can
    be encoded alone.
    """
    first = np.zeros(len(data), bool)
    if len(data) > 2:
        space = _spaces(data)
        middle = data[1:-1]
        first[1:-1] = ((middle == 0x20) | (middle == 0x0A)) & ~space[:-2] & ~space[2:]
        kind = _KIND[data]
        first[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(first)


class Pieces:
    """Ids of whole texts, put together from those of their chunks.

    ``merge`` turns a list of pre-tokens into their ids, as bytes. Each different chunk
    of a run of chunks is looked up once. The cache has two generations of ``cached``
    chunks and those of one run, of ``LONG`` bytes at most: when the younger one is full it
    becomes the older one, whose chunks go unless they are met again.
    """

    def __init__(self, pattern: str, merge, cached: int = CACHED):
        self._find = regex.compile(pattern).findall
        self._merge, self._cached = merge, cached
        self._now: dict[bytes, bytes] = {}
        self._was: dict[bytes, bytes] = {}

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks that are not known."""
        found = [self._find(x.decode()) for x in chunks]
        pieces = list({x for some in found for x in some})
        of = dict(zip(pieces, self._merge(pieces), strict=True)).__getitem__
        return [of(some[0]) if len(some) == 1 else b"".join(map(of, some)) for some in found]

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each of some different chunks."""
        found = list(map(self._now.get, chunks))
        missed = [k for k, x in enumerate(found) if x is None]
        for k in missed:
            found[k] = self._was.get(chunks[k])
        new = [k for k in missed if found[k] is None]
        if new:
            for k, ids in zip(new, self.learn([chunks[k] for k in new]), strict=True):
                found[k] = ids
        fresh = [(chunks[k], found[k]) for k in missed if len(chunks[k]) <= LONG][: self._cached]
        if len(self._now) + len(fresh) > self._cached:
            self._was, self._now = self._now, {}
        self._now.update(fresh)
        return found

    def _run(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of chunks, and how many each has."""
        coded = chunks.dictionary_encode()
        found = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, found), np.int32, len(found)) // 4
        which = coded.indices.to_numpy()
        each = size[which]
        ends = np.cumsum(each, dtype=np.int32)
        shift = (np.cumsum(size, dtype=np.int32) - size)[which] - (ends - each)
        return np.frombuffer(b"".join(found), "<i4")[np.repeat(shift, each) + np.arange(ends[-1], dtype=np.int32)], each

    def flat(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of the texts, one after another: all ids, and how many each text has."""
        for some in T.slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", TOGETHER):
            data, offsets = T.flat(some.column(0))
            starts = chunk_starts(data, offsets)
            ends = np.append(starts, len(data)).astype(np.int32)
            chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            runs = [self._run(chunks.slice(a, RUN)) for a in range(0, len(starts), RUN)]
            before = np.append(0, np.cumsum(np.concatenate([np.empty(0, np.int64), *[n for _, n in runs]])))
            yield (
                np.concatenate([np.empty(0, "<i4"), *[ids for ids, _ in runs]]),
                np.diff(before[np.searchsorted(starts, offsets)]),
            )

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        out: list[bytes] = []
        for ids, sizes in self.flat(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())):
            raw, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
            out += [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out


class Encoder:
    """Encodes by the ranks of a file, each match of a pattern by itself."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self._short = Merger(self.ranks)
        self.pieces = Pieces(pattern, self._merge)

    def _merge(self, pieces: list[str]) -> list[bytes]:
        out, short = [b""] * len(pieces), {}
        for k, piece in enumerate(x.encode() for x in pieces):
            if len(piece) > LONG or piece in self.ranks:
                out[k] = np.array(merge(piece, self.ranks), "<i4").tobytes()
            else:
                short[k] = piece
        for k, ids in zip(short, self._short.merge([*short.values()]), strict=True):
            out[k] = ids
        return out

    def encode(self, texts: list[str | None] | pa.Array) -> pa.Array:
        """A list of ids for each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        found = [*self.pieces.flat(texts)]
        return lists([ids for ids, _ in found], [n for _, n in found])


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of base64 lines."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def lists(ids: list[np.ndarray], sizes: list[np.ndarray]) -> pa.Array:
    """Lists of 32-bit integers from all values and the lengths of the lists, both in parts."""
    ends = np.append(0, np.cumsum(np.concatenate([np.empty(0, np.int64), *sizes]))).astype(np.int32)
    values = pa.array(np.concatenate([np.empty(0, np.int32), *ids]), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends), values)


@cache
def _encoder(path: str, pattern: str) -> Encoder:
    """One encoder a worker process; its cache serves all tasks."""
    return Encoder(path, pattern)


@cache
def _tokens(path: str) -> list[bytes]:
    """Bytes of each id."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def list_sizes(values: pa.Array) -> np.ndarray:
    """Length of each list; null has none."""
    return pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def encode(text: Column | str, path: str, pattern: str) -> Column:
    """Ids of a text column, by the rank file at ``path``: ``array<int>``.

    Null and empty texts give an empty array. No special tokens are added or known.
    """

    @F.arrow_udf("array<int>")
    def encoded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path, pattern)
        for texts in parts:
            yield encoder.encode(texts)
        T.give_back()

    return encoded(text)


def decode(ids: Column | str, path: str) -> Column:
    """The bytes that a column of ids stands for; null gives no bytes, unknown ids raise."""

    @F.arrow_udf("binary")
    def decoded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = _tokens(path).__getitem__
        for lists_ in parts:
            yield _decoded(lists_, of)
        T.give_back()

    return decoded(ids)


def _decoded(lists_: pa.Array, of) -> pa.Array:
    """The bytes of each list of ids, by ``of`` from an id to its bytes."""
    values, ends = lists_.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(list_sizes(lists_)))
    found = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        # Some ids at a time, as each is a Python integer for a moment.
        found.append(b"".join([b"".join(map(of, values[k : min(k + RUN, b)].tolist())) for k in range(a, b, RUN)]))
    return pa.array(found, pa.binary())


def round_trip(text: Column | str, path: str, pattern: str) -> Column:
    """``encode`` and then ``decode`` in one worker: ``struct<ids array<int>, bytes binary>``.

    The same as the two columns one after another, without a second Python worker on
    each core that holds a table of the ranks of its own.
    """

    @F.arrow_udf("ids array<int>, bytes binary")
    def both(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from trips(parts, path, pattern)

    return both(text)


def trips(parts: Iterator[pa.Array], path: str, pattern: str) -> Iterator[pa.StructArray]:
    """``round_trip`` for batches of texts; when they end, the worker gives back its free memory.

    The encoder and its cache stay for the next task.
    """
    encoder, of = _encoder(path, pattern), _tokens(path).__getitem__
    for texts in parts:
        ids = encoder.encode(texts)
        yield pa.StructArray.from_arrays([ids, _decoded(ids, of)], ["ids", "bytes"])
    T.give_back()

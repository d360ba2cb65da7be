"""The parts of the training-data operators that need no Spark."""

import collections
import os
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from callsift.llm import byte_bpe, decision_list, doc_stats, jaccard_join, suffix_dedup, texts, token_file
from callsift.llm.jaccard_join import Fraction

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    "", "a", "  a", " a", "a ", "\n", "a\n\nb", "a \nb", "\na", "a\tb c", "a\r\nb", "it's 'tis\x1cx", "\x00 a\x00",
    "é x y", "<|endoftext|> x", "'" * 300, "a" * 3000, "ab" * 2000, "²Ⅷ 12½", "😀 😀😀", "x" * 50 + " " * 40 + "y",
]


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def _mess(n: int, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("ab  \n\t'sré1²!? \x1c\x0b\0") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_bpe_equals_the_library(encoder):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    some = [*ODD, *_mess(3000), None]
    for x, ids in zip(some, encoder.encode(some), strict=True):
        assert library.encode_ordinary(x or "") == ids.as_py()


def test_bpe_of_wide_blanks_and_mixed_kinds(encoder):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    rng = random.Random(11)
    alphabet = "ab1' '\n.(\x85\xa0\u1680\u2003\u202f\u3000\u3001éÁ中😀'st"
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    for x, ids in zip(some, encoder.encode(some), strict=True):
        assert library.encode_ordinary(x) == ids.as_py(), repr(x)


def test_a_text_of_twenty_megabytes(encoder):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(5000)]
    x = " ".join(rng.choice(words) for _ in range(3_600_000))
    assert len(x) > 20_000_000 and library.encode_ordinary(x) == encoder.encode(["", x, "a"])[1].as_py()


def test_one_by_one_and_together_agree(encoder):
    pieces = [x.encode() for x in ("the", "ababababab", "ééé", "aaaaaaaaaaa", "q", " hello", "antidisestablishment")]
    together = encoder._short.merge([x for x in pieces if x not in encoder.ranks])
    alone = [np.array(byte_bpe.merge(x, encoder.ranks), "<i4").tobytes() for x in pieces if x not in encoder.ranks]
    assert together == alone


def test_cache_bound_changes_nothing(encoder):
    small = byte_bpe.Pieces(public_tokenizers.PATTERN, encoder._merge, cached=3)
    some = _mess(50)
    assert [small.encode([x])[0] for x in some] == encoder.pieces.encode(some)


def test_cache_stays_within_its_bound_after_a_run_of_new_chunks(encoder):
    small = byte_bpe.Pieces(public_tokenizers.PATTERN, encoder._merge, cached=3)
    some = _mess(200)
    assert small.encode(some) == encoder.pieces.encode(some)
    assert len(small._now) <= 3 and len(small._was) <= 3


def test_pieces_equal_whole_texts_of_the_tokenizers_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    some = [*ODD, *_mess(1000), "a <|endoftext|> b", "<|endoftext|>" * 2 + "x", " <|endoftext|"]
    for x, ids in zip(some, token_file._library(path, public_tokenizers.PATTERN).encode(some), strict=True):
        assert whole.encode(x, add_special_tokens=False).ids == np.frombuffer(ids, "<i4").tolist()


def test_library_keeps_a_run_of_more_new_chunks_than_the_encoder_does():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = token_file.Library(path, public_tokenizers.PATTERN)
    words = " ".join("".join(chr(97 + k // 26**j % 26) for j in range(4)) for k in range(100_000))
    first = library.encode([words])
    learned = []
    library.learn = lambda chunks: learned.append(len(chunks)) or token_file.Library.learn(library, chunks)
    assert library.encode([words]) == first
    assert not learned


@pytest.mark.parametrize("top", [1, 200, 70_000, 2**24 + 5, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 3, 4, 1001])
def test_packed_values_come_back(top, n):
    values = np.random.default_rng(n).integers(0, top, n, endpoint=True).astype(np.uint32)
    control, data = token_file.pack(values)
    assert len(control) == -(-n // 4)
    assert (token_file.unpack(control, data, n) == values).all()


def _stats(x: str) -> dict[str, int]:
    words = WORD.findall(x)
    threes = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {k + j for k in range(len(words) - 2) if threes[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [line for line in x.split("\n") if WORD.search(line)]
    return {
        "n_chars": len(x),
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(x.count(s) for s in "#*$%&|<>"),
        "n_repeat_words": len(inside),
        "n_distinct_words": len(set(words)),
        "n_echo_words": sum(a == b for a, b in zip(words, words[1:], strict=False)),
        "n_dup_lines": len(lines) - len(set(lines)),
    }


def test_counts_of_documents():
    rng = random.Random(5)
    some = [*ODD, *_mess(300)]
    some += [" ".join(rng.choice("a b c #x é|".split()) + rng.choice(["", "\n"]) for _ in range(40)) for _ in range(200)]
    found = doc_stats.counts(pa.array([*some, None]))
    for k, x in enumerate([*some, ""]):
        assert {name: int(found[name][k]) for name in _stats(x)} == _stats(x), repr(x)


def test_shingle_sets():
    some = ["", "  ", "A b", "a B", "a b c d e f a b c d e f", "é É"]
    sets = list(texts.shingle_sets(pa.array(some)))
    assert [len(x) for x in sets] == [0, 0, 1, 1, 6, 1]
    assert (sets[2] == sets[3]).all()


def test_similar_sets_share_a_prefix_token_under_any_order():
    t = Fraction(3, 4)
    for n in range(1, 60):
        p = jaccard_join.prefix_length(n, t)
        assert 1 <= p <= n
        # a similar set leaves out at most n - ceil(t n) tokens of this one
        assert n - p < -(-t.numerator * n // t.denominator)


def _repeated(group: list[bytes], length: int) -> list[set[int]]:
    seen = collections.Counter(x[p : p + length] for x in group for p in range(len(x) - length + 1))
    return [{p for p in range(len(x) - length + 1) if seen[x[p : p + length]] > 1} for x in group]


@pytest.mark.parametrize("by_rank", [False, True])
def test_repeats_equal_brute_force(monkeypatch, by_rank):
    if by_rank:
        monkeypatch.setattr(suffix_dedup, "_SORT_BYTES", 0)
    rng = random.Random(8)
    for _ in range(150):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))) for _ in range(4)]
        groups = [
            [b"".join(rng.choice(parts) for _ in range(rng.randint(5, 12))).ljust(5, b"z") for _ in range(rng.randint(1, 4))]
            for _ in range(2)
        ]
        for group, found in zip(groups, suffix_dedup.repeated_windows(groups, 5), strict=True):
            assert [{p for a, b in x for p in range(a, b)} for x in found] == _repeated(group, 5)


def test_runs_cover_every_window_once():
    rng = random.Random(2)
    some = [bytes(rng.choice(b"abcd") for _ in range(n)) for n in (0, 10, 39, 40, 41, 500)] + [b"xy" * 300]
    data = np.frombuffer(b"".join(some), np.uint8)
    offsets = np.append(0, np.cumsum([len(x) for x in some]))
    found = suffix_dedup.runs(data, offsets, 40, 10)
    held = collections.defaultdict(list)
    for i, a, n in zip(found.text, found.start, found.windows, strict=True):
        held[int(i)] += range(a, a + n)
    for i, x in enumerate(some):
        assert held[i] == list(range(max(len(x) - 39, 0)))
    for i, a, n, flag in zip(found.text, found.start, found.windows, found.repeats, strict=True):
        run = some[i][a : a + n + 39]
        assert flag or len({run[k : k + 40] for k in range(n)}) == n


def test_rules_tell_junk_from_prose():
    rng = np.random.default_rng(1)
    n = 3000
    bad = rng.random(n) < 0.15
    kind = rng.random(n) < 0.5
    values = {
        "symbols": np.where(bad & kind, rng.uniform(0.5, 1, n), rng.uniform(0, 0.2, n)),
        "upper": np.where(bad & ~kind, rng.uniform(0.6, 1, n), rng.uniform(0, 0.1, n)),
        "noise": rng.random(n),
    }
    rules = decision_list.learn_rules(values, bad)
    gone = np.logical_or.reduce([decision_list.covers(r, values) for r in rules])
    assert (gone == bad).mean() > 0.995
    assert decision_list.learn_rules(values, np.zeros(n, bool)) == []
    assert decision_list.learn_rules({"x": np.zeros(0)}, np.zeros(0, bool)) == []


def test_workers_give_back_free_memory_when_a_tasks_batches_end(monkeypatch):
    """Pipeline stages share Python workers; each hands back what it keeps free once its rows end."""
    given: list[int] = []
    seen: list[int] = []
    monkeypatch.setattr(texts, "give_back", lambda: given.append(len(seen)))
    parts = [pa.array(["a b c a b c x", None]), pa.array(["", "Hello world 123 \u00e9"])]

    def watched():
        for x in parts:
            seen.append(1)
            yield x

    described = list(doc_stats.counted(watched()))
    assert given == [2]
    for got, texts_ in zip(described, parts, strict=True):
        assert got.field("n_words").to_pylist() == doc_stats.counts(texts_)["n_words"].tolist()
    seen.clear()
    trips = list(byte_bpe.trips(watched(), RANKS, public_tokenizers.PATTERN))
    assert given == [2, 2]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    for got, texts_ in zip(trips, parts, strict=True):
        assert got.field("ids").to_pylist() == [library.encode(x or "") for x in texts_.to_pylist()]
        assert got.field("bytes").to_pylist() == [(x or "").encode() for x in texts_.to_pylist()]


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

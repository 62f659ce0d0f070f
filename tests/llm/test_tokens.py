"""Operators 2, 3 and 4 against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from photospark.llm import bpe_codec, packing, token_counts
from photospark.llm.bytepair import Cache, PreTokens, vocabulary


@pytest.fixture(scope="module")
def library(tokenizer):
    t = Tokenizer.from_file(tokenizer)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids, t


def strange(n=3000):
    r = random.Random(5)
    letters = list("ab's' \n\t1é²!<|>rvelm日  ")
    return ["".join(r.choice(letters) for _ in range(r.randrange(30))) for _ in range(n)]


def test_counts_and_ids_of_strange_texts(tokenizer, library):
    texts = strange()
    want = [library[0](t) for t in texts]
    assert token_counts.counts(texts, tokenizer).tolist() == [len(x) for x in want]
    ids, at = bpe_codec.pieces(tokenizer).encode_texts(texts, vocabulary(tokenizer))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def thue_morse(a, b, n):
    """Words of two letters whose patterns cancel out in polynomials modulo 2^64."""
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans({a: b, b: a}))
    return word


def test_patterns_that_cancel_out(tokenizer, library):
    texts = [thue_morse("e", "r", 2048), thue_morse("r", "e", 2048), thue_morse("a", "b", 1024), thue_morse("b", "a", 1024)]
    texts.append(" ".join(texts))
    want = [library[0](t) for t in texts]
    assert token_counts.counts(texts, tokenizer).tolist() == [len(x) for x in want]
    for store in (bpe_codec.pieces(tokenizer), packing._library(tokenizer)):
        ids, at = store.encode_texts(texts, vocabulary(tokenizer))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_colliding_pre_tokens_get_their_own_number():
    cache = Cache(lambda words: [len(w) for w in words])
    pre = PreTokens(["a bb ccc dddd bb"])
    pre.hashes[:] = 7
    assert cache(pre).tolist() == [1, 3, 4, 5, 3] and cache(pre).tolist() == [1, 3, 4, 5, 3]


def test_cache_starts_anew(tokenizer):
    calls = []
    cache = Cache(lambda words: calls.append(len(words)) or [len(w) for w in words], keep=5, bits=4)
    for text in ("a bb ccc dddd eeeee ffffff ggggggg", "a bb ccc", "a bb ccc dddd eeeee ffffff ggggggg"):
        pre = PreTokens([text])
        assert cache(pre).tolist() == [len(pre.piece(i)) for i in range(pre.starts.size)]
    assert len(calls) >= 2


def test_token_counts(odd_docs, odd_texts, tokenizer, library):
    got = sorted(map(tuple, token_counts.token_counts(odd_docs, tokenizer).collect()), key=str)
    want = [(i, len((t or "").encode()), len(library[0](t)), len(library[0](t)) > 1024) for i, t in odd_texts]
    assert got == sorted(want, key=str)


def test_codec(odd_docs, odd_texts, tokenizer, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in odd_texts:
        ids = library[0](t)
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library[1].decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, bpe_codec.codec_digests(odd_docs, tokenizer).collect()), key=str) == sorted(want, key=str)
    ids = bpe_codec.bpe_encode(odd_docs, tokenizer)
    assert sorted(((r.doc_id, r.ids) for r in ids.collect()), key=str) == sorted(((i, library[0](t)) for i, t in odd_texts), key=str)
    back = bpe_codec.bpe_decode(ids, tokenizer)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((i, t or "") for i, t in odd_texts), key=str)


def test_automaton_finds_every_ending(tokenizer):
    vocab = vocabulary(tokenizer)
    automaton = bpe_codec.SuffixAutomaton(vocab)
    for text in ["", " the international", "aaaaaaaaaaaaaaaaaaaa", "日本 é²", thue_morse("e", "r", 64), *strange(200)]:
        data = text.encode()
        want = [[(n, vocab.id_of[data[end - n : end]]) for n in range(end, 0, -1) if data[end - n : end] in vocab.id_of] for end in range(1, len(data) + 1)]
        assert [*automaton.endings(data)] == want


def test_no_documents(no_docs, tokenizer):
    assert token_counts.token_counts(no_docs, tokenizer).count() == 0
    assert bpe_codec.codec_digests(no_docs, tokenizer).count() == 0
    assert packing.best_fit_packing(no_docs, tokenizer).count() == 0


def check_packing(rows, texts, library, size):
    ids = sorted(tuple(library(t) + [0]) for _, t in texts)
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    bins = defaultdict(list)
    for r in rows:
        assert 1 <= r["length"] <= size
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing(odd_docs, odd_texts, tokenizer, library):
    for size in (64, 2048):
        rows = packing.best_fit_packing(odd_docs, tokenizer, size).collect()
        n = check_packing(rows, odd_texts, library[0], size)
        assert n >= -(-sum(r["length"] for r in rows) // size)
        by = defaultdict(list)
        for r in rows:
            by[r["doc_id"]].append(r)
        for i, t in odd_texts:
            if i in (1, 5, 7, 8):
                own, at = np.array(library[0](t) + [0], "<u4"), 0
                for j, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
                    assert (r["piece"], r["start"]) == (j, at) and (j == 0 or r["length"] == size)
                    assert r["ids_crc32"] == zlib.crc32(own[at : at + r["length"]].tobytes())
                    at += r["length"]
                assert at == own.size


def test_fullest_is_fullest():
    r = random.Random(2)
    for _ in range(300):
        room = r.randrange(1, 40)
        counts = np.zeros(41, np.int64)
        for _ in range(r.randrange(8)):
            counts[r.randrange(1, 41)] += r.randrange(1, 4)
        sums = {0}
        for length in np.flatnonzero(counts):
            for _ in range(counts[length]):
                sums |= {s + length for s in sums if s + length <= room}
        chosen = packing.fullest(counts, 40, room)
        assert sum(chosen) == max(sums)
        assert all(chosen.count(x) <= counts[x] for x in chosen)


def test_plan_uses_all():
    r = np.random.default_rng(1)
    counts = np.append(0, r.integers(0, 50, 100))
    counts[25] = 10_000
    plan = packing.bin_plan(counts, 100)
    used = np.zeros(101, np.int64)
    for length, first, last, *_ in plan:
        assert first == used[length]
        used[length] = last
    assert (used == counts).all()
    n_bins = max(b + (last - first) // each for _, first, last, b, each, _ in plan)
    assert n_bins <= 1.03 * max((counts * np.arange(101)).sum() / 100, counts[51:].sum())


def test_equal_lengths_spread(spark):
    pieces = spark.range(5000).select(F.col("id").alias("key"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(7).cast("long").alias("length"), F.col("id").alias("ids_crc32"))
    rows = packing.pack(pieces, 30, per_salt=100).collect()
    assert len(rows) == 5000 and len({r["sequence_id"] for r in rows}) == 1250 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 5000

"""Operators 1, 6 and 10, components and the pipeline against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from texts import prose

from photospark.llm import embedding_join, minhash
from photospark.llm.common import connected_components
from photospark.llm.shingles import weighted, windows, word_hashes


def components(ids, links):
    of = {i: i for i in ids}
    for a, b in links:
        x, y = of[a], of[b]
        for i in ids:
            if of[i] in (x, y):
                of[i] = min(x, y)
    return of


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 60)]
    got = {x.id: x.component for x in connected_components(spark.createDataFrame(edges + [(None, 1), (7, 7)], "a long, b long")).collect()}
    ids = {i for e in edges if e[0] != e[1] for i in e}
    assert got == components(sorted(ids), [e for e in edges if e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [4, 4096])
def test_embeddings(spark, block):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 16))
    rows = [(i, (centers[i % 12] + rng.normal(size=16) * 0.25).tolist()) for i in range(120)]
    rows += [(200, rows[0][1]), (201, [2 * x for x in rows[1][1]]), (3, rows[3][1]), (300, None), (301, []), (302, [0.0] * 16), (303, [None] + [1.0] * 15), (304, [float("nan")] * 16), (305, [1.0, 0.0]), (306, [2.0, 0.1]), (None, rows[5][1]), (307, [1e200] * 16), (308, [float("inf")] + [0.0] * 15)]
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cid string, w int")
    got = sorted((tuple(r) for r in embedding_join.embedding_links(docs, block_rows=block, most_pivots=6).collect()), key=str)
    ok = [v and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / max(map(abs, v)) if o else None for (_, v), o in zip(rows, ok)]
    linked = lambda i, j: ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] / (np.linalg.norm(unit[i]) * np.linalg.norm(unit[j])) >= 0.9
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if linked(i, j)]
    of, n = components(range(len(rows)), links), Counter(i for e in links for i in e)
    least = {c: min((rows[i][0] for i in of if of[i] == c and rows[i][0] is not None), default=None) for c in of.values()}
    want = [(k, n[i], k if not ok[i] else least[of[i]], k is not None and k == (k if not ok[i] else least[of[i]])) for i, (k, _) in enumerate(rows)]
    assert got == sorted(want, key=str)
    assert embedding_join.embedding_links(docs.limit(0)).count() == 0


def shingles(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[x] / a[d], b[x] / b[d]) for x in a.keys() | b.keys())
    return total


def noisy(text, r, share):
    return " ".join(("w%d" % r.randrange(10**6) if r.random() < share else w) for w in text.split())


def families():
    r, rows = random.Random(9), []
    for f in range(6):
        base = prose(100 + f, 120 + 40 * f)
        rows += [noisy(base, r, s) for s in (0, 0.01, 0.02, 0.02, 0.03, 0.04, 0.05)]
    rows += [prose(500 + i, 80) for i in range(20)] + ["spam eggs " * n for n in (20, 40, 41, 200)] + ["a b", "a b c", "a b"]
    return [*enumerate(rows)]


def test_probability_jaccard_and_signatures():
    rows = [t for _, t in families()][:20] + ["x y z u v " * 3 + "p q", "x y z u v x y z u v p q r", "a b", ""]
    sets = [shingles(t) for t in rows]
    elements, text, weight = weighted(*windows(*word_hashes(rows), 5))
    own = [(elements[text == i], weight[text == i]) for i in range(len(rows))]
    sig = minhash.signatures(elements, text, weight, len(rows))
    for i, j in itertools.combinations(range(len(rows) - 1), 2):
        exact = probability(sets[i], sets[j])
        assert abs(minhash.probability_jaccard(own[i], own[j]) - exact) < 1e-9
        assert abs((sig[i] == sig[j]).mean() - exact) < 6 * (exact * (1 - exact) / 128) ** 0.5 + 0.03


def test_near_duplicates(spark):
    rows = families()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes, _ = minhash.near_classes(docs, block_texts=3)
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if rows[i][1] == rows[j][1] or sets[i] and sets[j] and probability(sets[i], sets[j]) >= 0.8]
    of = components(range(len(rows)), links)
    keyed = minhash._keyed(docs, "doc_id", "text").join(classes, ["h1", "h2"])
    assert {r.key: r.component_key for r in keyed.collect()} == of


def test_near_duplicates_of_odd_rows(odd_docs, odd_texts, no_docs):
    got = sorted((tuple(r) for r in minhash.near_duplicates(odd_docs).collect()), key=str)
    same = {t for _, t in odd_texts if t and t.startswith(odd_texts[0][1][:50])}
    want = []
    for i, t in odd_texts:
        c = 1 if t in same else 4 if not t else 13 if t.startswith("spam") else i
        want.append((i, c, i == c))
    assert got == sorted(want, key=str)
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for i, c, k in want})
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.keep_one(no_docs).count() == 0


def test_one_row_stays_where_no_row_has_a_key(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, "x"), (3, "x"), (3, "y")], "doc_id long, text string")
    assert sorted(map(tuple, minhash.keep_one(docs).collect()), key=str) == sorted([(None, "a b c d e f"), (None, None), (3, "x"), (3, "y")], key=str)

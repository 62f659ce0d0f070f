"""Operators 5, 8 and 9 against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from photospark.llm import class_lm, license_scans, quality_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality(odd_docs, odd_texts, no_docs):
    got = sorted((tuple(r)[:7] for r in quality_rules.quality_verdicts(odd_docs).collect()), key=str)
    assert got == sorted(((i, *base(t)) for i, t in odd_texts), key=str)
    assert quality_rules.quality_verdicts(no_docs).count() == 0 and quality_rules.keep_quality(no_docs).count() == 0


def test_a_text_of_many_words(spark):
    """Windows of a text with a million different words are all different, but for a planted one; equal hashes alone don't make a repeat."""
    n = 1_000_000
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("w"), F.hex(i))), " ")
    docs = spark.range(2).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 0, text).otherwise(F.concat(text, F.lit(" w5 w6 w7 end w5 w6 w7"))).alias("text"))
    got = {r.doc_id: (r.n_words, r.n_repeat_words) for r in quality_rules.quality_verdicts(docs).collect()}
    assert got == {0: (n, 0), 1: (n + 7, 9)}


def test_rules_of_lines_and_letters(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "\n".join(f"- {words[i * 8:i * 8 + 60]}" for i in range(8))), (2, "\n".join(f"{words[i * 8:i * 8 + 60]}..." for i in range(8))), (3, " ".join(str(10**6 + i) for i in range(80))), (4, words)]
    got = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True}


def test_filter_keeps_what_verdicts_keep(odd_docs):
    kept = quality_rules.keep_quality(odd_docs)
    assert kept.columns == odd_docs.columns
    want = [r.doc_id for r in quality_rules.quality_verdicts(odd_docs).where("kept").collect()]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_order_is_by_rejection_for_its_cost(odd_docs):
    order = quality_rules.cascade_order(odd_docs, quality_rules.BASE + quality_rules.RULES)
    gains = [share / seconds for _, share, seconds in order]
    assert gains == sorted(gains, reverse=True)


def test_labels(spark, sf):
    v = quality_rules.quality_verdicts(spark.read.parquet(f"{sf}/documents.parquet")).where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    wrong = v.where((F.col("quality") == 1) != F.col("kept")).count()
    assert wrong == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf, name):
    compare(spark, connect(sf), queries.QUERIES[name], queries.ORACLES[name], sf)


def scan(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    at = sorted((i, label) for phrase, label in license_scans.PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


LICENSED = [
    "CC BY cc by CC-BY", "x Apache License, MIT license; gnu General public LICENSE", "mit licenses", "cc by", "İ mit license é", "xcc by", "cc byx", "apache\nlicense",
    "a b c. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including WITHOUT limitation the rights to use, copy, alter, merge, publish, distribute, sublicense, and/or sell copies of the Software. d",
    "Redistribution and use in source", "This work is licensed under a Creative Commons Attribution 4.0 International License",
]


def test_licenses(spark, odd_docs, odd_texts, no_docs):
    for docs, rows in ((odd_docs, odd_texts), (spark.createDataFrame([*enumerate(LICENSED)], "doc_id long, text string"), [*enumerate(LICENSED)])):
        got = sorted((tuple(r)[:6] for r in license_scans.license_scan(docs).collect()), key=str)
        assert got == sorted(((i, *scan(t)) for i, t in rows), key=str)
    labels = {r.doc_id: (r.labels, r.score) for r in license_scans.license_scan(docs).collect()}
    assert labels[8][0] == "mit" and 0.8 <= labels[8][1] < 1 and labels[9] == ("", 0.0) and labels[10] == ("cc-by-4.0", 1.0) and labels[0] == ("cc-by", 1.0)
    assert license_scans.license_scan(no_docs).count() == 0


def test_long_notices_word_by_word(spark):
    """A notice of any length is found whole, worn and cut short by a tenth, and not by its first half; the score is the share of its words that hits cover."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    templates = (("own", " ".join(words)), ("brief", "one two three four five"))
    worn = [w if r.random() > 0.04 else "x" for w in words]
    rows = [(1, "a b " + " ".join(words) + " c"), (2, " ".join(worn)), (3, " ".join(words[:360])), (4, " ".join(words[:200])), (5, "one two three four five"), (6, " ".join(words[47:50]))]
    got = {x.doc_id: x for x in license_scans.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()}
    for i, text in rows:
        w = text.split()
        covered = {p for a in range(len(w) - 2) if w[a].startswith("w") and [int(x[1:]) if x[0] == "w" else -9 for x in w[a : a + 3]] == [*range(int(w[a][1:]), int(w[a][1:]) + 3)] for p in range(int(w[a][1:]), int(w[a][1:]) + 3)}
        share = 1.0 if i == 5 else len(covered) / 400
        assert math.isclose(got[i].score, share if share >= 0.8 else 0.0) and got[i].labels == ("brief" if i == 5 else "own" if share >= 0.8 else "")


def brute_licence(text, templates, k=3, slack=3, coverage=0.8):
    """Labels and score by all hits of all notices, word by word, over every window of diagonals."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    w, labels, best = split(text), set(), 0.0
    for label, notice in templates:
        n = split(notice)
        drift = slack
        while 20 * drift <= len(n):
            drift *= 2
        places = {}
        for at in range(len(n) - k + 1):
            places.setdefault(tuple(n[at : at + k]), []).append(at)
        hits = [(p - at, at) for p in range(len(w) - k + 1) for at in places.get(tuple(w[p : p + k]), [])]
        for first in {d for d, _ in hits}:
            share = len({at + j for d, at in hits if first <= d <= first + drift for j in range(k)}) / len(n)
            if share >= coverage:
                labels.add(label)
                best = max(best, share)
    return ",".join(sorted(labels)), best


def test_spans_have_a_bounded_drift(spark):
    """Junk between the words of a notice is no licence, however its diagonals hang together; a few words put in or left out are."""
    mit = next(t for label, t in license_scans.TEMPLATES if label == "mit" and "AS IS" in t).split()
    r = random.Random(5)
    junk = lambda n: [f"junk{r.randrange(10**6)}" for _ in range(n)]

    def mixed(run, between):
        return " ".join(x for i in range(0, len(mit), run) for x in mit[i : i + run] + junk(between))

    put_in = mit[:50] + junk(2) + mit[50:100] + junk(3) + mit[100:120] + mit[123:]
    rows = [mixed(3, 3), mixed(4, 3), mixed(3, 4), mixed(10, 3), mixed(40, 1), " ".join(put_in), " ".join(junk(40) + mit + junk(300) + mit[:90]), " ".join(mit[80:] + mit[:80]), " ".join(mit), " ".join(mit[:60] * 3)]
    rows += [" ".join(w for w in mit if r.random() > x) for x in (0.02, 0.05, 0.1)]
    got = {x.doc_id: x for x in license_scans.license_scan(spark.createDataFrame([*enumerate(rows)], "doc_id long, text string")).collect()}
    for i, text in enumerate(rows):
        labels, score = brute_licence(text, license_scans.TEMPLATES)
        assert got[i].labels == labels and math.isclose(got[i].score, score), (i, got[i], labels, score)
    assert [got[i].labels for i in (0, 1, 2)] == ["", "", ""] and got[5].labels == got[6].labels == got[8].labels == "mit"


def test_base_of_real_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(tuple(r)[:6] for r in license_scans.license_scan(docs).collect())
    assert got == sorted((r.doc_id, *scan(r.text)) for r in docs.collect())


def brute_lm(rows, training):
    tokens = lambda t: [w.encode().lower() for w in WORD.findall(t or "")] + [class_lm.END]
    c = Counter(w for i, t in rows if training(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(i, not training(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows]


@pytest.mark.parametrize("known", [3, 200_000])
def test_lm(odd_docs, odd_texts, known):
    training = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    column = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    got = sorted((tuple(r) for r in class_lm.class_scores(odd_docs, column, n_known=known, n_exact=min(known, 100)).collect()), key=str)
    want = sorted(brute_lm(odd_texts, training), key=str)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(want, key=lambda r: (str(r[0]), r[2])), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and g[6] < 0


def test_lm_without_rows_or_training(no_docs, odd_docs):
    assert class_lm.class_scores(no_docs, F.lit(True)).count() == 0
    r = class_lm.class_scores(odd_docs, F.lit(False)).collect()
    assert len(r) == odd_docs.count() and all(x.train_tokens == 0 and x.n_known == 0 for x in r)


def test_classes_predict_held_out_text(spark, sf):
    """Class bigrams beat add-one unigrams on texts that they weren't learned from, and probabilities of words and end sum to one."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    r = class_lm.class_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]
    table, m = class_lm.train(docs.where("doc_id % 7 <> 2").select("text"), n_exact=50, classes=(5, 5), n_known=300)
    rest = {bytes(x.word): x.c for x in table.collect() if bytes(x.word) not in m.counts}
    emitted = [0.0] * m.step.shape[0]
    for i in m.counts.values():
        emitted[m.class_of[i]] += 10 ** m.emission[i]
    emitted[-1] += sum((c + 1) / m.rest for c in rest.values()) + 1 / m.rest
    assert all(abs(x - 1) < 1e-9 for x in emitted) and all(abs(x - 1) < 1e-9 for x in (10**m.step).sum(axis=1))


def test_score_is_that_of_the_model(spark, sf):
    """Word by word in plain Python: the class step, and the word's share of its class."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    docs, settings = spark.createDataFrame(rows, "doc_id long, text string"), {"n_exact": 30, "classes": (6, 6), "n_known": 400}
    table, m = class_lm.train(docs.where("doc_id % 2 = 0").select("text"), **settings)
    count = {bytes(r.word): r.c for r in table.collect()}
    got = {r.doc_id: r for r in class_lm.class_scores(docs, F.col("doc_id") % 2 == 0, **settings).collect()}
    for i, text in rows:
        before, total = m.class_of[m.counts[class_lm.END]], 0.0
        for w in [*class_lm.words(text), class_lm.END]:
            n = m.counts.get(w)
            c = m.class_of[-1] if n is None else m.class_of[n]
            total += m.step[before, c] + (math.log10((count.get(w, 0) + 1) / m.rest) if n is None else m.emission[n])
            before = c
        assert math.isclose(got[i].score, total, rel_tol=1e-9) and math.isclose(got[i].perplexity, 10 ** (-total / got[i].n_tokens), rel_tol=1e-9)


def test_sweeps_give_every_known_word_a_class(spark):
    """Words that follow each other in a cycle of three hidden classes: those moved in sweeps join the classes that exact exchange has found."""
    import random

    r = random.Random(1)
    words = [[f"w{k}x{i}" for i in range(40)] for k in range(3)]
    texts = [" ".join(words[(s + j) % 3][min(int(r.expovariate(0.12)), 39)] for j in range(300)) for s in range(60)]
    _, m = class_lm.train(spark.createDataFrame([(t,) for t in texts], "text string"), n_exact=30, classes=(3, 3))
    placed = [{m.class_of[m.counts[w.encode()]] for w in k if w.encode() in m.counts} for k in words]
    assert all(len(p) == 1 for p in placed) and len(set.union(*placed)) == 3


def test_exchange_finds_planted_classes():
    import numpy as np

    rng = np.random.default_rng(0)
    hidden = rng.integers(0, 3, 30)
    pairs = np.zeros((32, 32))
    for a in range(30):
        for b in range(30):
            pairs[a, b] = 100 if hidden[b] == (hidden[a] + 1) % 3 else 1
    of = class_lm.exchange_classes(pairs, 30, 3)[:30]
    assert all((of[i] == of[j]) == (hidden[i] == hidden[j]) for i in range(30) for j in range(30))

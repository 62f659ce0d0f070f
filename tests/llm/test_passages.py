"""Operator 6 against brute force: seeds, chains, alignment, recall, and the whole operator on small tables."""

import random

import numpy as np
import pytest
from texts import prose

from photospark.llm import passages
from photospark.llm.shingles import word_hashes


def test_minimizers():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n, w = [int(x) for x in rng.integers(0, 50, 3)], int(rng.integers(1, 20))
        h, text = rng.integers(1, 1000, sum(n)).astype(np.uint64), np.repeat(np.arange(3), n)
        want = []
        for t in range(3):
            x, keep = h[text == t], set()
            for i in range(max(1, len(x) - w + 1)) if len(x) else []:
                keep |= {i + j for j, v in enumerate(x[i : i + w]) if v == x[i : i + w].min()}
            want += [sum(n[:t]) + i for i in sorted(keep)]
        assert passages.minimizers(h, text, w).tolist() == want


def best_chain(runs, gap):
    """Quadratic dynamic programming."""
    order, score = sorted(range(len(runs)), key=lambda i: runs[i][0]), {}
    for i in order:
        x, y, n = runs[i]
        score[i] = n + max([0.0, *(score[j] - gap * (x - runs[j][0] - runs[j][2] + y - runs[j][1] - runs[j][2]) for j in score if runs[j][0] + runs[j][2] <= x and runs[j][1] + runs[j][2] <= y)])
    return max(score.values())


def test_chains_are_best():
    r = random.Random(6)
    for _ in range(200):
        runs = np.array([(r.randrange(60), r.randrange(60), r.randrange(3, 12)) for _ in range(r.randrange(1, 12))])
        first = passages.chains(runs, 0.5)[0]
        score = sum(runs[i][2] for i in first) - 0.5 * sum(runs[b][0] - runs[a][0] - runs[a][2] + runs[b][1] - runs[a][1] - runs[a][2] for a, b in zip(first, first[1:]))
        assert abs(score - best_chain(runs.tolist(), 0.5)) < 1e-9


def test_anchors_are_all_runs():
    rng = np.random.default_rng(3)
    for _ in range(100):
        a, b = (rng.integers(1, 6, int(rng.integers(0, 60))).astype(np.uint64) for _ in range(2))
        low, high = sorted(rng.integers(-30, 30, 2).tolist())
        want = []
        for shift in range(low, high + 1):
            x = max(0, shift)
            while x < a.size and x - shift < b.size:
                n = 0
                while x + n < a.size and x + n - shift < b.size and a[x + n] == b[x + n - shift]:
                    n += 1
                if n >= 3:
                    want.append([x, x - shift, n])
                x += n + 1
        for runs in (passages.anchors, passages.runs_between) if a.size and b.size else (passages.anchors,):
            assert sorted(runs(a, b, 3, low, high).tolist()) == sorted(want)


def test_alignment_has_fewest_changes():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.randrange(4) for _ in range(r.randrange(9))] for _ in range(2))
        columns = passages.align(a, b)
        best = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                best[i][j] = min(best[i - 1][j] + 1, best[i][j - 1] + 1, best[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        assert sum(c != passages.SAME for c in columns) == best[-1][-1]
        assert sum(c != passages.RIGHT for c in columns) == len(a) and sum(c != passages.LEFT for c in columns) == len(b)


def test_dense_ranges_are_the_longest():
    r, s = random.Random(4), passages.Settings(least_words=8, identity=0.8)
    for _ in range(300):
        equal = np.array([r.random() < 0.75 for _ in range(r.randrange(1, 60))])
        fits = [(j - i, i, j) for i in range(equal.size) for j in range(i + 8, equal.size + 1) if equal[i] and equal[j - 1] and equal[i:j].sum() >= 0.8 * (j - i)]
        got = [*passages.dense(equal, s)]
        assert bool(got) == bool(fits) and all(equal[i:j].sum() >= 0.8 * (j - i) for i, j in got)
        if got:
            assert got[0][1] - got[0][0] == max(fits)[0]


def edited(words, share, r, even=False):
    """A copy with this share of its words changed, left out or followed by another, by chance or at even steps."""
    n = round(len(words) * share)
    at = [int((i + 0.5) * len(words) / n) for i in range(n)] if even else r.sample(range(len(words)), n)
    out = [[w] for w in words]
    for i in at:
        new = f"new{r.randrange(10**9)}"
        out[i] = [new] if even or (kind := r.random()) < 0.6 else [] if kind < 0.8 else [words[i], new]
    return [w for x in out for w in x]


@pytest.mark.parametrize("even", [False, True])
@pytest.mark.parametrize("share", [0, 0.02, 0.05, 0.08])
@pytest.mark.parametrize("n", [55, 60, 80, 120])
def test_recall(n, share, even):
    """Through seeds, chains on places, and alignment: passages of identity over 0.9 are found, nearly whole."""
    r, s, hits, trials = random.Random(n), passages.Settings(), 0, 60
    for _ in range(trials):
        word = lambda m: [f"w{r.randrange(10**9)}" for _ in range(m)]  # noqa: B023, E731
        passage = word(n)
        a, b = word(r.randrange(100)) + passage + word(r.randrange(100)), word(r.randrange(100)) + edited(passage, share, r, even) + word(r.randrange(100))
        found = both(" ".join(a), " ".join(b), s)
        hits += any(m >= 0.85 * n for _, m, *_ in found)
    assert hits >= 0.9 * trials


def both(a, b, s):
    """Passages of two texts by the operator's own steps, without Spark."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([7, 8], pa.int32()), pa.array([b, a])], ["key", "mark", "text"])
    blocks = pa.Table.from_batches([*passages._seed_blocks([rows], s, 1)])
    ties = passages._bucket_ties(blocks, s)
    ties = ties.sort_by([(c, "ascending") for c in ("a", "a_mark", "b", "b_mark", "x", "y")])
    out = []
    words = {1: word_hashes([b])[0], 2: word_hashes([a])[0]}
    for chains in passages._pair_chains(ties.to_batches(), s):
        for c in chains.to_pylist():
            assert (c["a"], c["b"]) == (2, 1)
            x, y = max(0, c["x0"] - s.margin), max(0, c["y0"] - s.margin)
            out += [(i + x, n, j + y, m, e) for i, n, j, m, e in passages.passages(words[2][x : c["x1"] + s.margin], words[1][y : c["y1"] + s.margin], s, c["low"] - x + y - s.drift, c["high"] - x + y + s.drift)]
    return out


def test_parts_of_failing_chains():
    s = passages.Settings()
    for n, between in ((60, 80), (100, 150)):
        w = np.random.default_rng(n).integers(1, 1 << 60, 2 * n + between).astype(np.uint64)
        a, b = np.append(w[:n], w[n : 2 * n]), np.concatenate([w[:n], w[2 * n :], w[n : 2 * n]])
        assert sorted(p[:4] for p in passages.passages(a, b, s)) == [(0, n, 0, n), (n, n, n + between, n)]
        assert sorted(p[:4] for p in passages.passages(b, a, s)) == [(0, n, 0, n), (n + between, n, n, n)]


def brute_force(docs, least=51):
    """Words of each document, of text and key, that stand in an exact run of ``least`` words of one before it."""
    told = set()
    grams = [{tuple(t.split()[i : i + least]): i for i in range(len(t.split()) - least + 1)} for _, t in docs]
    for i, (key, text) in enumerate(docs):
        words = text.split()
        for p in range(len(words) - least + 1):
            if any(tuple(words[p : p + least]) in grams[j] for j in range(len(docs)) if docs[j][0] < key):
                told |= {(key, w) for w in range(p, p + least)}
    return told


def test_whole_operator_against_brute_force(spark):
    """Every word of an exact repeat is told, none else but a few about its ends; the common lines and passages among them stand in very many documents."""
    r = random.Random(9)
    common = [prose(9000 + i, r.choice((20, 26, 30, 60, 90))) for i in range(12)]
    docs = []
    for i in range(160):
        parts = [prose(100 + i, r.randrange(5, 60))]
        for _ in range(r.randrange(4)):
            parts += [r.choice(common), *([prose(7000 + r.randrange(10**6), r.randrange(1, 40))] if r.random() < 0.6 else [])]
        docs.append((i, " ".join(parts)))
    docs += [(200 + i, docs[5][1]) for i in range(30)]
    want = brute_force(docs)
    found = passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()
    told = {(x.doc_id, w) for x in found for w in range(x.start_word, x.start_word + x.n_words)}
    assert len(want) > 2000 and len(want & told) >= 0.99 * len(want)
    assert {k for k, _ in want} <= {k for k, _ in told}
    text = dict(docs)
    for x in found:
        a, b = text[x.doc_id].split()[x.start_word :][: x.n_words], text[x.source_doc_id].split()[x.source_start :][: x.source_words]
        columns = passages.align(a, b)
        assert x.source_doc_id < x.doc_id and min(len(a), len(b)) >= 51 and columns.count(passages.SAME) >= 0.9 * len(columns) - 1


def test_passages(spark, odd_docs, no_docs):
    shared, fuzzy = prose(50, 55), prose(51, 80).split()
    worn = [*fuzzy]
    worn[20], worn[50] = "other", "words"
    short = prose(52, 40)
    rows = [(1, prose(61, 90) + " " + shared + " " + prose(62, 30)), (2, shared + "\n" + prose(63, 70)), (3, prose(64, 40) + "\t" + " ".join(fuzzy)), (4, " ".join(worn) + " " + prose(65, 20)), (5, short + " " + prose(66, 60)), (6, prose(67, 60) + " " + short)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r.doc_id, r.source_doc_id): (r.start_word, r.n_words, r.source_start) for r in passages.repeated_passages(docs).collect()}
    assert got == {(2, 1): (0, 55, 90), (4, 3): (0, 80, 40)}
    cut = {r.doc_id: r for r in passages.cut_repeats(docs).collect()}
    assert cut[1].text == rows[0][1] and cut[2].text == prose(63, 70) and cut[4].text == prose(65, 20) and cut[5].text == rows[4][1] and cut[2].n_chars == len(cut[2].text)
    assert passages.repeated_passages(no_docs).count() == 0 and passages.cut_repeats(no_docs).columns == no_docs.columns
    odd = {(r.doc_id, r.source_doc_id) for r in passages.repeated_passages(odd_docs).collect()}
    assert odd == {(2, 1), (3, 1), (3, 2), (12, 1), (12, 2), (12, 3), (14, 13)}
    assert passages.cut_repeats(odd_docs).columns == odd_docs.columns and passages.cut_repeats(odd_docs).count() == odd_docs.count()


def test_copies_in_any_order_keep_their_links(spark):
    """The larger key of two copies comes first in its task: what the smaller one shares with a third text is told all the same."""
    shared = prose(90, 60)
    text = prose(91, 30) + " " + shared + " " + prose(92, 30)
    docs = [(9, text), (5, text), (1, shared + " " + prose(93, 20)), (7, prose(94, 15) + " " + shared)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = {(r.doc_id, r.source_doc_id) for r in passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(5, 1), (7, 1), (7, 5), (9, 5)}


def test_rows_of_one_key_are_cut_by_their_own_text(spark):
    p = prose(80, 60)
    rows = [(1, p), (2, p + " " + prose(81, 30)), (2, prose(82, 120)), (2, prose(82, 120)), (None, p)]
    cut = passages.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in cut) == sorted([(1, p), (2, prose(81, 30)), (2, prose(82, 120)), (2, prose(82, 120)), (0, p)])


def test_many_holders_cost_few_rows_each(spark):
    shared = prose(70, 60)
    docs = spark.createDataFrame([(i, prose(1000 + i, 20) + " " + shared + " " + prose(3000 + i, 20)) for i in range(200)], "doc_id long, text string")
    got = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in got} == {*range(1, 200)} and len(got) <= 4 * 200

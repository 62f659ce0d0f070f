"""Quality rules as a short-circuit cascade (operator 5), in DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from photospark.llm.common import whole_row

#: The six characters that part words.
WHITE = " \t\n\x0b\x0c\r"
BREAKS = r"[ \t\n\x0B\f\r]+"


@dataclass(frozen=True)
class Rule:
    """reject: SQL condition over the columns text, words and lines of ``_prepared`` (never null) under which a document goes."""

    name: str
    reject: str


_SYMBOLS = "regexp_count(text, '[#*$%&|<>]')"
_REPEATED = "n_repeat_words"

#: Rules beside the base ones. Each stands alone, so that any order gives the same verdict.
RULES = (
    Rule("symbols", f"10 * {_SYMBOLS} > 3 * size(words)"),
    Rule("shouting", "2 * length(regexp_replace(text, '[^A-Z]+', '')) > length(regexp_replace(text, '[^A-Za-z]+', ''))"),
    Rule("exclamations", "2 * (length(text) - length(replace(text, '!', ''))) > size(words)"),
    Rule("repeated_lines", "size(lines) >= 4 and 10 * (size(lines) - size(array_distinct(lines))) > 6 * size(lines)"),
    Rule("long_words", "length(array_join(words, '')) > 20L * size(words)"),
    Rule("bullets", "10 * size(filter(lines, x -> substr(ltrim(x), 1, 1) in ('-', '*', '\u2022'))) > 9 * size(lines)"),
    Rule("ellipses", "10 * size(filter(lines, x -> endswith(rtrim(x), '...') or endswith(rtrim(x), '\u2026'))) > 3 * size(lines)"),
    Rule("no_letters", "2 * size(filter(words, x -> x rlike '\\\\p{L}')) < size(words)"),
)
#: The base rules, for the cascade that only filters.
BASE = (Rule("few_words", "size(words) < 50"), Rule("repeated_words", "100 * n_repeat_words > 50 * size(words)"))

# Words in 3-word windows found twice or more. Each window becomes its 64-bit hash with its place; sorted, equal windows are neighbours, and neighbours of
# one hash count if their words are equal too. Windows cover three words each, less what the next one covers. A transform over an array of one
# names a value: so Spark evaluates it once, even where it copies this expression into a filter.
_KEYS = "CASE WHEN size(w) < 3 THEN array() ELSE sort_array(transform(slice(w, 1, size(w) - 2), (x, i) -> named_struct('h', xxhash64(x, get(w, i + 1), get(w, i + 2)), 'i', i))) END"
_EQUAL = "coalesce(x.h = get(keys, {j}).h and " + " and ".join(f"get(w, x.i + {k}) = get(w, get(keys, {{j}}).i + {k})" for k in range(3)) + ", false)"
_TWICE = f"filter(keys, (x, j) -> {_EQUAL.format(j='j - 1')} or {_EQUAL.format(j='j + 1')})"
_PLACES = f"sort_array(transform({_TWICE}, x -> x.i))"
_COVERED = "aggregate(transform(places, (x, k) -> least(3, coalesce(get(places, k + 1), x + 3) - x)), 0L, (a, v) -> a + v)"
_REPEATS = f"get(transform(array(words), w -> get(transform(array({_KEYS}), keys -> get(transform(array({_PLACES}), places -> {_COVERED}), 0)), 0)), 0)"


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    """All columns of docs as the struct ``row``, and text (null: empty), words, lines with a word."""
    out = docs.select(whole_row(docs).alias("row"), F.coalesce(docs[text], F.lit("")).alias("text"))
    bare = F.btrim("text", F.lit(WHITE))
    return out.withColumn("words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BREAKS))).withColumn("lines", F.expr("filter(split(text, '\\n'), x -> x rlike '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]')"))


def _with_repeats(df: DataFrame) -> DataFrame:
    return df.withColumn(_REPEATED, F.expr(_REPEATS))


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 500, tries: int = 2) -> list[tuple[Rule, float, float]]:
    """The rules with their rejection share and seconds over ``sample_rows`` documents (a bounded sample), most rejection per second first.

    A rule is run once for its share, which also compiles it, and then ``tries`` times for its cost: the shortest, less that of a rule that does
    nothing. Order changes only the time taken, never a verdict, so the sample need not be fair."""
    spark = docs.sparkSession  # take() reads as few files as it needs
    sample = _prepared(spark.createDataFrame(docs.select(F.col(text).alias("text")).take(sample_rows), "text string"), "text").coalesce(1).persist()

    def run(reject: str) -> tuple[int, float]:
        df = (_with_repeats(sample) if _REPEATED in reject else sample).agg(F.count_if(F.expr(reject)))
        hits, took = df.first()[0], []
        for _ in range(tries):
            began = time.perf_counter()
            df.first()
            took.append(time.perf_counter() - began)
        return hits, min(took)

    try:
        n = max(1, sample.count())
        nothing = run("size(words) < 0")[1]
        found = [(r, hits / n, max(took - nothing, 1e-4)) for r in rules for hits, took in [run(r.reject)]]
    finally:
        sample.unpersist()
    return sorted(found, key=lambda x: -x[1] / x[2])


def _cascade(rules: list[Rule]) -> Column:
    """True at the first rule that rejects; later ones aren't evaluated then."""
    chain = F.when(F.lit(False), True)
    for r in rules:
        chain = chain.when(F.expr(r.reject), True)
    return chain.otherwise(False)


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", sample_rows: int = 500) -> DataFrame:
    """One row per row of ``docs``: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed and kept.

    kept is false if base_failed, else whether no rule rejects. A null or empty text has no words and fails the base; a null key stays null;
    repeated rows each give their row; other columns, whatever their names, are not read. Whole texts of any length; narrow: no shuffle."""
    order = [r for r, _, _ in cascade_order(docs, rules, text, sample_rows)]
    df = _with_repeats(_prepared(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text"))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    failed = (F.col("n_words") < 50) | (100 * F.col(_REPEATED) > 50 * F.col("n_words"))
    return df.select(
        F.col("row.key").alias(key), "n_words", F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.expr(_SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.col(_REPEATED),
        failed.alias("base_failed"), F.when(failed, False).otherwise(~_cascade(order)).alias("kept"),
    )


def keep_quality(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, text: str = "text", sample_rows: int = 500) -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects: the cheap rules as one filter in cascade order, then those that need the
    repeated windows on what is left. A null or empty text has no words and goes (few_words); null and repeated keys, and rows that repeat, are kept
    or go each by their own text; no rows give none."""
    order = [r for r, _, _ in cascade_order(docs, rules, text, sample_rows)]
    df = _prepared(docs, text).where(~_cascade([r for r in order if _REPEATED not in r.reject]))
    if late := [r for r in order if _REPEATED in r.reject]:
        df = _with_repeats(df).where(~_cascade(late))
    return df.select("row.*")


#: DuckDB SQL of quality_verdicts over documents.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
rw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
s AS (SELECT d.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
             len(list_filter(lines, lambda x: substr(ltrim(x), 1, 1) IN ('-', '*', '•'))) AS n_bullets,
             len(list_filter(lines, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) AS n_ellipses,
             len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_lettered,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rw.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN rw ON d.doc_id = rw.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words
            OR 2 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > length(regexp_replace(t, '[^A-Za-z]', '', 'g'))
            OR 2 * (length(t) - length(replace(t, '!', ''))) > n_words
            OR (n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines) OR word_chars > 20 * n_words
            OR 10 * n_bullets > 9 * n_lines OR 10 * n_ellipses > 3 * n_lines OR 2 * n_lettered < n_words) AS kept
FROM f"""

"""Licence scans by diagonal voting (operator 8), in DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices and the labels they add.
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Bits of a long that hold places of a notice; the k - 1 bits above them take what shifts out.
BITS = 48


def _words_text(text: Column) -> Column:
    """The words of a text with one space between. Lower-casing beyond A-Z neither makes nor parts words, and turns nothing but the Kelvin sign
    into a letter from a to z."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _grams(words: Column, k: int) -> Column:
    """Hashes of all rolling k-grams of an array of words."""
    return F.when(F.size(words) >= k, F.transform(F.slice(words, F.lit(1), F.size(words) - (k - 1)), lambda x, i: F.xxhash64(x, *[F.get(words, i + j) for j in range(1, k)]))).otherwise(F.array().cast("array<bigint>"))


def _phrase_columns(padded: Column, n_words: Column) -> tuple[Column, Column, Column, Column]:
    """Places of all phrases, smallest and largest start, and the sorted labels, from text with a space around each word."""
    spaces = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    n, first, last, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        look = f" {phrase} "
        has = F.contains(padded, F.lit(look))
        n.append(F.when(has, F.regexp_count(padded, F.lit(f"(?={look})"))).otherwise(0).cast("long"))
        first.append(F.when(has, spaces(F.substring(padded, F.lit(1), F.locate(look, padded) - 1)).cast("long")))
        back = F.reverse(padded)
        last.append(F.when(has, (n_words - spaces(F.substring(back, F.lit(1), F.locate(look[::-1], back) - 1)) - len(phrase.split())).cast("long")))
        labels.append(F.when(has, label))
    return sum(n[1:], n[0]), F.least(*first), F.greatest(*last), F.array_sort(F.array_compact(F.array(*labels)))


def license_scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, key: str = "doc_id", text: str = "text", k: int = 3, slack: int = 3, coverage: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    All rolling k-gram hashes of a text are joined to those of the notices (a fixed, small table; broadcast). Hits vote for their diagonal, text
    place less notice place. From each diagonal on, those up to the notice's drift are merged: words put in or left out in all, ``slack`` of them or, for
    long notices, about a tenth of the notice. So a merged span is never longer than the notice by more than its drift, however many
    diagonals have votes; it is verified if it holds at least ``coverage`` of the notice's words. labels are the phrases' and those of verified
    notices. score: 1 where a phrase stands, else the largest verified coverage, else 0.

    A null text is empty: no words, no places, null first_word and last_word, empty labels, score 0. Null and repeated keys keep their rows;
    other columns are not read. One scan: a text sends its hits and one row of its own to the votes, and nothing else is shuffled."""
    spark = docs.sparkSession
    longest = max((len(re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+", t)) for _, t in templates), default=1)
    masks = [f"mask{i}" for i in range(max(1, -(-longest // BITS)))]
    known = spark.createDataFrame([(i, label, t) for i, (label, t) in enumerate(templates)], "template int, label string, text string")
    known = known.withColumn("words", F.split(_words_text(F.col("text")), " ")).select("template", "label", F.size("words").alias("size"), F.posexplode(_grams(F.col("words"), k)).alias("at", "gram"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("norm", _words_text(F.col("text")))
    n_words = F.when(F.col("norm") == "", 0).otherwise(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1).cast("long")
    rows = rows.select("row", "key", "norm", n_words.alias("n_words"), F.concat(F.lit(" "), "norm", F.lit(" ")).alias("padded"))
    n_base, first, last, labels = _phrase_columns(F.col("padded"), F.col("n_words"))
    rows = rows.select("row", F.struct("key", "n_words", n_base.alias("n_base"), first.alias("first_word"), last.alias("last_word"), labels.alias("base")).alias("own"), F.split("norm", " ").alias("words"))
    # Place -1 is the text's own row; only there does its struct go along.
    rows = rows.select("row", "own", F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), _grams(F.col("words"), k))).alias("place", "gram"))
    hits = rows.join(F.broadcast(known), "gram", "left").where("template is not null or place = 0").select("row", F.when(F.col("place") == 0, F.col("own")).alias("own"), "template", "label", "size", "at", (F.col("place") - 1).alias("place"))
    votes = hits.groupBy("row", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.max("own").alias("own"), F.max("label").alias("label"), F.max("size").alias("size"), *[F.bit_or(F.when(F.expr(f"at div {BITS}") == i, F.expr(f"shiftleft(1L, at % {BITS})")).otherwise(F.lit(0).cast("bigint"))).alias(m) for i, m in enumerate(masks)],
    )
    # Drifts are slack, twice that, and so on: one window for each that the notices need, all in one pass over the sorted votes.
    along, drift, drifts = Window.partitionBy("row", "template").orderBy("diagonal"), F.lit(slack), [slack]
    while 20 * drifts[-1] <= longest and slack > 0:
        drifts.append(2 * drifts[-1])
        drift = F.when(F.col("size") >= 10 * drifts[-1], drifts[-1]).otherwise(drift)

    def merged(mask: str) -> Column:
        """Hits of the diagonals from this one up to the notice's drift."""
        out = F.bit_or(mask).over(along.rangeBetween(0, drifts[0]))
        for d in drifts[1:]:
            out = F.when(F.col("drift") == d, F.bit_or(mask).over(along.rangeBetween(0, d))).otherwise(out)
        return out

    votes = votes.withColumn("drift", drift)
    spans = votes.select("row", "own", "label", "size", *[merged(m).alias(m) for m in masks])
    # A hit covers k words: its bit and the next k - 1, which may reach into the next long.
    low, over = f"(shiftleft(1L, {BITS}) - 1)", lambda m: "(" + " | ".join(f"shiftleft({m}, {j})" for j in range(k)) + ")"
    words = [F.bit_count(F.expr(f"({over(m)} & {low})" + (f" | shiftright({over(masks[i - 1])}, {BITS})" if i else ""))) for i, m in enumerate(masks)]
    held = sum(words[1:], words[0]) / F.col("size")
    spans = spans.withColumn("share", F.when(held >= coverage, held))
    out = spans.groupBy("row").agg(F.max("own").alias("own"), F.collect_set(F.when(F.col("share").isNotNull(), F.col("label"))).alias("more"), F.max("share").alias("share"))
    return out.select(
        F.col("own.key").alias(key), "own.n_words", "own.n_base", "own.first_word", "own.last_word", F.array_join("own.base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own.base", "more")), ",").alias("labels"), F.when(F.col("own.n_base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0)))).alias("score"),
    )

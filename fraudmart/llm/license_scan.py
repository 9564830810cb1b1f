"""License scan: lines and whole short texts against license templates by the
Dice coefficient over distinct word bigrams. DataFrame functions only.

Templates are short notices, standard headers and whole licences
(``license_texts``). A text unit is a line, a whole text of several lines, or a
passage: consecutive sentences or pieces of sentences between line ends, of a
template's size in words. Units and templates become lower-case words of letters and
digits. Dice >= t needs sizes within a factor (2 - t) / t of each other, so each
template lists the unit sizes it can match and units join it on their size: no
template outside the bounds is compared. A passage can only match where the text
holds so many of the template's bigrams that a few of them, the longest, cannot
all be missing: only texts with one of these are searched for passages, and only
for such templates. Of overlapping passages that match a template, the best stays;
a text that holds none of a few words, chosen so that no match can be without
them all, is not cut into words at all;
a passage is reported with the line it begins in. Everything happens inside a row after a
broadcast of the templates, each once, whose total size is checked; larger tables
are taken block by block. Only matches are shuffled.

Null or blank text gives no rows. Null ids are reported like others; rows that
repeat an id give one row per line and license. Units of one word are compared
by that word. Several licenses can match one unit, each with its best template.
Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.llm.common import stored
from fraudmart.llm.decontaminate import plain_words
from fraudmart.llm.license_texts import texts

#: Short notices as their licenses recommend them, by SPDX id.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "This project is licensed under the MIT License."],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license that can be found in the "
                     "LICENSE file.", "Released under the BSD 3-Clause License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "Licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                     "Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all "
                "copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved."],
}
BLOCK_WORDS = 1 << 20
#: Words of everyday English, taken as keywords only where nothing else is left.
EVERYDAY = frozenset("""about after also been before being between both could does each either every from have having
    here into many more most much must only other others over same should some such than that their them then there
    these they this those through under until upon were what when where whether which while will with within without
    would your""".split())


def templates(spark: SparkSession) -> DataFrame:
    notices = [(k, t) for k, v in NOTICES.items() for t in v]
    return spark.createDataFrame(notices + texts(), "license_id string, text string")


def bigrams(words: Column) -> Column:
    """Distinct hashes of adjacent words; of the word itself if there is one."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))),
                       F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return F.array_distinct(F.when(n == 1, F.array(F.xxhash64(F.get(words, 0)))).otherwise(pairs))


def _longest_first(words: Column) -> Column:
    """The distinct bigram hashes, those of the longest words first."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))),
                       F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.struct((-F.length(a) - F.length(b)).alias("n"), F.xxhash64(a, b).alias("h")))
    return F.when(n == 1, bigrams(words)).otherwise(
        F.transform(F.array_sort(F.array_distinct(pairs)), lambda v: v["h"]))


def keywords(templates_: list[list[str]], percent: int) -> list[str]:
    """Words of which every unit that can match a template holds at least one. A unit
    without them lacks all the template's bigrams they are part of; they are chosen,
    long and frequent ones first and everyday ones last, until each template would lose more bigrams than
    a match can miss."""
    bigrams_ = [set(zip(w, w[1:])) if len(w) > 1 else {(w[0],)} for w in templates_ if w]
    need = [len(g) - ceil(len(g) * percent / (200 - percent)) + 1 for g in bigrams_]
    chosen: list[str] = []
    for usable in (lambda w: len(w) > 3 and w not in EVERYDAY, lambda w: True):
        while any(n > 0 for n in need):
            gain: Counter = Counter()
            for g, n in zip(bigrams_, need):
                if n > 0:
                    touched = Counter(w for pair in g for w in set(pair) if usable(w))
                    for w, k in touched.items():
                        gain[w] += min(k, n) * len(w)
            if not gain:
                break
            word = max(gain, key=lambda w: (gain[w], w))
            chosen.append(word)
            for t, g in enumerate(bigrams_):
                lost = {pair for pair in g if word in pair}
                need[t] -= len(lost)
                g -= lost
    return chosen


def _only(df: DataFrame, *columns: Column) -> DataFrame:
    """Columns from a generator: later uses do not repeat their expressions."""
    return df.select(F.explode(F.array(F.struct(*columns))).alias("v")).select("v.*")


def _passages(docs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """``doc_id, line, license_id, dice`` of sentences and runs of pieces.
    ``docs``: ``doc_id, text, grams``."""
    rare = known.select(F.explode("rare").alias("gram")).agg(F.collect_set("gram").alias("rare_grams"))
    some = _only(docs.join(F.broadcast(rare), F.arrays_overlap("rare_grams", "grams")), F.col("doc_id"), F.col("text"),
                 F.col("grams"), F.array_intersect("rare_grams", "grams").alias("hits"))
    near = (some.join(F.broadcast(known), F.arrays_overlap("rare", "hits")
                      & (F.size(F.array_intersect("known", "grams")) >= F.col("lo"))).drop("grams", "hits", "rare"))
    pieces = F.flatten(F.transform(F.split("text", "\n"), lambda line, i: F.transform(
        F.split(line, r"(?<=[.!?:;])\s+"), lambda p: F.struct((i + 1).alias("line"), plain_words(p).alias("words")))))
    d = _only(near, F.col("doc_id"), F.col("license_id"), F.col("known"), F.col("known_size"),
              F.col("least_words"), F.col("most_words"), F.filter(pieces, lambda v: F.size(v["words"]) > 0).alias("pieces"))
    upto = F.aggregate("pieces", F.array(F.lit(0)), lambda acc, v: F.concat(
        acc, F.array(F.element_at(acc, -1) + F.size(v["words"]))))

    def mark(v: Column, k: Column) -> Column:
        """Has a piece bigrams of the template, only such, and one with the last word before it?"""
        own = F.when(F.size(v["words"]) > 1, bigrams(v["words"])).otherwise(F.array().cast("array<bigint>"))
        before = F.element_at(F.get("pieces", F.greatest(k - 1, F.lit(0)))["words"], -1)
        return F.transform(F.array(F.size(F.array_intersect(own, F.col("known")))), lambda m: F.struct(
            (m > 0).alias("some"), (m == F.size(own)).alias("only"),
            ((k > 0) & F.array_contains("known", F.xxhash64(before, F.get(v["words"], 0)))).alias("joined")))

    d = _only(d, *[F.col(c) for c in d.columns], upto.alias("upto"),
              F.flatten(F.transform("pieces", mark)).alias("marks"))
    n = F.size("pieces")
    at = lambda i: F.get("marks", i - 1)
    # a piece without bigrams of the template at an end lowers the coefficient, one more of
    # only such bigrams does not: no run begins or ends with the one or before the other
    first = F.filter(F.sequence(F.lit(1), n), lambda i: (F.col("known_size") == 1) | (
        (at(i)["some"] | ((i < n) & at(F.least(i + 1, n))["joined"]))
        & ((i == 1) | ~(at(F.greatest(i - 1, F.lit(1)))["only"] & at(i)["joined"]))))
    last = F.filter(F.sequence(F.lit(1), n), lambda j: (F.col("known_size") == 1) | (
        (at(j)["some"] | at(j)["joined"])
        & ((j == n) | ~(at(F.least(j + 1, n))["only"] & at(F.least(j + 1, n))["joined"]))))
    d = _only(d.filter(n > 0), *[F.col(c) for c in d.columns if c != "marks"], first.alias("firsts"), last.alias("lasts"))

    def run(i: Column, j: Column) -> Column:
        own = bigrams(F.flatten(F.transform(F.slice("pieces", i, j - i + 1), lambda v: v["words"])))
        return F.transform(F.array(own), lambda g: F.struct(
            (2 * F.size(F.array_intersect(g, F.col("known"))) / (F.size(g) + F.col("known_size"))).alias("dice"),
            (-i).alias("first"), (-j).alias("last")))

    def runs(i: Column) -> Column:
        size = lambda j: F.get("upto", j) - F.get("upto", i - 1)
        ends = F.filter("lasts", lambda j: (j >= i) & size(j).between(F.col("least_words"), F.col("most_words")))
        return F.filter(F.flatten(F.transform(ends, lambda j: run(i, j))), lambda v: 100 * v["dice"] >= percent)

    every = F.flatten(F.transform("firsts", runs))
    d = _only(d, F.col("doc_id"), F.col("license_id"), F.col("pieces"), F.sort_array(every, asc=False).alias("runs"))
    # best first; ends are negated, so equal ones come by place
    best = F.aggregate("runs", F.slice("runs", 1, 0), lambda acc, v: F.when(
        F.exists(acc, lambda x: (x["first"] >= v["last"]) & (v["first"] >= x["last"])), acc)
        .otherwise(F.concat(acc, F.array(v))))
    whole = lambda v: (v["first"] == -1) & (v["last"] == -F.size("pieces"))
    return (d.select("doc_id", "license_id", "pieces", F.explode(F.filter(best, lambda v: ~whole(v))).alias("v"))
            .select("doc_id", F.get("pieces", -F.col("v.first") - 1)["line"].alias("line"), "license_id", "v.dice"))


def scan(docs: DataFrame, notices: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text",
         percent: int = 80, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, line, license_id, dice``: units whose Dice coefficient
    with a template is at least ``percent``. ``line`` counts from 1 and is where
    the unit begins; 0 is the whole text of several lines."""
    spark = docs.sparkSession
    notices = templates(spark) if notices is None else notices
    known = stored(
        notices.select("license_id", plain_words(F.col("text")).alias("words"))
        .select("license_id", _longest_first(F.col("words")).alias("grams"), F.size("words").alias("n_words"))
        .withColumn("size", F.size("grams")).filter("size > 0").distinct(), "license-templates")
    # dice = 2 common / (a + b) and common <= min(a, b)
    lo = F.ceil(F.col("size") * F.lit(percent) / F.lit(200 - percent)).cast("int")
    hi = F.floor(F.col("size") * F.lit(200 - percent) / F.lit(percent)).cast("int")
    known = known.withColumn("lo", lo).withColumn("hi", hi)
    total = known.agg(F.sum(F.col("size") + F.col("hi") - F.col("lo") + 1)).first()[0]
    blocks = max(1, -(-int(total or 0) // block_words))

    # texts without any word that a match must hold are left out before words are cut;
    # all texts are read once, what is left is written and read again
    if blocks == 1:
        held = keywords([r[0] for r in notices.select(plain_words(F.col("text"))).collect()], percent)
        held = [w for w in held if not any(o != w and o in w for o in held)]
        # over an array of one, so that the text is lower-cased once and not for each word
        some = F.exists(F.array(F.lower(F.coalesce(F.col(text_col), F.lit("")))),
                        lambda t: reduce(lambda a, b: a | b, [t.contains(w) for w in held], F.lit(False)))
        docs = stored(docs.filter(some).select(F.col(id_col), F.col(text_col)), "license-candidates")

    # the words of a text are those of its lines, one after the other: one pass gives all units
    words = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), plain_words)
    per_text = _only(docs, F.col(id_col).alias("doc_id"), words.alias("lines"))
    each = F.transform("lines", lambda w, i: F.struct((i + 1).alias("line"), w.alias("words")))
    whole = F.array(F.struct(F.lit(0).alias("line"), F.flatten("lines").alias("words")))
    units = F.when(F.size("lines") > 1, F.concat(whole, each)).otherwise(each)
    sized = (per_text.select("doc_id", F.explode(units).alias("u"))
             .select("doc_id", "u.line", bigrams(F.col("u.words")).alias("grams"))
             .withColumn("size", F.size("grams")))
    texts_ = _only(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                   bigrams(plain_words(F.col(text_col))).alias("grams"))
    found = []
    for b in range(blocks):
        own = (known.filter(F.pmod(F.xxhash64("license_id", "grams"), F.lit(blocks)) == b)
               .select("license_id", F.col("grams").alias("known"), F.col("size").alias("known_size"), "lo", "hi",
                       F.floor(F.col("n_words") * F.lit(percent) / F.lit(200 - percent)).alias("least_words"),
                       F.ceil(F.col("n_words") * F.lit(200 - percent) / F.lit(percent)).alias("most_words"),
                       F.xxhash64("license_id", "grams", "n_words").alias("template")))
        # a unit with all but the rare ones has less than lo bigrams of the template
        found.append(_passages(texts_, own.withColumn("rare", F.slice("known", F.lit(1), F.col("known_size") - F.col("lo") + 1))
                               .drop("template"), percent))
        sizes = own.select("template", F.explode(F.sequence("lo", "hi")).alias("size"))
        near = sized.join(F.broadcast(sizes), "size").join(F.broadcast(own.select("template", "license_id", "known", "known_size")), "template")
        dice = 2 * F.size(F.array_intersect("grams", "known")) / (F.col("size") + F.col("known_size"))
        hit = F.filter(F.array(F.struct("license_id", dice.alias("dice"))), lambda v: 100 * v["dice"] >= percent)
        found.append(near.select("doc_id", "line", F.explode(hit).alias("v"))
                     .select("doc_id", "line", "v.license_id", "v.dice"))
    return (reduce(DataFrame.unionByName, found).groupBy("doc_id", "line", "license_id")
            .agg(F.max("dice").alias("dice")))

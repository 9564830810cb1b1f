"""Line-first cleaning with DataFrame functions only.

Each line is judged on its own; failing lines are removed; a document that
loses too large a share of its words is rejected. The rules for a line with at
least one word:

- punctuation: punctuation and symbol characters make up more than
  ``punctuation_percent`` of its words (for instance ``!!`` or ``***`` after
  every word), or a line of at least ``long_line`` words has no sentence mark
  at all;
- navigation: three or more bars or arrows between words, or a line of at most
  ``short_line`` words that holds a navigation phrase;
- boilerplate: a line of at most ``notice_line`` words that holds a boilerplate
  phrase.

Blank lines stay. Document statistics are taken over the whole text. The
statistics need no shuffle: everything is computed inside a row. Positions that
may lie in a repeated window are found by sorting 32-bit prints of the windows;
they are confirmed on 64-bit hashes of the words.

Null text counts as an empty text: no words, ``base_failed``. Other columns,
repeated rows and null ids pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import WORD_GAP, words_of

SYMBOLS = "[#*$%&|<>]"
#: Punctuation that makes a line look like decoration when it is dense.
MARKS = "[!?#*$%&|<>=_~^{}\\[\\]\\\\]"
SENTENCE = "[.!?:;,…。！？]"
BARS = "[|»›•·→]"
NAVIGATION = ("(skip to content|back to top|next page|previous page|read more|click here|sign in|sign up"
              "|log in|main menu|site map|share this|home page|load more)")
BOILERPLATE = ("(lorem ipsum|enable javascript|cookie policy|privacy policy|terms of use|terms of service"
               "|accept cookies|all rights reserved)")

RULES = dict(punctuation_percent=100, long_line=25, short_line=8, notice_line=12, max_loss_percent=50,
             min_words=50, max_repeat_percent=50)


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))


def line_fails(line: Column, words: Column, p: dict) -> Column:
    low = F.lower(line)
    return ((100 * F.regexp_count(line, F.lit(MARKS)) > p["punctuation_percent"] * words)
            | ((words >= p["long_line"]) & ~line.rlike(SENTENCE))
            | (F.regexp_count(line, F.lit(BARS)) >= 3)
            | ((words <= p["short_line"]) & low.rlike(NAVIGATION))
            | ((words <= p["notice_line"]) & low.rlike(BOILERPLATE)))


def line_statistics(docs: DataFrame, text_col: str = "text", width: int = 3, **rules) -> DataFrame:
    """``docs`` with the columns ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, lost_words, base_failed, kept, clean_text``; columns of
    those names are replaced."""
    p = RULES | rules
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words",
            "base_failed", "kept", "clean_text"]
    keep = [c for c in docs.columns if c not in made]
    t = F.col("_text")
    d = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    d = d.withColumn("_words", words_of(t)).withColumn("n_words", F.size("_words").cast("long"))

    # windows of `width` words: prints (32 bits of the hash, position), sorted
    w = F.col("_words")
    window_hash = F.transform(
        F.when(F.col("n_words") >= width, F.sequence(F.lit(1), (F.col("n_words") - (width - 1)).cast("int")))
        .otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(width)]))
    d = d.withColumn("_hash", window_hash)
    d = d.withColumn("_prints", F.sort_array(F.transform("_hash", lambda h, i: F.shiftleft(
        h.bitwiseAND(F.lit(0xFFFFFFFF)), 31).bitwiseOR(i.cast("long")))))
    s = F.col("_prints")

    def near(values: Column, x: Column, i: Column, part) -> Column:
        return (F.coalesce(part(F.get(values, i - 1)) == part(x), F.lit(False))
                | F.coalesce(part(F.get(values, i + 1)) == part(x), F.lit(False)))

    d = d.withColumn("_maybe", F.transform(
        F.filter(s, lambda x, i: near(s, x, i, lambda v: F.shiftright(v, 31))),
        lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")))
    h = F.col("_hash")
    d = d.withColumn("_sure", F.sort_array(F.transform("_maybe", lambda i: F.struct(
        F.get(h, i).alias("h"), i.alias("i")))))
    e = F.col("_sure")
    d = d.withColumn("_at", F.sort_array(F.transform(
        F.filter(e, lambda x, i: near(e, x, i, lambda v: v["h"])), lambda x: x["i"])))
    covered = F.aggregate(
        "_at", F.struct(F.lit(-width).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    d = d.withColumn("n_repeat_words", covered)

    # lines
    d = d.withColumn("_lines", F.split(t, "\n"))
    d = d.withColumn("_full", F.filter("_lines", lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    d = d.withColumn("_judged", F.transform("_lines", lambda x: F.struct(x.alias("line"), n_words(x).alias("words"))))
    d = d.withColumn("_bad", F.filter("_judged", lambda x: (x["words"] > 0) & line_fails(x["line"], x["words"], p)))
    lost = F.aggregate("_bad", F.lit(0).cast("long"), lambda acc, x: acc + x["words"])
    good = F.filter("_judged", lambda x: ~((x["words"] > 0) & line_fails(x["line"], x["words"], p)))
    failed = ((F.col("n_words") < p["min_words"])
              | (100 * F.col("n_repeat_words") > p["max_repeat_percent"] * F.col("n_words")))
    made = F.struct(
        "n_words", F.length(F.regexp_replace(t, WORD_GAP, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", lost.alias("lost_words"), failed.alias("base_failed"),
        (~failed & (100 * lost <= p["max_loss_percent"] * F.col("n_words"))).alias("kept"),
        F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("clean_text"))
    # Results leave through a generator: a filter on them is not pushed below it,
    # where it would repeat all of the above inside one expression.
    return (d.select(*[F.col(f"`{c}`") for c in keep], F.explode(F.array(made)).alias("_made"))
            .select(*[F.col(f"`{c}`") for c in keep], "_made.*"))

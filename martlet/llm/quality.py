"""Quality rules by distribution divergence.

Each document's histogram of character classes and its histogram of common words are
compared with those of its language's documents by the Jensen-Shannon distance (base 2, so
between 0 and 1). References are counted over all documents of the language: its
``COMMON`` most frequent words with all others in one bin, and its character classes. Every language with
``LEAST_WORDS`` words in all has a reference of its own, however rare it is; documents of other languages, or of none, are not
judged by distance, as a mix of languages is no measure for them.

References are a stored table of one row a language. They are broadcast up to ``SMALL`` languages, and beyond that joined
with a salt, so that a language that holds a third of the documents is spread over tasks.
Plain length and repetition rules come first; all texts that pass them are judged.

The bounds on words come from each reference. A text without any of its common words has a
fixed distance; the squared bound is the share ``FAR_SHARE`` of that squared, widened by what
sampling alone adds to a text of n words, which falls with 1 / n. Short texts scatter so
widely that this can't reject one without common words, so a text is rejected as well
when it has less than half the reference's share of common words and so few are
improbable (Chernoff's bound under e ** -``FEW``) at its length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from martlet.llm.native import let, upto, words
from martlet.llm.tables import store

COMMON, LEAST_WORDS = 50, 1000
#: Longer words (in bytes) aren't candidates for a language's common words.
LONGEST = 64
#: Languages up to which references are broadcast, and tasks over which one language is spread beyond it.
SMALL, SALTS = 1000, 32
FAR_SHARE, FEW, MAX_CHAR_DISTANCE = 0.3, 6.0, 0.25
REPEAT = 8
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "punctuation": "[!-/:-@\\[-`{-~]"}


def repeated_words(w: Column) -> Column:
    """Words in windows of REPEAT words that occur twice or more in the list, the first occurrence included."""
    def of_hashes(h: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return let(F.array_sort(F.transform(same, lambda x: x["i"])), lambda p: F.aggregate(
                upto(F.size(p)), F.lit(0), lambda n, j: n + F.when(j == F.size(p), REPEAT).otherwise(F.least(F.lit(REPEAT), F.get(p, j) - F.get(p, j - 1)))))
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, of_sorted))
    return let(F.transform(upto(F.size(w) - (REPEAT - 1)), lambda i: F.xxhash64(F.slice(w, i, REPEAT))), of_hashes)


def _histogram(w: Column, common) -> Column:
    """(word, n) of the listed words (texts, or a column of them) in a word list."""
    def of_sorted(s: Column) -> Column:
        ends = F.filter(upto(F.size(s)), lambda i: F.coalesce(F.get(s, i) != F.get(s, i - 1), F.lit(True)))
        return let(ends, lambda e: F.transform(e, lambda i, j: F.struct(F.get(s, i - 1).alias("word"), (i - F.coalesce(F.get(e, j - 1), F.lit(0))).alias("n"))))
    def listed(x: Column) -> Column:
        return F.array_contains(common, x) if isinstance(common, Column) else x.isin(common) if common else F.lit(False)
    return let(F.sort_array(F.filter(w, listed)), of_sorted)


def references(docs: DataFrame) -> DataFrame:
    """(key, ref_words, ref_shares): the most frequent words of each language with LEAST_WORDS words, and their shares of all its words."""
    counts = docs.filter("lang is not null").select("lang", F.explode(words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    counts = store(counts, "quality_words")
    total = counts.groupBy(F.col("lang").alias("key")).agg(F.sum("n").alias("total")).filter(F.col("total") >= LEAST_WORDS)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))     # Spark keeps COMMON a language before the shuffle
    top = counts.filter(F.octet_length("word") <= LONGEST).withColumn("place", place).filter(F.col("place") <= COMMON)
    shares = top.join(total, F.col("lang") == F.col("key")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct((F.col("n") / F.col("total")).alias("q"), "word")), asc=False).alias("r"))
    return store(shares.select("key", F.col("r.word").alias("ref_words"), F.col("r.q").alias("ref_shares")), "quality_references")


def _with(rows: DataFrame, known: DataFrame, few: bool) -> DataFrame:
    """``rows`` (lang, ...) with the columns of their language's row of ``known`` (key, ...)."""
    if few:
        return rows.join(F.broadcast(known), F.col("lang") == F.col("key"), "left").drop("key")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(SALTS)))
    spread = known.withColumn("salted", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(spread, (F.col("lang") == F.col("key")) & (F.col("salt") == F.col("salted")), "left").drop("key", "salt", "salted")


def _term(p: Column, q: Column) -> Column:
    """Share of one bin in the Jensen-Shannon divergence."""
    return (F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0) + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)) / 2


def _unlike(n: Column, share: Column, mass: Column, common: Column, squared: Column) -> Column:
    """Whether a text of ``n`` words isn't in its reference's language, by the squared distance and the share of common words."""
    none = mass / 2 + _term(F.lit(1.0), F.greatest(F.lit(0.0), 1 - mass))
    few = F.when(share > 0, share * F.log(share / mass)).otherwise(0.0) + (1 - share) * F.log((1 - share) / (1 - mass))
    return F.when((mass > 0) & (mass < 1), (squared > FAR_SHARE * none + common / (8 * math.log(2) * n)) | ((2 * share < mass) & (n * few > FEW))).otherwise(F.lit(False))


def assess(docs: DataFrame, small: int = SMALL) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, word_distance, char_distance).

    ``docs`` has doc_id, text and lang; other columns are ignored. A document fails the plain
    rules with fewer than 20 words, or with more than 30 % of its words in repeated windows.
    It isn't kept if it fails these, has a distance over its bound, or lacks its language's common words.
    Null texts have no words; documents of unknown language, or of one with fewer than LEAST_WORDS words in all, have
    distance 0 and are judged by the plain rules. Every row is judged by itself, repeated ones and those without id too; long texts
    are looked at whole. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    wordy = references(docs)
    few = wordy.select("key").limit(small + 1).count() <= small
    listed = sorted({w for r in wordy.select("ref_words").collect() for w in r["ref_words"]}) if few else F.col("ref_words")

    worded = docs.withColumn("w", words(F.col("text"))).withColumn("n_chars", F.char_length("text"))
    if not few:
        worded = _with(worded, wordy.drop("ref_shares"), few)
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    measured = worded.select(
        "doc_id", "lang", F.size("w").cast("long").alias("n_words"), F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all("text", F.lit("[#*$%&|<>]"), F.lit(0))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"), F.coalesce(_histogram(F.col("w"), listed), F.array().cast("array<struct<word:string,n:int>>")).alias("histogram"),
        "n_chars", F.greatest(F.lit(0), F.octet_length("text") - F.col("n_chars")).alias("wide"),
        *[F.size(F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(c) for c, p in CLASSES.items()])
    measured = measured.withColumn("blank", F.col("n_chars") - F.col("word_chars"))
    measured = store(measured.withColumn("letter", F.greatest(F.lit(0), F.col("n_chars") - F.col("blank") - F.col("upper") - F.col("digit") - F.col("punctuation"))), "quality")

    bins = ["letter", "wide", "blank", *CLASSES]
    chars = measured.filter("lang is not null").groupBy(F.col("lang").alias("of")).agg(*[F.sum(c).alias(f"ref_{c}") for c in bins])
    known = chars.join(wordy, F.col("of") == F.col("key")).drop("of")
    joined = _with(measured, known, few)

    mass, ref_mass = sum(F.col(c) for c in bins), sum(F.col(f"ref_{c}") for c in bins)
    char_js = sum(_term(F.col(c) / F.col("mass"), F.col(f"ref_{c}") / F.col("ref_mass")) for c in bins)
    shared = F.filter(F.transform("histogram", lambda x: F.struct((x["n"] / F.col("n_words")).alias("p"), F.get(F.col("ref_shares"), (F.array_position("ref_words", x["word"]) - 1).cast("int")).alias("q"))), lambda x: x["q"].isNotNull())
    def sum_of(xs, f):
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))
    # a reference bin that the document lacks contributes half its share
    word_js = let(shared, lambda xs: sum_of(xs, lambda x: _term(x["p"], x["q"]) - x["q"] / 2) + F.col("ref_mass_words") / 2
                  + _term(F.greatest(F.lit(0.0), 1 - sum_of(xs, lambda x: x["p"])), F.greatest(F.lit(0.0), 1 - F.col("ref_mass_words"))))
    judged = (joined.withColumn("mass", mass).withColumn("ref_mass", ref_mass).withColumn("ref_mass_words", sum_of(F.coalesce("ref_shares", F.array().cast("array<double>")), lambda q: q))
              .withColumn("common_share", F.least(F.lit(1.0), F.when(F.col("n_words") > 0, sum_of(shared, lambda x: x["p"])).otherwise(0.0)))
              .withColumn("squared", F.greatest(F.lit(0.0), word_js))
              .withColumn("char_distance", F.when((F.col("n_words") > 0) & F.col("ref_mass").isNotNull(), F.sqrt(F.greatest(F.lit(0.0), char_js))).otherwise(0.0))
              .withColumn("word_distance", F.when(F.col("n_words") > 0, F.sqrt("squared")).otherwise(0.0)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    unlike = _unlike(F.col("n_words"), F.col("common_share"), F.col("ref_mass_words"), F.size(F.coalesce("ref_shares", F.array().cast("array<double>"))), F.col("squared"))
    far = ~failed & (unlike | (F.col("char_distance") > MAX_CHAR_DISTANCE))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"),
                         "word_distance", "char_distance")

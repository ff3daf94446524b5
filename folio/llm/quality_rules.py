"""Quality rules: counts of a text's faults, and a hashed n-gram likelihood ratio.

DataFrame operations only.  Counts are array expressions over a text's words and
lines.  The verdict compares two multinomials over hashed n-grams, words by
themselves and pairs of neighbours' forms (letters and digits reduced to their
kind, runs to one): that of a trusted target, texts labelled good, and that of the whole raw corpus.  A text's score
is its log-likelihood ratio divided by its number of n-grams; a text is kept if
the score reaches ``THRESHOLD``, a fixed number, so equal texts fare alike.

The trusted texts are all that are labelled good; raw counts cover every row.
What is collected is one ratio for each of ``2 * BUCKETS`` buckets.

Defined cases: a null, empty or blank text has no words, and so fails (fewer
than 50 words); without trusted texts all ratios are 0 and the base rules alone
decide; repeated rows are judged alike, each for itself; an empty table gives an
empty result; other columns are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that n-grams of one length are hashed into.
BUCKETS = 4_096
#: Least log-likelihood ratio for each n-gram.
THRESHOLD = -0.4
MIN_WORDS = 50
MAX_REPEATED = 50

#: The six white-space characters between words, and the symbols that are counted.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

_LOWER = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)
_DIGITS = "0123456789"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _once(column: Column) -> Column:
    """The column, marked as nondeterministic: the optimiser then never copies it into what uses it.

    A copy inside a lambda, such as a filter on the verdict would make when it is
    pushed down, would be evaluated anew for each element.
    """
    return F.when(F.monotonically_increasing_id() >= 0, column)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def with_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) with words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("words", _once(words_of(F.col("text")))).withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn("word_chars", F.length(_without(text, BLANKS)).cast("long"))
    df = df.withColumn("n_symbols", (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"))
    df = df.withColumn("lines", _once(F.filter(F.split(text, "\n"), lambda x: _without(x, BLANKS) != "")))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    words = F.col("words")
    inner = F.slice(words, 1, F.greatest(F.col("n_words").cast("int") - 2, F.lit(0)))
    df = df.withColumn("windows", _once(F.transform(inner, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))))
    # what a lambda looks up by place has to be a column, or it would be made anew for each element
    ranked = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("ranked", _once(F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ranked)))
    df = df.withColumn("places", _once(_repeated_places(F.col("ranked"))))
    places = F.col("places")
    reach = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
    df = df.withColumn("n_repeat_words", F.coalesce(F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long"))
    return df.drop("windows", "ranked", "places")


def _repeated_places(ranked: Column) -> Column:
    """Places, in order, of the windows that are found twice or more; ``ranked``: (hash, place) sorted."""
    twice = F.transform(ranked, lambda x, k: F.when((F.get(ranked, k - 1)["h"] == x["h"]) | (F.get(ranked, k + 1)["h"] == x["h"]), x["i"]))
    return F.sort_array(F.filter(twice, lambda i: i.isNotNull()))


def forms_of(text: Column) -> Column:
    """Words with letters and digits replaced by their kind and runs of one character by it."""
    kinds = F.translate(F.coalesce(text, F.lit("")), _LOWER + _UPPER + _DIGITS, "a" * len(_LOWER) + "A" * len(_UPPER) + "9" * len(_DIGITS))
    return words_of(F.regexp_replace(kinds, "(\\S)\\1+", "$1"))


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the labelled good texts, each once."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log of trusted over raw probability of each bucket of words, then of pairs of forms; counts start at one."""
    good = trusted_ids(labels).withColumn("trusted", F.lit(1))
    # texts, not their words, go through the join: they are smaller; the labels grow with the table, so are never broadcast
    marked = docs.select("doc_id", "text").join(good.hint("shuffle_hash"), "doc_id", "left").select("trusted", _once(words_of(F.col("text"))).alias("words"), _once(forms_of(F.col("text"))).alias("forms"))
    follow = F.slice("forms", 2, F.greatest(F.size("forms"), F.lit(1)))
    pairs = marked.select("trusted", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("forms").alias("own"), follow.alias("next"))))
    grams = pairs.select("trusted", _bucket(F.col("word")).alias("one"), F.when(F.col("next").isNotNull(), _bucket(F.col("own"), F.col("next"))).alias("two"))
    met = grams.groupBy("one", "two").agg(F.count("*").alias("raw"), F.count("trusted").alias("good"))
    both = F.explode(F.array("one", F.col("two") + BUCKETS)).alias("bucket")
    each = met.select(both, "raw", "good").filter("bucket is not null")
    table = {r.bucket: (r.raw, r.good) for r in each.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()}
    out = []
    for first in (0, BUCKETS):
        own = [table.get(first + i, (0, 0)) for i in range(BUCKETS)]
        raw, good = sum(r for r, _ in own) + BUCKETS, sum(g for _, g in own) + BUCKETS
        if good == BUCKETS:
            return [0.0] * (2 * BUCKETS)
        out += [math.log((g + 1) / good) - math.log((r + 1) / raw) for r, g in own]
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept."""
    return _judged(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels).select(F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are kept, all columns as they are."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"))
    return _judged(own, labels).filter("kept").select("whole_row.*")


def _judged(own: DataFrame, labels: DataFrame) -> DataFrame:
    weights = F.expr("cast(split('" + ",".join(f"{x:.6f}" for x in ratios(own, labels)) + "', ',') as array<double>)")
    forms, words = F.col("forms"), F.col("words")

    def of(f: Column, i: Column) -> Column:
        follow = F.get(forms, i + 1)
        return F.get(weights, _bucket(F.get(words, i))) + F.when(follow.isNotNull(), F.get(weights, F.lit(BUCKETS) + _bucket(f, follow))).otherwise(0.0)

    df = with_counts(own).withColumn("forms", _once(forms_of(F.col("text"))))
    total = F.aggregate(F.transform(forms, of), F.lit(0.0), lambda a, x: a + x)
    df = df.withColumn("score", F.when(F.size(forms) > 0, total / (2 * F.size(forms) - 1)).otherwise(0.0))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= THRESHOLD))

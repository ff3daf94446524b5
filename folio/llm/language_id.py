"""Language identification by words first, then ever shorter character n-grams.

A known word scores its log frequency in each language.  A word that no training
text has is covered from left to right by the longest known n-grams (``LONGEST``
characters down to one) and scores their log frequencies.  A text's language
has the largest sum; its score is the winner's share in the softmax of the sums
for each word.

Learned from ``TRAIN_ROWS`` texts with a language at most, dealt evenly over all
languages: each gets an equal number, one at least, and a rarer one all that it
has.  The tables keep the ``MODEL_WORDS`` words met in most texts and the
``MODEL_GRAMS`` n-grams met most in different words, fewer where languages are
so many that the tables would pass ``MODEL_VALUES``.  Sums run over whole texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
without any training text so is everything; ties go to the language that sorts
first; repeated rows are predicted alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import checkpointed, sampled

#: Texts that are learned from, at most (one for each language where these are more).
TRAIN_ROWS = 4_000
#: Words that the tables keep, those met in most texts, and n-grams, those met most in different words.
MODEL_WORDS = 40_000
MODEL_GRAMS = 40_000
#: Values that either table holds at most, one for each entry and language.
MODEL_VALUES = 8_000_000
LONGEST = 5
#: What a text adds to the count of each entry of each language before any is seen.
SMOOTHING = 0.1
CACHED_WORDS = 200_000
UNKNOWN = "und"
#: Parts that rows are hashed into to be chosen by a share: far more than any table has rows.
SHARES = 2**62

WORDS = re.compile(r"[^\W\d_]+")


def grams_of(word: str) -> Iterator[str]:
    marked = f"<{word}>"
    for n in range(1, LONGEST + 1):
        for i in range(len(marked) - n + 1):
            yield marked[i : i + n]


@dataclass
class Model:
    """Tables of log frequencies, one value for each language; bounded, so it can be sent to every task."""

    languages: list[str] = field(default_factory=list)
    words: dict[str, np.ndarray] = field(default_factory=dict)
    grams: dict[str, np.ndarray] = field(default_factory=dict)

    def of_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        # longest known n-grams, left to right; the mean keeps a long word from outweighing known ones
        marked, at, found, total = f"<{word}>", 0, 0, np.zeros(len(self.languages))
        while at < len(marked):
            for n in range(min(LONGEST, len(marked) - at), 0, -1):
                gram = self.grams.get(marked[at : at + n])
                if gram is not None:
                    total, found, at = total + gram, found + 1, at + n
                    break
            else:
                at += 1
        return total / max(found, 1)

    def predict(self, text: str | None, cache: dict[str, np.ndarray]) -> tuple[str, float]:
        counts = Counter(WORDS.findall(text.lower())) if text and self.languages else None
        if not counts:
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.languages)), 0
        rows = []
        for word in counts:
            own = cache.get(word)
            if own is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                cache[word] = own = self.of_word(word)
            rows.append(own)
        times = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        total, n = times @ np.array(rows), times.sum()
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp((total - total[best]) / n).sum())


def _word_counts(sample: DataFrame) -> DataFrame:
    """word, lang, n: occurrences, texts: texts that have it."""
    schema = pa.schema([("word", pa.string()), ("lang", pa.string()), ("n", pa.int64()), ("texts", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: dict[str, Counter] = {}
            texts: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = Counter(WORDS.findall((text or "").lower()))
                n.setdefault(lang, Counter()).update(words)
                texts.setdefault(lang, Counter()).update(words.keys())
            rows = [(w, lang, k, texts[lang][w]) for lang, own in n.items() for w, k in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    rows = sample.select("text", "lang").mapInArrow(work, "word string, lang string, n long, texts long")
    return rows.groupBy("word", "lang").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """gram, lang, n: places in a language's different words that have it."""
    schema = pa.schema([("word", pa.string()), ("lang", pa.string()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: dict[str, Counter] = {}
            for word, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n.setdefault(lang, Counter()).update(grams_of(word))
            rows = [(g, lang, k) for lang, own in n.items() for g, k in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    rows = words.select("word", "lang").mapInArrow(work, "word string, lang string, n long")
    return rows.groupBy("word", "lang").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, teaching: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Learn from the ``teaching`` rows (id and language) of ``docs``; null languages and ids aren't used."""
    known = teaching.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, F.col(lang_col).alias("lang"))
    most = known.groupBy("lang").count().collect()  # a row for each language
    languages = sorted(r.lang for r in most)
    if not languages:
        return Model()
    each = max(1, rows // len(languages))
    # the share of each language's rows that gives ``each`` of them, more than twice over for chance; then exactly ``each`` at most
    share = {r.lang: min(1.0, (2 * each + 50) / r["count"]) for r in most}
    limit = F.element_at(F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(int(v * SHARES)))]), F.col("lang"))
    even = known.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit("lang")), F.lit(SHARES)) < limit)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(id_col), id_col))
    even = even.groupBy(id_col).agg(F.max("lang").alias("lang")).withColumn("place", place).filter(F.col("place") <= each).drop("place")
    sample = sampled(docs.select(id_col, F.col(text_col).alias("text")), even, max(rows, len(languages)), id_col)
    words = checkpointed(_word_counts(sample))
    model = Model(languages)
    for counts, rank, least, table, size in ((words, "texts", 2, model.words, MODEL_WORDS), (_gram_counts(words), "n", 1, model.grams, MODEL_GRAMS)):
        size = max(1, min(size, MODEL_VALUES // len(languages)))
        each_token = counts.groupBy("word").agg(F.sum(rank).alias("rank"), *[F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(languages)])
        kept = each_token.filter(F.col("rank") >= least).orderBy(F.desc("rank"), "word").limit(size).collect()
        n = np.array([r[2:] for r in kept], dtype=np.float64).reshape(len(kept), len(languages))
        logs = np.log((n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * size))
        table.update((r.word, own) for r, own in zip(kept, logs, strict=True))
    return model


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([(id_col, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = sent.value, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                found = [own.predict(t, cache) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], schema=schema)

    return df.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(work, f"`{id_col}` long, lang_pred string, score double")

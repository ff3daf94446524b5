"""Toxicity by maximum-scoring segments.

Words score their log-odds of standing in toxic rather than other texts, under
nested Dirichlet priors: a word's share is drawn towards that of its beginning,
a beginning's towards the share of all.  Of the running sum of scores (less a
drift that makes ordinary text negative) one linear scan finds every maximal
scoring segment; segments beyond what chance gives in a text of that length, by
an extreme-value fit to texts that are not toxic, are the toxic passages.  Their
joint significance (all segments add to it, weak ones little), calibrated on labelled texts that gave no counts, is the score.

Everything learned comes from at most ``TRAIN_ROWS`` labelled texts; texts that
are equal count once.  Labels are 0 or 1; null labels and null ids are not used.

Defined cases: null and empty texts have no segment and get the calibrated
score of none; without a label of each kind every text scores 0; repeated rows
score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import sampled

#: Labelled texts that are learned from, at most.
TRAIN_ROWS = 12_000
#: Words and beginnings that the model keeps, those that tell most.
MODEL_WORDS = 20_000
MODEL_PREFIXES = 10_000
PREFIX = 4
#: Strength of the priors, in texts.
WORD_PRIOR, PREFIX_PRIOR = 4.0, 20.0
DRIFT = 1.0
CLIP = (-2.0, 8.0)
#: Chance at which a segment counts as a toxic passage.
SIGNIFICANCE = 0.01
CACHED_WORDS = 300_000

WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments, left to right, in linear time."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # start, end, sum before, sum at the end, nearest earlier one with a smaller sum before
    for i in np.flatnonzero(scores > 0).tolist():
        new = [i, i + 1, sums[i], sums[i + 1], -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            new[4] = j
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, float(after - before)) for a, b, before, after, _ in found]


@dataclass
class Model:
    """What scoring needs; ``words`` and ``prefixes`` are bounded, so it can be sent to every task."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    rest: float = -DRIFT
    location: float = 0.0
    scale: float = 1.0
    weight: float = 1.0
    bias: float = -2.0
    known: bool = False

    def scores(self, words: list[str], cache: dict[str, float]) -> np.ndarray:
        def learn(word: str) -> float:
            if len(cache) >= CACHED_WORDS:
                cache.clear()
            cache[word] = s = self.words.get(word, self.prefixes.get(word[:PREFIX], self.rest))
            return s

        get = cache.get
        found = np.array([learn(w) if (s := get(w)) is None else s for w in words], dtype=np.float64)
        again = np.array([False, *map(str.__eq__, words[1:], words)], dtype=bool)[: len(words)]
        return np.where(again, np.minimum(found, self.rest), found)  # a stutter says a word once

    def segments(self, words: list[str], cache: dict[str, float]) -> list[tuple[int, int, float]]:
        return maximal_segments(self.scores(words, cache))

    def log_chance(self, score: float, n: int) -> float:
        """log of the chance that some segment of ``n`` ordinary words scores so much: Gumbel, moved by log(n)."""
        z = (score - self.location) / self.scale - np.log(max(n, 1))
        rate = np.exp(-np.clip(z, -30, 500))
        return float(np.log(-np.expm1(-rate))) if rate > 1e-8 else float(-z)

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> float:
        """Joint significance of all passages.  Chance adds little: pi^2 / 6 on average by the fit, at any length."""
        return float(np.log1p(sum(-self.log_chance(s, n) for _, _, s in segments)))

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weight * evidence + self.bias, -50, 50)))) if self.known else 0.0


def _counts(sample: DataFrame) -> DataFrame:
    """kind (0 word, 1 beginning, 2 all), token, texts with it that are toxic (y1) and that are not (y0)."""
    schema = pa.schema([("kind", pa.int32()), ("token", pa.string()), ("y1", pa.int64()), ("y0", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(words_of(text))
                seen[y].update((0, w) for w in own)
                seen[y].update((1, p) for p in {w[:PREFIX] for w in own})
                seen[y][2, ""] += 1
            tokens = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in tokens], pa.int32()), pa.array([t[1] for t in tokens]), pa.array([seen[1][t] for t in tokens], pa.int64()), pa.array([seen[0][t] for t in tokens], pa.int64())], schema=schema)

    rows = sample.select("text", "y").mapInArrow(work, "kind int, token string, y1 long, y0 long")
    return rows.groupBy("kind", "token").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))


def _log_odds(share: float, of_all: float) -> float:
    return float(np.clip(np.log(share / (1 - share)) - np.log(of_all / (1 - of_all)), *CLIP)) - DRIFT


def _with_scores(model: Model, counts: DataFrame, n1: int, n0: int) -> Model:
    of_all = n1 / (n1 + n0)
    model.rest = -DRIFT
    expected = (F.col("y1") + F.col("y0")) * F.lit(of_all)
    told = counts.filter("y1 + y0 >= 3").withColumn("z", F.abs(F.col("y1") - expected) / F.sqrt(expected * F.lit(1 - of_all) + 1))
    shares = {}
    for r in told.filter("kind = 1").orderBy(F.desc("z"), "token").limit(MODEL_PREFIXES).collect():
        shares[r.token] = (r.y1 + PREFIX_PRIOR * of_all) / (r.y1 + r.y0 + PREFIX_PRIOR)
        model.prefixes[r.token] = _log_odds(shares[r.token], of_all)
    for r in told.filter("kind = 0").orderBy(F.desc("z"), "token").limit(MODEL_WORDS).collect():
        prior = shares.get(r.token[:PREFIX], of_all)
        model.words[r.token] = _log_odds((r.y1 + WORD_PRIOR * prior) / (r.y1 + r.y0 + WORD_PRIOR), of_all)
    return model


def _fit_gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Location and scale of best scores that move with log(n), by moments of the texts that have a segment."""
    own, logs = best > 0, np.log(np.maximum(n, 1))
    if own.sum() < 20:  # log-odds have scale 1; segments of any score are as frequent as they were
        return float(np.log((own.sum() + 0.5) / (len(own) + 1)) - logs.mean()), 1.0
    x, logs = best[own], logs[own]
    scale = max(0.3, float(np.std(x) * np.sqrt(6) / np.pi))
    return float(np.mean(x - scale * logs) - 0.5772 * scale), scale


def _fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Weight and bias by Newton's method with a small ridge."""
    a, theta = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        gradient = a.T @ (p - y) + 0.01 * theta
        hessian = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Learn from ``labels`` rows (id and label); two thirds count words, the rest calibrate."""
    chosen = labels.filter(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("y"))
    sample = sampled(docs, chosen, rows, id_col, text_col).filter("text is not null")
    sample = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("y").alias("y"))
    counting, rest = sample.filter("pmod(h, 3) <> 0"), sample.filter("pmod(h, 3) = 0")
    counts = _counts(counting)
    total = counts.filter("kind = 2").first()
    model = Model()
    if total is None or not total.y1 or not total.y0:
        return model
    _with_scores(model, counts, total.y1, total.y0)
    found = _evidence(rest, model, "h", keep="y").select("y", "best", "words", "segments").collect()  # a third of ``rows`` at most
    y = np.array([r.y for r in found], dtype=np.float64)
    if not 0 < y.sum() < len(y):
        return model
    best, n = np.array([r.best for r in found]), np.array([r.words for r in found])
    model.location, model.scale = _fit_gumbel(best[y == 0], n[y == 0])
    x = np.array([model.evidence([(0, 0, s) for s in r.segments], r.words) for r in found])
    model.weight, model.bias = _fit_logistic(x, y)
    model.known = True
    return model


def _evidence(df: DataFrame, model: Model, id_col: str, keep: str | None = None) -> DataFrame:
    """Scores, the best segment's score, number of words, and scores and word spans of the segments."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    fields = [("id", pa.int64(), "long"), ("y", pa.int64(), "long"), ("score", pa.float64(), "double"), ("best", pa.float64(), "double"), ("words", pa.int64(), "long"), ("segments", pa.list_(pa.float64()), "array<double>"), ("starts", pa.list_(pa.int32()), "array<int>"), ("ends", pa.list_(pa.int32()), "array<int>")]
    schema = pa.schema([(n, t) for n, t, _ in fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = sent.value, {}
        sure = np.log(SIGNIFICANCE)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part, out = batch.slice(at, 1024), [[] for _ in fields]
                for key, y, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = words_of(text)
                    found = own.segments(words, cache)
                    passages = [s for s in found if own.log_chance(s[2], len(words)) <= sure] if own.known else found
                    row = key, y, own.probability(own.evidence(found, len(words))), max((s for _, _, s in found), default=0.0), len(words), [s for _, _, s in passages], [a for a, _, _ in passages], [b for _, b, _ in passages]
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t, _) in zip(out, fields, strict=True)], schema=schema)

    source = df.select(F.col(id_col).cast("long").alias("id"), (F.col(keep) if keep else F.lit(0)).cast("long").alias("y"), "text")
    return source.mapInArrow(work, ", ".join(f"{n} {t}" for n, _, t in fields))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted, and the toxic passages as word spans (starts, ends)."""
    found = _evidence(df.select(F.col(id_col), F.col(text_col).alias("text")), model, id_col)
    return found.select(F.col("id").alias(id_col), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "starts", "ends")


def without_toxic(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text isn't predicted toxic, all columns as they are."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = sent.value, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keep = []
                for text in part.column(part.schema.get_field_index(text_col)).to_pylist():
                    words = words_of(text)
                    keep.append(own.probability(own.evidence(own.segments(words, cache), len(words))) < 0.5)
                yield part.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(work, df.schema)

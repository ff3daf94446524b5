"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

A token's index vector is a sparse ternary vector drawn by its hash.  A frequent
token's word vector adds up the index vectors of its neighbours in the training
texts; any other token has its index vector
alone, at the same length.  A text pools its tokens' vectors and, once more, its
forms' index vectors by their mean, with the shares of stuttered and of
different words and the length beside.  A network of two layers, in numpy, gives a logit;
a temperature fitted on texts that it wasn't trained on makes it a probability.

Tokens of a word are its letters in lower case and its form (letters and digits
by kind, runs reduced to one).

Learned from ``TRAIN_ROWS`` labelled texts at most, equal texts once.  Context
vectors of ``MODEL_TOKENS`` tokens at most are kept, letters and forms together,
those met in most texts; the index vectors of all others need no table.  Pooling
runs over whole texts, and every word of them counts.

Defined cases: null and empty texts pool to zero and get the network's answer to
that; without a label of each kind every text scores 0.5; repeated rows score
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import sampled

#: Labelled texts that are learned from, at most.
TRAIN_ROWS = 6_000
#: Tokens whose context is kept, those met in most texts; others have their index vectors.
MODEL_TOKENS = 4_000
WIDTH = 96
NONZERO = 6
HIDDEN = 32
EPOCHS = 60
CACHED_WORDS = 200_000

_LETTER = re.compile(r"[^\W\d_]+")


def index_vectors(tokens: list[str]) -> np.ndarray:
    """Sparse ternary vectors, a row each, that the tokens' hashes draw."""
    from xxhash import xxh64_intdigest

    out, rows = np.zeros((len(tokens), WIDTH), dtype=np.float32), np.arange(len(tokens))
    h = np.array([xxh64_intdigest(t, 7) for t in tokens], dtype=np.uint64)
    for i in range(NONZERO):
        out[rows, (h >> np.uint64(8 * i)) % np.uint64(WIDTH)] += np.where(h >> np.uint64(56 + i) & np.uint64(1), np.float32(1), np.float32(-1))
    return out


def index_vector(token: str) -> np.ndarray:
    return index_vectors([token])[0]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=-1, keepdims=True), 1e-6)


class _Kinds(dict):
    """Kind of each character, found out once."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        return kind


_KINDS = _Kinds()
_RUN = re.compile(r"(.)\1+")


def form_of(word: str) -> str:
    return _RUN.sub(r"\1", word.translate(_KINDS))


def tokens_of(word: str) -> tuple[str, str]:
    return "=" + "".join(_LETTER.findall(word.lower())), "~" + form_of(word)


@dataclass
class Model:
    """Bounded in size, so it can be sent to every task."""

    contexts: dict[str, np.ndarray] = field(default_factory=dict)
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.ones(0))
    layers: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0

    def of_form(self, form: str) -> np.ndarray:
        """Word vector and index vector of a form's token."""
        index = index_vector(form)
        known = self.contexts.get(form)
        return np.concatenate([_unit(index) if known is None else known, index])

    def of_words(self, words: list[str], forms: dict[str, np.ndarray]) -> np.ndarray:
        """A row for each word: the sum of its tokens' word vectors, and its form's index vector; ``forms`` caches."""
        out = np.empty((len(words), 2 * WIDTH), dtype=np.float32)
        unknown, tokens = [], []
        for i, word in enumerate(words):
            letters, form = tokens_of(word)
            own = forms.get(form)
            if own is None:
                if len(forms) >= CACHED_WORDS // 10:
                    forms.clear()
                forms[form] = own = self.of_form(form)
            out[i] = own
            known = self.contexts.get(letters)
            if known is not None:
                out[i, :WIDTH] += known
            else:  # drawn together below
                unknown.append(i)
                tokens.append(letters)
        if tokens:
            out[unknown, :WIDTH] += _unit(index_vectors(tokens))
        return out

    def of_word(self, word: str) -> np.ndarray:
        return self.of_words([word], {})[0]

    def pool(self, text: str | None, cache: Cache) -> np.ndarray:
        words = text.split() if text else []
        out = np.zeros(2 * WIDTH + 3)
        if not words:
            return out
        counts = Counter(words)
        rows = cache.rows(self, counts)
        times = np.fromiter(counts.values(), dtype=np.float32, count=len(counts))
        out[: 2 * WIDTH] = times @ rows / len(words)
        out[2 * WIDTH] = sum(map(str.__eq__, words[1:], words)) / len(words)
        out[2 * WIDTH + 1] = len(counts) / len(words)
        out[2 * WIDTH + 2] = np.log1p(len(words)) / 10
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.maximum((pooled - self.mean) / self.spread @ a + b, 0) @ c + d

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(pooled), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -40, 40)))


class Cache:
    """Vectors of words and of forms that a task has met; emptied when full."""

    def __init__(self) -> None:
        self.at: dict[str, int] = {}
        self.forms: dict[str, np.ndarray] = {}
        self.table = np.empty((1024, 2 * WIDTH), dtype=np.float32)

    def rows(self, model: Model, words: Iterable[str]) -> np.ndarray:
        """A row for each of the words, which are different."""
        new = [w for w in words if w not in self.at]
        if self.at and len(self.at) + len(new) > CACHED_WORDS:
            self.at.clear()
            new = list(words)
        if new:
            n = len(self.at)
            if n + len(new) > len(self.table):
                self.table = np.concatenate([self.table[:n], np.empty((n + 2 * len(new), 2 * WIDTH), dtype=np.float32)])
            self.table[n : n + len(new)] = model.of_words(new, self.forms)
            self.at.update(zip(new, range(n, n + len(new)), strict=True))
        return self.table[[self.at[w] for w in words]]


def _frequent(sample: DataFrame) -> list[str]:
    """The ``MODEL_TOKENS`` tokens met in most texts; letters count from two texts on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                texts.update({t for w in set((text or "").split()) for t in tokens_of(w)})
            yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.string()), pa.array(list(texts.values()), pa.int64())], names=["token", "texts"])

    met = sample.select("text").mapInArrow(work, "token string, texts long").groupBy("token").agg(F.sum("texts").alias("texts"))
    most = met.filter("texts > 1 or token like '~%'").orderBy(F.desc("texts"), "token").limit(MODEL_TOKENS)
    return [r.token for r in most.collect()]


def _contexts(sample: DataFrame) -> DataFrame:
    """token and the sum of its neighbours' index vectors, for the frequent ones."""
    kept = sample.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(_frequent(sample))})
    schema = pa.schema([("token", pa.string()), ("context", pa.list_(pa.float32()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = kept.value
        for batch in batches:
            pairs: Counter = Counter()
            for text in batch.column(0).to_pylist():
                forms = [tokens_of(w) for w in (text or "").split()]
                pairs.update((t, x[1]) for left, x in zip(forms, forms[1:], strict=False) for t in left if t in places)
                pairs.update((t, left[1]) for left, x in zip(forms, forms[1:], strict=False) for t in x if t in places)
            tokens, near = list(dict.fromkeys(t for t, _ in pairs)), list(dict.fromkeys(x for _, x in pairs))
            drawn = dict(zip(near, index_vectors(near), strict=True))
            sums = {t: np.zeros(WIDTH, dtype=np.float32) for t in tokens}
            for (token, x), n in pairs.items():
                sums[token] += n * drawn[x]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(list(sums.values()), pa.list_(pa.float32()))], schema=schema)

    rows = sample.select("text").mapInArrow(work, "token string, context array<float>")
    return rows.groupBy("token").agg(*[F.sum(F.get("context", F.lit(i))).alias(f"x{i}") for i in range(WIDTH)])


def _train(x: np.ndarray, y: np.ndarray, seed: int = 5) -> list[np.ndarray]:
    """Two layers by Adam on the logistic loss; classes weigh alike by their root."""
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    share = y.mean()
    weight = np.where(y == 1, (0.5 / share) ** 0.5, (0.5 / (1 - share)) ** 0.5)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            i = order[at : at + 128]
            hidden = np.maximum(x[i] @ p[0] + p[1], 0)
            logit = hidden @ p[2] + p[3]
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[i]) * weight[i] / len(i)
            back = error[:, None] * p[2][None, :] * (hidden > 0)
            gradients = [x[i].T @ back + 1e-4 * p[0], back.sum(0), hidden.T @ error + 1e-4 * p[2], np.array([error.sum()])]
            t += 1
            rate = 3e-3 * (1 - epoch / EPOCHS) + 1e-4
            for k, g in enumerate(gradients):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return p


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least logistic loss, by golden-section search over its log."""
    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    a, b, ratio = -2.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _pooled(df: DataFrame, model: Model, columns: str) -> DataFrame:
    """The columns before text, and the pooled vector."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = sent.value, Cache()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = [own.pool(t, cache) for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(x, pa.list_(pa.float64()))], names=[*part.schema.names[:-1], "x"])

    return df.mapInArrow(work, f"{columns}, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Learn from ``labels`` rows (id and label); a quarter of the texts fit the temperature alone."""
    chosen = labels.filter(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("long").alias("y"))
    sample = sampled(docs, chosen, rows, id_col, text_col)
    sample = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.max("y").alias("y"), F.first("text").alias("text"))
    model = Model()
    for r in _contexts(sample.filter("pmod(h, 4) <> 0")).collect():  # MODEL_TOKENS rows at most
        vector = np.array(r[1:], dtype=np.float32)
        model.contexts[r.token] = vector / max(float(np.linalg.norm(vector)), 1e-6)
    found = _pooled(sample.select("h", "y", "text"), model, "h long, y long").orderBy("h").collect()  # ``rows`` at most
    y = np.array([r.y for r in found], dtype=np.float64)
    train = np.array([r.h % 4 != 0 for r in found], dtype=bool)
    if not len(y) or not 0 < y[train].sum() < train.sum():
        return Model()
    x = np.array([r.x for r in found])
    model.mean, model.spread = x[train].mean(0), x[train].std(0) + 1e-3
    model.layers = _train((x[train] - model.mean) / model.spread, y[train])
    if (~train).any():
        model.temperature = _temperature(model.logits(x[~train]), y[~train])
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([(id_col, pa.int64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = sent.value, Cache()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = np.array([own.pool(t, cache) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.probabilities(x), pa.float64())], schema=schema)

    found = df.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(work, f"`{id_col}` long, score double")
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))

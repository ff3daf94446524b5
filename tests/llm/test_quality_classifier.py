import random

import numpy as np

from folio.llm import quality_classifier as Q


def corpus():
    rng = random.Random(1)
    def word():
        return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(500):
        words = [word() for _ in range(rng.randint(10, 120))]
        good = int(i % 4 != 0)
        if not good:
            kind = i // 4 % 3
            words = [w + "&&&" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else [w for w in words[:8] for _ in range(9)]
        rows.append((i, " ".join(words), good))
    return rows


def test_held_out(spark):
    rows = corpus()
    odd = [(900, None), (901, ""), (902, " "), (None, "x y"), (903, "aa bb"), (903, "aa bb")]
    df = spark.createDataFrame([(i, t, 3.0) for i, t, _ in rows] + [(i, t, 3.0) for i, t in odd], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3 != 1] + [(None, 1), (900, 0), (903, None)], "doc_id long, quality int")
    model = Q.fit(df, labels)
    got = Q.score(df, model).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    held = [(i, y) for i, _, y in rows if i % 3 == 1]
    assert sum(by[i].predicted == y for i, y in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert by[900].score == by[901].score == by[902].score


def test_temperature_is_the_best():
    rng = np.random.default_rng(2)
    z = rng.normal(size=4000) * 2
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(Q._temperature(z * 3, y) - 3) < 0.3


def test_forms():
    assert Q.form_of("De%%%") == "Aa%" and Q.form_of("AÉ12!!") == "A9!" and Q.form_of("") == ""
    assert Q.tokens_of("Üb3r") == ("=übr", "~Aa9a")


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = Q.fit(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert [(r.score, r.predicted) for r in Q.score(df, model).collect()] == [(0.5, 1)]
    assert Q.score(df.limit(0), model).collect() == []


def test_every_token_has_a_vector():
    known = np.full(Q.WIDTH, 0.5, dtype=np.float32)
    model = Q.Model({"=one": known, "~A": known})
    def unit(token):
        v = Q.index_vector(token)
        return v / np.linalg.norm(v)
    half = slice(None, Q.WIDTH)
    assert np.allclose(model.of_word("two")[half], unit("=two") + unit("~a"), atol=1e-6)
    assert np.allclose(model.of_word("one")[half], known + unit("~a"), atol=1e-6)
    assert np.allclose(model.of_word("TWO")[half], unit("=two") + known, atol=1e-6)
    for word in ("one", "two", "TWO"):
        assert np.array_equal(model.of_word(word)[Q.WIDTH :], Q.index_vector("~" + Q.form_of(word)))
    # texts that differ in nothing but a word outside the table pool differently, cached or not
    cache = Q.Cache()
    pooled = [model.pool(t, cache) for t in ("one two", "one six", "one two")]
    assert not np.allclose(pooled[0], pooled[1]) and np.array_equal(pooled[0], pooled[2])
    assert np.array_equal(pooled[1], model.pool("one six", Q.Cache()))


def test_contexts_are_of_all_texts_however_dealt(spark):
    texts = [f"rare w{i}x{i % 7}y" for i in range(12)] + ["once only", None, ""]
    sample = spark.createDataFrame([(t,) for t in texts], "text string")
    found = []
    for n in (1, 12):
        found.append({r.token: list(r)[1:] for r in Q._contexts(sample.repartition(n)).collect()})
    assert found[0] == found[1]
    assert "=rare" in found[1] and "=once" not in found[1]  # one text in each of many batches, and one in all
    near = sum(Q.index_vector("~" + Q.form_of(t.split()[1])) for t in texts[:12])
    assert found[1]["=rare"] == near.tolist()


def test_contexts_read_every_training_text(spark, monkeypatch):
    from pyspark.sql import functions as F

    seen = []
    monkeypatch.setattr(Q, "_contexts", lambda sample, f=Q._contexts: seen.append(sample.count()) or f(sample))
    rows = corpus()
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    Q.fit(df, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int"))
    assert seen == [df.select("text").distinct().filter(F.pmod(F.xxhash64("text"), F.lit(4)) != 0).count()]


def test_scores_are_the_same_for_any_batch_size(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3 != 1], "doc_id long, quality int")
    found, key = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for size, parts in ((10_000, 2), (7, 5)):
            spark.conf.set(key, size)
            dealt = df.repartition(parts)
            found.append({r.doc_id: r.score for r in Q.score(dealt, Q.fit(dealt, labels)).collect()})
    finally:
        spark.conf.set(key, before)
    assert found[0].keys() == found[1].keys()
    assert max(abs(found[0][i] - found[1][i]) for i in found[0]) < 1e-6


def test_long_text(spark):
    df = spark.createDataFrame([(1, "ab cd ef " * 100_000), (2, "ab cd ef")], "doc_id long, text string")
    assert len({r.score for r in Q.score(df, Q.Model()).collect()}) == 1
    model = Q.Model(contexts={}, mean=np.zeros(2 * Q.WIDTH + 3), spread=np.ones(2 * Q.WIDTH + 3), layers=[np.ones((2 * Q.WIDTH + 3, 2)), np.zeros(2), np.ones(2), np.zeros(1)])
    assert all(0 <= r.score <= 1 for r in Q.score(df, model).collect())

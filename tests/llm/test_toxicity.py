import random

import numpy as np

from folio.llm import toxicity as T


def brute_segments(scores):
    """Ruzzo and Tompa's definition: the best contiguous run, then the same left and right of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    best = max(((i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), key=lambda x: (round(sum(scores[x[0] : x[1]]), 9), -(x[1] - x[0])))
    a, b = best
    left, right = brute_segments(scores[:a]), brute_segments(scores[b:])
    return [*left, (a, b), *[(x + b, y + b) for x, y in right]]


def test_maximal_segments():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.uniform(-3, 2) for _ in range(rng.randint(0, 14))]
        got = T.maximal_segments(np.array(scores, dtype=float))
        assert [(a, b) for a, b, _ in got] == brute_segments(scores)
        for a, b, s in got:
            assert abs(s - sum(scores[a:b])) < 1e-9


def corpus():
    rng = random.Random(5)
    words = ["w%s%s" % (a, b) for a in "abcdefgh" for b in "klmnop"]
    words = [w.replace("w", rng.choice(["ta", "be", "gi"])) for w in words]
    rows = []
    for i in range(600):
        own = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            own.insert(rng.randrange(len(own)), rng.choice(["nasty", "vilest", "scummy"]))
        rows.append((i, " ".join(own), toxic))
    return rows


def test_held_out(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 9.0) for i, t, _ in rows] + [(9000, None, 1.0), (9001, "", 1.0), (9002, "nasty nasty", 1.0), (9002, "nasty nasty", 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(None, 1), (9000, 1), (9001, None)], "doc_id long, toxic int")
    model = T.fit(df, labels)
    got = T.score(df, model).collect()
    assert len(got) == len(rows) + 4
    by = {r.doc_id: r for r in got}
    held = [(i, y) for i, _, y in rows if not i % 3]
    assert sum(by[i].predicted == y for i, y in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert by[9000].score == by[9001].score < 0.5
    i, text, _ = next(r for r in rows if r[2] and not r[0] % 3)
    words = T.words_of(text)
    assert any(w in ("nasty", "vilest", "scummy") for a, b in zip(by[i].starts, by[i].ends) for w in words[a:b])


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = T.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in T.score(df, model).collect()] == [0.0]
    assert T.score(df.limit(0), model).collect() == []


def test_every_passage_is_evidence():
    model = T.Model(location=1.0, scale=1.0)
    n, strong = 5000, [(0, 1, 16.0)]
    found = [model.evidence(strong * k, n) for k in range(30)]
    assert found[0] == 0 and all(a < b for a, b in zip(found, found[1:]))
    # segments of ordinary text, as many and as strong as chance gives, add pi^2 / 6 on average whatever the length
    rng = np.random.default_rng(3)
    for n in (100, 10_000):
        sums = []
        for _ in range(2000):
            rates = np.cumsum(rng.exponential(size=40))
            sums.append(np.expm1(model.evidence([(0, 1, 1.0 + np.log(n) - np.log(r)) for r in rates], n)))
        assert abs(np.mean(sums) - np.pi**2 / 6) < 0.15


def test_long_text_and_ties(spark):
    rows = corpus()
    docs = [(i, t, "p") for i, t, _ in rows] + [(9000, " ".join(t for _, t, y in rows if not y) * 5, "p"), (9001, rows[0][1] + " " + "ta " * 300_000, "p")]
    df = spark.createDataFrame(docs, "doc_id long, text string, starts string")
    model = T.fit(df, spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 0), (0, 1), (1, None)], "doc_id long, toxic int"))
    by = {r.doc_id: r for r in T.score(df, model).collect()}
    assert len(by) == len(docs) and by[9000].predicted == 0
    assert 0 <= by[9001].score <= 1
    words = T.words_of(docs[-1][1])
    short = model.segments(words[: len(T.words_of(rows[0][1]))], {})
    assert short and [x[:2] for x in model.segments(words, {})][: len(short)] == [x[:2] for x in short]  # segments are found in a very long text alike
    scores = np.array([1.0, -1.0, 1.0, -3.0, 1.0])
    assert [(a, b) for a, b, _ in T.maximal_segments(scores)] == [(0, 1), (2, 3), (4, 5)]  # equal runs stay apart


def brute_scores(words, word_scores, beginnings):
    out = []
    for i, w in enumerate(words):
        s = word_scores.get(w, beginnings.get(w[:4], -1.0))
        out.append(min(s, -1.0) if i and words[i - 1] == w else s)
    return out


def brute_sums(scores):
    """Sums of the segments that ``brute_segments`` names, from a table of all runs."""
    before = np.concatenate([[0.0], np.cumsum(scores)])
    table = np.round(before[None, :] - before[:, None], 9)
    table[np.tril_indices(len(before))] = -np.inf
    found, todo = [], [(0, len(scores))]
    while todo:
        lo, hi = todo.pop()
        own = table[lo:hi, lo + 1 : hi + 1]
        if hi <= lo or own.max() <= 0:
            continue
        a, b = min(zip(*np.nonzero(own == own.max())), key=lambda x: (x[1] - x[0], x[0]))
        found.append(own.max())
        todo += [(lo, lo + a), (lo + b + 1, hi)]
    return found


def test_score_brute_force(spark):
    import math
    from collections import Counter

    rows = corpus()
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = {i: y for i, _, y in rows if i % 3}
    got = {r.doc_id: r.score for r in T.score(df, T.fit(df, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))).collect()}
    # the texts that count words are told from the others by Spark's hash; all else is plain Python
    counting = {r.doc_id for r in df.selectExpr("doc_id", "pmod(xxhash64(text), 3) as fold").collect() if r.fold}
    words = {i: t.lower().split() for i, t, _ in rows}
    all_of, met = Counter(), {0: Counter(), 1: Counter()}
    for i in labels.keys() & counting:
        all_of[labels[i]] += 1
        met[labels[i]].update(("w", w) for w in set(words[i]))
        met[labels[i]].update(("b", b) for b in {w[:4] for w in words[i]})
    share = all_of[1] / (all_of[0] + all_of[1])

    def odds(p):
        return min(max(math.log(p / (1 - p)) - math.log(share / (1 - share)), -2), 8) - 1

    known = [t for t in met[0].keys() | met[1].keys() if met[0][t] + met[1][t] >= 3]
    shares = {b: (met[1][k, b] + 20 * share) / (met[0][k, b] + met[1][k, b] + 20) for k, b in known if k == "b"}
    scored = {w: odds((met[1][k, w] + 4 * shares.get(w[:4], share)) / (met[0][k, w] + met[1][k, w] + 4)) for k, w in known if k == "w"}
    begun = {b: odds(p) for b, p in shares.items()}
    sums = {i: brute_sums(brute_scores(own, scored, begun)) for i, own in words.items()}
    rest = sorted(labels.keys() - counting)
    quiet = [i for i in rest if not labels[i] and sums[i]]
    location, scale = T._fit_gumbel(np.array([max(sums[i], default=0.0) for i in rest if not labels[i]]), np.array([len(words[i]) for i in rest if not labels[i]]))
    if len(quiet) >= 20:
        best = [max(sums[i]) for i in quiet]
        assert abs(scale - max(0.3, float(np.std(best)) * 6**0.5 / math.pi)) < 1e-9

    def evidence(i):
        chances = [math.exp(-((s - location) / scale - math.log(len(words[i])))) for s in sums[i]]
        return math.log1p(sum(-math.log(-math.expm1(-c)) if c > 1e-12 else -math.log(c) for c in chances))

    weight, bias = T._fit_logistic(np.array([evidence(i) for i in rest]), np.array([float(labels[i]) for i in rest]))
    wanted = {i: 1 / (1 + math.exp(-weight * evidence(i) - bias)) for i in words}
    assert got.keys() == wanted.keys()
    assert max(abs(got[i] - wanted[i]) for i in got) < 1e-5
    # the line through the calibration texts is where the logistic loss, with its ridge, is flat
    x, y = np.array([evidence(i) for i in rest]), np.array([float(labels[i]) for i in rest])
    left = 1 / (1 + np.exp(-weight * x - bias)) - y
    assert abs((left * x).sum() + 0.01 * weight) < 1e-3 and abs(left.sum() + 0.01 * bias) < 1e-3

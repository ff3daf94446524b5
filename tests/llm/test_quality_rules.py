import random
import re
from collections import Counter

from folio.llm import quality_rules as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def corpus():
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "a", "a a a", "x y z x y z", "l\nl\n\nl \n l\r\nm", " nbsp em 🎉 # & |", "a b " * 500, "\x0bv\x0cf"]
    for _ in range(60):
        texts.append(rng.choice([" ", "\n", "  "]).join(rng.choice(["a", "b", "Cé", "dd", "%%", "<e>"]) for _ in range(rng.randint(0, 30))))
    for _ in range(40):
        texts.append(" ".join("w%d" % rng.randrange(400) for _ in range(rng.randint(45, 300))))
    return texts


def test_counts(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(3, "a", 5)], "doc_id long, text string, n_words int")
    rows = Q.judge(df, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id]), texts[r.doc_id]
        assert r.kept == (not r.base_failed)  # nothing is trusted: base rules alone
    assert "Python" not in Q.judge(df, spark.createDataFrame([], "doc_id long, quality int"))._jdf.queryExecution().executedPlan().toString()


def test_verdict(spark):
    rng = random.Random(8)
    def word():
        return "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    def prose(n):
        return " ".join(word().capitalize() if k % 12 == 0 else word() + ("." if k % 12 == 11 else "") for k in range(n))
    rows = [(i, prose(rng.randint(60, 200)), 1) for i in range(200)]
    rows += [(200 + i, " ".join(w + rng.choice(["%%%", "&&&", "***"]) for w in prose(100).split()), 0) for i in range(10)]
    rows += [(300 + i, prose(100).upper().replace(" ", "!! "), 0) for i in range(10)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows if i % 2] + [(None, 1, 0), (77777, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in Q.judge(df, labels).collect()}
    assert got == {i: bool(q) for i, _, q in rows}


def test_empty(spark):
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_every_good_label_counts(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["ab", "Cd", "e.", "9f", "g%"]) for _ in range(30))) for i in range(80)] + [(None, "x y"), (7, "Q r")], "doc_id long, text string")
    own = spark.range(80).selectExpr("id as doc_id", "1 as quality").filter("doc_id % 2 = 0")
    others = spark.range(1000, 61_000).selectExpr("id as doc_id", "1 as quality")  # good ones that docs hasn't
    assert Q.ratios(docs, own.union(others).union(own)) == Q.ratios(docs, own)
    assert any(Q.ratios(docs, own))


def brute_scores(texts, good):
    """Length-normalised log-likelihood ratios, hash by hash; ``good``: which texts are trusted."""
    import math
    from collections import Counter

    from xxhash import xxh64_intdigest

    def bucket(*parts):
        seed = 42
        for part in parts:
            seed = xxh64_intdigest(part.encode(), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) % Q.BUCKETS

    def form(word):
        kinds = "".join("a" if c in Q._LOWER else "A" if c in Q._UPPER else "9" if c in Q._DIGITS else c for c in word)
        return re.sub(r"(.)\1+", r"\1", kinds)

    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        forms = [form(w) for w in words]
        return [bucket(w) for w in words], [bucket(a, b) for a, b in zip(forms, forms[1:])]

    found = [grams(t) for t in texts]
    logs = []
    for kind in (0, 1):
        raw, own = Counter(), Counter()
        for g, t in zip(found, good):
            raw.update(g[kind])
            if t:
                own.update(g[kind])
        n_raw, n_own = sum(raw.values()) + Q.BUCKETS, sum(own.values()) + Q.BUCKETS
        logs.append({b: math.log((own[b] + 1) / n_own) - math.log((raw[b] + 1) / n_raw) for b in raw})
    return [(sum(logs[0][b] for b in one) + sum(logs[1][b] for b in two)) / (len(one) + len(two)) if one else 0.0 for one, two in found]


def test_verdict_brute_force(spark):
    texts = corpus()
    good = [i % 3 == 0 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, "f") for i, t in enumerate(texts)], "doc_id long, text string, forms string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    want = brute_scores(texts, good)
    for r in Q.judge(df, labels).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-5, texts[r.doc_id]
        assert r.kept == (not r.base_failed and r.score >= Q.THRESHOLD)


def test_words_count_and_not_their_shapes_alone(spark):
    rng = random.Random(9)
    one, two = ([a + b + c for a in letters for b in "aeiou" for c in letters] for letters in ("bcdfg", "mnprs"))
    texts = [" ".join(rng.choice(v) for _ in range(120)) for v in (one, two) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in Q.judge(df, labels).collect()}
    assert min(got[i] for i in range(30)) > max(got[i] for i in range(30, 60)) + 0.1
    assert got[None] == got[0]  # a row without an id is judged like any other


def test_threshold_itself_is_kept(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    some = sorted(r.score for r in Q.judge(df, labels).collect())[3]
    monkeypatch.setattr(Q, "THRESHOLD", some)
    assert all(r.kept == (r.score >= some) for r in Q.judge(df, labels).collect())

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from folio.llm import suffix_dedup as S


def brute(texts, length):
    """Covered flags per text."""
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                mark[i : i + length] = [True] * length
        out.append(mark)
    return out


def corpus(seed, size=60):
    rng = random.Random(seed)
    def word():
        return "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    def text(n):
        return " ".join(word() for _ in range(n))
    shared = [text(rng.randint(8, 60)) for _ in range(5)]
    texts = ["", None, "x", "a" * 120, "ab" * 90]
    for _ in range(size):
        parts = [text(rng.randint(0, 40)) for _ in range(rng.randint(0, 3))] + rng.sample(shared, rng.randint(0, 2))
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    near = text(60)
    for _ in range(25):
        words = near.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    return texts + [texts[10], texts[10], texts[12]]


def check(rows, texts, length):
    data = [(t or "").encode() for t in texts]
    assert len(rows) == len(texts)
    for r, text, mark in zip(sorted(rows, key=lambda r: r.doc_id), data, brute(data, length)):
        kept = bytes(b for b, m in zip(text, mark) if not m)
        assert r.n_bytes == len(text) and r.n_removed == sum(mark), r.doc_id
        assert r.n_spans == sum(1 for a, b in zip([False, *mark], mark) if b and not a)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length,crowded", [(40, 4096), (40, 3), (25, 0)])
def test_same_as_brute_force(spark, length, crowded):
    texts = corpus(length + crowded)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, key int")
    check(S.dedup(df, length, crowded=crowded).collect(), texts, length)


def test_slices_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 64)
    texts = corpus(5, 20)
    batch = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + 30] for t in batch for i in range(len(t) - 29))
    import pyarrow as pa
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(batch)), pa.int64()), pa.array([0] * len(batch), pa.int64()), pa.array([1] * len(batch), pa.int64()), pa.array(batch, pa.binary())], names=["key", "base", "weight", "content"])
    seen = Counter()
    for out in S.anchored(30, 5, summed=False)(iter([rows])):
        for r in out.to_pylist():
            for i in range(r["start"], r["start"] + r["n"]):
                seen[batch[r["key"]][i : i + 30]] += 1
    assert seen == count  # each window is in one segment


def test_matching_statistics():
    rng = random.Random(3)
    contents = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(25)]
    contents += [contents[3], contents[4] + contents[5]]
    index = S.RunLengthIndex(contents)
    assert index.run_lengths.sum() == index.n
    got = index.matching_statistics()
    subs = Counter(c[i:j] for c in contents for i in range(len(c)) for j in range(i + 1, len(c) + 1))
    for c, s in zip(contents, index.starts):
        for i in range(len(c)):
            want = max((j - i for j in range(i + 1, len(c) + 1) if subs[c[i:j]] > 1), default=0)
            assert got[s + i] == want


def test_empty_and_nulls(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.dedup(empty).collect() == []
    rows = S.dedup(spark.createDataFrame([(None, "z" * 300), (3, None)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed) for r in rows} == {(None, 300, 300), (3, 0, 0)}
    assert np.array_equal(S.spans_of([], [], 5)[0], [])


def test_rows_that_repeat_an_id_are_documents_of_their_own(spark):
    texts = corpus(3, 30)
    ids = [1, 1, 2, 2, None, None] + [i // 2 for i in range(len(texts) - 6)]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in zip(ids, texts)], "doc_id long, text string, content string, tag int")
    got = sorted((r.n_bytes, r.n_removed, r.kept_sha256, str(r.doc_id)) for r in S.dedup(df, 40).collect())
    data = [(t or "").encode() for t in texts]
    want = []
    for i, text, mark in zip(ids, data, brute(data, 40)):
        kept = bytes(b for b, m in zip(text, mark) if not m)
        want.append((len(text), sum(mark), hashlib.sha256(kept).hexdigest(), str(i)))
    assert got == sorted(want)


def test_unique_text_under_a_repeated_id_stays(spark):
    rng = random.Random(8)
    passage, own = ("".join(rng.choice("abcdefgh ") for _ in range(500)) for _ in range(2))
    df = spark.createDataFrame([(1, passage), (1, own), (2, passage)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in S.dedup(df).collect()) == [(1, 0), (1, 500), (2, 500)]
    kept = S.without_repeats(df).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, ""), (1, own), (2, "")])


def test_equal_rolling_hashes_are_no_match(spark, monkeypatch):
    """Strings that the rolling hash can't tell apart: digests and bytes decide."""
    rng = random.Random(4)
    contents = [bytes(rng.choice(b"abcd") for _ in range(60)) for _ in range(12)]
    contents.append(contents[2][:30] + contents[5][30:])
    monkeypatch.setattr(S.Hasher, "SYMBOLS", np.ones_like(S.Hasher.SYMBOLS))
    index = S.RunLengthIndex(contents, 20)
    got = index.matching_statistics()
    for c, start in zip(contents, index.starts):
        for i in range(len(c) - 19):
            twice = sum(o[j : j + 20] == c[i : i + 20] for o in contents for j in range(len(o) - 19)) > 1
            assert (got[start + i] >= 20) == twice
    _, u, v, _, start, n = S.segments(contents, 40, 6)
    assert len(set(zip(u.tolist(), v.tolist()))) > 12


def test_long_text_and_byte_cuts(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdé ") for _ in range(300_000))
    texts = [long, long[1000:1400] + "x" + long[250_000:250_300], "é" * 400, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in S.dedup(df).collect()}
    a, b = long[1000:1400].encode(), long[250_000:250_300].encode()
    assert (got[0].n_spans, got[0].n_removed) == (2, len(a) + len(b))
    assert (got[1].n_spans, got[1].n_removed) == (2, len(a) + len(b))
    assert got[2].n_removed == 800 and got[3].n_bytes == got[4].n_bytes == 0

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from folio.llm import simhash as S
from folio.llm.components import components


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints):
    """Smallest id reachable, by id."""
    ids = sorted(prints)
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if bin(prints[i] ^ prints[j]).count("1") <= 2 and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    changed = True
    return comp


def test_fingerprint():
    rng = random.Random(1)
    texts = ["", None, "One", "Two words", "É Über x y z", "\x0b\x0c a\tb\nc d\r", "a b c", "a b c d"]
    texts += [" ".join(rng.choice(["Aa", "b", "ccc", "Ö"]) for _ in range(n)) for n in (3, 10, 254, 255, 256, 257, 258, 1000)]
    for t in texts:
        assert S.fingerprint(t) == brute_fingerprint(t), t


@pytest.mark.parametrize("crowded", [2048, 4])
def test_links_connect_all(spark, crowded):
    rng = random.Random(7)
    fps = {0, (1 << 64) - 1}
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.component for r in components(S.links(df, crowded=crowded)).collect()}
    want = brute_groups({i: f for i, f in enumerate(fps)})
    for i, a in enumerate(signed):
        for j, b in enumerate(signed):
            assert (got.get(a, a) == got.get(b, b)) == (want[i] == want[j])


def test_groups(spark):
    rng = random.Random(9)
    words = ["w%d" % i for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(150)) for _ in range(12)]
    texts = ["", None, " \n", "one", "one"]
    for b in base:
        texts.append(b)
        for _ in range(3):
            own = b.split()
            own[rng.randrange(len(own))] = "changed"
            texts.append(" ".join(own))
    df = spark.createDataFrame([(i + 5, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, fp int")
    rows = {r.doc_id: r for r in S.groups(df).collect()}
    prints = {i + 5: brute_fingerprint(t) for i, t in enumerate(texts)}
    want = brute_groups(prints)
    assert len(rows) == len(texts)
    for i, p in prints.items():
        assert rows[i].fingerprint == f"{p:016x}" and rows[i].component_id == want[i]


def test_empty_and_null_ids(spark):
    assert S.groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = S.groups(spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.component_id or -1) for r in rows) == [(False, 4), (True, -1), (True, 4)]


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7), (9, 8)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_pivots_prune(spark):
    """Without their distances, cells and tables let every pair through."""
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 64, 6000, dtype=np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    cells = S._split(df.selectExpr("0L as cell", "fp"), S.pivots(6), 2)
    sizes = [r["count"] for r in cells.groupBy("cell").count().collect()]
    pairs = sum(n * (n - 1) // 2 for n in sizes)
    assert pairs < 0.3 * len(fps) ** 2 / 2
    table = S.distance_table(fps[:1000], S.pivots(32)).astype(int)
    left = sum(int((np.abs(table[i + 1 :] - table[i]).max(axis=1) <= 2).sum()) for i in range(999))
    assert left < 0.001 * 1000 * 999 / 2


def test_close_pairs_brute_force():
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 64, 200, dtype=np.uint64)
    fps = np.unique(np.r_[fps, *[fps ^ np.uint64(1 << int(b)) for b in rng.integers(0, 63, 5)], fps ^ np.uint64(7)])
    i, j = S.close_pairs(fps, 2, S.pivots(32))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    assert {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())} == {(a, b) for a, b in zip(*np.nonzero(near)) if a < b}


def test_representatives_keep_texts_that_are_no_near_copies(spark):
    texts = ["a b c d e f g", "some quite other words than these", "a b c d e f g"]
    df = spark.createDataFrame([(1, t, "x") for t in texts] + [(None, "one more text of its own kind", "y"), (2, texts[0], "z")] + [(3, texts[1], "w")] * 2, "doc_id long, text string, row_id string")
    kept = sorted((str(r.doc_id), r.text, r.row_id) for r in S.representatives(df).collect())
    assert kept == [("1", texts[0], "x"), ("1", texts[1], "x"), ("None", "one more text of its own kind", "y")]


def test_cells_of_all_pivots_in_one_step(spark):
    rng = np.random.default_rng(11)
    fps = np.unique(rng.integers(0, 1 << 64, 500, dtype=np.uint64))
    near = fps ^ np.uint64(1) ^ (np.uint64(1) << rng.integers(1, 64, len(fps), dtype=np.uint64))
    refs = S.pivots(5)
    df = spark.createDataFrame([(int(x),) for x in np.r_[fps, near].view(np.int64)], "fp long")
    split = S._split(df.selectExpr("0L as cell", "fp"), refs, 2)
    met = {}
    for r in split.collect():
        met.setdefault(r.fp, []).append(r.cell)
    own = lambda far: len({(far - S.CUT) // S.CELL, (far - S.CUT + 2) // S.CELL})
    for x, y in zip(fps, near, strict=True):
        a, b = met[int(x.astype(np.int64))], met[int(y.astype(np.int64))]
        assert set(a) & set(b) and len(a) == len(set(a)) == np.prod([own(int(np.bitwise_count(x ^ r))) for r in refs])
    assert split._jdf.queryExecution().executedPlan().toString().count("Generate") == 1
    assert S._split(df.selectExpr("0L as cell", "fp"), refs[:0], 2).count() == df.count()

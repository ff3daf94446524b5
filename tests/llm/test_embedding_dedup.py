import numpy as np
import pytest

from folio.llm import embedding_dedup as E


def vectors(seed, dim=12):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(12):
        base = rng.normal(size=dim)
        for _ in range(rng.integers(1, 14)):
            out.append(base * rng.uniform(0.5, 2) + rng.normal(size=dim) * rng.choice([0.02, 0.15, 0.3]))
    out += list(rng.normal(size=(60, dim)))
    out = [v.astype(np.float32) for v in out]
    return out + [out[0], out[0], out[5], (out[3] * 2).astype(np.float32)]


def brute(vs, threshold=0.95):
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(vs)
    unit = [np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) if ok(v) else None for v in vs]
    link = [[i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold for j in range(n)] for i in range(n)]
    comp = list(range(n))
    for _ in range(n):
        new = [min([comp[i], *[comp[j] for j in range(n) if link[i][j]]]) for i in range(n)]
        if new == comp:
            break
        comp = new
    return [sum(r) for r in link], comp


@pytest.mark.parametrize("cell,part", [(4096, 8192), (20, 8192), (30, 7)])
def test_same_as_brute_force(spark, monkeypatch, cell, part):
    monkeypatch.setattr(E, "LEAF", 4)
    vs = vectors(cell)
    data = [[float(x) for x in v] for v in vs] + [None, [0.0] * 12, [float("nan")] * 12, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11, [], [1.0, 2.0], [2.0, 4.0], [0.0] * 12]
    df = spark.createDataFrame([(i, v, 3, 7) for i, v in enumerate(data)], "vec_id long, embedding array<float>, label int, rid int")
    rows = sorted(E.groups(df, cell=cell, part=part).collect())
    n, comp = brute([None if v is None else [None if x is None else np.float32(x) for x in v] for v in data])
    assert [r.vec_id for r in rows] == list(range(len(data)))
    assert [r.n_links for r in rows] == n
    assert [r.component_id for r in rows] == comp
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_traversal_alone():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.01, 0.1, 0.3, 0.6)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    weights = rng.integers(1, 4, len(x))
    for threshold in (0.5, 0.9, 0.99):
        found = E.Found(weights)
        tree = E.cover_tree(x)
        E.traverse(x, tree, tree, threshold, found)
        link = x @ x.T >= threshold
        np.fill_diagonal(link, False)
        assert (found.counts == link @ weights).all()


def test_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert E.groups(empty).collect() == []
    rows = E.groups(spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (None, None)], "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in rows) == [(-1, 0, -1, False), (-1, 1, 5, False), (5, 1, 5, True)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_ranges_prune_and_lose_nothing(spark, monkeypatch, kind):
    """Clusters along several directions: visitors are far fewer than every vector to every later cell."""
    rng = np.random.default_rng(12)
    base = np.eye(12)
    data = np.concatenate([b + rng.normal(size=(40, 12)) * 0.05 for b in base])
    if kind == "float":
        data = data.astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], f"vec_id long, embedding array<{kind}>")
    dealt = []
    monkeypatch.setattr(E, "_dealt", lambda *a, f=E._dealt: dealt.append(a) or f(*a))
    rows = sorted(E.groups(df, cell=40).collect())
    n, comp = brute(list(data))
    assert [r.n_links for r in rows] == n and [r.component_id for r in rows] == comp
    centres, radii, ranges, parts, reach = dealt[0]
    classes = df.selectExpr("vec_id as rid", "1L as weight", "embedding as vector")
    sent = classes.mapInArrow(E._dealt(*dealt[0]), f"unit long, visitor int, rid long, weight long, vector array<{kind}>").filter("visitor = 1").count()
    assert sent < 0.2 * len(data) * len(centres) / 2

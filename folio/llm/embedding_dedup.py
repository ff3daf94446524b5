"""Embedding near-duplicates by dual traversal of cover trees.

Vectors with cosine of at least ``threshold`` link.  Scaled to length one they
are within the Euclidean distance sqrt(2 - 2 threshold), so metric bounds hold.

Equal vectors are one class first.  Classes are dealt to cells around centres:
the net that halving radii give on a bounded sample.  Each pair of cells meets in
one of the two: a class is also sent to the cells whose centre is within that
cell's covering radius and the linking distance of it, and whose distances to
each of some other centres reach to the linking distance of its own; others
can't hold a partner.  Crowded cells are split by hash, and their parts meet likewise.

A task builds a cover tree (nested levels, radii halved) of its cell and walks
it against itself and against trees of the visitors.  A pair of nodes whose
centres are further apart than both covering radii and the linking distance is
pruned; one that lies within it as a whole is counted without looking further;
of the others the wider node is opened; leaves compare exactly in double
precision.  Out go link counts and a spanning forest, never all pairs.

Defined cases: null, zero, empty and non-finite vectors and such with null parts
link with nothing, not even their equals; vectors of different lengths don't
link; repeated rows are rows, so equal vectors link; ids may repeat (each row
counts) and rows without an id get a null component unless an id reaches them;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import checkpointed
from folio.llm.components import components

THRESHOLD = 0.95
#: Bytes of vectors, in double precision, that a cell should have, and that one part of a crowded cell has on average.
CELL_BYTES, PART_BYTES = 8 << 20, 16 << 20
#: Cells at most; sampled vectors that centres are chosen from.
MAX_CELLS, SAMPLE = 512, 4_096
#: Centres whose distances to all that a cell holds are kept as ranges.
RANGES = 16
LEAF = 64
#: Visitors that get a tree of their own together.
VISITORS = 2_048
#: Slack of the bounds, above rounding; pairs this near the threshold are computed again, exactly summed.
SLACK = 1e-9


class Node:
    __slots__ = ("centre", "children", "members", "radius")

    def __init__(self, centre: int, members: np.ndarray, radius: float, children: list[Node]):
        self.centre, self.members, self.radius, self.children = centre, members, radius, children


def _distances(x: np.ndarray, members: np.ndarray, centre: int) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x[members] @ x[centre]), 0))


def cover_tree(x: np.ndarray) -> Node:
    """Tree of unit vectors: a node's centre is a child's too, and a level's radii are half of those above."""

    def grow(members: np.ndarray, centre: int, away: np.ndarray, reach: float) -> Node:
        node = Node(centre, members, float(away.max(initial=0.0)), [])
        if len(members) <= LEAF or node.radius <= SLACK:
            return node
        while reach >= node.radius:
            reach /= 2
        rest, far, own = members, away, centre
        children = []
        while len(rest):
            if own is None:
                own = int(rest[far.argmax()])  # the next centre is the one that the first covers least
            d = _distances(x, rest, own)
            near = d <= reach
            near[rest == own] = True
            children.append((rest[near], own, d[near]))
            rest, far, own = rest[~near], far[~near], None
            if len(children) > 32 and len(children) * 2 > len(members) - len(rest):
                return node  # the level covers next to nothing together: compared as a leaf
        node.children = [grow(m, c, d, reach / 2) for m, c, d in children]
        return node

    every = np.arange(len(x))
    return grow(every, 0, _distances(x, every, 0), 2.0)


class Found:
    """Links counted, and the forest that connects them, over the places of two sets of vectors."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), dtype=np.int64)
        self.parent = list(range(len(weights)))
        self.forest: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def connect(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.forest.append((i, j))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        n = len(self.counts)
        self.counts += np.bincount(a, self.weights[b], n).astype(np.int64) + np.bincount(b, self.weights[a], n).astype(np.int64)
        while len(a):  # most pairs of a dense group are connected by the time their turn comes
            for i, j in zip(a[:1000].tolist(), b[:1000].tolist(), strict=True):
                self.connect(i, j)
            label = np.array(self.parent)
            while (label != label[label]).any():
                label = label[label]
            self.parent = label.tolist()
            apart = label[a[1000:]] != label[b[1000:]]
            a, b = a[1000:][apart], b[1000:][apart]

    def add_all(self, a: np.ndarray, b: np.ndarray) -> None:
        """All pairs of one of ``a`` with one of ``b``, which share none."""
        self.counts[a] += self.weights[b].sum()
        self.counts[b] += self.weights[a].sum()
        for j in b.tolist():
            self.connect(int(a[0]), j)
        for i in a.tolist():
            self.connect(i, int(b[0]))

    def add_within(self, a: np.ndarray) -> None:
        self.counts[a] += self.weights[a].sum() - self.weights[a]
        for i in a.tolist():
            self.connect(int(a[0]), i)


def _linked(x: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Exact pairs of two leaves, a block at a time."""
    out = []
    for at in range(0, len(a), 1024):
        cosines = x[a[at : at + 1024]] @ x[b].T
        i, j = np.nonzero(cosines >= threshold - SLACK)
        near = np.abs(cosines[i, j] - threshold) <= SLACK
        i += at
        keep = np.ones(len(i), dtype=bool)
        for k in np.flatnonzero(near):
            keep[k] = math.fsum((x[a[i[k]]] * x[b[j[k]]]).tolist()) >= threshold
        out.append((a[i[keep]], b[j[keep]]))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def traverse(x: np.ndarray, left: Node, right: Node, threshold: float, found: Found) -> None:
    """All links between two trees, or within one."""
    reach = math.sqrt(2 - 2 * threshold)
    pairs = [(left, right)]
    while pairs:
        a, b = pairs.pop()
        if a is b:
            if 2 * a.radius <= reach - SLACK:
                found.add_within(a.members)
            elif a.children:
                pairs += [(c, d) for i, c in enumerate(a.children) for d in a.children[i:]]
            else:
                i, j = _linked(x, a.members, a.members, threshold)
                found.add(i[i < j], j[i < j])
            continue
        apart = math.sqrt(max(0.0, 2 - 2 * float(x[a.centre] @ x[b.centre])))
        if apart > a.radius + b.radius + reach + SLACK:
            continue
        if apart + a.radius + b.radius <= reach - SLACK:
            found.add_all(a.members, b.members)
        elif not a.children and not b.children:
            found.add(*_linked(x, a.members, b.members, threshold))
        elif a.children and (a.radius >= b.radius or not b.children):
            pairs += [(c, b) for c in a.children]
        else:
            pairs += [(a, c) for c in b.children]


def _unit(vectors: pa.Array) -> np.ndarray:
    """Rows of length one, in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def halving_net(x: np.ndarray, most: int) -> np.ndarray:
    """Centres of the finest net of halving radii that has at most ``most``."""
    best = np.zeros(1, dtype=np.int64)
    reach = 1.0
    while reach > 1e-3:
        away, chosen = np.full(len(x), np.inf), []
        while away.max() > reach and len(chosen) <= most:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, np.sqrt(np.maximum(2 - 2 * (x @ x[chosen[-1]]), 0)))
        if len(chosen) > most:
            # too fine: the net's first centres, which are the furthest apart
            return np.array(chosen[:most])
        best, reach = np.array(chosen), reach / 2
    return best


def _valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda v: v != 0), F.lit(False))


LINKS = "a long, b long, n long"
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def _walk(threshold: float):
    def rows(ids: np.ndarray, found: Found) -> pa.RecordBatch:
        a, b = (np.array(v, dtype=np.int64) for v in (zip(*found.forest, strict=True) if found.forest else ((), ())))
        counted = np.flatnonzero(found.counts)
        return pa.RecordBatch.from_arrays([pa.array(np.r_[ids[counted], ids[a]]), pa.array([None] * len(counted) + ids[b].tolist(), pa.int64()), pa.array(np.r_[found.counts[counted], np.zeros(len(a), dtype=np.int64)])], schema=_LINKS)

    def visit(own: list, visitors: list, tree: Node | None) -> Iterator[pa.RecordBatch]:
        x = np.concatenate([own[2], *[v[2] for v in visitors]])
        ids, weights = np.concatenate([own[0], *[v[0] for v in visitors]]), np.concatenate([own[1], *[v[1] for v in visitors]])
        found, n = Found(weights), len(own[0])
        other = cover_tree(x[n:])

        def moved(node: Node) -> Node:
            return Node(node.centre + n, node.members + n, node.radius, [moved(c) for c in node.children])

        traverse(x, tree, moved(other), threshold, found)
        yield rows(ids, found)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, own, tree, waiting = None, [], None, None, []

        def settle() -> Iterator[pa.RecordBatch]:
            """The unit's own are complete: their tree, and links among them."""
            nonlocal own, tree, held
            if own is None and held:
                own = [np.concatenate([h[i] for h in held]) for i in range(3)]
                held = []
                tree = cover_tree(own[2])
                found = Found(own[1])
                traverse(own[2], tree, tree, threshold, found)
                yield rows(own[0], found)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            if waiting and own is not None:
                yield from visit(own, waiting, tree)
            waiting = []

        for batch in batches:
            units, visitor = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.r_[True, (units[1:] != units[:-1]) | (visitor[1:] != visitor[:-1])]).tolist()
            for start, stop in zip(cuts, [*cuts[1:], len(units)], strict=True):
                if units[start] != unit:
                    yield from settle()
                    yield from flush()
                    unit, held, own, tree = units[start], [], None, None
                for at in range(start, stop, VISITORS):
                    part = batch.slice(at, min(VISITORS, stop - at))
                    values = [part.column(2).to_numpy(), part.column(3).to_numpy(), _unit(part.column(4))]
                    if visitor[start]:
                        yield from settle()
                        waiting.append(values)
                        if sum(len(w[0]) for w in waiting) >= VISITORS:
                            yield from flush()
                    else:
                        held.append(values)
        yield from settle()
        yield from flush()

    return work


def _dealt(centres: np.ndarray, radii: np.ndarray, ranges: tuple[np.ndarray, np.ndarray], parts: np.ndarray, reach: float):
    """unit, visitor, rid, weight, vector: a class at home, and as a visitor wherever a partner may be that no other meeting covers."""
    first = np.concatenate([[0], np.cumsum(parts)])
    least, most = ranges

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                d = np.sqrt(np.maximum(2 - 2 * (_unit(part.column(2)) @ centres.T), 0))
                home, rid = d.argmin(axis=1), part.column(0).to_numpy()
                own = ((rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts[home]
                rows = [np.arange(len(rid))]
                units, visitor = [first[home] + own], [np.zeros(len(rid), dtype=np.int32)]
                later = (d <= radii + reach + SLACK) & (np.arange(len(radii)) > home[:, None])
                for k in range(least.shape[1]):
                    later &= (d[:, k, None] >= least[:, k] - reach - SLACK) & (d[:, k, None] <= most[:, k] + reach + SLACK)
                i, j = np.nonzero(later)
                for cell in np.unique(j):
                    for p in range(parts[cell]):
                        rows.append(i[j == cell])
                        units.append(np.full(len(rows[-1]), first[cell] + p))
                        visitor.append(np.ones(len(rows[-1]), dtype=np.int32))
                for p in range(1, int(parts.max(initial=1))):
                    rows.append(np.flatnonzero((own < p) & (parts[home] > p)))
                    units.append(first[home[rows[-1]]] + p)
                    visitor.append(np.ones(len(rows[-1]), dtype=np.int32))
                take = pa.array(np.concatenate(rows))
                taken = part.take(take)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(units).astype(np.int64)), pa.array(np.concatenate(visitor), pa.int32()), taken.column(0), taken.column(1), taken.column(2)], names=["unit", "visitor", "rid", "weight", "vector"])

    return work


def _homes(centres: np.ndarray):
    """Each batch's cells: classes, the furthest from the centre, and the range of distances to each of the first centres."""
    n = min(RANGES, len(centres))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = np.sqrt(np.maximum(2 - 2 * (_unit(batch.column(0)) @ centres.T), 0))
            home = d.argmin(axis=1)
            order = np.argsort(home, kind="stable")
            at = np.flatnonzero(np.r_[True, np.diff(home[order]) > 0])
            near, d = d[order, home[order]], d[order, :n]
            columns = [home[order][at], np.diff(np.r_[at, len(order)]), np.maximum.reduceat(near, at), *np.minimum.reduceat(d, at).T, *np.maximum.reduceat(d, at).T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "n", "away", *[f"least{k}" for k in range(n)], *[f"most{k}" for k in range(n)]])

    return work


def links(classes: DataFrame, threshold: float = THRESHOLD, cell: int | None = None, part: int | None = None) -> DataFrame:
    """LINKS of (rid, weight, vector) rows, vectors of one length: counts for a (b null), and connecting pairs a, b."""
    n = classes.count()
    sample = classes.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).toArrow()["vector"].combine_chunks()  # SAMPLE rows at most
    x = _unit(sample)
    cell, part = cell or max(LEAF, CELL_BYTES // (8 * x.shape[1])), part or max(LEAF, PART_BYTES // (8 * x.shape[1]))
    centres = x[halving_net(x, min(MAX_CELLS, max(1, -(-n // cell))))]
    k = min(RANGES, len(centres))
    columns = ["n", "away", *[f"least{i}" for i in range(k)], *[f"most{i}" for i in range(k)]]
    met = classes.select("vector").mapInArrow(_homes(centres), "cell long, n long, " + ", ".join(f"{c} double" for c in columns[1:]))
    totals = [F.sum("n").alias("n"), F.max("away").alias("away"), *[(F.min if c.startswith("least") else F.max)(c).alias(c) for c in columns[2:]]]
    homes = {r.cell: r for r in met.groupBy("cell").agg(*totals).collect()}  # at most MAX_CELLS rows
    nowhere = [0, -10.0, *[10.0] * k, *[-10.0] * k]
    told = np.array([[homes[i][c] for c in columns] if i in homes else nowhere for i in range(len(centres))], dtype=np.float64)
    parts = np.maximum(1, -(-told[:, 0].astype(np.int64) // part))
    kind = classes.schema["vector"].dataType.simpleString()
    dealt = classes.select("rid", "weight", "vector").mapInArrow(_dealt(centres, told[:, 1], (told[:, 2 : 2 + k], told[:, 2 + k :]), parts, math.sqrt(2 - 2 * threshold)), f"unit long, visitor int, rid long, weight long, vector {kind}")
    return dealt.repartition("unit").sortWithinPartitions("unit", "visitor").mapInArrow(_walk(threshold), LINKS)


def groups(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", cell: int | None = None, part: int | None = None) -> DataFrame:
    """id, n_links (other rows linked directly), component_id (smallest id reachable), kept (id = component_id)."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("original"), _valid(F.col(vector_col)).alias("valid"))
    classes = rows.filter("valid").groupBy("original").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
    classes = checkpointed(classes.select(F.monotonically_increasing_id().alias("rid"), "original", "weight", "least"))
    found = None
    for r in classes.select(F.size("original").alias("size")).distinct().collect():  # lengths of vectors: one, but for odd tables
        vector = F.col("original") if dict(classes.dtypes)["original"] == "array<float>" else F.col("original").cast("array<double>")
        own = classes.filter(F.size("original") == r.size).select("rid", "weight", vector.alias("vector"))
        own = links(own, threshold, cell, part)
        found = own if found is None else found.unionByName(own)
    invalid = rows.filter("not valid").selectExpr("id", "0L as n_links", "id as component_id")
    if found is None:
        done = invalid
    else:
        found = checkpointed(found)
        counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
        nodes = components(found.filter("b is not null").select("a", "b"))
        named = classes.select("rid", "original", "weight", "least").join(counts.withColumnRenamed("a", "rid"), "rid", "left").join(nodes.withColumnRenamed("node", "rid"), "rid", "left")
        named = named.select("original", "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rid").alias("component"))
        smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
        done = rows.filter("valid").join(named.join(smallest, "component").drop("least", "component"), "original").select("id", "n_links", "component_id").unionByName(invalid)
    return done.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))

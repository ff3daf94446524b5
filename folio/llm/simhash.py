"""SimHash fingerprints and near-duplicate groups by pivot distance tables.

Fingerprints of 64 bits are taken over word shingles; two link when at most
``reach`` bits differ.  Only distinct fingerprints are compared.

Distances to reference fingerprints (pivots) both partition and prune.  By the
triangle inequality a pair whose distances to any pivot differ by more than
``reach`` doesn't link, so fingerprints are dealt to cells by their distances to
several pivots, cells overlapping by ``reach``; the number of pivots follows that
of the fingerprints, and cells that are still crowded are split by further ones.
Within a cell a table of distances to many more pivots discards pairs by their
largest coordinate difference, and what survives is verified bit by bit.

A task doesn't send all the pairs it finds, but a spanning forest of them;
groups are the connected components of the forests.

Defined cases: a null or word-less text has fingerprint zero, which links like
any other; a text shorter than a shingle is one shingle; repeated rows share a
fingerprint and so a group; the smallest id names the group (rows without an id
are grouped but name none, unless all are); an empty table gives an empty
result; other columns are ignored.
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

SHINGLE = 3
REACH = 2
SEED = 42
PIVOTS = 32
#: Distinct fingerprints of a cell that are compared without splitting it.
CROWDED = 4_096
#: Pivots that cells are split by, at most: what they can't tell apart is compared in one task, however many.
MOST_SPLITS = 64
#: Width of a cell and where cells begin, in bits of distance: near and far half, the best cut for its overlap.
CELL, CUT = 32, 1
#: What one pivot divides the size of a cell by, for unrelated fingerprints.
GAIN = 1.66


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of XXH64 over the word shingles, A-Z lower-cased, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    if shingle == 3:
        hashes = [xxh64_intdigest(b"%b %b %b" % w, SEED) for w in zip(words, words[1:], words[2:], strict=False)]
    else:
        hashes = [xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(len(words) - shingle + 1)]
    # eight bytes spread their bits over the eight byte lanes of a word: 255 of them add up without a carry
    h = np.array(hashes, dtype=np.uint64)
    votes = np.zeros((8, 8), dtype=np.int64)  # bit within a byte, byte
    lane = np.uint64(0x0101010101010101)
    for bit in range(8):
        spread = (h >> np.uint64(bit)) & lane
        sums = np.add.reduceat(spread, np.arange(0, len(h), 255))
        votes[bit] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = 2 * votes > len(h)
    return sum(1 << (8 * byte + bit) for bit in range(8) for byte in range(8) if bits[bit, byte])


def fingerprints(df: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", keep: str | None = None) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long), and a whole-number column to ``keep``."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), *([(keep, pa.int64())] if keep else [])])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                found = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64)), *part.columns[2:]], schema=schema)

    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *([F.col(keep)] if keep else []))
    return own.mapInArrow(work, "doc_id long, fp long" + (f", {keep} long" if keep else ""))


def pivots(n: int) -> np.ndarray:
    """Fixed pseudo-random reference fingerprints."""
    return np.random.default_rng(20_240_601).integers(0, 1 << 64, n, dtype=np.uint64)


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def close_pairs(fps: np.ndarray, reach: int, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places whose fingerprints differ in at most ``reach`` bits."""
    table = distance_table(fps, refs)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order].T.copy()
    until = np.searchsorted(table[0], table[0] + reach, side="right")
    found = []
    for at in range(0, len(fps), 64):
        # a block against all that its distances to the first pivot leave, then pivot by pivot
        own = np.arange(at, min(at + 64, len(fps)))
        rest = np.arange(at + 1, until[own[-1]])
        i, j = np.nonzero((rest > own[:, None]) & (rest < until[own][:, None]) & (np.abs(table[1, own][:, None] - table[1, rest]) <= reach))
        i, j = own[i], rest[j]
        for distances in table[2:]:
            if not len(i):
                break
            near = np.abs(distances[i] - distances[j]) <= reach
            i, j = i[near], j[near]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= reach
        if near.any():
            found.append((i[near], j[near]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b = (order[np.concatenate(x)] for x in zip(*found, strict=True))
    return a, b


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that are enough to connect what ``a``-``b`` pairs connect."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def _links(reach: int, refs: np.ndarray):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def of(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own = np.concatenate(parts)
        pairs = spanning_forest(len(own), *close_pairs(own.view(np.uint64), reach, refs)) if len(own) > 1 else []
        if pairs:
            a, b = (own[list(x)] for x in zip(*pairs, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            cells, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            for start, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), len(cells)], strict=True):
                if cells[start] != last and held:
                    yield from of(held)
                    held = []
                last = cells[start]
                held.append(fps[start:stop])
        if held:
            yield from of(held)

    return work


def _split(cells: DataFrame, refs: np.ndarray, reach: int) -> DataFrame:
    """(cell, fp): each cell cut by the distances to each of the pivots.

    A cell of width ``CELL`` holds fingerprints by their distance; one that is up
    to ``reach`` below the next cell goes there too.  So two that differ in at most
    ``reach`` bits share a cell for every pivot: that of the larger distance.  The
    cells of all pivots are found before a row is copied to any, so that no
    pivot's copies are made again for the next.
    """

    def cut(met: Column, ref: Column) -> Column:
        far = F.bit_count(F.col("fp").bitwiseXOR(ref))
        own = F.array_distinct(F.array(F.floor((far - CUT) / CELL), F.floor((far - CUT + reach) / CELL)))
        return F.flatten(F.transform(met, lambda cell: F.transform(own, lambda c: F.xxhash64(cell, c))))

    if not len(refs):
        return cells
    dealt = F.aggregate(F.array(*[F.lit(r) for r in refs.view(np.int64).tolist()]), F.array("cell"), cut)
    return cells.select(F.explode(dealt).alias("cell"), "fp")


def links(distinct: DataFrame, reach: int = REACH, n_pivots: int = PIVOTS, crowded: int = CROWDED) -> DataFrame:
    """(a, b) pairs of different fingerprints that connect all that link."""
    refs, splitting = pivots(n_pivots), pivots(n_pivots + MOST_SPLITS)[n_pivots:]
    n = distinct.count()
    # as many pivots as leave cells of half that size if distances are those of unrelated fingerprints
    first = max(0, math.ceil(math.log(max(n, 1) / max(crowded / 2, 1)) / math.log(GAIN)))
    cells, met, used = distinct.select(F.lit(0).cast("long").alias("cell"), "fp"), None, 0
    while True:
        take = min(first if not used else 2, MOST_SPLITS - used)
        cells = _split(cells, splitting[used : used + take], reach)
        used += max(take, 1)
        full = None
        if used < MOST_SPLITS:
            full = checkpointed(cells.groupBy("cell").agg(F.count("*").alias("size")).filter(F.col("size") > crowded).select("cell"))
            if full.isEmpty():
                full = None
        few = cells if full is None else cells.join(full, "cell", "left_anti")
        met = few if met is None else met.unionByName(few)
        if full is None:
            break
        cells = checkpointed(cells.join(full, "cell", "left_semi"))
    # a fingerprint that several ways lead to one cell is there once
    dealt = met.repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(_links(reach, refs), "a long, b long")


def groups(df: DataFrame, shingle: int = SHINGLE, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    prints = checkpointed(fingerprints(df, shingle, id_col, text_col))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    nodes = components(links(distinct.select("fp"), reach))
    # a component's name is the smallest id below any of its fingerprints
    named = distinct.join(nodes, distinct.fp == nodes.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "component").select("fp", "component_id")
    return prints.join(classes, "fp").select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(df: DataFrame, shingle: int = SHINGLE, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, all columns as they are: that of the smallest id, then of the smallest hash of the row; without ids, last.

    Rows are told apart by id and a hash of all their columns, so rows that repeat
    an id stand for themselves; of rows equal in all, one is taken first, in each
    task before the shuffle.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole_row"), F.col(f"`{id_col}`").try_cast("long").alias("row_id"), row.alias("row_hash"), F.col(f"`{text_col}`").alias("whole_text"))
    prints = checkpointed(fingerprints(marked, shingle, "row_hash", "whole_text", keep="row_id"))
    place = F.struct(F.col("row_id").isNull().alias("last"), "row_id", F.col("doc_id").alias("row_hash"))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min(place).alias("first")))
    nodes = components(links(distinct.select("fp"), reach))
    named = distinct.join(nodes, distinct.fp == nodes.node, "left").select("first", F.coalesce("component", "fp").alias("component"))
    chosen = named.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row_id").alias("chosen_id"), F.col("first.row_hash").alias("chosen_hash"))
    rows = marked.groupBy("row_id", "row_hash").agg(F.first("whole_row").alias("whole_row"))
    return rows.join(chosen, F.col("row_id").eqNullSafe(F.col("chosen_id")) & (F.col("row_hash") == F.col("chosen_hash")), "left_semi").select("whole_row.*")

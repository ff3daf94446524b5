"""Exact removal of repeated passages with a run-length index.

A window is a ``length``-byte string of one document.  Every byte covered by a
window that also starts anywhere else (same document included) is marked.

1. Anchors.  Each window picks the smallest of its hashed k-grams (leftmost on
   ties), so equal windows pick equal k-grams at equal places.  Consecutive
   windows with one pick form a segment; two equal windows are always in
   segments with equal anchors.  Segments are counted by the digests of their contents:
   alone under their anchor, they hold no repeat; with a content seen twice,
   they repeat whole.  What is left, one copy of each content, goes on.
2. Index.  The contents under an anchor are gathered and, for a bounded chunk of
   whole anchors at a time, their Burrows-Wheeler transform is built and
   run-compressed.  Suffix positions and match lengths are sampled at run heads
   and tails only; streaming over the text, a position's matching statistic is
   its last sample less the distance from it.  Windows with a statistic of at
   least ``length`` repeat.
3. Crowded anchors, with over ``CROWDED`` different contents, would not fit one
   task.  Their segments are cut anew by longer k-grams and counted again; at the
   last level an anchor is the window itself and counting decides it.

Shuffled are anchors (one per some 80 bytes), contents that are neither alone
nor copies, and each text twice: to cut contents from it, and marks out of it.
What a shuffle has brought is written by a checkpoint, and the shuffle let go
of before the next one.  No step pairs documents or segments.

Defined cases: a null text is empty; nothing is marked in texts under ``length``
bytes; repeated rows are documents of their own, so long ones lose all bytes;
rows that share an id, or have none, are documents of their own too; an empty
table gives an empty result; other columns are ignored by ``dedup`` and kept by
``without_repeats``.

Contents are equal if their 128-bit digests are, and matches in the index are
compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import checkpointed, release

LENGTH = 200
#: Sizes of the k-grams that levels anchor by, as parts of ``length`` (the last: the window itself).
LEVELS = (0.16, 0.92, 1.0)
#: Different contents under one anchor that the index takes.
CROWDED = 4_096
#: Bytes that are hashed at a time; longer texts are hashed in overlapping slices.
SLICE = 1 << 20
#: Bytes of contents that one index holds, but for an anchor that has more.
CHUNK = 1 << 19
#: Anchors that a task sums up before it sends them.
SUMMED = 400_000

#: Names of passing columns that no table is expected to have.
_CONTENT, _STARTS, _COUNTS = "__repeat_content__", "__repeat_starts__", "__repeat_counts__"
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of any substring of an array of symbols, from sums over its prefixes."""

    SYMBOLS = _mixed(np.arange(1, 512, dtype=np.uint64) * np.uint64(_BASE))
    _up = _powers(_BASE, 1)
    _down = _powers(_BASE, 1)

    def __init__(self, symbols: np.ndarray):
        n = len(symbols) + 1
        if len(Hasher._up) < n:
            size = 1 << (n - 1).bit_length()
            Hasher._up, Hasher._down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(Hasher.SYMBOLS[symbols] * Hasher._up[: n - 1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * Hasher._down[starts]

    def all_of(self, k: int) -> np.ndarray:
        return (self.sums[k:] - self.sums[:-k]) * Hasher._down[: len(self.sums) - k]


def _sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each ``w`` neighbours."""
    if w == 1:
        return values
    n = len(values)
    padded = np.full(-(-n // w) * w, np.uint64(_MASK))
    padded[:n] = values
    blocks = padded.reshape(-1, w)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - w + 1], head[w - 1 : n])


#: Bits of a place in a slice; hashes of k-grams are compared by the others, the same ones in all slices.
PLACE_BITS = 23


def segments(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, ...]:
    """Anchor, content digest (two halves), text number, start and number of windows of every segment of the texts, hashed together.

    The digest is XXH3's of 128 bits over the content's bytes, so equal contents
    don't rest on the rolling hash that picks the anchors.
    """
    from xxhash import xxh3_128_digest

    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    whole = b"".join(texts)
    data = np.frombuffer(whole, dtype=np.uint8)
    n = len(data)
    if n < length or not (sizes >= length).any():
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty, empty, empty
    assert n < 1 << PLACE_BITS
    ends = np.cumsum(sizes)
    hashed = Hasher(data)
    bits = np.uint64(PLACE_BITS)
    position = np.arange(n - k + 1, dtype=np.uint64)
    values = (_mixed(hashed.all_of(k)) >> bits << bits) | position
    picked = (_sliding_min(values, length - k + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    del values, position
    inside = np.ones(n - length + 1, dtype=bool)
    for e in ends[:-1].tolist():
        inside[max(0, e - length + 1) : e] = False
    change = np.ones(len(inside) + 1, dtype=bool)
    change[1:-1] = (picked[1:] != picked[:-1]) | (inside[1:] != inside[:-1])
    cuts = np.flatnonzero(change)
    first, last = cuts[:-1], cuts[1:]
    keep = inside[first]
    first, last = first[keep], last[keep]
    at = picked[first]
    anchor = _mixed(hashed(at, at + k) + np.uint64(k))
    digests = b"".join([xxh3_128_digest(whole[i:j]) for i, j in zip(first.tolist(), (last - 1 + length).tolist(), strict=True)])
    halves = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
    text = np.searchsorted(ends, first, side="right")
    return anchor, halves[:, 0], halves[:, 1], text, first - (ends - sizes)[text], last - first


def _slices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[list[bytes], list[int], list[int], list[int], list[int]]]:
    """Texts of about SLICE bytes together, with their keys, tags, offsets and weights; no window is in two of them."""
    texts: list[bytes] = []
    places: list[tuple[int, int, int, int]] = []
    held = 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):  # a few rows at a time as Python objects
            for key, base, weight, text, *tag in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                if text is None or len(text) < length:
                    continue
                for at in range(0, len(text) - length + 1, SLICE):
                    part = text[at : at + SLICE + length - 1]
                    texts.append(part)
                    places.append((key, tag[0] if tag else 0, base + at, weight))
                    held += len(part)
                    if held >= SLICE:
                        yield texts, *map(list, zip(*places, strict=True))
                        texts, places, held = [], [], 0
    if texts:
        yield texts, *map(list, zip(*places, strict=True))


SUMS = "a long, u long, v long, c long, key long, tag long, start long, n int"
SEGMENTS = "u long, v long, key long, tag long, start long, n int"


def _schema(columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])


def _table(columns: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def anchored(length: int, k: int, summed: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For (key, base, weight, content, tag) rows (the tag may be left out, as 0): rows of SEGMENTS, or of SUMS, one for each content that a task meets at a time."""
    schema = _schema(SUMS if summed else SEGMENTS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for texts, *places in _slices(batches, length):
            a, u, v, text, start, n = segments(texts, length, k)
            key, tag, base, weight = (np.array(p, dtype=np.int64)[text] for p in places)
            yield [a, u, v, weight, key, tag, start + base, n.astype(np.int32)]

    def sums(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        a, u, v, c, key, tag, start, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((start, tag, key, v, u))
        u, v = u[order], v[order]
        first = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
        own = order[first]
        return _table([a[own], u[first], v[first], np.add.reduceat(c[order], first), key[own], tag[own], start[own], n[own]], schema)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for own in rows(batches):
            if not len(own[0]):
                continue
            if not summed:
                yield _table([own[i] for i in (1, 2, 4, 5, 6, 7)], schema)
                continue
            parts.append(own)
            held += len(own[0])
            if held >= SUMMED:
                yield sums(parts)
                parts, held = [], 0
        if parts:
            yield sums(parts)

    return anchors


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; ``symbols`` are below 512 and the text ends with its smallest."""
    n = len(symbols)
    step = 7
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(step, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(step):
        key = (key << 9) | padded[i : i + n]
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.r_[False, sorted_key[1:] != sorted_key[:-1]]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new)
        if step >= n or rank[order[-1]] == n - 1:
            return order
        follow = np.zeros(n, dtype=np.int64)
        follow[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + follow
        step *= 2


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of some contents, with samples at the ends of its runs."""

    def __init__(self, contents: list[bytes], verify: int = 1):
        """Matches of ``verify`` symbols and more are compared symbol by symbol; shorter ones rest on hashes."""
        sizes = np.array([len(c) for c in contents], dtype=np.int64)
        text = np.frombuffer(b"\0".join(contents) + b"\0", dtype=np.uint8).astype(np.int64) + 1
        self.ends = np.cumsum(sizes + 1) - 1
        text[self.ends] = 0  # separators, below all bytes
        self.starts = self.ends - sizes
        self.n = len(text)
        order = suffix_order(text)
        bwt = np.where(order > 0, text[order - 1], -1)  # nothing stands before the text: a run alone
        differs = np.flatnonzero(bwt[1:] != bwt[:-1])
        self.run_symbols = bwt[np.r_[0, differs + 1]]
        self.run_lengths = np.diff(np.r_[0, differs + 1, self.n])
        tails, heads = order[differs], order[differs + 1]  # neighbours across a run's end
        common = self._verified(text, self._common(Hasher(text), tails, heads), tails, heads, verify)
        # the first row has no neighbour above it, the last none below
        self.head_samples = np.r_[order[0], heads], np.r_[0, common]
        self.tail_samples = np.r_[order[-1], tails], np.r_[0, common]

    def _common(self, hashed: Hasher, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes, by halving."""
        least, most = np.zeros(len(a), dtype=np.int64), self.n - np.maximum(a, b)
        while (least < most).any():
            middle = (least + most + 1) // 2
            same = hashed(a, a + middle) == hashed(b, b + middle)
            least, most = np.where(same, middle, least), np.where(same, most, middle - 1)
        return least

    @staticmethod
    def _verified(text: np.ndarray, common: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
        """``common`` cut at the first symbol that differs, a block of suffixes at a time."""
        for own in np.array_split(long := np.flatnonzero(common >= least), max(1, int(common[long].sum()) >> 20)):
            sizes = common[own]
            if not len(own):
                continue
            starts = np.cumsum(sizes) - sizes
            step = np.arange(sizes.sum()) - np.repeat(starts, sizes)
            differs = text[np.repeat(a[own], sizes) + step] != text[np.repeat(b[own], sizes) + step]
            if differs.any():
                common[own] = np.minimum.reduceat(np.where(differs, step, np.repeat(sizes, sizes)), starts)
        return common

    def matching_statistics(self) -> np.ndarray:
        """For each position, the length of the longest match that starts there and elsewhere, within its content."""
        position = np.arange(self.n)
        best = np.zeros(self.n, dtype=np.int64)
        for at, value in (self.head_samples, self.tail_samples):
            sampled, last = np.zeros(self.n, dtype=np.int64), np.zeros(self.n, dtype=np.int64)
            sampled[at], last[at] = value, at
            known = np.zeros(self.n, dtype=bool)
            known[at] = True
            last = np.maximum.accumulate(np.where(known, position, -1))
            best = np.maximum(best, np.where(last >= 0, sampled[last] - (position - last), 0))
        return np.minimum(best, np.repeat(self.ends, self.ends - self.starts + 1) - position)


MARKS = "key long, tag long, start long, n long"


def indexed(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Marks of (a, key, tag, start, c, content) rows that come sorted by a."""
    schema = _schema(MARKS)

    def marks(keys: list[int], tags: list[int], starts: list[int], counts: list[int], contents: list[bytes]) -> pa.RecordBatch:
        index = RunLengthIndex(contents, length)
        hit = np.r_[False, index.matching_statistics() >= length, False]
        edges = np.flatnonzero(hit[1:] != hit[:-1])
        first, last = edges[::2], edges[1::2]
        own = np.searchsorted(index.ends, first)
        alone = np.array(counts)[own] == 1  # others are marked whole already
        first, last, own = first[alone], last[alone], own[alone]
        return _table([np.array(keys, dtype=np.int64)[own], np.array(tags, dtype=np.int64)[own], np.array(starts, dtype=np.int64)[own] + first - index.starts[own], last - first], schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, ...] = ([], [], [], [], [])
        size, last = 0, None
        for batch in batches:
            for a, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= CHUNK and a != last:
                    yield marks(*held)
                    held, size = ([], [], [], [], []), 0
                for own, value in zip(held, row, strict=True):
                    own.append(value)
                size, last = size + len(row[-1]), a
        if size:
            yield marks(*held)

    return work


def _groups(source: DataFrame, length: int, k: int) -> DataFrame:
    """Contents under anchors that occur more than once: a, u, v, copies c, the first's place, and the number of contents under the anchor.

    Contents are counted by their digests and anchors by partial sums over their
    contents, so that no task gathers what a hot anchor or content has.
    """
    once = source.mapInArrow(anchored(length, k, summed=True), SUMS)
    contents = once.groupBy("a", "u", "v").agg(F.sum("c").alias("c"), F.min(F.struct("key", "tag", "start", "n")).alias("first"))
    # the use of ``first`` keeps the columns of both sides alike, so that their shuffle is one
    shared = contents.groupBy("a").agg(F.count("*").alias("contents"), F.sum("c").alias("uses"), F.count("first").alias("known")).filter("uses > 1 and known > 0").select("a", "contents")
    return contents.join(shared, "a").select("a", "u", "v", "c", "first.*", "contents")


def _unique(df: DataFrame, id_col: str) -> bool:
    """Whether every row has a whole number of its own as its id."""
    ids = df.select(F.col(id_col).try_cast("long").alias("key"))
    return ids.filter("key is null").isEmpty() and ids.groupBy("key").count().filter("count > 1").isEmpty()


class Texts:
    """Rows as key, tag, content and ``others`` (the other columns), and the different (key, tag, content) among them.

    The key is the id and the tag 0; where ids repeat or lack, the tag is a hash
    of the text, so that only rows with one id and one text share their marks,
    which are the same.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, others: tuple[str, ...] = ()):
        unique = _unique(df, id_col)
        self.keys = ["key"] if unique else ["key", "tag"]
        key = F.coalesce(F.col(id_col).try_cast("long"), F.lit(0)).alias("key")
        tag = (F.lit(0).cast("long") if unique else F.xxhash64(text_col)).alias("tag")
        content = F.col(text_col).cast("binary").alias("content")
        named = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")] if others else []
        self.source = df.select(key, tag, content)
        self.texts = df.select(key, content) if unique else self.source.dropDuplicates(self.keys)
        self.rows = df.select(key, *([] if unique else [tag]), content, *named, F.col(id_col).try_cast("long").alias("id"))

    def marked(self, length: int, crowded: int) -> DataFrame:
        """The rows with the starts (from) and numbers (n) of their runs of windows that repeat."""
        found = repeated_windows(self.source, self.texts, length, crowded)
        return self.rows.join(found.groupBy(*self.keys).agg(F.collect_list("start").alias("from"), F.collect_list("n").alias("n")), self.keys, "left")


def repeated_windows(rows: DataFrame, texts: DataFrame, length: int = LENGTH, crowded: int = CROWDED) -> DataFrame:
    """Runs of window starts that repeat: key, tag, start, n.  ``rows``: keyed texts; ``texts``: the different ones, without a tag where keys do."""
    source = rows.select("key", F.lit(0).cast("long").alias("base"), F.lit(1).cast("long").alias("weight"), "content", "tag")
    found = None
    for level, share in enumerate(LEVELS):
        k = min(length, max(1, round(share * length)))
        groups = checkpointed(_groups(source, length, k))
        release(groups.sparkSession)
        whole = groups.filter("c > 1").select("u", "v")
        # a content with copies is marked whole already
        every = source.filter("weight = 1").mapInArrow(anchored(length, k, summed=False), SEGMENTS).join(whole, ["u", "v"], "left_semi")
        marks = every.selectExpr("key", "tag", "start", "cast(n as long) as n")
        if k < length:
            places = groups.filter("contents > 1").withColumnRenamed("start", "from")
            if level == 0:
                taken = places.join(texts.withColumnRenamed("content", "text"), [c for c in ("key", "tag") if c in texts.columns]).withColumn("at", F.col("from"))
            else:  # a piece of text may hold several of a document's segments
                taken = places.join(source.selectExpr("key", "tag", "base", "content as text"), ["key", "tag"]).withColumn("at", F.col("from") - F.col("base")).filter(f"at >= 0 and at + n + {length - 1} <= length(text)")
                taken = taken.dropDuplicates(["a", "u", "v"])
            # written once: what the index takes and what the next level takes are both read from it
            content = F.expr(f"substring(text, cast(at + 1 as int), n + {length - 1})").alias("content")
            taken = checkpointed(taken.select("a", "key", "tag", "from", "c", content, "contents"))
            release(groups.sparkSession)
            few = taken.filter(F.col("contents") <= crowded).select("a", "key", "tag", "from", "c", "content")
            marks = marks.unionByName(few.repartition("a").sortWithinPartitions("a").mapInArrow(indexed(length), MARKS))
        found = marks if found is None else found.unionByName(marks)
        if k == length or groups.filter(F.col("contents") > crowded).isEmpty():
            return found
        source = taken.filter(F.col("contents") > crowded).selectExpr("key", "`from` as base", "c as weight", "content", "tag")
    return found


OUTPUTS = {
    "n_bytes": ("long", pa.int64()),
    "n_removed": ("long", pa.int64()),
    "n_spans": ("long", pa.int64()),
    "kept_sha256": ("string", pa.string()),
    "starts": ("array<long>", pa.list_(pa.int64())),
    "ends": ("array<long>", pa.list_(pa.int64())),
    "kept": ("binary", pa.binary()),
}


def spans_of(starts: list[int], counts: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes for runs of window starts."""
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.array(starts, dtype=np.int64)
    last = first + np.array(counts, dtype=np.int64) - 1 + length
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.r_[True, first[1:] > reach[:-1]]
    return first[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(first) - 1]]


def dedup(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept_sha256"), crowded: int = CROWDED) -> DataFrame:
    """One row per document: its id, and columns of ``OUTPUTS``: removed spans of bytes, what is kept, or digests of both."""
    docs = Texts(df, id_col, text_col)
    schema = pa.schema([("key", pa.int64()), *[(k, OUTPUTS[k][1]) for k in outputs]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out: list[list] = [[] for _ in outputs]
                for text, start, n in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    text = text or b""
                    first, last = spans_of(start or [], n or [], length)
                    kept = b"".join(text[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(text)], strict=True)) if len(first) else text
                    values = {"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(first), "starts": first, "ends": last, "kept": kept}
                    if "kept_sha256" in outputs:
                        values["kept_sha256"] = hashlib.sha256(kept).hexdigest()
                    for own, k in zip(out, outputs, strict=True):
                        own.append(values[k])
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, type=OUTPUTS[k][1]) for c, k in zip(out, outputs, strict=True)]], schema=schema)

    done = docs.marked(length, crowded).select("id", "content", "from", "n").mapInArrow(work, "key long, " + ", ".join(f"{k} {OUTPUTS[k][0]}" for k in outputs))
    return done.withColumnRenamed("key", id_col)


def without_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED) -> DataFrame:
    """The rows with marked bytes cut out of their texts; characters that a cut splits go too.  Other columns stay.

    Texts without a mark, null ones included, stay as they are.
    """
    others = [c for c in df.columns if c != text_col]
    docs = Texts(df, id_col, text_col, tuple(others))
    joined = docs.marked(length, crowded).select("others.*", F.col("content").alias(_CONTENT), F.col("from").alias(_STARTS), F.col("n").alias(_COUNTS))
    columns, at = list(df.columns), df.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 1024):
                part = batch.slice(row, 1024)
                texts = []
                for data, start, n in zip(*(part.column(len(others) + i).to_pylist() for i in range(3)), strict=True):
                    if start:
                        first, last = spans_of(start, n, length)
                        data = b"".join(data[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(data)], strict=True))
                    texts.append(None if data is None else data.decode("utf-8", "ignore"))
                own = [part.column(i) for i in range(len(others))]
                own.insert(at, pa.array(texts, type=pa.string()))
                yield pa.RecordBatch.from_arrays(own, names=columns)

    return joined.mapInArrow(work, df.schema)

"""Best-fit packing of tokenised documents by the sum of squares.

Documents become pieces of at most ``capacity`` tokens: one that is too long is
cut so that only its first piece is short.  A full piece is a sequence alone.
The others are placed, longest first, where the sum over gaps of (number of open
sequences with that gap) squared becomes smallest; opening a sequence is one of
the choices only if no open one has room, so none is opened in vain.

A document leaves at most one short piece, so documents are dealt by hash into
groups of ``GROUP`` short pieces on average and each group is packed by one
task: a group's size doesn't follow the table's, and what groups lose is the few
sequences that each leaves unfilled.

Defined cases: a null text is packed as the empty text (its end id alone);
repeated rows are packed each for itself, and rows that repeat an id, or have
none, are dealt by their texts; equal lengths are placed in order of id, piece,
start and ids; an empty table gives an empty result.  A special token's string
in a text is ordinary text, or that token where ``special`` is asked for, which
is the tokenizers library's own default.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
#: Short pieces that one task packs, on average.
GROUP = 32_768

#: Fixed value: how byte-level BPE of this family cuts a text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Ids of whole texts under a byte-level BPE file of the tokenizers library.

    Special tokens' strings are read as text, or with ``special`` as these
    tokens; texts that hold one then go to the tokenizers library.  Merging is left to a compiled BPE over the file's own vocabulary (its ids are
    merge ranks); probes compare it with the tokenizers library, which serves
    instead where they differ.
    """

    PROBES = ("Hello world, it's 42 o'clock.\n\n  Ünïcode — tests\t(they'll do) 日本 🎉", "AAA!! bbb&&& 12345 <|endoftext|> x", "  \n a")

    def __init__(self, path: str, special: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocab, added = content["model"]["vocab"], [t["content"] for t in content.get("added_tokens", [])]
        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = not special
        self.special = added if special else []
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if all(c in letters for c in token) and token not in added}
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        if any(self.fast.encode_ordinary(p) != self.own.encode(p, add_special_tokens=False).ids for p in self.PROBES if not self._holds_special(p)):
            self.fast = None

    def _holds_special(self, text: str) -> bool:
        return any(token in text for token in self.special)

    def packed(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        ids = self.fast.encode_ordinary(text) if self.fast and not self._holds_special(text) else self.own.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


_models: dict[tuple[str, bool], ByteBpe] = {}


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first may be short."""
    first = (length - 1) % capacity + 1
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def tokenised_pieces(df: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, special: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its ids if asked for.

    ``deal`` is a hash of the document's ids and of how many equal rows its task
    has met before: whatever order the rows come in, it is the same set of numbers.
    """
    fields = [("doc_id", pa.int64(), "long"), ("piece", pa.int32(), "int"), ("start", pa.int64(), "long"), ("length", pa.int64(), "long"), ("ids_crc32", pa.int64(), "long"), ("deal", pa.int64(), "long")]
    fields += [("ids", pa.list_(pa.int32()), "array<int>")] if with_ids else []
    schema = pa.schema([(n, t) for n, t, _ in fields])
    end = np.array([end_id], dtype="<u4").tobytes()
    from xxhash import xxh64_intdigest

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (tokenizer_path, special) not in _models:
            _models[tokenizer_path, special] = ByteBpe(tokenizer_path, special)
        bpe, met = _models[tokenizer_path, special], {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part, out = batch.slice(at, 1024), [[] for _ in fields]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = bpe.packed(text or "") + end
                    deal = xxh64_intdigest(ids) >> 1
                    met[doc, deal] = n = met.get((doc, deal), 0) + 1
                    if n > 1:
                        deal = xxh64_intdigest(f"{deal} {n}") >> 1
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + length)]
                        for column, v in zip(out, (doc, k, start, length, zlib.crc32(own), deal, np.frombuffer(own, "<i4") if with_ids else None), strict=False):
                            column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t, _) in zip(out, fields, strict=True)], schema=schema)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, ", ".join(f"{n} {t}" for n, _, t in fields))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, placed in the order given."""
    open_with = np.zeros(capacity + 1, dtype=np.int64)  # by gap; 0 and capacity stay 0: full and unopened ones don't count
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, n = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        gap = 0
        if size < capacity:
            before = open_with[size:capacity]
            if before.any():
                # how the sum changes: one fewer with this gap, one more with what is left of it; a filled one only leaves
                change = 2 * (open_with[: capacity - size] - before + 1)
                change[0] = 1 - 2 * before[0]
                gap = size + int(np.where(before > 0, change, np.iinfo(np.int64).max).argmin())
        if gap:
            own = stacks[gap].pop()
            open_with[gap] -= 1
        else:
            own, gap, n = n, capacity, n + 1
        sequence[i], offset[i] = own, capacity - gap
        left = gap - size
        if left:
            stacks[left].append(own)
            open_with[left] += 1
    return sequence, offset


def place(pieces: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; dealt by id, piece and ``deal``, so rows that share an id, or have none, spread."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "start", "deal"], ascending=[False, True, True, True, True], kind="stable")
        sequence, offset = sum_of_squares(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=pdf["pack_group"].to_numpy() * 2**32 + sequence, offset=offset).drop(columns=["pack_group", "deal"])

    kept = [f for f in pieces.schema.fields if f.name != "deal"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "start", "deal"), F.lit(groups)).cast("long"))
    return dealt.groupBy("pack_group").applyInPandas(work, schema)


def pack(df: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, with_ids: bool = False, special: bool = False) -> DataFrame:
    """Each piece with its sequence and its place there."""
    groups = max(1, -(-df.count() // group))
    return place(tokenised_pieces(df, tokenizer_path, end_id, capacity, id_col, text_col, with_ids, special), groups, capacity)

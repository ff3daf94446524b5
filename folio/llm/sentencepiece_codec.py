"""Offset-preserving SentencePiece encoding and decoding.

A text is normalised by longest-prefix look-ups in the model's compiled
character map, keeping for every normalised byte the source byte it came from.
Pieces partition the normalised bytes, so the alignment projects each piece to
a span of source bytes.  The segmentation itself is the sentencepiece library's.

Segmenting whole texts repeats the same words over and over.  When the model is
such that no merge can cross a word start (``_splits_at_spaces``), a text falls
apart at its single spaces and each distinct chunk is segmented once per worker;
the spans are projected through the whole text's alignment all the same;
other texts (leading, trailing, double or literal-marker spaces) and other
models go through the library whole.  Both ways give the library's ids.

Defined cases: a null text is encoded as the empty text (the end id alone, when
asked for); repeated rows give repeated results; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Distinct chunks remembered by a Python worker before its cache starts anew.
CACHED_CHUNKS = 400_000

OUTPUTS = {
    "n_tokens": ("long", pa.int64()),
    "ids": ("array<int>", pa.list_(pa.int32())),
    "starts": ("array<int>", pa.list_(pa.int32())),
    "ends": ("array<int>", pa.list_(pa.int32())),
    "decoded": ("string", pa.string()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
    "spans_crc32": ("long", pa.int64()),
}


class CharacterMap:
    """Longest-prefix rewriting through a compiled map: a double-array trie and its replacement strings."""

    def __init__(self, compiled: bytes):
        n = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + n], dtype="<u4").tolist()
        self.strings = compiled[4 + n :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest rule that matches at ``at``, and its replacement."""
        if not self.units:
            return None
        found, units = None, self.units

        def child(unit: int) -> int:
            return (unit >> 10) << ((unit & 512) >> 6)

        node = child(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= child(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.strings.index(b"\0", found[1])
        return found[0], self.strings[found[1] : end]


class Normalizer:
    """A model's normalisation with source alignment."""

    def __init__(self, compiled: bytes, dummy_prefix: bool, trim: bool, escape: bool):
        self.map, self.dummy_prefix, self.trim = CharacterMap(compiled), dummy_prefix, trim
        self.space = SPACE.encode() if escape else b" "

    @classmethod
    def of(cls, spec) -> Normalizer:
        return cls(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)

    def _steps(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(source offset, source length, replacement) of each rewriting step."""
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit is None:
                lead = data[at]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = n, data[at : at + n]
            yield at, *hit
            at += hit[0]

    @property
    def plain(self) -> bool:
        """Whether all that it does is to write a marker before the text and for each space."""
        return not self.map.units and not self.trim and self.dummy_prefix

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """What the steps give where no rule of the map can match: every byte stands for itself, a space for a marker."""
        n = len(self.space)
        sizes = np.ones(len(data) + 1, dtype=np.int64)
        letters = np.frombuffer(data, dtype=np.uint8)
        sizes[:-1][letters == 0x20] = n
        return self.space + data.replace(b" ", self.space), np.concatenate([np.zeros(n, dtype=np.int64), np.repeat(np.arange(len(data) + 1), sizes)])

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) the source offset."""
        if data and self.plain:
            return self._plain(data)
        return self._stepped(data)

    def _stepped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """One longest-prefix look-up after another."""
        steps = list(self._steps(data))
        end = len(data)
        if self.trim:
            while steps and steps[0][2] == b" ":
                steps.pop(0)
            first = steps[0][0] if steps else 0
        else:
            first = 0
        if not steps:
            return b"", np.array([end if self.trim else 0], dtype=np.int64)
        out, source = bytearray(), []

        def put(chunk: bytes, offset: int, as_it_is: bool = False) -> None:
            out.extend(chunk)
            source.extend(range(offset, offset + len(chunk)) if as_it_is else [offset] * len(chunk))

        if self.dummy_prefix:
            put(self.space, first)
        after_space = self.trim
        for offset, size, chunk in steps:
            if after_space:
                chunk = chunk.lstrip(b" ")
            if chunk:
                put(chunk.replace(b" ", self.space), offset, chunk != b" " and data[offset : offset + size] == chunk)
                after_space = self.trim and chunk.endswith(b" ")
        if self.trim:
            while out.endswith(self.space) and len(out) >= len(self.space):
                del out[-len(self.space) :]
                end = source[-len(self.space)]
                del source[-len(self.space) :]
        return bytes(out), np.array([*source, end], dtype=np.int64)


class Codec:
    """One model in one process."""

    def __init__(self, model_path: str, add_eos: bool = True):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            proto.ParseFromString(f.read())
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.normalizer = Normalizer.of(proto.normalizer_spec)
        self.tail = [self.sp.eos_id()] if add_eos else []
        self.by_chunk = self._splits_at_spaces(proto)
        self.lengths = [1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces]
        self.cache: dict[str, tuple] = {}

    @staticmethod
    def _splits_at_spaces(proto) -> bool:
        """No charmap, a marker for each space and none for another, and no piece with a marker after another character."""
        spec = proto.normalizer_spec
        return (
            not spec.precompiled_charsmap
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and proto.trainer_spec.model_type == 2
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and proto.trainer_spec.byte_fallback
            and not any(p.type == 4 or re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in proto.pieces)
        )

    def _segment(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids, and the spans of source bytes that the alignment projects them to."""
        pieces = self.sp.encode(text, out_type=str, add_eos=False)
        ids = self.sp.encode(text, out_type=int, add_eos=False)
        sizes = [1 if len(p) == 6 and p.startswith("<0x") and self.sp.is_byte(i) else len(p.encode()) for p, i in zip(pieces, ids, strict=True)]
        return ids, *self._projected(text.encode(), np.array(sizes, dtype=np.int64))

    def learn(self, chunks: set[str]) -> None:
        """Remember what a text needs of each chunk that follows a space: ids as text and packed, packed normalised lengths, surface."""
        if len(self.cache) + len(chunks - self.cache.keys()) > CACHED_CHUNKS:
            self.cache.clear()
        chunks -= self.cache.keys()
        new, length, cache = list(chunks), self.lengths, self.cache
        for chunk, ids, surface in zip(new, found := self.sp.encode(new, out_type=int, num_threads=1), self.sp.decode(found), strict=True):
            sizes = [length[i] for i in ids]
            cache[chunk] = " ".join(map(str, ids)), array("i", ids).tobytes(), array("I", sizes).tobytes(), surface

    def encode_all(self, texts: list[str | None]) -> list[dict]:
        """ids as text and packed, spans, and the decoded text, of each text."""
        texts = [t or "" for t in texts]
        chunks = [t.split(" ") if self.by_chunk and t and SPACE not in t and "  " not in t and t[0] != " " and t[-1] != " " else None for t in texts]
        self.learn({c for own in chunks if own for c in own})
        return [self._of_chunks(t, own) if own else self._of_whole(t) for t, own in zip(texts, chunks, strict=True)]

    def _of_chunks(self, text: str, chunks: list[str]) -> dict:
        parts = [self.cache[c] for c in chunks]
        starts, ends = self._projected(text.encode(), np.frombuffer(b"".join([p[2] for p in parts]), dtype="<u4"))
        return self._with_tail(text, " ".join([p[0] for p in parts]), b"".join([p[1] for p in parts]), starts, ends, " ".join([p[3] for p in parts]))

    def _projected(self, data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source spans of pieces that partition the normalised bytes, by the normaliser's alignment."""
        normalised, source = self.normalizer(data)
        at = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=at[1:])
        if at[-1] != len(normalised):
            raise ValueError("the pieces don't spell the normalised text")
        return source[at[:-1]], source[at[1:]]

    def _of_whole(self, text: str) -> dict:
        ids, starts, ends = self._segment(text)
        return self._with_tail(text, " ".join(map(str, ids)), array("i", ids).tobytes(), starts, ends, self.sp.decode([*ids, *self.tail]))

    def _with_tail(self, text: str, said: str, packed: bytes, starts: np.ndarray, ends: np.ndarray, decoded: str) -> dict:
        if self.tail:
            whole = len(text.encode())
            said = f"{said} {self.tail[0]}" if said else str(self.tail[0])
            packed += array("i", self.tail).tobytes()
            starts, ends = np.append(starts, whole), np.append(ends, whole)
        return {"ids_text": said, "packed": packed, "starts": starts, "ends": ends, "decoded": decoded}

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


_codecs: dict[tuple, Codec] = {}


def codec(model_path: str, add_eos: bool = True) -> Codec:
    """This process's codec of a model."""
    key = (model_path, add_eos)
    if key not in _codecs:
        _codecs[key] = Codec(model_path, add_eos)
    return _codecs[key]


def _values(found: dict, name: str):
    if name == "n_tokens":
        return len(found["packed"]) // 4
    if name == "ids":
        return np.frombuffer(found["packed"], dtype="<i4")
    if name in ("starts", "ends"):
        return found[name].astype(np.int32)
    if name == "decoded":
        return found["decoded"]
    if name == "ids_sha256":
        return hashlib.sha256(found["ids_text"].encode()).hexdigest()
    if name == "decoded_sha256":
        return hashlib.sha256(found["decoded"].encode()).hexdigest()
    return zlib.crc32(np.concatenate([found["starts"], found["ends"]]).astype("<u4").tobytes())


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", add_eos: bool = True, outputs: tuple[str, ...] = ("ids", "starts", "ends")) -> DataFrame:
    """Encode every whole text; ``outputs`` names columns of ``OUTPUTS``.

    ``starts`` and ``ends`` are byte offsets into the source text; ``decoded`` is
    decode(ids); ``ids_sha256`` digests the decimal ids joined by one space and
    ``spans_crc32`` the unsigned 32-bit starts followed by the ends.
    """
    source = df.select(id_col, text_col)
    arrow_id = pa.int64()
    schema = pa.schema([pa.field(id_col, arrow_id), *[pa.field(k, OUTPUTS[k][1]) for k in outputs]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, add_eos)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = own.encode_all(part.column(1).to_pylist())
                columns = [part.column(0).cast(arrow_id)]
                columns += [pa.array([_values(x, k) for x in found], type=OUTPUTS[k][1]) for k in outputs]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return source.mapInArrow(work, f"`{id_col}` long, " + ", ".join(f"{k} {OUTPUTS[k][0]}" for k in outputs))


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """decode(ids) of every row; null ids decode to the empty text."""
    schema = pa.schema([pa.field(id_col, pa.int64()), pa.field("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            texts = [own.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], schema=schema)

    return df.select(id_col, ids_col).mapInArrow(work, f"`{id_col}` long, text string")

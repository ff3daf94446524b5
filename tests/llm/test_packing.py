import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folio.llm import packing as K

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, "a", "Hello  world.\n\n 123 it's", "word " * 2500, "x" * 5000, "日本語 🎉 é <|endoftext|>", "a", "a"]


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=60, deadline=None)
def test_places_are_gapless(lengths):
    lengths = np.array(sorted(lengths, reverse=True), dtype=np.int64)
    sequence, offset = K.sum_of_squares(lengths, 64)
    filled = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist())):
        assert filled.get(s, 0) == o
        filled[s] = o + n
    assert all(v <= 64 for v in filled.values())
    assert len(filled) >= -(-lengths.sum() // 64)


def test_few_sequences():
    lengths = np.sort(np.random.default_rng(1).integers(20, 500, 4000))[::-1]
    sequence, _ = K.sum_of_squares(lengths, 1024)
    assert sequence.max() + 1 <= 1.01 * -(-lengths.sum() // 1024) + 2


def test_smallest_sum_of_squares_brute_force():
    lengths = np.sort(np.random.default_rng(2).integers(1, 33, 300))[::-1]
    sequence, _ = K.sum_of_squares(lengths, 32)
    gaps: list[int] = []
    for s, n in zip(sequence.tolist(), lengths.tolist()):
        def cost(k, n=n):
            after = [g - n * (i == k) for i, g in enumerate(gaps)]
            return sum(after.count(g) ** 2 for g in range(1, 32))
        room = [k for k, g in enumerate(gaps) if g >= n]
        if s == len(gaps):
            assert not room
            gaps.append(32 - n)
        else:
            assert cost(s) == min(cost(k) for k in room)
            gaps[s] -= n


def test_pack(spark):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, length int")
    rows = K.pack(df, PATH, group=4, with_ids=True).collect()
    places = {}
    for i, t in enumerate(TEXTS):
        ids = own.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert [x for r in mine for x in r.ids] == ids
        assert all(r.length == len(r.ids) == 1024 for r in mine[1:])
        assert len(mine) == -(-len(ids) // 1024)
        at = 0
        for r in mine:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            at += r.length
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own_places in places.values():
        at = 0
        for o, n in sorted(own_places):
            assert o == at
            at += n
        assert at <= 1024


def test_empty_table(spark):
    assert K.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_special_tokens_as_the_library_reads_them(spark):
    own = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "plain", "<|endoftext", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in K.pack(df, PATH, with_ids=True, special=True).collect():
        assert list(r.ids) == own.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
    assert own.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]


def test_repeated_and_null_ids_spread(spark):
    rows = [(None, f"text {i}", "x") for i in range(200)] + [(7, "same", None)] * 200 + [(8, f"other {i}", "y") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, deal string").coalesce(1)
    found = K.pack(df, PATH, group=30).collect()
    assert len(found) == 600
    for ids in (None, 7, 8):
        groups = [r.sequence_id >> 32 for r in found if r.doc_id == ids]
        assert len(groups) == 200 and max(map(groups.count, groups)) < 40
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]

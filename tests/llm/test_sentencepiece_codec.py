import hashlib

import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from folio.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "a", "The quick brown fox.", " lead", "trail ", "a  b", "tab\tand\nline\n\nend", "x▁y", "naïve 日本語 🎉🎉 é", "\x00nul", "word " * 3000 + "end", "</s> <s> <unk> <0x41>"]


def test_same_as_library_and_spans(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, "", "again")], "doc_id long, text string, ids string")
    rows = S.encode(df, PATH, outputs=("n_tokens", "ids", "starts", "ends", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[r.doc_id] or ""
        ids = sp.encode(text, add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == sp.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
        data = text.encode()
        assert b"".join(data[a:b] for a, b in zip(r.starts, r.ends)) == data  # the spans tile the source
        pieces = sp.encode(text, return_type="proto").pieces
        assert [data[a:b].decode("utf-8", "replace") for a, b, p in zip(r.starts, r.ends, pieces) if not p.piece.startswith("<0x")] == [p.surface for p in pieces if not p.piece.startswith("<0x")]
    back = {r.doc_id: r.text for r in S.decode(spark.createDataFrame([(r.doc_id, r.ids) for r in rows], "doc_id long, ids array<int>"), PATH).collect()}
    assert all(back[r.doc_id] == r.decoded for r in rows)


def test_normalisation_by_character_map():
    own = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(own.serialized_model_proto())
    normal = S.Normalizer.of(proto.normalizer_spec)
    for text in ["Ａ①  ｶﾞ x ", "ﬁn ½", "", "   ", "é   z", "plain", "　全角　ＡＢＣ​."]:
        want, _ = own.normalize(text, with_offsets=True)
        got, source = normal(text.encode())
        assert got.decode() == want
        assert len(source) == len(got) + 1 and all(a <= b for a, b in zip(source, source[1:]))
    got, source = normal("Ａ①".encode())
    assert got.decode() == S.SPACE + "A1" and list(source) == [0, 0, 0, 0, 3, 6]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.encode(empty, PATH).collect() == []


def test_plain_alignment_is_that_of_the_steps():
    codec = S.Codec(PATH)
    assert codec.by_chunk and codec.normalizer.plain
    for text in TEXTS:
        data = (text or "").encode()
        if not data:
            continue
        got, source = codec.normalizer(data)
        want, stepped = codec.normalizer._stepped(data)
        assert got == want and source.tolist() == stepped.tolist(), text


def test_spans_come_through_the_alignment(monkeypatch):
    codec = S.Codec(PATH)
    texts = ["The quick brown fox 🎉 naïve", " two  spaces"]
    before = [(r["starts"].tolist(), r["ends"].tolist()) for r in codec.encode_all(texts)]
    normal = S.Normalizer.__call__
    monkeypatch.setattr(S.Normalizer, "__call__", lambda self, data: (normal(self, data)[0], normal(self, data)[1] * 0))
    after = [(r["starts"].tolist(), r["ends"].tolist()) for r in codec.encode_all(texts)]
    assert all(a != b and not any(a[0][:-1]) for a, b in zip(after, before))


def test_null_ids_and_clashing_names(spark):
    df = spark.createDataFrame([(None, "a b", "z"), (None, None, "z"), (3, "a b", None)], "doc_id long, text string, n_tokens string")
    rows = S.encode(df, PATH, outputs=("n_tokens",)).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == [("3", 3), ("None", 1), ("None", 3)]

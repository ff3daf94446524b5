import random

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from folio.llm import quality_rules, simhash, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)

    def word():
        return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))

    def prose(n):
        return " ".join(word() for _ in range(n))

    shared = prose(70)
    rows = []
    for i in range(400):
        text = prose(rng.randint(60, 160))
        if i % 8 == 0:
            text += " nasty " + prose(5) + " vilest scummy " + prose(5)
        if i % 50 == 1:
            text = " ".join(w + "%%%" for w in text.split())
        if i in (10, 11):
            text = prose(80) + " " + shared + " " + prose(60)
        if i in (13, 14):
            text = rows[12][1]
        rows.append((i, text, "en", "src", len(text)))
    rows += [(9001, None, None, None, None), (9002, "", "en", "src", 0), (9003, "é" * 30, None, "src", 30)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 50 != 1), int(i % 8 == 0)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert len(C.STAGES) == 5
    left = {r[0]: r[1] for r in rows}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == C.COLUMNS, name
        got = {r.doc_id: r for r in out.collect()}
        if name == "toxicity":
            assert not [i for i in got if i < 400 and i % 8 == 0]
            assert set(got) == {i for i in left if i >= 400 or i % 8}
        elif name == "quality_rules":
            assert set(got) == {i for i in left if i < 400 and i % 50 != 1}
        elif name == "simhash_near_dedup":
            assert 12 in got and 13 not in got and 14 not in got
        else:
            a, b = got[10].text, got[11].text
            assert len(a) < len(left[10]) and len(b) < len(left[11])
            windows = [r.text.encode()[i : i + 200] for r in got.values() for i in range(len(r.text.encode()) - 199)]
            assert len(windows) == len(set(windows))
            assert all(r.n_chars == len(r.text) for r in got.values())
        left = {i: r.text for i, r in got.items()}
        docs = spark.createDataFrame(out.collect(), SCHEMA)
    pieces = C.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in pieces} == set(left)


def test_run(spark, folder):
    path, _ = folder
    out = C.run(spark, path)
    assert out.count() > 300 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_filters_keep_rows_as_they_are(spark):
    rows = [(1, "x " * 10, "k"), (1, "x " * 10, "k"), (None, None, "n"), (2, "z" * 450, "m"), (None, "z" * 450, "o")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string")
    assert sorted(map(str, toxicity.without_toxic(df, toxicity.Model()).collect())) == sorted(map(str, df.collect()))
    assert quality_rules.keep(df, spark.createDataFrame([], "doc_id long, quality int")).columns == df.columns
    got = {(r.doc_id, r.key): r.text for r in suffix_dedup.without_repeats(df).collect()}
    assert got == {(1, "k"): "x " * 10, (None, "n"): None, (2, "m"): "", (None, "o"): ""}
    one = simhash.representatives(df).collect()
    assert sorted(str(r.doc_id) for r in one) == ["1", "2", "None"]
    assert simhash.representatives(df.limit(0)).collect() == []
    assert suffix_dedup.without_repeats(df.filter(F.lit(False))).collect() == []


def test_empty_tables_and_extra_columns(spark, tmp_path, folder):
    path, rows = folder
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert C.run(spark, f"{tmp_path}/none").collect() == []
    # all go: a corpus of short texts only
    docs.limit(3).withColumn("text", F.lit("short")).write.parquet(f"{tmp_path}/short/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/short/labels.parquet")
    assert C.run(spark, f"{tmp_path}/short").collect() == []
    # columns whose names the operators use themselves
    names = ["key", "tag", "content", "score", "words", "fp", "deal", "h", "y", "kept", "row_id", "length"]
    clash = docs.limit(40).withColumns({n: F.lit("x") for n in names})
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, clash, path).columns == C.COLUMNS, name
    assert {r.doc_id for r in C.STAGES[-1][1](spark, clash, path).collect()} == {r[0] for r in rows[:40]}


def test_repeated_and_null_ids_in_every_stage(spark, folder):
    path, rows = folder
    texts = [r[1] for r in rows if r[0] % 8 and r[0] % 50 != 1 and r[0] < 60 and r[0] not in (13, 14)]
    own = [(None if i % 3 == 0 else 5000 + i // 2, t, "en", "src", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(own, SCHEMA)
    for name, stage in C.STAGES[:-1]:
        got = sorted(r.text for r in stage(spark, docs, path).collect())
        assert len(got) == len(texts), name
        if name != "suffix_array_dedup":
            assert got == sorted(texts), name
    pieces = C.STAGES[-1][1](spark, docs, path).collect()
    assert sum(r.piece == 0 for r in pieces) == len(texts)

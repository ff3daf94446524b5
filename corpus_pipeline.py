"""A corpus pipeline: each stage works on the documents that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next one's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import checkpoint_folder, fold, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject; labels teach as in its query.

    Null and empty texts have no toxic passage and stay; rows that repeat an id or
    a text are judged each for itself; an empty table gives an empty result.
    """
    from folio.llm.toxicity import fit, without_toxic

    model = fit(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    return without_toxic(docs, model).select(*COLUMNS)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts (under 50 words) go; ties with the threshold stay;
    repeated rows fare alike; an empty table gives an empty result.
    """
    from folio.llm.quality_rules import keep

    return keep(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one of the smallest id, then of the smallest row hash.

    Texts without a word make one group; rows that repeat an id but not a text
    stand for themselves; an empty table gives an empty result.
    """
    from folio.llm.simhash import representatives

    return representatives(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat; n_chars follows.

    Every row stays, with an empty text if all of it repeats; null texts stay null;
    an empty table gives an empty result.
    """
    from folio.llm.suffix_dedup import without_repeats

    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences; null texts are packed as empty ones."""
    from folio.llm import packing

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), special=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what they write goes to the shared checkpoint folder.

    A stage's folder is removed once the next one is written; the last one stays,
    since the result is read from it.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained scores, hashes and tokens are not SQL; the stages are tested against brute force.
ORACLE_SQL = None

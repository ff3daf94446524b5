"""The registered queries of the training-data operators; DuckDB twins are in sql.py."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import fold, table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.sentencepiece_codec import encode

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), outputs=("n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.html_extraction import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.language_id import fit, predict

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, docs.filter(fold("doc_id", 4) != 2))
    return predict(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.suffix_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.embedding_dedup import groups

    return groups(table(spark, sf_dir, "embeddings"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.simhash import groups

    return groups(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.quality_classifier import fit, score

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1))
    return score(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    return score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", F.size("starts").alias("n_passages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folio.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_sentencepiece, op2_html_extraction, op3_language_id, op4_suffix_dedup, op5_embedding_dedup, op6_quality_rules, op7_simhash, op8_quality_classifier, op9_toxicity, op10_packing)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from folio.llm import sql

    return sql.oracle_sql()

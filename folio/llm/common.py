"""What the training-data operators share: tables, checkpoints, fixed hash folds."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset, a temporary folder on a local master, and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="folio-checkpoint-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, its lineage cut."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the driver forget what nothing refers to any more: shuffles that a checkpoint has replaced are then removed from the executors' disks."""
    gc.collect()
    spark._jvm.System.gc()


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: the split that the held-out contracts name."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(n)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sampled(docs: DataFrame, chosen: DataFrame, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``rows`` of the ``chosen`` ids (those of smallest hash; other columns stay) with their texts, written once.

    The broadcast side holds ``rows`` rows at most.  An id that ``chosen`` repeats
    counts once, with its largest values; ids that ``docs`` repeats give a row each.
    """
    others = [F.max(c).alias(c) for c in chosen.columns if c != id_col]
    named = chosen.filter(F.col(id_col).isNotNull()).select(*chosen.columns)
    named = named.groupBy(id_col).agg(*others) if others else named.distinct()
    few = named.orderBy(F.xxhash64(id_col), id_col).limit(rows)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return checkpointed(texts.join(F.broadcast(few), id_col))

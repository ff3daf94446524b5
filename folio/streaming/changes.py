"""A stream of partial updates applied to a stored collection, a micro-batch at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from folio.operators.writes import update
from folio.sources.store import ParquetStore


def apply_updates(store: ParquetStore, name: str, stream: DataFrame, fields: Sequence[str], version: str) -> DataStreamWriter:
    """Of a batch's updates of one key the one with the highest ``version`` counts; start the writer to run.

    Where the collection stores the version itself, an update that isn't newer
    than what is stored is dropped, so late ones and a batch that runs again
    change nothing.  A batch without an update that counts writes nothing.  Of a
    collection kept in folders, those that hold the batch's keys are read and
    rewritten; of any other, all.
    """
    key = store.model[name].key

    def merge(batch: DataFrame, _: int) -> None:
        parts = store.parts_of(name, batch)
        base = store.frame(store.model[name].table or name, parts)
        fresh = batch.join(base.select(F.col(f"`{key}`"), F.col(version).alias("__stored")), key) if version in base.columns else batch.withColumn("__stored", F.lit(None))
        fresh = fresh.filter(F.col("__stored").isNull() | (F.col(version) > F.col("__stored"))).drop("__stored")
        last = fresh.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(version).desc()))).filter("__n = 1")
        own = [*fields, *([version] if version in base.columns and version not in fields else [])]
        if not last.isEmpty():
            store.replace(name, update(base, last, key, own), parts)  # type: ignore[arg-type]

    return stream.writeStream.foreachBatch(merge)

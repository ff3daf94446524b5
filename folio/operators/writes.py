"""Writes as DataFrame to DataFrame transforms: the state before in, the state after out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.errors import ModelError
from folio.model import Model

CREATED, UPDATED = "_created_at", "_updated_at"
#: Fixed value: the letters of generated ids.
ID_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ID_LENGTH = 20


def generated_id(*seed: Column) -> Column:
    """Twenty letters that follow from the seed, so that a repeated task makes the same id."""
    digest = F.sha2(F.concat_ws("\x1f", *[c.cast("string") for c in seed]), 512)
    letters = [F.substring(F.lit(ID_LETTERS), F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int") % len(ID_LETTERS) + 1, F.lit(1)) for i in range(ID_LENGTH)]
    return F.concat(*letters)


def without_null_elements(df: DataFrame) -> DataFrame:
    """Arrays are stored without null elements."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.filter(c, lambda x: x.isNotNull()) for c in arrays}) if arrays else df


def insert(base: DataFrame, rows: DataFrame, key: str, at: Column) -> DataFrame:
    """``base`` and the new rows, with audit columns; a null key is generated from the row."""
    rows = without_null_elements(rows)
    if isinstance(rows.schema[key].dataType, T.StringType):
        rows = rows.withColumn(key, F.coalesce(F.col(key), generated_id(F.to_json(F.struct("*")))))
    rows = rows.withColumns({CREATED: at, UPDATED: at})
    return base.unionByName(rows, allowMissingColumns=True)


def _set(value: Column, kind: T.DataType, steps: list[str], new: Column) -> Column:
    """``value`` with the field that the steps lead to set; a struct that is null on the way is made, its other fields null."""
    if not steps:
        return new.cast(kind)
    if not isinstance(kind, T.StructType) or steps[0] not in kind.names:
        raise ModelError(f"there is no field {steps[0]}")
    fields = [(_set(value[f.name], f.dataType, steps[1:], new) if f.name == steps[0] else value[f.name]).alias(f.name) for f in kind.fields]
    return F.struct(*fields)


def _cleared(value: Column, kind: T.DataType, steps: list[str]) -> Column:
    """``value`` without the field; a struct that is null on the way stays null."""
    if not steps:
        return F.lit(None).cast(kind)
    if not isinstance(kind, T.StructType) or steps[0] not in kind.names:
        raise ModelError(f"there is no field {steps[0]}")
    return F.when(value.isNotNull(), value.withField(steps[0], _cleared(value[steps[0]], kind[steps[0]].dataType, steps[1:])))


def update(base: DataFrame, changes: DataFrame, key: str, fields: Sequence[str], clear: Sequence[str] = (), at: Column | None = None) -> DataFrame:
    """Rows of ``base`` that ``changes`` has a row for get its ``fields`` (columns named by the path, dots as __) and lose ``clear``.

    Other fields stay as they are; a field set inside a struct that is null makes
    the struct.  A key that ``changes`` repeats fails when the result is read.
    """
    columns = base.columns
    named = changes.select(F.col(key).alias("__key"), *[F.col(f.replace(".", "__")).alias(f"__new_{i}") for i, f in enumerate(fields)])
    news = [F.first(f"__new_{i}").alias(f"__new_{i}") for i in range(len(fields))]
    named = named.filter("__key is not null").groupBy("__key").agg(F.count("*").alias("__times"), *news)
    repeated = F.raise_error(F.concat(F.lit("two changes of the key "), F.col("__key").cast("string"))).cast("boolean")
    named = named.withColumn("__hit", F.when(F.col("__times") > 1, repeated).otherwise(F.lit(True)))
    out = base.join(named, base[key] == named["__key"], "left")
    for i, path in enumerate(fields):
        top, *steps = path.split(".")
        value = _set(F.col(f"`{top}`"), base.schema[top].dataType, steps, F.col(f"__new_{i}"))
        out = out.withColumn(top, F.when(F.col("__hit"), value).otherwise(F.col(f"`{top}`")))
    for path in clear:
        top, *steps = path.split(".")
        value = _cleared(F.col(f"`{top}`"), base.schema[top].dataType, steps)
        out = out.withColumn(top, F.when(F.col("__hit"), value).otherwise(F.col(f"`{top}`")))
    if at is not None and UPDATED in columns:
        out = out.withColumn(UPDATED, F.when(F.col("__hit"), at).otherwise(F.col(UPDATED)))
    return out.select(*[F.col(f"`{c}`") for c in columns])


def set_reference(base: DataFrame, changes: DataFrame, key: str, fk: str) -> DataFrame:
    """References moved; a null in ``changes`` clears."""
    return update(base, changes, key, [fk])


def array_changed(array: Column, removed: Column, added: Column) -> Column:
    """The removed elements out, then those of the added that aren't there yet at the end; none left is no array."""
    kept = F.filter(F.coalesce(array, F.array()), lambda x: ~F.array_contains(removed, x))
    out = F.concat(kept, F.array_except(added, kept))
    return F.when(F.size(out) > 0, out)


def map_changed(entries: Column, removed: Column, put: Column) -> Column:
    """Keys removed, keys put; none left is no map."""
    kept = F.map_filter(entries, lambda k, _: ~F.array_contains(removed, k) & ~F.array_contains(F.map_keys(put), k))
    out = F.map_concat(F.coalesce(kept, F.map_filter(put, lambda k, _: F.lit(False))), put)
    return F.when(F.size(out) > 0, out)


def changes(before: DataFrame, after: DataFrame, key: str, columns: Iterable[str] | None = None) -> DataFrame:
    """key, change (added, removed, modified) and the names of the columns that differ.

    Sent are digests: of a scalar's text, of anything else's JSON.
    """
    own = [c for c in (columns or before.columns) if c != key]

    def digest(df: DataFrame, c: str) -> Column:
        nested = isinstance(df.schema[c].dataType, T.ArrayType | T.StructType | T.MapType)
        return F.unhex(F.md5((F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) if nested else F.col(f"`{c}`").cast("string")).cast("binary")))

    def shot(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.col(key).alias(f"{side}_key"), *[digest(df, c).alias(f"{side}_{i}") for i, c in enumerate(own)])

    both = shot(before, "b").join(shot(after, "a"), F.col("b_key") == F.col("a_key"), "full_outer")
    differing = F.array_compact(F.array(*[F.when(~F.col(f"b_{i}").eqNullSafe(F.col(f"a_{i}")), F.lit(c)) for i, c in enumerate(own)]))
    kind = F.when(F.col("b_key").isNull(), "added").when(F.col("a_key").isNull(), "removed").when(F.size(differing) > 0, "modified")
    return both.select(F.coalesce("b_key", "a_key").alias(key), kind.alias("change"), F.when(kind == "modified", differing).alias("columns")).filter("change is not null")


def delete(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``base`` without the documents whose key ``keys`` holds in its first column."""
    gone = keys.select(F.col(f"`{keys.columns[0]}`").alias("__gone")).filter("__gone is not null")
    return base.join(gone, base[key] == gone["__gone"], "left_anti")


def delete_cascade(model: Model, frames: Callable[[str], DataFrame], name: str, keys: DataFrame) -> dict[str, DataFrame]:
    """Collections after the documents and everything below them are gone; deepest first."""
    out: dict[str, DataFrame] = {}

    def below(collection_name: str, gone: DataFrame) -> None:
        collection = model[collection_name]
        for link in collection.children:
            child = model[link.child]
            df = out.get(child.name, frames(child.table or child.name))
            lost = gone.withColumnRenamed(gone.columns[0], "__parent")
            if child.key and child.children:
                below(child.name, df.join(lost, df[link.parent_key] == lost["__parent"], "left_semi").select(child.key))
            out[child.name] = df.join(lost, df[link.parent_key] == lost["__parent"], "left_anti")
        if collection.key is None:
            raise ModelError(f"{collection_name} has no key to delete by")

    below(name, keys.select(F.col(f"`{keys.columns[0]}`")))
    collection = model[name]
    out[name] = delete(frames(collection.table or name), keys, collection.key)  # type: ignore[arg-type]
    return out


def write_order(model: Model) -> list[str]:
    """Collections, parents before children: inserts go in this order, deletes in the reverse."""
    depth: dict[str, int] = {}

    def visit(name: str, at: int, path: tuple[str, ...]) -> None:
        if name in path:
            return
        depth[name] = max(depth.get(name, 0), at)
        for link in model[name].children:
            visit(link.child, at + 1, (*path, name))

    for name in model.collections:
        visit(name, 0, ())
    return sorted(depth, key=lambda n: (depth[n], n))

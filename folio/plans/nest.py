"""Children nested into their parents, per-parent bands and aggregates, and look-ups through arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK, ITEM, LOOKUP = "__rank", "__item", "__lookup"


def band(df: DataFrame, parent: str, order: Sequence[Column], skip: int = 0, take: int | None = None) -> DataFrame:
    """Rows ranked within their parent; only ranks in (skip, skip + take] stay, which Spark limits before the shuffle."""
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(parent).orderBy(*order)))
    if take is not None:
        ranked = ranked.filter(F.col(RANK) <= skip + take)
    return ranked.filter(F.col(RANK) > skip) if skip else ranked


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, T.MapType | T.VariantType)


def nested(children: DataFrame, parent: str, item: Column, name: str, order: Sequence[tuple[Column, bool]]) -> DataFrame:
    """One row for each parent: an array of its items, sorted by ``order`` (columns, and whether they descend) where there is one.

    The items are sorted as they are gathered, in the one aggregate; nulls among them are left out.
    """
    ranks = [F.struct(*[c.alias(f"o{i}") for i, (c, _) in enumerate(order)]).alias("r")] if order else []
    rows = children.select(F.col(parent).alias(parent), F.struct(*ranks, item.alias("v")).alias(ITEM)).filter(F.col(f"{ITEM}.v").isNotNull())
    listed = F.collect_list(ITEM)
    if order:
        kinds = rows.schema[ITEM].dataType["r"].dataType.fields  # type: ignore[index]
        if not any(desc for _, desc in order) and _orderable(rows.schema[ITEM].dataType):
            listed = F.sort_array(listed)
        else:
            listed = F.array_sort(listed, lambda a, b: _compared([(a["r"][f.name], b["r"][f.name], desc) for f, (_, desc) in zip(kinds, order, strict=True)]))
    return rows.groupBy(parent).agg(F.transform(listed, lambda x: x["v"]).alias(name))


def _compared(sides: list[tuple[Column, Column, bool]]) -> Column:
    out = F.lit(0)
    for a, b, desc in reversed(sides):
        out = F.when(a < b, F.lit(1 if desc else -1)).when(a > b, F.lit(-1 if desc else 1)).otherwise(out)
    return out


def attach(parents: DataFrame, key: str, side: DataFrame, side_key: str, name: str, empty: Column) -> DataFrame:
    """``parents`` with column ``name`` of ``side``, and ``empty`` where it has no row."""
    renamed = side.select(F.col(side_key).alias("__parent"), F.col(name).alias("__value"))
    joined = parents.join(renamed, parents[key] == renamed["__parent"], "left")
    return joined.withColumn(name, F.coalesce(F.col("__value"), empty.cast(renamed.schema["__value"].dataType))).drop("__parent", "__value")


def include_array(df: DataFrame, key: str, path: str, fk: str | None, name: str, target: DataFrame, target_key: str) -> DataFrame:
    """References below an array replaced or completed by their documents.

    ``path`` leads through arrays of structs to the array whose elements refer:
    themselves (``fk`` None; dangling ones drop, order stays) or by their field
    ``fk``, whose document then is their field ``name``.  The keys of a row are
    exploded, looked up by one join, and come back as the row's own map.
    """
    steps = path.split(".")

    def keys(value: Column, kind: T.DataType, rest: list[str]) -> Column:
        if isinstance(kind, T.ArrayType):
            if not rest:
                return F.transform(value, lambda e: e if fk is None else e[fk])
            return F.flatten(F.transform(value, lambda e: F.coalesce(keys(e, kind.elementType, rest), F.array())))
        return keys(value[rest[0]], kind[rest[0]].dataType, rest[1:])  # type: ignore[index]

    def filled(value: Column, kind: T.DataType, rest: list[str], found: Column) -> Column:
        if isinstance(kind, T.ArrayType):
            if not rest and fk is None:
                return F.filter(F.transform(value, lambda e: found[e]), lambda e: e.isNotNull())
            if not rest:
                return F.transform(value, lambda e: e.withField(name, found[e[fk]]))
            return F.transform(value, lambda e: filled(e, kind.elementType, rest, found))
        return value.withField(rest[0], filled(value[rest[0]], kind[rest[0]].dataType, rest[1:], found))  # type: ignore[index]

    top, kind = steps[0], df.schema[steps[0]].dataType
    asked = df.select(F.col(key).alias("__owner"), F.explode(F.array_distinct(keys(F.col(top), kind, steps[1:]))).alias("__key"))
    documents = target.select(F.col(target_key).alias("__target"), F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("__document"))
    met = asked.join(documents, asked["__key"] == documents["__target"])
    maps = met.groupBy("__owner").agg(F.map_from_entries(F.collect_list(F.struct("__target", "__document"))).alias(LOOKUP))
    none = F.create_map().cast(maps.schema[LOOKUP].dataType)
    joined = df.join(maps, df[key] == maps["__owner"], "left").withColumn(LOOKUP, F.coalesce(F.col(LOOKUP), none))
    return joined.withColumn(top, filled(F.col(top), kind, steps[1:], F.col(LOOKUP))).drop("__owner", LOOKUP)

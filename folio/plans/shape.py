"""What declarations of points, arrays and maps make of a stored table: fields ignored, points in one form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.errors import ModelError
from folio.model import Collection

POINT = ("latitude", "longitude")


def _reached(value: Column, kind: T.DataType, steps: list[str], change: Callable[[Column, T.DataType], Column]) -> Column:
    """``value`` with what the steps lead to (through structs, arrays and map values) changed."""
    if isinstance(kind, T.ArrayType) and steps:
        return F.transform(value, lambda e: _reached(e, kind.elementType, steps, change))
    if isinstance(kind, T.MapType) and steps:
        return F.transform_values(value, lambda _, v: _reached(v, kind.valueType, steps, change))
    if not steps:
        return change(value, kind)
    if not isinstance(kind, T.StructType) or steps[0] not in kind.names:
        raise ModelError(f"there is no field {steps[0]}")
    inner = _reached(value[steps[0]], kind[steps[0]].dataType, steps[1:], change)
    return F.when(value.isNotNull(), value.withField(steps[0], inner))


def _without(names: tuple[str, ...]) -> Callable[[Column, T.DataType], Column]:
    def change(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.ArrayType):
            return F.transform(value, lambda e: change(e, kind.elementType))
        if isinstance(kind, T.MapType):
            return F.transform_values(value, lambda _, v: change(v, kind.valueType))
        own = [n for n in names if isinstance(kind, T.StructType) and n in kind.names]
        return value.dropFields(*own) if own else value

    return change


def _point(latitude: str, longitude: str) -> Callable[[Column, T.DataType], Column]:
    def change(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.ArrayType):
            return F.transform(value, lambda e: change(e, kind.elementType))
        if not isinstance(kind, T.StructType) or not {latitude, longitude} <= set(kind.names):
            raise ModelError(f"a point needs {latitude} and {longitude}")
        return F.when(value.isNotNull(), F.struct(value[latitude].cast("double").alias(POINT[0]), value[longitude].cast("double").alias(POINT[1])))

    return change


def shaped(collection: Collection, df: DataFrame) -> DataFrame:
    """The table as the collection declares it.

    Fields that an array's or a map's declaration ignores are left out of its
    elements.  A point is a struct of latitude and longitude, made of the stored
    struct's fields or of two columns of the table; arrays of kind geo hold such.
    """
    changes = [(a.path, _without(a.ignore)) for a in collection.arrays if a.ignore]
    changes += [(m.path, _without(m.ignore)) for m in collection.maps if m.ignore]
    changes += [(a.path, _point(*POINT)) for a in collection.arrays if a.kind == "geo"]
    for point in collection.points:
        if point.path not in df.columns and "." not in point.path and {point.latitude, point.longitude} <= set(df.columns):
            own = F.when(F.col(point.latitude).isNotNull() & F.col(point.longitude).isNotNull(), F.struct(F.col(point.latitude).cast("double").alias(POINT[0]), F.col(point.longitude).cast("double").alias(POINT[1])))
            df = df.withColumn(point.path, own).drop(point.latitude, point.longitude)
        else:
            changes.append((point.path, _point(point.latitude, point.longitude)))
    for path, change in changes:
        top, *steps = path.split(".")
        if top not in df.columns:
            raise ModelError(f"{collection.name} has no column {top}")
        df = df.withColumn(top, _reached(F.col(f"`{top}`"), df.schema[top].dataType, steps, change))
    return df

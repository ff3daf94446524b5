"""A DataFrame with the references that paths through it have joined so far."""

from __future__ import annotations

import datetime
import enum
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.errors import UnsupportedQuery
from folio.functions import predicates as P
from folio.model import Collection, Model


def typed(schema: T.StructType, path: str) -> T.DataType | None:
    """Type of a dotted path, or None."""
    kind: T.DataType | None = schema
    for name in path.split("."):
        if isinstance(kind, T.MapType):
            kind = kind.valueType
            continue
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return None
        kind = kind[name].dataType
    return kind


def literal(value: Any, kind: T.DataType | None, values: tuple[str, ...] | None = None) -> Column:
    """A value as the store keeps it: enumerations by name, ids as text, instants in the column's own type."""
    if isinstance(value, enum.Enum):
        value = value.name
    elif isinstance(value, uuid.UUID):
        value = str(value)
    elif values and isinstance(value, int) and not isinstance(value, bool):
        value = values[value]
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        value = value.astimezone(datetime.UTC).replace(tzinfo=None)
    if isinstance(value, datetime.datetime) and isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, datetime.datetime):
        return F.lit(value.isoformat(sep=" ") + "+00:00").cast("timestamp")
    return F.lit(value)


def _tests_array(p: P.Predicate) -> bool:
    if isinstance(p, P.All | P.AnyOf):
        return any(map(_tests_array, p.parts))
    return isinstance(p, P.Contains) or isinstance(p, P.Negated) and _tests_array(p.part)


class Scope:
    """Paths of one collection over one DataFrame.

    A path through a reference left-joins the target once, however often it is
    used; the outer row always stays.  Which join it becomes is Catalyst's choice
    by size.
    """

    def __init__(self, model: Model, collection: Collection, df: DataFrame, frame: Callable[[str], DataFrame], strict: bool = True):
        self.model, self.collection, self.df, self.frame, self.strict = model, collection, df, frame, strict
        self.columns = list(df.columns)
        self.joined: dict[str, tuple[Collection, dict[str, str]]] = {}

    def _join(self, path: str, owner: Collection, fk: Column, name: str) -> tuple[Collection, dict[str, str]]:
        if path not in self.joined:
            reference = owner.reference(name)
            assert reference is not None
            target = self.model[reference.target]
            other = self.frame(target.name)
            names = {c: f"__{len(self.joined)}_{path.replace('.', '_')}__{c}" for c in other.columns}
            other = other.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
            self.df = self.df.join(other, fk == other[names[target.key]], "left")  # type: ignore[index]
            self.joined[path] = target, names
        return self.joined[path]

    def _walk(self, path: str) -> tuple[Collection, dict[str, str] | None, str, str]:
        """Collection that the path ends in, its joined columns, the way there, and the rest of the path."""
        owner, names, way, rest = self.collection, None, "", path
        while True:
            hit = next((r for r in owner.references if rest == r.name or rest.startswith(r.name + ".")), None)
            if hit is None:
                return owner, names, way, rest
            after = rest[len(hit.name) + 1 :]
            if after == self.model[hit.target].key:  # the key is here already, as the reference's own value
                return owner, names, way, hit.fk
            way = f"{way}.{hit.name}" if way else hit.name
            owner, names = self._join(way, owner, self._own(names, hit.fk), hit.name)
            rest = after
            if not rest:
                return owner, names, way, ""

    @staticmethod
    def _own(names: dict[str, str] | None, path: str) -> Column:
        first, *rest = path.split(".")
        out = F.col(f"`{names[first] if names else first}`")
        for name in rest:
            out = out[name]
        return out

    def reference_in(self, path: str) -> bool:
        """Whether the path needs a referenced document, not its key alone."""
        owner, rest = self.collection, path
        while hit := next((r for r in owner.references if rest == r.name or rest.startswith(r.name + ".")), None):
            rest = rest[len(hit.name) + 1 :]
            if rest != self.model[hit.target].key:
                return True
            return False
        return False

    def column(self, path: str) -> Column:
        if not isinstance(path, str):
            raise UnsupportedQuery(f"only field paths are supported, not {path!r}")
        owner, names, way, rest = self._walk(path)
        if not rest:  # a whole referenced document
            assert names is not None
            return F.when(F.col(f"`{names[owner.key]}`").isNotNull(), F.struct(*[F.col(f"`{n}`").alias(c) for c, n in names.items()]))  # type: ignore[index]
        first = rest.split(".")[0]
        if first not in (names or self.columns):
            raise UnsupportedQuery(f"{owner.name} has no field {rest}")
        return self._own(names, rest)

    def predicate(self, p: P.Predicate) -> Column:
        if isinstance(p, P.All | P.AnyOf):
            parts = [self.predicate(x) for x in p.parts]
            out = parts[0]
            for x in parts[1:]:
                out = out & x if isinstance(p, P.All) else out | x
            return out
        if isinstance(p, P.Path):
            return self._filterable(p.path) == F.lit(True)
        if isinstance(p, P.Negated):
            inner = p.part
            if isinstance(inner, P.Path):
                return self._filterable(inner.path) == F.lit(False)
            if isinstance(inner, P.Negated):
                return self.predicate(inner.part)
            if self.strict and _tests_array(inner):
                raise UnsupportedQuery("the negation of an array test is not supported")
            return ~self.predicate(inner)
        if isinstance(p, P.Compare):
            return self._compare(p)
        if isinstance(p, P.OneOf):
            kind, values = self._kind(p.path)
            return self._filterable(p.path).isin(*[literal(v, kind, values) for v in p.values]) if p.values else F.lit(False)
        if isinstance(p, P.Contains):
            kind, values = self._kind(p.path)
            element = kind.elementType if isinstance(kind, T.ArrayType) else None
            own = self._filterable(p.path)
            if len(p.values) == 1:
                return F.array_contains(own, literal(p.values[0], element, values).cast(element) if element else literal(p.values[0], None, values))
            wanted = F.array(*[literal(v, element, values) for v in p.values])
            return F.arrays_overlap(own, wanted.cast(T.ArrayType(element)) if element else wanted)
        if isinstance(p, P.StartsWith):
            return self._filterable(p.path).startswith(p.prefix)
        raise UnsupportedQuery(f"{type(p).__name__} is not a predicate")

    def _kind(self, path: str) -> tuple[T.DataType | None, tuple[str, ...] | None]:
        return typed(self.df.schema, path), self.collection.enums.get(path)

    def _filterable(self, path: str) -> Column:
        if self.strict and self.reference_in(path):
            raise UnsupportedQuery(f"{path}: a filter may look at a reference's key only; select or include the rest")
        return self.column(path)

    def _compare(self, p: P.Compare) -> Column:
        own = self._filterable(p.path)
        if p.value is None:
            if p.op not in ("==", "!="):
                raise UnsupportedQuery("null has no order")
            first = p.path.split(".")[0]
            if self.strict and p.path != self.collection.key and first not in self.collection.persist_null:
                raise UnsupportedQuery(f"{p.path}: nulls are only kept, and can only be asked for, where persist_null is declared")
            return own.isNull() if p.op == "==" else own.isNotNull()
        kind, values = self._kind(p.path)
        other = literal(p.value, kind, values)
        return {"==": own == other, "!=": own != other, "<": own < other, "<=": own <= other, ">": own > other, ">=": own >= other}[p.op]

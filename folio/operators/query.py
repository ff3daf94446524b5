"""The query builder: immutable, validated when it is planned, planned into one DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.errors import AmbiguousResult, EmptyResult, UnsupportedQuery
from folio.functions import predicates as P
from folio.model import Collection, Model
from folio.plans import nest
from folio.plans.scope import Scope
from folio.plans.shape import shaped

Frames = Callable[[str], DataFrame]
AGGREGATES = ("count", "any", "sum", "avg", "min", "max")


@dataclass(frozen=True)
class Order:
    path: str
    desc: bool = False


@dataclass(frozen=True)
class Clauses:
    """What root and child queries share."""

    filters: tuple[P.Predicate, ...] = ()
    order: tuple[Order, ...] = ()
    skipped: int | None = None
    taken: int | None = None
    included: tuple = ()
    fields: Mapping[str, Any] | None = None
    aggregate: tuple[str, str | None] | None = None

    def where(self, *predicates: P.Predicate | None):
        """Only rows for which all hold; None is no filter."""
        return replace(self, filters=(*self.filters, *[p for p in predicates if p is not None]))

    def order_by(self, path: str, desc: bool = False):
        """Rows without the field are left out; ties go by key."""
        return replace(self, order=(Order(path, desc),))

    def then_by(self, path: str, desc: bool = False):
        if not self.order:
            raise UnsupportedQuery("then_by needs order_by before it")
        return replace(self, order=(*self.order, Order(path, desc)))

    def take(self, n: int):
        return replace(self, taken=n if self.taken is None else min(n, self.taken))

    def skip(self, n: int):
        if self.taken is not None:
            return replace(self, skipped=(self.skipped or 0) + n, taken=max(0, self.taken - n))
        return replace(self, skipped=(self.skipped or 0) + n)

    def include(self, *what: str | ChildQuery):
        """References by path, arrays of references by path, or child queries."""
        return replace(self, included=(*self.included, *[w for w in what if w not in self.included]))

    def select(self, *paths: str, **named: Any):
        """Fields by path, and under new names: paths, child queries, or dicts of these for nested objects."""
        fields = {_last(p): p for p in paths} | named
        return replace(self, fields=fields)

    def _aggregate(self, kind: str, path: str | None, predicate: P.Predicate | None = None):
        return replace(self.where(predicate), aggregate=(kind, path))

    def count(self, predicate: P.Predicate | None = None):
        return self._aggregate("count", None, predicate)

    def any(self, predicate: P.Predicate | None = None):
        return self._aggregate("any", None, predicate)

    def sum(self, path: str):
        return self._aggregate("sum", path)

    def avg(self, path: str):
        return self._aggregate("avg", path)

    def min(self, path: str):
        return self._aggregate("min", path)

    def max(self, path: str):
        return self._aggregate("max", path)


def _unsupported(name: str):
    def method(self, *_, **__):
        raise UnsupportedQuery(f"{name} is outside the document query surface; use df() for plain DataFrame operations")

    return method


for _name in ("distinct", "group_by", "join", "union", "concat", "intersect", "exclude", "reverse", "last", "element_at", "skip_while", "take_while", "all", "select_many", "group_join", "of_type", "cast", "long_count", "contains", "default_if_empty"):
    setattr(Clauses, _name, _unsupported(_name))


def _last(path: Any) -> str:
    if not isinstance(path, str):
        raise UnsupportedQuery(f"only field paths can be selected, not {path!r}")
    return path.split(".")[-1]


@dataclass(frozen=True)
class Cast:
    """A field as another type, in a select."""

    path: str
    kind: str


def cast(path: str, kind: str) -> Cast:
    return Cast(path, kind)


@dataclass(frozen=True)
class ChildQuery(Clauses):
    """Children of each parent, in a select or an include."""

    name: str = ""


def child(name: str) -> ChildQuery:
    return ChildQuery(name=name)


@dataclass(frozen=True)
class DocQuery(Clauses):
    """A query of one collection."""

    model: Model = None  # type: ignore[assignment]
    frames: Frames = None  # type: ignore[assignment]
    name: str = ""
    strict: bool = True
    filtered: bool = True
    last: int | None = None
    after: tuple = ()
    terminal: str | None = None

    # cardinality

    def take_last(self, n: int) -> DocQuery:
        if not self.order:
            raise UnsupportedQuery("take_last needs order_by before it")
        return replace(self, last=n)

    def start_after(self, *values: Any) -> DocQuery:
        """Rows after the one with these values of the sort fields, then of the key."""
        return replace(self, after=values)

    def first(self, predicate: P.Predicate | None = None, default: bool = False) -> DocQuery:
        return replace(self.where(predicate).take(1), terminal="first_or_default" if default else "first")

    def single(self, predicate: P.Predicate | None = None, default: bool = False) -> DocQuery:
        return replace(self.where(predicate).take(2), terminal="single_or_default" if default else "single")

    def find(self, key: Any) -> DocQuery:
        return self.where(P.Compare(self.model[self.name].key, "==", key)).first(default=True)  # type: ignore[arg-type]

    def ignore_filters(self) -> DocQuery:
        return replace(self, filtered=False)

    def relaxed(self) -> DocQuery:
        """Lift the restrictions that are not a matter of meaning."""
        return replace(self, strict=False)

    # results

    def df(self) -> DataFrame:
        return Planner(self.model, self.frames, self.strict, self.filtered).root(self)

    def scalar(self, nullable: bool = False) -> Any:
        """Value of an aggregate; avg, min and max of nothing raise unless ``nullable``."""
        if not self.aggregate:
            raise UnsupportedQuery("scalar needs an aggregate")
        value = self.df().first()[0]
        if value is None and not nullable:
            raise EmptyResult(f"{self.aggregate[0]} of no rows")
        return value

    def one(self) -> Any:
        """The row of first or single, or what they raise."""
        rows = self.df().collect()
        if self.terminal in ("single", "single_or_default") and len(rows) > 1:
            raise AmbiguousResult("more than one row")
        if not rows and self.terminal in ("first", "single"):
            raise EmptyResult("no row")
        return rows[0] if rows else None

    def collect(self, attempts: int = 1, wait: float = 0.1) -> list:
        """All rows; with more ``attempts`` a failed run is tried again after ``wait`` seconds, doubled each time."""
        for turn in range(attempts):
            try:
                return self.df().collect()
            except PySparkException:
                if turn + 1 == attempts:
                    raise
                time.sleep(wait * 2**turn)
        return []

    def rows(self) -> Iterator:
        """The rows one after another, a partition at a time on the driver."""
        return self.df().toLocalIterator(prefetchPartitions=True)

    def describe(self) -> str:
        """The query in words, for logs."""
        parts = [self.name, *(f"where {_said(f)}" for f in self.filters)]
        parts += ["order by " + ", ".join(o.path + " desc" * o.desc for o in self.order)] if self.order else []
        parts += [f"{k} {v}" for k, v in (("skip", self.skipped), ("take", self.taken), ("take last", self.last)) if v is not None]
        parts += [f"include {i if isinstance(i, str) else i.name}" for i in self.included]
        parts += ["select " + ", ".join(self.fields)] if self.fields else []
        parts += [" ".join(x for x in self.aggregate if x)] if self.aggregate else []
        return " | ".join(parts)

    def log(self, level: str = "full", rows: int = 100) -> str:
        """What a log should say: nothing (none), the query and its number of rows (count), the first keys (ids), or the plan too (full)."""
        if level == "none":
            return ""
        df = self.df()
        said = f"{self.describe()} | {df.count()} rows"
        key = self.model[self.name].key
        if level in ("ids", "full") and key in df.columns:
            said += f" | {key}: {[r[0] for r in df.select(key).limit(rows).collect()]}"
        if level == "full":
            said += "\n" + df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return said

    def explain(self, mode: str = "formatted") -> None:
        self.df().explain(mode)


def _said(p: P.Predicate) -> str:
    if isinstance(p, P.All | P.AnyOf):
        return "(" + (" and " if isinstance(p, P.All) else " or ").join(map(_said, p.parts)) + ")"
    if isinstance(p, P.Negated):
        return f"not {_said(p.part)}"
    if isinstance(p, P.Compare):
        return f"{p.path} {p.op} {p.value!r}"
    if isinstance(p, P.OneOf | P.Contains):
        return f"{p.path} {'in' if isinstance(p, P.OneOf) else 'has'} {list(p.values)!r}"
    return f"{p.path} starts with {p.prefix!r}" if isinstance(p, P.StartsWith) else p.path  # type: ignore[attr-defined]


def _clauses_of(filters: tuple[P.Predicate, ...]) -> list[P.Predicate]:
    out: list[P.Predicate] = []
    for f in filters:
        out += _clauses_of(f.parts) if isinstance(f, P.All) else [f]
    return out


def check_key_use(collection: Collection, filters: tuple[P.Predicate, ...]) -> None:
    """A key stands alone as ``==``, or once among other clauses."""
    clauses = _clauses_of(filters)
    own = [c for c in clauses if getattr(c, "path", None) == collection.key or isinstance(c, P.Negated) and getattr(c.part, "path", None) == collection.key]
    if len(own) > 1:
        raise UnsupportedQuery("two clauses on the key")
    if own and len(clauses) == 1 and not (isinstance(own[0], P.Compare) and own[0].op == "=="):
        raise UnsupportedQuery("a key by itself can only be asked for with ==")
    for c in clauses:
        if isinstance(c, P.AnyOf) and all(getattr(p, "path", None) == collection.key for p in c.parts) and len(clauses) == 1:
            raise UnsupportedQuery("or over keys alone is not supported")


class Planner:
    """Queries into DataFrames: scans, filters, one join for each navigation, windows for bands; nothing is collected."""

    def __init__(self, model: Model, frames: Frames, strict: bool = True, filtered: bool = True):
        self.model, self.strict, self.filtered = model, strict, filtered
        self._frames = frames

    def frame(self, name: str) -> DataFrame:
        collection = self.model[name]
        return shaped(collection, self._frames(collection.table or name))

    def _scope(self, collection: Collection, df: DataFrame) -> Scope:
        return Scope(self.model, collection, df, self.frame, self.strict)

    def _filtered(self, collection: Collection, q: Clauses) -> Scope:
        scope = self._scope(collection, self.frame(collection.name))
        filters = q.filters
        if self.strict and collection.key:
            check_key_use(collection, filters)
        if self.filtered and collection.default_filter:
            filters = (collection.default_filter(), *filters)
        for f in filters:
            condition = scope.predicate(f)
            scope.df = scope.df.filter(condition)
        return scope

    @staticmethod
    def _sort(scope: Scope, order: tuple[Order, ...], flip: bool = False) -> list[Column]:
        columns = [scope.column(o.path).desc() if o.desc != flip else scope.column(o.path).asc() for o in order]
        key = scope.collection.key
        if key and key not in [o.path for o in order]:
            columns.append(F.col(f"`{key}`").desc() if flip else F.col(f"`{key}`").asc())
        return columns

    @staticmethod
    def _ranks(scope: Scope, order: tuple[Order, ...]) -> list[tuple[Column, bool]]:
        """Columns that children are sorted by, and whether they descend; the key last."""
        key = scope.collection.key
        own = [(scope.column(o.path), o.desc) for o in order]
        return [*own, (F.col(f"`{key}`"), False)] if key and key not in [o.path for o in order] else own

    def root(self, q: DocQuery) -> DataFrame:
        scope = self._filtered(self.model[q.name], q)
        for o in q.order:
            present = scope.column(o.path).isNotNull()
            scope.df = scope.df.filter(present)
        if q.after:
            self._start_after(scope, q)
        limited = q.taken is not None or q.skipped is not None or q.last is not None
        if q.last is not None:
            scope.df = scope.df.orderBy(*self._sort(scope, q.order, flip=True)).limit(q.last)
        if q.order or limited:
            scope.df = scope.df.orderBy(*self._sort(scope, q.order)) if q.order else scope.df
            if q.skipped:
                scope.df = scope.df.offset(q.skipped)
            if q.taken is not None:
                scope.df = scope.df.limit(q.taken)
        if q.aggregate:
            kind, path = q.aggregate
            if kind == "any":  # one row is enough
                scope.df = scope.df.limit(1)
            return scope.df.agg(self._aggregated(scope, kind, path).alias("value"))
        self._include(scope, q.included)
        out = self._selected(scope, q) if q.fields is not None else scope.df.select(*[f"`{c}`" for c in self._kept(scope)])
        if q.order and q.included and q.fields is None:  # joins don't keep order
            return out.orderBy(*[F.col(f"`{o.path}`").desc() if o.desc else F.col(f"`{o.path}`").asc() for o in q.order if "." not in o.path], *([F.col(f"`{scope.collection.key}`")] if scope.collection.key else []))
        return out

    @staticmethod
    def _kept(scope: Scope) -> list[str]:
        return [c for c in scope.df.columns if not c.startswith("__")]

    def _start_after(self, scope: Scope, q: DocQuery) -> None:
        order = [*q.order]
        key = scope.collection.key
        if key and key not in [o.path for o in order]:
            order.append(Order(key))
        if len(q.after) != len(order):
            raise UnsupportedQuery(f"start_after needs {len(order)} values: the sort fields' and the key's")
        condition = None
        for o, value in reversed(list(zip(order, q.after, strict=True))):
            other = scope.predicate(P.Compare(o.path, "<" if o.desc else ">", value))
            same = scope.predicate(P.Compare(o.path, "==", value))
            condition = other if condition is None else other | (same & condition)
        scope.df = scope.df.filter(condition)

    # aggregates

    def _aggregated(self, scope: Scope, kind: str, path: str | None) -> Column:
        if kind == "count":
            return F.count(F.lit(1))
        if kind == "any":
            return F.count(F.lit(1)) > 0
        if not isinstance(path, str):
            raise UnsupportedQuery(f"{kind} takes a plain field path")
        own = scope.column(path)
        if kind == "sum":
            total = F.sum(own)
            return F.coalesce(total, F.lit(0).cast("double") if dict(scope.df.dtypes).get(path) in ("double", "float") else F.lit(0))
        return {"avg": F.avg, "min": F.min, "max": F.max}[kind](own)

    # projections

    def _selected(self, scope: Scope, q: Clauses) -> DataFrame:
        assert q.fields is not None
        order = [o for o in q.order] if isinstance(q, DocQuery) else []
        columns = [self._value(scope, v, f"__v{i}").alias(n) for i, (n, v) in enumerate(q.fields.items())]
        rank = [scope.column(o.path).alias(f"__o{i}") for i, o in enumerate(order)]
        needs = order and any(not isinstance(v, str) or scope.reference_in(v) for v in q.fields.values())
        if needs and scope.collection.key:
            key = F.col(f"`{scope.collection.key}`").alias("__k")
            sorted_rows = scope.df.select(*columns, *rank, key).orderBy(*[F.col(f"__o{i}").desc() if o.desc else F.col(f"__o{i}").asc() for i, o in enumerate(order)], "__k")
            out = sorted_rows.drop("__k", *[f"__o{i}" for i in range(len(order))])
        else:
            out = scope.df.select(*columns)
        if len(q.fields) == 1:  # a single field leaves out the rows without it
            (name,) = q.fields
            out = out.filter(F.col(f"`{name}`").isNotNull())
        return out

    def _value(self, scope: Scope, value: Any, name: str) -> Column:
        if isinstance(value, str):
            return scope.column(value)
        if isinstance(value, Cast):
            return scope.column(value.path).cast(value.kind)
        if isinstance(value, Mapping):
            return F.struct(*[self._value(scope, v, f"{name}_{i}").alias(n) for i, (n, v) in enumerate(value.items())])
        if isinstance(value, ChildQuery):
            if value.skipped and self.strict:
                raise UnsupportedQuery("skip is not supported in a projected sub-collection")
            self._attach_child(scope, value, name)
            return F.col(name)
        raise UnsupportedQuery(f"{value!r} cannot be selected: only field paths, child queries and nested objects can")

    # children

    def _attach_child(self, scope: Scope, q: ChildQuery, name: str) -> None:
        """A column of the children, or of their aggregate, on the parents."""
        collection = scope.collection
        link = collection.child(q.name)
        if link is None:
            raise UnsupportedQuery(f"{collection.name} has no sub-collection {q.name}")
        below = self._filtered(self.model[link.child], q)
        for o in q.order:
            present = below.column(o.path).isNotNull()
            below.df = below.df.filter(present)
        banded = q.taken is not None or q.skipped is not None
        if banded:
            below.df = nest.band(below.df, link.parent_key, self._sort(below, q.order) or [F.lit(1)], q.skipped or 0, q.taken)
        if q.aggregate:
            kind, path = q.aggregate
            side = below.df.groupBy(link.parent_key).agg(self._aggregated(below, kind, path).alias(name))
            empty = F.lit(None) if kind in ("min", "max") else F.lit(False) if kind == "any" else F.lit(0)
            scope.df = nest.attach(scope.df, collection.key, side, link.parent_key, name, empty)  # type: ignore[arg-type]
            return
        self._include(below, q.included)
        if q.fields is None:
            item = F.struct(*[F.col(f"`{c}`") for c in self._kept(below)])
        else:
            values = {n: self._value(below, v, f"__c{i}") for i, (n, v) in enumerate(q.fields.items())}
            item = next(iter(values.values())) if len(values) == 1 else F.struct(*[v.alias(n) for n, v in values.items()])
        side = nest.nested(below.df, link.parent_key, item, name, [(F.col(nest.RANK), False)] if banded else self._ranks(below, q.order))
        scope.df = nest.attach(scope.df, collection.key, side, link.parent_key, name, F.array())  # type: ignore[arg-type]

    def _include(self, scope: Scope, included: tuple) -> None:
        for what in included:
            if isinstance(what, ChildQuery):
                self._attach_child(scope, what, what.name)
                continue
            collection = scope.collection
            array = next((a for a in collection.arrays if a.kind == "reference" and (what == a.path or what == f"{a.path}.{a.fk}" or what == f"{a.path}.{_entity(a.fk)}")), None)
            if array is not None:
                target = self.model[array.target]  # type: ignore[index]
                if collection.key is None:
                    raise UnsupportedQuery(f"{what}: references in arrays need a collection with a key")
                scope.df = nest.include_array(scope.df, collection.key, array.path, array.fk, _entity(array.fk), self.frame(target.name), target.key)  # type: ignore[arg-type]
                continue
            if not scope.reference_in(what):
                raise UnsupportedQuery(f"{collection.name} has no navigation {what}")
            value = scope.column(what)
            name = what.replace(".", "_")
            scope.df = scope.df.withColumn(name, value)


def _entity(fk: str | None) -> str:
    """Name under which the document of a key field appears."""
    return fk.removesuffix("_id") if fk and fk.endswith("_id") else f"{fk}_document"


def query(model: Model, frames: Frames, name: str) -> DocQuery:
    model[name]
    return DocQuery(model=model, frames=frames, name=name)

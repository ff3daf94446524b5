"""Declarations of collections: keys, references, sub-collections, arrays, maps and points."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from folio.errors import ModelError

if TYPE_CHECKING:
    from folio.functions.predicates import Predicate


@dataclass(frozen=True)
class Reference:
    """``name`` leads to the document of ``target`` whose key is at ``fk`` (a column or a path into structs)."""

    name: str
    target: str
    fk: str


@dataclass(frozen=True)
class SubCollection:
    """Documents of ``child`` whose ``parent_key`` column holds the parent's key."""

    name: str
    child: str
    parent_key: str


@dataclass(frozen=True)
class ArrayOf:
    """An array at ``path``; of kind reference, its elements (or their ``fk`` fields) are keys of ``target``."""

    path: str
    kind: str = "primitive"
    target: str | None = None
    fk: str | None = None
    ignore: tuple[str, ...] = ()

    KINDS = ("primitive", "embedded", "geo", "reference")


@dataclass(frozen=True)
class MapOf:
    """A map at ``path`` with keys stored as strings."""

    path: str
    ignore: tuple[str, ...] = ()


@dataclass(frozen=True)
class GeoPoint:
    """A struct of latitude and longitude at ``path``."""

    path: str
    latitude: str = "latitude"
    longitude: str = "longitude"


@dataclass(frozen=True)
class Collection:
    name: str
    key: str | None
    table: str | None = None
    references: tuple[Reference, ...] = ()
    children: tuple[SubCollection, ...] = ()
    arrays: tuple[ArrayOf, ...] = ()
    maps: tuple[MapOf, ...] = ()
    points: tuple[GeoPoint, ...] = ()
    enums: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    persist_null: frozenset[str] = frozenset()
    default_filter: Callable[[], Predicate] | None = None

    def reference(self, name: str) -> Reference | None:
        return next((r for r in self.references if r.name == name), None)

    def child(self, name: str) -> SubCollection | None:
        return next((c for c in self.children if c.name == name), None)

    def array(self, path: str) -> ArrayOf | None:
        return next((a for a in self.arrays if a.path == path), None)


class Model:
    """Collections by name, checked when they are declared."""

    def __init__(self, *collections: Collection):
        self.collections = {c.name: c for c in collections}
        if len(self.collections) < len(collections):
            raise ModelError("two collections have one name")
        self.validate()

    def __getitem__(self, name: str) -> Collection:
        if name not in self.collections:
            raise ModelError(f"{name} is not a declared collection")
        return self.collections[name]

    def validate(self) -> None:
        for c in self.collections.values():
            if c.key is not None and (not c.key or "," in c.key):
                raise ModelError(f"{c.name}: a key is one column")
            names = [r.name for r in c.references] + [s.name for s in c.children]
            if len(set(names)) < len(names):
                raise ModelError(f"{c.name}: two navigations have one name")
            for r in c.references:
                if r.target not in self.collections:
                    raise ModelError(f"{c.name}.{r.name} refers to {r.target}, which is not declared")
                if self.collections[r.target].key is None:
                    raise ModelError(f"{c.name}.{r.name} refers to {r.target}, which has no key")
            for s in c.children:
                if s.child not in self.collections:
                    raise ModelError(f"{c.name}.{s.name} holds {s.child}, which is not declared")
                if c.key is None:
                    raise ModelError(f"{c.name} has children but no key")
                back = [x for x in self.collections[s.child].children if x.child == c.name]
                if back:
                    raise ModelError(f"{c.name} and {s.child} hold each other: many-to-many is not supported")
            for a in c.arrays:
                if a.kind not in ArrayOf.KINDS:
                    raise ModelError(f"{c.name}.{a.path}: unknown kind {a.kind}")
                if a.kind == "reference" and (a.target is None or a.target not in self.collections):
                    raise ModelError(f"{c.name}.{a.path} refers to {a.target}, which is not declared")

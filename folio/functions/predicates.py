"""Predicates over document fields, built with Python operators."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from folio.errors import UnsupportedQuery


class Predicate:
    """Combine with ``&``, ``|`` and ``~``."""

    def __and__(self, other: Predicate | None) -> Predicate:
        return self if other is None else All((self, other))

    def __rand__(self, other: Predicate | None) -> Predicate:
        return self if other is None else All((other, self))

    def __or__(self, other: Predicate) -> Predicate:
        return AnyOf((self, other))

    def __invert__(self) -> Predicate:
        return Negated(self)

    def __bool__(self) -> bool:
        raise TypeError("combine predicates with &, | and ~")


@dataclass(frozen=True, eq=False)
class All(Predicate):
    parts: tuple[Predicate, ...]


@dataclass(frozen=True, eq=False)
class AnyOf(Predicate):
    parts: tuple[Predicate, ...]


@dataclass(frozen=True, eq=False)
class Negated(Predicate):
    part: Predicate


@dataclass(frozen=True, eq=False)
class Compare(Predicate):
    path: str
    op: str
    value: Any


@dataclass(frozen=True, eq=False)
class OneOf(Predicate):
    path: str
    values: tuple


@dataclass(frozen=True, eq=False)
class Contains(Predicate):
    """Some element of the array at ``path`` is one of ``values``."""

    path: str
    values: tuple


@dataclass(frozen=True, eq=False)
class StartsWith(Predicate):
    path: str
    prefix: str


class Path(Predicate):
    """A field, dotted into structs and references; by itself, a boolean field that is true."""

    def __init__(self, path: str):
        self.path = path

    def __getattr__(self, name: str) -> Path:
        if name.startswith("_"):
            raise AttributeError(name)
        return Path(f"{self.path}.{name}")

    def __getitem__(self, name: str) -> Path:
        return Path(f"{self.path}.{name}")

    def __eq__(self, value: Any) -> Compare:  # type: ignore[override]
        return Compare(self.path, "==", value)

    def __ne__(self, value: Any) -> Compare:  # type: ignore[override]
        return Compare(self.path, "!=", value)

    def __lt__(self, value: Any) -> Compare:
        return Compare(self.path, "<", value)

    def __le__(self, value: Any) -> Compare:
        return Compare(self.path, "<=", value)

    def __gt__(self, value: Any) -> Compare:
        return Compare(self.path, ">", value)

    def __ge__(self, value: Any) -> Compare:
        return Compare(self.path, ">=", value)

    __hash__ = None  # type: ignore[assignment]

    def equals(self, value: Any) -> Compare:
        return Compare(self.path, "==", value)

    def between(self, low: Any, high: Any) -> Predicate:
        return All((Compare(self.path, ">=", low), Compare(self.path, "<=", high)))

    def is_in(self, values: Iterable) -> OneOf:
        return OneOf(self.path, tuple(values))

    def not_in(self, values: Iterable) -> Predicate:
        return Negated(OneOf(self.path, tuple(values)))

    def contains(self, value: Any) -> Contains:
        return Contains(self.path, (value,))

    def contains_any(self, values: Iterable) -> Contains:
        values = tuple(values)
        if not values:
            raise UnsupportedQuery("contains_any needs at least one value")
        return Contains(self.path, values)

    def starts_with(self, prefix: str) -> StartsWith:
        return StartsWith(self.path, prefix)

    def is_null(self) -> Compare:
        return Compare(self.path, "==", None)

    def is_not_null(self) -> Compare:
        return Compare(self.path, "!=", None)

    def ends_with(self, _: str) -> Predicate:
        raise UnsupportedQuery("of the string tests only starts_with is supported")

    like = matches = contains_text = ends_with


def field(path: str) -> Path:
    return Path(path)


def if_set(value: Any, predicate: Any) -> Predicate | None:
    """``predicate(value)``, or no filter at all where the parameter is None."""
    return None if value is None else predicate(value)

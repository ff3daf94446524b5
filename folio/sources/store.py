"""Collections kept as Parquet folders."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.model import Model
from folio.operators.query import DocQuery, query


#: Column of a partitioned collection's folders; its name tells into how many the keys are hashed.
PART = re.compile(r"__part_of_(\d+)")


def _part(key: Column, of: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(of)).cast("int")


class ParquetStore:
    """Reads ``{folder}/{table}.parquet``; writes new states beside the old and swaps them by rename.

    A collection can be kept in folders that keys are hashed into (``partition``);
    an update then rewrites those alone that hold its keys.  ``on_command`` is told
    each write.
    """

    def __init__(self, spark: SparkSession, folder: str, model: Model, on_command: Callable[[str], None] | None = None):
        self.spark, self.folder, self.model, self.on_command = spark, folder.rstrip("/"), model, on_command

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def frame(self, table: str, parts: Iterable[int] | None = None) -> DataFrame:
        """The collection, or the rows of some of its folders: others aren't read."""
        df = self.spark.read.parquet(self.path(table))
        own = [c for c in df.columns if PART.fullmatch(c)]
        return (df.filter(F.col(own[0]).isin(*parts)) if parts is not None else df).drop(*own)

    def part_column(self, table: str) -> str | None:
        """What the collection's folders are named after, where it has any."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        fs = self.file_system()
        names = [f.getPath().getName().split("=")[0] for f in fs.listStatus(at)] if fs.exists(at) else []
        return next((n for n in names if PART.fullmatch(n)), None)

    def parts_of(self, name: str, rows: DataFrame) -> list[int] | None:
        """The folders that hold the keys of ``rows``, or None for a collection without folders.

        At most as many numbers are collected as there are folders.
        """
        c = self.model[name]
        table = c.table or name
        column = self.part_column(table)
        if column is None:
            return None
        key = F.col(f"`{c.key}`")
        found = rows.filter(key.isNotNull()).select(_part(key.cast(self.frame(table).schema[c.key].dataType), self._width(column)).alias("part"))
        return sorted(r.part for r in found.distinct().collect())

    def partition(self, name: str, parts: int) -> None:
        """Keep the collection in ``parts`` folders from now on.  An empty one stays without."""
        self._commit({name: self.frame(self.model[name].table or name)}, {name: f"__part_of_{parts}"})

    @staticmethod
    def _width(column: str) -> int:
        return int(PART.fullmatch(column)[1])  # type: ignore[index]

    def _write(self, name: str, state: DataFrame, path: str, column: str | None, mode: str = "error") -> None:
        if column is None or state.isEmpty():  # a write into folders leaves no schema of an empty state
            state.write.mode(mode).parquet(path)
        else:
            n = self._width(column)
            state.withColumn(column, _part(F.col(f"`{self.model[name].key}`"), n)).repartition(n, column).write.mode(mode).partitionBy(column).parquet(path)

    def query(self, name: str) -> DocQuery:
        return query(self.model, self.frame, name)

    def get(self, name: str, key: Any) -> Any:
        """One document, or None: a filter on the key reaches the Parquet scan."""
        return self.query(name).ignore_filters().find(key).one()

    def exists(self, name: str, key: Any) -> bool:
        c = self.model[name]
        return not self.frame(c.table or name).filter(F.col(c.key) == F.lit(key)).limit(1).isEmpty()  # type: ignore[arg-type]

    def children(self, name: str, sub: str, key: Any) -> DataFrame:
        """The sub-collection of one parent."""
        link = self.model[name].child(sub)
        if link is None:
            raise LookupError(f"{name} has no sub-collection {sub}")
        child = self.model[link.child]
        return self.frame(child.table or child.name).filter(F.col(link.parent_key) == F.lit(key))

    def can_connect(self) -> bool:
        """Whether the folder is there."""
        return self.file_system().exists(self.spark._jvm.org.apache.hadoop.fs.Path(self.folder))

    def file_system(self) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def append(self, name: str, rows: DataFrame) -> None:
        self._said(f"append {name}")
        table = self.model[name].table or name
        column = self.part_column(table)
        if column is None or not rows.isEmpty():
            self._write(name, rows, self.path(table), column, "append")

    def replace(self, name: str, state: DataFrame, parts: Iterable[int] | None = None) -> None:
        """Write the new state in full, then swap it in; with ``parts``, that of these folders alone."""
        if parts is None:
            self.commit({name: state})
            return
        column, table, run = self.part_column(self.model[name].table or name), self.model[name].table or name, uuid.uuid4().hex
        new, old = f"{self.folder}/.{table}-{run}", f"{self.folder}/.{table}-old-{run}"
        folders = [f"{column}={k}" for k in parts]
        self._swapped([name], lambda: self._write(name, state, new, column), [(f"{new}/{k}", f"{self.path(table)}/{k}", f"{old}/{k}") for k in folders], [new], [old])

    def commit(self, states: Mapping[str, DataFrame]) -> None:
        """New states of several collections, all or none; those kept in folders stay so.

        All are written in full beside the old ones first.  Then each is swapped in
        by two checked renames; if one fails, those done are undone and the old
        states are where they were.  The old ones are deleted last.  Between the two
        renames of a collection a reader may find none; it never finds half of one.
        Of a state that replaces some folders only, a reader may meanwhile find some
        new, some old, and one missing.
        """
        self._commit(states, {name: self.part_column(self.model[name].table or name) for name in states})

    def _commit(self, states: Mapping[str, DataFrame], columns: Mapping[str, str | None]) -> None:
        run = uuid.uuid4().hex
        names = {name: self.model[name].table or name for name in states}
        new = {name: f"{self.folder}/.{table}-{run}" for name, table in names.items()}
        old = {name: f"{self.folder}/.{table}-old-{run}" for name, table in names.items()}

        def write() -> None:
            for name, state in states.items():
                self._write(name, state, new[name], columns[name])

        self._swapped(list(states), write, [(new[n], self.path(table), old[n]) for n, table in names.items()], list(new.values()), list(old.values()))

    def _swapped(self, names: list[str], write: Callable[[], None], moves: list[tuple[str, str, str]], made: list[str], left: list[str]) -> None:
        """``write``, then for each (new, target, old) the target to old and new to the target, all or none; then ``made`` and ``left`` go."""
        path, fs = self.spark._jvm.org.apache.hadoop.fs.Path, self.file_system()
        done: list[tuple[Any, Any]] = []

        def moved(source: Any, to: Any) -> None:
            fs.mkdirs(to.getParent())
            if not fs.rename(source, to):
                raise OSError(f"{source} could not be renamed to {to}")
            done.append((source, to))

        try:
            write()
            for new, target, old in ((path(x) for x in move) for move in moves):
                if fs.exists(target):
                    moved(target, old)
                if fs.exists(new):
                    moved(new, target)
        except Exception:
            for source, to in reversed(done):
                fs.rename(to, source)
            for own in made:
                fs.delete(path(own), True)
            self._said(f"rollback {', '.join(names)}")
            raise
        for own in (*made, *left):
            fs.delete(path(own), True)
        for name in names:
            self.spark.catalog.refreshByPath(self.path(self.model[name].table or name))
        self._said(f"commit {', '.join(names)}")

    def _said(self, command: str) -> None:
        if self.on_command:
            self.on_command(command)

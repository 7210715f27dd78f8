"""Runs of a job that can be taken up again, and tables laid out by one column.

A run writes each table beside its place and moves it there when it is whole; then a note in `_manifest` says so. A run over the
same inputs with the same arguments, begun after one that stopped, takes the tables with a note as they are. Tables that only
the job itself reads are kept under `_shared` until all results are there, then removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from callgrain.sources import files


def input_digest(df: DataFrame) -> str:
    """Of the files a table comes from (names, sizes, times of change) and of what is done to them.

    Tables that do not come from files get another digest each time, as their rows are not compared.
    """
    paths = df.inputFiles()
    if not paths:
        return uuid.uuid4().hex
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    return sha256("\n".join([plan, *files.states(df.sparkSession, paths)]).encode()).hexdigest()


def write_laid_out(df: DataFrame, path: str, column: str, buckets: int, is_placed: bool = False) -> str:
    """Write a table in buckets of `column`, sorted by it; returns its name in the catalog.

    `is_placed` says that its rows come from tables laid out the same way, and so are where they belong.

    Grouping and joining by the column, also together with further ones, needs no exchange then. A bucket is one file, so rows
    of one value must fit one task: this is for tables with a limited number of rows for each value.
    """
    name = f"laid_out_{uuid.uuid4().hex}"
    placed = df if is_placed else df.repartition(buckets, column)
    placed.write.bucketBy(buckets, column).sortBy(column).format("parquet").option(
        "path", path).saveAsTable(name)
    return name


def register_laid_out(spark: SparkSession, path: str, column: str, buckets: int, ddl: str) -> str:
    """The same for a table that an earlier session has written with `write_laid_out`."""
    name, path = f"laid_out_{uuid.uuid4().hex}", path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({column}) SORTED BY ({column}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


class Run:
    """One run of a job into `folder`. Inputs and arguments decide whether tables of an earlier run still hold."""

    def __init__(self, folder: str, inputs: list[DataFrame], arguments: object):
        self.spark, self.folder = inputs[0].sparkSession, folder.rstrip("/")
        self.digest = sha256("\n".join([*map(input_digest, inputs), repr(arguments)]).encode()).hexdigest()
        self._notes_at, self._shared_at = f"{self.folder}/_manifest", f"{self.folder}/_shared"
        found = {name: json.loads(text) for name, text in files.read_texts(self.spark, self._notes_at, ".json").items()}
        self.notes = {name: note for name, note in found.items() if note["digest"] == self.digest}
        for name in found.keys() - self.notes.keys():
            files.remove(self.spark, f"{self._notes_at}/{name}.json")
        if not self.notes:
            files.remove(self.spark, self._shared_at)
        self._laid_out: list[str] = []

    def _note(self, name: str, **more: object) -> None:
        self.notes[name] = {"digest": self.digest, **more}
        files.write_text(self.spark, f"{self._notes_at}/{name}.json", json.dumps(self.notes[name]))

    def shared(self, name: str, make: Callable[[], DataFrame], column: str | None = None, buckets: int = 0) -> DataFrame:
        """A table that several results read, written once; with `column` it is laid out by that."""
        path, note = f"{self._shared_at}/{name}", f"shared.{name}"
        if note in self.notes:
            held = self.notes[note]
            if not column:
                return self.spark.read.schema(held["ddl"]).parquet(path)
            return self._table(register_laid_out(self.spark, path, column, held["buckets"], held["ddl"]))
        files.remove(self.spark, path)
        df = make()
        if column:
            out = self._table(write_laid_out(df, path, column, buckets))
        else:
            df.write.parquet(path)
            out = self.spark.read.schema(df.schema).parquet(path)
        self._note(note, ddl=_ddl(out), buckets=buckets)
        return out

    def _table(self, name: str) -> DataFrame:
        self._laid_out.append(name)
        return self.spark.table(name)

    def has(self, name: str) -> bool:
        """Whether a run with the same inputs and arguments has written this result."""
        return name in self.notes and files.exists(self.spark, f"{self.folder}/{name}")

    def publish(self, name: str, make: Callable[[], DataFrame], column: str | None = None, buckets: int = 0) -> str:
        """Write a result, unless an earlier run has; returns its path. With `column` it is laid out by that, as what it is made of."""
        path = f"{self.folder}/{name}"
        if not self.has(name):
            made, df = f"{self.folder}/_building/{name}-{uuid.uuid4().hex}", make()
            if column:
                self.spark.sql(f"DROP TABLE {write_laid_out(df, made, column, buckets, is_placed=True)}")
            else:
                df.write.parquet(made)
            files.put_in_place(self.spark, made, path)
            self._note(name, ddl=_ddl(df), column=column, buckets=buckets)
        return path

    def result(self, name: str) -> DataFrame:
        """A result of this run or an earlier one, with its layout."""
        note, path = self.notes[name], f"{self.folder}/{name}"
        if not note["column"]:
            return self.spark.read.schema(note["ddl"]).parquet(path)
        return self._table(register_laid_out(self.spark, path, note["column"], note["buckets"], note["ddl"]))

    def publish_all(self, tables: dict[str, Callable[[], DataFrame]]) -> dict[str, str]:
        """Write all results, then finish."""
        paths = {name: self.publish(name, make) for name, make in tables.items()}
        self.finish()
        return paths

    def __enter__(self) -> Run:
        return self

    def __exit__(self, *_: object) -> None:
        """Whatever happened: names in the catalog go, files stay."""
        for name in self._laid_out:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._laid_out.clear()

    def finish(self) -> None:
        """Remove what only the job needed."""
        for name in [n for n in self.notes if n.startswith("shared.")]:
            files.remove(self.spark, f"{self._notes_at}/{name}.json")
            del self.notes[name]
        for folder in (self._shared_at, f"{self.folder}/_building"):
            files.remove(self.spark, folder)

"""Replacing a set of files of a table by others that hold the same rows, without losing a file that appears in between.

Parquet has no transactions, so a replacement goes through three steps, each of which may be cut short:

1. The new files are written to ``_replacing/<name>/data`` inside the table, hidden from its readers.
2. A note beside them names the old and the new files. It appears whole or not at all; from then on the replacement is decided.
3. Every new file is moved to its folder, then exactly the old files are removed.

Whoever finds a note may finish it, however often: a file that was moved or removed already is passed over. Files that the note doesn't
name, a load's for instance, are never touched. While a note is there, ``read_table`` leaves out its old files and reads those new ones
that haven't been moved, so a broken replacement shows every row once. A folder without a note is what an unfinished first step left; it
is deleted. One replacement of a table at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.plans.staging import child_names, delete_folder, file_lengths, move_file, path_exists, read_text, remove_file, write_text

# Beside the table's day folders and hidden from readers.
REPLACING = "_replacing"


@dataclass(frozen=True)
class Replacement:
    """A decided replacement: files as paths below the table, and below ``data`` while they are new."""

    table: str
    name: str
    old: tuple[str, ...]
    new: tuple[str, ...]
    rows: int

    @property
    def place(self) -> str:
        return f"{self.table}/{REPLACING}/{self.name}"

    @property
    def data(self) -> str:
        return f"{self.place}/data"


def new_data(path: str) -> tuple[str, str]:
    """Name and hidden folder of a replacement to be prepared."""
    name = uuid.uuid4().hex
    return name, f"{path.rstrip('/')}/{REPLACING}/{name}/data"


def decide(spark: SparkSession, path: str, name: str, old: list[str], rows: int) -> Replacement:
    """Note that the files written to the hidden folder replace the ``old`` ones (paths below the table)."""
    place = f"{path.rstrip('/')}/{REPLACING}/{name}"
    new = sorted(file_lengths(spark, f"{place}/data"))
    write_text(spark, f"{place}/note", json.dumps({"old": sorted(old), "new": new, "rows": rows}))
    return Replacement(path.rstrip("/"), name, tuple(sorted(old)), tuple(new), rows)


def decided(spark: SparkSession, path: str) -> list[Replacement]:
    """The replacements of a table that are decided and not finished."""
    path, found = path.rstrip("/"), []
    for name in child_names(spark, f"{path}/{REPLACING}"):
        note = f"{path}/{REPLACING}/{name}/note"
        if path_exists(spark, note):
            held = json.loads(read_text(spark, note))
            found.append(Replacement(path, name, tuple(held["old"]), tuple(held["new"]), held["rows"]))
    return found


def _folder(file: str) -> str:
    return file.rsplit("/", 1)[0]


def _unmoved(spark: SparkSession, work: Replacement) -> list[str]:
    """New files that are still hidden. Old files go last, so a folder that is gone was dropped, and its files with it."""
    hidden = set(file_lengths(spark, work.data))
    there = {folder: path_exists(spark, f"{work.table}/{folder}") for folder in {_folder(file) for file in work.new if file in hidden}}
    return [file for file in work.new if file in hidden and there[_folder(file)] and not path_exists(spark, f"{work.table}/{file}")]


def finish(spark: SparkSession, work: Replacement) -> int:
    """Carry out what is decided, from wherever it stopped; returns the rows of the new files."""
    for file in _unmoved(spark, work):
        move_file(spark, f"{work.data}/{file}", f"{work.table}/{file}")
    for file in work.old:
        remove_file(spark, f"{work.table}/{file}")
    delete_folder(spark, work.place)
    return work.rows


def settle(spark: SparkSession, path: str) -> int:
    """Finish the decided replacements of a table and clear away undecided ones; returns the rows of finished ones."""
    rows = sum(finish(spark, work) for work in decided(spark, path))
    if path_exists(spark, f"{path.rstrip('/')}/{REPLACING}"):
        delete_folder(spark, f"{path.rstrip('/')}/{REPLACING}")
    return rows


def read_table(
    spark: SparkSession, schema: T.StructType, path: str, wanted: Callable[[str], bool] = lambda _: True
) -> DataFrame:
    """The rows of a table's top folders whose names are ``wanted``, each once, whatever replacement is under way."""
    path = path.rstrip("/")
    names = [name for name in child_names(spark, path) if "=" in name and wanted(name)]
    if not names:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{name}" for name in names])
    for work in decided(spark, path):
        old = [file for file in work.old if file.split("/", 1)[0] in names]
        if old:
            # A task writes files of one name to several folders, so it takes the folders to tell them apart.
            below = F.substring_index(F.col("_metadata.file_path"), "/", -(old[0].count("/") + 1))
            rows = rows.filter(~below.isin(old))
        hidden = [file for file in _unmoved(spark, work) if file.split("/", 1)[0] in names]
        if hidden:
            more = spark.read.schema(schema).option("basePath", work.data).parquet(*[f"{work.data}/{file}" for file in hidden])
            rows = rows.unionByName(more)
    return rows

"""Append-only tables of few rows an entry, and their compaction.

A table is a folder of entries, ``entry=<id>``, each written by one caller. A
compaction copies all entries into one set of files, a generation:

``_merged/<number>-<id>/rows``    the rows, with the entry they come from
``_merged/<number>-<id>/files``   the entries' files that they were read from
``_merged/<number>-<id>.done``    written last; the highest number that has it counts

A reader takes the newest generation and the files of entries that it does not
name, so it sees an entry's rows once, before, during and after a compaction.
An entry written anew after it was merged has other files: it stands for its
merged rows. The files that a generation took in are deleted by a later
compaction, once that generation is so old that no reader still lists by the
one before it.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import join_path

MERGED, DONE = "_merged", ".done"
ENTRY = "_entry"
#: Rows of a generation's file.
FILE_ROWS = 1_000_000


def column_names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class _Store:
    """The few calls that a table's folder needs of its file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop, self.root = spark._jvm.org.apache.hadoop.fs, path
        self.files = self.hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self.hadoop.Path(join_path(self.root, *parts))

    def generations(self) -> dict[str, float]:
        """Finished generations, oldest first, with the time (seconds) each was finished."""
        path = self.at(MERGED)
        if not self.files.exists(path):
            return {}
        found = {f.getPath().getName(): f.getModificationTime() / 1000 for f in self.files.listStatus(path)}
        return {n.removesuffix(DONE): found[n] for n in sorted(found) if n.endswith(DONE)}

    def newest(self) -> str | None:
        return max(self.generations(), default=None)

    def finish(self, generation: str) -> None:
        self.files.create(self.at(MERGED, generation + DONE), True).close()

    def drop_generation(self, generation: str) -> None:
        # The marker goes last: a generation that lost its rows only is tried again, not forgotten.
        self.files.delete(self.at(MERGED, generation), True)
        self.files.delete(self.at(MERGED, generation + DONE), False)

    def drop_files(self, files: list[str]) -> None:
        """Delete files, and their entries' folders if nothing else is in them."""
        names: dict[str, list[str]] = {}
        for f in files:
            folder, name = f.split("/", 1)
            names.setdefault(folder, []).append(name)

        def drop(folder: str) -> None:
            for name in names[folder]:
                self.files.delete(self.at(folder, name), False)
            try:
                left = [s.getPath().getName() for s in self.files.listStatus(self.at(folder))]
            except Exception as e:  # noqa: BLE001  (a store without folders forgets an empty one)
                if "FileNotFoundException" not in str(e):
                    raise
                return
            if left == ["_SUCCESS"]:
                self.files.delete(self.at(folder, "_SUCCESS"), False)
                left = []
            if not left:
                self.files.delete(self.at(folder), False)

        with ThreadPoolExecutor(8) as pool:
            list(pool.map(drop, names))


def _entry_files(spark: SparkSession, path: str, schema: str) -> list[str]:
    """The entries' files, as ``entry=<id>/<file>``; no file is opened."""
    return ["/".join(unquote(f).rsplit("/", 2)[1:]) for f in spark.read.schema(schema).parquet(path).inputFiles()]


def _merged_files(spark: SparkSession, store: _Store, generation: str | None) -> set[str]:
    if generation is None:
        return set()
    return {r["file"] for r in spark.read.schema("file string").parquet(str(store.at(MERGED, generation, "files"))).toLocalIterator()}


def _state(spark: SparkSession, store: _Store, path: str, schema: str) -> tuple[str | None, list[str], list[str]]:
    """(generation, files of entries that it took in, files of entries beside it), all as of one moment.

    Files go only when a generation that names them has been finished, so a
    listing is whole if the newest generation is the same before and after it.
    """
    while True:
        generation = store.newest()
        files = _entry_files(spark, path, schema)
        if store.newest() == generation:
            merged = _merged_files(spark, store, generation)
            return generation, [f for f in files if f in merged], [f for f in files if f not in merged]


def _rows(spark: SparkSession, store: _Store, path: str, schema: str, generation: str | None, live: list[str]) -> DataFrame:
    """The table's rows with the entry of each."""
    columns = column_names(schema)
    parts = []
    if live:
        entry = F.regexp_extract(F.col("_metadata.file_path"), "/entry=([^/]*)/[^/]*$", 1)
        parts.append(spark.read.schema(schema).parquet(*[join_path(path, f) for f in live]).select(*columns, entry.alias(ENTRY)))
    if generation is not None:
        merged = spark.read.schema(f"{schema}, {ENTRY} string").parquet(str(store.at(MERGED, generation, "rows")))
        # An entry that was written anew stands for its merged rows.
        parts.append(merged.join(parts[0].select(ENTRY).distinct(), ENTRY, "left_anti").select(*columns, ENTRY) if parts else merged)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A run table, or an empty frame of ``schema`` before the first entry.

    Only a missing folder counts as no entry; one that can't be read is an error.
    """
    path, columns = join_path(root, name), column_names(schema)
    store = _Store(spark, path)
    try:
        if store.newest() is None:
            found = spark.read.parquet(path).select(*columns)
            if store.newest() is None:
                return found
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    generation, _, live = _state(spark, store, path, schema)
    return _rows(spark, store, path, schema, generation, live).select(*columns)


def compact_table(spark: SparkSession, root: str, name: str, schema: str, keep_seconds: float = 86_400.0) -> int:
    """Merge all entries of a table into one set of files; returns how many files were taken in.

    Callers may write and read meanwhile; entries that arrive meanwhile stay
    beside the generation until the next compaction. Of two compactions at the
    same time one gives up. Files that a generation older than
    ``keep_seconds`` took in, and generations before it, are deleted:
    ``keep_seconds`` has to exceed the time from a reader's look at the table to
    the end of its query (0 only if nothing reads meanwhile). A reader that is
    slower than that fails on a missing file; it never gets fewer rows.
    """
    path = join_path(root, name)
    store = _Store(spark, path)
    if not store.files.exists(store.at()):
        return 0
    generation, merged, live = _state(spark, store, path, schema)
    if live:
        number = 1 + (int(generation.split("-")[0]) if generation else 0)
        new = f"{number:012d}-{uuid.uuid4().hex}"
        rows = _rows(spark, store, path, schema, generation, live)
        files = 1 + rows.count() // FILE_ROWS
        rows.repartition(files, ENTRY).write.parquet(str(store.at(MERGED, new, "rows")))
        spark.createDataFrame([(f,) for f in merged + live], "file string").coalesce(1).write.parquet(str(store.at(MERGED, new, "files")))
        if store.newest() != generation:
            store.drop_generation(new)
            return 0
        store.finish(new)
    # The newest generation that every reader of an earlier one is done with.
    done = store.generations()
    settled = max((g for g, at in done.items() if time.time() - at >= keep_seconds), default=None)
    if settled is not None:
        gone = _merged_files(spark, store, settled)
        store.drop_files([f for f in merged + live if f in gone])
        for old in done:
            if old < settled:
                store.drop_generation(old)
    return len(live)

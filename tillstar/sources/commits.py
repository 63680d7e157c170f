"""Tables of immutable folders, published by numbered commits.

::

    root/data/_part=00000007-<id>/[year=2024/month=3/]*.parquet    written once, never changed
    root/log/00000007.json                                       which folders are the table, from commit 7 on

A commit lists every folder of the table, so it can take some over from the one before and add or leave out others. Its file
appears whole and only if its number is free: a writer takes the number after the one it began with, so of two
that began alike one wins and the other gets ConcurrentWrite. Readers see the newest commit; no clock is involved.

A part's name begins with the number that its writer aims at. Once that number is taken, a part outside the kept
commits can never become visible, which is how ``collect`` tells leftovers of failed writers from the work of running ones.

Commits need a store on which a hard link (local and mounted folders) or a rename (HDFS and its kin) refuses an
existing name. Layout columns must have values that need no escaping in a path, such as numbers.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstar.sources.workspace import by_partition

KEPT_COMMITS = 3
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentWrite(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


@dataclass(frozen=True)
class Commit:
    """One state of a table. ``folders`` maps each folder below data to its number of rows."""

    number: int
    schema: StructType
    layout: tuple[str, ...]
    folders: dict[str, int]
    notes: dict[str, str] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(self.folders.values())


class CommittedTable:
    """The table under a root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # --- reading -------------------------------------------------------------------------------

    def numbers(self) -> list[int]:
        """Commits that are there, oldest first."""
        names = (name for name, _ in self._children(f"{self.root}/log"))
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())

    def commit(self, number: int) -> Commit:
        store, path = self._store(self._log(number))
        stream = store.open(path)
        held = json.loads(bytes(stream.readAllBytes()).decode())
        stream.close()
        folders = dict(zip(held["folders"], held["rows"], strict=True))
        return Commit(number, StructType.fromJson(json.loads(held["schema"])), tuple(held["layout"]), folders, held["notes"])

    def latest(self) -> Commit | None:
        found = self.numbers()
        return self.commit(found[-1]) if found else None

    def read(self, commit: Commit | None = None, only: Callable[[str], bool] | None = None) -> DataFrame:
        """Rows of a commit, the newest by default; ``only`` picks folders by name. A table without rows can be read."""
        commit = commit or self.latest()
        if commit is None:
            raise LookupError(f"nothing has been committed under {self.root}")
        folders = [f"{self.root}/data/{f}" for f in commit.folders if only is None or only(f)]
        if not folders:
            return self.spark.createDataFrame([], commit.schema)
        reader = self.spark.read.schema(commit.schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*folders).select(*commit.schema.names)

    def statement(self, commit: Commit | None = None) -> str:
        """SQL that reads the newest commit whenever it runs: folders are listed anew, and the log's own list prunes them."""
        commit = commit or self.latest()
        typed = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in commit.schema)
        levels = [f"'_part=', _part", *(f"'/{c}=', coalesce(CAST(`{c}` AS STRING), '{NULL_FOLDER}')" for c in commit.layout)]
        newest = f"SELECT max_by(folders, number) FROM json.`{self.root}/log`"
        return f"SELECT {typed} FROM parquet.`{self.root}/data` WHERE array_contains(({newest}), concat({', '.join(levels)}))"

    # --- writing -------------------------------------------------------------------------------

    def write(
        self,
        rows: DataFrame,
        layout: Sequence[str] = (),
        keep: Callable[[str], bool] | None = None,
        check: Callable[[DataFrame], dict[str, str]] | None = None,
        hidden: Sequence[str] = (),
        arrange: bool = True,
        rows_per_file: int = 0,
        base: Commit | None = None,
        extra: dict[str, str] | None = None,
        retained: int = KEPT_COMMITS,
    ) -> Commit:
        """Write rows as a new part and commit it.

        ``keep`` names folders of the base commit that stay; by default the new part replaces all. ``check`` sees the whole
        table to be before anybody else does, may raise, and returns notes for the commit. ``hidden`` columns
        lay the part out without belonging to the table. What fails leaves no files. Pass as ``base`` the commit that ``rows``
        was made from, so that a commit in between is noticed. ``extra`` are notes that are known beforehand; ``retained`` is the number of commits that stay.
        """
        base = base or self.latest()
        number = base.number + 1 if base else 1
        part = f"_part={number:08d}-{uuid.uuid4().hex}"
        location = f"{self.root}/data/{part}"
        schema = StructType([f for f in rows.schema if f.name not in hidden])
        try:
            writer = (by_partition(rows, tuple(layout)) if arrange else rows).write
            if rows_per_file:
                writer = writer.option("maxRecordsPerFile", rows_per_file)
            writer.parquet(location, mode="errorifexists", partitionBy=list(layout))
            written = self.spark.read.schema(rows.schema).parquet(location)
            # Counts come from the written footers, which a recomputed task cannot inflate.
            counted = written.groupBy(*[F.col(c).cast("string") for c in layout]).count().collect()
            made = {}
            for *values, count in counted:
                made["/".join([part, *(f"{c}={NULL_FOLDER if v is None else v}" for c, v in zip(layout, values, strict=True))])] = count
            kept = {f: n for f, n in base.folders.items() if keep(f)} if base and keep else {}
            whole = written.drop(*hidden)
            if kept:
                whole = self.read(base, kept.__contains__).unionByName(whole)
            notes = check(whole) if check else {}
            if not made and not kept:
                # One file without rows holds the schema for readers that infer it.
                made["/".join([part, *(f"{c}={NULL_FOLDER}" for c in layout)])] = 0
                rows.limit(0).drop(*layout).write.parquet(f"{self.root}/data/{next(iter(made))}", mode="append")
            done = Commit(number, schema, tuple(layout), kept | made, notes | dict(extra or {}))
            self._publish(done)
        except PySparkException as error:
            self._delete(location)
            if self.numbers()[-1:] >= [number]:
                raise ConcurrentWrite(f"{self.root}: commit {number} was made by another writer") from error
            raise
        except BaseException:
            self._delete(location)
            raise
        self.collect(retained)
        return done

    def _publish(self, commit: Commit) -> None:
        held = {
            "number": commit.number, "schema": commit.schema.json(), "layout": list(commit.layout),
            "folders": list(commit.folders), "rows": list(commit.folders.values()), "notes": commit.notes,
        }
        draft, final = f"{self.root}/log/.{uuid.uuid4().hex}", self._log(commit.number)
        store, path = self._store(draft)
        text = json.dumps(held).encode()
        if store.getScheme() == "file":
            # Hadoop's local rename would replace a file; a link refuses.
            here, there = (self._store(p)[1].toUri().getPath() for p in (draft, final))
            os.makedirs(os.path.dirname(here), exist_ok=True)
            with open(here, "wb") as file:
                file.write(text)
            try:
                os.link(here, there)
                free = True
            except FileExistsError:
                free = False
            os.unlink(here)
        else:
            stream = store.create(path, False)
            stream.write(bytearray(text))
            stream.close()
            free = store.rename(path, self._store(final)[1])
            if not free:
                store.delete(path, False)
        if not free:
            raise ConcurrentWrite(f"{self.root}: commit {commit.number} was made by another writer")

    def collect(self, keep: int = KEPT_COMMITS) -> list[str]:
        """Drop old commits and every folder that no kept commit lists and no running writer can still commit."""
        found = self.numbers()
        if not found:
            return []
        gone = [self._log(n) for n in found[:-keep]]
        kept = [self.commit(n) for n in found[-keep:]]
        used = {folder for commit in kept for folder in commit.folders}
        depth = max(len(commit.layout) for commit in kept)

        def leftovers(folder: str, level: int) -> list[str]:
            if folder in used:
                return []
            if level == depth or not any(f.startswith(folder + "/") for f in used):
                return [f"{self.root}/data/{folder}"]
            inner = [name for name, is_folder in self._children(f"{self.root}/data/{folder}") if is_folder]
            return [x for name in inner for x in leftovers(f"{folder}/{name}", level + 1)]

        for name, _ in self._children(f"{self.root}/data"):
            if name.startswith("_part=") and int(name[6:14]) <= found[-1]:
                gone += leftovers(name, 0)
        for path in gone:
            self._delete(path)
        return gone

    # --- store ---------------------------------------------------------------------------------

    def _log(self, number: int) -> str:
        return f"{self.root}/log/{number:08d}.json"

    def _store(self, path: str) -> tuple:
        """Hadoop's view of the store that holds a path."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        store = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return store, store.makeQualified(hadoop)

    def _children(self, path: str) -> list[tuple[str, bool]]:
        """Names in a folder, and which are folders."""
        store, folder = self._store(path)
        if not store.exists(folder):
            return []
        return sorted((status.getPath().getName(), status.isDirectory()) for status in store.listStatus(folder))

    def _delete(self, path: str) -> None:
        store, folder = self._store(path)
        store.delete(folder, True)

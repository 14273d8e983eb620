"""Versions of a folder of tables: what a load wrote is seen by readers all at once, or never.

Below the root every table has a folder, and every write of a load makes a new part of it,
``lot=<name>``, in which partitioned tables have their own folders.  Nothing is ever overwritten.  A
version is one small file under ``_versions`` that lists each table's parts; the highest
number is the current one.  A load writes its parts first and its version last, by a rename,
so a load that breaks leaves parts that no version names: readers do not see them, the load can
simply be run again, and ``sweep`` removes them.

A version holds a line for a part of a table or for a folder in it (country and year), not
for a file, so it stays small; files are listed by the scans that read them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSIONS = "_versions"


class ConcurrentLoad(RuntimeError):
    """Another load published a version in the meantime."""


class Folder:
    """The few file operations that are needed, on whatever file system holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self._path("/".join([self.root, *names]))

    def children(self, *names: str, folders: bool = True) -> list[str]:
        path = self.at(*names)
        if not self.fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path) if s.isDirectory() == folders)

    def read_text(self, *names: str) -> str:
        stream = self.fs.open(self.at(*names))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, text: str, *names: str) -> bool:
        """Writes beside the place and renames; False if the place is taken."""
        place, beside = self.at(*names), self.at(*names[:-1], f".{names[-1]}-{uuid.uuid4().hex}")
        out = self.fs.create(beside, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if not self.fs.exists(place) and self.fs.rename(beside, place):
            return True
        self.fs.delete(beside, False)
        return False

    def remove(self, *names: str) -> None:
        self.fs.delete(self.at(*names), True)


def _leaves(folder: Folder, depth: int, *names: str) -> list[str]:
    """Folders ``depth`` levels below, as paths relative to the first name's folder."""
    if depth == 0:
        return ["/".join(names[1:])]
    below = [c for c in folder.children(*names) if "=" in c]
    return [leaf for c in below for leaf in _leaves(folder, depth - 1, *names, c)]


class Snapshot:
    """One version's tables."""

    def __init__(self, folder: Folder, version: int, parts: dict[str, list[str]]):
        self.folder, self.version, self.parts = folder, version, parts

    def has(self, table: str) -> bool:
        return table in self.parts

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table with the columns of ``schema``; partition columns may be among them or not.

        Without a schema it is that of the files, with the partition columns and without the lot.
        """
        spark = self.folder.spark
        base = f"{self.folder.root}/{table}"
        paths = [f"{base}/{part}" for part in self.parts.get(table, [])]
        if schema is None:
            return spark.read.option("basePath", base).parquet(*paths).drop("lot")
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())


class Batch(Snapshot):
    """A version in the making: reads what is published and what it has written itself."""

    def __init__(self, base: Snapshot):
        super().__init__(base.folder, base.version + 1, {t: list(p) for t, p in base.parts.items()})
        self.base, self._lots = base, 0
        self._name = uuid.uuid4().hex[:8]

    def append(self, table: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Writes ``rows`` as a new part; a table without rows becomes a table all the same."""
        lot = f"lot={self.version:06d}-{self._name}-{self._lots:02d}"
        self._lots += 1
        rows.write.mode("error").partitionBy(*partition_by).parquet(f"{self.folder.root}/{table}/{lot}", compression="zstd")
        self.parts.setdefault(table, []).extend(_leaves(self.folder, len(partition_by), table, lot))

    def drop(self, table: str, folders: Sequence[str]) -> None:
        """Leaves out the parts that end in one of ``folders``, such as id_pays=1/annee=2005."""
        ends = tuple(f"/{f}" for f in folders)
        if table in self.parts and ends:
            self.parts[table] = [p for p in self.parts[table] if not p.endswith(ends)]

    def replace(self, table: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """The table is ``rows`` alone from this version on; rows read from it may be among them."""
        before = self.parts.pop(table, [])
        try:
            self.append(table, rows, partition_by)
        except Exception:
            self.parts[table] = before
            raise

    def publish(self) -> Snapshot:
        text = json.dumps({"version": self.version, "tables": self.parts}, indent=1)
        self.folder.fs.mkdirs(self.folder.at(VERSIONS))
        if latest(self.folder).version != self.base.version or not self.folder.write_text(text, VERSIONS, f"{self.version:08d}.json"):
            raise ConcurrentLoad(f"version {self.version} of {self.folder.root} is there already")
        return Snapshot(self.folder, self.version, self.parts)


def numbers(folder: Folder) -> list[int]:
    return [int(n[:-5]) for n in folder.children(VERSIONS, folders=False) if n.endswith(".json") and n[:-5].isdigit()]


def opened(folder: Folder, version: int) -> Snapshot:
    return Snapshot(folder, version, json.loads(folder.read_text(VERSIONS, f"{version:08d}.json"))["tables"])


def latest(folder: Folder) -> Snapshot:
    """The current version; number 0 without tables while nothing is published."""
    there = numbers(folder)
    return opened(folder, max(there)) if there else Snapshot(folder, 0, {})


def sweep(folder: Folder, keep: int = 2) -> list[str]:
    """Removes versions before the last ``keep`` and the parts no kept version names; gives what it removed.

    To be run while no load is under way.  Readers of removed versions fail.
    """
    there = sorted(numbers(folder))
    kept = [opened(folder, v) for v in there[-keep:]]
    used = {(t, part.split("/")[0]) for s in kept for t, parts in s.parts.items() for part in parts}
    gone = [(VERSIONS, f"{v:08d}.json") for v in there[:-keep]]
    gone += [(t, lot) for t in folder.children() if t != VERSIONS for lot in folder.children(t) if lot.startswith("lot=") and (t, lot) not in used]
    for names in gone:
        folder.remove(*names)
    return ["/".join(names) for names in gone]

"""Listing of a large object tree in tasks (MIG-1).

Spark's file sources list a tree into an index that the driver holds, an
entry for every object. Here a listing is data: the prefixes of one level are
rows, range-partitioned over tasks that list them and return their entries;
sub-prefixes are the rows of the next level. Every level is stored, so the
driver knows two counts a level and no object. The number of rounds is the
depth of the tree, not its size.

A listing can be brought up to date: a prefix whose modification time is that
of the previous inventory is not listed again, its entries are taken over,
and only its sub-prefixes are asked for their times. Stores that keep no time for a
prefix are listed whole.

Objects are reached through ``pyarrow.fs``, so keys may hold characters that
Hadoop paths do not take (a colon).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as afs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import shared_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this package

ENTRY = "parent string, path string, is_dir boolean, size bigint, modified timestamp, listed boolean"
PREFIX = "path string, modified timestamp"
PREFIXES_PER_TASK = 64
ENTRIES_PER_BATCH = 10_000
CONTENT_PER_BATCH = 4 << 20


def store(root: str) -> tuple[afs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    if root.startswith("file:"):
        root = "/" + root[5:].lstrip("/")
    if "://" not in root:
        return afs.LocalFileSystem(), root.rstrip("/") or "/"
    parts = urlsplit(root)
    uri = root if parts.scheme not in ("s3a", "s3n") else "s3" + root[len(parts.scheme):]
    found, path = afs.FileSystem.from_uri(uri)
    return found, path.rstrip("/") or "/"


def _entries(infos: list[afs.FileInfo], parent: list[str], listed: bool) -> Iterator[pa.RecordBatch]:
    keep = [(p, i) for p, i in zip(parent, infos, strict=True) if i.type in (afs.FileType.File, afs.FileType.Directory)]
    for at in range(0, len(keep), ENTRIES_PER_BATCH):
        part = keep[at:at + ENTRIES_PER_BATCH]
        yield pa.RecordBatch.from_arrays([
            pa.array([p for p, _ in part], pa.string()), pa.array([i.path for _, i in part], pa.string()),
            pa.array([i.type == afs.FileType.Directory for _, i in part], pa.bool_()), pa.array([i.size for _, i in part], pa.int64()),
            pa.array([None if i.mtime_ns is None else i.mtime_ns // 1000 for _, i in part], pa.int64()).cast(pa.timestamp("us", tz="UTC")),
            pa.array([listed] * len(part), pa.bool_())], names=["parent", "path", "is_dir", "size", "modified", "listed"])


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _dealt(prefixes: DataFrame, n: int) -> DataFrame:
    return prefixes.repartitionByRange(max(1, -(-n // PREFIXES_PER_TASK)), "path")


def _list(root: str, prefixes: DataFrame, n: int) -> DataFrame:
    """The entries of some prefixes, one listing each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = store(root)
        for b in batches:
            for prefix in b.column(0).to_pylist():
                infos = files.get_file_info(afs.FileSelector(prefix, allow_not_found=True))
                yield from _entries(infos, [prefix] * len(infos), listed=True)
    return _dealt(prefixes.select("path"), n).mapInArrow(run, ENTRY)


def _times(root: str, known: DataFrame, n: int) -> DataFrame:
    """Entries of prefixes as they are now, in place of what the previous
    inventory says; those that are gone have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = store(root)
        for b in batches:
            if b.num_rows:
                yield from _entries(files.get_file_info(b.column(0).to_pylist()), b.column(1).to_pylist(), listed=False)
    return _dealt(known.select("path", "parent"), n).mapInArrow(run, ENTRY)


def inventory(spark: SparkSession, root: str, previous: DataFrame | None = None) -> DataFrame:
    """All entries below ``root`` (ENTRY): objects and prefixes; ``listed`` tells
    whether the entry's parent was listed now or taken over from ``previous``.
    A root that is not there has no entries. Stored in the shared folder."""
    folder = shared_path(spark, "inventory")
    files, path = store(root)
    top = files.get_file_info(path)
    time = None if top.mtime_ns is None else top.mtime_ns // 1000
    work = spark.createDataFrame([(path, time)], "path string, t long").select("path", F.timestamp_micros("t").alias("modified"))
    before = None
    if previous is not None:
        # the time a prefix had when it was listed; that of the root stands in no entry
        before = previous.where("is_dir").select("path", F.col("modified").alias("then"))
    depth, out = 0, None
    while True:
        n = work.count()
        if not n:
            return out if out is not None else spark.createDataFrame([], ENTRY)
        if before is None:
            level = _list(root, work, n)
        else:
            same = work.join(before, "path").where(F.col("modified") == F.col("then")).select("path")
            same = _stored(same, f"{folder}/same-{depth}")
            changed = work.join(same, "path", "left_anti")
            kept = previous.join(same.withColumnRenamed("path", "parent"), "parent")
            level = _list(root, changed, n).unionByName(kept.where("NOT is_dir").withColumn("listed", F.lit(False)).select(*previous.columns)) \
                .unionByName(_times(root, kept.where("is_dir"), n))
        level = _stored(level, f"{folder}/level-{depth}")
        out = level if out is None else out.unionByName(level)
        work, depth = level.where("is_dir").select("path", "modified"), depth + 1


def contents(root: str, objects: DataFrame, max_bytes: int = CONTENT_PER_BATCH) -> DataFrame:
    """(path, content) of objects, read in the tasks that hold their rows;
    a batch ends after ``max_bytes`` of content, so a task holds one object more than that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = store(root)
        held: list[tuple[str, bytes]] = []
        for b in batches:
            for path in b.column(0).to_pylist():
                with files.open_input_stream(path) as f:
                    held.append((path, f.read()))
                if sum(len(c) for _, c in held) >= max_bytes:
                    yield _content(held)
                    held = []
        if held:
            yield _content(held)

    def _content(held: list[tuple[str, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in held], pa.string()), pa.array([c for _, c in held], pa.binary())], names=["path", "content"])
    return objects.select("path").mapInArrow(run, "path string, content binary")

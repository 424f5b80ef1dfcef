"""File trees listed and read on the executors.

``file_tree`` is a Python data source: the driver looks only at the folders at
the top of the tree, deals them out as shards, and tasks walk them. It emits
every regular file, hidden and empty ones included. ``read_contents`` opens
files by path in the tasks, after whatever filter or anti join came before.
Both reach any file system that pyarrow opens. ``with_digest`` digests files of
any size a piece at a time.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint"
#: A Spark value of bytes must stay below this.
MOST_BYTES = (1 << 31) - 64
#: Bytes of files that are held before they are passed on; a larger file goes alone.
BATCH_BYTES = 1 << 25
#: Listed files that are passed on at a time.
BATCH_FILES = 10_000
#: Bytes of a file that are held at a time while it is digested.
PIECE_BYTES = 1 << 22
_LISTED = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", tz="UTC")), ("length", pa.int64())])


def resolved(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark gives it: without one, that of the default file system; a ``viewfs`` path is the one it is mounted on."""
    conf, folder_of = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    if ":" not in path.split("/")[0]:
        if spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf).getScheme() == "file":
            return "file:" + os.path.abspath(path)
        path = folder_of(path).getFileSystem(conf).makeQualified(folder_of(path)).toString()
    if not path.startswith("viewfs:"):
        return path.rstrip("/") or path
    folder, below = folder_of(path), ""
    mounts = folder.getFileSystem(conf)
    while not mounts.exists(folder):  # only what exists can be resolved
        folder, below = folder.getParent(), f"/{folder.getName()}{below}"
    return mounts.resolvePath(folder).toString().rstrip("/") + below


def _is_shared(spark: SparkSession, uri: str) -> bool:
    """Whether a local ``uri`` lies in a folder that the session names as shared: the one for checkpoints or the warehouse."""
    roots = [spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir(), spark.conf.get("spark.sql.warehouse.dir", None)]
    plain = lambda u: "/" + u.removeprefix("file:").strip("/") + "/"
    return any(plain(uri).startswith(plain(resolved(spark, r))) for r in roots if r)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as tasks can open it (``resolved``). Without a scheme it may name a local folder only in a local
    session or under the folders that a cluster's session shares."""
    uri = resolved(spark, path)
    if ":" not in path.split("/")[0] and uri.startswith("file:") and not spark.sparkContext.master.startswith("local") and not _is_shared(spark, uri):
        raise ValueError(f"{path!r} has no scheme: name the file system that the executors share")
    return uri


def open_path(uri: str):
    """(file system, path in it, what precedes that path in uris) of a qualified uri."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/"), "file:"
    filesystem, inner = fs.FileSystem.from_uri(uri)
    return filesystem, inner, uri[:len(uri) - len(inner)] if uri.endswith(inner) else uri.split("://")[0] + "://"


@dataclass
class Shard(InputPartition):
    """Folders that one task lists; those in ``deep`` with everything below them."""

    flat: list[str]
    deep: list[str]


class FileTree(DataSource):
    """``spark.read.format("file_tree").option("root", uri).option("shards", n).load()``: every regular file below ``root``."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FileTreeReader(self.options["root"], int(self.options.get("shards", "64")))


class FileTreeReader(DataSourceReader):
    def __init__(self, root: str, shards: int) -> None:
        self.root, self.shards = root, shards

    def partitions(self) -> list[Shard]:
        """Folders level by level until there are enough to deal out; files are listed by the tasks."""
        from pyarrow import fs

        filesystem, root, _ = open_path(self.root)
        if filesystem.get_file_info(root).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no folder at {self.root}")
        flat: list[str] = []
        frontier = [root]
        while frontier and len(frontier) < self.shards:
            below = [i.path for d in frontier for i in filesystem.get_file_info(fs.FileSelector(d)) if i.type == fs.FileType.Directory]
            flat += frontier
            frontier = below
        n = max(1, min(self.shards, len(flat) + len(frontier)))
        return [Shard(flat[k::n], frontier[k::n]) for k in range(n)]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, _, before = open_path(self.root)
        todo = [(d, False) for d in partition.flat] + [(d, True) for d in partition.deep]
        while todo:  # one folder at a time
            folder, deep = todo.pop()
            found = filesystem.get_file_info(fs.FileSelector(folder))
            files = [i for i in found if i.type == fs.FileType.File]
            if deep:
                todo += [(i.path, True) for i in found if i.type == fs.FileType.Directory]
            for k in range(0, len(files), BATCH_FILES):
                some = files[k:k + BATCH_FILES]
                yield pa.RecordBatch.from_arrays([pa.array([before + i.path for i in some]),
                                                  pa.array([i.mtime for i in some], _LISTED.types[1]),
                                                  pa.array([i.size for i in some], pa.int64())], schema=_LISTED)


def list_tree(spark: SparkSession, path: str, shards: int | None = None) -> DataFrame:
    """``path, modificationTime, length`` of every regular file below ``path``."""
    spark.dataSource.register(FileTree)
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.format("file_tree").option("root", qualified(spark, path)).option("shards", shards).load()


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*_LISTED, ("content", pa.binary()), ("error", pa.string())])
    opened: dict[str, tuple] = {}

    def read(uri: str, length: int) -> tuple[bytes | None, str | None]:
        if length > MOST_BYTES:
            return None, f"{uri}: {length} bytes do not fit into one value"
        scheme = "/".join(uri.split("/")[:3]) if "://" in uri else uri.split(":")[0]
        try:
            if scheme not in opened:
                opened[scheme] = open_path(uri)
            filesystem, _, before = opened[scheme]
            with filesystem.open_input_stream(uri.removeprefix(before)) as f:
                return f.read(), None
        except OSError as exc:
            return None, f"{uri}: {exc}"

    for batch in batches:
        rows, size = [], 0
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append((*row, *read(row[0], row[2])))
            size += row[2]
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def read_contents(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Listed files with ``content`` and, where a file cannot be read, ``error``.

    Paths are dealt over ``tasks`` tasks by hash (the session's number of shuffle partitions unless given): a
    fixed number, since a table of paths is small whatever its files weigh.
    """
    tasks = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (files.select("path", "modificationTime", "length").repartition(tasks, "path")
            .mapInArrow(_contents, LISTING_SCHEMA + ", content binary, error string"))


def md5_in_pieces(stream) -> str:
    """MD5 of all that ``stream`` gives; only a piece is held at a time."""
    digest = hashlib.md5(usedforsecurity=False)
    while piece := stream.read(PIECE_BYTES):
        digest.update(piece)
    return digest.hexdigest()


def _as_opened(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """What the paths that Spark lists under ``path`` (which may hold wildcards) begin with, and the uri of the same folder
    for ``open_path``; None where pyarrow does not open that."""
    from pyarrow import fs

    conf, folder = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path(path)
    while any(c in folder.toString() for c in "{}[]*?\\"):
        folder = folder.getParent()
    listed = folder.getFileSystem(conf).makeQualified(folder).toString().rstrip("/")
    root = resolved(spark, folder.toString())
    try:
        filesystem, inner, before = open_path(root)
        there = before + inner == root and filesystem.get_file_info(inner).type != fs.FileType.NotFound
    except (OSError, ValueError, NotImplementedError):
        return None
    return (listed, root) if there or root.startswith("file:") else None


def _md5_of(filesystem, inner: str, skipped: set[str]) -> str | None:
    """MD5 of one file; None if it cannot be read and ``skipped`` names that, as Spark's readers skip it."""
    try:
        with filesystem.open_input_stream(inner, compression=None) as f:
            return md5_in_pieces(f)
    except PermissionError:
        raise
    except FileNotFoundError:
        if "ignoreMissingFiles" not in skipped:
            raise
    except OSError:
        if "ignoreCorruptFiles" not in skipped:
            raise
    return None


def with_digest(raw: DataFrame, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """``binaryFile`` rows read from ``path`` (with the reader's ``options``) and ``content_md5``, the MD5 of each whole file.

    Tasks read the files a piece at a time, so memory does not grow with a file; only on file systems that pyarrow does not
    open it is taken from Spark's ``content``, which holds a file whole. Checksum files beside local ones are not looked at.
    """
    spark = raw.sparkSession
    found = _as_opened(spark, path)
    if found is None:
        return raw.withColumn("content_md5", F.md5("content"))
    listed, root = found
    given = {k.lower(): v for k, v in (options or {}).items()}
    skipped = {n for n in ("ignoreMissingFiles", "ignoreCorruptFiles")
               if str(given.get(n.lower(), spark.conf.get(f"spark.sql.files.{n}"))).lower() == "true"}

    @F.arrow_udf("string")
    def read_md5(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        filesystem, _, before = open_path(root)

        def inner(uri: str) -> str:
            uri = root + uri[len(listed):] if uri.startswith(listed + "/") or uri == listed else uri
            if not uri.startswith(before):
                raise ValueError(f"{uri!r} does not lie under {root!r}")
            return uri.removeprefix(before)

        for batch in batches:
            yield pa.array([_md5_of(filesystem, inner(u), skipped) for u in batch.to_pylist()], pa.string())

    if not skipped:
        return raw.withColumn("content_md5", read_md5("path"))
    # not deterministic: else the filter would go below and read each file once more
    return raw.withColumn("content_md5", read_md5.asNondeterministic()("path")).where("content_md5 is not null")

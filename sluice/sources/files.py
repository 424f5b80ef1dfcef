"""File trees as documents, glob filters, content toggle, seen sets.

``scan_files`` reads with Spark's ``binaryFile`` source, so ``content`` is
only read when it is projected (a file is then one value, held whole:
``digest=True`` gives its MD5 without that); that source skips files of zero
length and those whose name starts with ``.`` or ``_``. ``scan_tree`` and the
incremental passes list and read on the executors (``tree``) and skip none.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import fresh_path
from sluice.sources.documents import add_errors, string_map, to_documents
from sluice.sources.tree import LISTING_SCHEMA, list_tree, read_contents, resolved, with_digest

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def glob_regex(pattern: str) -> str:
    """A path glob (may contain ``/``) as a regex matching the end of a path."""
    body = fnmatch.translate(pattern)
    # fnmatch gives ``(?s:...)\\Z``; match it against the path tail instead.
    if body.endswith(r"\Z"):
        body = body[:-2]
    return r"(^|/)" + body.replace(".*", "[^/]*") + "$"


def read_files(spark: SparkSession, path: str, patterns: Sequence[str] | None = None,
               recursive: bool = True, stream: bool = False, options: dict[str, str] | None = None,
               file_format: str = "binaryFile", schema: str | None = None) -> DataFrame:
    """Raw ``binaryFile`` rows (``path, modificationTime, length, content``); of other formats, rows of ``schema`` and ``_file``, their file's path."""
    patterns = list(dict.fromkeys(patterns or ["*"]))
    reader = spark.readStream.schema(schema or BINARY_FILE_SCHEMA) if stream else spark.read
    reader = reader.format(file_format)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    simple = all("/" not in p for p in patterns)
    if simple and patterns != ["*"]:
        reader = reader.option("pathGlobFilter", patterns[0] if len(patterns) == 1 else "{" + ",".join(patterns) + "}")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    raw = reader.load(path)
    file = "path" if file_format == "binaryFile" else "_file"
    if file == "_file":
        raw = raw.withColumn("_file", F.col("_metadata.file_path"))
    if not simple:
        hit = None
        for p in patterns:
            cond = F.col(file).rlike(glob_regex(p))
            hit = cond if hit is None else hit | cond
        raw = raw.where(hit)
    return raw


def files_to_documents(raw: DataFrame, include_content: bool = True, source: str = "files",
                       ingested_at: float | None = None, keep: Sequence[str] = ()) -> DataFrame:
    meta = string_map({
        "source": F.lit(source),
        "size_bytes": F.col("length"),
        "modified_at": F.unix_micros(F.col("modificationTime")) / F.lit(1_000_000.0),
    })
    return to_documents(raw, uri="path", content="content" if include_content else None,
                        metadata=meta, ingested_at=ingested_at, keep=["length", "modificationTime", *keep])


def scan_files(spark: SparkSession, path: str, patterns: Sequence[str] | None = None,
               include_content: bool = True, recursive: bool = True, exclude: Sequence[str] = (),
               ingested_at: float | None = None, ordered: bool = False, digest: bool = False) -> DataFrame:
    """Every regular file under ``path`` matching any pattern (union,
    de-duplicated), as documents. ``include_content=False`` keeps the rows
    with null content and never reads the bytes. ``exclude`` drops paths
    under the given prefixes (a state folder kept inside the tree).
    ``ordered`` sorts by path (a range shuffle; only for presentation).
    ``digest`` adds ``content_md5``, the MD5 of the whole file, read in pieces."""
    raw = _without(read_files(spark, path, patterns, recursive), exclude)
    docs = files_to_documents(with_digest(raw, path) if digest else raw, include_content, ingested_at=ingested_at,
                              keep=["content_md5"] if digest else [])
    return docs.orderBy("uri") if ordered else docs


def _without(raw: DataFrame, exclude: Sequence[str]) -> DataFrame:
    plain = F.regexp_replace("path", "^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/")
    for prefix in exclude:
        folder = re.sub("^([a-zA-Z][a-zA-Z0-9+.-]*:)?/*", "/", prefix.rstrip("/"))
        raw = raw.where(~(plain.startswith(folder + "/") | (plain == folder)))
    return raw


def _listing(spark: SparkSession, path: str, patterns: Sequence[str] | None, exclude: Sequence[str]) -> DataFrame:
    found = _without(list_tree(spark, path), [resolved(spark, p) for p in exclude])
    patterns = list(dict.fromkeys(patterns or ["*"]))
    return found if "*" in patterns else found.where(F.col("path").rlike("|".join(f"(?:{glob_regex(p)})" for p in patterns)))


def _read_documents(files: DataFrame, include_content: bool, ingested_at: float | None = None) -> DataFrame:
    """Documents of listed files; a file that cannot be read keeps its row, with the message in ``errors``."""
    if not include_content:
        return files_to_documents(files, False, ingested_at=ingested_at)
    raw = read_contents(files)
    docs = files_to_documents(raw, ingested_at=ingested_at, keep=["error"])
    return docs.withColumn("errors", add_errors(F.col("errors"), F.col("error"))).drop("error")


def scan_tree(spark: SparkSession, path: str, patterns: Sequence[str] | None = None, include_content: bool = True,
              exclude: Sequence[str] = (), ingested_at: float | None = None) -> DataFrame:
    """S2-S4 over ``tree``: every regular file, hidden and empty ones included, listed and read by the executors."""
    return _read_documents(_listing(spark, path, patterns, exclude), include_content, ingested_at)


def new_files(files: DataFrame, seen: DataFrame, key: str = "uri") -> DataFrame:
    """Rows whose ``uri`` is not in the seen set (a modified file is not new).

    An anti join on the key: the seen set grows with the data, so it is
    not broadcast blindly; AQE switches to a broadcast at run time when the
    seen side turns out small.
    """
    return files.join(seen.select(key), on=key, how="left_anti")


def load_seen(spark: SparkSession, path: str) -> DataFrame:
    """The stored seen set (empty when nothing was stored yet)."""
    try:
        return spark.read.parquet(path).select("uri")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "uri string")


def record_seen(emitted: DataFrame, path: str) -> None:
    """Append the emitted URIs to the seen set after the pass was written."""
    emitted.select("uri").write.mode("append").parquet(path)


def read_paths(spark: SparkSession, paths: Sequence[str], include_content: bool = True,
               ingested_at: float | None = None) -> DataFrame:
    """Documents for an explicit list of files (the bytes of only these files are read)."""
    if not paths:
        return files_to_documents(spark.createDataFrame([], BINARY_FILE_SCHEMA), include_content,
                                  ingested_at=ingested_at)
    return files_to_documents(spark.read.format("binaryFile").load(list(paths)), include_content,
                              ingested_at=ingested_at)


def pending_files(spark: SparkSession, path: str, state_path: str, patterns=None, max_files: int | None = None) -> DataFrame:
    """The files of one pass: those not in the seen set, written down (``path, modificationTime, length``).

    Found by an anti join on the executors from a listing that reads no bytes, and written under
    ``spark.checkpoint.dir``, so that the pass reads and then records exactly these. ``max_files`` takes the
    oldest files first and leaves the rest for the next pass.
    """
    seen = load_seen(spark, state_path).select(F.col("uri").alias("path"))
    fresh = new_files(_listing(spark, path, patterns, [state_path]), seen, "path")
    if max_files is not None:
        fresh = fresh.orderBy("modificationTime", "path").limit(max_files)
    target = fresh_path(spark, "pending")
    fresh.write.parquet(target)
    return spark.read.schema(LISTING_SCHEMA).parquet(target)


def incremental_scan(spark: SparkSession, path: str, state_path: str, patterns=None,
                     include_content: bool = True, max_files: int | None = None) -> DataFrame:
    """S5 as one call: documents for the files not seen yet. Call
    ``record_seen`` with the result once its sinks have committed (or use
    ``files_pass``, which does both)."""
    return _read_documents(pending_files(spark, path, state_path, patterns, max_files), include_content)


def files_pass(spark: SparkSession, path: str, state_path: str, write, patterns=None,
               include_content: bool = True, max_files: int | None = None) -> int:
    """S5 as one pass: the new files go to ``write`` (which must run them to
    their sinks); exactly those paths are added to the seen set after it
    returns, so a file landing during the write waits for the next pass.
    Returns how many files were new."""
    pending = pending_files(spark, path, state_path, patterns, max_files)
    n = pending.count()
    if n:
        write(_read_documents(pending, include_content))
        record_seen(pending.select(F.col("path").alias("uri")), state_path)
    return n

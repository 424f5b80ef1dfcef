"""K1-K4: table rows, JSON records, raw content copies, several sinks at once.

Writers are plain DataFrame writes: every task writes its own files, so
nothing is buffered on the driver. A *sink* is a callable
``(df, batch_id) -> None`` that must run the frame it is given to the end
(a write or any other action): run counters are observed on that action.

A ``TargetSink`` names its target. A flow gathers what all its pipelines
bring to one target and writes it in one job (``write_targets``), so an
overwriting target is replaced once per run, and a pipeline that brings
nothing loses its old rows. In a stream ``batch_id`` is the micro-batch id:
a path target keeps a ``batch_id=N`` folder per micro-batch, a catalog table
a partition per stream and micro-batch; writing one again replaces exactly
that, so a replay after a crash neither doubles nor leaves rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import extension_of
from sluice.session import delete_path, fresh_path, work_root
from sluice.sources.tree import open_path, qualified

Sink = Callable[[DataFrame, "int | None"], None]

#: Partition columns of a catalog table that streams write to.
COMMIT_COLUMNS = ("stream_id", "batch_id")


def extracted_json(extracted: Column, kind: str) -> Column:
    """JSON text of ``extracted``; null when it is null or empty."""
    if kind.startswith("map"):
        empty = F.size(extracted) == 0
    elif kind.startswith("struct<>"):
        empty = F.lit(True)
    else:
        empty = F.lit(False)
    return F.when(extracted.isNotNull() & ~empty, F.to_json(extracted, {"ignoreNullFields": "false"}))


def _extracted_type(df: DataFrame) -> str:
    return df.schema["extracted"].dataType.simpleString() if "extracted" in df.columns else ""


def table_rows(df: DataFrame, pipeline_name: str | Column | None = None, run_id: str = "") -> DataFrame:
    """K1 row: ``doc_id, uri, doc_type, ingested_at, metadata_json, extracted_json, pipeline_name, run_id``."""
    kind = _extracted_type(df)
    extracted = extracted_json(F.col("extracted"), kind) if kind else F.lit(None).cast("string")
    pipeline = (F.col("pipeline") if pipeline_name is None else
                pipeline_name if isinstance(pipeline_name, Column) else F.lit(pipeline_name))
    return df.select(
        "doc_id", "uri", F.col("doc_type").cast("string").alias("doc_type"), "ingested_at",
        F.to_json(F.col("metadata")).alias("metadata_json"),
        extracted.alias("extracted_json"),
        pipeline.cast("string").alias("pipeline_name"),
        F.lit(run_id).alias("run_id"),
    )


def json_records(df: DataFrame, pipeline_name: str | Column | None = None, run_id: str = "") -> DataFrame:
    """K2 record: the table row with nested ``metadata`` / ``extracted`` and ``errors``."""
    pipeline = (F.col("pipeline") if pipeline_name is None else
                pipeline_name if isinstance(pipeline_name, Column) else F.lit(pipeline_name))
    extracted = F.col("extracted") if "extracted" in df.columns else F.lit(None).cast("string")
    return df.select(
        "doc_id", "uri", "doc_type", "ingested_at", "metadata", extracted.alias("extracted"), "errors",
        pipeline.cast("string").alias("pipeline_name"), F.lit(run_id).alias("run_id"),
    )


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _target(path: str, batch_id: int | None) -> str:
    return path if batch_id is None else f"{path.rstrip('/')}/batch_id={batch_id}"


def write_table(df: DataFrame, table: str, mode: str = "append", fmt: str = "parquet",
                batch_id: int | None = None, partition_by: Sequence[str] = ()) -> None:
    """K1: write rows (already projected with ``table_rows``) to a table path or a catalog table.

    ``partition_by=["pipeline_name"]`` writes one folder per pipeline with no
    shuffle: each task writes the pipelines it holds, so a pipeline that
    receives a third of all documents does not land in one task.
    ``overwrite`` replaces the whole table. With ``batch_id`` the
    micro-batch's folder (path) or partition (catalog table, see
    ``commit_batch``) is replaced, whatever the mode.
    """
    if is_path(table):
        mode = mode if batch_id is None else "overwrite"
        _writer(df, mode, partition_by).format(fmt).save(_target(table, batch_id))
    elif batch_id is None:
        _writer(df, mode, partition_by).format(fmt).saveAsTable(table)
    else:
        commit_batch(df, table, fmt, batch_id)


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str] = ()):
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    return writer


def _stream_id(df: DataFrame) -> str:
    """Id of the streaming query that runs this code: the same after a restart from its checkpoint, another for another stream."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def commit_batch(df: DataFrame, table: str, fmt: str, batch_id: int) -> None:
    """Replace what micro-batch ``batch_id`` of the running stream has in a catalog table.

    The table is partitioned by ``stream_id`` and ``batch_id``; the list of its
    partitions is the record of what has been committed. A micro-batch that is
    replayed finds its own partition and replaces it, also with nothing, and
    several streams can write to one table.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}, stream_id STRING, batch_id BIGINT) USING {fmt} "
                  f"PARTITIONED BY ({', '.join(COMMIT_COLUMNS)})")
    columns = spark.catalog.listColumns(table)
    if tuple(c.name for c in columns if c.isPartition) != COMMIT_COLUMNS:
        raise ValueError(f"table {table} is not partitioned by {COMMIT_COLUMNS}: a replayed micro-batch could not find its rows")
    view = f"batch_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        names = ", ".join(f"`{c.name}`" for c in columns if not c.isPartition)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (stream_id = '{_stream_id(df)}', batch_id = {int(batch_id)}) "
                  f"SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def write_json(df: DataFrame, path: str, mode: str = "append", batch_id: int | None = None) -> None:
    """K2: JSON lines, many records per part file; nulls are written as ``null``.

    ``overwrite`` replaces the whole folder; with ``batch_id`` the micro-batch's folder is replaced.
    """
    _write_records([df], path, mode, batch_id)


def _write_records(records: Sequence[DataFrame], path: str, mode: str, batch_id: int | None) -> None:
    mode = mode if batch_id is None else "overwrite"
    path = _target(path, batch_id)
    if len({r.schema.simpleString() for r in records}) == 1:
        reduce(DataFrame.unionByName, records).write.mode(mode).option("ignoreNullFields", "false").json(path)
    else:  # pipelines with different ``extracted`` fields: the same lines, made before the union (in files named .txt)
        lines = [r.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")) for r in records]
        reduce(DataFrame.unionByName, lines).write.mode(mode).text(path)


def content_names(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """K3 projection: ``name = doc_id.ext`` (``bin`` without extension), only rows with content."""
    ext = extension_of(F.col("uri"))
    return (df.where(F.col("content").isNotNull())
              .select(*keep, F.concat(F.col("doc_id"), F.lit("."),
                               F.when(ext == "", F.lit("bin")).otherwise(ext)).alias("name"), "content"))


def write_content(df: DataFrame, path: str) -> None:
    """K3: copy raw bytes to ``path/<doc_id>.<ext>``, one file per document, by the executors."""
    write_files(content_names(df), path)


def write_files(files: DataFrame, path: str) -> None:
    """``content`` as the file ``name`` under ``path`` (any file system pyarrow opens; on a cluster with its scheme).

    Each file is written under a name of its own and then moved, so a lost
    task leaves no half file under a final name and a retry replaces it.
    """
    root = qualified(files.sparkSession, path)

    def write_partition(rows):
        filesystem, base, _ = open_path(root)
        filesystem.create_dir(base, recursive=True)
        for row in rows:
            part = f"{base}/.part-{uuid.uuid4().hex}"
            with filesystem.open_output_stream(part) as out:
                out.write(bytes(row["content"]))
            filesystem.move(part, f"{base}/{row['name']}")

    files.select("name", "content").foreachPartition(write_partition)


@contextmanager
def shared_rows(df: DataFrame, sinks: Sequence[Sink]) -> Iterator[DataFrame]:
    """``df`` computed once and written for several sinks, each of which reads back its own columns.

    The copy is a table under ``spark.checkpoint.dir``, deleted afterwards: a lost executor takes none of it along,
    and no executor holds whole rows. ``content`` is written only if a sink may read it. Rows that Parquet
    cannot hold (fields without a type, column names that differ in case only) are checkpointed instead.
    """
    spark = df.sparkSession
    if "content" in df.columns and all(isinstance(s, TargetSink) and not s.reads_content for s in parts_of(sinks)):
        df = df.drop("content")
    kinds = df.schema.simpleString()
    if "struct<>" in kinds or "void" in kinds or len({c.lower() for c in df.columns}) < len(df.columns):
        work_root(spark)
        yield df.checkpoint(eager=True)
        return
    path = fresh_path(spark, "rows")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def write_all(df: DataFrame, sinks: Sequence[Sink], batch_id: int | None = None) -> None:
    """K4: every sink in order over one computation of ``df``."""
    parts = parts_of(sinks)
    if len(parts) == 1:
        parts[0](df, batch_id)
    elif parts:
        with shared_rows(df, parts) as rows:
            for sink in parts:
                sink(rows, batch_id)


@dataclass(frozen=True)
class TargetSink:
    """A sink with a named target: ``rows`` projects what one pipeline brings, ``write`` puts all of it there in one job."""

    target: str
    mode: str
    kind: str
    rows: Callable[[DataFrame], DataFrame]
    write: Callable[[Sequence[DataFrame], "int | None"], None]
    reads_content: bool = False

    @property
    def key(self) -> tuple[str, str, str]:
        return self.kind, self.target, self.mode

    def __call__(self, df: DataFrame, batch_id: int | None = None) -> None:
        self.write([self.rows(df)], batch_id)


@dataclass(frozen=True)
class SinkGroup:
    """Several sinks that stand for one; flows and ``write_all`` see its parts."""

    sinks: Sequence[Sink]

    def __call__(self, df: DataFrame, batch_id: int | None = None) -> None:
        write_all(df, self.sinks, batch_id)


def parts_of(sinks: Sequence[Sink]) -> list[Sink]:
    """The sinks with every group replaced by its parts."""
    return [part for s in sinks for part in (parts_of(s.sinks) if isinstance(s, SinkGroup) else [s])]


def write_targets(work: Sequence[tuple[Sink, DataFrame]], batch_id: int | None = None) -> None:
    """Every sink over its frame, in order; frames for one target are written together, where the last of them stands."""
    pending: dict[tuple, list[DataFrame]] = {}
    left: dict[tuple, int] = {}
    for sink, _ in work:
        if isinstance(sink, TargetSink):
            left[sink.key] = left.get(sink.key, 0) + 1
    for sink, df in work:
        if not isinstance(sink, TargetSink):
            sink(df, batch_id)
            continue
        pending.setdefault(sink.key, []).append(sink.rows(df))
        left[sink.key] -= 1
        if not left[sink.key]:
            sink.write(pending.pop(sink.key), batch_id)


def table_sink(table: str, mode: str = "append", fmt: str = "parquet", run_id: str = "",
               pipeline_name: str | None = None) -> Sink:
    return TargetSink(table, mode, f"table-{fmt}", lambda df: table_rows(df, pipeline_name, run_id),
                      lambda rows, batch_id: write_table(reduce(DataFrame.unionByName, rows), table, mode, fmt, batch_id))


def json_sink(path: str, run_id: str = "", pipeline_name: str | None = None, raw_path: str | None = None,
              mode: str = "append") -> Sink:
    """K2 (+ K3 when ``raw_path`` is given: raw bytes copied to their own folder,
    so the JSON folder holds only records)."""
    records = TargetSink(path, mode, "json", lambda df: json_records(df, pipeline_name, run_id),
                         lambda records, batch_id: _write_records(records, path, mode, batch_id))
    return records if raw_path is None else SinkGroup([records, content_sink(raw_path)])


def content_sink(path: str) -> Sink:
    """K3 as a sink; a micro-batch has a folder of its own."""
    return TargetSink(path, "append", "content", content_names,
                      lambda files, batch_id: write_files(reduce(DataFrame.unionByName, files), _target(path, batch_id)),
                      reads_content=True)

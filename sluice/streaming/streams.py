"""The same operators on Structured Streaming.

Streams run as finite micro-batches (``availableNow``) or continuously;
each query has its own checkpoint under ``spark.checkpoint.dir``, so a
restarted or replayed query resumes where it committed. Micro-batches are
handed to the batch flow through ``foreachBatch``; sinks there replace a
``batch_id=N`` folder of a path, or the stream's partition of a catalog
table, so a replayed batch neither duplicates output nor leaves any behind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.plans.flow import RouterSpec, run_router, write_flow
from sluice.sources.documents import string_map, to_documents
from sluice.sources.files import files_to_documents, read_files
from sluice.sources.tree import with_digest

# Far older files than the newest seen one must still be picked up.
NO_MAX_AGE = "36500d"


def stream_files(spark: SparkSession, path: str, patterns: Sequence[str] | None = None,
                 max_files_per_trigger: int | None = None, include_content: bool = True,
                 options: dict[str, str] | None = None, file_format: str = "binaryFile", schema: str | None = None,
                 digest: bool = False) -> DataFrame:
    """New files under ``path`` as a stream of documents (each path emitted once).

    ``binaryFile`` makes a document of each file; ``digest`` adds its MD5 as ``content_md5``, read in pieces. Any other format of Spark's file streams (``text``, ``json``,
    ``csv``, ``parquet``…, with its ``schema``) makes one of each row: ``uri`` is its ``path`` column, or the file's
    path if it has none, ``content`` its ``content`` column, and every column but ``content`` goes to the metadata.
    """
    opts = {"maxFileAge": NO_MAX_AGE, **(options or {})}
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if file_format != "binaryFile":
        if digest:
            raise ValueError(f"documents of a {file_format} stream are rows, not files: digest their content")
        return _stream_rows(spark, path, patterns, include_content, opts, file_format, schema)
    raw = read_files(spark, path, patterns, recursive=True, stream=True, options=opts)
    return files_to_documents(with_digest(raw, path, opts) if digest else raw, include_content, source="files_stream",
                              keep=["content_md5"] if digest else [])


def _stream_rows(spark: SparkSession, path: str, patterns, include_content: bool, options: dict[str, str], file_format: str,
                 schema: str | None) -> DataFrame:
    """Documents from the rows of new files of one format."""
    if schema is None and file_format != "text":
        raise ValueError(f"a stream of {file_format} files needs a schema")
    raw = read_files(spark, path, patterns, recursive=True, stream=True, options=options, file_format=file_format,
                     schema=schema or "value string")
    columns = [c for c in raw.columns if c != "content"]
    uri = F.col("path") if "path" in columns else F.col("_file")
    meta = string_map({**{c: F.col(f"`{c}`") for c in columns if c not in ("source", "_file")}, "source": F.lit("files_stream")})
    return to_documents(raw, uri=uri, content="content" if include_content and "content" in raw.columns else None, metadata=meta)


def stream_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A landing table (folder or catalog name) read as a stream.

    ``glob`` keeps only matching file names in the folder (a table stored
    as single files next to others); the schema is taken from a batch read
    of the same files unless given."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if "/" not in path and ":" not in path:
        return reader.table(path)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is None:
        batch = spark.read.format(fmt)
        schema = (batch.option("pathGlobFilter", glob) if glob else batch).load(path).schema
    return reader.format(fmt).schema(schema).load(path)


def run_stream(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
               trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query; ``trigger`` defaults to ``availableNow``."""
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def stream_to(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
              trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a file table (exactly-once through the file sink log)."""
    writer = (stream.writeStream.format(fmt).option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def router_batch_writer(spec: RouterSpec, run_id: str = "", on_stats: Callable[[int, dict], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of F2: the batch router flow on one
    micro-batch, sinks keyed by ``batch_id`` so a replay overwrites itself."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        result = run_router(batch, spec)
        try:
            stats = write_flow(result, spec.pipelines, batch_id=batch_id, run_id=run_id)
        finally:
            result.close()
        if on_stats is not None:
            on_stats(batch_id, stats)

    return on_batch


def run_router_stream(stream: DataFrame, spec: RouterSpec, checkpoint: str, trigger: dict | None = None,
                      run_id: str = "", on_stats: Callable[[int, dict], None] | None = None) -> StreamingQuery:
    """F2: the router flow per micro-batch; one checkpoint for the whole flow,
    so a second run over the same input processes nothing new."""
    return run_stream(stream, router_batch_writer(spec, run_id, on_stats), checkpoint, trigger)

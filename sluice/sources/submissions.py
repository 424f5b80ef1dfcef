"""Pushed submissions ``{uri, content_base64?, metadata}``.

Producers drop JSON-lines files (or rows) into a submissions location;
a file stream with its own checkpoint consumes each file once, and, with
``remember``, each submission once: one that is sent again (a producer that
got no answer) is told by its content, in the stream's state.
Content is base64-decoded (absent or empty → null; invalid → null and an error
on the row); metadata gets
``source=api`` unless the submitter already set ``source``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.documents import add_errors, to_documents

BAD_BASE64 = "submission: content_base64 is not base64"
SUBMISSION_SCHEMA = "uri string, content_base64 string, metadata map<string,string>"


def ingest_submissions(df: DataFrame, ingested_at: float | None = None) -> DataFrame:
    given = F.nullif(F.col("content_base64"), F.lit(""))
    content = F.try_to_binary(given, F.lit("base64"))
    meta = F.coalesce(F.col("metadata"), F.create_map().cast("map<string,string>"))
    staged = df.withColumn("_bad", given.isNotNull() & content.isNull())
    docs = to_documents(staged, uri="uri", content=content, metadata=meta, source="api", ingested_at=ingested_at,
                        keep=["_bad"])
    return docs.withColumn("errors", add_errors(F.col("errors"), F.when(F.col("_bad"), F.lit(BAD_BASE64)))).drop("_bad")


def submission_key() -> Column:
    """What makes two submissions the same: uri, content and metadata, in whatever order its keys come. Null and empty differ."""
    entries = F.array_sort(F.map_entries("metadata"))
    return F.sha2(F.to_json(F.struct("uri", "content_base64", entries.alias("entries"))), 256)


def consume_once(df: DataFrame, remember: str = "30 days") -> DataFrame:
    """Of equal submissions the one that arrives first, in a batch or over a stream's micro-batches.

    A stream keeps the keys (no content) it saw in the last ``remember`` in its state. Time is the time of
    arrival, which a replayed micro-batch takes from the stream's log, so no submission can be late and none
    is dropped but for being there already; one sent again after ``remember`` counts as new.
    """
    keyed = df.withColumn("_key", submission_key())
    if not df.isStreaming:
        return keyed.dropDuplicates(["_key"]).drop("_key")
    timed = keyed.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
    return timed.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def read_submissions(spark: SparkSession, path: str, stream: bool = False,
                     max_files_per_trigger: int | None = None, remember: str | None = None) -> DataFrame:
    """Documents of the submissions under ``path``; with ``remember`` (``"30 days"``) equal ones are taken once."""
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(SUBMISSION_SCHEMA)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    found = reader.json(path)
    return ingest_submissions(found if remember is None else consume_once(found, remember))


def submit(df: DataFrame, path: str) -> None:
    """Producer side: append submissions as JSON lines."""
    df.select("uri", "content_base64", "metadata").write.mode("append").json(path)

"""The canonical document row.

Every source ends here: ``doc_id, uri, content, metadata`` plus the
per-run columns. ``doc_id`` defaults to ``sha2(uri, 256)`` so a retried
task or a replayed micro-batch produces the same id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.text import extension_of, filename_of

METADATA_TYPE = T.MapType(T.StringType(), T.StringType())

DOCUMENT_COLUMNS = ["doc_id", "uri", "content", "metadata", "doc_type", "ingested_at", "errors"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_map() -> Column:
    return F.create_map().cast(METADATA_TYPE)


def string_map(pairs: dict[str, Column | str | None]) -> Column:
    """A ``map<string,string>`` from named columns; null values are left out.

    One ``create_map`` then a null filter: measured faster than assembling
    one-entry maps with ``map_concat``, although the filter is a lambda."""
    if not pairs:
        return _empty_map()
    args: list[Column] = []
    for key, value in pairs.items():
        value_col = F.lit(None) if value is None else (value if isinstance(value, Column) else F.lit(value))
        args += [F.lit(key), value_col.cast("string")]
    return F.map_filter(F.create_map(*args), lambda k, v: v.isNotNull())


def with_defaults(defaults: dict[str, str], given: Column) -> Column:
    """``given`` map with the ``defaults`` keys added where it lacks them (the caller's keys win)."""
    parts = [F.when(F.array_contains(F.map_keys(given), F.lit(k)), _empty_map())
             .otherwise(F.create_map(F.lit(k), F.lit(v)).cast(METADATA_TYPE)) for k, v in defaults.items()]
    return F.map_concat(*parts, given)


def to_documents(
    df: DataFrame,
    uri: str | Column = "uri",
    content: str | Column | None = "content",
    metadata: Column | None = None,
    source: str | None = None,
    doc_id: Column | None = None,
    ingested_at: float | Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Normalise any frame to the canonical document schema.

    ``metadata`` is a map column; ``source`` (if given) is added under key
    ``source`` unless the row already carries one. ``content`` may be
    ``None`` for URI-only rows. ``ingested_at`` is the time of the run (epoch
    seconds) unless given.
    """
    uri_col = _col(uri).cast("string")
    content_col = F.lit(None).cast("binary") if content is None else _col(content).cast("binary")
    meta = metadata if metadata is not None else F.create_map().cast(METADATA_TYPE)
    if source is not None:
        meta = with_defaults({"source": source}, meta)
    if ingested_at is None:
        ingested_at = F.unix_micros(F.current_timestamp()) / F.lit(1_000_000.0)
    ingested = ingested_at if isinstance(ingested_at, Column) else F.lit(float(ingested_at))
    cols = [
        (doc_id if doc_id is not None else F.sha2(uri_col, 256)).alias("doc_id"),
        uri_col.alias("uri"),
        content_col.alias("content"),
        meta.cast(METADATA_TYPE).alias("metadata"),
        F.lit(None).cast("string").alias("doc_type"),
        ingested.cast("double").alias("ingested_at"),
        F.array().cast("array<string>").alias("errors"),
    ]
    return df.select(*cols, *[F.col(k) for k in (keep or [])])


def with_name_columns(df: DataFrame) -> DataFrame:
    """Add ``filename`` and ``extension`` derived from ``uri``."""
    return df.withColumn("filename", filename_of(F.col("uri"))).withColumn("extension", extension_of(F.col("uri")))


def add_errors(errors: Column, message: Column) -> Column:
    """Append ``message`` to the errors array when it is not null (no per-row lambda)."""
    text = message.cast("string")
    return F.concat(errors, F.when(text.isNotNull(), F.array(text)).otherwise(F.array().cast("array<string>")))

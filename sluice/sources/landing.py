"""Landing tables read by high-water mark, and appended to.

A landing table is any table with a URI column, an optional content
column and an ingest timestamp. Increments are a pushed-down range filter
on the timestamp; the next mark is a max aggregate (partial per task,
one row to the driver). Both stay correct at any table size.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.sources.documents import string_map, to_documents


def _mark(value, ts_type: str) -> Column:
    return F.lit(value).cast(ts_type)


def read_increment(df: DataFrame, ts_col: str = "ts", watermark=None, uri_col: str = "uri",
                   content_col: str = "content", include_content: bool = True,
                   source: str = "landing", ingested_at: float | None = None, ordered: bool = False) -> DataFrame:
    """Rows with ``ts > watermark`` (strict; all rows without a mark), as
    documents. Every non-content column goes into ``metadata`` as text; the
    timestamp column is kept typed as ``ts``. ``ordered`` sorts by it (a
    range shuffle; only for presentation)."""
    ts_type = df.schema[ts_col].dataType.simpleString()
    if watermark is not None:
        df = df.where(F.col(ts_col) > _mark(watermark, ts_type))
    meta = string_map({c: F.col(c) for c in df.columns if c not in (content_col, "source")})
    meta = F.map_concat(meta, F.create_map(F.lit("source"), F.lit(source)))
    content = content_col if (include_content and content_col in df.columns) else None
    docs = to_documents(df, uri=F.col(uri_col), content=content, metadata=meta,
                        ingested_at=ingested_at, keep=[ts_col])
    return docs.orderBy(ts_col) if ordered else docs


def next_watermark(df: DataFrame, ts_col: str = "ts", old=None) -> DataFrame:
    """One row ``(old_mark, new_mark, n_new)``; the mark stays when nothing is new."""
    ts_type = df.schema[ts_col].dataType.simpleString()
    old_col = _mark(old, ts_type)
    rows = df if old is None else df.where(F.col(ts_col) > old_col)
    return rows.agg(
        old_col.alias("old_mark"),
        F.coalesce(F.max(ts_col), old_col).alias("new_mark"),
        F.count(F.lit(1)).alias("n_new"),
    )


def load_watermark(spark: SparkSession, path: str):
    """The stored mark, or None before the first pass."""
    try:
        row = spark.read.parquet(path).agg(F.max("new_mark").alias("mark")).first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if row is None else row["mark"]


def save_watermark(marks: DataFrame, path: str) -> None:
    """Add the one-row result of ``next_watermark`` after the pass is written; the largest mark counts.

    Appended, so that a crash in between never loses the mark before.
    """
    marks.write.mode("append").parquet(path)


def landing_pass(spark: SparkSession, table: DataFrame, state_path: str, write, ts_col: str = "ts",
                 **read_options) -> dict:
    """S7 + S8 as one pass: read what is new since the stored mark, hand it
    to ``write`` (any function that runs the documents to their sinks; it
    must run an action over the frame it is given), and only then store the
    new mark. The mark is observed during the write, so
    finding it costs no extra scan; nothing new leaves the mark unchanged."""
    old = load_watermark(spark, state_path)
    docs = read_increment(table, ts_col, old, **read_options)
    seen = Observation("landing_pass")
    write(docs.observe(seen, F.max(ts_col).alias("new_mark"), F.count(F.lit(1)).alias("n_new")))
    result = seen.get
    if result["n_new"]:
        ts_type = table.schema[ts_col].dataType.simpleString()
        marks = spark.createDataFrame([(result["new_mark"], result["n_new"])], f"new_mark {ts_type}, n_new bigint")
        save_watermark(marks.withColumn("old_mark", _mark(old, ts_type)), state_path)
    return {"old_mark": old, "new_mark": result["new_mark"] or old, "n_new": int(result["n_new"])}


def append_landing(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                   ts_col: str | None = "ts") -> None:
    """The producer side: append ``uri, content`` plus any extra columns
    to a landing table, stamping an ingest timestamp when the frame has none."""
    if ts_col is not None and ts_col not in df.columns:
        df = df.withColumn(ts_col, F.localtimestamp())
    writer = df.write.format(fmt).mode(mode)
    if "/" in path or ":" in path:
        writer.save(path)
    else:
        writer.saveAsTable(path)

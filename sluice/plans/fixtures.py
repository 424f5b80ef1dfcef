"""Document views derived from the test tables (see FIXTURES.md §2).

Each view is a projection of a whole table, so its size grows with it:
``landing`` from ``documents``, ``web`` from ``pages``, ``landing_events``
from ``events``, ``submissions`` from ``conversations``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import text_bytes
from sluice.sources.documents import string_map, to_documents

# File stems by ``doc_id % 6`` and extensions by ``(doc_id div 6) % 5``.
STEMS = ["Invoice", "service_agreement", "MSA-contract", "notes", "scan", "memo"]
EXTENSIONS = [".pdf", ".PDF", ".docx", ".txt", ""]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows carry whole texts."""
    return table(spark, sf_dir, name)


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as landed files: ``/landing/<source>/<lang>/<stem>_<id><ext>``."""
    docs = text_table(spark, sf_dir, "documents")
    stem = _pick(STEMS, F.col("doc_id") % 6)
    ext = _pick(EXTENSIONS, F.expr("(doc_id div 6) % 5"))
    uri = F.concat(F.lit("/landing/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"),
                   stem, F.lit("_"), F.col("doc_id").cast("string"), ext)
    meta = string_map({
        "lang": F.col("lang"),
        "mime_type": F.when(ext == ".pdf", F.lit("application/pdf")).when(ext == ".PDF", F.lit(""))
                      .when(ext == ".txt", F.lit("text/plain")),
        "content_type": F.when(ext == ".PDF", F.lit("application/pdf")),
    })
    staged = docs.select(F.col("doc_id").alias("src_id"), "n_chars", uri.alias("uri"),
                         text_bytes(F.col("text")).alias("content"), meta.alias("metadata"))
    return to_documents(staged, metadata=F.col("metadata"), source="landing", keep=["src_id", "n_chars"])


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = text_table(spark, sf_dir, "pages")
    staged = pages.select(F.col("url").alias("uri"), text_bytes(F.col("html")).alias("content"), "page_id")
    return to_documents(staged, source="web", keep=["page_id"])


def landing_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing *table* form of events: ``uri, content, ts`` and the other columns."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.concat(F.lit("event://"), F.col("event_id").cast("string")).alias("uri"),
                     text_bytes(F.col("props")).alias("content"), "ts", "event_id", "user_id", "event_type")


def submissions_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions ``{uri, content_base64, metadata{role}}``; system turns carry no content."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select(
        F.concat(F.lit("conv://"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("uri"),
        F.when(F.col("role") != "system", F.base64(text_bytes(F.col("text")))).alias("content_base64"),
        F.create_map(F.lit("role"), F.col("role")).alias("metadata"),
    )


def labelled(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """``docs`` with a ``doc_type`` already set from ``labels`` (toxic → ``quarantine``).

    ``labels`` is a table that grows with the data: a plain left join on
    the id, which AQE turns into a broadcast only if it measures it small.
    """
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("src_id"), "toxic")
    return (docs.drop("doc_type").join(lab, "src_id", "left")
                .withColumn("doc_type", F.when(F.col("toxic") == 1, F.lit("quarantine")).cast("string"))
                .drop("toxic"))

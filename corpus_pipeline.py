"""Corpus pipeline: toxic documents out, one document per near-duplicate group, benchmark passages out, sources mixed, token files.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet under
``spark.checkpoint.dir`` and read back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, jaccard, mixing, token_files, toxicity
from sluice.llm.common import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; the model is learned from the labelled ones among ``docs``."""
    scored = toxicity.score(docs, toxicity.fitted(spark, docs, sf_dir))
    return scored.where("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; documents without an id stay.

    Of rows that repeat the id of a kept document one stays, the one with the smallest hash of the text.
    """
    groups = jaccard.jaccard_components(docs)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("kept_id"))
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("kept_id"))
    one = row.join(kept, "kept_id", "left_semi")
    # ids are unique as a rule: only rows of repeated ids are grouped
    single = one.join(repeated, "kept_id", "left_anti").select("row.*")
    several = one.join(repeated, "kept_id", "left_semi").groupBy("kept_id").agg(F.min_by("row", F.xxhash64("row.text")).alias("row")).select("row.*")
    return single.unionByName(several).unionByName(docs.where("doc_id IS NULL"))


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item of ``benchmark`` was found."""
    found = decontaminate.find_leaks(docs.select(F.struct("*").alias("row"), "text"), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's repetition rate says (150 % of the words that came in)."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: ``doc_id, start, n_tokens, ids_crc32`` per document and copy."""
    return token_files.digests(docs)


STAGES = [
    ("drop_toxic", drop_toxic),
    ("drop_near_copies", drop_near_copies),
    ("drop_leaked", drop_leaked),
    ("mix_sources", mix_sources),
    ("write_tokens", write_tokens),
]

#: Toxicity scores and tokenizer ids are not SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Mixing sources to target weights: repetition rates per source, then whole copies plus a hashed coin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import n_words, saved, table, unit_hash

#: Above this many sources the plan is joined by shuffle (AQE splits a hot source) instead of broadcast.
BROADCAST_SOURCES = 100_000


def source_plan(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                size: Column | None = None, source: str = "source") -> DataFrame:
    """One row per source: ``source, source_size, target, rate``.

    Sources in code-point order (null last) take the weights in turn. ``share`` times all tokens is dealt out
    by weight; no target exceeds ``cap`` times its source's size, and what is cut off is dealt out again by
    weight among the others. With sources ordered by cap over weight, the level when the first k are capped
    rises up to the right k and falls after it, so the level is the largest of them: no loop is needed.
    Sizes are summed per task before the shuffle; the windows see one row per source.
    """
    size = n_words(F.col("text")) if size is None else size
    totals = docs.select(F.col(source).alias("source"), size.alias("s")).groupBy("source").agg(
        F.sum("s").alias("source_size"))
    ranked = totals.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", weight.alias("w"),
                           (F.lit(float(cap)) * F.col("source_size")).alias("top"))
    order = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    level = ((F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
              - F.coalesce(F.sum("top").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    target = F.least(F.col("top"), F.col("w") * F.max("level").over(Window.partitionBy()))
    return (ranked.withColumn("level", level).select("source", "source_size", target.alias("target"))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0))))


def _coin(key: str, seed: str) -> Column:
    """A number in [0, 1) from the key; rows without one draw by their text, so that they do not all decide alike."""
    return F.when(F.col(key).isNotNull(), unit_hash(F.col(key), seed=seed)).otherwise(
        unit_hash(F.lit(None), F.md5(F.col("text").cast("binary")), seed=seed))


def with_copies(docs: DataFrame, seed: str = "mix", key: str = "doc_id", source: str = "source",
                size: Column | None = None, **plan_args) -> DataFrame:
    """``row`` (the document as a struct), ``size, source_size, target, rate, copies`` for every document.

    ``copies`` is floor(rate), plus one if the hash of the seed and the key falls below the fraction: the same
    on every run and in every partitioning. Null text has size 0; a null source is a source of its own; rows
    that repeat a key decide alike, rows without a key by their text; extra columns ride along inside ``row`` whatever their names.
    """
    size = n_words(F.col("text")) if size is None else size
    plan = saved(source_plan(docs, source=source, size=size, **plan_args), "mix-plan")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    staged = docs.select(F.struct("*").alias("row"), size.alias("size"), _coin(key, seed).alias("u"),
                         F.col(source).alias("mixed_source"))
    joined = staged.join(plan, staged["mixed_source"].eqNullSafe(plan["source"]))
    floor = F.floor("rate")
    copies = (floor + F.when(F.col("u") < F.col("rate") - floor, 1).otherwise(0)).cast("long")
    return joined.select("row", "size", "source_size", "target", "rate", copies.alias("copies"))


def mix(docs: DataFrame, **args) -> DataFrame:
    """The mixed corpus: every document as often as ``with_copies`` says, with its own columns."""
    return (with_copies(docs, **args).where("copies > 0")
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select("row.*"))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return with_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix|' || coalesce('=' || doc_id::VARCHAR, '~|' || coalesce('=' || md5(text), '~'))), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 2.0::DOUBLE * source_size AS top,
             [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM s),
l AS (SELECT source, source_size, top, w,
             (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
              - coalesce(sum(top) OVER (ORDER BY top / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(w) OVER (ORDER BY top / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
t AS (SELECT source, source_size, least(top, w * max(level) OVER ()) AS target FROM l),
r AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t)
"""

OP10_SQL = MIX_SQL + r"""
SELECT d.doc_id, d.size, r.source_size, r.target,
       (d.size * (floor(r.rate) + CASE WHEN d.u < r.rate - floor(r.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""

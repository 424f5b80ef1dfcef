"""Preference formatting: one prompt from the longest common turn prefix, two masked completions; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import table

TRAINED_ROLE = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _render(turn: Column) -> Column:
    return F.concat(_head(turn), F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _mask(turns: Column) -> Column:
    """Code-point ranges [start, stop) of the rendered turns that are trained on: the trained role's text and end mark."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def step(acc, t):
        stop = acc["at"] + F.length(_render(t))
        span = F.array(F.struct((acc["at"] + F.length(_head(t))).alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"),
                        F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Adds ``n_prefix, prompt, chosen_text, chosen_mask, rejected_text, rejected_mask``; keeps all columns of ``pairs`` in ``row``.

    ``chosen`` and ``rejected`` are arrays of ``struct<role, text>`` in turn order. Turns are equal if role and
    text are (null equals null); the prefix ends before the first turn that differs or is missing on one side.
    A null conversation counts as empty; equal conversations leave two empty completions.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    plain = {c: F.coalesce(F.transform(F.col(c), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), none)
             for c in (chosen, rejected)}
    staged = pairs.select(F.struct("*").alias("row"), plain[chosen].alias("c"), plain[rejected].alias("r"))
    same = F.zip_with("c", "r", lambda a, b: a.eqNullSafe(b) & a.isNotNull() & b.isNotNull())
    differs = F.array_position(same, False)
    n = F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int")
    rest = {c: F.slice(c, F.col("n_prefix") + 1, F.greatest(F.size(c) - F.col("n_prefix"), F.lit(0))) for c in ("c", "r")}
    return staged.withColumn("n_prefix", n).select(
        "row", "n_prefix", _rendered(F.slice("c", 1, F.col("n_prefix"))).alias("prompt"),
        _rendered(rest["c"]).alias("chosen_text"), _mask(rest["c"]).alias("chosen_mask"),
        _rendered(rest["r"]).alias("rejected_text"), _mask(rest["r"]).alias("rejected_mask"))


def pairs_of(conversations: DataFrame) -> DataFrame:
    """One pair per conversation: ``conv_id, chosen_id, chosen, rejected``.

    Conversations that open with the same turn answer the same prompt: the one with the smallest id is the
    chosen side for all others of its group. A conversation that is alone or first in its group is the chosen
    side itself; its rejected side ends with its previous trained reply (or an empty one) in place of the
    last. Rows of a null ``conv_id`` are no conversation and are left out; rows that repeat a turn are kept
    in the order of turn, role and text.

    A first turn shared by very many conversations meets one head row in an equi-join, whose hot side AQE splits.
    """
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    convs = (conversations.where("conv_id IS NOT NULL").groupBy("conv_id").agg(turns.alias("t"))
             .select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("t")))
    convs = convs.withColumn("opening", F.sha2(_render(F.get("t", F.lit(0))).cast("binary"), 256))
    heads = convs.groupBy("opening").agg(F.min("conv_id").alias("head_id"), F.count("*").alias("n")).where("n > 1")
    heads = heads.select("head_id").join(convs, F.col("head_id") == F.col("conv_id")).select(
        "head_id", "opening", F.col("t").alias("head"))
    joined = convs.join(heads, "opening", "left")
    other = F.col("head_id").isNotNull() & (F.col("head_id") != F.col("conv_id"))
    roles = F.transform("t", lambda x: F.coalesce(x["role"] == TRAINED_ROLE, F.lit(False)))
    replies = F.filter("t", lambda x: x["role"] == TRAINED_ROLE)
    last = F.size("t") - F.array_position(F.reverse(roles), True).cast("int")  # index of the last reply
    before = F.when(F.size(replies) > 1, F.get(replies, F.size(replies) - 2)["text"]).otherwise(F.lit(""))
    swapped = F.when(F.size(replies) > 0, F.concat(
        F.slice("t", 1, last), F.array(F.struct(F.lit(TRAINED_ROLE).alias("role"), before.alias("text"))),
        F.slice("t", last + 2, F.size("t")))).otherwise(F.col("t"))
    return joined.select("conv_id", F.when(other, F.col("head_id")).otherwise(F.col("conv_id")).alias("chosen_id"),
                         F.when(other, F.col("head")).otherwise(F.col("t")).alias("chosen"),
                         F.when(other, F.col("t")).otherwise(swapped).alias("rejected"))


def _spans(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")


def op1_preference(spark, sf_dir: str) -> DataFrame:
    out = format_preferences(pairs_of(table(spark, sf_dir, "conversations")))
    return out.select("row.conv_id", "row.chosen_id", "n_prefix", "prompt", "chosen_text", _spans("chosen_mask").alias("chosen_mask"),
                      "rejected_text", _spans("rejected_mask").alias("rejected_mask"))


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, role, text
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text FROM t WHERE i = 1),
g AS (SELECT o.conv_id, min(o.conv_id) OVER (PARTITION BY o.role, o.text) AS chosen_id FROM o),
reply AS (
  SELECT conv_id, i, lag(text) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         lag(i) OVER (PARTITION BY conv_id ORDER BY i) AS before_i,
         row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back
  FROM t WHERE role = 'assistant'),
c AS (SELECT g.conv_id, t.i, t.role, t.text FROM g JOIN t ON t.conv_id = g.chosen_id),
r AS (SELECT g.conv_id, t.i, t.role,
             CASE WHEN g.chosen_id = g.conv_id AND reply.i IS NOT NULL
                  THEN CASE WHEN reply.before_i IS NULL THEN '' ELSE reply.before END ELSE t.text END AS text
      FROM g JOIN t ON t.conv_id = g.conv_id
      LEFT JOIN reply ON reply.conv_id = t.conv_id AND reply.i = t.i AND reply.back = 1),
b AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.i, r.i) AS i,
             c.i IS NOT NULL AND r.i IS NOT NULL AND c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text AS same
      FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.i = r.i),
n AS (SELECT conv_id, coalesce(min(i) FILTER (WHERE NOT same), max(i) + 1) - 1 AS n_prefix FROM b GROUP BY conv_id),
s AS (
  SELECT side, x.conv_id, i, n_prefix, role, '<|' || coalesce(role, '') || '|>' || chr(10) AS head,
         '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS turn
  FROM (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'r', * FROM r) x JOIN n ON n.conv_id = x.conv_id),
k AS (
  SELECT *, CASE WHEN i > n_prefix THEN sum(CASE WHEN i > n_prefix THEN length(turn) ELSE 0 END)
              OVER (PARTITION BY side, conv_id ORDER BY i) END AS stop
  FROM s),
m AS (
  SELECT side, conv_id, coalesce(string_agg(turn, '' ORDER BY i) FILTER (WHERE i <= n_prefix), '') AS prompt,
         coalesce(string_agg(turn, '' ORDER BY i) FILTER (WHERE i > n_prefix), '') AS rest,
         coalesce(string_agg((stop - length(turn) + length(head))::BIGINT::VARCHAR || '-' || stop::BIGINT::VARCHAR, ',' ORDER BY i)
                  FILTER (WHERE i > n_prefix AND role = 'assistant'), '') AS mask
  FROM k GROUP BY side, conv_id)
SELECT g.conv_id, g.chosen_id, n.n_prefix::INT AS n_prefix, c.prompt, c.rest AS chosen_text, c.mask AS chosen_mask,
       r.rest AS rejected_text, r.mask AS rejected_mask
FROM g JOIN n ON n.conv_id = g.conv_id JOIN m c ON c.side = 'c' AND c.conv_id = g.conv_id
JOIN m r ON r.side = 'r' AND r.conv_id = g.conv_id
"""

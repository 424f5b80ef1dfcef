"""Line dedup by overlapping windows of three consecutive lines; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import table


def _windows(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key, doc, pos, h1, h2``: a 128-bit hash of every run of ``width`` lines that is not blank throughout.

    ``doc`` is a hash of the whole text: it tells rows apart that share a key, or have none.
    """
    lines = F.split(F.col(text), "\n", -1)

    def hashed(i):
        run = [F.get("lines", i.cast("int") + k) for k in range(width)]
        blank = F.trim(F.concat(*run)) == ""
        return F.when(~blank, F.struct(F.xxhash64(*run).alias("h1"), F.xxhash64(F.lit(width), *run).alias("h2")))

    at = F.when(F.size("lines") >= width, F.sequence(F.lit(0), F.size("lines") - width))
    return (docs.select(F.col(key).alias("key"), _doc(text).alias("doc"), lines.alias("lines"))
            .select("key", "doc", F.posexplode(F.transform(at, hashed)).alias("pos", "h"))
            .where("h IS NOT NULL").select("key", "doc", "pos", "h.h1", "h.h2"))


def _doc(text: str):
    return F.unhex(F.md5(F.col(text).cast("binary")))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``row`` (the document as a struct), ``n_lines``, ``removed`` (line numbers from 0), ``deduped`` (the text left).

    A window is ``width`` consecutive lines. Of a window that occurs more than once in the table, the
    occurrence with the smallest (key, MD5 of the text, position) stays; every line that a later occurrence covers goes,
    overlapping occurrences being merged. Texts of fewer lines than the width, and null texts (0 lines, still
    null), stay whole. Rows of one key and text are the same document and lose the same lines; rows of one key, or
    of none, with different texts are different documents. A null key sorts first. Extra columns stay inside ``row``.

    First occurrences are a minimum with partial aggregation, so a window found everywhere costs one row per
    task; the join back is an ordinary equi-join whose hot keys AQE splits.
    """
    windows = _windows(docs, key, text, width)
    first = (windows.groupBy("h1", "h2").agg(F.min(F.struct("key", "doc", "pos")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    later = windows.join(first, ["h1", "h2"]).where(F.struct("key", "doc", "pos") > F.col("first"))
    covered = later.groupBy("key", "doc").agg(F.collect_set("pos").alias("starts"))
    spread = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (width - 1))))
    covered = covered.select(F.col("key").alias("hit"), F.col("doc").alias("hit_doc"), F.array_sort(F.array_distinct(spread)).alias("removed"))
    staged = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), _doc(text).alias("doc"), F.col(text).alias("whole"))
    joined = staged.join(covered, staged["key"].eqNullSafe(covered["hit"]) & (staged["doc"] == covered["hit_doc"]), "left")
    lines = F.split("whole", "\n", -1)
    n = F.when(F.col("whole").isNull(), 0).otherwise(F.size(lines))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return (joined.withColumns({"n_lines": n, "lines": lines})
            .select("row", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
                    F.when(F.col("removed").isNull(), F.col("whole")).otherwise(kept).alias("deduped")))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", F.size("removed").alias("n_removed"), F.col("deduped").alias("text"))


OP9_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text, md5(text) AS doc FROM documents),
l AS (
  SELECT r, doc_id, doc, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM d),
w AS (
  SELECT r, doc_id, doc, pos, line || chr(10) || lead(line, 1) OVER p || chr(10) || lead(line, 2) OVER p AS run
  FROM l WINDOW p AS (PARTITION BY r ORDER BY pos)),
v AS (SELECT *, row(doc_id IS NOT NULL, coalesce(doc_id, 0), doc, pos) AS spot FROM w WHERE run IS NOT NULL AND trim(replace(run, chr(10), '')) <> ''),
f AS (SELECT run, min(spot) AS first FROM v GROUP BY run HAVING count(*) > 1),
c AS (SELECT DISTINCT v.r, v.pos + k.k AS pos FROM v JOIN f USING (run), (SELECT unnest([0, 1, 2]) AS k) k WHERE v.spot > f.first),
a AS (SELECT l.r, count(*) AS n_lines, count(c.pos) AS n_removed,
             coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL), '') AS text
      FROM l LEFT JOIN c ON l.r = c.r AND l.pos = c.pos GROUP BY l.r)
SELECT d.doc_id, coalesce(a.n_lines, 0)::INT AS n_lines, coalesce(a.n_removed, 0)::INT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE a.text END AS text
FROM d LEFT JOIN a USING (r)
"""

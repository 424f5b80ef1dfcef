"""Vector code compression: product codes from exact integer k-means, its searches ordered and pruned by LAESA pivots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import saved, table

#: Components from this magnitude on count as not finite: a squared difference of two would not fit into 64 bits.
LIMIT = float(1 << 19)
#: Scale of the integers: a component x becomes floor(SCALE * x).
SCALE = 4096
LONG = (1 << 63) - 1


def _cuts(dims: int, parts: int) -> list[slice]:
    """``parts`` consecutive slices, equal where ``dims`` allows."""
    at = [dims * j // parts for j in range(parts + 1)]
    return [slice(a, b) for a, b in zip(at, at[1:])]


def _exact(*values: np.ndarray) -> type:
    """int64 where squared distances between rows of these arrays fit, else Python integers."""
    most = max((int(np.abs(v).max()) for v in values if v.size), default=0)
    width = max(1, values[0].shape[-1])
    return np.int64 if most <= isqrt((1 << 62) // width) // 2 else object


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of the rows of two integer arrays (broadcast)."""
    kind = _exact(a, b)
    diff = a.astype(kind) - b.astype(kind)
    return (diff * diff).sum(axis=-1)


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Positions of ``n`` entries far from each other: the first, then each time the one with the largest sum of distances."""
    if not len(entries):
        return np.empty(0, np.int64)
    chosen, total = [0], np.zeros(len(entries))
    while len(chosen) < min(n, len(entries)):
        total += np.sqrt(squared(entries, entries[chosen[-1]]).astype(np.float64))
        left = total.copy()
        left[chosen] = -1
        chosen.append(int(left.argmax()))
    return np.array(chosen)


def to_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every row to every pivot."""
    return np.sqrt(squared(rows[:, None, :], pivots[None]).astype(np.float64))


def nearest(rows: np.ndarray, held: np.ndarray, entries: np.ndarray, entry_held: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, squared distance, distances evaluated) of every row; ties go to the lower entry.

    ``held`` and ``entry_held`` are the distances of rows and entries to the pivots. By the triangle inequality
    no entry is nearer than the largest difference of the two; entries are tried in the order of that bound
    and a row is done when its next bound exceeds its best distance. A slack covers the rounding of bounds.
    """
    n = len(rows)
    low = np.zeros((n, len(entries)))
    for p in range(held.shape[1]):
        np.maximum(low, np.abs(held[:, p, None] - entry_held[None, :, p]), out=low)
    order = np.argsort(low, axis=1, kind="stable")
    slack = 2e-6 * (float(held.max(initial=0)) + float(entry_held.max(initial=0)))
    low = np.take_along_axis(low, order, axis=1) - slack
    kind = _exact(rows, entries)
    rows, entries = rows.astype(kind), entries.astype(kind)
    best, root, code = np.zeros(n, kind), np.full(n, np.inf), np.zeros(n, np.int64)
    live, tried = np.arange(n), 0
    for j in range(len(entries)):
        live = live[low[live, j] <= root[live]]
        if not len(live):
            break
        e = order[live, j]
        diff = rows[live] - entries[e]
        d = (diff * diff).sum(axis=1)
        tried += len(live)
        better = np.isinf(root[live]) | (d < best[live]) | ((d == best[live]) & (e < code[live]))
        at = live[better]
        best[at], code[at] = d[better], e[better]
        root[at] = np.sqrt(d[better].astype(np.float64))
    return code, best, tried


def _rows(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _stage(batches: Iterator[pa.RecordBatch], cuts: list[slice], pivots: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """``key, label, ints, held``: the integers of a vector and the distances of its parts to the part's pivots."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, cuts[-1].stop)
        ints = np.floor(x * SCALE).astype(np.int64)
        held = np.concatenate([to_pivots(ints[:, c], p) for c, p in zip(cuts, pivots)], axis=1).astype("<f4")
        packed = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (ints.astype("<i4"), held)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *packed], names=["key", "label", "ints", "held"])


def _searched(batch: pa.RecordBatch, cuts, pivots, books) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per part of a staged batch: its integers, the entries they are nearest to, and the squared distances."""
    ints = _rows(batch.column(0), "<i4", cuts[-1].stop).astype(np.int64)
    width = len(pivots[0])
    held = _rows(batch.column(1), "<f4", width * len(cuts)).astype(np.float64)
    for j, (cut, pivot, book) in enumerate(zip(cuts, pivots, books)):
        rows = ints[:, cut]
        yield rows, *nearest(rows, held[:, j * width:(j + 1) * width], book, to_pivots(book, pivot))[:2]


def _sum_up(batches: Iterator[pa.RecordBatch], cuts, pivots, books) -> Iterator[pa.RecordBatch]:
    """``part, entry, pos, n, total`` of one task: how many parts an entry got and the sums of their components."""
    k = len(books[0])
    counts = [np.zeros(k, np.int64) for _ in cuts]
    sums = [np.zeros((k, c.stop - c.start), np.int64) for c in cuts]
    for batch in batches:
        if not batch.num_rows:
            continue
        for j, (rows, code, _) in enumerate(_searched(batch, cuts, pivots, books)):
            width = rows.shape[1]
            counts[j] += np.bincount(code, minlength=k)
            slot = (code[:, None] * width + np.arange(width)).ravel()
            # sums of one batch stay far below 2**53, so floating point is exact
            sums[j] += np.bincount(slot, rows.ravel(), k * width).astype(np.int64).reshape(k, width)
    rows = [(j, e, p, int(counts[j][e]), int(sums[j][e, p])) for j in range(len(cuts)) for e in range(k) if counts[j][e]
            for p in range(sums[j].shape[1])]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(),) * 3 + (pa.int64(),) * 2)],
                                         names=["part", "entry", "pos", "n", "total"])


def _assign(batches: Iterator[pa.RecordBatch], cuts, pivots, books) -> Iterator[pa.RecordBatch]:
    digits = np.array([f"{e:02x}" for e in range(len(books[0]))])
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, errors = [], []
        for _, code, d in _searched(pa.RecordBatch.from_arrays([batch.column(2), batch.column(3)], names=["i", "h"]), cuts, pivots, books):
            codes.append(digits[code])
            errors.append(d)
        if sum(float(e.max()) for e in errors) < float(1 << 62):
            error = np.sum(errors, axis=0).tolist()
        else:
            error = [s if (s := sum(map(int, e))) <= LONG else None for e in zip(*errors)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(["".join(c) for c in zip(*codes)], pa.string()), pa.array(error, pa.int64())],
            names=["key", "label", "code", "error"])


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = 8, entries: int = 16, rounds: int = 6, pivots: int = 4) -> DataFrame:
    """``key, label, code, error, label_error, codebooks_sha256`` of every kept vector.

    Rows whose vector is null or holds a null, non-finite or over-large (``LIMIT``) component are dropped, and so
    are vectors of another length than that of the smallest kept key. Codebooks start as the ``entries`` first
    vectors by key (nulls last, ties by the vector; all of them if there are fewer) and are refined ``rounds``
    times; everything is integer arithmetic, so the result is the same in any partitioning. Rows that repeat a
    key each get their row; ``error`` is null where it would not fit into 64 bits, and counts as nothing in
    ``label_error``, which is the sum over equal labels, nulls together. Other columns are not read; no kept
    vector gives no row.

    The integers and pivot distances are computed once and written; a round reads them, sums per task and sends
    ``parts * entries`` sums to the driver. Nothing is shuffled by vector or entry; labels are summed per task first.
    """
    spark = vectors.sparkSession
    sound = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < LIMIT))
    kept = vectors.where(sound).select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    kind = {f.name: f.dataType.simpleString() for f in kept.schema}
    order = [F.col("key").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*order).limit(entries).collect()
    dims = len(first[0]["vector"]) if first else parts
    if any(len(r["vector"]) != dims for r in first):
        first = kept.where(F.size("vector") == dims).orderBy(*order).limit(entries).collect()
    cuts = _cuts(dims, parts)
    start = np.floor(np.array([r["vector"] for r in first], np.float64).reshape(len(first), dims) * SCALE).astype(np.int64)
    books = [start[:, c] for c in cuts]
    fixed = [b[choose_pivots(b, pivots)] for b in books]
    staged = saved(kept.where(F.size("vector") == dims).mapInArrow(
        partial(_stage, cuts=cuts, pivots=fixed), f"key {kind['key']}, label {kind['label']}, ints binary, held binary"), "laesa")
    for _ in range(rounds if first else 0):
        sums = staged.select("ints", "held").mapInArrow(partial(_sum_up, cuts=cuts, pivots=fixed, books=books),
                                                        "part int, entry int, pos int, n long, total long")
        merged = sums.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        books = [b.copy() for b in books]
        for r in merged.collect():  # one row per part, entry and position
            books[r["part"]][r["entry"], r["pos"]] = int(r["total"]) // r["n"]
    flat = ",".join(str(v) for b in books for row in b.tolist() for v in row)
    coded = saved(staged.mapInArrow(partial(_assign, cuts=cuts, pivots=fixed, books=books),
                                    f"key {kind['key']}, label {kind['label']}, code string, error long"), "laesa-codes")
    by_label = saved(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "laesa-labels")
    return (coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
            .select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error",
                    F.lit(hashlib.sha256(flat.encode()).hexdigest()).alias("codebooks_sha256")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def _sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    out = [rf"""WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (
  SELECT r, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i, len(embedding) // {parts} AS w FROM kept),
v AS MATERIALIZED (
  SELECT r, (i // w)::INT AS part, (i % w)::INT AS pos, floor(4096 * e::DOUBLE)::BIGINT AS x FROM flat),
b0 AS MATERIALIZED (SELECT part, r::INT AS entry, pos, x FROM v WHERE r < {entries})"""]
    for k in range(rounds + 1):
        out.append(rf"""
a{k} AS MATERIALIZED (
  SELECT r, part, (min(d * {entries} + entry) % {entries})::INT AS entry, min(d * {entries} + entry) // {entries} AS d
  FROM (SELECT r, part, entry, sum((v.x - b.x)::HUGEINT * (v.x - b.x)) AS d
        FROM v JOIN b{k} b USING (part, pos) GROUP BY ALL) GROUP BY r, part)""")
        if k < rounds:
            out.append(rf"""
s{k} AS (SELECT part, entry, pos, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM v JOIN a{k} USING (r, part) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce((s - (s % n + n) % n) // n, x)::BIGINT AS x FROM b{k} LEFT JOIN s{k} USING (part, entry, pos))""")
    return ",".join(out) + rf""",
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


OP11_SQL = _sql()

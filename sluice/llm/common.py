"""Helpers shared by the training-data operators: tables, shared copies, bounded bitmaps, word counts."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import fresh_path

#: Fixed value: a word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh table under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage and survives lost executors; used where a frame is read more than once.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes tables that ``saved`` wrote, once everything that reads them has been written itself."""
    for df in frames:
        path = getattr(df, "__dict__", {}).get("saved_at")
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release_memory() -> None:
    """Gives memory that a task of Python no longer needs back to the system; workers live on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a GNU C library
        pass


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*cols: Column, seed: str) -> Column:
    """A number in [0, 1) from an MD5 of the seed and the columns (null and '' differ); the same on every run."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in cols]
    digest = F.md5(F.concat_ws("|", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """The first column of ``values`` (long; nulls ignored) as a bitmap of ``2**bits`` bits.

    The bit of a value is its low bits, folded with higher ones. The words are or-ed in Spark, so what reaches the
    driver is bounded by ``2**bits / 8`` bytes whatever the number of values. A set bit may be shared: users
    of the map must stay right when a value is taken for a member that is none.
    """
    col = F.col(values.columns[0])
    v = col.cast("long")
    pos = (v.bitwiseXOR(F.shiftrightunsigned(v, 17)).bitwiseXOR(F.shiftrightunsigned(v, 31))).bitwiseAND(F.lit((1 << bits) - 1))
    words = (values.where(col.isNotNull()).select(pos.alias("p"))
             .groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")))
    out = np.zeros(max(1, 1 << bits >> 6), dtype=np.uint64)
    got = words.toPandas()
    out[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64).view(np.uint64)
    return out


def in_bitmap(bits: int, words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the int64 ``values`` may be members (numpy twin of ``bitmap``)."""
    v = values.astype(np.int64).view(np.uint64)
    p = (v ^ v >> np.uint64(17) ^ v >> np.uint64(31)) & np.uint64((1 << bits) - 1)
    return (words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) != 0


def is_crc(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; null ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))

"""Token counts at every prefix of a text, so that budgets and cuts need no second encoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import bpe
from sluice.llm.common import table


def count_prefixes(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 1024,
                   path: str | None = None, keep: bool = False) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit, fits_chars`` and, with ``keep``, ``prefix_steps`` for every row.

    ``n_tokens`` is what the library gives for the whole text without added special tokens; ``fits_chars`` is
    the longest prefix in code points that has at most ``limit`` tokens. ``prefix_steps`` holds the change of
    the count at each code point as little-endian 16-bit integers; ``tokens_before`` and ``chars_within``
    answer from it. A null text is empty; rows are independent, repeated rows give repeated results; other
    columns are not read.
    """
    path = path or bpe.default_path()
    schema = docs.select(F.col(key).alias("key")).schema[0].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = bpe.prefix_counter(path)
        for batch in batches:
            rows = []
            for t in batch["text"]:
                at = counter.counts(t)
                last = int(at[-1]) if len(at) else 0
                fits = len(at) if not len(at) or at.max() <= limit else int(np.flatnonzero(at <= limit)[-1:].sum()) + 1
                rows.append((len(t.encode()), last, last > limit, fits if len(at) and at.min() <= limit else 0,
                             np.diff(at, prepend=0).astype("<i2").tobytes() if keep else b""))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_tokens", "over_limit", "fits_chars", "prefix_steps"])
            yield out.assign(key=batch["key"].array)[["key", *out.columns]]

    out = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(
        run, f"key {schema}, n_bytes long, n_tokens long, over_limit boolean, fits_chars long, prefix_steps binary")
    return out.withColumnRenamed("key", key) if keep else out.drop("prefix_steps").withColumnRenamed("key", key)


def tokens_before(steps: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` code points of the text whose ``prefix_steps`` these are."""

    @F.pandas_udf("long")
    def go(s: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([int(np.frombuffer(b, "<i2")[:max(0, int(k))].sum()) for b, k in zip(s, n)], dtype="int64")

    return go(steps, n_chars)


def chars_within(steps: Column, budget: Column) -> Column:
    """Length in code points of the longest prefix with at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def go(s: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([int(max(np.flatnonzero(np.cumsum(np.frombuffer(b, "<i2")) <= k), default=-1)) + 1
                          for b, k in zip(s, n)], dtype="int64")

    return go(steps, budget)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_prefixes(table(spark, sf_dir, "documents"))

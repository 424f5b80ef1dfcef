"""Language ID: multinomial logistic regression on TF-IDF character n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import is_crc, table, unit_hash

#: Buckets of the n-gram hash: bounds the model, the document frequencies and what a worker holds.
BUCKETS = 1 << 16
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letters as themselves, every other character as a space, by code point."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = c
    return out


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the character 1- to 3-grams of a text, letters lower-cased, all else one space."""
    code = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    if not (code != 32).any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = code == 32
    code = code[~(gap & np.concatenate([[False], gap[:-1]]))]
    with np.errstate(over="ignore"):
        one = code * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B) + code[1:] * np.uint32(0xC2B2AE35)
        three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1) + code[2:] * np.uint32(0x2C1B3C6D)
        mixed = np.concatenate([one, two, three]) * np.uint32(0x2545F491)
    counts = np.bincount((mixed >> np.uint32(16)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # (BUCKETS,)
    weights: np.ndarray  # (BUCKETS, languages), sparse by the l1 penalty
    temperature: float

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        return x / (np.sqrt((x * x).sum()) or 1.0)

    def probabilities(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return softmax(self.vector(at, counts) @ self.weights[at] / self.temperature)


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 2, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> np.ndarray:
    """FTRL-proximal with elastic net: per-coordinate steps, weights in closed form from the gradient sums."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for at, x, y in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            g2 = ni + g * g
            z[at] = zi + g - (np.sqrt(g2) - np.sqrt(ni)) / alpha * w
            n[at] = g2
    return weights(z, n)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """(documents per bucket, documents) over all rows of the first column: summed per task, then by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for t in batch["text"]:
                df[grams(t)[0]] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.concatenate([[-1], at]), "n": np.concatenate([[n], df[at]])})

    got = (texts.toDF("text").mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(BUCKETS)
    real = got[got.bucket >= 0]
    out[real.bucket.to_numpy(np.int64)] = real.n
    return out, int(got.n[got.bucket == -1].sum())


def train(docs: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
          rows_per_language: int = 1000, seed: str = "lang") -> Model | None:
    """A model from the rows where ``usable`` holds and text and language are not null; None without such rows.

    Document frequencies are counted over all usable rows. The weights are fitted on a bounded sample:
    about ``rows_per_language`` documents of each language, chosen by a hash of the key; a fifth of them
    sets the temperature and is not trained on.
    """
    labelled = docs.where(usable & F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    labelled = labelled.where("text IS NOT NULL")
    df, n = document_frequencies(labelled.select("text"))
    share = F.create_map(*[x for v in langs for x in (F.lit(v), F.lit(rows_per_language / sizes[v]))])[F.col("lang")]
    sample = labelled.where(unit_hash(F.col("key"), seed=seed) < share)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [grams(t) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "u": batch["u"], "at": [a.astype("<u2").tobytes() for a, _ in got],
                                "counts": [np.minimum(c, 65535).astype("<u2").tobytes() for _, c in got]})

    held = sample.select("lang", unit_hash(F.col("key"), seed=seed + "-order").alias("u"), "text").mapInPandas(
        featurise, "lang string, u double, at binary, counts binary").toPandas().sort_values(["u", "lang"])
    model = Model(langs, np.log((1 + n) / (1 + df)) + 1, np.zeros((BUCKETS, len(langs)), np.float32), 1.0)
    rows = []
    for r in held.itertuples():
        at, counts = np.frombuffer(r.at, "<u2").astype(np.int64), np.frombuffer(r.counts, "<u2").astype(np.float64)
        if len(at):
            rows.append((at, model.vector(at, counts), langs.index(r.lang)))
    keep = len(rows) - len(rows) // 5
    model.weights = ftrl(rows[:keep], len(langs)).astype(np.float32)
    if rows[keep:]:
        logits = np.array([x @ model.weights[at] for at, x, _ in rows[keep:]])
        y = np.array([c for _, _, c in rows[keep:]])
        loss = {t: -np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in np.geomspace(0.02, 5, 60)}
        model.temperature = float(min(loss, key=loss.get))
    return model


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row; ``und`` and 0.0 for null texts, texts without a letter, or no model.

    Rows are independent: repeated rows repeat; other columns are not read.
    """
    kind = docs.select(F.col(key).alias("key")).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS x languages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            out = []
            for t in batch["text"]:
                at, counts = grams(t)
                if model is None or not len(at):
                    out.append((UNKNOWN, 0.0))
                else:
                    p = model.probabilities(at, counts)
                    best = int(p.argmax())
                    out.append((model.langs[best], float(p[best])))
            yield pd.DataFrame(out, columns=["lang_pred", "score"]).assign(key=batch["key"].array)[["key", "lang_pred", "score"]]

    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(
        run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = is_crc(F.col("doc_id"), 3, 1)
    return predict(docs, train(docs, ~held_out)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")

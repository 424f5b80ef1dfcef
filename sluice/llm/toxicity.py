"""Toxicity: token log-odds with Dirichlet priors, maximum-scoring segments, extreme-value calibration."""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import is_crc, saved, table, unit_hash

_WORDS = re.compile(r"\w+")
THRESHOLD = 0.3


@dataclass
class Model:
    """Word scores, the score of every other word, the extreme-value parameters and the logistic weights."""

    scores: dict[str, float] = field(default_factory=dict)
    other: float = -0.5
    rate: float = 1.0  # lambda: decay of segment scores in clean text
    space: float = 1.0  # K: scale of the number of segments
    weights: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)

    def significance(self, score: float, n_words: int) -> float:
        """Minus the log of the number of segments of this score expected in clean text of this length."""
        return self.rate * score - math.log(self.space * max(1, n_words))

    def features(self, n_words: int, found: list[tuple[float, int]]) -> tuple[float, float, float]:
        """Of the (score, toxic words) of all segments: best and summed significance, toxic words of the best segment."""
        sure = [(self.significance(s, n_words), k) for s, k in found]
        best, words = max(sure, default=(0.0, 0))
        return (max(0.0, min(40.0, best)), math.log1p(sum(x for x, _ in sure if x > 0)), math.log1p(words))

    def probability(self, text: str) -> float:
        n, found = segments(self, text)
        z = sum(w * x for w, x in zip(self.weights, (1.0, *self.features(n, [(s, k) for s, _, _, k in found]))))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


def segments(model: Model, text: str) -> tuple[int, list[tuple[float, int, int, int]]]:
    """(number of words, all maximal-scoring segments as (score, first word, word after, toxic words)), in one pass.

    Ruzzo and Tompa: candidates are kept with the running sum before and after each; a new positive score
    swallows the candidates back to the last one that begins lower, if that one also ends lower.
    """
    words = _WORDS.findall(text.lower())
    get = model.scores.get
    hits = [(k, s) for k, w in enumerate(words) if (s := get(w)) is not None]
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, first, after, toxic words
    total, at = 0.0, 0
    for k, s in hits:
        total += model.other * (k - at)
        at = k + 1
        low, total = total, total + s
        if s <= 0:
            continue
        high, first, inside = total, k, 1
        while found:
            # candidates that begin no lower than this one cannot be extended by it
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:
                j -= 1
            if j < 0 or found[j][1] >= high:
                break
            low, first, inside = found[j][0], found[j][2], inside + sum(x[4] for x in found[j:])
            del found[j:]
        found.append((low, high, first, k + 1, inside))
    return len(words), [(h - lo, a, b, w) for lo, h, a, b, w in found]


def toxic_passages(model: Model, text: str, expected: float = 0.01) -> list[tuple[int, int, float]]:
    """(first word, word after, significance) of every segment expected less than ``expected`` times by chance."""
    n, found = segments(model, text or "")
    return [(a, b, e) for s, a, b, _ in found if (e := model.significance(s, n)) > -math.log(expected)]


def _log_odds(counts: DataFrame, prior: float, surprise: float) -> dict[str, float]:
    """Scores of the significantly toxic words: log-odds against an informative Dirichlet prior.

    The prior gives each word its share of the corpus, with a mass of ``prior`` times the corpus. A word is
    significant if its log-likelihood ratio exceeds what chance gives the most surprising of all words,
    2 ln(distinct words), by ``surprise``. Filtered in Spark: only significant words reach the driver.
    """
    counts = saved(counts.groupBy("word").agg(F.sum("toxic").alias("y1"), F.sum("clean").alias("y0")), "toxic-words")
    n = counts.agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0"), F.count("*").alias("words")).first()
    n1, n0 = float(n["n1"] or 0), float(n["n0"] or 0)
    if not n1 or not n0:
        return {}
    a0, share = prior * (n1 + n0), n1 / (n1 + n0)
    both = F.col("y1") + F.col("y0")
    x1, x0 = F.col("y1") + F.lit(prior) * both, F.col("y0") + F.lit(prior) * both
    delta = F.log(x1 / (n1 + a0 - x1)) - F.log(x0 / (n0 + a0 - x0))
    ratio = 2 * (F.when(F.col("y1") > 0, F.col("y1") * F.log(F.col("y1") / (both * share))).otherwise(0.0)
                 + F.when(F.col("y0") > 0, F.col("y0") * F.log(F.col("y0") / (both * (1 - share)))).otherwise(0.0))
    kept = counts.select("word", delta.alias("d"), ratio.alias("g")).where(
        (F.col("d") > 1) & (F.col("g") > 2 * math.log(n["words"]) + surprise))
    return {r["word"]: float(r["d"]) for r in kept.select("word", "d").collect()}


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, key: str = "doc_id", text: str = "text",
          label: str = "toxic", rows: int = 50_000, prior: float = 0.1, surprise: float = 6.0, other: float = -0.5,
          seed: str = "toxic") -> Model:
    """A model from the labelled rows of ``docs``; without rows of both labels one that finds nothing.

    ``usable`` is a condition on the key column of the labels. About ``rows`` labelled documents, chosen by a
    hash of the key, are used (all if there are no more): their ids, bounded by that parameter, go to the scan
    of the texts, so texts are not shuffled. Copies of a text count once. Two thirds give the word counts (documents that hold the word),
    the rest, unseen by the words, the extreme-value and logistic parameters.
    """
    spark = docs.sparkSession
    lab = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
    if usable is not None:
        lab = lab.where(usable)
    lab = lab.groupBy("key").agg(F.max("y").alias("y"))
    share = rows / max(1, lab.count())
    chosen = lab.where(unit_hash(F.col("key"), seed=seed) < share)
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    once = (texts.join(F.broadcast(chosen), "key").groupBy(F.md5(F.col("text").cast("binary")).alias("h"))
            .agg(F.min("key").alias("key"), F.max("y").alias("y")).select("key", "y"))
    once = saved(once, "toxic-sample")
    rows_ = texts.join(F.broadcast(once), "key")
    rows_ = rows_.select("text", "y", (unit_hash(F.col("key"), seed=seed + "-fold") < 2 / 3).alias("fit"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch["text"], batch["y"]):
                (toxic if y else clean).update(set(_WORDS.findall(t.lower())))
            if len(toxic) + len(clean) > 1_000_000:
                yield _rows(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield _rows(toxic, clean)

    model = Model(other=other)
    counts = rows_.where("fit").drop("fit").mapInPandas(count, "word string, toxic long, clean long")
    model.scores = _log_odds(counts, prior, surprise)
    if not model.scores:
        return model

    def measure(shared, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            out = []
            for t, y in zip(batch["text"], batch["y"]):
                n, found = segments(model, t)
                hits = Counter(s for w in _WORDS.findall(t.lower()) if (s := model.scores.get(w)) is not None)
                out.append((y, n, *model.features(n, [(s, k) for s, _, _, k in found]), max([0.0, *(s for s, *_ in found)]),
                            [float(s) for s, c in hits.items() for _ in range(c)]))
            yield pd.DataFrame(out, columns=["y", "n", "x1", "x2", "x3", "top", "hits"])

    def measured(part: DataFrame) -> pd.DataFrame:
        shared = spark.sparkContext.broadcast(model)
        return part.mapInPandas(functools.partial(measure, shared), _MEASURED).toPandas()

    clean = measured(rows_.where("NOT fit AND y = 0").select("text", "y"))
    _extreme_values(model, clean)
    return _logistic(model, measured(rows_.where("NOT fit").select("text", "y")))


def _rows(toxic: Counter, clean: Counter) -> pd.DataFrame:
    words = list(toxic.keys() | clean.keys())
    return pd.DataFrame({"word": pd.Series(words, dtype=object), "toxic": [toxic[w] for w in words], "clean": [clean[w] for w in words]})


_MEASURED = "y int, n int, x1 double, x2 double, x3 double, top double, hits array<double>"


def _extreme_values(model: Model, clean: pd.DataFrame) -> None:
    """lambda and K from unseen clean documents (a bounded sample)."""
    words = max(1, int(clean.n.sum()))
    hits = np.concatenate([np.asarray(h, float) for h in clean.hits] or [np.empty(0)])
    scores = np.concatenate([hits, [max(model.scores.values())]])  # half a hit where there is none
    mass = np.concatenate([np.ones(len(hits)), [0.5]]) / words
    rest = max(0.0, 1 - mass.sum())
    lo, hi = 1e-6, 50.0
    for _ in range(80):  # sum of p e^(lambda s) = 1 has one positive root
        mid = (lo + hi) / 2
        over = (mass * np.exp(np.minimum(700, mid * scores))).sum() + rest * math.exp(mid * model.other) > 1
        lo, hi = (lo, mid) if over else (mid, hi)
    model.rate = lo
    # the largest segment of a clean text of n words exceeds s K n e^(-lambda s) times: K by maximum likelihood
    fits = clean.n.to_numpy(float) * np.exp(-model.rate * clean.top.to_numpy(float))
    model.space = (len(clean) + 1) / (float(fits.sum()) + 1)


def _logistic(model: Model, held: pd.DataFrame) -> Model:
    """Weights of the segment features, from unseen labelled documents (a bounded sample)."""
    x = np.column_stack([np.ones(len(held)), held.x1, held.x2, held.x3])
    y = (held.y > 0).to_numpy(float)
    w = np.zeros(4)
    ridge = np.array([1e-6, 0.5, 0.5, 0.5])
    for _ in range(60):  # ridge-penalised Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    model.weights = tuple(float(v) for v in w)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` as ``row`` with ``score`` (0 to 1), ``predicted`` and ``passages`` (word ranges and significance).

    A null text scores as an empty one. Rows are independent; extra columns stay inside ``row``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the labelled sample

    @F.pandas_udf("score double, passages array<struct<start:int,stop:int,significance:double>>")
    def scored(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        return pd.DataFrame({
            "score": [model.probability(t or "") for t in texts],
            "passages": [[{"start": a, "stop": b, "significance": e} for a, b, e in toxic_passages(model, t)] for t in texts]})

    out = docs.select(F.struct("*").alias("row"), scored(F.col(text)).alias("s"))
    return out.select("row", "s.score", (F.col("s.score") >= threshold).cast("int").alias("predicted"), "s.passages")


def fitted(spark, docs: DataFrame, sf_dir: str) -> Model:
    return train(docs, table(spark, sf_dir, "labels"), ~is_crc(F.col("key"), 4, 2))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fitted(spark, docs, sf_dir))
    return out.select("row.doc_id", is_crc(F.col("row.doc_id"), 4, 2).alias("held_out"), "score", "predicted",
                      F.size("passages").alias("n_passages"))

"""Benchmark decontamination: exact pieces by the pigeonhole principle, then bit-parallel edit distance."""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, saved, table

#: Characters of test items searched for at once; a larger benchmark is searched in several passes.
BLOCK_CHARS = 8_000_000


def normal(text: str) -> str:
    """Lower case, white space as single spaces."""
    return " ".join(text.lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(start, piece): ``errors + 1`` runs of nearly equal length that make up the item; one stays whole under as many edits."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(pattern: str, window: str) -> tuple[int, int]:
    """(distance, end) of the substring of ``window`` nearest to ``pattern`` by edit distance; the first such end.

    Myers: the column of the distance matrix as two bit vectors of its vertical steps, one word per pattern.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    up, down, score = full, 0, m
    best = (m, 0)
    for j, c in enumerate(window, 1):
        eq = where.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        score += bool(rise & top) - bool(fall & top)
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | ~((eq | down) | rise) & full, rise & (eq | down)
        if score < best[0]:
            best = (score, j)
    return best


class Searcher:
    """Finds the items of a list in texts with at most ``floor(rate x length)`` edits each."""

    def __init__(self, items: tuple[tuple[int, str], ...], rate: float) -> None:
        import ahocorasick

        self.items = {i: (t, int(rate * len(t))) for i, t in items}
        by_piece: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (t, errors) in self.items.items():
            for start, piece in pieces(t, errors):
                by_piece[piece].append((i, start))
        self.automaton = ahocorasick.Automaton()
        for piece, found in by_piece.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()

    def search(self, text: str) -> dict[int, tuple[int, int]]:
        """item → (distance, end) of its best match in a normalised text, items without a match left out."""
        starts: dict[int, list[int]] = defaultdict(list)
        for end, (length, found) in self.automaton.iter(text):
            for item, offset in found:
                starts[item].append(end + 1 - length - offset)
        out: dict[int, tuple[int, int]] = {}
        for item, at in starts.items():
            pattern, errors = self.items[item]
            done = -1
            for s in sorted(at):  # windows that overlap are searched as one, up to the next gap
                if s + len(pattern) + errors <= done:
                    continue
                lo = max(0, s - errors, done - len(pattern) - errors)
                hi = done = s + len(pattern) + errors
                got, end = best_match(pattern, text[lo:hi])
                if got <= errors and (item not in out or got < out[item][0]):
                    out[item] = (got, lo + end)
        return out


@functools.lru_cache(maxsize=1)
def _searcher(items: tuple[tuple[int, str], ...], rate: float) -> Searcher:
    return Searcher(items, rate)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
               item_text: str = "text", rate: float = 0.08, min_chars: int = 20) -> DataFrame:
    """Every row of ``docs`` with ``leaks``: ``array<struct<item, distance, end>>`` of the test items found in its text.

    Texts and items are compared in lower case with white space collapsed; ``end`` is a position in that form.
    An item matches where a substring is within ``floor(rate x its length)`` edits. Items under ``min_chars``
    characters (nulls and empty ones among them) are no evidence and match nothing; an item id that repeats is
    searched with each of its texts. A null text has no leaks. All columns are kept; the column added is ``leaks``
    and replaces one of that name.

    Items are taken to the tasks in blocks of about ``BLOCK_CHARS`` characters. Each block but a sole one is a pass of
    its own: its result is written under ``spark.checkpoint.dir`` before the next begins, so a worker holds the
    automaton of one block, however many there are.
    """
    items = benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = 1 + total // BLOCK_CHARS
    kept = [c for c in docs.columns if c.lower() != "leaks"]
    staged = [F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")] if kept else []
    if text in kept:
        searched = F.col("row").getField(text)
    else:  # the text is a column ``leaks`` itself, which the result replaces
        staged, searched = [*staged, F.col(f"`{text}`").alias("text")], F.col("text")
    found = docs.select(*staged, F.array().cast("array<struct<item:long,distance:int,end:int>>").alias("leaks"))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).distinct().collect()
        wanted = sorted({(r["i"], normal(r["t"])) for r in rows})
        wanted = tuple((i, t) for i, t in wanted if len(t) >= min_chars)
        if wanted:
            searched_in = found
            found = found.withColumn("leaks", F.concat("leaks", _leaks_udf(docs, wanted, rate)(searched)))
            if blocks > 1:
                found = saved(found, "leaks")
                discard(searched_in)
    return found.select(*(["row.*"] if kept else []), "leaks")


def _leaks_udf(docs: DataFrame, wanted: tuple[tuple[int, str], ...], rate: float):
    shared = docs.sparkSession.sparkContext.broadcast(wanted)  # bounded by BLOCK_CHARS

    @F.pandas_udf("array<struct<item:long,distance:int,end:int>>")
    def leaks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = [i for i, _ in shared.value]
        searcher = _searcher(tuple(enumerate(t for _, t in shared.value)), rate)  # an id may stand for several texts
        for batch in texts:
            yield pd.Series([[{"item": ids[i], "distance": d, "end": e} for i, (d, e) in sorted(searcher.search(normal(t)).items())]
                             if t else [] for t in batch])

    return leaks


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"),
                        F.array_sort(F.array_distinct(F.col("leaks")["item"])).alias("item_ids"),
                        F.array_min(F.col("leaks")["distance"]).alias("least_distance"))

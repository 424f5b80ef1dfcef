"""N-gram Jaccard join by token-combination prefixes.

Words in a document are turned into its set of 5-word shingles ("tokens" below). With threshold t a set of n
tokens lacks at most e = n - ceil(t n) of them in any set it links with. All sets put their tokens in one order:
rare tokens first, frequent ones after, each by hash. Then of two linked sets

* either they share a rare token, which stands among the first e + 1 tokens of each, or
* they share none, so a set with r rare tokens lacks only e - r of its frequent ones; with the frequent tokens
  dealt into g groups, the first e - r + g + 1 frequent tokens of each hold g + 1 common ones, and so two in
  one group.

So a set is indexed by the rare tokens of its prefix and, only if it has at most e of them, by the pairs of
frequent tokens of one group in its extended prefix. Texts that are equal are one class with one set. Candidates
are compared exactly; which tokens count as frequent only decides the cost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial, wraps

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import bitmap, discard, in_bitmap, release_memory, saved, table

WIDTH = 5
#: Bits of a token that name it in the index; a clash only adds a candidate.
REST_BITS = 32
#: A token is frequent if it is in more documents than this; doubled while the frequent ones exceed FREQUENT_MOST.
FREQUENT_LEAST, FREQUENT_MOST = 32, 1 << 21
#: Tokens after which a task passes on what it has gathered.
FLUSH_TOKENS = 1_000_000
#: Words a task remembers the hash of.
CACHE_WORDS = 150_000
BITMAP_BITS = (16, 27)
#: An entry of more sets than this is compared by blocks of BLOCK sets.
HOT, BLOCK = 64, 512
#: Ids that may be broadcast (8 MB); more are joined by shuffle.
BROADCAST_IDS = 1_000_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def shingles(text: str | bytes, hashes: _WordHash | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; of fewer words the whole sequence; of none, none.

    A-Z are lower-cased and words separated by the six ASCII white-space characters, which is what bytes do.
    """
    data = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map((_WordHash() if hashes is None else hashes).__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - width + 1, 0x9E3779B97F4A7C15 * width & (1 << 64) - 1, np.uint64)
        for k in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - width + 1 + k]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def least_common(n: int, percent: int) -> int:
    """Fewest tokens a set of ``n`` shares with any set it links with."""
    return -(-n * percent // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large or not small:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (small + large - common)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(rare tokens, hashes of pairs of frequent tokens) that index a set; ``frequent`` marks its tokens."""
    n = len(tokens)
    missing = n - least_common(n, percent)
    rare = tokens[~frequent][:missing + 1]
    if len(rare) > missing:
        return rare, np.empty(0, np.uint64)
    common = tokens[frequent]
    if n == 1:  # links only with an equal set
        return rare, common ^ np.uint64(0x5555555555555555)
    # sets that link differ in size by at most 1/t, so they share one of two neighbouring size levels
    step = 100 / percent
    level = int(math.log(n) / math.log(step) + 1e-9)
    pairs = []
    for lv in (level, level + 1):
        groups = max(1, int(step ** (lv - 1) * (step - 1) / 2))
        ahead = common[:missing - len(rare) + groups + 1]
        group = (ahead * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        ahead, group = ahead[order], group[order]
        for d in range(1, len(ahead)):
            same = group[d:] == group[:-d]
            if not same.any():
                break
            mixed = (ahead[:-d][same] * np.uint64(3) + np.uint64(lv)) * np.uint64(0xD6E8FEB86659FD93) + ahead[d:][same]
            mixed ^= mixed >> np.uint64(31)
            pairs.append(mixed * np.uint64(0x9FB21C651E98DF25))
    return rare, np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.uint64)


def _bits(n: int) -> int:
    return min(BITMAP_BITS[1], max(BITMAP_BITS[0], math.ceil(math.log2(16 * max(1, n)))))


class _Map:
    """A bitmap that tasks share; what it holds wrongly only costs time."""

    def __init__(self, values: DataFrame, n: int) -> None:
        self.bits = _bits(n)
        self.words = values.sparkSession.sparkContext.broadcast(bitmap(values, self.bits))  # at most 16 MB

    def has(self, values: np.ndarray) -> np.ndarray:
        return in_bitmap(self.bits, self.words.value, values)


def _tidy(task: Callable) -> Callable:
    """A task that gives its memory back when it ends: workers are used again for other stages."""
    @wraps(task)
    def run(*args, **kwargs):
        try:
            yield from task(*args, **kwargs)
        finally:
            release_memory()
    return run


def _frame(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def _sets(batches: Iterator[pa.RecordBatch], wanted: _Map) -> Iterator[tuple[int, np.ndarray]]:
    hashes = _WordHash()
    for batch in batches:
        ids, texts = batch.column("id").to_numpy(zero_copy_only=False), batch.column("text").cast(pa.binary())
        for k in np.flatnonzero(wanted.has(ids)).tolist():
            yield int(ids[k]), shingles(texts[k].as_py(), hashes)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(bucket, its rows without that column) of rows sorted by bucket."""
    at, rows = None, []
    for batch in batches:
        columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "bucket"]
        for k, b in enumerate(batch.column("bucket").to_pylist()):
            if rows and b != at:
                yield at, rows
                rows = []
            at = b
            rows.append(tuple(c[k].as_py() for c in columns))
    if rows:
        yield at, rows


def _by_bucket(tokens: np.ndarray, bucket_bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted tokens by their first bits."""
    bucket = (tokens >> np.uint64(64 - bucket_bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(tokens)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield int(bucket[a]), slice(a, b)


def _rest(tokens: np.ndarray, bucket_bits: int) -> np.ndarray:
    return (tokens >> np.uint64(64 - bucket_bits - REST_BITS)).astype("<u4")


def _name(tokens: np.ndarray, bucket_bits: int) -> np.ndarray:
    return (tokens >> np.uint64(64 - bucket_bits - REST_BITS)).astype(np.int64)


@_tidy
def _count_out(batches, wanted: _Map, bucket_bits: int):
    """Tokens of the sets, packed by bucket with the number of sets that hold each."""
    held, size = [], 0

    def packed():
        tokens, n = np.unique(np.concatenate(held), return_counts=True)
        n = np.minimum(n, 255).astype(np.uint8)
        rest = _rest(tokens, bucket_bits)
        rows = [(b, rest[s].tobytes(), n[s].tobytes()) for b, s in _by_bucket(tokens, bucket_bits)]
        return _frame(rows, bucket=pa.int32(), tokens=pa.binary(), counts=pa.binary())

    for _, tokens in _sets(batches, wanted):
        held.append(tokens)
        size += len(tokens)
        if size >= FLUSH_TOKENS:
            yield packed()
            held, size = [], 0
    if size:
        yield packed()


@_tidy
def _count_in(batches):
    """Tokens in more than FREQUENT_LEAST sets, with the power of two of their number; a bucket is held at a time."""
    for b, rows in _buckets(batches):
        keys = np.concatenate([np.frombuffer(t, "<u4") for t, _ in rows])
        counts = np.concatenate([np.frombuffer(n, np.uint8) for _, n in rows])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        total = np.add.reduceat(counts, starts)
        often = total > FREQUENT_LEAST
        if often.any():
            token = (np.int64(b) << REST_BITS) | keys[starts[often]].astype(np.int64)
            power = np.log2((total[often] - 1) / FREQUENT_LEAST).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(power)], names=["token", "power"])


@_tidy
def _index_out(batches, wanted: _Map, frequent: _Map, bucket_bits: int, percent: int):
    """Index entries packed by bucket: 0 rare tokens, 1 pairs (spread by document), 2 set sizes."""
    tokens, owners, rows, size = [], [], [], 0

    def packed():
        flat = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
        who = np.repeat(np.array([i for i, _ in owners], np.int64), [k for _, k in owners])
        order = np.argsort(flat, kind="stable")
        flat, who = flat[order], who[order].view(np.uint64)
        rest, low, high = _rest(flat, bucket_bits), who.astype("<u4"), (who >> np.uint64(32)).astype("<u4")
        rows.extend((0, b, rest[s].tobytes(), low[s].tobytes() + high[s].tobytes()) for b, s in _by_bucket(flat, bucket_bits))
        return _frame(rows, kind=pa.int32(), bucket=pa.int32(), tokens=pa.binary(), ids=pa.binary())

    for i, got in _sets(batches, wanted):
        spot = xxhash.xxh32_intdigest(str(i)) >> (32 - bucket_bits) if bucket_bits <= 32 else 0
        one = np.array([i], np.int64).tobytes()
        rows.append((2, spot, np.array([len(got)], "<i8").tobytes(), one))
        if not len(got):
            continue
        rare, pairs = signatures(got, frequent.has(_name(got, bucket_bits)), percent)
        tokens.append(rare)
        owners.append((i, len(rare)))
        if len(pairs):
            rows.append((1, spot, pairs.astype("<u8").tobytes(), one))
        size += len(rare) + len(pairs)
        if size >= FLUSH_TOKENS:
            yield packed()
            tokens, owners, rows, size = [], [], [], 0
    if rows:
        yield packed()


def _index_rows(kind: np.ndarray, sig: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(sig), pa.array(ids)], names=["kind", "sig", "id"])


@_tidy
def _index_in(batches):
    """``kind, sig, id``: rare tokens that several sets are indexed by, all pairs, and sizes (in ``sig``).

    Rows come sorted by bucket; a bucket is held at a time.
    """
    for b, rows in _buckets(batches):
        other = [(kind, np.frombuffer(tokens, "<i8"), np.frombuffer(ids, "<i8")[0]) for kind, tokens, ids in rows if kind]
        if other:
            # pairs below zero, rare tokens above
            sig = np.concatenate([t | np.int64(-1 << 63) if kind == 1 else t for kind, t, _ in other])
            times = [len(t) for _, t, _ in other]
            yield _index_rows(np.repeat([k for k, _, _ in other], times), sig, np.repeat([i for _, _, i in other], times))
        rare = [(np.frombuffer(tokens, "<u4"), np.frombuffer(ids, "<u4").astype(np.uint64)) for kind, tokens, ids in rows if not kind]
        if rare:
            keys = np.concatenate([t for t, _ in rare])
            owners = np.concatenate([i[:len(t)] | i[len(t):] << np.uint64(32) for t, i in rare]).view(np.int64)
            order = np.lexsort((owners, keys))
            keys, owners = keys[order], owners[order]
            first = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
            keys, owners = keys[first], owners[first]
            near = keys[1:] == keys[:-1]
            shared = np.concatenate([[False], near]) | np.concatenate([near, [False]])
            if shared.any():
                sig = (np.int64(b) << REST_BITS) | keys[shared].astype(np.int64)
                yield _index_rows(np.zeros(len(sig)), sig, owners[shared])


def _pack_set(tokens: np.ndarray) -> bytes:
    """The first 40 bits of sorted tokens."""
    return (tokens >> np.uint64(32)).astype("<u4").tobytes() + (tokens >> np.uint64(24) & np.uint64(255)).astype(np.uint8).tobytes()


def _unpack_set(data: bytes) -> np.ndarray:
    n = len(data) // 5
    return np.frombuffer(data, "<u4", n).astype(np.uint64) << np.uint64(8) | np.frombuffer(data, np.uint8, n, 4 * n).astype(np.uint64)


def _cells(tokens: np.ndarray) -> bytes:
    """How many tokens fall into each of a power of two of cells, one to two of them for two tokens."""
    cells = 1 << max(6, (len(tokens) - 1).bit_length() - 1)
    counts = np.bincount((tokens >> np.uint64(40)).astype(np.int64) & (cells - 1), minlength=cells)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def may_link(a: bytes, b: bytes, n: int, m: int, percent: int) -> bool:
    """Whether sets of these sizes and cell counts can link: no cell holds more common tokens than either set."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    if max(x.max(), y.max()) == 255:  # a full cell bounds nothing
        return True
    cells = min(len(x), len(y))
    common = int(np.minimum(x.reshape(-1, cells).sum(0), y.reshape(-1, cells).sum(0)).sum())
    return 100 * common >= percent * (n + m - common)


@_tidy
def _possible(batches, percent: int):
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        sizes = zip(batch.column("na").to_pylist(), batch.column("nb").to_pylist())
        ok = [may_link(x[k].as_py(), y[k].as_py(), n, m, percent) for k, (n, m) in enumerate(sizes)]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


@_tidy
def _set_rows(batches, wanted: _Map):
    rows, size = [], 0
    types = {"id": pa.int64(), "n": pa.int32(), "cells": pa.binary(), "tokens": pa.binary()}
    for i, tokens in _sets(batches, wanted):
        rows.append((i, len(tokens), _cells(tokens), _pack_set(tokens)))
        size += len(tokens)
        if size >= FLUSH_TOKENS:
            yield _frame(rows, **types)
            rows, size = [], 0
    if rows:
        yield _frame(rows, **types)


@_tidy
def _compare(batches, percent: int):
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        ok = [linked(_unpack_set(x[k].as_py()), _unpack_set(y[k].as_py()), percent) for k in range(len(x))]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def components(links: DataFrame) -> DataFrame:
    """``id, comp`` (the smallest id reachable) for every id in ``links`` (``a, b``).

    Each round takes the smallest label among the neighbours and then the label of that label, until nothing
    changes; labels are written out between rounds. Hubs meet single rows in equi-joins, which AQE splits.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).toDF("u", "v").distinct(), "jaccard-edges")
    labels = saved(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")).select(
        "id", F.least("id", "m").alias("comp")), "jaccard-labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("v"), "comp"), "v").groupBy(F.col("u").alias("id"))
                .agg(F.min("comp").alias("m")))
        step = labels.select("id", "comp").join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        of = labels.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
        new = saved(step.join(of, "comp").select("id", "old", F.least("comp", "top").alias("comp")), "jaccard-labels")
        discard(labels)
        labels = new
        if new.where("old <> comp").isEmpty():
            discard(both)
            out = new.select("id", "comp")
            out.saved_at = new.saved_at
            return out


def _alike_in_size(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _compare_all(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the distinct pairs that link: first by cell counts, which rule most out, then by the sets.

    Pairs should have been held against sizes before: what is shuffled here are the cells and sets of each pair.
    """
    x = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("cells").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("y"))
    possible = saved(pairs.join(x, "a").join(y, "b").mapInArrow(
        partial(_possible, percent=percent), "a long, b long").distinct(), "jaccard-possible")
    ids = saved(possible.select(F.col("a").alias("id")).union(possible.select("b")).distinct(), "jaccard-possible")
    # few sets are left: no need to shuffle all of them
    left = sets.select("id", "tokens").join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    x, y = left.select(F.col("id").alias("a"), F.col("tokens").alias("x")), left.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    got = saved(possible.join(x, "a").join(y, "b").mapInArrow(partial(_compare, percent=percent), "a long, b long"), "jaccard-pairs")
    discard(possible, ids)
    return got


def _block_links(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links across two blocks (within one where they are the same), from a product of incidence matrices."""
    sets = [_unpack_set(t) for t in group["tokens"]]
    sizes = np.array([len(t) for t in sets])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    names, column, holders = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    left, right = np.flatnonzero(group["side"] == 0), np.flatnonzero(group["side"] == group["side"].max())
    common = np.zeros((len(left), len(right)), np.float32)
    place = np.cumsum(holders > 1) - 1  # tokens of one set alone add nothing
    keep = holders[column] > 1
    column, row = place[column[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = 4096
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        lo, hi = np.searchsorted(column, (start, start + width))
        grid = np.zeros((len(sets), width), np.float32)
        grid[row[lo:hi], column[lo:hi] - start] = 1
        common += grid[left] @ grid[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    i, j = np.nonzero((100 * common >= percent * union) & (union > 0))
    ids = group["id"].to_numpy(np.int64)
    root = np.arange(len(sets))  # smallest position reachable, by passing labels along the links
    u, v = left[i], right[j]
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    a, b = ids, ids[root]
    return pd.DataFrame({"a": np.minimum(a, b)[a != b], "b": np.maximum(a, b)[a != b]})


def _hot_links(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links among sets (``sig, id, n``) that share an entry of very many sets.

    Such entries come in crowds (every pair of tokens of a passage), so their sets are gathered into groups that
    share any. Sets that link are of the same or of neighbouring levels of size, so each level of a group is dealt
    into blocks by hash, and each two blocks of such levels are compared by a matrix product: pairs are neither
    listed nor compared twice, and what a task holds is two blocks.
    """
    lead = hot.groupBy("sig").agg(F.min("id").alias("lead"))
    edges = hot.join(lead, "sig").where("id <> lead").select(F.col("id").alias("a"), F.col("lead").alias("b")).distinct()
    # levels a little wider than the largest ratio of two sizes, so that rounding parts no link
    level = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent) * (1 + 1e-6))).cast("int")
    found = components(edges)
    group = saved(found.join(hot.groupBy("id").agg(F.max("n").alias("n")), "id").select("id", "comp", level.alias("level")),
                  "jaccard-groups")
    discard(found)
    parts = saved(group.groupBy("comp", "level").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "jaccard-groups")
    met = [parts.select("comp", (F.col("level") - step).alias("level"), F.lit(step).alias("step"), F.col("parts").alias("others"))
           for step in (-1, 0, 1)]
    dealt = (group.join(parts, ["comp", "level"])
             .select("id", "comp", "level", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("block"))
             .join(met[0].union(met[1]).union(met[2]), ["comp", "level"])
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))))
    own, below = F.col("step") == 0, F.col("step") < 0
    dealt = saved(dealt.select(
        "id", "comp", F.least("level", F.col("level") + F.col("step")).alias("level"), F.abs("step").alias("step"),
        F.when(own, F.least("block", "other")).when(below, F.col("other")).otherwise(F.col("block")).alias("lo"),
        F.when(own, F.greatest("block", "other")).when(below, F.col("block")).otherwise(F.col("other")).alias("hi"),
        F.when(own, F.col("block") > F.col("other")).otherwise(below).cast("int").alias("side")), "jaccard-blocks")
    held = dealt.join(sets.select("id", "tokens"), "id")
    links = saved(held.groupBy("comp", "level", "step", "lo", "hi").applyInPandas(
        partial(_block_links, percent=percent), "a long, b long"), "jaccard-links")
    discard(group, parts, dealt)
    return links


def _link(shared: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``id, comp`` of all sets that link with another, from the index entries of several sets (``sig, id, lead``).

    First every set is compared with one set of each of its entries, which joins most copies of a group without
    listing its pairs; entries whose sets are then in one component are done. Of the others, all pairs across
    components are compared: pair by pair for entries of up to HOT sets, by blocks for larger ones. Pairs whose
    sizes differ too much go no further than the join that finds them.
    """
    ends = shared.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    ends = (ends.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
            .where(_alike_in_size(F.col("na"), F.col("nb"), percent)).select("a", "b"))
    links = first = _compare_all(ends, sets, percent)
    comp = components(links)
    labelled = (shared.select("sig", "id").join(sizes, "id").join(comp, "id", "left")
                .select("sig", "id", "n", F.coalesce("comp", "id").alias("comp")))
    open_ = labelled.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k")).where("lo < hi")
    rows = saved(labelled.join(open_.select("sig", "k"), "sig"), "jaccard-open")
    cold = rows.where(F.col("k") <= HOT)
    other = cold.select("sig", F.col("id").alias("id2"), F.col("comp").alias("comp2"), F.col("n").alias("n2"))
    pairs = cold.join(other, "sig").where("id < id2 AND comp <> comp2").where(_alike_in_size(F.col("n"), F.col("n2"), percent))
    second = _compare_all(pairs.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct(), sets, percent)
    links = links.union(second)
    hot = rows.where(F.col("k") > HOT).select("sig", "id", "n")
    if not hot.isEmpty():
        links = links.union(_hot_links(hot, sets, percent))
    out = components(links)
    discard(first, second, rows, comp)
    return out


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """``key, n_shingles, component_id`` for every row; ``component_id`` is the smallest key reachable by links.

    Two documents link when ``100 * common >= percent * union`` of their shingle sets. A null or wordless text
    has an empty set and links with nothing. A null key takes no part (null component). Rows that repeat a key
    are one document. Other columns are not read. ``percent`` must be over 50.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = rows.where("id IS NOT NULL")
    hashed = rows.select("id", F.md5(F.col("text").cast("binary")).alias("h"))
    classes = saved(hashed.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "jaccard-classes")
    members = classes.where("rep IS NOT NULL")
    wanted = _Map(members.select("rep"), members.count())
    bucket_bits = max(10, math.ceil(math.log2(8 * int(spark.conf.get("spark.sql.shuffle.partitions")))))

    counts = texts.mapInArrow(partial(_count_out, wanted=wanted, bucket_bits=bucket_bits),
                              "bucket int, tokens binary, counts binary")
    often = saved(counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count_in, "token long, power int"),
                  "jaccard-frequent")
    by_power = {r["power"]: r["n"] for r in often.groupBy("power").agg(F.count("*").alias("n")).collect()}
    least = 0
    while sum(n for p, n in by_power.items() if p >= least) > FREQUENT_MOST:
        least += 1
    frequent = _Map(often.where(F.col("power") >= least).select("token"), sum(n for p, n in by_power.items() if p >= least))

    entries = texts.mapInArrow(partial(_index_out, wanted=wanted, frequent=frequent, bucket_bits=bucket_bits, percent=percent),
                               "kind int, bucket int, tokens binary, ids binary")
    index = saved(entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_index_in, "kind int, sig long, id long"),
                  "jaccard-index")
    sizes = saved(index.where("kind = 2").groupBy("id").agg(F.max("sig").alias("n")), "jaccard-sizes")
    # the index is pruned once: entries of one set alone link nothing
    several = index.where("kind < 2").groupBy("sig").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last")
    shared = saved(index.where("kind < 2").select("sig", "id").join(several.select("sig", "lead"), "sig"), "jaccard-shared")
    discard(often, index)
    ids = saved(shared.select("id").distinct(), "jaccard-ids")
    holds = _Map(ids, ids.count())
    sets = saved(texts.mapInArrow(partial(_set_rows, wanted=holds), "id long, n int, cells binary, tokens binary"), "jaccard-sets")
    comp = _link(shared, sizes, sets, percent)
    discard(shared, ids, sets)

    of = classes.join(sizes, F.col("rep") == F.col("id"), "left").select("h", "rep", "n")
    of = of.join(comp, F.col("rep") == F.col("id"), "left").select("h", "n", F.coalesce("comp", "rep").alias("comp"))
    out = hashed.join(of, "h")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return out.select(F.col("id").alias(key), n.alias("n_shingles"),
                      F.when(F.col("id").isNull(), None).when(n == 0, F.col("id")).otherwise(F.col("comp")).alias("component_id"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))

"""Packing documents into training sequences: first-fit decreasing over a tournament tree of bin capacities."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe
from sluice.llm.common import table

LENGTH = 2048
#: Ids after which a group is packed; it holds whole documents, so a longer one is a group of its own.
GROUP_IDS = 1 << 22
#: Bytes of ids that one batch of pieces passes on.
BATCH_BYTES = 1 << 23

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padding long, ids binary")
_NAMES = [c.split()[0] for c in PIECES.split(", ")]


class Piece(NamedTuple):
    """``length`` ids of document ``doc`` (its place in the group) from ``start`` on."""

    doc: int
    start: int
    length: int


class Bins:
    """Remaining capacities of bins in a tournament tree: every inner node holds the larger of its two children."""

    def __init__(self, n: int, capacity: int) -> None:
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """The first bin that has room for ``size``, which it takes up."""
        tree, node = self.tree, 1
        if tree[1] < size:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        found = node - self.leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places of ``sizes`` (each at most ``capacity``) by bin; equal sizes go in the order given."""
    bins, out = Bins(len(sizes), capacity), []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        b = bins.first_fit(sizes[k])
        if b == len(out):
            out.append([])
        out[b].append(k)
    return out


def _powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _cut(pieces: list[Piece], size: int) -> list[Piece]:
    """Takes the last ``size`` ids from ``pieces``, cutting one of them where needed."""
    out = []
    while size:
        p = pieces.pop()
        if p.length > size:
            pieces.append(Piece(p.doc, p.start, p.length - size))
            p = Piece(p.doc, p.start + p.length - size, size)
        size -= p.length
        out.append(p)
    return out


def pack_group(sizes: list[int], length: int = LENGTH, top_up: bool = True) -> list[list[Piece]]:
    """Sequences of at most ``length`` ids that hold every id of documents of these sizes once.

    Documents fill whole sequences as long as they can; what is left of each is placed by first-fit decreasing.
    With ``top_up`` the emptiest sequences are then cut up to fill the gaps of the fullest, and the one that stays
    open is cut into powers of two, so that nothing needs padding.
    """
    full = [[Piece(d, s, length)] for d, n in enumerate(sizes) for s in range(0, n - length + 1, length)]
    rest = [Piece(d, n - n % length, n % length) for d, n in enumerate(sizes) if n % length]
    placed = [[rest[k] for k in b] for b in first_fit_decreasing([p.length for p in rest], length)] if rest else []
    if not top_up:
        return full + placed
    fill = [sum(p.length for p in b) for b in placed]
    order = sorted(range(len(placed)), key=lambda b: -fill[b])
    low, high = 0, len(order) - 1
    while low < high:
        to, source = order[low], order[high]
        moved = min(length - fill[to], fill[source])
        placed[to] += _cut(placed[source], moved)
        fill[to] += moved
        fill[source] -= moved
        low += fill[to] == length
        high -= fill[source] == 0
    done = [placed[b] for b in order if fill[b] == length]
    for b in order:
        if 0 < fill[b] < length:
            left = placed[b][::-1]
            done += [_cut(left, n) for n in _powers(fill[b])]
    return full + done


def padding(n: int, length: int = LENGTH) -> int:
    """Ids that fill a sequence of ``n`` up to ``length``; a power of two needs none."""
    return 0 if n & (n - 1) == 0 else length - n


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = 1,
                   path: str | None = None, top_up: bool = True, ids: bool = True, seed: str = "pack") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padding`` and ``ids``.

    A document's ids are the tokenizer's without special tokens, then ``end_id``; ``ids`` are little-endian unsigned
    32-bit integers (null with ``ids=False``), ``padding`` is that of the whole sequence. Documents are dealt at
    random, by a hash of the seed, key and text, over the tasks, where ``GROUP_IDS`` ids at a time are packed by
    themselves; a source or length in plenty is thereby spread like any other, and a task holds one group.
    A null text is empty (the end id alone); a null key stays null; repeated rows are documents of their own;
    other columns are not read; an empty table gives no piece. ``sequence_id`` is unique, not gapless.
    """
    path = path or bpe.default_path()
    width = 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = bpe.id_encoder(path), TaskContext.get().partitionId() << 33
        end = end_id.to_bytes(width, "little")
        keys: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64()] * 8 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_NAMES)

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, size
            rows, heavy = [], 0
            for pieces in pack_group([len(h) // width for h in held], length, top_up):
                n = sum(p.length for p in pieces)
                offset, pad = 0, padding(n, length)
                for p in pieces:
                    data = held[p.doc][width * p.start:width * (p.start + p.length)]
                    rows.append((keys[p.doc], p.start, p.length, crc32(data), len(held[p.doc]) // width, sequence, offset, pad,
                                 data if ids else None))
                    offset += p.length
                sequence += 1
                heavy += width * n if ids else len(pieces) * 64
                if heavy >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, heavy = [], 0
            if rows:
                yield batch_of(rows)
            keys.clear()
            held.clear()
            size = 0

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                some = batch.slice(start, 512)
                for doc, got in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                    keys.append(doc)
                    held.append(got + end)
                    size += len(held[-1]) // width
                    if size >= GROUP_IDS:
                        yield from close()
        if held:
            yield from close()

    staged = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chance = F.xxhash64(F.lit(seed), F.col("key"), F.col("text")).alias("chance")
    dealt = staged.select("key", "text", chance).repartition("chance").sortWithinPartitions("chance", "key").select("key", "text")
    return dealt.mapInArrow(run, PIECES).withColumnRenamed("doc_id", key)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), ids=False).drop("ids")

"""Token-id files of patched frame-of-reference blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import bpe
from sluice.llm.common import release_memory, saved, table

#: Ids in a block: 32 lanes of 32 values, so that a width of w bits fills w words of each lane.
BLOCK = 1024
#: Ids after which a file row is closed; it holds whole documents, so a longer document has a row of its own.
ROW_IDS = 1 << 16
HEADER = np.dtype([("least", "<u4"), ("n", "<u2"), ("width", "<u2"), ("patches", "<u2"), ("spare", "<u2")])

FILE_SCHEMA = ("part int, row int, first long, n_tokens long, doc_ids array<long>, doc_lengths array<long>, "
               "block_starts array<int>, blocks binary")


def _widths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack(ids: np.ndarray, share: float = 0.9) -> tuple[bytes, np.ndarray]:
    """(bytes, block starts) of ids: each block less its minimum, at the width that fits ``share`` of its values.

    What does not fit keeps its low bits in place; position and high bits go to the block's patch list.
    """
    if not len(ids):
        return b"", np.empty(0, np.int32)
    blocks = -(-len(ids) // BLOCK)
    counts = np.full(blocks, BLOCK)
    counts[-1] = len(ids) - BLOCK * (blocks - 1)
    grid = np.concatenate([ids, np.full(blocks * BLOCK - len(ids), ids[-1], ids.dtype)]).astype(np.uint32).reshape(blocks, BLOCK)
    least = grid.min(axis=1)
    grid = grid - least[:, None]
    rank = min(BLOCK - 1, int(share * BLOCK))
    width = _widths(np.partition(grid, rank, axis=1)[:, rank])
    out: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        low = (grid[at] & np.uint32((1 << w) - 1)).astype(np.uint64).reshape(len(at), 32, 32)
        words = np.zeros((len(at), max(w, 1), 32), np.uint64)
        for r in range(32 if w else 0):
            k, shift = divmod(r * w, 32)
            words[:, k] |= low[:, r] << np.uint64(shift)
            if shift + w > 32:
                words[:, k + 1] |= low[:, r] >> np.uint64(32 - shift)
        words = words[:, :w].astype("<u4")  # the low 32 bits
        high = grid[at] >> np.uint32(w) if w < 32 else np.zeros_like(grid[at])
        for j, b in enumerate(at.tolist()):
            pos = np.flatnonzero(high[j]).astype("<u2")
            head = np.array([(least[b], counts[b], w, len(pos), 0)], HEADER)
            out[b] = head.tobytes() + words[j].tobytes() + pos.tobytes() + high[j][pos].astype("<u4").tobytes()
    starts = np.concatenate([[0], np.cumsum([len(x) for x in out])[:-1]]).astype(np.int32)
    return b"".join(out), starts


def unpack(blocks: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids (uint32) of the blocks that begin at ``starts``; any run of a file row's block starts will do."""
    heads = [np.frombuffer(blocks, HEADER, 1, s)[0] for s in starts]
    out = np.zeros((len(heads), BLOCK), np.uint32)
    width = np.array([h["width"] for h in heads], dtype=np.int64)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        if w:
            words = np.stack([np.frombuffer(blocks, "<u4", 32 * w, starts[i] + HEADER.itemsize) for i in at])
            words = words.astype(np.uint64).reshape(len(at), w, 32)
            got = np.zeros((len(at), 32, 32), np.uint64)
            for r in range(32):
                k, shift = divmod(r * w, 32)
                got[:, r] = words[:, k] >> np.uint64(shift)
                if shift + w > 32:
                    got[:, r] |= words[:, k + 1] << np.uint64(32 - shift)
            out[at] = (got & np.uint64((1 << w) - 1)).reshape(len(at), BLOCK)
    for i, h in enumerate(heads):
        w, m = int(h["width"]), int(h["patches"])
        if m:
            at = starts[i] + HEADER.itemsize + 128 * w
            pos = np.frombuffer(blocks, "<u2", m, at)
            out[i][pos] |= np.frombuffer(blocks, "<u4", m, at + 2 * m) << np.uint32(w)
        out[i] += h["least"]
    return np.concatenate([out[i][:h["n"]] for i, h in enumerate(heads)]) if heads else np.empty(0, np.uint32)


def write_token_files(docs: DataFrame, key: str = "doc_id", text: str = "text", end_id: int = 2,
                      path: str | None = None, share: float = 0.9) -> DataFrame:
    """Encodes every document, appends ``end_id`` and writes the ids in ascending key order; returns the files' rows.

    One file per range of keys, in order; a row holds consecutive whole documents as patched
    frame-of-reference blocks with the start of each block, the documents' ids and lengths, and the number of
    ids before the row in its file (``first``). A null text is empty (the end id alone); a null key sorts
    first; repeated rows are written as often as they occur, ties of a key in the order of the text's hash,
    which also splits a key that holds very many rows.
    """
    path = path or bpe.default_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()  # what tasks of earlier stages left to this worker
        encoder, part = bpe.id_encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        row = first = n = 0
        keys, lengths, raw = [], [], []

        def close() -> pa.RecordBatch:
            nonlocal row, first, n
            blocks, starts = pack(np.frombuffer(b"".join(raw), "<u4"), share)
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([row], pa.int32()), pa.array([first], pa.int64()),
                pa.array([n], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([starts.tolist()], pa.list_(pa.int32())), pa.array([blocks], pa.binary())],
                names=["part", "row", "first", "n_tokens", "doc_ids", "doc_lengths", "block_starts", "blocks"])
            row, first, n = row + 1, first + n, 0
            for x in (keys, lengths, raw):
                x.clear()
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # texts of a whole batch need not be strings at once
                some = batch.slice(start, 256)
                for doc, got in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                    keys.append(doc)
                    lengths.append(len(got) // 4 + 1)
                    raw += (got, end)
                    n += lengths[-1]
                    if n >= ROW_IDS:
                        yield close()
        if keys:
            yield close()

    staged = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    rows = (staged.repartitionByRange("key", tie).sortWithinPartitions("key", tie).mapInArrow(encode, FILE_SCHEMA))
    return saved(rows, "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files; ``ids`` are little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before it: ids before the file, before its row, and in the row.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["blocks"], np.array(r["block_starts"], np.int64)).astype("<u4")
                stops = np.cumsum(r["doc_lengths"])
                starts = stops - r["doc_lengths"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["doc_ids"], pa.int64()), pa.array(starts + r["base"] + r["first"], pa.int64()),
                    pa.array(r["doc_lengths"], pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("base"))
    parts = saved(parts, "token-file-starts")
    # one row per written file
    side = F.broadcast(parts) if parts.count() <= 100_000 else parts
    return (files.join(side, "part").select("base", "first", "doc_ids", "doc_lengths", "block_starts", "blocks")
            .mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary"))


def digests(docs: DataFrame, **args) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the written files."""

    return read_token_files(write_token_files(docs, **args)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))

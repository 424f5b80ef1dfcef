"""Counting quotient filters of word-id n-grams: lossless, compact, sorted and so mergeable.

An n-gram of ids of ``width`` bits is packed into one key of ``n * width`` bits, which is permuted invertibly. The
permuted key's first bits (the quotient) name a slot and need not be stored, the rest (the remainder) is kept
whole, so that keys come back exactly. Keys are held in two halves, ``left`` and ``right`` (at most 32 and 64 bits).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np

_HEADER = "<IB"  # entries, quotient bits after those of the region
U = np.uint64


@dataclass(frozen=True)
class Layout:
    """Ids in a key, bits of an id, and the key's first bits that name a region (a filter holds one region)."""

    n: int
    width: int
    region: int

    @property
    def left(self) -> int:
        bits = self.n * self.width
        return max(bits - 64, min(bits // 2, 32))

    @property
    def right(self) -> int:
        return self.n * self.width - self.left


class Counts(NamedTuple):
    """Keys in ascending order, each once, and how often each occurs."""

    left: np.ndarray
    right: np.ndarray
    n: np.ndarray


def layout(n: int, width: int, entries: int, least_regions: int) -> Layout:
    """A layout whose regions hold some 2**19 of ``entries`` each; ids of up to 32 bits and three of them fit."""
    if n * width > 96 or width > 32:
        raise ValueError("keys of more than 96 bits are not supported")
    left = Layout(n, width, 0).left
    wanted = max(least_regions, entries >> 19, 1)
    return Layout(n, width, min(left, (wanted - 1).bit_length()))


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def _mix(v: np.ndarray, seed: int, bits: int) -> np.ndarray:
    """``bits`` hash bits of each value."""
    with np.errstate(over="ignore"):
        v = (v + U(seed)) * U(0x9E3779B97F4A7C15)
        v ^= v >> U(32)
        v *= U(0xD6E8FEB86659FD93)
    return v >> U(64 - bits) if bits else np.zeros_like(v)


def permuted(left: np.ndarray, right: np.ndarray, form: Layout) -> tuple[np.ndarray, np.ndarray]:
    """A bijection of the keys that spreads them evenly: each half in turn is changed by a hash of the other."""
    left = left ^ _mix(right, 1, form.left)
    right = right ^ _mix(left, 2, form.right)
    return left ^ _mix(right, 3, form.left), right


def restored(left: np.ndarray, right: np.ndarray, form: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``permuted``: the same changes backwards."""
    left = left ^ _mix(right, 3, form.left)
    right = right ^ _mix(left, 2, form.right)
    return left ^ _mix(right, 1, form.left), right


def pack(ids: list[np.ndarray], form: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Halves of the keys of n-grams; ``ids`` has one array per place."""
    w, left, right = U(form.width), np.zeros(len(ids[0]), U), np.zeros(len(ids[0]), U)
    for column in ids:
        up = right >> U(form.right - form.width)
        left = (left << w if form.left > form.width else np.zeros_like(left)) & _mask(form.left) | up
        right = (right << w & _mask(form.right) if form.right > form.width else np.zeros_like(right)) | column.astype(U)
    return left, right


def unpack(left: np.ndarray, right: np.ndarray, form: Layout) -> list[np.ndarray]:
    """The ids of the keys, one array per place."""
    low, out = _mask(form.width), []
    for _ in range(form.n):
        out.append((right & low).astype(np.int64))
        down = (left & low) << U(form.right - form.width)
        right = (right >> U(form.width) if form.right > form.width else np.zeros_like(right)) | down
        left = left >> U(form.width)
    return out[::-1]


def tally(left: np.ndarray, right: np.ndarray, form: Layout, n: np.ndarray | None = None) -> Counts:
    """Sorted distinct keys with their counts (``n`` of each key given, else 1)."""
    if not len(left):
        return Counts(left, right, np.empty(0, np.int64))
    if form.n * form.width <= 64:
        whole = left << U(form.right) | right if form.right < 64 else right
        order = np.argsort(whole, kind="stable")
        whole = whole[order]
        new = whole[1:] != whole[:-1]
    else:
        order = np.lexsort((right, left))
        a, b = left[order], right[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    starts = np.concatenate([[0], np.flatnonzero(new) + 1])
    total = np.diff(np.append(starts, len(order))) if n is None else np.add.reduceat(n[order], starts)
    first = order[starts]
    return Counts(left[first], right[first], total)


def merge(parts: list[Counts], form: Layout) -> Counts:
    """Counts of several sorted filters added up."""
    if len(parts) == 1:
        return parts[0]
    return tally(*(np.concatenate(c) for c in (zip(*((p.left, p.right) for p in parts)))), form, np.concatenate([p.n for p in parts]))


def _bytes(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each value in whole bytes."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)].tobytes()


def _values(data: bytes, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    size = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    return out.view("<u8").ravel().astype(U), at + n * size


def encode(counts: Counts, form: Layout) -> bytes:
    """A filter of the keys of one region.

    A slot's run of remainders is written in unary (a one per entry, a zero at its end), then the remainders, then
    one byte per counter; counters over 255 follow in whole.
    """
    m, free = len(counts.n), form.left - form.region
    q = min(free, max(0, m.bit_length() - 1))
    rest = free - q
    slot = (counts.left & _mask(free)) >> U(rest)
    runs = np.zeros((1 << q) + m, np.uint8)
    runs[slot.astype(np.int64) + np.arange(m)] = 1
    over = counts.n > 255
    return b"".join([struct.pack(_HEADER, m, q), np.packbits(runs).tobytes(), _bytes(counts.left & _mask(rest), rest),
                     _bytes(counts.right, form.right), np.where(over, 0, counts.n).astype(np.uint8).tobytes(),
                     counts.n[over].astype("<i8").tobytes()])


def decode(data: bytes, region: int, form: Layout) -> Counts:
    """Inverse of ``encode``."""
    m, q = struct.unpack_from(_HEADER, data)
    free, at = form.left - form.region, struct.calcsize(_HEADER)
    size = -(-((1 << q) + m) // 8)
    runs = np.unpackbits(np.frombuffer(data, np.uint8, size, at))
    slot = (np.flatnonzero(runs) - np.arange(m)).astype(U)
    low, at = _values(data, at + size, m, free - q)
    right, at = _values(data, at, m, form.right)
    n = np.frombuffer(data, np.uint8, m, at).astype(np.int64)
    n[n == 0] = np.frombuffer(data, "<i8", -1, at + m)
    return Counts(U(region) << U(free) | slot << U(free - q) | low, right, n)


def by_region(counts: Counts, form: Layout):
    """``(region, counts of that region)`` in ascending order."""
    region = (counts.left >> U(form.left - form.region)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(region)) + 1, [len(region)]]) if len(region) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(region[a]), Counts(counts.left[a:b], counts.right[a:b], counts.n[a:b])

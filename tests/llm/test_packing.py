"""Packing against a plain first-fit, exact round trips of the ids, odd rows."""

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import bpe, packing

SCHEMA = "doc_id long, text string, ids string, length string"
SIZES = st.lists(st.one_of(st.integers(1, 70), st.sampled_from([1, 31, 32, 33, 64, 200])), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_tree_places_as_a_plain_first_fit(sizes):
    bins = []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        for b in bins:
            if sum(sizes[j] for j in b) + sizes[k] <= 32:
                b.append(k)
                break
        else:
            bins.append([k])
    assert packing.first_fit_decreasing(sizes, 32) == bins


@settings(max_examples=200, deadline=None)
@given(SIZES, st.booleans())
def test_groups_hold_every_id_once(sizes, top_up):
    got = packing.pack_group(sizes, 32, top_up)
    spots = sorted((p.doc, p.start + k) for s in got for p in s for k in range(p.length))
    assert spots == [(d, k) for d, n in enumerate(sizes) for k in range(n)]
    fills = [sum(p.length for p in s) for s in got]
    assert all(0 < n <= 32 for n in fills)
    if top_up:
        assert sum(packing.padding(n, 32) for n in fills) == 0
        assert sum(n < 32 for n in fills) <= 5  # one sequence cut into powers of two
        pieces = sum(map(len, got))
        assert pieces <= sum(n // 32 + bool(n % 32) for n in sizes) + len(got) + 5


def test_pieces_give_back_every_document(spark, monkeypatch):
    long = "the quick brown fox jumps over it. " * 3000
    texts = ["a b c", None, "", long, "a b c", "<|endoftext|> x", "été\n\n漢字 \x00 z"] + [f"word{k} " * (k % 90) for k in range(300)]
    rows = [(k, t, "i", "l") for k, t in enumerate(texts)] + [(4, "a b c", "i", "l"), (None, "null key", "i", "l")]
    tok = bpe.load(bpe.default_path())
    got = packing.pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_doc[r["doc_id"]].append((r["start"], ids.tolist(), r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], r["padding"]))
    for k, t, *_ in rows:
        want = tok.encode(t or "", add_special_tokens=False).ids + [1]
        times = 2 if k == 4 else 1
        at = []
        for start, ids, n in by_doc[k]:
            assert n == len(want) and ids == want[start:start + len(ids)]
            at += range(start, start + len(ids))
        assert sorted(at) == sorted(list(range(len(want))) * times)
    assert set(by_doc) == {k for k, *_ in rows}
    for pieces in by_sequence.values():
        at = 0
        for offset, length, pad in sorted(pieces):
            assert offset == at and pad == 0
            at += length
        assert at <= packing.LENGTH
    again = packing.pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), ids=False)
    assert {tuple(r)[:8] for r in again.collect()} == {tuple(r)[:8] for r in got}


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []

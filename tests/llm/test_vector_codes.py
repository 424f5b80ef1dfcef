"""Vector codes against a brute-force version in Python integers, and odd rows."""

import hashlib
import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import laesa

SCHEMA = "vec_id long, embedding array<float>, label int, ints string, held string"


def brute(rows, parts=8, entries=16, rounds=6):
    """{vec_id: (code, error)} and the codebooks as text."""
    kept = sorted((k, [math.floor(4096 * x) for x in v]) for k, v, *_ in rows
                  if v is not None and all(x is not None and math.isfinite(x) for x in v))
    w = len(kept[0][1]) // parts
    books = [[v[j * w:(j + 1) * w] for _, v in kept[:entries]] for j in range(parts)]

    def assign():
        out = {}
        for k, v in kept:
            got = [min((sum((a - b) ** 2 for a, b in zip(v[j * w:(j + 1) * w], e)), i) for i, e in enumerate(books[j])) for j in range(parts)]
            out[k] = [i for _, i in got], sum(d for d, _ in got)
        return out

    for _ in range(rounds):
        codes = assign()
        books = [[[sum(col) // len(mine) for col in zip(*mine)] if (mine := [v[j * w:(j + 1) * w] for k, v in kept if codes[k][0][j] == i]) else e
                  for i, e in enumerate(books[j])] for j in range(parts)]
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return {k: ("".join(f"{i:02x}" for i in c), e) for k, (c, e) in assign().items()}, hashlib.sha256(flat.encode()).hexdigest()


def check(spark, rows, **args):
    got = laesa.compress(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5), **args).collect()
    want, books = brute(rows, **args)
    labels = {r[0]: r[2] for r in rows}
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want
    assert len(got) == len(want) and {r["codebooks_sha256"] for r in got} == {books}
    for r in got:
        assert r["label_error"] == sum(e for k, (_, e) in want.items() if labels[k] == labels[r["vec_id"]])


def f32(x):
    return float(np.float32(x))


def test_codes_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = [(k, [f32(rnd.gauss(0, 0.2)) for _ in range(16)], rnd.choice([1, 1, 1, 2, None])) for k in range(150)]
    rows += [(150 + k, rows[7][1], 1) for k in range(100)]  # one very common vector
    rows += [(-1, None, 1), (-2, [None] + [0.5] * 15, 1), (-3, [math.nan] + [0.5] * 15, 2), (-4, [math.inf] + [0.5] * 15, None)]
    check(spark, rows)


def test_ties_and_few_vectors(spark):
    grid = [(k, [float(k % 3), float(k % 2)] * 4, 0) for k in range(40)]
    check(spark, grid)
    check(spark, grid[:5])
    check(spark, [(9, [0.25] * 8, None)])


def test_large_components_are_exact(spark):
    rows = [(k, [f32(90_000.0 + k * 1.37), f32(-200_000.0 / (k + 1))] + [0.001 * k] * 6, k % 2) for k in range(20)]
    check(spark, [(k, [f32(x) for x in v], y) for k, v, y in rows])


def test_odd_rows(spark):
    empty = laesa.compress(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    rows = [(2, [1.0] * 8, 1, "", ""), (2, [1.0] * 8, 1, "", ""), (None, [2.0] * 8, None, "", ""), (3, [1.0] * 7, 1, "", ""),
            (4, [1e30] * 8, 1, "", ""), (5, [], 1, "", "")]
    got = laesa.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["vec_id"]), r["error"], r["label_error"]) for r in got) == [("2", 0, 0), ("2", 0, 0), ("None", 0, 0)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_pruned_search_is_exact_and_evaluates_less(seed):
    rng = np.random.default_rng(seed)
    spread = int(rng.choice([3, 1000, 2**30]))
    entries = rng.integers(-spread, spread, (16, 4))
    rows = np.concatenate([rng.integers(-spread, spread, (60, 4)), entries + rng.integers(-2, 2, entries.shape)])
    pivots = entries[laesa.choose_pivots(entries, 4)]
    code, best, tried = laesa.nearest(rows, laesa.to_pivots(rows, pivots).astype("f4").astype(float), entries, laesa.to_pivots(entries, pivots))
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in entries] for r in rows]
    assert [int(c) for c in code] == [d.index(min(d)) for d in exact]
    assert [int(b) for b in best] == [min(d) for d in exact]
    if spread > 3:
        assert tried < rows.shape[0] * 16 * 0.8

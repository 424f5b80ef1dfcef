"""Collocations against a brute-force version; quotient filters give back what went in."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import collocations as co
from sluice.llm import quotient as cqf

SCHEMA = "doc_id long, text string, lang string, chunk string, words string"


def brute(rows, least, share=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and b >= least and p in (q[:2], q[1:]) and 100 * b >= share * a for q, b in c.items()):
                continue
            s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def rows_of(seed, docs=120):
    rnd = random.Random(seed)
    words = ["the", "The", "new", "york", "times", "ünï", "x\x00y", "漢", "a", "of", "\x1c", "'s"] + [f"r{k}" for k in range(30)]
    weights = [30, 5, 10, 10, 8, 5, 3, 4, 20, 20, 2, 3] + [1] * 30
    out = []
    for k in range(docs):
        parts = rnd.choices(words, weights, k=rnd.randint(0, 60))
        parts = [p if p != "new" or rnd.random() < 0.2 else "new york times" for p in parts]
        text = "".join(p + rnd.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " \x0b"]) for p in parts)
        out.append((k, text, rnd.choice(["en", "en", "fr", None, "und"]), "c", "w"))
    return out + [(900, None, "en", "", ""), (901, "", None, "", ""), (902, " .,\n", "de", "", ""), out[0], out[0]]


def test_collocations_equal_brute_force(spark):
    rows = rows_of(5)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = sorted(tuple(r) for r in co.collocations(docs, least=3).collect())
    want = brute(rows, 3)
    assert got == want and len(got) > 100
    got = sorted(tuple(r) for r in co.collocations(docs, least=3, top=7).collect())
    assert got == brute(rows, 3, top=7)


def test_empty_and_wordless_tables(spark):
    for rows in ([], [(1, None, None, "", ""), (2, "?", "en", "", "")], [(1, "only", "en", "", "")]):
        assert co.collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.integers(2, 3), st.integers(1, 32), st.integers(0, 6), st.integers(0, 2**32 - 1))
def test_filters_give_back_every_count(n, width, regions, seed):
    rng = np.random.default_rng(seed)
    form = cqf.Layout(n, width, min(regions, cqf.Layout(n, width, 0).left))
    shards, want = [], Counter()
    for _ in range(3):
        ids = [rng.integers(0, 1 << width, 40) for _ in range(n)]
        ids = [np.concatenate([c, np.repeat(c[:1], 300)]) for c in ids]  # a counter beyond one byte
        want.update(zip(*(c.tolist() for c in ids)))
        counts = cqf.tally(*cqf.permuted(*cqf.pack(ids, form), form), form)
        shards.append({r: cqf.encode(c, form) for r, c in cqf.by_region(counts, form)})
    got = Counter()
    for r in set().union(*shards):
        whole = cqf.merge([cqf.decode(s[r], r, form) for s in shards if r in s], form)
        back = cqf.unpack(*cqf.restored(whole.left, whole.right, form), form)
        assert len(whole.n) == len(set(zip(*(c.tolist() for c in back))))
        got.update(dict(zip(zip(*(c.tolist() for c in back)), whole.n.tolist())))
    assert got == want


def test_tasks_pass_on_and_merge_in_small_steps(spark, monkeypatch):
    rng = np.random.default_rng(1)
    form = cqf.layout(2, 9, 10_000, 8)
    monkeypatch.setattr(co, "FLUSH", 500)
    monkeypatch.setattr(co, "SLICE", 101)
    import pyarrow as pa

    data = [rng.integers(-1, 300, 900).astype("<i4") for _ in range(6)]
    batches = [pa.RecordBatch.from_arrays([pa.array([d.tobytes()], pa.binary())], names=["ids"]) for d in data]
    filters = [(r, f) for b in co._count(iter(batches), form) for r, f in zip(*(c.to_pylist() for c in b.columns))]
    assert len({r for r, _ in filters}) < len(filters)
    filters.sort(key=lambda x: x[0])
    merged = co._merge(iter([pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([f], pa.binary())], names=["region", "filter"])
                             for r, f in filters]), form, 1)
    got = {(a, b): n for m in merged for a, b, n in zip(*(c.to_pylist() for c in m.columns))}
    want = Counter((int(a), int(b)) for d in data for a, b in zip(d, d[1:]) if a >= 0 and b >= 0)
    assert got == want

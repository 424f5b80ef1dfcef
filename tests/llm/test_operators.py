"""Edge cases and brute-force versions of the training-data operators."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import bpe, decontaminate, jaccard, language_id, line_dedup, merkle, mixing, preference, token_counts, token_files, toxicity
from sluice.llm.common import bitmap, in_bitmap

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size string"
LONG = "the quick brown fox jumps over it. " * 3000
ODD = [
    (1, "a b c d e f g", "en", "s1", 13, "x", "y"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "s1", 0, "x", "y"),
    (4, "a b c d e f g", "en", "s2", 13, "x", "y"),
    (5, LONG, "en", "s2", len(LONG), "x", "y"),
    (6, "  \n\n \t ", "fr", None, 6, "x", "y"),
    (7, "a b c d e f g", "en", "s1", 13, "x", "y"),
    (7, "a b c d e f g", "en", "s1", 13, "x", "y"),
    (8, "one\ntwo\nthree\nfour\none\ntwo\nthree", "en", "s3", 0, "x", "y"),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bitmap_holds_every_value(spark):
    values = np.random.default_rng(0).integers(-(2**62), 2**62, 500)
    words = bitmap(spark.createDataFrame([(int(v),) for v in values] + [(None,)], "v long"), 14)
    assert in_bitmap(14, words, values).all()
    assert in_bitmap(14, words, np.arange(10**6, 10**6 + 1000)).mean() < 0.1


# token counts and token files

PIECES = st.sampled_from(["a", "the", " ", "  ", "\n", "\n\n", " \n", "'", "'re", "don't", "12", ".", "!!", "é", "漢", "\t", "\x00",
                          "\x1c", "　", "<|endoftext|>", "<|end", " 're", "---", "word", "🙂"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=10).map("".join))
def test_counts_at_every_prefix_equal_the_library(text):
    path = bpe.default_path()
    tok = bpe.load(path)
    want = [len(tok.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]
    assert bpe.prefix_counter(path).counts(text).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=10).map("".join), max_size=5))
def test_cached_ids_equal_the_library(texts):
    path = bpe.default_path()
    got = [np.frombuffer(b, "<u4").tolist() for b in bpe.id_encoder(path).encode(texts)]
    assert got == [bpe.load(path).encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 60), max_size=2500), st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, share):
    ids = np.array(ids, np.uint32)
    blocks, starts = token_files.pack(ids, share)
    starts = starts.astype(np.int64)
    assert np.array_equal(token_files.unpack(blocks, starts), ids)
    if len(starts) > 1:
        assert np.array_equal(token_files.unpack(blocks, starts[1:2]), ids[token_files.BLOCK:2 * token_files.BLOCK])


def test_token_counts_and_files_of_odd_rows(odd, empty):
    tok = bpe.load(bpe.default_path())
    n = {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in ODD}
    rows = token_counts.count_prefixes(odd, limit=5, keep=True)
    for r in rows.collect():
        text = dict((i, t or "") for i, t, *_ in ODD)[r.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n[r.doc_id], n[r.doc_id] > 5)
        best = max(k for k in range(min(len(text), 60) + 1) if len(tok.encode(text[:k], add_special_tokens=False).ids) <= 5)
        assert r.fits_chars == best
    asked = rows.select("doc_id", token_counts.tokens_before(F.col("prefix_steps"), F.lit(3)).alias("t"),
                        token_counts.chars_within(F.col("prefix_steps"), F.lit(1)).alias("c")).where("doc_id = 1").first()
    assert (asked.t, asked.c) == (len(tok.encode("a b", add_special_tokens=False).ids), 1)
    assert token_counts.count_prefixes(empty).count() == 0
    at = 0
    for r in sorted(token_files.digests(odd).collect(), key=lambda r: (r.doc_id, r.start)):
        text = dict((i, t or "") for i, t, *_ in ODD)[r.doc_id]
        ids = tok.encode(text, add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert token_files.digests(empty).count() == 0


# fingerprints

def test_fingerprints_locate_edits():
    a = "One. Two.\nThree.\n\nFour."
    b = "One. Two.\nThree!\n\nFour."
    assert merkle.fingerprint(a) == merkle.fingerprint(str(a)) != merkle.fingerprint(b)
    assert merkle.differing_branches(merkle.fingerprint(a), merkle.fingerprint(b)) == [(0, 1)]
    assert merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) == 0.75
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1.0
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(a)) == 0.0
    texts = ["", " ", "\n", "\n\n", "a\n\nb", "a\n \nb", "a\n\n\nb", "a\nb", "ab", "a. b", "a.b"]
    assert len({merkle.fingerprint(t) for t in texts}) == len(texts)


def test_fingerprints_of_odd_rows(odd, empty):
    rows = sorted(((i, t or "") for i, t, *_ in ODD), reverse=True)
    want = Counter()
    for k, (i, t) in enumerate(rows):
        following, cut = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[:len(t) - cut] + following[:cut]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), merkle.fingerprint(t), merkle.fingerprint(edited)] += 1
    got = merkle.fingerprint_edits(odd.repartition(5)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got) == want
    assert merkle.fingerprint_edits(empty).count() == 0
    one = merkle.fingerprint_edits(odd.where("doc_id = 1")).first()
    assert one.near_next == 1.0


# language ID and toxicity

def test_language_id(spark, odd, empty):
    words = {"en": "the and with house", "de": "der und mit über straße", "ru": "это дом и мир"}
    rows = [(k, " ".join(np.random.default_rng(k).permutation((words[g] * 4).split())), g) for k, g in enumerate(list(words) * 40)]
    docs = spark.createDataFrame(rows + [(900, None, "en"), (901, "123 !!", "de"), (902, "the house", None)], "doc_id long, text string, lang string")
    model = language_id.train(docs, F.col("doc_id") % 5 != 1)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(got[i].lang_pred == g and 0 <= got[i].score <= 1 for i, _, g in rows)
    assert (got[900].lang_pred, got[901].lang_pred, got[902].lang_pred) == ("und", "und", "en")
    assert language_id.train(empty, F.lit(True)) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def _maximal(scores):
    """All maximal-scoring segments by their recursive definition."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    a, b = best[3], best[4]
    return _maximal(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in _maximal(scores[b:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("bbbcn"), max_size=14))
def test_segments_are_the_maximal_ones(letters):
    model = toxicity.Model(scores={"b": 1.0, "c": 2.5}, other=-0.625)
    n, found = toxicity.segments(model, " ".join(letters))
    values = [model.scores.get(x, model.other) for x in letters]
    assert n == len(letters)
    assert [(a, b) for _, a, b, _ in found] == _maximal(values)
    assert all(s == pytest.approx(sum(values[a:b])) and k == sum(x != "n" for x in letters[a:b]) for s, a, b, k in found)


def test_toxicity(spark, odd, empty):
    rng = np.random.default_rng(3)
    vocab = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(600):
        words = list(rng.choice(vocab, 60))
        if k % 6 == 0:
            words[20:30] = list(rng.choice(["bad", "worse", "vile"], 10))
        rows.append((k, " ".join(words), int(k % 6 == 0)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.col("key") % 4 != 2)
    got = {r.row.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[k].predicted == y for k, _, y in rows)
    assert [(p.start, p.stop) for p in got[0].passages] == [(20, 30)]
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(empty, model).count() == 0
    nothing = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(odd, nothing).collect()} == {0}


# n-gram Jaccard join

def _brute(rows, percent=75):
    def tokens(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [(i, tokens(t)) for i, t in rows]
    comp = {i: i for i, _ in rows}
    for _ in rows:
        for i, a in sets:
            for j, b in sets:
                if i != j and a and b and 100 * len(a & b) >= percent * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    return {i: (len(s), comp[i]) for i, s in sets}


@pytest.mark.parametrize("least,hot,block", [(32, 64, 512), (1, 64, 512), (1, 1, 3)])
def test_jaccard_equals_brute_force(spark, monkeypatch, least, hot, block):
    for name, value in (("FREQUENT_LEAST", least), ("HOT", hot), ("BLOCK", block)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(7)
    base = [list(rng.choice([f"w{k}" for k in range(400)], n)) for n in (6, 9, 14, 40, 90)]
    rows = [(1000, None), (1001, ""), (1002, " \n "), (1003, "One two"), (1004, "one TWO"), (1005, "one  two\n"), (1006, "É a b"), (1007, "é a b")]
    for k in range(70):
        words = list(base[k % 5])
        for _ in range(rng.integers(0, 3)):
            words[rng.integers(0, len(words))] = f"x{rng.integers(0, 50)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == _brute(rows)


def test_jaccard_of_odd_rows(odd, empty, spark):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd).collect())
    assert [x for x in got if x[0] in (1, 4, 7)] == [(1, 3, 1), (4, 3, 1), (7, 3, 1), (7, 3, 1)]
    assert [x[1:] for x in got if x[0] in (2, 3, 6)] == [(0, 2), (0, 3), (0, 6)]
    assert jaccard.jaccard_components(empty).count() == 0
    lone = spark.createDataFrame([(None, "a b c"), (4, "a b c")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard.jaccard_components(lone).collect()) == [(0, 0), (4, 4)]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60)))
def test_linked_sets_share_a_signature(a, b, often):
    spread = lambda s: np.unique(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x, y, hot = spread(a), spread(b), spread(often) if often else np.empty(0, np.uint64)
    if jaccard.linked(x, y, 75):
        shared = [np.intersect1d(p, q) for p, q in zip(jaccard.signatures(x, np.isin(x, hot), 75), jaccard.signatures(y, np.isin(y, hot), 75))]
        assert sum(map(len, shared))
        assert jaccard.may_link(jaccard._cells(x), jaccard._cells(y), len(x), len(y), 75)


# benchmark decontamination

def _distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        row, before = [i], row
        for j, d in enumerate(t, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc ", min_size=1, max_size=12), st.text("abc ", max_size=30))
def test_bit_parallel_distance(pattern, text):
    assert decontaminate.best_match(pattern, text)[0] == _distance(pattern, text)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=20, max_size=30), st.text("ab", max_size=20), st.text("ab", max_size=20),
       st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["", "c", "ab"])), max_size=2))
def test_search_equals_brute_force(item, before, after, edits):
    copy = item
    for at, by in edits:
        copy = copy[:at] + by + copy[at + 1:]
    text = before + copy + after
    got = decontaminate.Searcher(((9, item),), 0.08).search(text)
    distance = _distance(item, text)
    assert (9 in got) == (distance <= int(0.08 * len(item)))
    assert not got or got[9][0] == distance


def test_many_blocks_of_items_find_what_one_finds(spark, monkeypatch):
    from conftest import SF001
    from sluice.llm.common import table

    docs, items = table(spark, SF001, "documents").select("doc_id", "text"), table(spark, SF001, "benchmark")
    leaks = lambda: {r.doc_id: sorted(map(tuple, r.leaks)) for r in decontaminate.find_leaks(docs, items).collect()}
    one = leaks()
    assert any(one.values())
    total = items.agg(F.sum(F.length("text"))).first()[0]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", total // 4)
    assert leaks() == one
    found = decontaminate.find_leaks(docs, items)
    assert "ArrowEvalPython" not in found._jdf.queryExecution().executedPlan().toString()  # every block's result is written
    # a text column of the result's own name, and no other column
    named = docs.select(F.col("text").alias("leaks"))
    assert sorted(sorted(map(tuple, r.leaks)) for r in decontaminate.find_leaks(named, items, text="leaks").collect()) == sorted(one.values())


def test_leaks_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "The QUICK brown\nfox jumps over it."), (2, None), (3, ""), (None, "x" * 40), (4, "short"),
                                   (1, "nowhere to be found in any text")], "item_id long, text string")
    got = {r.doc_id: [x["item"] for x in r.leaks] for r in decontaminate.find_leaks(odd, items).collect()}
    assert got == {i: [1] if i == 5 else [] for i, *_ in ODD}
    assert decontaminate.find_leaks(empty, items).count() == 0
    assert decontaminate.find_leaks(odd, items.limit(0)).where(F.size("leaks") > 0).count() == 0


# line dedup, mixing, preference formatting

def test_line_dedup_of_odd_rows(odd, empty):
    got = {r.row.doc_id: r for r in line_dedup.dedup_lines(odd).collect()}
    assert (got[8].deduped, got[8].removed) == ("one\ntwo\nthree\nfour", [4, 5, 6])
    assert got[2].deduped is None and got[2].n_lines == 0 and got[3].deduped == "" and got[6].deduped == "  \n\n \t "
    assert line_dedup.dedup_lines(empty).count() == 0
    assert "row" in got[1].row.asDict()


def test_line_dedup_merges_overlaps(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb\nq"), (4, "r\nr\nr\nr\nr")], "doc_id long, text string")
    got = {r.row.doc_id: r.deduped for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: "a\nb\nc\nd\ne", 2: "x\ny", 3: "a\nb\nq", 4: "r"}


def _plan(sizes, share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, total, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = total / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > cap * sizes[s] + 1e-9}
        if not over:
            return left | {s: weight[s] * level for s in open_}
        left |= {s: cap * sizes[s] for s in over}
        total -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return left


@pytest.mark.parametrize("seed", range(3))
def test_mixing_plan_equals_resharing(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {s: int(rng.integers(0, 1000)) for s in ["b", "a", "Z", "é", None, "c", "d"]}
    docs = spark.createDataFrame([(k, "w " * n, s) for k, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
    got = {r.source: r.target for r in mixing.source_plan(docs).collect()}
    assert got == pytest.approx(_plan(sizes))


def test_mixing_of_odd_rows(odd, empty):
    rows = mixing.with_copies(odd).collect()
    assert len(rows) == len(ODD) and all(0 <= r.copies <= 2 for r in rows)
    again = mixing.with_copies(odd.repartition(7)).collect()
    assert Counter((r.row.doc_id, r.copies) for r in rows) == Counter((r.row.doc_id, r.copies) for r in again)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(empty).count() == 0


def test_preference_formatting(spark):
    turns = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame([
        (1, [("user", "hi"), ("assistant", "yes")], [("user", "hi"), ("assistant", "no"), ("user", "why")]),
        (2, [("user", "hi")], [("user", "hi"), ("assistant", None)]), (3, None, [("user", "a")]), (4, [], [])],
        f"pair_id int, chosen {turns}, rejected {turns}")
    got = {r.row.pair_id: r for r in preference.format_preferences(pairs).collect()}
    one = got[1]
    assert one.prompt == "<|user|>\nhi<|end|>\n" and one.n_prefix == 1
    assert one.chosen_text == "<|assistant|>\nyes<|end|>\n"
    assert [one.chosen_text[s.start:s.stop] for s in one.chosen_mask] == ["yes<|end|>\n"]
    assert [one.rejected_text[s.start:s.stop] for s in one.rejected_mask] == ["no<|end|>\n"]
    assert (got[2].n_prefix, got[2].chosen_text, len(got[2].rejected_mask)) == (1, "", 1)
    assert (got[3].n_prefix, got[3].prompt, got[3].rejected_text) == (0, "", "<|user|>\na<|end|>\n")
    assert (got[4].prompt, got[4].chosen_text) == ("", "")


def test_pairs_share_an_opening(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q"), (2, 1, "assistant", "b"), (3, 0, "user", "z"),
            (3, 1, "assistant", "c"), (3, 2, "user", "more"), (3, 3, "assistant", "d"), (4, 0, "user", None), (None, 0, "user", "q"),
            (5, 0, "system", "alone")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in preference.pairs_of(conv).collect()}
    assert {i: r.chosen_id for i, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    assert [t.text for t in got[2].chosen] == ["q", "a"] and [t.text for t in got[2].rejected] == ["q", "b"]
    assert [t.text for t in got[3].rejected] == ["z", "c", "more", "c"]
    assert [t.text for t in got[1].rejected] == ["q", ""]
    assert preference.format_preferences(preference.pairs_of(conv.limit(0))).count() == 0


def test_words_are_ascii_separated():
    assert len(re.findall(r"[^\x20\x09-\x0D]+", "a\xa0b c")) == len("a\xa0b c".encode().split()) == 2

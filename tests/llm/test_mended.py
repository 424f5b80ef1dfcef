"""Rows that share a key or have none, texts that differ in blank lines only, and the SQL twins on small tables."""

import os
import sys
import tracemalloc

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import bpe, common, jaccard, line_dedup, merkle, mixing, registry

DOCS = "doc_id long, text string, lang string, source string, row string, key string, doc string"


def test_line_dedup_tells_rows_of_one_key_apart(spark):
    rows = [(2, "a\nb\nc\nd"), (2, "one\ntwo\nthree\nfour\nfive\nsix"), (1, "a\nb\nc"), (None, "x\ny\nz\na\nb\nc"), (None, "U1\nU2\nU3\nU4"),
            (None, "x\ny\nz\na\nb\nc"), (3, "x\ny\nz"), (4, None)]
    docs = spark.createDataFrame([(*r, "l", "s", "r", "k", "d") for r in rows], DOCS)
    got = sorted(((str(r["row"]["doc_id"]), r["deduped"]) for r in line_dedup.dedup_lines(docs).collect()), key=str)
    whole = ("None", "x\ny\nz\na\nb\nc")
    assert got == sorted([("2", "d"), ("2", "one\ntwo\nthree\nfour\nfive\nsix"), ("1", ""), whole, ("None", "U1\nU2\nU3\nU4"), whole,
                          ("3", ""), ("4", None)], key=str)


PARTS = st.lists(st.sampled_from(["a", "b", "\n", "\n\n", ".", " "]), max_size=12).map("".join)


@settings(max_examples=600, deadline=None)
@given(PARTS, PARTS)
def test_equal_roots_mean_equal_texts(a, b):
    same = merkle.fingerprint(a).partition(":")[0] == merkle.fingerprint(b).partition(":")[0]
    assert same == (a == b)


def test_blank_lines_are_part_of_the_root():
    a, b = (merkle.fingerprint(t) for t in ("a\n\nb\n\n\nc", "a\n\n\nb\n\nc"))
    assert a.partition(":")[0] != b.partition(":")[0]


def test_an_inserted_paragraph_is_one_differing_branch():
    lines = [f"Paragraph {k} says something. And more of it." for k in range(12)]
    text = "\n\n".join("\n".join(lines[k:k + 4]) for k in (0, 4, 8))
    more = text.replace(lines[5], lines[5] + "\nAn inserted one.")
    assert merkle.differing_branches(merkle.fingerprint(text), merkle.fingerprint(more)) == [(1, 2)]
    less = text.replace(lines[2] + "\n", "")
    assert merkle.differing_branches(merkle.fingerprint(text), merkle.fingerprint(less)) == [(0, 2)]
    changed = text.replace("Paragraph 9 says", "Paragraph nine says")
    assert merkle.differing_branches(merkle.fingerprint(text), merkle.fingerprint(changed)) == [(2, 1)]
    assert merkle.differing_branches(merkle.fingerprint(text), merkle.fingerprint("New section.\n\n" + text)) == [(0, 0)]
    assert merkle.differing_branches(merkle.fingerprint(text), merkle.fingerprint(text)) == []


def test_rows_without_a_key_do_not_decide_alike(spark):
    docs = spark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("w "), F.col("id")).alias("text"),
                                   F.when(F.col("id") < 300, "a").otherwise("b").alias("source"))
    got = mixing.with_copies(docs, weights=(1, 1)).groupBy("row.source").agg(F.sum("copies").alias("n")).collect()
    assert all(400 < r["n"] < 500 for r in got)


def test_sql_twins_match_on_odd_rows(spark, tmp_path):
    rows = [(k, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, 0) for k, t in enumerate(
        ["a\nb\nc\nd", "x\na\nb\nc", None, "", "b c d e. New york, new york; new york", "\n\n\n", "one"] + ["New York times a b c\nb c"] * 12)]
    rows += [(None, "a\nb\nc\nz", "en", "s1", 0), (None, "q\nr\ns", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("op9_line_dedup", "op10_mixing", "op12_collocations"):
        got = registry.QUERIES[name](spark, str(tmp_path))
        want = con.execute(registry.ORACLE_SQL[name])
        names = [c[0] for c in want.description]
        rows_ = sorted((str(tuple(r[c] for c in names)) for r in got.collect()))
        assert rows_ == sorted(str(t) for t in want.fetchall()), name


def test_prefix_counts_survive_full_tables(monkeypatch):
    """With tables of a few entries, which are set aside all the time, counts at every prefix are still the library's."""
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 4)
    counter = bpe.PrefixCounter(bpe.default_path())
    tok = bpe.load(bpe.default_path())
    for text in ("the quick brown foxes jumped, jumped again: naïveté!", "übergrößenträger straße 日本語テキスト ok", "aaaaaaaaaaaaaaaaaaaaaaaa zzzzzzzz"):
        want = [len(tok.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]
        assert counter.counts(text).tolist() == want
        assert counter.counts(text).tolist() == want


def test_discard_deletes_only_saved_tables(spark):
    one, two = common.saved(spark.range(3), "kept"), common.saved(spark.range(4), "gone")
    common.discard(two, spark.range(1))
    assert one.count() == 3
    assert not os.path.exists(two.saved_at.removeprefix("file:"))
    common.release_memory()


def test_jaccard_links_across_size_levels_in_hot_groups(spark, monkeypatch):
    """Sets of every size from 60 to 99 that share hot entries: each links with the next ones, across levels and blocks."""
    for name, value in (("FREQUENT_LEAST", 1), ("HOT", 1), ("BLOCK", 4)):
        monkeypatch.setattr(jaccard, name, value)
    texts = [(k, " ".join(f"w{j}" for j in range(64 + k))) for k in range(40)] + [(100, " ".join(f"x{j}" for j in range(80)))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {k: (60 + k, 0) for k in range(40)} | {100: (76, 100)}


CHUNKS = ["übergrößen.\nDie", "a.\nb,\nc", "x123", "12.5%", "wort$$$", "\n", "a\n\nb", "\nab", "don't", "'s", "a²", "½", "日本語。", "e\u0301t", "<|endoftext|>",
          "a<|endoftext|>b", "<|endof", "one", "two,", "\t", "", "", "<a|b>", "_x_", "\u2028", "tail\n"]


def test_ids_of_plain_pieces_equal_the_library(monkeypatch):
    """Chunks cut here and chunks left to the library, over tables of a few entries and batches of a few chunks."""
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 8)
    monkeypatch.setattr(bpe, "BATCH_CHUNKS", 7)
    tok = bpe.load(bpe.default_path())
    rng = np.random.default_rng(0)
    texts = ["", "\0", "a\0b c", *(" ".join(rng.choice(CHUNKS, 9)) for _ in range(300))]
    got = [np.frombuffer(b, "<u4").tolist() for b in bpe.IdEncoder(bpe.default_path()).encode(texts)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_pieces_are_the_pre_tokenizer_s():
    pre = bpe.load(bpe.default_path()).pre_tokenizer
    letters = "".join(chr(c) for c in range(0x110000) if chr(c).isalpha())
    assert len(pre.pre_tokenize_str(letters)) == 1  # Python's letters are the library's
    for key in CHUNKS:
        for mark, lead in (("", " "), ("\0", "")):
            pieces = bpe.plain_pieces(mark + key)
            if pieces:
                text = lead + key
                assert [lead * (k == 0) + p.lstrip("\0") for k, p in enumerate(pieces)] == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)], key
    assert bpe.plain_pieces("wort.\nDie") == ("wort", "\0.", "\0\n", "\0Die")
    assert all(bpe.plain_pieces(k) is None for k in ("don't", "a²", "a\n\nb", "tail\n", "\nab", "日本語。"))


class _Counting:
    """The library, counting the calls for ids of whole texts."""

    def __init__(self, tok):
        self.tok, self.texts = tok, []

    def encode_batch_fast(self, texts, **args):
        self.texts += texts
        return self.tok.encode_batch_fast(texts, **args)


def test_new_plain_chunks_are_asked_in_one_call():
    """New chunks of letters, marks and line ends take one call a batch, to the model, with each piece once."""
    encoder = bpe.IdEncoder(bpe.default_path())
    encoder.tok, encoder.model = _Counting(encoder.tok), _Counting(encoder.model)
    encoder.encode(["one two, three.\nOne", "one, two. three, four.\nOne"])
    assert not encoder.tok.texts
    (asked,) = encoder.model.texts
    pieces = [p for p in asked if p != "Ġ"]  # a lone space stands before a piece that has none
    assert sorted(pieces) == sorted(["one", "Ġtwo", "Ġthree", "Ġfour", ",", ".", "Ċ", "One"])


def test_prefix_counts_of_plain_chunks_need_no_pre_tokenizer(monkeypatch):
    counter = bpe.PrefixCounter(bpe.default_path())
    tok = bpe.load(bpe.default_path())
    monkeypatch.setattr(counter, "run", lambda text: pytest.fail(f"pre-tokenized {text!r}"))
    for text in ("wort.\nDie x", "a 12.5% b", "die $$$ und###"):
        want = [len(tok.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]
        assert counter.counts(text).tolist() == want


def _words(n, seed=0):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäöüßéñ"))
    return ["".join(w) for w in letters[rng.integers(0, len(letters), (n, 8))]]


def test_what_an_encoder_remembers_is_small():
    """A worker's memory of pieces: well under the 150 bytes each that strings in a dictionary take."""
    words = _words(60_000)
    encoder = bpe.IdEncoder(bpe.default_path())
    encoder.encode(["warm up"])
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for k in range(0, len(words), 5000):
        encoder.encode([" ".join(words[k:k + 5000])])
    after = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert after - before < 110 * len(words)


def test_ids_stay_right_over_longer_texts_and_a_table_that_fills_up(monkeypatch):
    """Pieces longer than a key, batches that outgrow the table, empty texts alone in a batch."""
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 500)
    monkeypatch.setattr(bpe, "BATCH_CHUNKS", 300)
    tok = bpe.load(bpe.default_path())
    words = [*_words(900, 1), *("x" * k for k in range(20, 30)), "ä" * 12, "ä" * 13, "日" * 8, "日" * 9, *CHUNKS]
    rng = np.random.default_rng(2)
    texts = ["", *(" ".join(rng.choice(words, 700)) for _ in range(12)), "", " ", "  a ", "a  b", "a \n b", "\n"]
    for some in (texts, [""], []):
        got = [np.frombuffer(b, "<u4").tolist() for b in bpe.IdEncoder(bpe.default_path()).encode(some)]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in some]


def test_new_pieces_cost_no_python_call_each():
    """Calls of Python or C functions while texts of new words are encoded: some a batch, none a word."""
    words = _words(4000, 3)
    encoder = bpe.IdEncoder(bpe.default_path())
    encoder.encode(["warm up."])
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        encoder.encode([" ".join(words[k:k + 40]) + "." for k in range(0, len(words), 40)])
    finally:
        sys.setprofile(None)
    assert calls < len(words)

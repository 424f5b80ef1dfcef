"""Document fingerprints: a Merkle tree over sections, paragraphs and the sentences in them."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import saved, table

_SECTIONS = re.compile(r"\n[ \t]*\n\s*")
#: A leaf: up to the marks that end a sentence; longer runs are cut every 160 characters.
_LEAVES = re.compile(r"[^.!?]{0,160}[.!?]+\s*|[^.!?]{1,160}")
SHORT = 8  # hex digits of a leaf in a fingerprint


def fingerprint(text: str) -> str:
    """``root:leaves`` of a text: sections separated by ``/``, their paragraphs by ``.``, leaves of 8 hex digits each.

    Sections are separated by blank lines, paragraphs by line ends. A node hashes its children's hashes, the
    root its sections' and, length first, the white space after each, so equal roots mean equal texts, and a branch
    (section or paragraph) in which two fingerprints differ holds an edit.
    """
    digest = hashlib.blake2b
    sections, shown = [], []
    for section in _SECTIONS.split(text):
        paragraphs, parts = [], []
        for paragraph in section.split("\n"):
            leaves = [digest(x.encode(), digest_size=16).digest() for x in _LEAVES.findall(paragraph)]
            paragraphs.append(digest(b"".join(leaves), digest_size=16, person=b"paragraph").digest())
            parts.append("".join([x[:SHORT // 2].hex() for x in leaves]))
        sections.append(digest(b"".join(paragraphs), digest_size=16, person=b"section").digest())
        shown.append(".".join(parts))
    gaps = [g.encode() for g in _SECTIONS.findall(text)] + [b""]
    nodes = b"".join([node + len(gap).to_bytes(8, "little") + gap for node, gap in zip(sections, gaps)])
    root = digest(nodes, digest_size=16, person=b"root").hexdigest()
    return root + ":" + "/".join(shown)


def _leaves(print_: str) -> Counter:
    flat = print_.partition(":")[2].replace("/", "").replace(".", "")
    return Counter([flat[k:k + SHORT] for k in range(0, len(flat), SHORT)])


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else the share of leaves (twice the common ones over both counts), 0 where there are none."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return 1.0
    x, y = _leaves(a), _leaves(b)
    both = x.total() + y.total()
    return 2 * (x & y).total() / both if both else 0.0


def differing_branches(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) places at which two fingerprints differ; none for equal roots.

    Sections are aligned by what they hold, and only those without an equal partner are entered, where
    paragraphs are aligned likewise: an inserted paragraph or section marks itself and nothing after it. Places
    are those of ``b``, or of ``a`` for what ``b`` lacks.
    """
    if a.partition(":")[0] == b.partition(":")[0]:
        return []
    x, y = ([s.split(".") for s in p.partition(":")[2].split("/")] for p in (a, b))
    out = set()
    for _, i, j, k, m in _unequal(list(map(tuple, x)), list(map(tuple, y))):
        for n in range(max(j - i, m - k)):
            if n >= j - i:
                out |= {(k + n, q) for q in range(len(y[k + n]))}
            elif n >= m - k:
                out |= {(i + n, p) for p in range(len(x[i + n]))}
            else:
                for _, p, q, r, t in _unequal(x[i + n], y[k + n]):
                    out |= {(k + n, u) for u in range(r, t)} or {(i + n, u) for u in range(p, q)}
    return sorted(out)


def _unequal(x: list, y: list) -> list[tuple]:
    return [o for o in SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if o[0] != "equal"]


_ROW = ("kind string, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, text string")
_NAMES = [f.split()[0] for f in _ROW.split(", ")]


def _against(doc_id, text: str, print_: str, following: str, following_print: str) -> tuple:
    cut = len(text) // 2
    edited = text[:len(text) - cut] + following[:cut]
    edited_print = fingerprint(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), print_, edited_print,
            likeness(print_, edited_print), likeness(print_, following_print))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=_NAMES)


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit by the next text in descending key order (after the last: the first).

    A null text is empty; a null key comes last; rows of one key are ordered by the text's hash, and equal
    rows are neighbours of each other. Keys are long; other columns are not read.

    The texts are shuffled once, by ranges of keys, and each task walks its range in order. Only a range's
    last document lacks its next one: these, one per range, are matched with the first of the next range.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                print_ = fingerprint(whole)
                if before is None:
                    rows.append(("first", part, doc, None, None, print_, None, None, None, whole))
                else:
                    rows.append(("full", part, *_against(*before, whole, print_), None))
                before = (doc, whole, print_)
                if len(rows) >= 1000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
        if before:
            yield _batch([("last", part, before[0], None, None, before[2], None, None, None, before[1])])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch([("full", None, *_against(r["doc_id"], r["text"], r["fingerprint"], r["next_text"],
                                                       r["next_print"]), None)])

    staged = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").desc_nulls_last(), F.xxhash64("text")]
    out = saved(staged.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(walk, _ROW), "fingerprints")
    first = out.where("kind = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"),
                                               F.col("fingerprint").alias("next_print"))
    parts = out.where("kind = 'first'").select("part")  # one row per range
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                                F.min("part").over(Window.partitionBy())).alias("next_part"))
    ends = (out.where("kind = 'last'").select("part", "doc_id", "text", "fingerprint").join(following, "part")
            .join(first, "next_part").select("doc_id", "text", "fingerprint", "next_text", "next_print"))
    whole = out.where("kind = 'full'").unionByName(ends.mapInArrow(close, _ROW))
    return whole.drop("kind", "part", "text").withColumnRenamed("doc_id", key)


def op2_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))

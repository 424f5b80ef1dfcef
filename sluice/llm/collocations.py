"""Phrase collocation mining: n-gram counts in counting quotient filters, merged across shards, then scored exactly."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import quotient as cqf
from sluice.llm.common import bitmap, in_bitmap, saved, table

#: Words after which a task closes a chunk, and entries after which it passes on what it has counted.
CHUNK, FLUSH = 1 << 20, 1 << 20
#: Texts, and ids of a chunk, that a task works on at a time.
BATCH, SLICE = 256, 1 << 18
#: Bits of the map of frequent word pairs (16 MB at most); what it holds wrongly only costs time.
BITMAP_BITS = (16, 27)
#: A-Z become a-z, and a piece ends at one of ``.,;:!?`` or a byte from 0A to 0D.
_CLEAN = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Numbers(dict):
    """Numbers words as they come; ``seen`` collects (language, word) over all languages of a chunk."""

    def __init__(self, lang: str, seen: list) -> None:
        self.lang, self.seen = lang, seen

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.seen)
        self.seen.append((self.lang, word))
        return n


_ROW = pa.schema([("chunk", pa.int64()), ("local", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()),
                  ("ids", pa.binary())])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as chunks: a row per distinct word of a chunk (``local`` is its number there), and a row with ``local`` -1
    that holds the text as numbers of words, -1 after each piece."""
    part, made = TaskContext.get().partitionId(), 0
    seen: list[tuple[str, bytes]] = []
    numbers: dict[str, _Numbers] = {}
    ids = array("i")

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal made, ids
        got, m = np.frombuffer(ids, np.int32), len(seen)
        name = part << 32 | made
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([-1], pa.int32()), *(pa.nulls(1, t) for t in _ROW.types[2:5]),
                                          pa.array([got.astype("<i4").tobytes()], pa.binary())], schema=_ROW)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(m, name)), pa.array(np.arange(m, dtype=np.int32)), pa.array([x for x, _ in seen], pa.string()),
            pa.array([x for _, x in seen], pa.binary()).cast(pa.string()), pa.array(np.bincount(got[got >= 0], minlength=m)),
            pa.nulls(m, pa.binary())], schema=_ROW)
        made += 1
        seen.clear()
        numbers.clear()
        ids = array("i")

    for whole in batches:
        for start in range(0, whole.num_rows, BATCH):
            batch = whole.slice(start, BATCH)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                number = numbers.get(lang)
                if number is None:
                    number = numbers[lang] = _Numbers(lang, seen)
                of = number.__getitem__
                for piece in text.translate(_CLEAN).split(b"\n"):
                    words = piece.split()
                    if words:
                        ids.extend(map(of, words))
                        ids.append(-1)
                if len(ids) >= CHUNK:
                    yield from close()
    if ids:
        yield from close()
    pa.default_memory_pool().release_unused()  # workers are used again for other stages


def _renumber(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Chunks with the words' ids of the whole corpus, from rows sorted by chunk and local number; words without an id become -1."""
    own, chunk, local, whole = None, None, [], []

    def done() -> pa.RecordBatch:
        of = np.full(int(own.max(initial=-1)) + 2, -1, kind)  # the last place is that of -1
        for k, v in zip(local, whole):
            of[k] = v
        got = of[own]
        cut = got >= 0
        cut[1:] |= cut[:-1]  # one -1 ends a run as well as many
        return pa.RecordBatch.from_arrays([pa.array([got[cut].tobytes()], pa.binary())], names=["ids"])

    for batch in batches:
        chunks, locals_, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a and chunks[a] != chunk:
                if own is not None:
                    yield done()
                own, chunk, local, whole = np.frombuffer(batch.column(3)[a].as_py(), "<i4"), chunks[a], [], []
                a += 1
            local.append(locals_[a:b].astype(np.int64))
            whole.append(ids[a:b])
    if own is not None:
        yield done()


def id_kind(width: int) -> str:
    return "<i4" if width < 32 else "<i8"


def _count(batches: Iterator[pa.RecordBatch], form: cqf.Layout, pairs=None) -> Iterator[pa.RecordBatch]:
    """Filters by region of the n-grams of a task's chunks; with ``pairs``, only of those all whose word pairs it may hold."""
    held: list[cqf.Counts] = []

    def packed(counts: cqf.Counts) -> pa.RecordBatch:
        rows = [(r, cqf.encode(c, form)) for r, c in cqf.by_region(counts, form)]
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([f for _, f in rows], pa.binary())],
                                          names=["region", "filter"])

    def passed_on(everything: bool) -> Iterator[pa.RecordBatch]:
        if held and (everything or sum(len(c.n) for c in held) > FLUSH):
            counts = cqf.merge(held, form)
            held.clear()
            if everything or len(counts.n) > FLUSH // 2:
                yield packed(counts)
            else:
                held.append(counts)

    for batch in batches:
        for data in batch.column(0).to_pylist():
            every = np.frombuffer(data, id_kind(form.width))
            for start in range(0, len(every) - form.n + 1, SLICE):
                ids = every[start:start + SLICE + form.n - 1].astype(np.int64)
                places = [ids[k:len(ids) - form.n + 1 + k] for k in range(form.n)]
                whole = np.logical_and.reduce([p >= 0 for p in places])
                if pairs is not None:
                    bits, words = pairs[0], pairs[1].value
                    may = in_bitmap(bits, words, ids[:-1] << form.width | ids[1:])
                    for k in range(form.n - 1):
                        whole &= may[k:len(may) - form.n + 2 + k]
                counts = cqf.tally(*cqf.permuted(*cqf.pack([p[whole] for p in places], form), form), form)
                if len(counts.n):
                    held.append(counts)
                yield from passed_on(False)
    yield from passed_on(True)
    pa.default_memory_pool().release_unused()


def _merge(batches: Iterator[pa.RecordBatch], form: cqf.Layout, least: int) -> Iterator[pa.RecordBatch]:
    """Ids and counts of the n-grams that occur ``least`` times; a region's filters come one after the other."""
    region, held = None, []

    def done() -> Iterator[pa.RecordBatch]:
        counts = cqf.merge(held, form)
        often = counts.n >= least
        ids = cqf.unpack(*cqf.restored(counts.left[often], counts.right[often], form), form)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in ids), pa.array(counts.n[often], pa.int64())],
                                         names=[*(f"w{k + 1}" for k in range(form.n)), "f"])

    size = 0
    for batch in batches:
        for r, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if r != region and held:
                yield from done()
                held, size = [], 0
            region = r
            held.append(cqf.decode(data, r, form))
            size += len(held[-1].n)
            if size > FLUSH and len(held) > 1:
                held = [cqf.merge(held, form)]
                size = len(held[0].n)
    if held:
        yield from done()


def ngrams(chunks: DataFrame, n: int, width: int, words: int, least: int, pairs: DataFrame | None = None) -> DataFrame:
    """``w1 … wn, f``: the n-grams of ids that occur ``least`` times in the chunks (``words`` words in all).

    Tasks count in filters of their own; filters of a region meet in one task, which merges them. The permutation
    deals distinct n-grams evenly over the regions, and a frequent one comes once per filter.
    """
    spark = chunks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    form = cqf.layout(n, width, words, 4 * parts)
    held = None
    if pairs is not None:
        bits = min(BITMAP_BITS[1], max(BITMAP_BITS[0], (16 * pairs.count()).bit_length()))
        key = F.shiftleft("w1", width).bitwiseOR(F.col("w2"))
        held = bits, spark.sparkContext.broadcast(bitmap(pairs.select(key.alias("v")), bits))
    filters = chunks.mapInArrow(partial(_count, form=form, pairs=held), "region int, filter binary")
    schema = ", ".join([*(f"w{k + 1} long" for k in range(n)), "f long"])
    return saved(filters.repartition("region").sortWithinPartitions("region")
                 .mapInArrow(partial(_merge, form=form, least=least), schema), f"ngrams-{n}")


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with dense numbers ``id`` from 0: places within partitions, plus the sizes of the partitions before."""
    rows = saved(words.withColumn("at", F.monotonically_increasing_id()), "vocabulary")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row per partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("part", before.alias("base"))
    return saved(rows.withColumn("part", part).join(sizes, "part").withColumn("id", F.col("base") + place).drop("at", "part", "base"),
                 "vocabulary")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 10, share: int = 50,
                 top: int | None = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of two and three words of every language.

    Pieces end at ``.,;:!?`` and line ends; words are separated by spaces and tabs, A-Z lower-cased. A phrase that
    occurs ``a >= least`` times is a candidate; ``l`` and ``r`` are the counts of its two parts at the cut with the
    lowest score ``floor(10**6 * a * a / (l * r))``, of equal ones the first. A two-word candidate goes if a
    candidate that holds it has ``share`` per cent of its count or more. ``n`` counts the language's words; ``top``
    rows of each language are kept (None: all). A null language is ``und``, a null or wordless text adds nothing,
    repeated rows count as often as they occur, other columns are not read, an empty table gives no row.

    A phrase's words occur ``least`` times themselves, so only such words get an id, and a three-word phrase needs
    two frequent pairs: both leave out nothing that could be a candidate. What meets by key is counted before.
    """
    staged = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    chunks = saved(staged.mapInArrow(_chunks, "chunk long, local int, lang string, word string, n long, ids binary"), "chunks")
    words = chunks.where("local >= 0").select("chunk", "local", "lang", "word", "n")
    counted = saved(words.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = saved(counted.groupBy("lang").agg(F.sum("f").alias("n")), "language-words")
    vocabulary = _numbered(counted.where(F.col("f") >= least))
    size = vocabulary.count()
    width = max(1, (size - 1).bit_length()) if size else 1
    n_words = totals.agg(F.sum("n")).first()[0] or 0

    own = words.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select("chunk", "local", "id", F.lit(None).cast("binary").alias("ids"))
    texts = chunks.where("local < 0").select("chunk", "local", F.lit(0).cast("long").alias("id"), "ids")
    corpus = saved(texts.union(own).repartition("chunk").sortWithinPartitions("chunk", "local")
                   .mapInArrow(partial(_renumber, kind=id_kind(width)), "ids binary"), "chunks-numbered")
    pairs = ngrams(corpus, 2, width, n_words, least)
    triples = ngrams(corpus, 3, width, n_words, least, pairs)

    def score(l: str, r: str) -> str:
        return f"cast(1000000 * cast(f as decimal(16,0)) * cast(f as decimal(16,0)) div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0))) as long)"

    one = vocabulary.select("id", "lang", F.col("word"), F.col("f").alias("f1"))
    first = one.select(F.col("id").alias("w1"), "lang", F.col("word").alias("t1"), F.col("f1").alias("l"))
    second = one.select(F.col("id").alias("w2"), F.col("word").alias("t2"), F.col("f1").alias("r"))
    known = saved(pairs.join(first, "w1").join(second, "w2").select("w1", "w2", "lang", "t1", "t2", "l", "r", "f"), "pairs")
    head = known.select("w1", "w2", "lang", F.concat_ws(" ", "t1", "t2").alias("start"), F.col("l").alias("f1"), F.col("f").alias("f12"))
    tail = known.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("t2").alias("t3"), F.col("r").alias("f3"),
                        F.col("f").alias("f23"))
    cuts = [F.struct(F.expr(score(l, r)).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
            for k, l, r in ((1, "f1", "f23"), (2, "f12", "f3"))]
    long_ = (triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
             .select("lang", F.concat_ws(" ", "start", "t3").alias("phrase"), F.col("f").alias("a"), F.least(*cuts).alias("cut"))
             .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    inside = triples.select("w1", "w2", "f").union(triples.select("w2", "w3", "f")).groupBy("w1", "w2").agg(F.max("f").alias("longer"))
    short = (known.join(inside, ["w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("f")))
             .select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("f").alias("a"), "l", "r", F.expr(score("l", "r")).alias("score")))
    found = short.unionByName(long_)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # the best of each language are among the best of each of its parts
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
        found = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
s AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g1 AS MATERIALIZED (SELECT lang, w1, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w) AS w1 FROM s) GROUP BY ALL),
g2 AS MATERIALIZED (
  SELECT lang, w1, w2, count(*)::HUGEINT AS f
  FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM s)) GROUP BY ALL HAVING count(*) >= 10),
g3 AS MATERIALIZED (
  SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f
  FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM s))
  GROUP BY ALL HAVING count(*) >= 10),
inside AS (SELECT lang, w1, w2, max(f) AS longer FROM (
  SELECT lang, w1, w2, f FROM g3 UNION ALL SELECT lang, w2, w3, f FROM g3) GROUP BY ALL),
c AS (
  SELECT g2.lang, g2.w1 || ' ' || g2.w2 AS phrase, g2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM g2 JOIN g1 x ON x.lang = g2.lang AND x.w1 = g2.w1 JOIN g1 y ON y.lang = g2.lang AND y.w1 = g2.w2
  LEFT JOIN inside i ON i.lang = g2.lang AND i.w1 = g2.w1 AND i.w2 = g2.w2
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * g2.f
  UNION ALL
  SELECT g3.lang, g3.w1 || ' ' || g3.w2 || ' ' || g3.w3, g3.f, 1, x.f, y.f
  FROM g3 JOIN g1 x ON x.lang = g3.lang AND x.w1 = g3.w1 JOIN g2 y ON y.lang = g3.lang AND y.w1 = g3.w2 AND y.w2 = g3.w3
  UNION ALL
  SELECT g3.lang, g3.w1 || ' ' || g3.w2 || ' ' || g3.w3, g3.f, 2, x.f, y.f
  FROM g3 JOIN g2 x ON x.lang = g3.lang AND x.w1 = g3.w1 AND x.w2 = g3.w2 JOIN g1 y ON y.lang = g3.lang AND y.w1 = g3.w3),
q AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM c),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM t JOIN (SELECT lang, sum(f) AS n FROM g1 GROUP BY lang) USING (lang)
"""

import base64
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from sluice.sources.files import glob_regex, load_seen, new_files, record_seen, scan_files
from sluice.sources.landing import next_watermark, read_increment
from sluice.sources.submissions import ingest_submissions
from sluice.streaming.streams import stream_files, stream_to


def _tree(files: dict[str, bytes]) -> str:
    root = tempfile.mkdtemp(prefix="sluice-src-")
    for name, data in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
    return root


def _names(df):
    return sorted(r["uri"].rsplit("/", 1)[-1] for r in df.select("uri").collect())


def test_scan_is_recursive_with_metadata(spark):
    root = _tree({"a.pdf": b"A", "b.txt": b"BB", "sub/c.pdf": b"CCC", ".hidden": b"h", "empty.txt": b""})
    docs = scan_files(spark, root)
    # binaryFile skips hidden and zero-length files (documented gap).
    assert _names(docs) == ["a.pdf", "b.txt", "c.pdf"]
    row = docs.where(F.col("uri").endswith("c.pdf")).first()
    assert bytes(row["content"]) == b"CCC"
    assert row["metadata"]["source"] == "files" and row["metadata"]["size_bytes"] == "3"
    assert float(row["metadata"]["modified_at"]) > 0


def test_patterns_union_and_dedupe(spark):
    root = _tree({"a.pdf": b"A", "b.txt": b"B", "c.docx": b"C", "sub/d.pdf": b"D"})
    assert _names(scan_files(spark, root, patterns=["*.pdf"])) == ["a.pdf", "d.pdf"]
    assert _names(scan_files(spark, root, patterns=["*.pdf", "*.docx", "*.pdf"])) == ["a.pdf", "c.docx", "d.pdf"]
    assert _names(scan_files(spark, root, patterns=["sub/*.pdf"])) == ["d.pdf"]


def test_glob_with_folder_matches_path_tail():
    import re

    assert re.search(glob_regex("sub/*.pdf"), "/r/sub/d.pdf")
    assert not re.search(glob_regex("sub/*.pdf"), "/r/sub/x/d.pdf")


def test_content_toggle_keeps_rows(spark):
    root = _tree({"a.pdf": b"A", "b.pdf": b"B"})
    docs = scan_files(spark, root, include_content=False)
    assert docs.where(F.col("content").isNull()).count() == 2
    plan = docs.select("uri", "content")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[-1].split("\n")[0]


def test_incremental_files_emitted_once(spark):
    root = _tree({"a.pdf": b"A", "b.pdf": b"B"})
    state = tempfile.mkdtemp(prefix="sluice-seen-") + "/seen"
    first = new_files(scan_files(spark, root), load_seen(spark, state))
    assert _names(first) == ["a.pdf", "b.pdf"]
    record_seen(first, state)
    assert new_files(scan_files(spark, root), load_seen(spark, state)).count() == 0
    with open(os.path.join(root, "c.pdf"), "wb") as f:
        f.write(b"C")
    with open(os.path.join(root, "a.pdf"), "wb") as f:  # modified: keyed on path, not re-emitted
        f.write(b"AA")
    third = new_files(scan_files(spark, root), load_seen(spark, state))
    assert _names(third) == ["c.pdf"]


def test_file_stream_second_run_emits_nothing(spark):
    root = _tree({"a.pdf": b"A", "b.pdf": b"B", "sub/c.pdf": b"C"})
    out, ckpt = tempfile.mkdtemp() + "/out", tempfile.mkdtemp() + "/ckpt"
    rows = lambda: stream_files(spark, root, max_files_per_trigger=1).select("uri")
    stream_to(rows(), out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    stream_to(rows(), out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    with open(os.path.join(root, "d.pdf"), "wb") as f:
        f.write(b"D")
    stream_to(rows(), out, ckpt).awaitTermination()
    assert sorted(r.uri.rsplit("/", 1)[-1] for r in spark.read.parquet(out).collect()) == [
        "a.pdf", "b.pdf", "c.pdf", "d.pdf"]


def _landing(spark):
    rows = [("u1", b"a", "2024-01-01 00:00:00", "x"), ("u2", b"b", "2024-01-02 00:00:00", "y"),
            ("u3", None, "2024-01-03 00:00:00", "z")]
    return (spark.createDataFrame(rows, "uri string, content binary, ts string, kind string")
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def test_increment_is_strictly_after_the_mark(spark):
    df = _landing(spark)
    assert read_increment(df, "ts").count() == 3
    inc = read_increment(df, "ts", "2024-01-02 00:00:00")
    assert [r.uri for r in inc.collect()] == ["u3"]
    meta = read_increment(df, "ts").where("uri = 'u1'").first()["metadata"]
    assert meta["kind"] == "x" and meta["source"] == "landing" and "content" not in meta


def test_watermark_advances_and_stays(spark):
    df = _landing(spark)
    row = next_watermark(df, "ts", "2024-01-01 12:00:00").first()
    assert str(row["new_mark"]) == "2024-01-03 00:00:00" and row["n_new"] == 2
    same = next_watermark(df, "ts", "2024-01-05 00:00:00").first()
    assert str(same["new_mark"]) == "2024-01-05 00:00:00" and same["n_new"] == 0
    assert str(next_watermark(df, "ts").first()["new_mark"]) == "2024-01-03 00:00:00"


def test_submissions_decode_and_callers_keys_win(spark):
    b64 = base64.b64encode(b"hello").decode()
    rows = [("uri://a", b64, {"k": "v"}), ("uri://b", None, None), ("uri://c", "%%%", {"source": "mine"})]
    df = spark.createDataFrame(rows, "uri string, content_base64 string, metadata map<string,string>")
    got = {r["uri"]: r for r in ingest_submissions(df).collect()}
    assert bytes(got["uri://a"]["content"]) == b"hello" and got["uri://a"]["metadata"] == {"source": "api", "k": "v"}
    assert got["uri://b"]["content"] is None and got["uri://b"]["metadata"] == {"source": "api"}
    assert got["uri://c"]["content"] is None and got["uri://c"]["metadata"] == {"source": "mine"}


def test_watermark_state_round_trip(spark):
    from sluice.sources.landing import load_watermark, save_watermark

    path = tempfile.mkdtemp() + "/mark"
    assert load_watermark(spark, path) is None
    save_watermark(next_watermark(_landing(spark), "ts", "2024-01-01 12:00:00"), path)
    assert str(load_watermark(spark, path)) == "2024-01-03 00:00:00"


def test_excluded_folder_keeps_its_neighbours(spark):
    root = tempfile.mkdtemp()
    for name in ("seen/old.txt", "seen_invoices/a.txt", "b.txt"):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write("x")
    for prefix in (f"{root}/seen", f"file:{root}/seen/", f"file://{root}/seen"):
        got = sorted(r["uri"].rsplit("/", 1)[-1] for r in scan_files(spark, root, exclude=[prefix]).collect())
        assert got == ["a.txt", "b.txt"]


def test_landing_pass_saves_mark_only_after_the_write(spark):
    from sluice.sources.landing import landing_pass

    state = tempfile.mkdtemp() + "/mark"
    out = tempfile.mkdtemp() + "/out"
    write = lambda docs: docs.select("uri").write.mode("append").parquet(out)
    first = landing_pass(spark, _landing(spark), state, write)
    assert first["n_new"] == 3 and str(first["new_mark"]) == "2024-01-03 00:00:00"
    again = landing_pass(spark, _landing(spark), state, write)
    assert again["n_new"] == 0 and str(again["new_mark"]) == "2024-01-03 00:00:00"
    assert spark.read.parquet(out).count() == 3

    def broken(docs):
        raise RuntimeError("sink down")

    more = _landing(spark).union(spark.createDataFrame([("u4", None, "2024-01-04 00:00:00", "w")],
                                                       "uri string, content binary, ts string, kind string")
                                 .withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    try:
        landing_pass(spark, more, state, broken)
    except RuntimeError:
        pass
    assert landing_pass(spark, more, state, write)["n_new"] == 1


def test_files_pass_records_exactly_what_it_wrote(spark):
    from sluice.sources.files import files_pass

    root = _tree({"a.pdf": b"A", "b.pdf": b"B"})
    state = tempfile.mkdtemp() + "/seen"
    got = []

    def write(docs):
        got.extend((r["uri"].rsplit("/", 1)[-1], bytes(r["content"])) for r in docs.collect())
        with open(os.path.join(root, "late.pdf"), "wb") as f:  # lands while the pass is writing
            f.write(b"L")

    assert files_pass(spark, root, state, write) == 2
    assert sorted(got) == [("a.pdf", b"A"), ("b.pdf", b"B")]
    assert files_pass(spark, root, state, lambda docs: got.extend(_names(docs))) == 1
    assert got[-1] == "late.pdf"
    assert files_pass(spark, root, state, lambda docs: docs.count()) == 0


def test_incremental_scan_reads_only_new_bytes_and_caps_oldest_first(spark):
    from sluice.sources.files import incremental_scan

    root = _tree({"a.pdf": b"A", "b.pdf": b"B", "c.pdf": b"C"})
    for i, name in enumerate(["b.pdf", "a.pdf", "c.pdf"]):
        os.utime(os.path.join(root, name), (1_000_000 + i, 1_000_000 + i))
    state = tempfile.mkdtemp() + "/seen"
    first = incremental_scan(spark, root, state, max_files=2)
    assert _names(first) == ["a.pdf", "b.pdf"]
    record_seen(first, state)
    rest = incremental_scan(spark, root, state)
    assert _names(rest) == ["c.pdf"] and bytes(rest.first()["content"]) == b"C"
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert ".pdf" not in plan and "pending" in plan  # the pass is a table of paths, not a list on the driver


def test_presentation_orderings(spark):
    root = _tree({"c.pdf": b"C", "a.pdf": b"A", "sub/b.pdf": b"B"})
    names = [r["uri"].split(root)[-1] for r in scan_files(spark, root, ordered=True).select("uri").collect()]
    assert names == sorted(names)
    ts = [r["ts"] for r in read_increment(_landing(spark), "ts", ordered=True).collect()]
    assert ts == sorted(ts)


def test_empty_increment_keeps_the_document_schema(spark):
    from sluice.sources.files import incremental_scan, read_paths, scan_tree

    empty = read_paths(spark, [])
    assert empty.count() == 0
    full = scan_files(spark, _tree({"a.pdf": b"A"}))
    assert empty.schema == full.schema
    assert scan_tree(spark, _tree({"a.pdf": b"A"})).schema.simpleString() == full.schema.simpleString()
    root = _tree({"a.pdf": b"A"})
    state = tempfile.mkdtemp() + "/seen"
    record_seen(incremental_scan(spark, root, state), state)
    assert incremental_scan(spark, root, state).count() == 0


def test_tree_emits_hidden_and_empty_files_at_any_depth(spark):
    from sluice.sources.files import scan_tree

    files = {"a.pdf": b"A", ".hidden.pdf": b"H", "_SUCCESS": b"", "x/empty.txt": b"", "x/y/z/deep.pdf": b"D", ".git/config": b"c"}
    files |= {f"many/{k}/f.pdf": b"%d" % k for k in range(20)}
    root = _tree(files)
    for shards in (1, 3, 200):
        from sluice.sources.tree import list_tree

        assert sorted(r["path"] for r in list_tree(spark, root, shards).collect()) == sorted(f"file:{root}/{n}" for n in files)
    got = {r["uri"].split(root + "/")[1]: (bytes(r["content"]), r["errors"]) for r in scan_tree(spark, root).collect()}
    assert got == {n: (c, []) for n, c in files.items()}
    listed = lambda d: {r["uri"]: (r["length"], r["ms"]) for r in d.withColumn("ms", F.unix_millis("modificationTime")).collect()}
    same, tree = listed(scan_files(spark, root)), listed(scan_tree(spark, root, include_content=False))
    assert same and {k: tree[k] for k in same} == same
    assert _names(scan_tree(spark, root, patterns=["x/y/z/*.pdf", "*.txt"])) == ["deep.pdf", "empty.txt"]
    assert scan_tree(spark, tempfile.mkdtemp()).count() == 0


def test_a_file_that_cannot_be_read_keeps_its_row(spark, monkeypatch):
    from sluice.sources.tree import MOST_BYTES, list_tree, read_contents

    root = _tree({"gone.pdf": b"A", "here.pdf": b"B"})
    listed = spark.createDataFrame(list_tree(spark, root).collect())
    os.remove(os.path.join(root, "gone.pdf"))
    huge = listed.where("path like '%here%'").withColumn("length", F.lit(MOST_BYTES + 1))
    got = {(r["path"].rsplit("/", 1)[-1], r["length"] > 10): r for r in read_contents(listed.union(huge)).collect()}
    assert got["gone.pdf", False]["content"] is None and "gone.pdf" in got["gone.pdf", False]["error"]
    assert bytes(got["here.pdf", False]["content"]) == b"B" and got["here.pdf", False]["error"] is None
    assert "do not fit" in got["here.pdf", True]["error"]


def test_streams_of_other_formats_make_a_document_of_each_row(spark):
    from sluice.streaming.streams import stream_files, stream_to

    root = tempfile.mkdtemp() + "/in"
    spark.createDataFrame([("u1", "text é", 3, None), ("u2", None, None, "x")], "path string, content string, n int, source string").write.json(root)
    out, ckpt = tempfile.mkdtemp() + "/out", tempfile.mkdtemp() + "/ckpt"
    for _ in range(2):  # the second run adds nothing
        stream_to(stream_files(spark, root, file_format="json", schema="path string, content string, n int, source string"), out, ckpt).awaitTermination()
    got = {r["uri"]: (r["content"] and bytes(r["content"]), r["metadata"]) for r in spark.read.parquet(out).collect()}
    assert got == {"u1": ("text é".encode(), {"path": "u1", "n": "3", "source": "files_stream"}),
                   "u2": (None, {"path": "u2", "source": "files_stream"})}
    lines = _tree({"a.txt": b"one\ntwo\n", "b.log": b"three"})
    rows = stream_files(spark, lines, patterns=["*.txt"], file_format="text", include_content=False)
    out = tempfile.mkdtemp() + "/out"
    stream_to(rows, out, tempfile.mkdtemp() + "/ckpt").awaitTermination()
    got = sorted((r["uri"].rsplit("/", 1)[-1], r["content"], r["metadata"]["value"]) for r in spark.read.parquet(out).collect())
    assert got == [("a.txt", None, "one"), ("a.txt", None, "two")]
    with pytest.raises(ValueError, match="schema"):
        stream_files(spark, root, file_format="json")


def _as_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "master", property(lambda self: "spark://elsewhere:7077"), raising=False)


def test_shared_folder_without_a_scheme_is_written_and_listed_on_a_cluster(spark, monkeypatch):
    from sluice.session import fresh_path
    from sluice.sinks.writers import write_files
    from sluice.sources.tree import list_tree, qualified

    _as_on_a_cluster(spark, monkeypatch)
    root = spark.conf.get("spark.checkpoint.dir") + "/raw copies"
    assert root.startswith("/") and fresh_path(spark, "x").startswith("/")
    write_files(spark.createDataFrame([("a.txt", bytearray(b"A"))], "name string, content binary"), root)
    assert [r["path"] for r in list_tree(spark, root).collect()] == [f"file:{root}/a.txt"]
    with pytest.raises(ValueError, match="no scheme"):
        qualified(spark, tempfile.mkdtemp())


def test_mounted_folders_are_written_and_listed(spark):
    from sluice.sinks.writers import write_content
    from sluice.sources.files import files_pass, scan_tree

    root = tempfile.mkdtemp()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tests.link./shared", f"file://{root}")
    docs = spark.createDataFrame([("d1", "/x/a.txt", bytearray(b"A")), ("d2", "/x/b", bytearray(b"B"))], "doc_id string, uri string, content binary")
    write_content(docs, "viewfs://tests/shared/in/raw")
    assert sorted(os.listdir(f"{root}/in/raw")) == ["d1.txt", "d2.bin"]
    assert {r["uri"]: bytes(r["content"]) for r in scan_tree(spark, "viewfs://tests/shared/in").collect()} == {
        f"file:{root}/in/raw/d1.txt": b"A", f"file:{root}/in/raw/d2.bin": b"B"}
    state = "viewfs://tests/shared/in/state"
    assert [files_pass(spark, "viewfs://tests/shared/in", state, lambda found: found.collect()) for _ in range(2)] == [2, 0]


def test_a_folder_of_many_files_is_listed_in_parts(spark, monkeypatch):
    from sluice.sources import tree

    monkeypatch.setattr(tree, "BATCH_FILES", 3)
    root = _tree({f"{k}.txt": b"%d" % k for k in range(7)})
    reader = tree.FileTreeReader(f"file:{root}", 4)
    assert sorted(b.num_rows for p in reader.partitions() for b in reader.read(p)) == [1, 3, 3]


def test_streams_over_landed_documents_take_as_many_micro_batches_whatever_their_number(spark):
    import glob

    from sluice.plans import catalog

    ckpt, taken = spark.conf.get("spark.checkpoint.dir"), {}
    for n in (4_000, 16_000):
        sf_dir = tempfile.mkdtemp(prefix="sluice-src-")
        spark.range(0, n, 1, 2 if n < 5_000 else 40).select(
            F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"),
            F.lit("web").alias("source"), F.lit(9).alias("n_chars")).write.parquet(f"{sf_dir}/documents.parquet")
        before = set(glob.glob(f"{ckpt}/sluice/formats_out-*_ckpt_*"))
        rows = catalog.files_stream_formats(spark, sf_dir)
        assert rows.groupBy("kind").agg(F.count_distinct(F.coalesce("uri", "line"))).orderBy("kind").collect() == [("json", n), ("text", n)]
        assert rows.count() == 2 * n
        new = set(glob.glob(f"{ckpt}/sluice/formats_out-*_ckpt_*")) - before
        taken[n] = sorted(len(glob.glob(f"{c}/commits/[0-9]*")) for c in new)
        catalog._write_landing(spark, sf_dir, landed := tempfile.mkdtemp() + "/landed")
        taken[n].append(len(glob.glob(f"{landed}/*.parquet")))
    assert all(1 < few and many <= 2 * few for few, many in zip(taken[4_000], taken[16_000])), taken


def _md5s(files: dict[str, bytes]) -> dict[str, str]:
    import hashlib

    return {n: hashlib.md5(c).hexdigest() for n, c in files.items() if c}


@pytest.fixture
def whole_files_refused(spark):
    """Spark's own reader refuses to hold a file of more than 1,000 bytes in one value."""
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    yield
    spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_scan_digests_files_that_no_value_holds(spark, whole_files_refused):
    from sluice.plans import catalog

    files = {"a.parquet": bytes(range(256)) * 4_000, "b c%20d.gz": b"not compressed" * 100, "sub/é.TXT": b"E", "empty.txt": b""}
    root = _tree(files)
    got = {r["filename"]: (r["extension"], r["size_bytes"], r["content_md5"]) for r in catalog.files_scan(spark, root).collect()}
    assert got == {n.split("/")[-1]: (n.lower().split(".")[-1], len(files[n]), m) for n, m in _md5s(files).items()}
    docs = scan_files(spark, f"{root}/*", patterns=["*.parquet", "*.TXT"], digest=True, exclude=[f"{root}/sub"])
    assert [(r["uri"], r["content_md5"]) for r in docs.select("uri", "content_md5").collect()] == [(f"file:{root}/a.parquet", _md5s(files)["a.parquet"])]
    assert bytes(scan_files(spark, f"{root}/sub", digest=True).first()["content"]) == b"E"  # the content is still there
    with pytest.raises(Exception, match="FILE_LENGTH|length"):
        scan_files(spark, root).select(F.md5("content")).collect()


def test_a_digest_holds_a_piece_at_a_time():
    import hashlib
    import io

    from sluice.sources.tree import PIECE_BYTES, md5_in_pieces

    class Stream(io.BytesIO):
        most = 0

        def read(self, n=-1):
            got = super().read(n)
            self.most = max(self.most, len(got))
            return got

    data = b"0123456789" * (PIECE_BYTES // 4)
    stream = Stream(data)
    assert md5_in_pieces(stream) == hashlib.md5(data).hexdigest() and stream.most == PIECE_BYTES
    assert md5_in_pieces(Stream(b"")) == hashlib.md5(b"").hexdigest()


def test_digests_of_mounted_folders_and_of_stores_that_only_spark_reads(spark, monkeypatch, whole_files_refused):
    from sluice.sources import tree

    files = {"a.bin": b"A" * 2_000, "sub/b.bin": b"B"}
    root = _tree(files)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.digests.link./in", f"file://{root}")
    digests = lambda path: {r["uri"]: r["content_md5"] for r in scan_files(spark, path, digest=True).select("uri", "content_md5").collect()}
    want = {f"viewfs://digests/in/{n}": m for n, m in _md5s(files).items()}
    assert digests("viewfs://digests/in") == digests("viewfs://digests/in/") == digests("viewfs://digests/in/*") == want

    def closed(uri):
        raise OSError("no such file system here")

    monkeypatch.setattr(tree, "open_path", closed)
    with pytest.raises(Exception, match="FILE_LENGTH|length"):
        digests(root)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "5000")
    assert {u.removeprefix(f"file:{root}/"): m for u, m in digests(root).items()} == _md5s(files)


def test_stream_digests_files_that_no_value_holds(spark, whole_files_refused):
    from sluice.plans import catalog

    files = {f"{k}.bin": bytes([k]) * (900 + 100 * k) for k in range(1, 8)} | {"sub/x y%20.gz": b"not compressed" * 100}
    root = _tree(files)
    got = {r["filename"]: (r["extension"], r["size_bytes"], r["content_md5"]) for r in catalog.files_stream(spark, root).collect()}
    assert got == {n.split("/")[-1]: (n.split(".")[-1], len(files[n]), m) for n, m in _md5s(files).items()}
    out, ckpt = tempfile.mkdtemp() + "/out", tempfile.mkdtemp() + "/ckpt"
    for more in ({}, {"late.bin": b"L" * 5_000}):  # the second run reads the new file only
        for name, data in more.items():
            with open(os.path.join(root, name), "wb") as f:
                f.write(data)
        stream_to(stream_files(spark, root, patterns=["*.bin"], digest=True).select("uri", "content_md5"), out, ckpt).awaitTermination()
        want = _md5s({n: c for n, c in (files | more).items() if n.endswith(".bin")})
        assert sorted((r["uri"].rsplit("/", 1)[-1], r["content_md5"]) for r in spark.read.parquet(out).collect()) == sorted(want.items())
    with pytest.raises(ValueError, match="rows, not files"):
        stream_files(spark, root, file_format="text", digest=True)


def test_a_digest_skips_unreadable_files_where_sparks_reader_would(spark):
    from sluice.sources.tree import _md5_of

    class Broken:
        def __init__(self, error):
            self.error = error

        def open_input_stream(self, path, compression):
            raise self.error

    kinds = {"ignoreMissingFiles": FileNotFoundError("gone"), "ignoreCorruptFiles": OSError("bad block")}
    for option, error in kinds.items():
        assert _md5_of(Broken(error), "/x", {option}) is None
        for skipped in (set(), set(kinds) - {option}):
            with pytest.raises(OSError, match=str(error)):
                _md5_of(Broken(error), "/x", skipped)
    with pytest.raises(PermissionError):
        _md5_of(Broken(PermissionError("denied")), "/x", set(kinds))

    files = {"a.bin": b"A", "b.bin": b"B", "gone.bin": b"G"}
    root = _tree(files)
    spark.conf.set("spark.sql.files.ignoreMissingFiles", "true")
    try:
        docs = scan_files(spark, root, digest=True).select("uri", "content_md5")
        os.remove(os.path.join(root, "gone.bin"))
        assert {r["uri"].rsplit("/", 1)[-1]: r["content_md5"] for r in docs.collect()} == _md5s({n: files[n] for n in ("a.bin", "b.bin")})
        assert str(docs._jdf.queryExecution().executedPlan()).count("ArrowEvalPython") == 1  # each file is read once
        out = tempfile.mkdtemp() + "/out"
        stream_to(stream_files(spark, root, digest=True, options={"ignorecorruptfiles": "true"}).select("uri", "content_md5"), out, tempfile.mkdtemp() + "/ckpt").awaitTermination()
        assert spark.read.parquet(out).count() == 2
    finally:
        spark.conf.unset("spark.sql.files.ignoreMissingFiles")

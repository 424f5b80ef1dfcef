import json
import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators.classify import rules_classifier
from sluice.operators.parse import text_parser, udf_parser
from sluice.operators.route import RouteTable
from sluice.plans.flow import PipelineSpec, RouterSpec, build_tables, run_pipeline, run_router, write_flow
from sluice.sinks.writers import json_sink, table_rows, table_sink, write_all, write_content
from sluice.sources.files import scan_files
from sluice.streaming.streams import run_router_stream


def test_table_row_and_empty_extracted(docs, spark):
    d = docs([("/x/a.txt", b"hello", {"k": "v"})], doc_type="t").withColumn(
        "extracted", F.struct(F.lit(42).alias("total")))
    row = table_rows(d, "p", "r1").first()
    assert row["extracted_json"] == '{"total":42}' and row["metadata_json"] == '{"k":"v"}'
    assert (row["pipeline_name"], row["run_id"], row["doc_type"]) == ("p", "r1", "t")
    empty = docs([("/x/b", b"x", None)]).withColumn("extracted", F.create_map().cast("map<string,string>"))
    assert table_rows(empty, "p").first()["extracted_json"] is None


def test_json_sink_keeps_nulls_and_errors(docs, spark):
    path = tempfile.mkdtemp() + "/json"
    d = docs([("/x/a", b"x", None)]).withColumn("errors", F.array(F.lit("boom")))
    json_sink(path, "r")(d.withColumn("pipeline", F.lit("p")))
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".json"))
    rec = json.loads(text.splitlines()[0])
    assert rec["errors"] == ["boom"] and rec["doc_type"] is None and rec["pipeline_name"] == "p"


def test_raw_content_copy_names(docs, spark):
    path = tempfile.mkdtemp() + "/raw"
    d = docs([("/x/a.PDF", b"A", None), ("/x/noext", b"B", None), ("/x/none.pdf", None, None)])
    write_content(d, path)
    ids = {r["uri"]: r["doc_id"] for r in d.collect()}
    assert sorted(os.listdir(path)) == sorted([f"{ids['/x/a.PDF']}.pdf", f"{ids['/x/noext']}.bin"])


def test_write_all_runs_every_sink(docs, spark):
    base = tempfile.mkdtemp()
    d = docs([("/x/a", b"x", None), ("/x/b", b"y", None)]).withColumn("pipeline", F.lit("p"))
    write_all(d, [table_sink(base + "/t"), json_sink(base + "/j")])
    assert spark.read.parquet(base + "/t").count() == 2 and spark.read.json(base + "/j").count() == 2


def test_several_sinks_read_one_written_copy(docs, spark):
    from sluice.sinks.writers import shared_rows
    from sluice.sources.tree import list_tree

    base, calls = tempfile.mkdtemp(), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def once(uri):
        calls.add(1)
        return uri

    d = docs([(f"/x/{k}.txt", b"x" * k, {"k": str(k)}) for k in range(5)]).withColumn("pipeline", F.lit("p"))
    d = d.withColumn("extracted", F.struct(once.asNondeterministic()("uri").alias("name")))
    work = spark.sparkContext.getCheckpointDir()
    before = {r.path for r in list_tree(spark, work).collect()}
    write_all(d, [table_sink(base + "/t"), json_sink(base + "/j", raw_path=base + "/raw")])
    assert calls.value == 5  # one computation for three targets
    assert spark.read.json(base + "/j").count() == 5 and len(os.listdir(base + "/raw")) == 5
    assert {r.path for r in list_tree(spark, work).collect()} <= before  # the copy is gone
    with shared_rows(d, [table_sink("t"), json_sink("/j")]) as rows:
        assert "content" not in rows.columns
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" not in plan and "FileScan parquet" in plan
    with shared_rows(d, [lambda df, batch_id: None, json_sink("/j", raw_path="/r")]) as rows:
        assert rows.where("content IS NOT NULL").count() == 5
    empty = d.withColumn("extracted", F.from_json(F.lit("{}"), "struct<>"))
    write_all(empty, [table_sink(base + "/e"), table_sink(base + "/e2")])  # no type that Parquet holds
    assert spark.read.parquet(base + "/e2").where("extracted_json IS NULL").count() == 5


def test_a_pipeline_with_several_targets_parses_once_and_counts(spark):
    base, calls = tempfile.mkdtemp(), spark.sparkContext.accumulator(0)

    def parse(raw):
        calls.add(1)
        if len(raw) < 16:
            raise ValueError("too short")
        return {"text": raw.decode()}

    spec = _spec(base, lambda: udf_parser(parse, "text string"), on_error="dead_letter", dead=True)
    for name, pipe in spec.pipelines.items():
        pipe.sinks = [json_sink(f"{base}/{name}", "r", name, raw_path=f"{base}/raw"), table_sink(f"{base}/t", pipeline_name=name)]
    stats = write_flow(run_router(scan_files(spark, _landing_dir()), spec), spec.pipelines)
    assert (stats["processed"], stats["failed"], calls.value) == (2, 1, 3)
    assert spark.read.parquet(base + "/t").count() == 2 and spark.read.json(base + "/dead").count() == 1
    assert len(os.listdir(base + "/raw")) == 2


RULES = [{"doc_type": "invoice", "filename_regex": "(?i)invoice"},
         {"doc_type": "contract", "filename_regex": "(?i)(contract|agreement)"}]
LANDING = {"Invoice_001.txt": b"Invoice #1\nTotal: 100", "Service_Agreement.txt": b"This agreement...",
           "random_notes.txt": b"just some notes"}


def _spec(base, parser=text_parser, on_error="skip", dead=False, default="unclassified_pipeline"):
    routes = RouteTable([("invoice", "invoice_pipeline"), ("contract", "contract_pipeline")], default)
    pipes = {n: PipelineSpec(n, parser=parser(), sinks=[json_sink(f"{base}/{n}", "r", n)], on_error=on_error,
                             dead_letter=json_sink(f"{base}/dead", "r", n) if dead else None)
             for n in routes.pipelines()}
    return RouterSpec(routes, pipes, classifiers=[rules_classifier(RULES)])


def _landing_dir():
    root = tempfile.mkdtemp(prefix="landing-")
    for name, data in LANDING.items():
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)
    return root


def test_router_run_writes_each_pipeline_and_stats(spark):
    base = tempfile.mkdtemp()
    spec = _spec(base)
    stats = write_flow(run_router(scan_files(spark, _landing_dir()), spec), spec.pipelines, run_id="r")
    assert stats == {"discovered": 3, "received": 3, "unrouted": 0, "processed": 3, "failed": 0, "run_id": "r"}
    for name in ("invoice_pipeline", "contract_pipeline", "unclassified_pipeline"):
        assert spark.read.json(f"{base}/{name}").count() == 1


def test_router_stream_second_run_processes_nothing(spark):
    base, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp() + "/ckpt"
    root = _landing_dir()
    spec = _spec(base)
    seen = []
    from sluice.streaming.streams import stream_files

    run_router_stream(stream_files(spark, root, max_files_per_trigger=1), spec, ckpt,
                      on_stats=lambda b, s: seen.append(s)).awaitTermination()
    assert sum(s["received"] for s in seen) == 3 and len(seen) == 3
    run_router_stream(stream_files(spark, root), spec, ckpt, on_stats=lambda b, s: seen.append(s)).awaitTermination()
    assert len(seen) == 3
    assert spark.read.option("recursiveFileLookup", "true").json(base).count() == 3


def test_error_policies(spark):
    def _checked(raw):
        if len(raw) < 16:
            raise ValueError("too short")
        return {"text": raw.decode(), "length": len(raw)}

    root = _landing_dir()
    base = tempfile.mkdtemp()
    parser = lambda: udf_parser(_checked, "text string, length int")
    spec = _spec(base, parser, on_error="dead_letter", dead=True)
    stats = write_flow(run_router(scan_files(spark, root), spec), spec.pipelines)
    assert stats["failed"] == 1 and stats["processed"] == 2
    dead = spark.read.json(f"{base}/dead").first()
    assert dead["errors"] == ["too short"] and dead["uri"].endswith("random_notes.txt")
    skip = _spec(tempfile.mkdtemp(), parser, on_error="skip")
    result = run_router(scan_files(spark, root), skip)
    assert result.outputs["unclassified_pipeline"].count() == 0
    fail = _spec(tempfile.mkdtemp(), parser, on_error="fail")
    with pytest.raises(PySparkException, match="too short"):
        write_flow(run_router(scan_files(spark, root), fail), fail.pipelines)
    # A table sink does not project ``errors``; the failure must still stop the write.
    table_base = tempfile.mkdtemp()
    fail.pipelines["unclassified_pipeline"].sinks = [table_sink(f"{table_base}/t")]
    with pytest.raises(PySparkException, match="too short"):
        write_flow(run_router(scan_files(spark, root), fail), fail.pipelines)


def test_dead_letter_needs_a_sink_and_routes_need_pipelines():
    with pytest.raises(ValueError):
        PipelineSpec("p", on_error="dead_letter")
    with pytest.raises(ValueError):
        RouterSpec(RouteTable([("a", "missing")]), {})


def test_unrouted_counted_without_default(spark):
    spec = _spec(tempfile.mkdtemp(), default=None)
    stats = write_flow(run_router(scan_files(spark, _landing_dir()), spec), spec.pipelines)
    assert (stats["received"], stats["unrouted"], stats["processed"]) == (3, 1, 2)


def test_dedicated_pipeline_uses_its_own_source_and_chain(spark):
    root = _landing_dir()
    spec = PipelineSpec("only", parser=text_parser(), classifiers=[rules_classifier(RULES)],
                        source=lambda s: scan_files(s, root))
    result = run_pipeline(spark, spec)
    out = result.outputs["only"]
    counts = result.stats().first()
    assert (counts["discovered"], counts["received"], counts["processed"]) == (3, 0, 3)
    got = {r["uri"].rsplit("/", 1)[-1]: r["doc_type"] for r in out.collect()}
    assert got == {"Invoice_001.txt": "invoice", "Service_Agreement.txt": "contract", "random_notes.txt": None}
    with pytest.raises(RuntimeError):
        run_pipeline(spark, PipelineSpec("nosource"))


def test_gold_tables_expand_fields(spark):
    tables = build_tables(scan_files(spark, _landing_dir()), _spec(tempfile.mkdtemp()))
    assert set(tables) == {"bronze", "classified", "invoice_pipeline", "contract_pipeline", "unclassified_pipeline"}
    gold = tables["invoice_pipeline"].first()
    assert gold["length"] == len(LANDING["Invoice_001.txt"]) and gold["text"].startswith("Invoice")
    assert "doc_type" in tables["classified"].columns


def test_shared_flow_reads_the_source_once(spark):
    from sluice.plans import catalog

    df = catalog.router_batch(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 0 and plan.count("Scan parquet") == 3
    spark.catalog.clearCache()


def test_replayed_micro_batch_overwrites_its_own_output(spark):
    from sluice.streaming.streams import router_batch_writer

    base = tempfile.mkdtemp()
    on_batch = router_batch_writer(_spec(base))
    batch = scan_files(spark, _landing_dir())
    on_batch(batch, 7)
    on_batch(batch, 7)
    assert spark.read.option("recursiveFileLookup", "true").json(base).count() == 3
    on_batch(batch, 8)
    assert spark.read.option("recursiveFileLookup", "true").json(base).count() == 6


def test_user_sink_runs_per_micro_batch(spark):
    from sluice.streaming.streams import run_stream, stream_files

    seen = []

    def my_sink(df, batch_id):
        seen.append((batch_id, df.count()))

    q = run_stream(stream_files(spark, _landing_dir(), max_files_per_trigger=2), my_sink,
                   tempfile.mkdtemp() + "/ckpt")
    q.awaitTermination()
    assert sorted(seen) == [(0, 2), (1, 1)]


def test_submissions_stream_consumes_each_once(spark):
    import base64

    from sluice.sources.submissions import read_submissions, submit
    from sluice.streaming.streams import stream_to

    inbox, out, ckpt = tempfile.mkdtemp() + "/in", tempfile.mkdtemp() + "/out", tempfile.mkdtemp() + "/ck"
    rows = [("uri://a", base64.b64encode(b"x").decode(), {"k": "v"}), ("uri://b", None, None)]
    submit(spark.createDataFrame(rows, "uri string, content_base64 string, metadata map<string,string>"), inbox)
    run = lambda: stream_to(read_submissions(spark, inbox, stream=True).select("uri"), out, ckpt)
    run().awaitTermination()
    run().awaitTermination()
    assert sorted(r.uri for r in spark.read.parquet(out).collect()) == ["uri://a", "uri://b"]


def _sent(spark, rows):
    return spark.createDataFrame(rows, "uri string, content_base64 string, metadata map<string,string>")


def test_a_submission_sent_again_is_consumed_once(spark):
    from sluice.sources.submissions import consume_once, read_submissions, submit
    from sluice.streaming.streams import stream_to

    inbox, out, ckpt = tempfile.mkdtemp() + "/in", tempfile.mkdtemp() + "/out", tempfile.mkdtemp() + "/ck"
    first = [("uri://a", "eA==", {"k": "v", "l": "w"}), ("uri://b", None, None), (None, "eA==", None)]
    again = [("uri://a", "eA==", {"l": "w", "k": "v"}), ("uri://b", None, None)]  # metadata in another order
    other = [("uri://a", "eQ==", {"k": "v", "l": "w"}), ("uri://b", "", None), ("uri://b", None, {"k": None})]
    for batch in (first, again + again, other, first):
        submit(_sent(spark, batch), inbox)
        stream_to(read_submissions(spark, inbox, stream=True, remember="1 hour").select("uri", "content", "metadata"),
                  out, ckpt).awaitTermination()
    got = [(r.uri, r.content and bytes(r.content)) for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=str) == sorted([("uri://a", b"x"), ("uri://b", None), (None, b"x"), ("uri://a", b"y"), ("uri://b", None),
                                           ("uri://b", None)], key=str)
    assert consume_once(_sent(spark, first + again + other)).count() == 6  # a batch likewise


def test_stream_counts_per_micro_batch(spark, docs):
    from sluice.operators.stats import StreamCounts, observe_stream
    from sluice.sources.submissions import read_submissions, submit
    from sluice.streaming.streams import stream_to

    inbox, out, ckpt = tempfile.mkdtemp() + "/in", tempfile.mkdtemp() + "/out", tempfile.mkdtemp() + "/ck"
    seen = []
    counts = StreamCounts(lambda *batch: seen.append(batch))
    spark.streams.addListener(counts)
    try:
        run = lambda: counts.wait(stream_to(
            observe_stream(read_submissions(spark, inbox, stream=True), "inbox").select("uri"), out, ckpt))
        for rows in ([("a", "eA==", None), ("b", "no base64!", None)], [("c", None, None)], []):
            if rows:
                submit(_sent(spark, rows).coalesce(1), inbox)
            run()
    finally:
        spark.streams.removeListener(counts)
    assert [b for b in seen if b[2]] == [("inbox", 0, 2, 1), ("inbox", 1, 1, 0)]
    assert counts.totals("inbox", "r") == {"discovered": 3, "received": 0, "unrouted": 0, "processed": 2, "failed": 1, "run_id": "r"}
    counts._count("q", "inbox", 4, 5, 0)
    counts._count("q", "inbox", 4, 5, 0)  # reported twice, counted once
    assert counts.totals("inbox")["discovered"] == 8 and counts.totals("none")["discovered"] == 0


def test_router_flow_adds_no_shuffle(spark):
    spec = _spec(tempfile.mkdtemp())
    result = run_router(scan_files(spark, _landing_dir()), spec, share=None)
    for name, out in result.outputs.items():
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name


@pytest.mark.parametrize("share", [None, "persist", "checkpoint", "table"])
def test_share_modes_give_the_same_outputs(spark, share):
    spec = _spec(tempfile.mkdtemp())
    result = run_router(scan_files(spark, _landing_dir()), spec, share=share)
    got = {n: sorted(r.uri.rsplit("/", 1)[-1] for r in df.collect()) for n, df in result.outputs.items()}
    assert got == {"invoice_pipeline": ["Invoice_001.txt"], "contract_pipeline": ["Service_Agreement.txt"],
                   "unclassified_pipeline": ["random_notes.txt"]}
    if share == "table":
        plan = result.outputs["invoice_pipeline"]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(pipeline" in plan
    result.close()


def test_flow_with_no_pipelines_counts_everything_unrouted(spark):
    spec = RouterSpec(RouteTable([]), {}, classifiers=[rules_classifier(RULES)])
    stats = write_flow(run_router(scan_files(spark, _landing_dir()), spec), spec.pipelines)
    assert (stats["received"], stats["unrouted"], stats["processed"]) == (3, 3, 0)


def test_json_sink_with_raw_copies(docs, spark):
    base = tempfile.mkdtemp()
    d = docs([("/x/a.txt", b"A", None)]).withColumn("pipeline", F.lit("p"))
    json_sink(base + "/json", raw_path=base + "/raw")(d)
    assert spark.read.json(base + "/json").count() == 1
    assert [f.endswith(".txt") for f in os.listdir(base + "/raw")] == [True]


def test_stats_as_json_line():
    from sluice.operators.stats import stats_json

    line = stats_json({"discovered": 3, "received": 3, "unrouted": 1, "processed": 1, "failed": 1}, "r9")
    assert json.loads(line) == {"run_id": "r9", "discovered": 3, "received": 3, "unrouted": 1, "processed": 1,
                                "failed": 1}


def test_routed_table_one_write_partitioned_by_pipeline(spark):
    from sluice.plans.flow import write_routed_table

    path = tempfile.mkdtemp() + "/routed"
    result = run_router(scan_files(spark, _landing_dir()), _spec(tempfile.mkdtemp()))
    write_routed_table(result, path, run_id="r")
    result.close()
    assert sorted(d for d in os.listdir(path) if d.startswith("pipeline_name=")) == [
        "pipeline_name=contract_pipeline", "pipeline_name=invoice_pipeline", "pipeline_name=unclassified_pipeline"]
    back = spark.read.parquet(path)
    assert back.count() == 3 and back.where("pipeline_name = 'invoice_pipeline'").first()["doc_type"] == "invoice"


def test_raw_copies_to_a_relative_path(docs, spark, monkeypatch):
    cwd = tempfile.mkdtemp()
    monkeypatch.chdir(cwd)
    write_content(docs([("/x/a.txt", b"A", None)]), "rel/raw")
    assert [f.endswith(".txt") for f in os.listdir(os.path.join(cwd, "rel/raw"))] == [True]


def _two_pipelines(sink_of, dead=None):
    from sluice.operators.parse import text_parser
    from sluice.operators.route import RouteTable
    from sluice.plans.flow import PipelineSpec, RouterSpec

    names = ["p1", "p2"]
    pipes = {n: PipelineSpec(n, parser=text_parser(), sinks=[sink_of(n)]) for n in names}
    return RouterSpec(RouteTable([("a", "p1"), ("b", "p2")], None), pipes)


def _typed_docs(docs, n):
    return docs([(f"uri://{k}", b"text", {}) for k in range(n)]).withColumn(
        "doc_type", F.when(F.substring("uri", -1, 1).cast("int") % 2 == 0, "a").otherwise("b"))


def test_second_run_in_a_session_sees_new_rows(spark, docs):
    path = tempfile.mkdtemp() + "/in"
    out = tempfile.mkdtemp() + "/out"
    spec = _two_pipelines(lambda n: json_sink(out, "r", n))
    _typed_docs(docs, 2).write.parquet(path)
    assert write_flow(run_router(spark.read.parquet(path), spec), spec.pipelines)["processed"] == 2
    _typed_docs(docs, 3).write.mode("append").parquet(path)
    assert write_flow(run_router(spark.read.parquet(path), spec), spec.pipelines)["processed"] == 5


def test_pipelines_share_a_path_in_a_micro_batch_and_in_overwrite(spark, docs):
    base = tempfile.mkdtemp()
    for sink, read in ((lambda n: json_sink(f"{base}/json", "r", n), lambda: spark.read.json(f"{base}/json")),
                       (lambda n: table_sink(f"{base}/table", "overwrite", run_id="r", pipeline_name=n),
                        lambda: spark.read.parquet(f"{base}/table"))):
        spec = _two_pipelines(sink)
        for batch in (0, 0, 1):  # the first batch is replayed
            write_flow(run_router(_typed_docs(docs, 4), spec), spec.pipelines, batch_id=batch)
        assert read().count() == 8
    spec = _two_pipelines(lambda n: table_sink(f"{base}/over", "overwrite", pipeline_name=n))
    write_flow(run_router(_typed_docs(docs, 4), spec), spec.pipelines)
    assert sorted(r.pipeline_name for r in spark.read.parquet(f"{base}/over").collect()) == ["p1", "p1", "p2", "p2"]


def test_extracted_json_keeps_null_fields(spark):
    from sluice.sinks.writers import extracted_json

    df = spark.createDataFrame([((1, None),)], "extracted struct<n:int,vendor:string>")
    assert df.select(extracted_json(F.col("extracted"), "struct<n:int,vendor:string>").alias("j")).first().j == '{"n":1,"vendor":null}'


def test_an_overwriting_target_is_replaced_once_per_run(spark, docs):
    base = tempfile.mkdtemp()
    for sink, read in ((lambda n: table_sink(f"{base}/t", "overwrite", pipeline_name=n), lambda: spark.read.parquet(f"{base}/t")),
                       (lambda n: json_sink(f"{base}/j", "r", n, mode="overwrite"), lambda: spark.read.json(f"{base}/j"))):
        spec = _two_pipelines(sink)
        write_flow(run_router(_typed_docs(docs, 5), spec), spec.pipelines)
        assert sorted(r.pipeline_name for r in read().collect()) == ["p1"] * 3 + ["p2"] * 2
        only_a = _typed_docs(docs, 5).where("doc_type = 'a'")
        write_flow(run_router(only_a, spec), spec.pipelines)
        assert sorted(r.pipeline_name for r in read().collect()) == ["p1"] * 3


def test_a_replayed_batch_replaces_its_rows_in_a_catalog_table(spark, docs):
    spark.sql("DROP TABLE IF EXISTS replayed_rows")
    spec = _two_pipelines(lambda n: table_sink("replayed_rows", pipeline_name=n))
    try:
        for batch, n in ((0, 4), (1, 6), (1, 4)):  # the replay of batch 1 brings less
            write_flow(run_router(_typed_docs(docs, n), spec), spec.pipelines, batch_id=batch)
        assert spark.table("replayed_rows").count() == 8
        write_flow(run_router(_typed_docs(docs, 4).where("doc_type = 'none'"), spec), spec.pipelines, batch_id=1)
        assert {(r["batch_id"], r["pipeline_name"]) for r in spark.table("replayed_rows").collect()} == {(0, "p1"), (0, "p2")}
    finally:
        spark.sql("DROP TABLE IF EXISTS replayed_rows")


def test_a_table_without_commit_columns_is_refused_to_streams(spark, docs):
    spark.range(1).write.mode("overwrite").saveAsTable("plain_rows")
    try:
        with pytest.raises(ValueError, match="not partitioned by"):
            table_sink("plain_rows", pipeline_name="p")(docs([("/a", b"x", None)]).withColumn("extracted", F.lit(None).cast("map<string,string>")), 0)
    finally:
        spark.sql("DROP TABLE plain_rows")


def test_records_with_different_fields_share_a_json_folder(spark, docs):
    path = tempfile.mkdtemp() + "/mixed"
    parsers = {"p1": lambda df: df.withColumn("extracted", F.struct(F.lit(1).alias("n"))),
               "p2": lambda df: df.withColumn("extracted", F.struct(F.lit("x").alias("name")))}
    spec = _two_pipelines(lambda n: json_sink(path, "r", n))
    for name, parser in parsers.items():
        spec.pipelines[name].parser = parser
    write_flow(run_router(_typed_docs(docs, 4), spec), spec.pipelines)
    got = {(r["pipeline_name"], r["extracted"]["n"], r["extracted"]["name"]) for r in spark.read.json(path).collect()}
    assert got == {("p1", 1, None), ("p2", None, "x")}

"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole tables (through the views in ``fixtures``) and
returns plain typed columns (no binary, no maps) so results can be
compared with the SQL twins in ``oracle``. Queries that exercise a sink
or a stream write to a fresh folder under ``spark.checkpoint.dir`` and
read their output back.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluice.functions.text import decode_utf8, extension_of, filename_of
from sluice.operators.classify import (
    classify_chain, extension_condition, rules_classifier, filename_condition, first_match, mime_condition, mime_of,
    model_classifier, path_condition, rule_condition,
)
from sluice.operators.extract import extract_fields, extract_map, hosted_prompt, schema_from_fields
from sluice.operators.models import python_predict
from sluice.operators.parse import document_parser, parse_document, text_parser
from sluice.operators.route import RouteTable, fan_out, route, route_by_table, split_unrouted
from sluice.operators.stats import StreamCounts, observe_stream
from sluice.plans import fixtures as fx
from sluice.plans import specs
from sluice.plans.flow import (
    PipelineSpec, RouterSpec, materialize, run_pipeline, run_router, write_flow, write_tables,
)
from sluice.session import fresh_path
from sluice.sinks.writers import content_names, json_sink, table_rows, table_sink, write_all, write_content, write_files, write_table
from sluice.sources.documents import to_documents, with_name_columns
from sluice.sources.files import files_pass, new_files, scan_files, scan_tree
from sluice.sources.landing import append_landing, next_watermark, read_increment
from sluice.sources.submissions import read_submissions, submit
from sluice.streaming.streams import run_router_stream, stream_files, stream_table, stream_to

RUN_ID = "run-0"
# Registered queries read whole texts: no snippet or prompt cut (the operators' defaults keep theirs).
WHOLE = None
WATERMARK = "2024-01-15 00:00:00"


def _long(c) -> F.Column:
    return c.cast("long")


# ---------------------------------------------------------------- sources


def doc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_name_columns(fx.landing(spark, sf_dir))
    return d.select("doc_id", "uri", "filename", "extension",
                    _long(F.octet_length("content")).alias("content_bytes"),
                    F.md5("content").alias("content_md5"),
                    F.to_json("metadata").alias("metadata_json"))


def _file_rows(docs: DataFrame, with_md5: bool = True, with_flag: bool = False) -> DataFrame:
    cols = [filename_of(F.col("uri")).alias("filename"), extension_of(F.col("uri")).alias("extension"),
            _long(F.col("length")).alias("size_bytes")]
    if with_md5:
        cols.append(F.col("content_md5"))
    if with_flag:
        cols.append(F.col("content").isNotNull().alias("has_content"))
    return docs.select(*cols)


def files_scan(spark, sf_dir):
    return _file_rows(scan_files(spark, sf_dir, digest=True))


FILE_PATTERNS = ["n*.parquet", "*ion*.parquet"]


def files_pattern(spark, sf_dir):
    return _file_rows(scan_files(spark, sf_dir, patterns=FILE_PATTERNS, include_content=False), with_md5=False)


def files_no_content(spark, sf_dir):
    return _file_rows(scan_files(spark, sf_dir, include_content=False), with_md5=False, with_flag=True)


def files_incremental(spark, sf_dir):
    """Documents already labelled count as seen; only the others are new."""
    found = fx.landing(spark, sf_dir)
    labelled_ids = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("src_id"))
    seen = found.join(labelled_ids, "src_id", "left_semi").select("uri")
    return new_files(found, seen).select("uri", "doc_id")


def files_stream_formats(spark, sf_dir):
    """JSON rows and text lines as streams of documents, each started twice; the second run adds nothing."""
    root, out = fresh_path(spark, "formats_in"), fresh_path(spark, "formats_out")
    docs = fx.table(spark, sf_dir, "documents")
    rows = docs.select(F.concat(F.lit("json://"), F.col("doc_id")).alias("path"), F.col("text").alias("content"), "lang", "n_chars")
    _write_files_of(docs, rows, 8).json(f"{root}/json")
    _write_files_of(docs, docs.select(F.concat_ws("\t", "doc_id", "source")), 8).text(f"{root}/text")
    for kind, schema in (("json", rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), ("text", None)):
        for _ in range(2):
            found = stream_files(spark, f"{root}/{kind}", max_files_per_trigger=2, file_format=kind, schema=schema)
            found = found.select(F.lit(kind).alias("kind"), F.when(F.lit(kind == "json"), F.col("uri")).alias("uri"),
                                 F.md5("content").alias("content_md5"), F.col("metadata")["lang"].alias("lang"),
                                 F.col("metadata")["n_chars"].alias("n_chars"), F.col("metadata")["value"].alias("line"))
            stream_to(found, out + "/" + kind, f"{out}_ckpt_{kind}").awaitTermination()
    return spark.read.parquet(f"{out}/json").unionByName(spark.read.parquet(f"{out}/text"))


def files_incremental_passes(spark, sf_dir):
    """S5 over real files: three passes, files landing before each; every third is hidden, and one more is empty."""
    root, state, out = (fresh_path(spark, f"passes_{n}") for n in ("landing", "seen", "out"))
    docs = fx.landing(spark, sf_dir)
    names = content_names(docs.select("src_id", "doc_id", "uri", "content"), ["src_id"])
    hidden = names.withColumn("name", F.concat(F.when(F.col("src_id") % 3 == 1, ".").otherwise(""), "name"))
    empty = F.lit(b"").alias("content")
    for k in range(3):
        write_files(hidden.where(F.col("src_id") % 3 == k), f"{root}/{k}")
        write_files(spark.range(1).select(F.lit(f"empty-{k}.txt").alias("name"), empty), f"{root}/{k}")
        files_pass(spark, root, state, lambda found: found.select(
            F.lit(k).alias("pass"), "uri", F.size("errors").alias("n_errors"), F.octet_length("content").alias("size_bytes"),
            F.md5("content").alias("content_md5")).write.mode("append").parquet(out))
    back = spark.read.parquet(out)
    return back.select(_long(F.col("pass")).alias("pass"), filename_of(F.col("uri")).alias("name"), _long(F.col("n_errors")).alias("n_errors"),
                       _long(F.col("size_bytes")).alias("size_bytes"), "content_md5")


def files_stream(spark, sf_dir):
    docs = stream_files(spark, sf_dir, max_files_per_trigger=5, digest=True)
    rows = docs.select("uri", "length", "content_md5")
    out, ckpt = fresh_path(spark, "files_stream"), fresh_path(spark, "files_stream_ckpt")
    stream_to(rows, out, ckpt).awaitTermination()
    back = spark.read.parquet(out)
    return back.select(filename_of(F.col("uri")).alias("filename"), extension_of(F.col("uri")).alias("extension"),
                       _long(F.col("length")).alias("size_bytes"), "content_md5")


def _event_rows(docs: DataFrame) -> DataFrame:
    return docs.select("uri", "ts", F.col("metadata")["event_type"].alias("event_type"),
                       F.col("metadata")["user_id"].alias("user_id"),
                       _long(F.octet_length("content")).alias("content_bytes"))


def landing_increment(spark, sf_dir):
    return _event_rows(read_increment(fx.landing_events_table(spark, sf_dir), "ts", WATERMARK))


def landing_watermark(spark, sf_dir):
    return next_watermark(fx.landing_events_table(spark, sf_dir), "ts", WATERMARK)


def landing_stream(spark, sf_dir):
    events = stream_table(spark, sf_dir, glob="events.parquet")
    table = events.select(F.concat(F.lit("event://"), F.col("event_id").cast("string")).alias("uri"),
                          F.encode("props", "UTF-8").alias("content"), "ts", "event_id", "user_id", "event_type")
    rows = _event_rows(read_increment(table, "ts"))
    out, ckpt = fresh_path(spark, "landing_stream"), fresh_path(spark, "landing_stream_ckpt")
    stream_to(rows, out, ckpt).awaitTermination()
    return spark.read.parquet(out)


def landing_append(spark, sf_dir):
    path = fresh_path(spark, "landing_table")
    append_landing(fx.landing_events_table(spark, sf_dir), path)
    return _event_rows(read_increment(spark.read.parquet(path), "ts"))


def submissions_ingest(spark, sf_dir):
    path = fresh_path(spark, "submissions")
    submit(fx.submissions_frame(spark, sf_dir), path)
    docs = read_submissions(spark, path)
    return docs.select("uri", F.col("metadata")["role"].alias("role"), F.col("metadata")["source"].alias("source"),
                       _long(F.octet_length("content")).alias("content_bytes"), F.md5("content").alias("content_md5"))


def submissions_stream(spark, sf_dir):
    """Three rounds of submissions; the second sends the whole first round again, which is consumed once."""
    inbox, out, checkpoint = (fresh_path(spark, f"submitted_{n}") for n in ("in", "out", "ckpt"))
    sent = fx.submissions_frame(spark, sf_dir)
    third = F.pmod(F.xxhash64("uri"), F.lit(3))
    for k in range(3):
        submit(sent.where(third == k), inbox)
        if k == 1:
            submit(sent.where(third == 0), inbox)
        docs = read_submissions(spark, inbox, stream=True, remember="30 days")
        stream_to(docs.select("uri", F.col("metadata")["role"].alias("role"), F.col("metadata")["source"].alias("source"),
                              _long(F.octet_length("content")).alias("content_bytes"), F.md5("content").alias("content_md5")),
                  out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def stream_stats(spark, sf_dir):
    """T1 on plain streams: documents and failures counted per micro-batch while S6, S9 and S11 streams are written."""
    inbox, rows = fresh_path(spark, "counted_submissions"), fresh_path(spark, "counted_files")
    sent = fx.submissions_frame(spark, sf_dir)
    broken = F.col("metadata")["role"] == "user"  # their content is no base64
    submit(sent.withColumn("content_base64", F.when(broken, F.lit("not base64!")).otherwise(F.col("content_base64"))), inbox)
    docs = fx.table(spark, sf_dir, "documents")
    _write_files_of(docs, docs.select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content")), 8).json(rows)
    _write_landing(spark, sf_dir, landed := fresh_path(spark, "counted_landing"))
    streams = {
        "files": stream_files(spark, rows, max_files_per_trigger=1, file_format="json", schema="path string, content string"),
        "landing": to_documents(stream_table(spark, landed, max_files_per_trigger=1), metadata=F.col("metadata")),
        "submissions": read_submissions(spark, inbox, stream=True),
    }
    counts = StreamCounts()
    spark.streams.addListener(counts)
    try:
        for name, stream in streams.items():
            observed = observe_stream(stream, name).select("uri", "errors")
            counts.wait(stream_to(observed, fresh_path(spark, f"counted_{name}_out"), fresh_path(spark, f"counted_{name}_ckpt")))
    finally:
        spark.streams.removeListener(counts)
    return reduce(DataFrame.unionByName, [
        spark.range(1).select(F.lit(name).alias("stream"), *[
            F.lit(v).alias(k) if isinstance(v, str) else _long(F.lit(v)).alias(k) for k, v in counts.totals(name, RUN_ID).items()])
        for name in streams])


# ---------------------------------------------------------------- classification


def rule_extension(spark, sf_dir):
    d = fx.landing(spark, sf_dir)
    uri = F.col("uri")
    return d.select("uri", extension_of(uri).alias("extension"),
                    extension_condition([".PDF"], uri).alias("is_pdf"),
                    extension_condition(["pdf", "DOCX"], uri).alias("is_office"),
                    extension_condition([], uri).alias("is_none"))


def rule_mime(spark, sf_dir):
    d = fx.landing(spark, sf_dir)
    return d.select("uri", mime_of(F.col("metadata")).alias("mime"),
                    mime_condition(["application/pdf"], F.col("metadata")).alias("is_pdf_mime"),
                    mime_condition(["text/plain", "application/pdf"], F.col("metadata")).alias("is_known_mime"))


def rule_filename(spark, sf_dir):
    d = fx.landing(spark, sf_dir)
    uri = F.col("uri")
    return d.select("uri", filename_of(uri).alias("filename"),
                    filename_condition("(?i)invoice", uri).alias("is_invoice"),
                    filename_condition("(?i)(contract|agreement|msa)", uri).alias("is_contract"),
                    filename_condition("^notes_[0-9]+[.]txt$", uri).alias("is_notes_txt"))


PATH_REGEX = "^/landing/src1[0-9]?/(en|de)/"


def rule_path(spark, sf_dir):
    d = fx.landing(spark, sf_dir)
    return d.select("uri", path_condition(PATH_REGEX, F.col("uri")).alias("matched"))


ALL_CONDITIONS_RULE = {"doc_type": "pdf_invoice_or_msa", "extensions": ["pdf"], "mime_types": ["application/pdf"],
                       "filename_regex": "(?i)^(invoice|msa)", "path_regex": "/(en|fr)/"}


def rule_all_conditions(spark, sf_dir):
    d = fx.landing(spark, sf_dir)
    return d.select("uri", rule_condition(ALL_CONDITIONS_RULE).alias("m_all"),
                    rule_condition({"doc_type": "anything"}).alias("m_none"))


def rule_first_match(spark, sf_dir):
    return fx.landing(spark, sf_dir).select("uri", first_match(specs.FLAGSHIP_RULES).alias("doc_type"))


def model_classify(spark, sf_dir):
    d = classify_chain(fx.landing(spark, sf_dir), [specs.language_model(WHOLE)])
    return d.select("uri", F.col("doc_type").alias("label"))


def udf_classifier(spark, sf_dir):
    d = classify_chain(fx.landing(spark, sf_dir), [specs.secret_classifier()])
    return d.select("uri", "doc_type")


def chain_first(spark, sf_dir):
    d = fx.labelled(spark, sf_dir, fx.landing(spark, sf_dir))
    d = classify_chain(d, [specs.flagship_classifier(), specs.language_model(WHOLE)], mode="first")
    return d.select("uri", "doc_type")


def chain_last(spark, sf_dir):
    d = classify_chain(fx.landing(spark, sf_dir), [specs.flagship_classifier()], mode="first")
    d = classify_chain(d, [specs.language_model(WHOLE), specs.oversized_classifier()], mode="last")
    return d.select("uri", "doc_type")


# ---------------------------------------------------------------- routing

RESOLVE_ROUTES = RouteTable(
    [("invoice", "invoice_pipeline"), ("contract", "contract_pipeline"),
     ("invoice", "shadow_pipeline"), ("*", "catchall_pipeline")],
    "unclassified_pipeline",
)


def _classified(spark, sf_dir):
    return classify_chain(fx.landing(spark, sf_dir), [specs.flagship_classifier()])


def route_resolve(spark, sf_dir):
    return route(_classified(spark, sf_dir), RESOLVE_ROUTES).select("uri", "doc_type", "pipeline")


def route_unrouted(spark, sf_dir):
    routed = route(_classified(spark, sf_dir), specs.flagship_routes(default=None))
    return split_unrouted(routed)[1].select("uri", "doc_type")


def route_fanout(spark, sf_dir):
    routed = materialize(route(_classified(spark, sf_dir).drop("content"), specs.flagship_routes()), "table")
    parts = fan_out(routed, specs.PIPELINES)
    return reduce(DataFrame.unionByName,
                  [df.select("uri", F.lit(name).alias("pipeline_name")) for name, df in parts.items()])


def route_strict(spark, sf_dir):
    """R3 on documents that all have a route (the raising side is pytest's)."""
    return route(_classified(spark, sf_dir), specs.flagship_routes(), strict=True).select("uri", "pipeline")


def route_table(spark, sf_dir):
    """R1 with routes that are data: two languages have a pipeline, the others take the default."""
    docs = fx.table(spark, sf_dir, "documents").where(F.col("lang").isin("en", "de"))
    routes = docs.groupBy(F.col("lang").alias("doc_type")).agg(F.min("doc_id").alias("ordinal")) \
                 .withColumn("pipeline", F.concat("doc_type", F.lit("_pipeline")))
    typed = fx.landing(spark, sf_dir).withColumn("doc_type", F.try_element_at("metadata", F.lit("lang")))
    return route_by_table(typed, routes, default="other_pipeline").select("uri", "pipeline")


def user_source(spark, sf_dir):
    """A pipeline whose source is the user's own function."""
    spec = PipelineSpec("event_pipeline", parser=text_parser(),
                        source=lambda s: read_increment(fx.landing_events_table(s, sf_dir), "ts"))
    out = run_pipeline(spark, spec).outputs["event_pipeline"]
    return out.select("uri", _long(F.col("extracted.length")).alias("text_chars"), F.md5("extracted.text").alias("text_md5"))


def user_sink(spark, sf_dir):
    """U4: every pipeline writes through the user's own sink function."""
    path = fresh_path(spark, "user_sink")

    def orc_sink(df, batch_id=None):
        df.select("uri", "pipeline", "extracted.length").write.mode("append").orc(path)

    _run_and_write(spark, sf_dir, flagship_spec(sinks_for=lambda name: [orc_sink]))
    return spark.read.orc(path).select("uri", F.col("pipeline").alias("pipeline_name"), _long(F.col("length")).alias("text_chars"))


# A scripted model: what it answers, or how it fails, follows from the file name.


def _label_client():
    def ask(request):
        name = request["filename"]
        if name.startswith("scan"):
            raise TimeoutError("model timed out")
        return "no such label" if name.startswith("memo") else " invoice\n" if name.startswith("Invoice") else "contract"

    return ask


def _fields_client():
    def ask(request):
        name = request["filename"]
        if name.startswith("scan"):
            raise TimeoutError("model timed out")
        if name.startswith("notes"):
            return None
        return "not json" if name.startswith("memo") else json.dumps({"vendor_name": name, "total_amount": 1.5})

    return ask


def _first_error() -> F.Column:
    return F.try_element_at("errors", F.lit(1)).alias("error")


def model_errors(spark, sf_dir):
    """C7 + E4: a failed model call is an error of its row; unknown labels are none."""
    model = model_classifier(["invoice", "contract"], predict=python_predict(_label_client, field=None))
    return classify_chain(fx.landing(spark, sf_dir), [model]).select("uri", "doc_type", _first_error())


def extract_bad_reply(spark, sf_dir):
    """P5 + P7: failed calls, missing replies and replies that are no JSON."""
    fields = [{"name": "vendor_name"}, {"name": "total_amount", "type": "number"}]
    d = extract_fields(fx.landing(spark, sf_dir), fields, predict=python_predict(_fields_client, field=None), expand=True)
    return d.select("uri", "vendor_name", "total_amount", _first_error())


def dedicated_pipeline(spark, sf_dir):
    spec = PipelineSpec("web_pipeline", parser=document_parser(),
                        classifiers=[rules_classifier(specs.WEB_RULES)],
                        source=lambda s: fx.web(s, sf_dir))
    out = run_pipeline(spark, spec).outputs["web_pipeline"]
    doc = F.col("extracted.parsed_document.document")
    return out.select("uri", "doc_type", doc["title"].alias("title"),
                      _long(F.length(doc["text"])).alias("text_chars"))


# ---------------------------------------------------------------- parsing


def parse_text_query(spark, sf_dir):
    d = text_parser()(fx.landing(spark, sf_dir))
    return d.select("uri", _long(F.col("extracted.length")).alias("text_chars"),
                    F.md5(F.col("extracted.text")).alias("text_md5"))


def parse_document_query(spark, sf_dir):
    d = parse_document(fx.web(spark, sf_dir))
    doc = F.col("parsed_document.document")
    kinds = doc["elements"]["type"]
    shown = F.filter(doc["elements"], lambda e: e["type"].isin("heading", "paragraph", "list_item"))
    lines = F.transform(shown, lambda e: F.concat_ws(":", e["type"], e["level"].cast("string"), e["content"]))
    return d.select("uri", doc["title"].alias("title"), _long(F.length(doc["text"])).alias("text_chars"),
                    F.md5(doc["text"]).alias("text_md5"),
                    _long(_count_of(kinds, "heading")).alias("n_headings"),
                    _long(_count_of(kinds, "paragraph")).alias("n_paragraphs"),
                    _long(_count_of(kinds, "list_item")).alias("n_list_items"),
                    F.md5(F.array_join(lines, "|")).alias("elements_md5"))


def _count_of(kinds, kind: str):
    """Elements of one kind; null when there is no parsed document (whatever ANSI mode says of size(null))."""
    return F.when(kinds.isNotNull(), F.size(kinds) - F.size(F.array_remove(kinds, kind)))


def extract_fields_query(spark, sf_dir):
    d = extract_fields(fx.landing(spark, sf_dir), specs.PII_FIELDS, max_content_chars=WHOLE, expand=True)
    return d.select("uri", "email", "ip", "card", F.array_join("phones", "|").alias("phones"),
                    (F.size("errors") > 0).alias("failed"))


def extract_prompt(spark, sf_dir):
    _, schema_json = schema_from_fields(specs.PII_FIELDS)
    d = fx.landing(spark, sf_dir)
    prompt = hosted_prompt(schema_json, decode_utf8(F.col("content")), max_chars=WHOLE)
    return d.select("uri", _long(F.length(prompt)).alias("prompt_chars"), F.md5(prompt).alias("prompt_md5"))


def _line_counts(raw: bytes) -> dict:
    text = raw.decode("utf-8", errors="ignore")
    if len(text) < specs.MIN_CHARS:
        raise ValueError("too short")
    return {"n_lines": text.count("\n") + 1, "n_chars": len(text)}


def extract_map_query(spark, sf_dir):
    d = fx.landing(spark, sf_dir).withColumn("extracted", extract_map(_line_counts)(F.col("content")))
    m = F.col("extracted")
    return d.select("uri", m["n_lines"].alias("n_lines"), m["n_chars"].alias("n_chars"), m["_error"].alias("error"))


def udf_parser_query(spark, sf_dir):
    d = specs.line_stats_parser()(fx.landing(spark, sf_dir))
    return d.select("uri", _long(F.col("extracted.n_lines")).alias("n_lines"),
                    F.col("extracted.first_word").alias("first_word"), (F.size("errors") > 0).alias("failed"))


# ---------------------------------------------------------------- flows, sinks, errors


def flagship_spec(parser_factory=text_parser, on_error="skip", dead_letter=None, default=specs.DEFAULT_PIPELINE,
                  sinks_for=None) -> RouterSpec:
    routes = specs.flagship_routes(default)
    pipelines = {
        name: PipelineSpec(name, parser=parser_factory(), on_error=on_error, dead_letter=dead_letter,
                           sinks=sinks_for(name) if sinks_for else ())
        for name in routes.pipelines()
    }
    return RouterSpec(routes, pipelines, classifiers=[specs.flagship_classifier()])


def router_batch(spark, sf_dir):
    """F1, the flagship: landing → rules → route (with default) → text parse → per pipeline/type."""
    result = run_router(fx.landing(spark, sf_dir), flagship_spec())
    parts = [df.select(F.lit(name).alias("pipeline_name"), "doc_type", F.col("extracted.length").alias("n"))
             for name, df in result.outputs.items()]
    return (reduce(DataFrame.unionByName, parts)
            .groupBy("pipeline_name", "doc_type")
            .agg(F.count(F.lit(1)).alias("n_docs"), _long(F.sum("n")).alias("text_chars")))


def _flow_rows(spark, sf_dir) -> DataFrame:
    result = run_router(fx.landing(spark, sf_dir), flagship_spec())
    return reduce(DataFrame.unionByName, [table_rows(df, name, RUN_ID) for name, df in result.outputs.items()])


def sink_table(spark, sf_dir):
    path = fresh_path(spark, "sink_table")
    write_table(_flow_rows(spark, sf_dir), path, mode="overwrite")
    back = spark.read.parquet(path)
    return back.select("doc_id", "uri", "doc_type", "metadata_json", F.md5("extracted_json").alias("extracted_md5"),
                       "pipeline_name", "run_id")


def _run_and_write(spark, sf_dir, spec: RouterSpec) -> dict:
    result = run_router(fx.landing(spark, sf_dir), spec)
    try:
        return write_flow(result, spec.pipelines, run_id=RUN_ID)
    finally:
        result.close()


def _read_records(spark, path):
    schema = ("doc_id string, uri string, doc_type string, ingested_at double, metadata map<string,string>, "
              "extracted struct<text:string,length:int>, errors array<string>, pipeline_name string, run_id string")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)


def sink_json(spark, sf_dir):
    path = fresh_path(spark, "sink_json")
    spec = flagship_spec(sinks_for=lambda name: [json_sink(f"{path}/{name}", RUN_ID, name)])
    _run_and_write(spark, sf_dir, spec)
    back = _read_records(spark, path)
    return back.select("uri", "doc_type", "pipeline_name", _long(F.size("errors")).alias("n_errors"),
                       _long(F.col("extracted.length")).alias("text_chars"), F.md5("extracted.text").alias("text_md5"),
                       F.to_json("metadata").alias("metadata_json"))


def sink_content(spark, sf_dir):
    path = fresh_path(spark, "sink_content")
    write_content(fx.landing(spark, sf_dir), path)
    back = scan_tree(spark, path).where("length > 0")  # listed and read by the executors; empty files are no rows, as with ``binaryFile``
    return back.select(filename_of(F.col("uri")).alias("name"), F.md5("content").alias("content_md5"))


def multi_sink(spark, sf_dir):
    table_path, json_path = fresh_path(spark, "multi_table"), fresh_path(spark, "multi_json")
    docs = run_router(fx.landing(spark, sf_dir), flagship_spec()).outputs
    rows = reduce(DataFrame.unionByName, [df.withColumn("pipeline", F.lit(n)) for n, df in docs.items()])
    write_all(rows, [table_sink(table_path, run_id=RUN_ID), json_sink(json_path, RUN_ID)])
    t = spark.read.parquet(table_path).select(F.lit("table").alias("sink"), "uri", "pipeline_name", "metadata_json",
                                              F.md5(F.get_json_object("extracted_json", "$.text")).alias("text_md5"))
    j = _read_records(spark, json_path).select(F.lit("json").alias("sink"), "uri", "pipeline_name",
                                               F.to_json("metadata").alias("metadata_json"), F.md5("extracted.text").alias("text_md5"))
    return t.unionByName(j)


def on_error_skip(spark, sf_dir):
    result = run_router(fx.landing(spark, sf_dir), flagship_spec(specs.checked_text_parser))
    parts = [df.select("uri", F.lit(n).alias("pipeline_name"), _long(F.col("extracted.length")).alias("text_chars"))
             for n, df in result.outputs.items()]
    return reduce(DataFrame.unionByName, parts)


def on_error_dead_letter(spark, sf_dir):
    path = fresh_path(spark, "dead_letter")
    spec = flagship_spec(specs.checked_text_parser, on_error="dead_letter", dead_letter=json_sink(path, RUN_ID))
    _run_and_write(spark, sf_dir, spec)
    back = spark.read.schema("uri string, pipeline_name string, errors array<string>").json(path)
    return back.select("uri", "pipeline_name", F.element_at("errors", 1).alias("error"))


def on_error_fail(spark, sf_dir):
    """E3 on documents that all pass (the raising side is pytest's)."""
    result = run_router(fx.landing(spark, sf_dir), flagship_spec(on_error="fail"))
    return reduce(DataFrame.unionByName, [df.select("uri", F.lit(n).alias("pipeline_name")) for n, df in result.outputs.items()])


def _record_rows(back: DataFrame) -> DataFrame:
    return back.select("uri", "doc_type", "pipeline_name", F.md5("extracted.text").alias("text_md5"),
                       F.to_json("metadata").alias("metadata_json"), "run_id")


def router_rerun(spark, sf_dir):
    """F1 twice in one session, the landing table grown in between: the second run sees every document."""
    landing_path, out = fresh_path(spark, "rerun_landing"), fresh_path(spark, "rerun_out")
    docs = fx.landing(spark, sf_dir).select("uri", "content", "metadata", "src_id")
    for i in range(2):
        docs.where(F.col("src_id") % 2 == i).write.mode("append").parquet(landing_path)
        spec = flagship_spec(sinks_for=lambda name: [json_sink(f"{out}/{i}", RUN_ID, name)])
        landed = to_documents(spark.read.parquet(landing_path), metadata=F.col("metadata"))
        write_flow(run_router(landed, spec), spec.pipelines, run_id=RUN_ID)
    return _record_rows(_read_records(spark, f"{out}/1"))


def _stream_router(spark, sf_dir, spec: RouterSpec, name: str) -> None:
    """The flow over the landed documents, one file per micro-batch."""
    landing_path = fresh_path(spark, f"{name}_landing")
    _write_landing(spark, sf_dir, landing_path)
    stream = stream_table(spark, landing_path, max_files_per_trigger=1)
    docs = to_documents(stream, metadata=F.col("metadata"))
    run_router_stream(docs, spec, fresh_path(spark, f"{name}_ckpt"), run_id=RUN_ID).awaitTermination()


def router_stream_dead_letter(spark, sf_dir):
    """F2 + E2: all pipelines share one dead-letter path over several micro-batches."""
    path = fresh_path(spark, "stream_dead")
    _stream_router(spark, sf_dir, flagship_spec(specs.checked_text_parser, on_error="dead_letter",
                                                dead_letter=json_sink(path, RUN_ID)), "stream_dead")
    schema = "uri string, pipeline_name string, errors array<string>, metadata map<string,string>, run_id string"
    back = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    return back.select("uri", "pipeline_name", _first_error(), F.to_json("metadata").alias("metadata_json"), "run_id")


@contextmanager
def _catalog_table(spark, name: str):
    """A table name in a database of its own, which goes when the rows have been copied out."""
    database = f"sluice_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_path(spark, name)}'")
    try:
        yield f"{database}.gold_rows"
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _gold_rows(spark, table: str, name: str) -> DataFrame:
    """The table sink's rows, kept in a folder so that the catalog table can go."""
    rows = spark.table(table).select("doc_id", "uri", "doc_type", "metadata_json", F.md5("extracted_json").alias("extracted_md5"),
                                     "pipeline_name", "run_id")
    path = fresh_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def router_stream_table(spark, sf_dir):
    """F2 + K1: all pipelines append to one catalog table over several micro-batches."""
    with _catalog_table(spark, "stream_catalog") as rows:
        _stream_router(spark, sf_dir, flagship_spec(sinks_for=lambda name: [table_sink(rows, run_id=RUN_ID, pipeline_name=name)]),
                       "stream_catalog")
        return _gold_rows(spark, rows, "stream_catalog_rows")


def router_stream_replay(spark, sf_dir):
    """F2 + K1: the second micro-batch dies between two targets and is replayed; no row comes twice or stays behind."""
    landing_path, checkpoint = fresh_path(spark, "replay_landing"), fresh_path(spark, "replay_ckpt")
    _write_landing(spark, sf_dir, landing_path)
    failures = []

    def dies_once(df, batch_id=None):
        df.write.format("noop").mode("overwrite").save()
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("the driver died here")

    with _catalog_table(spark, "replay_catalog") as rows:
        # one pipeline has written its rows when the other one's sink fails
        def sinks(name):
            table = table_sink(rows if name == specs.DEFAULT_PIPELINE else f"{rows}_{name}", run_id=RUN_ID, pipeline_name=name)
            return [table, dies_once]

        for _ in range(2):
            docs = to_documents(stream_table(spark, landing_path, max_files_per_trigger=1), metadata=F.col("metadata"))
            query = run_router_stream(docs, flagship_spec(sinks_for=sinks), checkpoint, run_id=RUN_ID)
            try:
                query.awaitTermination()
            except StreamingQueryException:
                if len(failures) != 1:
                    raise
        tables = [rows if name == specs.DEFAULT_PIPELINE else f"{rows}_{name}" for name in specs.flagship_routes(specs.DEFAULT_PIPELINE).pipelines()]
        parts = [_gold_rows(spark, t, "replay_rows") for t in tables]
    return reduce(DataFrame.unionByName, parts)


def sink_overwrite_twice(spark, sf_dir):
    """K1 + K2: two runs replace a table and a JSON folder that all pipelines share; the second brings contracts only."""
    table_path, json_path = fresh_path(spark, "over_table"), fresh_path(spark, "over_json")
    spec = flagship_spec(sinks_for=lambda name: [table_sink(table_path, "overwrite", run_id=RUN_ID, pipeline_name=name),
                                                 json_sink(json_path, RUN_ID, name, mode="overwrite")])
    for only in (None, "contract"):
        docs = classify_chain(fx.landing(spark, sf_dir), spec.classifiers, mode="first")
        docs = docs if only is None else docs.where(F.col("doc_type") == only)
        write_flow(run_router(docs, spec), spec.pipelines, run_id=RUN_ID)
    t = spark.read.parquet(table_path).select(F.lit("table").alias("sink"), "uri", "doc_type", "pipeline_name",
                                              F.md5("extracted_json").alias("extracted_md5"))
    j = _read_records(spark, json_path).select(F.lit("json").alias("sink"), "uri", "doc_type", "pipeline_name",
                                               F.md5("extracted.text").alias("extracted_md5"))
    return t.unionByName(j)


def run_stats(spark, sf_dir):
    result = run_router(fx.landing(spark, sf_dir), flagship_spec(specs.checked_text_parser, default=None))
    return result.stats(RUN_ID)


def router_stream(spark, sf_dir):
    """F2: the flagship flow over a landing table read as a stream of micro-batches."""
    landing_path = fresh_path(spark, "router_landing")
    _write_landing(spark, sf_dir, landing_path)
    out = fresh_path(spark, "router_stream_out")
    spec = flagship_spec(sinks_for=lambda name: [json_sink(out, RUN_ID, name)])  # all pipelines share the path
    stream = stream_table(spark, landing_path, max_files_per_trigger=3)
    docs = to_documents(stream, metadata=F.col("metadata"), keep=["src_id", "n_chars"])
    run_router_stream(docs, spec, fresh_path(spark, "router_stream_ckpt"), run_id=RUN_ID).awaitTermination()
    back = _read_records(spark, out)
    return (back.groupBy("pipeline_name", "doc_type")
                .agg(F.count(F.lit(1)).alias("n_docs"), _long(F.sum("extracted.length")).alias("text_chars")))


def _write_landing(spark, sf_dir, path, files: int = 4) -> None:
    """Land the documents as a table of several files."""
    docs = fx.landing(spark, sf_dir).select("uri", "content", "metadata", "src_id", "n_chars")
    _write_files_of(fx.table(spark, sf_dir, "documents"), docs, files, 1).mode("overwrite").parquet(path)


def _write_files_of(table: DataFrame, rows: DataFrame, files: int, least: int = 400):
    """A writer of ``rows`` (of as many as ``table`` has) as several files, without a shuffle: a stream of so many files
    each time takes about as many micro-batches whatever their size. A task for each core (or ``files``) writes, and
    starts another file after a share of all rows (``least`` rows of a small table).
    """
    tasks = max(files, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.coalesce(tasks).write.option("maxRecordsPerFile", max(least, -(-table.count() // files)))


def gold_tables(spark, sf_dir):
    paths = write_tables(fx.landing(spark, sf_dir), flagship_spec(), fresh_path(spark, "gold"))
    parts = [spark.read.parquet(paths[name]).select(F.lit(name).alias("table_name"), "uri", "doc_type",
                                                    _long(F.col("length")).alias("text_chars"), F.md5("text").alias("text_md5"))
             for name in specs.PIPELINES]
    return reduce(DataFrame.unionByName, parts)


def queries():
    return {
        "doc_normalize": doc_normalize,
        "files_scan": files_scan,
        "files_pattern": files_pattern,
        "files_no_content": files_no_content,
        "files_incremental": files_incremental,
        "files_stream": files_stream,
        "files_stream_formats": files_stream_formats,
        "files_incremental_passes": files_incremental_passes,
        "landing_increment": landing_increment,
        "landing_watermark": landing_watermark,
        "landing_stream": landing_stream,
        "landing_append": landing_append,
        "submissions_ingest": submissions_ingest,
        "submissions_stream": submissions_stream,
        "stream_stats": stream_stats,
        "rule_extension": rule_extension,
        "rule_mime": rule_mime,
        "rule_filename": rule_filename,
        "rule_path": rule_path,
        "rule_all_conditions": rule_all_conditions,
        "rule_first_match": rule_first_match,
        "model_classify": model_classify,
        "udf_classifier": udf_classifier,
        "chain_first": chain_first,
        "chain_last": chain_last,
        "route_resolve": route_resolve,
        "route_unrouted": route_unrouted,
        "route_fanout": route_fanout,
        "route_strict": route_strict,
        "route_by_table": route_table,
        "user_source": user_source,
        "user_sink": user_sink,
        "model_errors": model_errors,
        "extract_bad_reply": extract_bad_reply,
        "dedicated_pipeline": dedicated_pipeline,
        "parse_text": parse_text_query,
        "parse_document": parse_document_query,
        "extract_fields": extract_fields_query,
        "extract_prompt": extract_prompt,
        "extract_map": extract_map_query,
        "udf_parser": udf_parser_query,
        "sink_table": sink_table,
        "sink_json": sink_json,
        "sink_content": sink_content,
        "multi_sink": multi_sink,
        "on_error_skip": on_error_skip,
        "on_error_dead_letter": on_error_dead_letter,
        "on_error_fail": on_error_fail,
        "run_stats": run_stats,
        "router_rerun": router_rerun,
        "router_stream_dead_letter": router_stream_dead_letter,
        "router_stream_table": router_stream_table,
        "router_stream_replay": router_stream_replay,
        "sink_overwrite_twice": sink_overwrite_twice,
        "router_batch": router_batch,
        "router_stream": router_stream,
        "gold_tables": gold_tables,
    }

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.extract import (
    CORRUPT, NO_REPLY, extract_fields, extract_map, json_schema_of, parse_reply, schema_from_fields,
)
from sluice.operators.parse import document_parser, parse_document, text_parser, udf_parser


def _text(df):
    return {r["uri"]: (r["extracted"]["text"], r["extracted"]["length"]) for r in df.collect()}


def test_text_parser_hello_world_and_null(docs):
    d = docs([("/a", b"hello world", None), ("/b", None, None)])
    assert _text(text_parser()(d)) == {"/a": ("hello world", 11), "/b": ("", 0)}


RAW_BYTES = {
    "/bad": (b"ok\xff\xfebad", "okbad"),
    "/two": (b"h\xc3\xa9", "hé"),
    "/cut": (b"h\xc3", "h"),
    "/fffd": ("a�b".encode(), "a�b"),
    "/empty": (b"", ""),
}


def test_invalid_bytes_are_dropped_and_valid_fffd_kept(docs):
    d = docs([(u, raw, None) for u, (raw, _) in RAW_BYTES.items()])
    got = _text(text_parser()(d))
    assert {u: t for u, (t, _) in got.items()} == {u: want for u, (_, want) in RAW_BYTES.items()}
    assert got["/two"][1] == 2


def test_other_encodings(docs):
    d = docs([("/a", "café".encode("latin-1"), None)])
    assert _text(text_parser("latin-1")(d)) == {"/a": ("café", 4)}


PAGE = (b'<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{x}</style>'
        b'<script>var t="</p>";</script></head><body><!-- c --><h1>Head</h1>'
        b'<p>One <b>two</b></p>\n\n<p>Three&nbsp;x</p></body></html>')


def test_parse_document_html(docs):
    d = parse_document(docs([("/p.html", PAGE, None)])).first()["parsed_document"]["document"]
    assert d["title"] == "T & t"
    assert d["text"] == "T & t Head One two Three x"
    assert [(e["type"], e["content"]) for e in d["elements"]] == [
        ("heading", "Head"), ("paragraph", "One two"), ("paragraph", "Three x")]


ORDINARY = {
    "/fragment": ("<div>a <b>b</b></div>", "a b", []),
    "/prolog": ('<?xml version="1.0"?>\n<html><body><p>x</p></body></html>', "x", [("paragraph", "x")]),
    "/entities": ("<p>caf&eacute; &#8217; &#x2014; &mdash; &amp;lt; &nosuch; &#0;</p>", "café ’ — — &lt; &nosuch; &#0;",
                  [("paragraph", "café ’ — — &lt; &nosuch; &#0;")]),
    "/pre": ("<pre>b</pre><p>c</p><param x><picture></picture>", "b c", [("preformatted", "b"), ("paragraph", "c")]),
    "/order": ("<p>1</p><h2 id=x>2</h2><P class='a'>3<p>4<h3>5</h3><!-- <p>no</p> --><p>6", "1 2 3 4 5 6",
               [("paragraph", "1"), ("heading", "2"), ("paragraph", "3"), ("paragraph", "4"), ("heading", "5"), ("paragraph", "6")]),
    "/less": ("a < b and c<d & e", "a < b and c<d & e", [("paragraph", "a < b and c<d & e")]),
}


def test_parse_document_on_ordinary_html(docs):
    rows = parse_document(docs([(u, raw.encode(), None) for u, (raw, _, _) in ORDINARY.items()])).collect()
    got = {r["uri"]: r["parsed_document"]["document"] for r in rows}
    for uri, (_, text, elements) in ORDINARY.items():
        assert got[uri]["text"] == text, uri
        assert [(e["type"], e["content"]) for e in got[uri]["elements"]] == elements, uri


def test_parse_document_plain_text_and_empty(docs):
    out = {r["uri"]: r["parsed_document"] for r in parse_document(docs([("/a.txt", b"plain  text", None),
                                                                        ("/b", b"", None)])).collect()}
    assert out["/a.txt"]["document"]["text"] == "plain  text" and out["/a.txt"]["document"]["title"] is None
    assert out["/b"] is None
    parsed = document_parser()(docs([("/b", b"", None)])).first()["extracted"]
    assert parsed is None


FIELDS = [{"name": "vendor_name", "type": "string"}, {"name": "total_amount", "type": "number"}]


def test_schema_from_fields():
    schema, text = schema_from_fields(FIELDS)
    assert schema == T.StructType([T.StructField("vendor_name", T.StringType()),
                                   T.StructField("total_amount", T.DoubleType())])
    assert json.loads(text)["required"] == ["vendor_name", "total_amount"]


def test_optional_fields_left_out_of_required():
    spec = json_schema_of([{"name": "a"}, {"name": "b", "required": False}])
    assert spec["required"] == ["a"] and spec["properties"]["a"] == {"type": "string", "description": ""}


def test_json_schema_overrides_fields_and_nests():
    nested = {"type": "object", "properties": {"items": {"type": "array", "items": {
        "type": "object", "properties": {"qty": {"type": "integer"}}}}}}
    schema, _ = schema_from_fields(FIELDS, json_schema=nested)
    assert schema.simpleString() == "struct<items:array<struct<qty:bigint>>>"


def test_extraction_needs_fields_or_schema():
    with pytest.raises(ValueError):
        schema_from_fields()


def test_reply_parsing_bad_json_and_type_mismatch(spark):
    schema, _ = schema_from_fields(FIELDS)
    df = spark.createDataFrame([('{"vendor_name": "Acme", "total_amount": 42.5}',), ("not json",),
                                ('{"vendor_name": "A", "total_amount": "lots"}',)], "r string")
    rows = df.select(parse_reply(F.col("r"), schema).alias("p")).collect()
    assert rows[0]["p"]["vendor_name"] == "Acme" and rows[0]["p"][CORRUPT] is None
    assert rows[1]["p"][CORRUPT] == "not json"
    assert rows[2]["p"][CORRUPT] is not None


def test_extract_fields_with_a_model_reply(docs):
    @F.pandas_udf("string")
    def model(req):
        import pandas as pd

        return pd.Series([None if "nothing" in p else json.dumps({"vendor_name": "Acme", "total_amount": 42})
                          for p in req["prompt"]])

    d = docs([("/a.pdf", b"invoice text", None), ("/b.pdf", b"nothing", None)])
    out = {r["uri"]: r for r in extract_fields(d, FIELDS, predict=model, expand=True).collect()}
    assert out["/a.pdf"]["vendor_name"] == "Acme" and out["/a.pdf"]["total_amount"] == 42.0
    assert out["/a.pdf"]["errors"] == []
    assert out["/b.pdf"]["extracted"] is None and out["/b.pdf"]["errors"] == [NO_REPLY]


def test_model_client_is_planned_once_behind_filters(docs):
    from sluice.operators.classify import classify_chain, model_classifier
    from sluice.operators.models import python_predict
    from sluice.operators.route import RouteTable, fan_out, route

    ask = python_predict(lambda: lambda prompt: "x")
    d = docs([("/a.pdf", b"text", None)])
    kept = extract_fields(d, FIELDS, predict=ask).where(F.size("errors") == 0)
    routed = fan_out(route(classify_chain(d, [model_classifier(["x"], predict=ask)]), RouteTable([("x", "p")])), ["p"])["p"]
    for df in (kept, routed):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert routed.count() == 1 and kept.count() == 0


def test_a_null_number_never_reaches_an_attempted_function(spark):
    from sluice.operators.errors import attempt

    call = attempt(lambda n: int(n) + 1, "int")
    rows = spark.createDataFrame([(1,), (None,)], "n int").select("n", call(F.col("n")).alias("o")).collect()
    got = {r["n"]: (r["o"]["result"], r["o"]["error"]) if r["o"] else None for r in rows}
    assert got[1] == (2, None) and got[None] in (None, (None, None))


def test_extract_fields_prompt_uses_parsed_text_and_cut(docs):
    @F.pandas_udf("string")
    def echo(req):
        import pandas as pd

        return pd.Series([json.dumps({"vendor_name": p}) for p in req["prompt"]])

    d = parse_document(docs([("/a.html", b"<html><title>X</title><p>abcdef</p></html>", None)]))
    out = extract_fields(d, [{"name": "vendor_name"}], predict=echo, max_content_chars=4).first()
    prompt = out["extracted"]["vendor_name"]
    assert prompt.startswith("Extract fields per this JSON schema:\n{") and prompt.endswith("\n\nDocument:\nX ab")


def test_extract_map_stringifies_and_captures_errors(docs):
    def fn(raw):
        if raw == b"bad":
            raise ValueError("cannot read")
        return {"n": len(raw), "none": None}

    d = docs([("/a", b"abc", None), ("/b", b"bad", None)])
    got = {r["uri"]: r["m"] for r in d.select("uri", extract_map(fn)(F.col("content")).alias("m")).collect()}
    assert got == {"/a": {"n": "3", "none": None}, "/b": {"_error": "cannot read"}}


def test_udf_parser_records_errors_and_runs_once(docs):
    def fn(raw):
        if len(raw) < 3:
            raise ValueError("too short")
        return {"n": len(raw)}

    d = docs([("/a", b"abcd", None), ("/b", b"ab", None), ("/c", None, None)])
    out = udf_parser(fn, "n int")(d)
    got = {r["uri"]: (r["extracted"], r["errors"]) for r in out.collect()}
    assert got["/a"][0]["n"] == 4 and got["/a"][1] == []
    assert got["/b"] == (None, ["too short"])
    assert got["/c"] == (None, [])
    plan = out.where(F.size("errors") == 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_binary_formats_go_to_a_python_parser(docs, spark):
    calls = spark.sparkContext.accumulator(0)

    def fake_pdf(raw):
        calls.add(1)
        if raw.startswith(b"%PDF-broken"):
            raise ValueError("cannot parse")
        return {"text": "pdf text", "title": "Doc", "elements": [{"type": "paragraph", "content": "pdf text"}]}

    d = docs([("/a.pdf", b"%PDF-1.7\xff\xfe", None), ("/b.pdf", b"%PDF-broken\xff", None),
              ("/c.txt", b"plain", None)])
    rows = parse_document(d, fake_pdf).collect()
    assert {r["uri"]: r["errors"] for r in rows} == {"/a.pdf": [], "/b.pdf": ["cannot parse"], "/c.txt": []}
    got = {r["uri"]: r["parsed_document"] for r in rows}
    assert got["/a.pdf"]["document"]["text"] == "pdf text" and got["/a.pdf"]["document"]["title"] == "Doc"
    assert got["/b.pdf"]["document"] is None
    assert got["/c.txt"]["document"]["text"] == "plain"
    assert calls.value == 2


def test_document_fields_parser_merges_parse_and_fields(docs):
    from sluice.operators.extract import document_fields_parser

    @F.pandas_udf("string")
    def model(req):
        import pandas as pd

        return pd.Series([None if p is None else json.dumps({"vendor_name": "Acme"}) for p in req["prompt"]])

    d = docs([("/a.html", b"<html><title>Bill</title><p>pay</p></html>", None), ("/b", b"", None)])
    out = {r["uri"]: r for r in document_fields_parser([{"name": "vendor_name"}], predict=model)(d).collect()}
    a = out["/a.html"]["extracted"]
    assert a["vendor_name"] == "Acme" and a["parsed_document"]["document"]["title"] == "Bill"
    assert out["/b"]["extracted"] is None and out["/b"]["errors"] == []
    only = document_fields_parser()(d).first()["extracted"]
    assert only["parsed_document"]["document"]["text"] == "Bill pay"


STRUCTURES = {
    "/angles": ("<p>3 < 4 and 5 > 2</p>", "3 < 4 and 5 > 2", [("paragraph", "3 < 4 and 5 > 2", 0, None)]),
    "/prose": ("In C write <b> if x < y and z > w", "In C write <b> if x < y and z > w",
               [("paragraph", "In C write <b> if x < y and z > w", 0, None)]),
    "/tight": ("<p>if x<y and z>w then</p>", "if x<y and z>w then", [("paragraph", "if x<y and z>w then", 0, None)]),
    "/inline": ("<p>t<b>w</b>o <a title='a > b' href=\"x\">l<i>in</i>k</a><br>next</p>", "two link next",
                [("paragraph", "two link next", 0, None)]),
    "/pre": ("<pre>\na  &lt;b\n  c\n</pre><p> x  y </p>", "a <b c x y", [("preformatted", "a  <b\n  c", 0, None), ("paragraph", "x y", 0, None)]),
    "/lists": ("<ul><li>one<ul><li>in<li>ner</ul>tail<li><p>two</p></ul>", "one in ner tail two",
               [("list", "", 0, None), ("list_item", "one tail", 1, 0), ("list", "", 2, 1), ("list_item", "in", 3, 2),
                ("list_item", "ner", 3, 2), ("list_item", "", 1, 0), ("paragraph", "two", 2, 5)]),
    "/table": ("<table><caption>C</caption><tr><th>h<td>1<tr><td>2<table><tr><td>in</table></table>after", "C h 1 2 in after",
               [("table", "", 0, None), ("caption", "C", 1, 0), ("row", "", 1, 0), ("cell", "h", 2, 2), ("cell", "1", 2, 2),
                ("row", "", 1, 0), ("cell", "2", 2, 5), ("table", "", 3, 6), ("row", "", 4, 7), ("cell", "in", 5, 8)]),
    "/hidden": ("<p>a<script>if (x</p>y) <p></SCRIPT >b<!-- <p>no</p> > -->c<style>p>q</style></p>", "a bc",
                [("paragraph", "a bc", 0, None)]),
    "/open": ("<div>a<!-- never closed <p>b", "a", []),
    "/quote": ("<p class=\"x>y</p><p>z</p>", "y z", [("paragraph", "y", 0, None), ("paragraph", "z", 0, None)]),
    "/unknown": ("<note><to kind='x'>T</to><x-y z=1>U</x-y></note><p>V</p>", "T U V", [("paragraph", "V", 0, None)]),
}


def test_parse_document_keeps_text_and_nesting(docs):
    rows = parse_document(docs([(u, raw.encode(), None) for u, (raw, _, _) in STRUCTURES.items()])).collect()
    got = {r["uri"]: r["parsed_document"]["document"] for r in rows}
    for uri, (_, text, elements) in STRUCTURES.items():
        assert got[uri]["text"] == text, uri
        assert [tuple(e) for e in got[uri]["elements"]] == elements, uri


def test_html_is_read_in_one_pass():
    import time

    from sluice.functions.html import looks_html, parse_html

    for part in ("<a \"", "<", "<!--", "<p '", "</", "<x y z>", "<script>", "&#", "<li>"):
        text = "<p>" + part * 20_000
        start = time.perf_counter()
        assert looks_html(text) and parse_html(text)["text"] is not None
        assert time.perf_counter() - start < 5, part

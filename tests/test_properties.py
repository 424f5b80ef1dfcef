"""Property checks of the JVM-side text functions against Python semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.text import byte_prefix_text, decode_utf8, extension_of, filename_of

# Bytes biased towards UTF-8 structure: ASCII, lead and continuation bytes, whole characters.
chunks = st.one_of(
    st.binary(max_size=4),
    st.sampled_from([b"\xc3", b"\xa9", b"\xe2\x82", b"\xac", b"\xf0\x9f", b"\x98\x80", b"\xed\xa0\x80", b"\xff",
                     "�".encode(), b"\x01", b"\x01\x02", b"\x01\x03"]),
    st.text(max_size=4).map(lambda t: t.encode("utf-8", "surrogatepass")),
)
blobs = st.lists(chunks, max_size=12).map(b"".join)


def _check_decode(spark, values):
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, c binary")
    got = {r["i"]: r["t"] for r in df.select("i", decode_utf8(F.col("c")).alias("t")).collect()}
    for i, raw in enumerate(values):
        want = raw.decode("utf-8", errors="ignore")
        assert got[i] == want, (raw, got[i], want)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(blobs, min_size=1, max_size=40))
def test_lenient_decode_matches_python_ignore(spark, values):
    _check_decode(spark, values)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=1, max_size=30), st.integers(min_value=0, max_value=40))
def test_byte_prefix_matches_python_slice_then_ignore(spark, texts, n):
    data = [(i, bytearray(t.encode("utf-8", "surrogatepass"))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "i int, c binary")
    got = {r["i"]: r["t"] for r in df.select("i", byte_prefix_text(F.col("c"), n).alias("t")).collect()}
    for i, t in enumerate(texts):
        raw = t.encode("utf-8", "surrogatepass")
        want = raw[:n].decode("utf-8", errors="ignore") if n > 0 else ""
        assert got[i] == want, (raw, n, got[i], want)


def test_filename_and_extension_of_written_cases(spark):
    cases = [("/a/b/Report.PDF", "Report.PDF", "pdf"), ("plain", "plain", ""), ("x.tar.GZ", "x.tar.GZ", "gz"), ("/dir.d/none", "none", ""),
             ("s3://bucket/é.Txt", "é.Txt", "txt"), ("/ends/", "", ""), (".hidden", ".hidden", "hidden"), ("dot.", "dot.", "")]
    df = spark.createDataFrame([(u,) for u, _, _ in cases], "u string")
    got = {r["u"]: (r["f"], r["e"]) for r in df.select("u", filename_of(F.col("u")).alias("f"), extension_of(F.col("u")).alias("e")).collect()}
    assert got == {u: (f, e) for u, f, e in cases}


RULES = [
    {"doc_type": "invoice", "extensions": ["pdf"], "filename_regex": "(?i)inv"},
    {"doc_type": "mime_pdf", "mime_types": ["application/pdf"]},
    {"doc_type": "under_a", "path_regex": "^/a/", "extensions": [".TXT", "md"]},
    {"doc_type": "nothing", "extensions": []},
    {"doc_type": "any_x", "filename_regex": "x"},
]


metas = st.fixed_dictionaries({}, optional={
    "mime_type": st.sampled_from(["", "application/pdf", "text/plain"]),
    "content_type": st.sampled_from(["", "application/pdf"]),
})
paths = st.tuples(st.sampled_from(["/a/", "/b/", "/a/b/", ""]),
                  st.text(alphabet="INVinvx.pdfmdTXT", max_size=10)).map("".join)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(paths, metas), min_size=1, max_size=40))
def test_rules_relate(spark, rows):
    """A rule that never matches changes nothing; a rule put first only takes what it matches; order within a rule's lists is free."""
    from sluice.operators.classify import first_match

    df = spark.createDataFrame([(i, u, m) for i, (u, m) in enumerate(rows)],
                               "i int, uri string, metadata map<string,string>")
    never = {"doc_type": "never", "extensions": ["none"], "filename_regex": "^$"}
    front = {"doc_type": "front", "path_regex": "^/b/"}
    turned = [{k: v[::-1] if isinstance(v, list) else v for k, v in r.items()} for r in RULES]
    picked = df.select("uri", first_match(RULES).alias("t"), first_match([never, *RULES, never]).alias("with_never"),
                       first_match([front, *RULES]).alias("with_front"), first_match([front]).alias("front"),
                       first_match(turned).alias("turned")).collect()
    for r in picked:
        assert r["with_never"] == r["t"] == r["turned"]
        assert r["with_front"] == (r["front"] or r["t"])
        assert (r["front"] == "front") == r["uri"].startswith("/b/")


ROUTE_LIST = [("a", "p1"), ("b", "p2"), ("a", "p3"), ("*", "pw"), ("c", "p4")]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "c", "d", None]), min_size=1, max_size=30),
       st.lists(st.sampled_from(ROUTE_LIST), max_size=5), st.sampled_from([None, "dflt"]))
def test_routes_relate(spark, labels, routes, default):
    """A label's first route wins, others' order is free, the wildcard takes the rest, and the default what is left."""
    from sluice.operators.route import RouteTable, route

    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, doc_type string")

    def resolved(table, fallback=default):
        return {r["i"]: r["pipeline"] for r in route(df, RouteTable(table, fallback)).collect()}

    got = resolved(routes)
    assert resolved(sorted(routes, key=lambda r: r[0])) == got  # a stable sort keeps each label's own order
    assert resolved([*routes, ("zzz", "p9")]) == got
    assert resolved([("a", "first"), *routes]) == {i: "first" if x == "a" else got[i] for i, x in enumerate(labels)}
    if not routes:
        assert set(got.values()) == {default}
    if ("*", "pw") in routes:
        assert resolved(routes, None) == got and None not in got.values()



KEYWORDS = {"en": ["the", "and"], "fr": ["le", "et", "la"], "xx": ["é1"]}


def _python_keyword_label(text):
    import regex

    tokens = [t for t in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if t]
    scores = [sum(tokens.count(k) for k in kws) for kws in KEYWORDS.values()]
    best = max(scores)
    return None if best == 0 else list(KEYWORDS)[scores.index(best)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["the", "The", "and", "le", "Et", "la", "é1", "thé", "lea", "x",
                                          " ", ", ", "-", "é", "1"]), max_size=12).map("".join),
                min_size=1, max_size=30))
def test_keyword_model_matches_token_counting(spark, texts):
    from sluice.operators.classify import classify_chain, model_classifier

    df = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "i int, content binary")
    df = df.withColumn("uri", F.lit("/x")).withColumn("errors", F.array().cast("array<string>"))
    clf = model_classifier(list(KEYWORDS), keywords=KEYWORDS, max_content_chars=None)
    got = {r["i"]: r["doc_type"] for r in classify_chain(df, [clf]).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _python_keyword_label(t), t


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "c", "d", None]), min_size=1, max_size=30),
       st.lists(st.sampled_from(ROUTE_LIST), max_size=5), st.sampled_from([None, "dflt"]))
def test_route_table_join_equals_the_literal_map(spark, labels, routes, default):
    from sluice.operators.route import RouteTable, route, route_by_table

    df = spark.createDataFrame([(i, f"/u/{i}", x) for i, x in enumerate(labels)], "i int, uri string, doc_type string")
    table = spark.createDataFrame([(t, p, k) for k, (t, p) in enumerate(routes)],
                                  "doc_type string, pipeline string, ordinal int")
    out = route_by_table(df, table, default=default)
    want = route(df, RouteTable(routes, default))
    assert sorted((r["i"], r["pipeline"] or "") for r in out.collect()) == sorted((r["i"], r["pipeline"] or "") for r in want.collect())

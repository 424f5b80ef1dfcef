import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators.route import RouteTable, fan_out, route, route_by_table, split_unrouted

from conftest import labels_of

ROUTES = [("invoice", "invoice_pipeline"), ("contract", "contract_pipeline")]


def _typed(docs, pairs):
    d = docs([(u, b"x", None) for u, _ in pairs])
    types = dict(pairs)
    mapping = F.create_map(*[F.lit(x) for u, t in types.items() if t is not None for x in (u, t)])
    return d.withColumn("doc_type", F.try_element_at(mapping, F.col("uri")))


def test_label_routes_to_its_pipeline(docs):
    d = _typed(docs, [("/landing/Invoice_123.pdf", "invoice"), ("/landing/c.pdf", "contract")])
    got = labels_of(route(d, RouteTable(ROUTES)), "pipeline")
    assert got == {"/landing/Invoice_123.pdf": "invoice_pipeline", "/landing/c.pdf": "contract_pipeline"}


def test_default_takes_unlabelled_and_unrouted_labels(docs):
    d = _typed(docs, [("/landing/random_file.pdf", None), ("/landing/x.txt", "plain")])
    got = labels_of(route(d, RouteTable(ROUTES, "unclassified")), "pipeline")
    assert got == {"/landing/random_file.pdf": "unclassified", "/landing/x.txt": "unclassified"}


def test_wildcard_before_default_and_first_route_wins(docs):
    table = RouteTable([("invoice", "a"), ("invoice", "b"), ("*", "wild"), ("*", "wild2")], "default")
    d = _typed(docs, [("/1", "invoice"), ("/2", "other"), ("/3", None)])
    assert labels_of(route(d, table), "pipeline") == {"/1": "a", "/2": "wild", "/3": "wild"}


def test_no_route_no_default_is_null(docs):
    d = _typed(docs, [("/1", "other"), ("/2", None)])
    assert labels_of(route(d, RouteTable(ROUTES)), "pipeline") == {"/1": None, "/2": None}


def test_strict_routing_fails_with_uri_and_type(docs):
    d = _typed(docs, [("/landing/random_file.pdf", "other")])
    with pytest.raises(PySparkException) as err:
        route(d, RouteTable(ROUTES), strict=True).collect()
    assert "/landing/random_file.pdf" in str(err.value) and "doc_type=other" in str(err.value)


def test_non_strict_splits_unrouted(docs):
    d = _typed(docs, [("/1", "invoice"), ("/2", "other")])
    ok, unrouted = split_unrouted(route(d, RouteTable(ROUTES)))
    assert [r.uri for r in ok.collect()] == ["/1"] and [r.uri for r in unrouted.collect()] == ["/2"]


def test_fan_out_each_pipeline_sees_only_its_documents(docs):
    table = RouteTable([("invoice", "shared"), ("contract", "shared"), ("memo", "memos")], "rest")
    d = _typed(docs, [("/1", "invoice"), ("/2", "contract"), ("/3", "memo"), ("/4", None)])
    parts = fan_out(route(d, table), table.pipelines())
    got = {name: sorted(r.uri for r in df.collect()) for name, df in parts.items()}
    assert got == {"shared": ["/1", "/2"], "memos": ["/3"], "rest": ["/4"]}


def test_route_table_as_data_matches_literal_routes(docs, spark):
    rows = [("invoice", "a", 1), ("invoice", "b", 2), ("*", "wild", 3), ("contract", "c", 4)]
    routes = spark.createDataFrame(rows, "doc_type string, pipeline string, ordinal int")
    d = _typed(docs, [("/1", "invoice"), ("/2", "contract"), ("/3", "memo"), ("/4", None)])
    by_table = labels_of(route_by_table(d, routes, default="default"), "pipeline")
    literal = labels_of(route(d, RouteTable([(t, p) for t, p, _ in rows], "default")), "pipeline")
    assert by_table == literal == {"/1": "a", "/2": "c", "/3": "wild", "/4": "wild"}


def test_strict_routing_checks_even_when_pipeline_is_not_selected(docs):
    d = _typed(docs, [("/x", "other")])
    with pytest.raises(PySparkException):
        route(d, RouteTable(ROUTES), strict=True).select("uri").collect()


@pytest.mark.parametrize("limit", [50_000, 3, 0])
def test_routes_as_data_leave_documents_where_they_are(spark, docs, monkeypatch, limit):
    from sluice.operators import route as module

    monkeypatch.setattr(module, "BROADCAST_LABELS", limit)
    rows = [(f"label{k}", f"p{k}", k) for k in range(10)] + [("label1", "later", 99)]
    routes = spark.createDataFrame(rows, "doc_type string, pipeline string, ordinal int")
    d = _typed(docs, [("/1", "label1"), ("/2", "label7"), ("/3", "memo"), ("/4", None), ("/5", "label1")])
    routed = route_by_table(d, routes, default="rest")
    assert labels_of(routed, "pipeline") == {"/1": "p1", "/2": "p7", "/3": "rest", "/4": "rest", "/5": "p1"}
    assert routed.columns == [*d.columns, "pipeline"]
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit > 0)

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.operators.classify import (
    classify_chain, column_classifier, first_match, keyword_predict, model_classifier, rule_condition,
    rules_classifier, udf_classifier,
)

from conftest import labels_of

RULE_URIS = ["/x/a.png", "/x/a.pdf", "/x/Invoice_2024.pdf", "/x/contract.pdf", "/x/invoice.txt"]


def _label(df, rules):
    return labels_of(df.withColumn("doc_type", first_match(rules)))


def test_extension_rule(docs):
    d = docs([(u, b"x", None) for u in RULE_URIS])
    got = _label(d, [{"doc_type": "pdf", "extensions": ["pdf"]}])
    assert got["/x/a.png"] is None and got["/x/a.pdf"] == "pdf"


def test_extension_lower_case_and_leading_dot(docs):
    d = docs([("/x/A.PDF", b"x", None), ("/x/b.Docx", b"x", None), ("/x/noext", b"x", None)])
    got = _label(d, [{"doc_type": "office", "extensions": [".PDF", "DOCX"]}])
    assert got == {"/x/A.PDF": "office", "/x/b.Docx": "office", "/x/noext": None}


def test_empty_extension_list_matches_nothing(docs):
    d = docs([("/x/a.pdf", b"x", None), ("/x/noext", b"x", None)])
    assert set(_label(d, [{"doc_type": "t", "extensions": []}]).values()) == {None}


def test_filename_regex_rule(docs):
    d = docs([(u, b"x", None) for u in RULE_URIS])
    got = _label(d, [{"doc_type": "invoice", "filename_regex": "(?i)invoice"}])
    assert got["/x/Invoice_2024.pdf"] == "invoice" and got["/x/invoice.txt"] == "invoice"
    assert got["/x/contract.pdf"] is None


def test_filename_regex_looks_at_filename_only(docs):
    d = docs([("/invoices/a.pdf", b"x", None)])
    assert _label(d, [{"doc_type": "invoice", "filename_regex": "invoice"}])["/invoices/a.pdf"] is None


def test_path_regex_looks_at_whole_uri(docs):
    d = docs([("/invoices/a.pdf", b"x", None), ("/other/a.pdf", b"x", None)])
    got = _label(d, [{"doc_type": "invoice", "path_regex": "^/invoices/"}])
    assert got == {"/invoices/a.pdf": "invoice", "/other/a.pdf": None}


def test_all_conditions_must_match(docs):
    d = docs([(u, b"x", None) for u in RULE_URIS])
    got = _label(d, [{"doc_type": "invoice", "extensions": ["pdf"], "filename_regex": "(?i)invoice"}])
    assert got["/x/Invoice_2024.pdf"] == "invoice"
    assert got["/x/invoice.txt"] is None and got["/x/a.pdf"] is None


def test_mime_rule_and_content_type_fallback(docs):
    d = docs([
        ("/x/a", b"x", {"mime_type": "application/pdf"}),
        ("/x/b", b"x", {"mime_type": "", "content_type": "application/pdf"}),
        ("/x/c", b"x", {"content_type": "application/pdf"}),
        ("/x/d", b"x", {"mime_type": "text/plain", "content_type": "application/pdf"}),
        ("/x/e", b"x", None),
    ])
    got = _label(d, [{"doc_type": "pdf", "mime_types": ["application/pdf"]}])
    assert got == {"/x/a": "pdf", "/x/b": "pdf", "/x/c": "pdf", "/x/d": None, "/x/e": None}


def test_first_matching_rule_wins(docs):
    d = docs([("/x/Invoice_2024.pdf", b"x", None), ("/x/a.pdf", b"x", None)])
    rules = [{"doc_type": "invoice", "filename_regex": "(?i)invoice"}, {"doc_type": "pdf", "extensions": ["pdf"]}]
    assert _label(d, rules) == {"/x/Invoice_2024.pdf": "invoice", "/x/a.pdf": "pdf"}


def test_no_rules_gives_null_and_rule_without_conditions_matches(docs):
    d = docs([("/x/a.pdf", b"x", None)])
    assert _label(d, []) == {"/x/a.pdf": None}
    assert _label(d, [{"doc_type": "any"}]) == {"/x/a.pdf": "any"}


def test_rule_needs_doc_type():
    with pytest.raises(ValueError):
        rules_classifier([{"extensions": ["pdf"]}])
    with pytest.raises(ValueError):
        rule_condition({"extensions": ["pdf"]})


def _scripted(reply):
    @F.pandas_udf("string")
    def predict(req: pd.DataFrame) -> pd.Series:
        return pd.Series([None if p is None else reply for p in req["prompt"]])

    return predict


def test_model_label_in_set_is_kept_and_trimmed(docs):
    d = docs([("/x/a.pdf", b"hello", None)])
    clf = model_classifier(["invoice", "contract"], predict=_scripted("  invoice \n"))
    assert labels_of(classify_chain(d, [clf])) == {"/x/a.pdf": "invoice"}


def test_model_label_outside_set_is_null(docs):
    d = docs([("/x/a.pdf", b"hello", None)])
    clf = model_classifier({"invoice": "a bill"}, predict=_scripted("resume"))
    assert labels_of(classify_chain(d, [clf])) == {"/x/a.pdf": None}


def test_model_needs_labels():
    with pytest.raises(ValueError):
        model_classifier([], predict=_scripted("x"))


def test_model_skips_empty_content_without_a_call(docs):
    d = docs([("/x/a", b"", None), ("/x/b", None, None), ("/x/c", b"text", None)])
    clf = model_classifier(["invoice"], predict=_scripted("invoice"), skip_empty=True)
    assert labels_of(classify_chain(d, [clf])) == {"/x/a": None, "/x/b": None, "/x/c": "invoice"}


def test_prompt_lists_labels_filename_and_byte_snippet(docs):
    from sluice.functions.text import byte_prefix_text
    from sluice.operators.classify import label_prompt

    d = docs([("/x/a.txt", "é".encode() * 3, None)])
    prompt = d.select(label_prompt({"a": "first", "b": ""}, F.lit("a.txt"),
                                   byte_prefix_text(F.col("content"), 5)).alias("p")).first()["p"]
    assert prompt == ("Labels:\n- a: first\n- b\n\nFilename: a.txt\nContent snippet:\néé\n\n"
                      "Which label best matches this document?")


def test_keyword_model_counts_whole_tokens(docs):
    d = docs([("/x/1", b"the cat and the dog", None), ("/x/2", b"le chat et la theorie", None),
              ("/x/3", b"nothing matches here", None), ("/x/4", b"thee andes", None)])
    clf = model_classifier(["en", "fr"], keywords={"en": ["the", "and"], "fr": ["le", "la", "et"]})
    assert labels_of(classify_chain(d, [clf])) == {"/x/1": "en", "/x/2": "fr", "/x/3": None, "/x/4": None}


def test_keyword_model_ties_go_to_first_label(docs):
    d = docs([("/x/1", b"the le", None)])
    clf = model_classifier(["en", "fr"], predict=keyword_predict({"en": ["the"], "fr": ["le"]}))
    assert labels_of(classify_chain(d, [clf])) == {"/x/1": "en"}


def test_udf_classifier_exception_gives_null(docs):
    def fn(raw):
        if raw.startswith(b"boom"):
            raise RuntimeError("model down")
        return "ok"

    d = docs([("/x/a", b"boom", None), ("/x/b", b"fine", None), ("/x/c", None, None)])
    out = classify_chain(d, [udf_classifier(fn)])
    assert labels_of(out) == {"/x/a": None, "/x/b": "ok", "/x/c": None}
    assert labels_of(out, "errors") == {"/x/a": ["model down"], "/x/b": [], "/x/c": []}


def test_udf_only_sees_rows_rules_left_unlabelled(docs, spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(raw):
        calls.add(1)
        return "model"

    d = docs([("/x/Invoice.pdf", b"a", None), ("/x/b.pdf", b"b", None), ("/x/c.pdf", b"c", None)])
    chain = [rules_classifier([{"doc_type": "invoice", "filename_regex": "(?i)invoice"}]), udf_classifier(fn)]
    got = labels_of(classify_chain(d, chain))
    assert got == {"/x/Invoice.pdf": "invoice", "/x/b.pdf": "model", "/x/c.pdf": "model"}
    assert calls.value == 2


def test_router_chain_keeps_existing_label_and_first_answer_wins(docs):
    d = docs([("/x/a.pdf", b"x", None)], doc_type="given")
    chain = [rules_classifier([{"doc_type": "pdf", "extensions": ["pdf"]}])]
    assert labels_of(classify_chain(d, chain, mode="first")) == {"/x/a.pdf": "given"}
    d2 = docs([("/x/a.pdf", b"x", None)])
    two = chain + [rules_classifier([{"doc_type": "second"}])]
    assert labels_of(classify_chain(d2, two, mode="first")) == {"/x/a.pdf": "pdf"}


def test_pipeline_chain_last_answer_wins_and_null_never_erases(docs):
    d = docs([("/x/a.pdf", b"x", None), ("/x/b.txt", b"x", None)], doc_type="router")
    chain = [rules_classifier([{"doc_type": "pdf", "extensions": ["pdf"]}]),
             column_classifier(lambda df: F.when(F.col("uri").endswith("a.pdf"), F.lit("late")))]
    assert labels_of(classify_chain(d, chain, mode="last")) == {"/x/a.pdf": "late", "/x/b.txt": "router"}


def test_empty_chain_leaves_doc_type(docs):
    d = docs([("/x/a", b"x", None)])
    out = classify_chain(d, [])
    assert out.schema["doc_type"].dataType.simpleString() == "string"
    assert labels_of(out) == {"/x/a": None}


def test_model_classifier_works_outside_a_chain(docs):
    d = docs([("/x/1", b"the cat and the dog", None)])
    clf = model_classifier(["en"], keywords={"en": ["the"]})
    assert labels_of(d.withColumn("doc_type", clf(d, F.lit(True)))) == {"/x/1": "en"}


def test_python_client_predict_labels_and_skips_unasked_rows(docs, spark):
    from sluice.operators.models import python_predict

    made, calls = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def make_client():
        made.add(1)

        def ask(prompt):
            calls.add(1)
            if "boom" in prompt:
                raise TimeoutError("model timed out")
            return " contract\n" if "agreement" in prompt else "invoice"

        return ask

    d = docs([("/x/Invoice.pdf", b"rule hits", None), ("/x/a.pdf", b"an agreement", None),
              ("/x/b.pdf", b"a bill", None), ("/x/c.pdf", b"boom", None)]).coalesce(1)
    chain = [rules_classifier([{"doc_type": "ruled", "filename_regex": "(?i)invoice"}]),
             model_classifier(["invoice", "contract"], predict=python_predict(make_client))]
    out = classify_chain(d, chain).collect()
    got = {r["uri"]: r["doc_type"] for r in out}
    assert got == {"/x/Invoice.pdf": "ruled", "/x/a.pdf": "contract", "/x/b.pdf": "invoice", "/x/c.pdf": None}
    assert {r["uri"]: r["errors"] for r in out if r["errors"]} == {"/x/c.pdf": ["model timed out"]}
    assert calls.value == 3 and made.value == 1


def test_python_client_extraction_reply(docs):
    import json as _json

    from sluice.operators.extract import extract_fields
    from sluice.operators.models import python_predict

    def make_client():
        return lambda prompt: None if "empty" in prompt else _json.dumps({"vendor_name": "Acme"})

    d = docs([("/a.pdf", b"invoice from Acme", None), ("/b.pdf", b"empty", None)])
    out = {r["uri"]: r for r in extract_fields(d, [{"name": "vendor_name"}], predict=python_predict(make_client),
                                                prompt="direct").collect()}
    assert out["/a.pdf"]["extracted"]["vendor_name"] == "Acme" and out["/a.pdf"]["errors"] == []
    assert out["/b.pdf"]["extracted"] is None and len(out["/b.pdf"]["errors"]) == 1


def test_python_client_can_receive_the_whole_request(docs):
    from sluice.operators.classify import LABEL_SYSTEM_PROMPT
    from sluice.operators.models import python_predict

    def make_client():
        def ask(request):
            assert request["system"] == LABEL_SYSTEM_PROMPT and request["filename"] == "a.pdf"
            return "invoice" if "bill" in request["snippet"] else "contract"

        return ask

    d = docs([("/x/a.pdf", b"a bill", None)])
    clf = model_classifier(["invoice", "contract"], predict=python_predict(make_client, field=None))
    assert labels_of(classify_chain(d, [clf])) == {"/x/a.pdf": "invoice"}


def test_python_client_concurrent_calls_keep_order(docs):
    import time

    from sluice.operators.models import python_predict

    def make_client():
        def ask(prompt):
            time.sleep(0.01)
            return "invoice" if "bill" in prompt else "contract"

        return ask

    rows = [(f"/x/{i}.pdf", b"a bill" if i % 3 else b"a deal", None) for i in range(40)]
    d = docs(rows).coalesce(1)
    clf = model_classifier(["invoice", "contract"], predict=python_predict(make_client, concurrency=8))
    got = labels_of(classify_chain(d, [clf]))
    assert got == {f"/x/{i}.pdf": ("invoice" if i % 3 else "contract") for i in range(40)}

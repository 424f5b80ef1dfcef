"""The example flow configurations used by the registered queries, tests and bench."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators.classify import column_classifier, model_classifier, rules_classifier, udf_classifier
from sluice.operators.parse import checked_parser, text_parser, udf_parser
from sluice.operators.route import RouteTable

# The flagship rule list, in order.
FLAGSHIP_RULES = [
    {"doc_type": "invoice", "extensions": ["pdf"], "filename_regex": "(?i)invoice"},
    {"doc_type": "contract", "extensions": ["pdf", "docx"], "filename_regex": "(?i)(contract|agreement|msa)"},
    {"doc_type": "plain", "extensions": ["txt"]},
]

FLAGSHIP_ROUTES = [("invoice", "invoice_pipeline"), ("contract", "contract_pipeline")]
DEFAULT_PIPELINE = "unclassified_pipeline"
PIPELINES = ["invoice_pipeline", "contract_pipeline", "unclassified_pipeline"]

# Label → description and keyword lists of the default keyword model.
LANGUAGE_LABELS = {
    "english": "English prose",
    "french": "French prose",
    "spanish": "Spanish prose",
    "german": "German prose",
}
LANGUAGE_KEYWORDS = {
    "english": ["the", "and", "of", "to", "is"],
    "french": ["le", "la", "les", "des", "et"],
    "spanish": ["el", "los", "las", "que", "y"],
    "german": ["der", "die", "und", "das", "ist"],
}

# Field specs with the extraction patterns of the default regex model.
PII_FIELDS = [
    {"name": "email", "type": "string", "description": "An e-mail address",
     "pattern": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "contains": "@"},
    {"name": "ip", "type": "string", "description": "An IPv4 address",
     "pattern": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"},
    {"name": "card", "type": "string", "description": "A long account or card number",
     "pattern": r"[0-9]{13,19}"},
    {"name": "phones", "type": "array", "description": "Phone numbers", "required": False,
     "pattern": r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}", "contains": "+"},
]

WEB_RULES = [
    {"doc_type": "html_page", "extensions": ["html"]},
    {"doc_type": "spam", "path_regex": "(spam-farm|cheap-pills)"},
]

MIN_CHARS = 200


def flagship_routes(default: str | None = DEFAULT_PIPELINE) -> RouteTable:
    return RouteTable(FLAGSHIP_ROUTES, default)


def flagship_classifier():
    return rules_classifier(FLAGSHIP_RULES)


def language_model(max_content_chars: int | None = None):
    return model_classifier(LANGUAGE_LABELS, keywords=LANGUAGE_KEYWORDS, max_content_chars=max_content_chars)


def oversized_classifier(limit: int = 20_000):
    return column_classifier(lambda df: F.when(F.col("n_chars") > limit, F.lit("oversized")))


def secret_or_long(raw: bytes) -> str | None:
    """Python classifier of the C8/U2 example: secrets first, then long texts."""
    if len(raw) < 100:
        raise ValueError("too small to judge")
    if b'token = "' in raw:
        return "secret"
    if raw.count(b"\n") > 20:
        return "long_form"
    return None


def secret_classifier():
    return udf_classifier(secret_or_long)


def checked_text_parser():
    """A parser that refuses short documents (the ``failing`` fixture)."""
    return checked_parser(text_parser(), lambda: F.col("extracted.length") < MIN_CHARS, "too short")


def line_stats(raw: bytes) -> dict:
    text = raw.decode("utf-8", errors="ignore")
    return {"n_lines": text.count("\n") + 1, "first_word": text.split(" ")[0]}


def line_stats_parser():
    return udf_parser(line_stats, "n_lines int, first_word string")

"""Rule conditions, ordered rules, model labels, classifier chains.

A *classifier* is a callable ``(df, needed) -> Column`` returning a string
label or null. ``needed`` is a boolean column that is true where an
answer is still wanted: native classifiers may ignore it, but anything
that leaves the JVM (a pandas UDF, a model call) must feed null input to
rows that do not need it, because Spark evaluates a Python UDF on every
row of its input regardless of any surrounding ``coalesce``/``when``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import byte_prefix_text, extension_of, filename_of
from sluice.operators.errors import attempt
from sluice.operators.models import returns_outcome
from sluice.sources.documents import add_errors

Classifier = Callable[[DataFrame, Column], Column]


def null_label() -> Column:
    return F.lit(None).cast("string")


# ---------------------------------------------------------------- rules


def extension_condition(extensions: Sequence[str], uri: Column) -> Column:
    """Extension in the set; both sides lower-cased, leading dots ignored; ``[]`` matches nothing."""
    wanted = sorted({e.lower().lstrip(".") for e in extensions})
    if not wanted:
        return F.lit(False)
    return extension_of(uri).isin(wanted)


def mime_of(metadata: Column) -> Column:
    """``metadata.mime_type``, falling back to ``content_type`` when missing or empty."""
    return F.coalesce(F.nullif(F.try_element_at(metadata, F.lit("mime_type")), F.lit("")),
                      F.try_element_at(metadata, F.lit("content_type")))


def mime_condition(mime_types: Sequence[str], metadata: Column) -> Column:
    """Effective MIME type in the list (no MIME type never matches)."""
    if not mime_types:
        return F.lit(False)
    return F.coalesce(mime_of(metadata).isin(list(mime_types)), F.lit(False))


def filename_condition(pattern: str, uri: Column) -> Column:
    """Regex *find* on the filename."""
    return F.coalesce(filename_of(uri).rlike(pattern), F.lit(False))


def path_condition(pattern: str, uri: Column) -> Column:
    """C4: regex *find* on the whole URI."""
    return F.coalesce(uri.rlike(pattern), F.lit(False))


def rule_condition(rule: Mapping[str, Any], uri: Column | None = None, metadata: Column | None = None) -> Column:
    """AND of the conditions the rule gives; a rule with none always matches."""
    if "doc_type" not in rule:
        raise ValueError(f"rule missing `doc_type`: {dict(rule)}")
    uri = F.col("uri") if uri is None else uri
    metadata = F.col("metadata") if metadata is None else metadata
    parts: list[Column] = []
    if rule.get("extensions") is not None:
        parts.append(extension_condition(rule["extensions"], uri))
    if rule.get("mime_types") is not None:
        parts.append(mime_condition(rule["mime_types"], metadata))
    if rule.get("filename_regex") is not None:
        parts.append(filename_condition(rule["filename_regex"], uri))
    if rule.get("path_regex") is not None:
        parts.append(path_condition(rule["path_regex"], uri))
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def first_match(rules: Sequence[Mapping[str, Any]], uri: Column | None = None,
                metadata: Column | None = None) -> Column:
    """Label of the first rule that matches, else null."""
    label = null_label()
    for rule in reversed(list(rules)):
        label = F.when(rule_condition(rule, uri, metadata), F.lit(str(rule["doc_type"]))).otherwise(label)
    return label.cast("string")


def rules_classifier(rules: Sequence[Mapping[str, Any]]) -> Classifier:
    for rule in rules:
        if "doc_type" not in rule:
            raise ValueError(f"rule missing `doc_type`: {dict(rule)}")
    return lambda df, needed: first_match(rules)


# ---------------------------------------------------------------- model labels

SNIPPET_COL = "_snippet"

# Characters stripped from a model reply (as Python's ``str.strip``, ASCII part).
WHITESPACE = " \t\n\r\x0b\x0c"

# The instruction sent with every label request.
LABEL_SYSTEM_PROMPT = (
    "You classify documents into exactly one label. Respond with only the "
    "label text and nothing else. If none of the labels fit, respond with "
    "the single word: unknown."
)


# The layout of a label request (label lines, filename, snippet, question).
LABEL_LINE, LABEL_LINE_DESCRIBED = "- {label}", "- {label}: {description}"
LABEL_HEAD, FILENAME_HEAD, SNIPPET_HEAD = "Labels:\n", "\n\nFilename: ", "\nContent snippet:\n"
LABEL_QUESTION = "\n\nWhich label best matches this document?"


def label_prompt(labels: Mapping[str, str], filename: Column, snippet: Column) -> Column:
    lines = "\n".join(LABEL_LINE_DESCRIBED.format(label=k, description=v) if v else LABEL_LINE.format(label=k)
                      for k, v in labels.items())
    return F.concat(F.lit(LABEL_HEAD + lines + FILENAME_HEAD), filename, F.lit(SNIPPET_HEAD), snippet,
                    F.lit(LABEL_QUESTION))


def keyword_pattern(words: Sequence[str]) -> str:
    """Regex matching any of ``words`` as a whole token (no letter or digit on either side)."""
    alternatives = "|".join(re.escape(w.lower()) for w in sorted(set(words), key=lambda w: (-len(w), w)))
    return rf"(?<![\p{{L}}\p{{N}}])(?:{alternatives})(?![\p{{L}}\p{{N}}])"


def keyword_predict(keywords: Mapping[str, Sequence[str]]) -> Callable[[Column], Column]:
    """Default deterministic model: per label, count snippet tokens in its keyword list;
    highest count wins, ties go to the earlier label, no hit at all gives null.

    Each label's count is one ``regexp_count`` (generated code). The
    arg-max is a single ``greatest`` over ``count * (n + 1) + (n - k)``:
    the largest value has the highest count and, on ties, the earliest
    label; the constant ``n`` (label 0, "none") wins when nothing matched.
    """
    labels = list(keywords)
    n = len(labels)

    def predict(request: Column) -> Column:
        text = F.lower(request["snippet"])
        coded = F.greatest(F.lit(n), *[
            F.regexp_count(text, F.lit(keyword_pattern(keywords[label]))) * (n + 1) + (n - k)
            for k, label in enumerate(labels, start=1)
        ])
        names = F.array(F.lit(None).cast("string"), *[F.lit(x) for x in labels])
        return F.element_at(names, (F.lit(n + 1) - coded % (n + 1)).cast("int"))

    return predict


@dataclass
class ModelLabels:
    """Ask a model for one label out of a fixed set.

    ``predict`` maps a request struct ``<prompt, system, filename, snippet>`` to a
    string column; it is either a native expression (the keyword default)
    or a pandas UDF wrapping a real model (``python_predict``, whose failed
    calls end in the row's ``errors``). The answer is trimmed and kept
    only when it is one of the labels. ``skip_empty`` gives null without a
    call for rows with no content (the hosted variant).
    """

    labels: Mapping[str, str] | Sequence[str]
    predict: Callable[[Column], Column]
    max_content_chars: int | None = None
    skip_empty: bool = False

    def __post_init__(self) -> None:
        if not self.labels:
            raise ValueError("a model classifier needs at least one label")
        if not isinstance(self.labels, Mapping):
            self.labels = {label: "" for label in self.labels}

    @property
    def returns_outcome(self) -> bool:
        return returns_outcome(self.predict)

    def _ask(self, needed: Column) -> Column:
        if not self.skip_empty:
            return needed
        return needed & F.coalesce(F.octet_length(F.col("content")) > 0, F.lit(False))

    def prepare(self, df: DataFrame, needed: Column) -> DataFrame:
        """Decode the snippet once, in its own column, for the rows that ask."""
        snippet = byte_prefix_text(F.col("content"), self.max_content_chars)
        return df.withColumn(SNIPPET_COL, F.when(self._ask(needed), snippet))

    def __call__(self, df: DataFrame, needed: Column) -> Column:
        ask = self._ask(needed)
        filename = filename_of(F.col("uri"))
        snippet = (F.col(SNIPPET_COL) if SNIPPET_COL in df.columns
                   else byte_prefix_text(F.col("content"), self.max_content_chars))
        request = F.when(ask, F.struct(
            label_prompt(self.labels, filename, snippet).alias("prompt"),
            F.lit(LABEL_SYSTEM_PROMPT).alias("system"),
            filename.alias("filename"),
            snippet.alias("snippet"),
        ))
        if self.returns_outcome:  # <result, error>: the chain reads the label off the planned column
            return self.predict(request)
        # Rows not asked get no label even if ``predict`` answers a null
        # request; ``ask`` is folded in without a branch so the predictor
        # stays outside CASE WHEN, where Spark does not share common parts.
        return self.label_of(F.concat(self.predict(request), F.when(ask, F.lit(""))))

    def label_of(self, reply: Column) -> Column:
        """The trimmed reply when it is one of the labels, else null."""
        known = F.create_map(*[F.lit(x) for label in self.labels for x in (label, label)])
        return F.try_element_at(known, F.btrim(reply, F.lit(WHITESPACE))).cast("string")


def model_classifier(labels, predict=None, keywords=None, max_content_chars=None, skip_empty=False) -> ModelLabels:
    if predict is None:
        if keywords is None:
            raise ValueError("give `predict` or `keywords`")
        predict = keyword_predict(keywords)
    return ModelLabels(labels, predict, max_content_chars, skip_empty)


# ---------------------------------------------------------------- Python classifiers


def udf_classifier(fn: Callable[[bytes], str | None], max_content_bytes: int | None = None) -> Classifier:
    """A per-document Python function as a vectorised classifier.

    The function sees the content bytes (optionally only the first
    ``max_content_bytes``, cut before the data leaves the JVM). An exception
    gives no label for that row and its message is added to the row's
    ``errors``, so the pipeline's error policy sees it. Rows that do not
    need an answer reach the UDF as null and are never passed to ``fn``.
    """

    def run(raw):
        out = fn(bytes(raw))
        return None if out is None else str(out)

    call = attempt(run, "string")

    def classify(df: DataFrame, needed: Column) -> Column:
        content = F.col("content")
        if max_content_bytes is not None:
            content = F.substring(content, 1, max_content_bytes)
        return call(F.when(needed, content))

    classify.returns_outcome = True  # answers are <result, error> structs
    return classify


def column_classifier(expr: Callable[[DataFrame], Column]) -> Classifier:
    """U2 in native form: any Column expression over the document row."""
    return lambda df, needed: F.when(needed, expr(df)).cast("string")


# ---------------------------------------------------------------- chains


def classify_chain(df: DataFrame, classifiers: Sequence[Classifier], mode: str = "first") -> DataFrame:
    """Run a chain into ``doc_type``.

    ``first`` (router): an already-set ``doc_type`` is kept, else the first
    non-null answer wins and later classifiers only see rows still unlabelled.
    ``last`` (pipeline): every classifier runs; the last non-null answer
    wins over earlier ones and over the incoming label; null never erases.
    """
    if "doc_type" not in df.columns:
        df = df.withColumn("doc_type", null_label())
    df = df.withColumn("doc_type", F.col("doc_type").cast("string"))
    if mode not in ("first", "last"):
        raise ValueError("mode must be 'first' or 'last'")
    for i, clf in enumerate(classifiers):
        needed = F.col("doc_type").isNull() if mode == "first" else F.lit(True)
        answer = f"_label_{i}"
        before = set(df.columns)
        if hasattr(clf, "prepare"):
            df = clf.prepare(df, needed)
        df = df.withColumn(answer, clf(df, needed))
        label = F.col(answer)
        if returns_outcome(clf):  # <result, error> from a Python classifier or model client
            label = F.col(f"{answer}.result")
            if hasattr(clf, "label_of"):
                label = clf.label_of(label)
            errors = F.col("errors") if "errors" in df.columns else F.array().cast("array<string>")
            df = df.withColumn("errors", add_errors(errors, F.col(f"{answer}.error")))
        pick = [F.col("doc_type"), label] if mode == "first" else [label, F.col("doc_type")]
        df = df.withColumn("doc_type", F.coalesce(*pick))
        df = df.drop(*[c for c in df.columns if c not in before and c != "doc_type"])
    return df

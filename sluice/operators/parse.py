"""P1/P2 parsers and user parsers.

A *parser* is a callable ``df -> df`` that sets the struct column
``extracted`` (and may append to ``errors``). Native parsers are single
projections; Python parsers go through ``attempt`` so a failure stays on
its row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.html import DOCUMENT_TYPE, document_struct
from sluice.functions.text import decode_bytes
from sluice.operators.errors import attempt, capture
from sluice.sources.documents import add_errors

Parser = Callable[[DataFrame], DataFrame]


def text_columns(content, encoding: str = "utf-8"):
    text = F.coalesce(decode_bytes(content, encoding), F.lit(""))
    return text, F.length(text)


def text_parser(encoding: str = "utf-8") -> Parser:
    """``{text, length}``; invalid bytes dropped; null/empty content → ``''``, 0."""

    def parse(df: DataFrame) -> DataFrame:
        text, length = text_columns(F.col("content"), encoding)
        return df.withColumn("extracted", F.struct(text.alias("text"), length.cast("int").alias("length")))

    return parse


def parse_text(df: DataFrame, encoding: str = "utf-8") -> DataFrame:
    return text_parser(encoding)(df)


BinaryParser = Callable[[bytes], dict[str, Any]]


def _has_content(content):
    return F.coalesce(F.octet_length(content) > 0, F.lit(False))


def _is_binary(content):
    return _has_content(content) & ~F.is_valid_utf8(content.cast("string"))


def document_parser(binary_parser: BinaryParser | None = None) -> Parser:
    """``extracted = {parsed_document}``; null for empty content (the reference returns ``{}``)."""

    def parse(df: DataFrame) -> DataFrame:
        parsed = F.col("parsed_document")
        return (parse_document(df, binary_parser)
                .withColumn("extracted", F.when(parsed.isNotNull(), F.struct(parsed))).drop("parsed_document"))

    return parse


def parse_document(df: DataFrame, binary_parser: BinaryParser | None = None) -> DataFrame:
    """``parsed_document = struct<document: struct<text, title, elements>>``; empty content → null.

    HTML goes through one pass of a tag tokenizer in Arrow batches (``functions.html``), text without ``<`` stays
    in the JVM. With ``binary_parser`` (a Python
    function for PDF, images...), content that is not valid UTF-8 goes to it
    instead, other rows reach it as null; a failure leaves ``document`` null
    and its message in ``errors``.
    """
    content = F.col("content")
    document = document_struct(decode_bytes(content))
    if binary_parser is not None:
        call = attempt(lambda raw: binary_parser(bytes(raw)), DOCUMENT_TYPE)
        df = df.withColumn("_binary", call(F.when(_is_binary(content), content)))
        df = df.withColumn("errors", add_errors(F.col("errors"), F.col("_binary.error")))
        document = F.when(_is_binary(content), F.col("_binary.result")).otherwise(document)
    return df.withColumn("parsed_document",
                         F.when(_has_content(content), F.struct(document.alias("document")))).drop("_binary")


def checked_parser(parser: Parser, refuse: Callable[[], Column], message: str) -> Parser:
    """``parser`` with a native check on its result: rows that ``refuse`` marks get ``message`` and no ``extracted``."""

    def parse(df: DataFrame) -> DataFrame:
        df = parser(df).withColumn("_refused", F.coalesce(refuse(), F.lit(False)))
        return (df.withColumn("errors", add_errors(F.col("errors"), F.when(F.col("_refused"), F.lit(message))))
                  .withColumn("extracted", F.when(~F.col("_refused"), F.col("extracted"))).drop("_refused"))

    return parse


def udf_parser(fn: Callable[[bytes], dict[str, Any]], schema: T.StructType | str,
               max_content_bytes: int | None = None) -> Parser:
    """A per-document Python function returning a dict of fields.

    The result is typed by ``schema``; an exception is recorded in
    ``errors`` and leaves ``extracted`` null. Null content is not passed
    to ``fn`` and gives null.
    """
    call = attempt(lambda raw: fn(bytes(raw)), schema)

    def parse(df: DataFrame) -> DataFrame:
        content = F.col("content")
        if max_content_bytes is not None:
            content = F.substring(content, 1, max_content_bytes)
        return capture(df.withColumn("_outcome", call(content)), "_outcome", "extracted")

    return parse

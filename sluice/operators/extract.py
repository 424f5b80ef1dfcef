"""Field specs, extraction prompts, typed field extraction.

The "model" is pluggable: ``predict`` maps a request struct
``<prompt, text, filename, schema, instructions>`` to a JSON object string. The default is a
native per-field regex extractor, so extraction stays in the JVM and
can be checked against SQL; a real model is a pandas UDF with the same
shape. The reply is parsed with ``from_json`` against the schema built
from the field spec; a missing or unparsable reply is a row error (P7).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.text import char_prefix, decode_utf8, filename_of
from sluice.operators.models import returns_outcome
from sluice.sources.documents import add_errors

# The tool instruction and prompt head of the direct form, the prompt head of the hosted form.
DEFAULT_INSTRUCTIONS = "Extract the requested fields from the document. Leave a field null if absent."
DIRECT_PREFIX = "Filename: {filename}\n\n"
HOSTED_PREFIX = "Extract fields per this JSON schema:\n{schema}\n\nDocument:\n"
CORRUPT = "_corrupt_record"
NO_REPLY = "extraction: model response did not include the expected structured output"

# JSON-Schema type word → Spark type.
JSON_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
    "array": T.ArrayType(T.StringType()),
    "object": T.MapType(T.StringType(), T.StringType()),
}


def spark_type(node: Mapping[str, Any]) -> T.DataType:
    kind = node.get("type", "string")
    if kind == "object" and "properties" in node:
        return T.StructType([T.StructField(k, spark_type(v)) for k, v in node["properties"].items()])
    if kind == "array" and "items" in node:
        return T.ArrayType(spark_type(node["items"]))
    if kind not in JSON_TYPES:
        raise ValueError(f"unsupported field type {kind!r}")
    return JSON_TYPES[kind]


def struct_of(fields: Sequence[Mapping[str, Any]]) -> T.StructType:
    """The struct a field list describes: an optional field is nullable; word and description are its metadata."""
    return T.StructType([
        T.StructField(f["name"], spark_type({"type": f.get("type", "string")}), nullable=not f.get("required", True),
                      metadata={"word": f.get("type", "string"), "comment": f.get("description", "")})
        for f in fields])


def json_schema_of(fields: Sequence[Mapping[str, Any]] | None = None,
                   json_schema: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """The JSON Schema the model is told about, read off the struct; a given ``json_schema`` is taken as it is."""
    if json_schema is not None:
        return dict(json_schema)
    struct = struct_of(fields or ())
    if not struct.fields:
        raise ValueError("describe what to extract with `fields` or `json_schema`")
    return {
        "type": "object",
        "properties": {c.name: {"type": c.metadata["word"], "description": c.metadata["comment"]} for c in struct},
        "required": [c.name for c in struct if not c.nullable],
    }


def schema_from_fields(fields=None, json_schema=None) -> tuple[T.StructType, str]:
    """(Spark schema of the extracted struct, JSON text of the schema)."""
    spec = json_schema_of(fields, json_schema)
    struct = spark_type({**spec, "type": "object"})
    assert isinstance(struct, T.StructType)
    return struct, json.dumps(spec)


def hosted_prompt(schema_json: str, text: Column, max_chars: int | None = None) -> Column:
    """P4, hosted form: schema then the parsed text (cut to ``max_chars``; ``None`` = whole); null → ``''``."""
    return F.concat(F.lit(HOSTED_PREFIX.format(schema=schema_json)),
                    F.coalesce(char_prefix(text, max_chars), F.lit("")))


def direct_prompt(filename: Column, text: Column, max_chars: int | None = None) -> Column:
    """P4, direct form: ``Filename: f`` then the text (cut to ``max_chars``; ``None`` = whole)."""
    head, tail = DIRECT_PREFIX.split("{filename}")
    return F.concat(F.lit(head), filename, F.lit(tail), F.coalesce(char_prefix(text, max_chars), F.lit("")))


def regex_predict(fields: Sequence[Mapping[str, Any]]) -> Callable[[Column], Column]:
    """Default model: each field has a ``pattern``; first match (or all
    matches for ``array``) is the value, as a JSON object reply. A field may
    name a literal every match ``contains``: texts without it are not searched."""

    def predict(request: Column) -> Column:
        text = request["text"]
        parts = []
        for f in fields:
            pattern = f.get("pattern")
            if pattern is None:
                value = F.lit(None).cast("string")
            elif f.get("type", "string") == "array":
                found = F.regexp_extract_all(text, F.lit(pattern), 0)
                value = F.when(F.size(found) > 0, found)
            else:
                value = F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))
            if f.get("contains") and pattern is not None:
                value = F.when(F.contains(text, F.lit(f["contains"])), value)
            parts.append(value.alias(f["name"]))
        return F.when(request.isNotNull(), F.to_json(F.struct(*parts)))

    return predict


def parse_reply(reply: Column, schema: T.StructType) -> Column:
    """Reply JSON → ``struct<fields..., _corrupt_record>``. Bad JSON or a type
    mismatch keeps the raw text in ``_corrupt_record`` and nulls the fields."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(reply, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def extract_fields(df: DataFrame, fields=None, json_schema=None,
                   predict: Callable[[Column], Column] | None = None,
                   max_content_chars: int | None = None, prompt: str = "hosted",
                   text: Column | None = None, expand: bool = False, ask: Column | None = None,
                   instructions: str = DEFAULT_INSTRUCTIONS) -> DataFrame:
    """Typed ``extracted`` struct from a model reply.

    Text comes from ``parsed_document.document.text`` when the frame has it,
    else from the decoded content. A null or corrupt reply leaves
    ``extracted`` null and records an error on the row (the client's own
    message when the call failed). Rows where ``ask`` is false are not sent
    to the model and get neither fields nor an error.
    """
    schema, schema_json = schema_from_fields(fields, json_schema)
    if predict is None:
        predict = regex_predict(fields or [])
    if text is None:
        text = (F.col("parsed_document.document.text") if "parsed_document" in df.columns
                else decode_utf8(F.col("content")))
    text = F.coalesce(text, F.lit(""))
    filename = filename_of(F.col("uri"))
    prompt_col = (hosted_prompt(schema_json, text, max_content_chars) if prompt == "hosted"
                  else direct_prompt(filename, text, max_content_chars))
    ask = F.lit(True) if ask is None else F.coalesce(ask, F.lit(False))
    request = F.when(ask, F.struct(prompt_col.alias("prompt"), char_prefix(text, max_content_chars).alias("text"),
                                   filename.alias("filename"), F.lit(schema_json).alias("schema"),
                                   F.lit(instructions).alias("instructions")))
    out, failure = df.withColumn("_ask", ask), F.lit(None).cast("string")
    if returns_outcome(predict):
        out = out.withColumn("_outcome", predict(request)).withColumn("_reply", F.col("_outcome.result"))
        failure = F.col("_outcome.error")
    else:
        out = out.withColumn("_reply", predict(request))
    parsed = parse_reply(F.col("_reply"), schema)
    bad = F.col("_ask") & (F.col("_reply").isNull() | parsed[CORRUPT].isNotNull())
    out = (out.withColumn("_parsed", parsed)
              .withColumn("errors", add_errors(F.col("errors"), F.when(bad, F.coalesce(failure, F.lit(NO_REPLY)))))
              .withColumn("extracted", F.when(F.col("_ask") & ~bad, F.struct(*[F.col("_parsed")[f.name].alias(f.name)
                                                                              for f in schema.fields])))
              .drop("_ask", "_outcome", "_reply", "_parsed"))
    if expand:
        out = out.select("*", *[F.col("extracted")[f.name].alias(f.name) for f in schema.fields])
    return out


def extract_map(fn: Callable[[bytes], Mapping[str, Any]]):
    """A Python extractor as ``map<string,string>``; every value is
    stringified and an exception becomes ``{"_error": message}``."""

    def run(raw):
        if raw is None:
            return None
        try:
            return {str(k): None if v is None else str(v) for k, v in fn(bytes(raw)).items()}
        except Exception as exc:  # noqa: BLE001 - captured per row by design
            return {"_error": str(exc)}

    @F.pandas_udf("map<string,string>")
    def call(content: pd.Series) -> pd.Series:
        return content.map(run)

    return call


def document_fields_parser(fields=None, json_schema=None, predict: Callable[[Column], Column] | None = None,
                           max_content_chars: int | None = None, binary_parser=None):
    """P2 + P5 as one parser: ``extracted = {parsed_document, <fields>...}``.

    Without fields or a schema only the parsed document is kept. Empty
    content gives null ``extracted`` and is not sent to the model.
    """
    from sluice.operators.parse import parse_document

    def parse(df: DataFrame) -> DataFrame:
        df = parse_document(df, binary_parser)
        parsed = F.col("parsed_document")
        if not fields and not json_schema:
            return df.withColumn("extracted", F.when(parsed.isNotNull(), F.struct(parsed.alias("parsed_document")))) \
                     .drop("parsed_document")
        schema, _ = schema_from_fields(fields, json_schema)
        df = extract_fields(df, fields, json_schema, predict, max_content_chars, ask=parsed.isNotNull())
        merged = F.struct(parsed.alias("parsed_document"), *[F.col("extracted")[f.name].alias(f.name)
                                                             for f in schema.fields])
        return df.withColumn("extracted", F.when(parsed.isNotNull(), merged)).drop("parsed_document")

    return parse

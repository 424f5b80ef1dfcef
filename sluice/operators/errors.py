"""Per-row error capture and the per-pipeline error policy.

A failing document carries its messages in ``errors`` (empty = ok) and
keeps flowing; the policy then decides where it goes. Nothing here stops
the job except ``on_error="fail"``, which raises from a filter inside the
written plan so no partial output for the batch is committed.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.documents import add_errors

POLICIES = ("skip", "dead_letter", "fail")


def failed(errors: Column | None = None) -> Column:
    errors = F.col("errors") if errors is None else errors
    return F.size(errors) > 0


def attempt(fn: Callable[..., Any], result_type: T.DataType | str, n_args: int = 1):
    """Wrap a per-row Python function as a vectorised UDF returning
    ``struct<result, error>``; an exception becomes the error text of that
    row only. Null first input gives a null struct without calling ``fn``.

    The UDF is marked non-deterministic so Catalyst evaluates it once even
    when both fields are projected (a deterministic struct UDF would be
    planned twice: once for the filter on ``error``, once for ``result``).
    """
    if isinstance(result_type, str):
        result_type = T._parse_datatype_string(result_type)
    out_type = T.StructType([T.StructField("result", result_type), T.StructField("error", T.StringType())])

    def run_one(*args):
        if args[0] is None or (pd.api.types.is_scalar(args[0]) and pd.isna(args[0])):  # a null number arrives as NaN
            return None
        try:
            return {"result": fn(*args), "error": None}
        except Exception as exc:  # noqa: BLE001 - captured per row by design
            return {"result": None, "error": str(exc) or type(exc).__name__}

    @F.pandas_udf(out_type)
    def call(*cols: pd.Series) -> pd.DataFrame:
        rows = [run_one(*vals) for vals in zip(*cols)]
        results = [None if r is None else r["result"] for r in rows]
        errors = [None if r is None else r["error"] for r in rows]
        return pd.DataFrame({"result": results, "error": errors})

    return call.asNondeterministic()


def capture(df: DataFrame, outcome: str, into: str) -> DataFrame:
    """Split an ``attempt`` struct column into ``into`` and ``errors``."""
    return (df.withColumn(into, F.col(f"{outcome}.result"))
              .withColumn("errors", add_errors(F.col("errors"), F.col(f"{outcome}.error")))
              .drop(outcome))


def apply_policy(df: DataFrame, policy: str, dead_letter: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(rows for the main sinks, rows for the dead-letter sink or None).

    ``skip``: failed rows are dropped from the main output (counted in
    stats). ``dead_letter``: failed rows go to the dead-letter output.
    ``fail``: the first failed row raises its first error.
    """
    if policy not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}")
    if policy == "dead_letter" and not dead_letter:
        raise ValueError("on_error=dead_letter needs a dead-letter sink")
    if policy == "fail":
        # A filter, not a projected column: whatever a sink selects, the check runs.
        stop = F.raise_error(F.element_at(F.col("errors"), 1)).cast("boolean")
        return df.where(F.when(failed(), stop).otherwise(F.lit(True))), None
    good = df.where(~failed())
    bad = df.where(failed()) if policy == "dead_letter" else None
    return good, bad

"""Plugging a real model in: the ``predict`` callables of C7 and P5.

A model client is expensive to create and may fail per call. ``python_predict``
wraps a client factory as an iterator pandas UDF: the factory runs once per
task (not per row, not on the driver), each request field is sent as one
call, and a failing call gives that row an error text instead of a reply.
Rows the classifier did not ask about arrive as null requests and are never
sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Client = Callable[[str], Any]

OUTCOME = "result string, error string"


def _missing(value: Any) -> bool:
    return value is None or (isinstance(value, float) and value != value)


def returns_outcome(predict: Any) -> bool:
    """Whether a ``predict`` answers ``<result, error>`` structs (else plain replies)."""
    return bool(getattr(predict, "returns_outcome", False))


def python_predict(make_client: Callable[[], Client], field: str | None = "prompt",
                   concurrency: int = 1) -> Callable[[Column], Column]:
    """``predict`` for ``model_classifier`` (reply = label text) or for
    ``extract_fields`` (reply = JSON object text) backed by a Python client.

    The client receives the request's ``field`` (the prompt by default), or
    with ``field=None`` the whole request as a dict (prompt plus the system
    instruction, schema, filename... of the calling operator). Calls are
    network-bound, so ``concurrency > 1`` keeps that many requests of a task
    in flight at once (threads sharing the task's client); reply order is kept.

    The answer is ``struct<result, error>``: an exception becomes the error
    text of its row, which the operators add to ``errors``. The UDF is
    non-deterministic, so a filter behind it never makes Spark ask twice.
    """

    def values(requests: pd.DataFrame):
        if field is not None:
            return list(requests[field])
        first = requests.columns[0]
        return [None if _missing(row[first]) else row for row in requests.to_dict("records")]

    def ask(client: Client, value: Any) -> tuple[str | None, str | None]:
        if _missing(value):
            return None, None
        try:
            reply = client(value)
        except Exception as exc:  # noqa: BLE001 - a failed call is an error of this row
            return None, str(exc) or type(exc).__name__
        return (None if reply is None else str(reply)), None

    @F.pandas_udf(OUTCOME)
    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        try:
            for requests in batches:
                todo = values(requests)
                replies = (list(pool.map(lambda v: ask(client, v), todo)) if pool
                           else [ask(client, v) for v in todo])
                yield pd.DataFrame(replies, columns=["result", "error"], dtype=object)
        finally:
            if pool:
                pool.shutdown()

    once = call.asNondeterministic()

    def predict(request: Column) -> Column:
        return once(request)

    predict.returns_outcome = True
    return predict

"""Run statistics.

Counted as aggregate expressions, never by iterating rows: as a query
(``stats_frame``), attached to a write with ``Observation`` so the counts
come for free with the job that writes the output, or attached to a stream
(``observe_stream``) and gathered per micro-batch (``StreamCounts``).
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

STAT_KEYS = ("discovered", "received", "unrouted", "processed", "failed")


def stat_columns(routed: Column, failed: Column, via_router: bool = True) -> list[Column]:
    """``discovered``: documents the source emitted; ``received``: documents the
    router took in (the same rows in a router flow, none in a dedicated pipeline)."""
    return [
        F.count(F.lit(1)).alias("discovered"),
        (F.count(F.lit(1)) if via_router else F.lit(0).cast("long")).alias("received"),
        F.count_if(~routed).alias("unrouted"),
        F.count_if(routed & ~failed).alias("processed"),
        F.count_if(routed & failed).alias("failed"),
    ]


def stats_frame(outcomes: DataFrame, run_id: str = "", via_router: bool = True) -> DataFrame:
    """One row of counts over ``pipeline`` / ``errors`` of every discovered document."""
    routed = F.col("pipeline").isNotNull()
    failed = F.coalesce(F.size(F.col("errors")) > 0, F.lit(False))
    return outcomes.agg(*stat_columns(routed, failed, via_router)).withColumn("run_id", F.lit(run_id))


def observe_outcomes(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach counters to a frame that is about to be written."""
    obs = Observation(name)
    failed = F.coalesce(F.size(F.col("errors")) > 0, F.lit(False))
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("failed"))
    return observed, obs


def observe_stream(stream: DataFrame, name: str) -> DataFrame:
    """Attach counters to a stream of documents; every micro-batch reports them under ``name``."""
    failed = F.coalesce(F.size(F.col("errors")) > 0, F.lit(False))
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("failed"))


class StreamCounts(StreamingQueryListener):
    """Counts of observed streams, one entry per micro-batch as it is committed.

    Register with ``spark.streams.addListener`` before the streams start. A micro-batch counts once, however
    often it was tried: only its commit is reported. What is held per observed name is its totals and, per
    query, the last micro-batch counted; ``on_batch(name, batch_id, rows, failed)`` receives each micro-batch,
    to be written wherever it shall be kept.
    """

    def __init__(self, on_batch: Callable[[str, int, int, int], None] | None = None) -> None:
        self._on_batch = on_batch
        self._totals: dict[str, list[int]] = {}
        self._last: dict[tuple[str, str], int] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, counts in progress.observedMetrics.items():
            fields = counts.asDict()
            if "rows" in fields and "failed" in fields:
                self._count(str(progress.id), name, progress.batchId, int(fields["rows"]), int(fields["failed"]))

    def _count(self, query: str, name: str, batch_id: int, rows: int, failed: int) -> None:
        with self._changed:
            if self._last.get((query, name), -1) >= batch_id:
                return
            self._last[query, name] = batch_id
            total = self._totals.setdefault(name, [0, 0])
            total[0] += rows
            total[1] += failed
        if self._on_batch is not None:
            self._on_batch(name, batch_id, rows, failed)

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until ``query`` has ended and all it reported is counted (reports come after the query's own end)."""
        query.awaitTermination()
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"the end of {query.runId} was not reported within {seconds} s")

    def totals(self, name: str, run_id: str = "") -> dict:
        """Run statistics of one observed stream, as ``write_flow`` gives them; a plain stream routes nothing."""
        with self._changed:
            rows, failed = self._totals.get(name, (0, 0))
        return {"discovered": rows, "received": 0, "unrouted": 0, "processed": rows - failed, "failed": failed, "run_id": run_id}


def stats_json(stats: dict, run_id: str) -> str:
    return json.dumps({"run_id": run_id, **{k: int(stats.get(k, 0)) for k in STAT_KEYS}})

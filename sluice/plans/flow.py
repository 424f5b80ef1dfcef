"""Whole flows built from the operators.

``run_router`` is lazy: it returns frames, and ``write_flow`` runs them.
All routed pipelines share one read of the source and one classified,
routed frame; each pipeline is a filter of it followed by its own
classify/parse stage and error policy. Nothing shuffles except what a
caller's sinks ask for.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators.classify import Classifier, classify_chain
from sluice.operators.errors import apply_policy
from sluice.operators.parse import Parser
from sluice.operators.route import RouteTable, fan_out, route, split_unrouted
from sluice.operators.stats import observe_outcomes, stats_frame
from sluice.session import fresh_path, work_root
from sluice.sinks.writers import Sink, parts_of, shared_rows, table_rows, write_table, write_targets


@dataclass
class PipelineSpec:
    name: str
    parser: Parser | None = None
    classifiers: Sequence[Classifier] = ()
    sinks: Sequence[Sink] = ()
    on_error: str = "skip"
    dead_letter: Sink | None = None
    source: Callable[[SparkSession], DataFrame] | None = None

    def __post_init__(self) -> None:
        if self.on_error == "dead_letter" and self.dead_letter is None:
            raise ValueError(f"pipeline {self.name!r}: on_error=dead_letter needs a dead_letter sink")
        if self.on_error not in ("skip", "dead_letter", "fail"):
            raise ValueError(f"pipeline {self.name!r}: unknown on_error {self.on_error!r}")


@dataclass
class RouterSpec:
    routes: RouteTable
    pipelines: Mapping[str, PipelineSpec]
    classifiers: Sequence[Classifier] = ()
    strict: bool = False

    def __post_init__(self) -> None:
        missing = [p for p in self.routes.pipelines() if p not in self.pipelines]
        if missing:
            raise ValueError(f"routes name unknown pipelines: {missing}")


@dataclass
class FlowResult:
    routed: DataFrame
    processed: dict[str, DataFrame] = field(default_factory=dict)
    outputs: dict[str, DataFrame] = field(default_factory=dict)
    dead_letter: dict[str, DataFrame] = field(default_factory=dict)
    routing: Observation | None = None
    outcomes_seen: dict[str, Observation] = field(default_factory=dict)
    via_router: bool = True

    @property
    def unrouted(self) -> DataFrame:
        return split_unrouted(self.routed)[1]

    def outcomes(self) -> DataFrame:
        """``uri, pipeline, errors`` for every received document (for stats)."""
        cols = ["uri", "pipeline", "errors"]
        parts = [self.unrouted.select(*cols)] + [p.select(*cols) for p in self.processed.values()]
        return reduce(DataFrame.unionByName, parts)

    def stats(self, run_id: str = "") -> DataFrame:
        return stats_frame(self.outcomes(), run_id, self.via_router)

    def close(self) -> None:
        """Release the shared routed frame (when it was persisted)."""
        self.routed.unpersist()


def process(docs: DataFrame, spec: PipelineSpec) -> DataFrame:
    """One pipeline's stage: its own chain (last answer wins), then its parser."""
    df = docs
    if spec.classifiers:
        df = classify_chain(df, spec.classifiers, mode="last")
    if spec.parser is not None:
        df = spec.parser(df)
    elif "extracted" not in df.columns:
        df = df.withColumn("extracted", F.lit(None).cast("map<string,string>"))
    return df


def materialize(df: DataFrame, how: str | None) -> DataFrame:
    """Share a frame between several consumers.

    ``persist``: cached on the executors (memory, spilling to local disk),
    recomputed from lineage if an executor is lost. ``checkpoint``: written
    to ``spark.checkpoint.dir``; use it when the stage calls an expensive
    model that must not run twice. ``table``: written once to the shared
    folder partitioned by ``pipeline``, so each pipeline reads only its own
    partition (pruned at the scan) and nothing is recomputed.
    """
    if how == "persist":
        return df.persist()
    if how == "checkpoint":
        work_root(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "table":
        path = fresh_path(df.sparkSession, "routed")
        df.write.partitionBy("pipeline").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if how is not None:
        raise ValueError(f"unknown share mode {how!r}")
    return df


def run_router(source: DataFrame, spec: RouterSpec, share: str | None = "auto") -> FlowResult:
    """chain (first answer wins) → route → per-pipeline process → policy.

    Every pipeline is a filter of the same routed frame; Catalyst does not
    reuse it across branches, so with more than one pipeline it is
    materialised once (``share="auto"`` → ``table``) and the source is
    read, decoded and classified a single time. ``share=None`` leaves the
    plan as is; ``"checkpoint"`` / ``"table"`` write it to the shared
    folder (see ``materialize``).
    """
    classified = classify_chain(source, spec.classifiers, mode="first")
    if share == "auto":
        share = "table" if len(spec.routes.pipelines()) > 1 else None
    routing = Observation("routing")
    # Counted below the shared copy: the counts come with building it, and
    # pipeline filters on a written copy still reach its partitions.
    counted = route(classified, spec.routes, strict=spec.strict).observe(
        routing, F.count(F.lit(1)).alias("received"), F.count_if(F.col("pipeline").isNull()).alias("unrouted"))
    routed = materialize(counted, share)
    result = FlowResult(routed=routed, routing=routing)
    good_rows, _ = split_unrouted(routed)
    for name, docs in fan_out(good_rows, spec.routes.pipelines()).items():
        _attach(result, name, process(docs, spec.pipelines[name]), spec.pipelines[name])
    return result


def _attach(result: FlowResult, name: str, done: DataFrame, pipe: PipelineSpec) -> None:
    """Record a pipeline's processed frame, its counters and its policy split."""
    observed, obs = observe_outcomes(done, name)
    good, bad = apply_policy(observed, pipe.on_error, pipe.dead_letter is not None)
    result.processed[name] = observed
    result.outcomes_seen[name] = obs
    result.outputs[name] = good
    if bad is not None:
        result.dead_letter[name] = bad


def run_pipeline(spark: SparkSession, spec: PipelineSpec, source: DataFrame | None = None) -> FlowResult:
    """A dedicated pipeline with its own source, no routing filter."""
    if source is None:
        if spec.source is None:
            raise RuntimeError(f"pipeline {spec.name!r} has no source")
        source = spec.source(spark)
    docs = source.withColumn("pipeline", F.lit(spec.name))
    result = FlowResult(routed=docs, via_router=False)
    _attach(result, spec.name, process(docs, spec), spec)
    return result


def write_flow(result: FlowResult, pipelines: Mapping[str, PipelineSpec], batch_id: int | None = None,
               run_id: str = "") -> dict:
    """Run every sink; returns the run statistics as a dict.

    What several pipelines bring to one target is written in one job, so an
    overwriting target is replaced once per run and a micro-batch's part of a
    target is committed whole or not at all.
    Counts come from observations attached to the written frames, so no
    extra pass runs the classifiers or parsers again. A pipeline whose
    output feeds more than one sink is written to the shared folder while they
    write (``shared_rows``), so a parser (or a model call) runs once per document.
    """
    work = []
    try:
        with ExitStack() as copies:
            for name, done in result.processed.items():
                pipe = pipelines[name]
                sinks, good, bad = parts_of(pipe.sinks), result.outputs[name], result.dead_letter.get(name)
                dead = parts_of([pipe.dead_letter]) if pipe.dead_letter is not None and bad is not None else []
                if len(sinks) + len(dead) > 1:
                    rows = copies.enter_context(shared_rows(done, [*sinks, *dead]))
                    good, bad = apply_policy(rows, pipe.on_error, pipe.dead_letter is not None)
                elif not sinks and not dead:
                    done.write.format("noop").mode("overwrite").save()
                work += [(sink, good) for sink in sinks] + [(sink, bad) for sink in dead]
            write_targets(work, batch_id)
            if not result.processed and result.routing is not None:
                result.routed.write.format("noop").mode("overwrite").save()  # nothing routed: still count
            return _collect_stats(result, run_id)
    finally:
        result.close()


def _collect_stats(result: FlowResult, run_id: str) -> dict:
    outcomes = [obs.get for obs in result.outcomes_seen.values()]
    processed = sum(int(o.get("rows", 0)) - int(o.get("failed", 0)) for o in outcomes)
    failed = sum(int(o.get("failed", 0)) for o in outcomes)
    if result.routing is not None:
        routing = result.routing.get
        discovered, unrouted = int(routing["received"]), int(routing["unrouted"])
    else:
        discovered, unrouted = processed + failed, 0
    received = discovered if result.via_router else 0
    return {"discovered": discovered, "received": received, "unrouted": unrouted, "processed": processed,
            "failed": failed, "run_id": run_id}


def write_routed_table(result: FlowResult, path: str, run_id: str = "", mode: str = "append",
                       batch_id: int | None = None) -> None:
    """R4's physical form: every pipeline's output as table rows in one job,
    partitioned by ``pipeline_name``. The union reads the shared routed copy;
    each task writes its own files per pipeline, so nothing is shuffled and a
    large pipeline is spread over all tasks."""
    rows = [table_rows(df, name, run_id) for name, df in result.outputs.items()]
    if rows:
        write_table(reduce(DataFrame.unionByName, rows), path, mode=mode, batch_id=batch_id,
                    partition_by=["pipeline_name"])


def gold_frame(classified: DataFrame, spec: RouterSpec, name: str) -> DataFrame:
    """One gold table: the pipeline's documents, parsed, ``extracted`` fields expanded to columns
    (named ``extracted_<field>`` where the document has a column of that name)."""
    routed = classified if "pipeline" in classified.columns else route(classified, spec.routes)
    gold = process(routed.where(F.col("pipeline") == F.lit(name)), spec.pipelines[name])
    kind = gold.schema["extracted"].dataType
    if hasattr(kind, "fieldNames"):
        gold = gold.select("*", *[F.col("extracted")[f].alias(f"extracted_{f}" if f in gold.columns else f)
                                  for f in kind.fieldNames()])
    return gold


def build_tables(source: DataFrame, spec: RouterSpec) -> dict[str, DataFrame]:
    """F3 (lazy form): ``bronze`` (the source), ``classified`` (bronze +
    ``doc_type``) and one gold frame per routed pipeline."""
    classified = classify_chain(source, spec.classifiers, mode="first")
    tables: dict[str, DataFrame] = {"bronze": source, "classified": classified}
    for name in spec.routes.pipelines():
        tables[name] = gold_frame(classified, spec, name)
    return tables


def write_tables(source: DataFrame, spec: RouterSpec, root: str, fmt: str = "parquet") -> dict[str, str]:
    """F3 materialised: each stage is written, and the next stage reads the
    table just written (bronze → classified → gold), so the source is read
    once and classification runs once. The classified table is partitioned by
    ``pipeline``: each gold table scans its own partition only; binary content
    is left out of gold."""
    spark = source.sparkSession
    paths = {name: f"{root.rstrip('/')}/{name}" for name in ["bronze", "classified", *spec.routes.pipelines()]}
    source.write.format(fmt).mode("overwrite").save(paths["bronze"])
    bronze = spark.read.format(fmt).load(paths["bronze"])
    routed = route(classify_chain(bronze, spec.classifiers, mode="first"), spec.routes)
    routed.write.format(fmt).mode("overwrite").partitionBy("pipeline").save(paths["classified"])
    classified = spark.read.format(fmt).schema(routed.schema).load(paths["classified"])
    for name in spec.routes.pipelines():
        gold_frame(classified, spec, name).drop("content").write.format(fmt).mode("overwrite").save(paths[name])
    return paths

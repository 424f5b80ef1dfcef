"""Resolve a pipeline per document, split unrouted rows, fan out.

Routes are configuration, not data: a handful of ``(doc_type, pipeline)``
pairs become a literal map inside the projection, so routing is a
row-local expression with no join and no shuffle. A route table that is
itself data (thousands of labels) is joined instead; see ``route_by_table``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WILDCARD = "*"

# What a strict routing failure says, around the document's uri and label.
UNROUTABLE = ("strict routing: no route takes ", " for doc_type=", "")


@dataclass(frozen=True)
class Route:
    doc_type: str
    pipeline: str


def as_routes(routes: Sequence[Route | Mapping[str, str] | tuple[str, str]]) -> list[Route]:
    out = []
    for r in routes:
        if isinstance(r, Route):
            out.append(r)
        elif isinstance(r, Mapping):
            out.append(Route(str(r["doc_type"]), str(r["pipeline"])))
        else:
            out.append(Route(str(r[0]), str(r[1])))
    return out


@dataclass
class RouteTable:
    routes: list[Route] = field(default_factory=list)
    default_pipeline: str | None = None

    def __post_init__(self) -> None:
        self.routes = as_routes(self.routes)

    def exact(self) -> dict[str, str]:
        """First route per label wins; the wildcard is not a label."""
        table: dict[str, str] = {}
        for r in self.routes:
            if r.doc_type != WILDCARD and r.doc_type not in table:
                table[r.doc_type] = r.pipeline
        return table

    def fallback(self) -> str | None:
        """First wildcard route, else the default pipeline."""
        for r in self.routes:
            if r.doc_type == WILDCARD:
                return r.pipeline
        return self.default_pipeline

    def pipelines(self) -> list[str]:
        names = [r.pipeline for r in self.routes]
        if self.default_pipeline:
            names.append(self.default_pipeline)
        return list(dict.fromkeys(names))

    def resolve(self, doc_type: Column) -> Column:
        """Exact label → first ``*`` route → default → null."""
        exact = self.exact()
        fallback = F.lit(self.fallback()).cast("string")
        if not exact:
            return fallback
        pairs = []
        for label, pipeline in exact.items():
            pairs += [F.lit(label), F.lit(pipeline)]
        hit = F.when(doc_type.isNotNull(), F.try_element_at(F.create_map(*pairs), doc_type))
        return F.coalesce(hit, fallback)


#: Routes that may be broadcast (some megabytes).
BROADCAST_LABELS = 50_000


def route(df: DataFrame, table: RouteTable, strict: bool = False, column: str = "pipeline") -> DataFrame:
    """Add the ``pipeline`` column. ``strict`` fails the job on the
    first document no route can take, naming its uri and doc_type."""
    target = table.resolve(F.col("doc_type"))
    if strict:
        message = F.concat(F.lit(UNROUTABLE[0]), F.col("uri"), F.lit(UNROUTABLE[1]),
                           F.coalesce(F.col("doc_type"), F.lit("None")), F.lit(UNROUTABLE[2]))
        target = F.when(target.isNull(), F.raise_error(message).cast("string")).otherwise(target)
        # As a filter the check runs even if a later projection drops the column.
        return df.withColumn(column, target).where(F.col(column).isNotNull())
    return df.withColumn(column, target)


def route_by_table(df: DataFrame, routes: DataFrame, default: str | None = None, column: str = "pipeline") -> DataFrame:
    """R1 for a route table that is data. First route per label wins
    (``routes`` carries an ``ordinal``).

    Documents stay where they are: up to ``BROADCAST_LABELS`` routes are
    counted and broadcast; of more, only those whose label some document has,
    found from the labels alone. Only if these are too many as well are whole
    rows joined by label: adaptive execution then splits a hot label, and
    documents without one get keys of their own (no label starts with the
    control character), so they spread too.
    """
    ordered = routes.select("doc_type", "pipeline", "ordinal")
    exact = (ordered.where(F.col("doc_type") != WILDCARD).groupBy(F.col("doc_type").alias("_label"))
             .agg(F.min_by("pipeline", "ordinal").alias("_exact")))
    wild = ordered.where(F.col("doc_type") == WILDCARD).orderBy("ordinal").select("pipeline").limit(1).collect()
    fallback = F.lit(wild[0][0] if wild else default).cast("string")

    def few(side: DataFrame) -> bool:
        return side.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS

    if not few(exact):
        exact = exact.join(df.select(F.col("doc_type").alias("_label")).distinct(), "_label", "left_semi")
    if few(exact):
        joined = df.join(F.broadcast(exact), F.col("doc_type") == F.col("_label"), "left")
    else:
        keyed = df.withColumn("_key", F.coalesce(F.col("doc_type"), F.concat(F.lit("\x00"), F.col("uri"))))
        joined = keyed.join(exact, F.col("_key") == F.col("_label"), "left").drop("_key")
    return joined.withColumn(column, F.coalesce(F.col("_exact"), fallback)).drop("_label", "_exact")


def split_unrouted(df: DataFrame, column: str = "pipeline") -> tuple[DataFrame, DataFrame]:
    """R2: (routed, unrouted) halves of a routed frame."""
    return df.where(F.col(column).isNotNull()), df.where(F.col(column).isNull())


def fan_out(df: DataFrame, pipelines: Sequence[str], column: str = "pipeline") -> dict[str, DataFrame]:
    """One filtered frame per pipeline; each sees only its own documents.

    Callers that run several of them should persist ``df`` first so the
    source is read and classified once for all pipelines.
    """
    return {name: df.where(F.col(column) == F.lit(name)) for name in dict.fromkeys(pipelines)}

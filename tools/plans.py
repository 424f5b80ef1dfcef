"""Write docs/PLANS.md: the physical operator tree of every registered query."""

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")
from sluice.plans.catalog import queries  # noqa: E402
from sluice.session import build_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
out = ["# Physical plans", "",
       f"Operator trees from `explain(\"formatted\")` of each registered query over `{sf_dir}`",
       "(generated by `tools/plans.py`; node details omitted). Queries that write a sink or run a stream",
       "show the plan of reading their output back; the write plans are covered by the flow tests.", "",
       "Distinct nodes per plan (a shared subtree shown under several branches counts once). On these",
       "single-file test tables one `Exchange` is the `spread()` round-robin, which a many-file input skips.", "",
       "| query | Exchange | scans | ArrowEvalPython |", "|---|---|---|---|"]
summary, sections = [], []
NOTES = {
    "router_batch": "One scan; the round-robin `spread` exchange; the routed frame is an `InMemoryRelation` built "
                    "once and read by the three pipeline branches (its counters are the `CollectMetrics` inside); "
                    "partial `HashAggregate` before the only keyed exchange.",
    "route_fanout": "Three pipeline filters over one cached routed frame: one scan, not three.",
    "files_no_content": "`ReadSchema` has no `content`: the bytes are never read.",
    "landing_increment": "The watermark is a `PushedFilters` range on `ts` in the parquet scan.",
    "landing_watermark": "Partial `max`/`count` per task, one row per task to the final aggregate.",
    "files_incremental": "Anti join on the unique URI; the broadcast is chosen from measured sizes, not forced.",
    "model_classify": "No Python: the keyword model is `regexp_count` per label inside the projection.",
    "udf_classifier": "One `ArrowEvalPython`; rows a rule already labelled reach it as null.",
    "on_error_skip": "One `ArrowEvalPython` per pipeline (three), each over that pipeline's rows only.",
    "chain_first": "`labels` join on a unique id; the model runs only where the rules left no label.",
}
for name, fn in queries().items():
    df = fn(spark, sf_dir)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    tree = buf.getvalue().split("\n\n(1)")[0].replace("== Physical Plan ==\n", "").rstrip()
    tree = re.sub(r"\[plan_id=\d+\]", "", tree)
    def distinct(node):
        return len(set(re.findall(rf"{node} \((\d+)\)", tree)))

    exchanges, scans, python = distinct("Exchange"), distinct("Scan [a-zA-Z]+ ?"), distinct("ArrowEvalPython")
    summary.append(f"| `{name}` | {exchanges} | {scans} | {python} |")
    sections += [f"## `{name}`", ""] + ([NOTES[name], ""] if name in NOTES else []) + ["```", tree, "```", ""]
    spark.catalog.clearCache()
open("docs/PLANS.md", "w").write("\n".join(out + summary + [""] + sections))

"""The README usage example, end to end, with a fake model client."""

import json
import os
import tempfile

from sluice.operators.classify import model_classifier, rules_classifier
from sluice.operators.extract import extract_fields
from sluice.operators.models import python_predict
from sluice.operators.parse import text_parser
from sluice.operators.route import RouteTable
from sluice.plans.flow import PipelineSpec, RouterSpec, run_router, write_flow
from sluice.session import fresh_path
from sluice.sinks.writers import json_sink, table_sink
from sluice.sources.files import scan_files
from sluice.streaming.streams import run_router_stream, stream_files


def make_client():
    def reply(prompt):
        if prompt.startswith("Extract fields"):
            return json.dumps({"vendor_name": "Acme", "total_amount": 12.5})
        return "invoice" if "Total" in prompt else "unknown"

    return reply


def test_readme_example(spark):
    landing, shared = tempfile.mkdtemp(), tempfile.mkdtemp()
    files = {"Invoice_001.pdf": b"Invoice\\nTotal: 12.5", "MSA-contract.docx": b"Master agreement",
             "scan_7.pdf": b"Total due 40", "notes.txt": b"just notes"}
    for name, data in files.items():
        with open(os.path.join(landing, name), "wb") as f:
            f.write(data)
    rules = rules_classifier([
        {"doc_type": "invoice", "extensions": ["pdf"], "filename_regex": "(?i)invoice"},
        {"doc_type": "contract", "extensions": ["pdf", "docx"], "filename_regex": "(?i)(contract|agreement|msa)"},
    ])
    model = model_classifier({"invoice": "a bill", "contract": "a legal agreement"},
                             predict=python_predict(make_client))
    fields = [{"name": "vendor_name"}, {"name": "total_amount", "type": "number"}]
    pipelines = {
        "invoice_pipeline": PipelineSpec(
            "invoice_pipeline", parser=lambda df: extract_fields(df, fields, predict=python_predict(make_client)),
            sinks=[table_sink(f"{shared}/gold/invoices", run_id="r1")],
            on_error="dead_letter", dead_letter=json_sink(f"{shared}/dead_letter", "r1")),
        "contract_pipeline": PipelineSpec("contract_pipeline", parser=text_parser(),
                                          sinks=[json_sink(f"{shared}/gold/contracts", "r1")]),
        "unclassified_pipeline": PipelineSpec("unclassified_pipeline", parser=text_parser(),
                                              sinks=[json_sink(f"{shared}/gold/other", "r1")]),
    }
    spec = RouterSpec(RouteTable([("invoice", "invoice_pipeline"), ("contract", "contract_pipeline")],
                                 "unclassified_pipeline"), pipelines, classifiers=[rules, model])
    stats = write_flow(run_router(scan_files(spark, landing), spec), spec.pipelines, run_id="r1")
    assert stats["received"] == 4 and stats["processed"] == 4 and stats["failed"] == 0
    invoices = {r["uri"].rsplit("/", 1)[-1]: r for r in spark.read.parquet(f"{shared}/gold/invoices").collect()}
    assert set(invoices) == {"Invoice_001.pdf", "scan_7.pdf"}  # the second one labelled by the model
    assert json.loads(invoices["scan_7.pdf"]["extracted_json"]) == {"vendor_name": "Acme", "total_amount": 12.5}
    assert spark.read.json(f"{shared}/gold/contracts").count() == 1
    assert spark.read.json(f"{shared}/gold/other").count() == 1

    seen = []
    run_router_stream(stream_files(spark, landing, max_files_per_trigger=500), spec,
                      checkpoint=fresh_path(spark, "router"), on_stats=lambda b, s: seen.append(s)).awaitTermination()
    assert sum(s["received"] for s in seen) == 4


def test_a_local_session_without_a_shared_folder_gets_one(tmp_path):
    """In a process of its own, with no settings from files: the suite's session names a folder."""
    import subprocess
    import sys

    code = ("from pyspark.sql import SparkSession; from sluice.session import fresh_path, work_root\n"
            "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "assert work_root(s) == work_root(s); p = fresh_path(s, 'x'); s.range(3).write.parquet(p)\n"
            "assert s.read.parquet(p).count() == 3; s.range(2).checkpoint().count(); print('fine')")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": root, "SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True)
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.sources.documents import to_documents  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="sluice-tests-")
    spark = (
        SparkSession.builder.master("local[4]")
        .appName("sluice-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    spark.sparkContext.setCheckpointDir(ckpt)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture(autouse=True)
def _ship_test_functions_by_value(request):
    """Functions defined in a test module run inside UDFs; ship them by value."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(request.module)
    yield


@pytest.fixture
def docs(spark):
    """Build a document frame from ``(uri, content bytes|None, metadata dict|None)`` tuples."""
    from pyspark.sql import functions as F

    def make(rows, doc_type=None):
        data = [(u, bytearray(c) if c is not None else None, m or {}) for u, c, m in rows]
        df = spark.createDataFrame(data, "uri string, content binary, metadata map<string,string>")
        out = to_documents(df, metadata=F.col("metadata"))
        if doc_type is not None:
            out = out.withColumn("doc_type", F.lit(doc_type))
        return out

    return make


def labels_of(df, col="doc_type"):
    return {r["uri"]: r[col] for r in df.select("uri", col).collect()}


__all__ = ["labels_of", "SF001", "SF01"]

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="strata-tests-ckpt-")
    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", ckpt)
    yield spark


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="strata-test-")


def docs_frame(spark, texts, source="test"):
    """A document frame (source, object_key, document) from JSON texts."""
    rows = [(source, f"{source}/doc-{i}.json", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source string, object_key string, document string")

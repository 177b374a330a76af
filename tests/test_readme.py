"""The README's usage examples, run on local folders."""

import json

from pyspark.sql import functions as F

from strata.operators import quality
from strata.sinks.curated import write_curated
from strata.sinks.raw import write_raw
from strata.sources.raw import read_documents_text, read_raw_days
from strata.specs import get_spec


def test_readme_examples(spark, tmp_dir):
    docs = [(f"2026-04-{d:02d}", json.dumps({"records": [
        {"center_id": "EUR_MAD_001", "timestamp": f"2026-04-{d:02d}T{h:02d}:00:00",
         "visitors_count": h} for h in range(24)], "total_records": 24})) for d in (1, 2, 30)]
    write_raw(spark.createDataFrame(docs, "ingest_date string, document string"),
              f"{tmp_dir}/raw", "traffic", "document")
    spec = get_spec("traffic")
    raw = read_raw_days(spark, f"{tmp_dir}/raw", "traffic", spec.raw_schema,
                        "2026-04-01", "2026-04-30", allow_missing=True)
    write_curated(spec.curate(raw), path=f"{tmp_dir}/curated/traffic")
    assert spark.read.parquet(f"{tmp_dir}/curated/traffic").count() == 72
    texts = read_documents_text(spark, f"{tmp_dir}/raw/traffic").withColumn(
        "source", F.lit("traffic"))
    verdicts = quality.verdicts(texts, quality.standard_rules(), id_col="path")
    quality.assert_passed(verdicts)
    assert verdicts.count() == 3

"""The quality report under a condition: the plan stays as large as the report's own, and the rows agree."""

import pytest
from pyspark.sql import functions as F

from millrace.llm.quality import quality_report
from workloads.registry import table


@pytest.mark.parametrize("condition", ["kept", "not base_failed", "n_words > 20", "n_repeat_words = 0 and kept"])
def test_condition_on_the_report(spark, sf_dir, condition):
    report = quality_report(table(spark, sf_dir, "documents"))
    filtered = report.where(condition)
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(filtered) < 1.5 * size(report)
    whole = report.select("*", F.expr(condition).alias("wanted")).collect()
    assert sorted(r.doc_id for r in filtered.collect()) == sorted(r.doc_id for r in whole if r.wanted)

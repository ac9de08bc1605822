"""The quality classifier: held-out accuracy, and the edge cases."""

from pyspark.sql import functions as F

from millrace.llm import cotrain
from workloads.registry import table


def test_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = table(spark, folder, "labels")
    seen = labels.where("doc_id % 3 <> 0")
    got = cotrain.quality_scores(table(spark, folder, "documents"), seen).join(labels.where("doc_id % 3 = 0"), "doc_id")
    rows = got.collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.9 * len(rows)


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, None, None, None), (None, "", "en", None), (3, "x " * 50_000, "en", "s")],
        "doc_id long, text string, lang string, source string",
    ).withColumns({"score": F.lit(1), "id": F.lit(2), "label": F.lit(3)})
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0), labels.where("quality = 1")):
        got = cotrain.quality_scores(docs, some)
        assert got.where("score BETWEEN 0 AND 1").count() == 5
    assert cotrain.quality_scores(docs.limit(0), labels).count() == 0

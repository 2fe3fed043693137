import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, documents, empty, remainder

from tidewatt.llm import quality as op
from tidewatt.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    rows = op.quality_scores(table(spark, sf, "documents"), labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_columns_and_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 0), (None, 1, 0), (3, None, 0), (3, 7, 0)], "doc_id bigint, quality int, toxic int")
    found = op.quality_scores(docs, labels).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.doc_id is None or r.held_out == (remainder(r.doc_id, 3) == 1)
    assert op.quality_scores(empty(spark), labels).count() == 0
    assert {r.score for r in op.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_held_out_labels_do_not_matter(spark):
    docs = documents(spark, [f"some text number {k} {'!!' * (k % 2)}" for k in range(60)])
    rows = [(k, k % 2, 0) for k in range(60)]
    turned = [(k, 1 - q if remainder(k, 3) == 1 else q, t) for k, q, t in rows]
    schema = "doc_id bigint, quality int, toxic int"
    one, two = (op.quality_scores(docs, spark.createDataFrame(x, schema)).orderBy("doc_id").collect() for x in (rows, turned))
    assert one == two


def test_good_documents_keep_their_columns(spark):
    docs = awkward(spark)
    kept = op.good_documents(docs, spark.createDataFrame([(k, 1) for k in range(12)], "doc_id bigint, quality int"))
    assert kept.columns == docs.columns
    assert kept.count() == docs.count()
    assert kept.filter(F.col("score") != "extra score").count() == 0


def test_scores_are_sparse_dot_products():
    texts = ["a b a, b", None, "x", "same same same"]
    buckets, rows, counts = op.features(pa.array(texts))
    assert counts.tolist() == [9, 0, 1, 5]
    one, _, _ = op.features(pa.array(["a b a, b"]))
    assert sorted(buckets[rows == 0]) == sorted(one)

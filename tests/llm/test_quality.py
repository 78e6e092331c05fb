import zlib

import numpy as np
import pytest

from fleetlake.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return quality.train(*tables)


def test_held_out_accuracy(tables, model):
    scored = quality.score(tables[0], model).join(tables[1], "doc_id").where("held_out").toPandas()
    good = scored.quality == 1
    assert len(scored) > 60 and (~good).sum() > 5
    ranks = scored.score.rank().to_numpy()
    auc = (ranks[good].mean() - (good.sum() + 1) / 2) / (~good).sum()
    assert auc > 0.97
    assert (scored.predicted == scored.quality).mean() > 0.95
    assert (scored.predicted[good] == 1).mean() > 0.98


def test_held_out_labels_are_never_learnt(spark, tables, model):
    docs, labels = tables
    turned = labels.withColumn("quality", (quality.fold() == 2).cast("int") * (1 - labels["quality"]) + (quality.fold() != 2).cast("int") * labels["quality"])
    again = quality.train(docs, turned)
    assert np.array_equal(again.weights, model.weights) and again.shift == model.shift


def test_fold_is_that_of_zlib(docs, rows):
    got = docs.select("doc_id", quality.fold().alias("f")).collect()
    assert all(r.f == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 4 for r in got)


def test_awkward_rows(docs, rows, model):
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}


def test_scores_depend_on_the_text_alone(docs, model):
    from pyspark.sql import functions as F

    a = {(r.doc_id, r.score) for r in quality.score(docs, model).collect()}
    b = {(r.doc_id, r.score) for r in quality.score(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")), model).collect()}
    assert a == b


def test_no_rows_and_no_labels(spark, docs, no_docs, tables, model):
    assert quality.score(no_docs, model).collect() == []
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    assert quality.train(docs, none) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {1.0}
    assert quality.stage(docs, none).count() == docs.count()
    assert quality.train(no_docs, tables[1]) is None
    after = quality.stage(docs, tables[1])
    assert after.dtypes == docs.dtypes and after.count() <= docs.count()


def test_one_class_of_labels(spark, docs, rows):
    some = spark.createDataFrame([(r[0], 1) for r in rows if r[0] is not None] * 2, "doc_id long, quality int")
    model = quality.train(docs, some)
    assert all(np.isfinite(r.score) for r in quality.score(docs, model).collect())


def test_risk_never_rewards_a_negative_part():
    """With all unlabelled rows positive, the non-negative risk doesn't push the positives down."""
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(400, 5)).astype(np.float32)
    model = quality.fit(x[:200], x[200:], x[:200], np.ones(200))
    assert model.scores(x).mean() > 0.7

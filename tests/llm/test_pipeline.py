"""Each stage on the awkward documents and on what its predecessor kept, against brute force."""

import hashlib
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from fleetlake.llm import pieces, quality

from tests.llm import test_line_dedup, test_mixing, test_setsketch

from .helpers import DOCUMENT

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        folder = str(tmp_path_factory.mktemp("stage") / str(i))
        function(spark, docs, SF).write.parquet(folder)
        docs = spark.read.parquet(folder)
        found.append(docs)
    return found


def as_rows(df):
    return [tuple(r) for r in df.select(*DOCUMENT).collect()]


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "mixing", "SentencePiece encoding"]


def test_all_but_the_last_return_documents(outputs):
    for df in outputs[:-1]:
        assert df.dtypes == outputs[0].dtypes


def test_quality_rejects_what_it_predicts(spark, outputs):
    docs = outputs[0]
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in outputs[1].select("doc_id").collect()} == kept
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()
    assert sum(r.doc_id in kept for r in labels) >= 0.98 * len(labels)


def test_lines(outputs):
    expected = test_line_dedup.brute(as_rows(outputs[1]))
    assert sorted((r.doc_id, r.text) for r in outputs[2].collect()) == sorted((a, t) for a, _, _, t in expected)


def test_near_copies(outputs):
    expected = test_setsketch.brute(as_rows(outputs[2]), 5)
    assert sorted(r.doc_id for r in outputs[3].collect()) == sorted(i for i, e in expected.items() if e[2])


def test_mix(outputs):
    before, after = as_rows(outputs[3]), as_rows(outputs[4])
    copies = Counter(r[0] for r in after)
    size, target, taken = Counter(), {}, Counter()
    for r in before:
        size[r[3]] += test_mixing.words(r[1])
        taken[r[3]] += copies[r[0]] * test_mixing.words(r[1])
    target = test_mixing.targets(size, (3, 1, 2), 1.5, 2)
    largest = Counter()
    for r in before:
        largest[r[3]] = max(largest[r[3]], test_mixing.words(r[1]))
    assert set(copies.values()) <= {1, 2} and {r[:2] for r in after} <= {r[:2] for r in before}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_tokens(outputs):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    expected = Counter((r[0], tuple(library.encode(r[1]))) for r in as_rows(outputs[4]))
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in outputs[5].collect()) == expected


def test_run_is_the_stages_one_after_the_other(spark, outputs):
    def digest(df):
        return Counter((r.doc_id, hashlib.md5(repr(r.token_ids).encode()).hexdigest()) for r in df.collect())

    assert digest(corpus_pipeline.run(spark, SF)) == digest(outputs[5])


def test_awkward_documents_and_none(spark, docs, no_docs):
    for start in (docs, no_docs):
        df = start
        for _, function in corpus_pipeline.STAGES[:-1]:
            df = function(spark, df, SF)
            assert df.dtypes == docs.dtypes
        assert (corpus_pipeline.STAGES[-1][1](spark, df, SF).count() > 0) == (start is docs)

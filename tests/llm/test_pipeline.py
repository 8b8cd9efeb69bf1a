"""The pipeline's stages, one by one and together."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hazegrid.llm import neardup, quality, toxicity


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def test_stages_keep_what_they_should(spark, docs, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    now, seen = docs, []
    for name, stage in corpus_pipeline.STAGES[:3]:
        ids = {r["doc_id"] for r in now.select("doc_id").collect()}
        wanted = {
            "quality": lambda d: quality.score(d, labels).filter("kept"),
            "toxicity": lambda d: toxicity.score(d, labels).filter("predicted = 0"),
            "near_duplicates": lambda d: neardup.duplicate_components(d).filter("kept"),
        }[name](now)
        left = stage(spark, now, data)
        assert left.columns == corpus_pipeline.COLUMNS
        got = sorted(r["doc_id"] for r in left.collect())
        assert got == sorted(r["doc_id"] for r in wanted.select("doc_id").collect())
        assert set(got) <= ids and len(got) == len(set(got))
        now, seen = spark.createDataFrame(left.collect(), docs.schema), [*seen, len(got)]
    assert seen[-1] > 0.4 * docs.count()


def test_run_packs_every_mixed_document(spark, data, docs):
    out = corpus_pipeline.run(spark, data)
    twice = corpus_pipeline.run(spark, data)
    assert out.exceptAll(twice).count() == 0 and out.count() == twice.count()
    per = out.groupBy("bucket", "batch").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("s"),
                                             F.max("padded_to").alias("p"))
    assert per.filter("n <> s + 1 or (n > 1 and n * p > 65536)").count() == 0
    assert out.select("doc_id").distinct().count() <= docs.count()


@pytest.mark.parametrize("name", [f"{x[0]}" for x in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_input(spark, docs, data, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0),
            (2, "word " * 9000, "en", None, 7), (3, "a b c", None, "a", 3), (3, "d e f", None, "a", 3)]
    odd = spark.createDataFrame(rows, docs.schema)
    path = corpus_pipeline.written(odd, "odd")
    assert stage(spark, path, data).count() <= len(rows) * 2
    empty = corpus_pipeline.written(odd.filter("false"), "odd")
    assert stage(spark, empty, data).count() == 0


def test_eleven_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1

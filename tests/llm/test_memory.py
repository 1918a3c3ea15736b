"""What the pipeline leaves in the memory of its executors and their Python workers."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandcast.llm import common

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def batch_sizes(df):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return [r[0] for r in common.map_arrow(df, run, "n bigint").collect()]


@pytest.mark.parametrize("asked, most", [("10000", 1000), ("0", 1000), ("300", 300)])
def test_stages_exchange_small_batches(spark, asked, most):
    docs = spark.range(2500).coalesce(1).select(F.col("id").alias("doc_id"), F.lit("a short text").alias("text"))
    spark.conf.set(KEY, asked)
    try:
        out = corpus_pipeline.tokenize(spark, docs, "")
        sizes = batch_sizes(docs)
        assert max(sizes) <= most and sum(sizes) == 2500
        assert out.count() == 2500
    finally:
        spark.conf.unset(KEY)


def test_workers_release_memory_after_the_last_batch(monkeypatch):
    class Frame:
        class sparkSession:
            class sparkContext:
                environment: dict = {}

        def mapInArrow(self, run, schema):
            return run

    seen = []
    monkeypatch.setattr(common, "release", lambda: seen.append("released"))

    def run(batches):
        for batch in batches:
            seen.append(batch)
            yield batch

    assert list(common.map_arrow(Frame(), run, "n bigint")([1, 2])) == [1, 2]
    assert seen == [1, 2, "released"]


def test_release_runs_on_this_machine():
    common.release()

"""Registered corpus queries and the pipeline over the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, connect
from demandcast.llm import decontam, neardup
from demandcast.llm.queries import load

QUERIES, ORACLES = load()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, QUERIES[name], ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14)) and "pipeline" in QUERIES


def test_url_sql_spreads_over_links(spark, tmp_path):
    """The twin's recursion and the operator agree on pages that do link."""
    from demandcast.llm import urls
    from demandcast.llm.queries import URL_RULES, URL_SQL

    rows = [(i, f"http://h{i}.{'net' if i % 7 == 0 else 'com'}/{'fr/' if i % 5 == 0 else ''}p{i}",
             f"<link rel='canonical' href='{'http://h%d.%s/p%d' % (i - 1, 'net' if (i - 1) % 7 == 0 else 'com', i - 1) if i % 3 else ''}'>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df.write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    want = sorted(map(repr, con.execute(URL_SQL).fetchall()))
    got = sorted(repr(tuple(r)) for r in urls.judge(df, urls.rule_table(spark, URL_RULES)).collect())
    assert got == want and sum("block" in x for x in got) > 20


def test_pipeline_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "", "en", "s", 0), (-3, "!! 11", None, None, 5)], docs.schema)
    docs = docs.unionByName(odd).withColumn("id", F.lit("x")).cache()
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        sizes.append(docs.count())
        if name != "byte_bpe":
            assert docs.columns == columns
        if name == "language_id":
            assert sizes[0] - sizes[1] == 3
        if name == "near_dedup":
            assert neardup.near_duplicates(docs, percent=80).where("NOT kept").count() == 0
        if name == "decontamination":
            assert decontam.contained_items(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.3 * sizes[0]
    assert docs.where("size(ids) <> n_tokens OR decoded_sha256 IS NULL").count() == 0
    assert docs.limit(1).columns == ["doc_id", "lang", "source", "n_chars", "id", "n_tokens", "ids", "decoded_sha256"]


def test_pipeline_of_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0

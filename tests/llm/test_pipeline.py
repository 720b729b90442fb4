"""The pipeline's stages, and every registered training-data query on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shelfscope.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def test_every_number_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_table(spark, name):
    table, key = {"op4_vectors": ("embeddings", "vec_id"), "op6_pages": ("pages", "page_id")}.get(name, ("documents", "doc_id"))
    got = queries.QUERIES[name](spark, SF).select(key).distinct().count()
    assert got == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "x", 0), (9002, "12 34", "en", "x", 5), (9002, "12 34", "en", "x", 5),
                                 (9003, "a secret='hunter2hunter2' in a text of some words", "en", "x", 49), (None, "and the of in", None, None, None)], docs.schema)
    cur = docs.unionByName(odd).withColumn("score", F.lit(1)).withColumn("_copies", F.lit("c"))
    for name, stage in corpus_pipeline.STAGES:
        nxt = stage(spark, cur, SF)
        if name != "packing":
            assert nxt.columns == cur.columns
            nxt = spark.createDataFrame(nxt.collect(), cur.schema)
        if name == "language_id":
            assert nxt.where("doc_id in (9001, 9002)").count() == 0
            assert nxt.count() >= cur.count() - 6
        if name == "simhash_near_dedup":
            kept = nxt.select("doc_id").distinct().count()
            assert kept == nxt.count()
            want = simhash.simhash_groups(cur).select("component_id").distinct().count()   # the group without an id, too
            assert kept == want
        if name == "secret_scan":
            assert nxt.count() == cur.count() and nxt.where("text like '%[SECRET]%'").count() > 0
        if name == "mixing":
            copies = nxt.groupBy("doc_id").count().agg(F.max("count")).first()[0]
            assert 1 <= copies <= 3 and nxt.count() > 0
        if name == "packing":
            assert nxt.select("doc_id").distinct().count() == cur.select("doc_id").distinct().count()
        cur = nxt


def test_near_dedup_keeps_one_of_each_group_without_ids(spark):
    text = ["".join(f"{c}{i} " for i in range(40)) for c in "abcdef"]
    rows = [(None, text[0], None, "x", 1), (None, text[0], None, "x", 1), (None, text[0], "x", None, 1),
            (None, text[1], "en", "x", 2), (7, text[2], "en", "x", 3), (7, text[3], "en", "x", 4), (7, text[3], "de", "x", 4),
            (None, text[4], "en", "x", 5), (9, text[4], "en", "x", 5), (8, text[4], "en", "x", 5), (8, text[4], "en", "x", 5)]
    d = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    got = corpus_pipeline.near_duplicates(spark, d, SF).collect()
    assert all(tuple(g) in rows for g in got)
    assert sorted((text.index(g["text"]), g["doc_id"]) for g in got) == [(0, None), (1, None), (2, 7), (3, 7), (4, 8)]


def test_language_keeps_texts_without_any_label(spark):
    d = spark.createDataFrame([(1, "some words"), (2, "12 34"), (3, None)], "doc_id long, text string").withColumn(
        "lang", F.lit(None).cast("string")).withColumn("source", F.lit("x")).withColumn("n_chars", F.lit(0).cast("long"))
    assert [r["doc_id"] for r in corpus_pipeline.language(spark, d, SF).collect()] == [1]


def test_empty_pipeline(spark):
    cur = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        cur = stage(spark, cur, SF)
        assert cur.count() == 0

"""The registered queries over the smallest tables."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from lectern.llm.queries import ORACLES, QUERIES
from lectern.llm.scratch import stored
from standins.views import TABLES
from tests.llm import brute
from tests.test_queries import canonical


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{small}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(spark, small):
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]


def test_all_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in driver.queries() if name.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in driver.queries()
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, duck, name):
    got = QUERIES[name](spark, small)
    expected = duck.sql(ORACLES[name])
    ours = canonical(got.columns, [tuple(row) for row in got.collect()])
    theirs = canonical(expected.columns, expected.fetchall())
    assert ours == theirs and ours[1]


def test_jaccard_query(spark, small, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_jaccard_join"](spark, small).collect()}
    assert got == brute.jaccard_components(texts)


def test_suffix_query(spark, small, texts):
    wanted = {i: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, (n, gone, spans, kept) in brute.without_repeats(texts).items()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_suffix_dedup"](spark, small).collect()}
    assert got == wanted


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], small), name))
    first, good, lines, single, clean, mix = tables
    assert all(t.columns == docs.columns for t in tables[:-1])
    labels = spark.read.parquet(f"{small}/labels.parquet")
    kept = good.join(labels, "doc_id").groupBy("quality").count().collect()
    marked = {r.quality: r["count"] for r in labels.join(first, "doc_id").groupBy("quality").count().collect()}
    assert {r.quality: r["count"] for r in kept}.get(1, 0) >= 0.97 * marked[1]
    assert {r.quality: r["count"] for r in kept}.get(0, 0) <= 0.1 * marked[0]
    dropped = brute.dropped_lines([tuple(r) for r in good.select("doc_id", "text").collect()])
    emptied = {i for i, (n, gone) in dropped.items() if n == len(gone)}
    assert {r.doc_id for r in lines.collect()} == {r.doc_id for r in good.collect()} - emptied
    label = brute.jaccard_components([tuple(r) for r in lines.select("doc_id", "text").collect()])
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in label.items() if c == i}
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute.contamination([tuple(r) for r in single.select("doc_id", "text").collect()], items)
    assert {r.doc_id for r in clean.collect()} == {i for i, x in hit.items() if not x[3]}
    assert mix.count() == clean.count()
    total, taken = mix.agg(F.sum("size"), F.sum("taken")).first()
    assert abs(taken - 1.5 * total) <= 20


def test_stages_go_by_rows_not_ids(spark, small):
    item = spark.read.parquet(f"{small}/benchmark.parquet").orderBy("item_id").first().text
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    clean = "plain words that stand in no benchmark at all " * 3
    rows = [(None, item, None, None, None), (1, item, "en", "s", 1), (1, clean, "en", "s", 1), (None, "short one", None, None, None),
            (2, clean, "en", "s", 1), (2, clean, "en", "s", 1), (3, None, None, "s", None), (4, "", None, "s", 0), (None, clean, None, "t", 1)]
    docs = stored(spark.createDataFrame(rows, schema), "rows")
    kept = corpus_pipeline.decontamination(spark, docs, small).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in docs.collect() if r.text != item)
    single = corpus_pipeline.near_duplicates(spark, docs, small).collect()
    assert sorted((str(r.doc_id), r.text) for r in single) == sorted(
        [("1", item), ("1", clean), ("None", "short one"), ("3", None), ("4", "")], key=str)


def test_stages_on_no_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small), name)
        assert docs.count() == 0

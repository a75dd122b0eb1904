"""The registered queries against their SQL, and the pipeline against its rules, on the smallest data folder."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm.queries import ORACLES, QUERIES
from tests.test_oracles import FOLDER, TABLES, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows(result.columns, result.collect()) == rows(columns, cursor.fetchall())


@pytest.mark.parametrize("name, key, table", [
    ("op6_language_id", "doc_id", "documents"), ("op8_toxicity", "doc_id", "documents"), ("op9_token_store", "doc_id", "documents"),
    ("op10_html_text", "page_id", "pages")])
def test_every_row_has_a_result(spark, name, key, table):
    got = QUERIES[name](spark, FOLDER).select(key)
    want = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_pipeline_stages_obey_their_rules(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
        if name != "token_files":
            assert found.columns == docs.columns
        kept[name], docs = found, found
    count = lambda n: kept[n].count()
    assert count("language") >= 0.98 * spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert count("near_duplicates") < count("language") and count("decontamination") < count("near_duplicates")
    assert kept["near_duplicates"].select("text").distinct().count() == count("near_duplicates")
    repeats = kept["mixing"].groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert repeats == 2 and count("token_files") == count("mixing")
    last = kept["token_files"].agg(F.max(F.col("start") + F.col("n_tokens")), F.sum("n_tokens")).first()
    assert last[0] == last[1]


def test_one_document_of_repeated_rows_and_null_ids_stays(spark):
    said = [" ".join(f"w{i * 31 + k}" for k in range(40)) for i in range(4)]
    rows = [(1, said[0]), (1, said[0]), (2, said[0]), (None, said[1]), (None, said[1]), (None, said[2]), (0, said[3]), (0, said[3]), (3, said[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    got = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], said.index(r["text"])) for r in got.collect()), key=str) == [(0, 3), (1, 0), (None, 1), (None, 2)]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clash = ["size", "target", "taken", "copies", "score", "rejected", "lang_pred", "tie", "_id", "_tie", "_none", "contamination"]
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in clash})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.columns == docs.columns
        assert found.filter(" or ".join(f"`{c}` <> concat('{c} of ', doc_id)" for c in clash)).count() == 0 < found.count()

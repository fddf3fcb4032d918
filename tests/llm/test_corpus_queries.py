"""The registered corpus queries on the smallest supplied tables: oracles where there are any, invariants else."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from cauce.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables are not here")
registry.load_all()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in ("documents", "conversations", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_oracle(spark, oracle, name):
    df = registry.QUERIES[name](spark, SF)
    result = oracle.execute(registry.ORACLES[name])
    columns = sorted(d[0] for d in result.description)
    assert columns == sorted(df.columns)
    places = [[d[0] for d in result.description].index(c) for c in columns]
    want = sorted((tuple(row[p] for p in places) for row in result.fetchall()), key=repr)
    assert sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", ["op1_toxicity", "op2_quality_model", "op3_secrets", "op5_substring_dedup", "op7_bpe", "op8_simhash", "op12_alignment", "op13_sharding"])
def test_query_gives_one_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.QUERIES[name](spark, SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_all_operators_and_the_pipeline_are_registered(spark):
    names = entry_point.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert names["pipeline"](spark, SF).count() > 0

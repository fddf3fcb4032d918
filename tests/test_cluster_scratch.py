"""Queries on a cluster whose ``spark.checkpoint.dir`` is a shared folder named without a scheme."""

import importlib.util
import json
import os
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from cauce.sources import scratch
from tests.test_queries import plain

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
QUERIES = [
    "a01_read_csv",
    "a02_read_csv_sniffed",
    "a06_load_idempotent",
    "a07_load_file_map",
    "a08_load_quality_cases",
    "a09_append_load",
    "a10_create_empty_like",
    "a11_write_mart",
    "a13_export_files",
    "a14_write_partitioned",
    "a17_partition_inventory",
    "a18_preview_facts",
    "b02_clean_trips",
    "b03_rule_profile",
    "b04_retention",
    "b05_predicates",
    "b07_code_labels",
    "b08_bucketing",
    "b09_flags",
    "c03_role_playing_join",
    "c08_key_resolution",
    "c05_left_join_using",
    "d01_global_metrics",
    "d01_global_percentiles",
]


def build(spark, folder):
    """Small tables of the supplied schema."""
    day = datetime(1996, 1, 1)
    tables = {
        "region": ("r_regionkey int, r_name string", [(i, f"REGION_{i}") for i in range(5)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"NATION_{i}", i % 5) for i in range(25)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"Customer#{i:09d}", i % 25, i * 97.25 - 500, ("BUILDING", "FURNITURE", "MACHINERY")[i % 3]) for i in range(60)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
                     [(i, f"Supplier#{i:09d}", i % 25, i * 31.5) for i in range(30)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"part {i}", f"Brand#{i % 9}", f"TYPE {i % 6}", i % 50 + 1, 900 + i / 10) for i in range(300)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                   "o_orderpriority string",
                   [(i, i * 7 % 60, "FOP"[i % 3], 1000.5 + i * 11.25, day + timedelta(days=i * 3 % 1500),
                     ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")[i * 3 % 5]) for i in range(400)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(i * 3 % 400, i * 13 % 300, i * 11 % 30, i % 7 + 1, float(i % 12 + 1), 900.25 + i * 17 % 40_000, i % 11 / 100, i % 9 / 100,
                       "ANR"[i % 3], "FO"[i % 2], day + timedelta(days=i * 5 % 1600)) for i in range(2000)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{folder}/{name}.parquet")


def run(folder, results, names):
    """In a process of its own: every query on two executors; rows, or what failed, as JSON."""
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.config(map={
        "spark.master": "local-cluster[2,1,1024]", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1",
        "spark.checkpoint.dir": f"{folder}/shared", "spark.sql.warehouse.dir": f"{folder}/warehouse",
        "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "2"}).getOrCreate()
    found = {}
    for name in names:
        try:
            df = entry_point.queries()[name](spark, folder)
            found[name] = [df.columns, [[plain(v) for v in row] for row in df.collect()]]
        except Exception as e:
            found[name] = f"{type(e).__name__}: {str(e)[:300]}"
    with open(results, "w") as f:
        json.dump([found, sorted({p.split("-")[0] for p in os.listdir(f"{folder}/shared")})], f, default=str)


@pytest.fixture(scope="module")
def on_cluster(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cluster")
    build(spark, folder)
    (folder / "home" / "work").mkdir(parents=True)  # the executors' logs go to work in Spark's home
    for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():
        if p.name != "work":
            (folder / "home" / p.name).symlink_to(p)
    own = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))}
    own |= {"SPARK_HOME": str(folder / "home"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1",
            "PYSPARK_PYTHON": sys.executable, "PYTHONPATH": REPO, "TZ": "UTC"}
    results = folder / "results.json"
    done = subprocess.run([sys.executable, "-B", __file__, str(folder), str(results), *QUERIES], env=own, cwd=folder, capture_output=True,
                          text=True, timeout=600)
    assert results.exists(), done.stderr[-2000:]
    oracle = duckdb.connect()
    for p in folder.glob("*.parquet"):
        oracle.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}/*.parquet'")
    return json.loads(results.read_text()), oracle


def told(columns, rows):
    """Rows as they look after JSON, columns by name."""
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(([str(v) if isinstance(v, datetime) else v for v in (plain(row[p]) for p in places)] for row in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query_runs_on_a_cluster_with_a_shared_folder_without_a_scheme(on_cluster, name):
    (found, _), oracle = on_cluster
    assert not isinstance(found[name], str), found[name]
    columns, rows = found[name]
    assert rows
    if sql := entry_point.oracle_sql().get(name):
        result = oracle.execute(sql)
        assert told(columns, rows) == told([d[0] for d in result.description], result.fetchall())


def test_intermediate_tables_lie_in_the_named_folder(on_cluster):
    (_, kept), _ = on_cluster
    assert "customer" in kept and "probe" not in kept


class Clustered:
    """A session that says it runs on a cluster; ``loses`` rows like a folder that each machine has for itself."""

    def __init__(self, spark, folder, loses=False):
        self.spark, self.loses = spark, loses
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = self
        self.master, self.applicationId, self.defaultParallelism = "spark://host", folder, 4

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def getConf(self):
        return self.conf

    def range(self, first, last, step, parts):
        return self.spark.range(first, last - self.loses, step, parts)


def test_a_folder_that_loses_rows_is_refused(spark, tmp_path):
    assert scratch.scratch_dir(Clustered(spark, str(tmp_path / "kept"))) == str(tmp_path / "kept")
    lost = Clustered(spark, str(tmp_path / "lost"), loses=True)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            scratch.scratch_dir(lost)
    assert not list((tmp_path / "lost").glob("probe-*"))


if __name__ == "__main__":
    run(sys.argv[1], sys.argv[2], sys.argv[3:])

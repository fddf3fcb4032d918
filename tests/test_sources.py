import logging
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cauce.plans import layout
from cauce.sources import files, scratch, tables
from cauce.streaming import landing

NOW = datetime(2026, 1, 1, 6)


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿id,name\n01,x\n".encode())
    df = files.read_csv(spark, str(path))
    assert df.columns == ["id", "name"] and df.first().id == "01"


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_delimiter_is_sniffed(spark, tmp_path, sep):
    path = tmp_path / "a.csv"
    path.write_text(sep.join(["a", "b", "c"]) + "\n" + sep.join(["1", "2", "3"]) + "\n")
    assert files.sniff_delimiter(spark, str(path)) == sep
    assert [tuple(r) for r in files.read_csv_sniffed(spark, str(path)).collect()] == [("1", "2", "3")]


def test_landing_cleans_names_text_and_dates(spark):
    df = spark.createDataFrame([(" nan ", "2024-01-05", 1), ("\tok", "soon", 2), ("None", None, 3)],
                               "` Some Name ` string, `Cut Date` string, n int")
    landed = files.land_csv(df, ["cut_date"])
    assert landed.columns == ["some_name", "cut_date", "n"]
    assert [tuple(r) for r in landed.collect()] == [(None, date(2024, 1, 5), 1), ("ok", None, 2), (None, None, 3)]


def test_file_order_follows_the_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("v\n" + "\n".join(str(i) for i in range(200)) + "\n")
    ordered = files.with_file_order(files.read_csv(spark, str(path))).orderBy("_file_order")
    assert [int(r.v) for r in ordered.collect()] == list(range(200))


def test_file_map_skips_what_is_missing_and_repeats_safely(spark, tmp_path, caplog):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Id\n1\n2\n")
    specs = {"a.csv": files.FileSpec("a"), "b.csv": files.FileSpec("b")}
    with caplog.at_level(logging.WARNING):
        for _ in range(2):
            written = files.load_file_map(spark, str(tmp_path / "in"), specs, str(tmp_path / "out"), NOW)
    assert list(written) == ["a"] and "b.csv" in caplog.text
    back = spark.read.parquet(written["a"])
    assert back.count() == 2 and back.first()["_extracted_at"] == NOW
    with pytest.raises(FileNotFoundError):
        files.load_file_map(spark, str(tmp_path / "none"), specs, str(tmp_path / "out"), NOW)


def test_optional_file_may_fail(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,a\n1,2\n")
    for required in (False, True):
        specs = {"bad.csv": files.FileSpec("bad", required=required, columns=("x", "x"))}
        if required:
            with pytest.raises(Exception):
                files.load_file_map(spark, str(tmp_path), specs, str(tmp_path / "o1"), NOW)
        else:
            assert files.load_file_map(spark, str(tmp_path), specs, str(tmp_path / "o2"), NOW) == {}


class Settings(dict):
    def get(self, name, default=None):
        return dict.get(self, name, default)


class Session:
    """Just enough of a session to ask where intermediate tables go."""

    def __init__(self, master, named=None):
        self.conf = Settings({"spark.checkpoint.dir": named} if named else {})
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return None


def test_scratch_folder_is_the_named_one_or_local():
    assert scratch.scratch_dir(Session("spark://host", "hdfs:///shared")) == "hdfs:///shared"
    assert "cauce-scratch" in scratch.scratch_dir(Session("local[2]"))
    with pytest.raises(RuntimeError):
        scratch.scratch_dir(Session("spark://host"))


def test_materialised_rows_read_back(spark):
    df = scratch.materialise(spark.range(3).toDF("v"))
    assert df.inputFiles() and sorted(r.v for r in df.collect()) == [0, 1, 2]


def test_empty_table_keeps_the_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    tables.create_empty_like(df, str(tmp_path / "e"))
    back = spark.read.parquet(str(tmp_path / "e"))
    assert back.count() == 0 and back.dtypes == df.dtypes


def partitioned(spark, tmp_path):
    trips = spark.range(4000).select(
        F.date_add(F.lit(date(2022, 3, 1)), (F.col("id") % 60).cast("int")).alias("pickup_date"),
        (F.col("id") % 50).cast("int").alias("pickup_location_id"), (F.col("id") % 7).cast("int").alias("dropoff_location_id"),
        F.lit(10.0).alias("fare_amount"), F.lit(12.0).alias("total_amount"), F.lit("wide").alias("other"))
    path = str(tmp_path / "p")
    tables.write_partitioned(trips, path, "pickup_date", ["pickup_location_id", "dropoff_location_id"])
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_period_and_zone_reach_the_scan(spark, tmp_path):
    trips = partitioned(spark, tmp_path)
    daily = layout.daily_revenue(trips, date(2022, 3, 5), date(2022, 3, 6))
    text = plan(daily)
    assert "PartitionFilters: [isnotnull(pickup_date" in text
    assert "ReadSchema: struct<total_amount:double>" in text
    assert [r.viajes for r in daily.collect()] == [67, 67]
    zone = layout.zone_destinations(trips, date(2022, 3, 5), date(2022, 3, 9), 14)
    assert "EqualTo(pickup_location_id,14)" in plan(zone)


def test_partition_inventory_and_bytes(spark, tmp_path):
    trips = partitioned(spark, tmp_path)
    facts = tables.partition_inventory(trips, "pickup_date").first()
    assert (facts.n_partitions, facts.first_partition) == (60, date(2022, 3, 1))
    some = layout.between_days(trips, date(2022, 3, 1), date(2022, 3, 3))
    assert 0 < layout.scanned_bytes(some) < layout.scanned_bytes(trips) / 10
    parts = [layout.scanned_bytes(some, [c]) for c in trips.columns]
    assert sum(parts) == layout.scanned_bytes(some) and layout.scanned_bytes(some, ["pickup_date"]) == 0
    assert layout.scanned_bytes(trips.where("false")) == 0


def test_rows_of_one_hot_day_spread_over_files(spark, tmp_path):
    hot = spark.range(20000).select(F.lit(date(2022, 1, 1)).alias("d"), F.lit(1).alias("z"), "id")
    tables.write_partitioned(hot, str(tmp_path / "h"), "d", ["z"], files=8)
    back = spark.read.parquet(str(tmp_path / "h"))
    assert back.count() == 20000 and len(back.inputFiles()) == 8


def test_compare_runs(spark):
    log = layout.run_log(spark, [("B1", "STD", 1000, 30), ("B1", "OPT", 100, 10), ("B2", "STD", 5, 1)])
    got = {r.prueba: (r.bytes_std, r.bytes_opt, r.reduccion_pct, r.ms_opt) for r in layout.compare_runs(log).collect()}
    assert got == {"B1": (1000, 100, 90.0, 10), "B2": (5, None, None, None)}


def test_arriving_files_land_once(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    (incoming / "1.csv").write_text("Id,Cut Date\n 1 ,2024-01-05\n")
    spec = files.FileSpec("stock", ("cut_date",), columns=("Id", "Cut Date"))

    def run():
        landing.land_arriving(spark, str(incoming), spec, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()

    run()
    (incoming / "2.csv").write_text("Id,Cut Date\nnan,late\n")
    run()
    run()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy(F.asc_nulls_first("id")).collect()
    assert [(r.id, r.cut_date) for r in got] == [(None, None), ("1", date(2024, 1, 5))]


def test_csv_as_people_write_it(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text('note,id\n"a ""b"", c",1\n"two\nlines",2\n')
    got = files.read_csv(spark, str(path), ["id", "note"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("1", 'a "b", c'), ("2", "two\nlines")]
    with pytest.raises(ValueError, match="nowhere"):
        files.read_csv(spark, str(path), ["id", "nowhere"])


def test_exported_csv_doubles_its_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "two\nlines")], "id int, note string").coalesce(1)
    tables.export_csv(df, str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*"))
    assert '"a ""b"", c"' in part.read_text()
    assert {r.note for r in files.read_csv(spark, str(tmp_path / "out")).collect()} == {'a "b", c', "two\nlines"}


def test_landed_dates_in_several_forms(spark):
    texts = ["2026-01-15", "15/01/2026", "01/02/2026", "Jan 5 2026", "5 Jan 2026", "soon", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, day string")
    got = [str(r.day) for r in files.land_csv(df, ["day"]).orderBy("id").collect()]
    assert got == ["2026-01-15", "2026-01-15", "2026-01-02", "2026-01-05", "2026-01-05", "None", "None"]


def test_interleaved_key_follows_the_bits_of_the_ranks(spark):
    df = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    key = tables.interleaved_key(df, ["a", "b"], bits=2)
    got = {(r.a, r.b): r.k for r in df.select("a", "b", key.alias("k")).collect()}
    for (a, b), k in got.items():
        ranks = (k >> 1 & 1) | (k >> 3 & 1) << 1, (k & 1) | (k >> 2 & 1) << 1
        assert abs(ranks[0] - a // 16) <= (a % 16 in (0, 15)) and abs(ranks[1] - b // 16) <= (b % 16 in (0, 15))
    assert sorted(set(got.values())) == list(range(16))


def test_interleaved_key_of_missing_values_ties_dates_and_no_rows(spark):
    df = spark.createDataFrame([(None, date(2024, 1, 1)), (7, date(2024, 1, 1)), (7, None), (7, date(2024, 3, 1))], "a int, d date")
    rows = df.select("a", "d", tables.interleaved_key(df, ["a", "d"], bits=3).alias("k")).collect()
    assert all(0 <= r.k < 64 for r in rows) and rows[0].k >= rows[1].k and rows[2].k >= rows[3].k >= rows[1].k
    none = df.limit(0)
    assert none.select(tables.interleaved_key(none, ["a"], bits=3)).collect() == []


def test_clustering_skips_row_groups_for_either_column(spark, tmp_path):
    df = spark.range(40_000).select((F.xxhash64("id") % 500).alias("a"), (F.xxhash64("id", F.lit(1)) % 500).alias("b"),
                                    F.when(F.col("id") % 3 > 0, 0).otherwise(1).alias("part"), "id")
    plain, alike, folders = (str(tmp_path / n) for n in ("sorted", "alike", "folders"))
    df.repartitionByRange(4, "a", "b").sortWithinPartitions("a", "b").write.option("parquet.block.size", 8 << 10).parquet(plain)
    tables.write_clustered(df, alike, ["a", "b"], files=4, block_bytes=8 << 10)
    tables.write_clustered(df, folders, ["a", "b"], by="part", files=4, block_bytes=8 << 10)
    left = {}
    for path in (plain, alike, folders):
        back = spark.read.parquet(path)
        assert back.count() == 40_000 and set(back.columns) == set(df.columns)
        for c in ("a", "b"):
            found = layout.row_groups(back, {c: (17, 17)}).first()
            assert found.n_rows == 40_000 and found.rows_left >= back.where(F.col(c) == 17).count()
            left[path, c] = found.groups_left / found.groups
    assert left[plain, "b"] > 0.9
    assert max(left[p, c] for p in (alike, folders) for c in ("a", "b")) < 0.35
    both = layout.row_groups(spark.read.parquet(alike), {"a": (17, 17), "b": (17, 17)}).first()
    assert both.groups_left / both.groups < 0.1
    assert layout.row_groups(spark.read.parquet(alike).limit(0), {"a": (1, 1)}).first().groups == 0


def test_a_hot_cell_spreads_over_files(spark, tmp_path, many_slices):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 400).alias("a"), (F.col("id") % 7).alias("b"), "id")
    tables.write_clustered(df.withColumn("b", F.when(F.col("a") == 5, 1).otherwise(F.col("b"))), str(tmp_path / "h"), ["a", "b"], files=8)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "h")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 2 * 20_000 / 8

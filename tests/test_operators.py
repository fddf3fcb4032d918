import math
import random
import re
from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cauce.operators import aggregates as agg, dims, joins, measures, quality, rows
from cauce.operators.history import merge_history, versions_per_key
from cauce.operators.late_history import LateHistory
from cauce.operators.order import number_rows, rank_descending, running_total
from cauce.operators.quantiles import exact_quantiles
from cauce.sources.publish import published
from cauce.sources.scratch import materialise


def skewed(spark, n=3000):
    """A third of the rows share one key."""
    rng = np.random.default_rng(1)
    keys = np.where(np.arange(n) % 3 == 0, "hot", np.char.add("k", (rng.integers(0, 40, n)).astype(str)))
    frame = pd.DataFrame({"k": keys, "v": np.round(rng.gamma(2, 50, n), 2), "i": np.arange(n)})
    return spark.createDataFrame(frame), frame


def test_running_total_over_slices(spark, many_slices):
    df, frame = skewed(spark)
    got = running_total(df.repartition(8), ["i"], "v", "r", ["k"]).toPandas().sort_values("i")
    want = frame.sort_values("i").groupby("k")["v"].cumsum()
    assert np.allclose(got["r"].to_numpy(), want.sort_index().to_numpy())


def test_running_total_uses_more_than_one_slice(spark, many_slices):
    df, _ = skewed(spark)
    ranged = materialise(df.repartitionByRange("i"))
    assert len(ranged.inputFiles()) > 1


def test_number_rows_is_dense(spark, many_slices):
    df, frame = skewed(spark)
    got = number_rows(df.select("i"), ["i"], "n", start=10).toPandas().sort_values("i")
    assert got["n"].tolist() == list(range(11, 11 + len(frame)))


def test_rank_descending(spark, many_slices):
    df = spark.createDataFrame([("a", 5), ("b", 7), ("c", 5), ("d", None), ("e", 1)], "k string, n int")
    got = {r.k: r.pos for r in rank_descending(df, "n", "pos").collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "e": 4, "d": 5}


@pytest.mark.parametrize("by", [[], ["k"]])
def test_exact_quantiles_against_numpy(spark, many_slices, by):
    df, frame = skewed(spark)
    got = exact_quantiles(df, "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}, by).toPandas()
    groups = {(): frame} if not by else dict(tuple(frame.groupby("k")))
    assert len(got) == len(groups)
    for _, row in got.iterrows():
        part = groups[row["k"]] if by else frame
        for name, p in (("q1", 0.25), ("q2", 0.5), ("q9", 0.9)):
            assert math.isclose(row[name], np.quantile(part["v"], p), rel_tol=1e-12)


def test_median_interpolates_and_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", 9.0), ("a", None), (None, 3.0)], "k string, v double")
    assert [tuple(r) for r in exact_quantiles(df, "v", {"m": 0.5}, ["k"]).collect()] == [("a", 3.0)]


def test_keep_first_takes_a_whole_row(spark):
    df = spark.createDataFrame([(1, 3, "x", None), (1, 2, "y", 1.0), (2, 1, "z", 2.0)], "k int, o int, s string, d double")
    got = {r.k: (r.o, r.s, r.d) for r in rows.keep_first(df, ["k"], ["o"]).collect()}
    assert got == {1: (2, "y", 1.0), 2: (1, "z", 2.0)}


def test_keep_first_keeps_null_keys_and_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k int, o int")
    first = rows.keep_first(df, ["k"], ["o"])
    assert [tuple(r) for r in first.collect()] == [(None, 1)]
    plan = first._jdf.queryExecution().sparkPlan().toString() + first._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", below)


def test_conditional_overwrites(spark):
    df = spark.createDataFrame([("C", 1.0), ("O", None), ("D", None), (None, 5.0)], "s string, v double")
    cleared = rows.null_where(df, F.col("s") == "C", ["v"])
    filled = rows.default_where(cleared, F.col("s") == "O", "v", 0.0)
    assert [r.v for r in filled.collect()] == [None, 0.0, None, 5.0]


def test_resolve_keys_can_fail_on_a_missing_member(spark):
    fact = spark.createDataFrame([("a",), ("q",)], "code string")
    dim = spark.createDataFrame([("a", 1)], "code string, key int")
    lookup = [joins.KeyLookup("code", dim, "code", "key", "code_key")]
    assert {r.code: r.code_key for r in joins.resolve_keys(fact, lookup).collect()} == {"a": 1, "q": None}
    with pytest.raises(Exception, match="no dimension row for q"):
        joins.resolve_keys(fact, lookup, on_missing="error").collect()


def test_orphans_count_null_keys_but_the_relationship_check_does_not(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert joins.count_orphans(child, parent, "id", "id", "n").first().n == 3
    assert quality.check_relationship(child, "t", "id", parent, "id").first().failures == 2


def test_zone_join_fans_out_and_keeps_unknown_zones(spark):
    trips = spark.createDataFrame([(1,), (9,)], "zone int")
    zones = spark.createDataFrame([(1, "A"), (1, "B")], "id int, name string")
    got = joins.role_play(trips, zones, "id", {"zone": {"name": "label"}}).collect()
    assert sorted((r.zone, r.label or "") for r in got) == [(1, "A"), (1, "B"), (9, "")]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 10, 10)] + [(None,)], "v double")
    bins = agg.histogram(df, "v", 5).orderBy("bin").collect()
    assert [b.n for b in bins] == [2, 0, 1, 0, 2]
    assert bins[0].bin_from == 0.0 and bins[-1].bin_to == 10.0


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert agg.histogram(df, "v", 3).orderBy("bin").first().n == 2


def test_weekly_counts_fill_gaps(spark):
    days = [date(2024, 1, 1), date(2024, 1, 7), date(2024, 1, 22), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [tuple(r) for r in agg.weekly_counts(df, "d").orderBy("week").collect()] == [
        (date(2024, 1, 7), 2), (date(2024, 1, 14), 0), (date(2024, 1, 21), 0), (date(2024, 1, 28), 1)]


def test_describe_against_pandas(spark):
    df, frame = skewed(spark, 500)
    got = agg.describe_numeric(df, ["v", "i"]).toPandas().set_index("variable")
    want = frame[["v", "i"]].describe()
    for name in ("v", "i"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
            assert math.isclose(got.loc[name, ours], want.loc[theirs, name], rel_tol=1e-9)


def test_duplicate_profile_against_pandas(spark):
    frame = pd.DataFrame({"k": ["a", "a", "a", "b", None, None], "v": [1, 1, 2, 3, 4, 4]})
    got = agg.duplicate_profile(spark.createDataFrame(frame), "k").first()
    assert (got.n_rows, got.duplicate_rows, got.duplicate_keys, got.distinct_keys) == (
        6, frame.duplicated().sum(), frame["k"].duplicated().sum(), 2)


def test_pivot_drops_null_keys_and_fills(spark):
    df = spark.createDataFrame([("x", "A"), ("x", "A"), ("y", None), (None, "B"), ("y", "B")], "i string, c string")
    got = {r.i: (r.A, r.B) for r in agg.pivot_table(df, "i", "c", ["A", "B"], F.count("c")).collect()}
    assert got == {"x": (2, 0), "y": (0, 1)}


def test_simple_dim_keeps_old_keys(spark):
    first = dims.build_simple_dim(spark.createDataFrame([("m",), ("c",), (None,)], "v string"), "v", "key")
    assert {r.v: r.key for r in first.collect()} == {"c": 1, "m": 2}
    second = dims.build_simple_dim(spark.createDataFrame([("a",), ("m",), ("z",)], "v string"), "v", "key", first)
    assert {r.v: r.key for r in second.collect()} == {"c": 1, "m": 2, "a": 3, "z": 4}


def test_value_dims_in_one_scan(spark, many_slices):
    df = spark.createDataFrame([("b", "a", 7), ("c", None, 3)], "o string, d string, n int")
    specs = {"places": dims.ValueDim(("o", "d"), "place", "place_key"), "numbers": dims.ValueDim(("n",), "n", "n_key")}
    built = dims.build_value_dims(df, specs)
    assert {r.place: r.place_key for r in built["places"].collect()} == {"a": 1, "b": 2, "c": 3}
    more = dims.build_value_dims(spark.createDataFrame([("a", "aa", 3)], df.schema), specs, built)
    assert {r.place: r.place_key for r in more["places"].collect()} == {"a": 1, "b": 2, "c": 3, "aa": 4}
    assert sorted(r.n for r in more["numbers"].collect()) == [3, 7]


def test_calendar_has_no_gaps(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 27, 9),), (datetime(2024, 3, 2, 1),)], "t timestamp")
    days = dims.build_calendar(df, "t").orderBy("fecha").collect()
    assert [d.fecha_key for d in days] == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert days[-1].nombre_dia_semana == "Sabado" and days[-1].es_fin_semana


LOAD, NEXT = datetime(2026, 1, 1), datetime(2026, 2, 1)
PEOPLE = "passenger_id string, genero string, edad int, nacionalidad string"
ATTRIBUTES = ("genero", "edad", "nacionalidad")


def merged(spark, dimension, people, ts):
    batch = spark.createDataFrame(people, PEOPLE)
    result = merge_history(dimension, batch, "passenger_id", ATTRIBUTES, ts)
    return materialise(result.dimension), result.counts.first()


def test_history_opens_changes_and_keeps(spark):
    first, counts = merged(spark, None, [("a", "M", 30, "GT"), ("b", "F", 20, None), ("a", "M", 31, "GT")], LOAD)
    assert counts.inserted == 2
    assert {r.passenger_id: r.edad for r in first.collect()} == {"a": 30, "b": 20}
    second, counts = merged(spark, first, [("a", "M", 30, "MX"), ("b", "F", 20, None), ("c", "X", 1, "XX")], NEXT)
    assert (counts.inserted, counts.changed, counts.unchanged) == (1, 1, 1)
    history = second.where("passenger_id = 'a'").orderBy("version").collect()
    assert [(h.version, h.nacionalidad, h.es_actual) for h in history] == [(1, "GT", False), (2, "MX", True)]
    assert history[0].fecha_fin_validez == NEXT and history[1].fecha_inicio_validez == NEXT
    assert sorted(r.pasajero_key for r in second.collect()) == [1, 2, 3, 4]
    assert [r.passenger_id for r in versions_per_key(second, "passenger_id").collect()] == ["a"]
    current = second.where("es_actual").groupBy("passenger_id").count()
    assert current.where("count <> 1").count() == 0


def test_merging_the_same_batch_again_changes_nothing(spark):
    batch = [("a", "M", 30, "GT"), ("b", "F", None, None)]
    first, _ = merged(spark, None, batch, LOAD)
    second, counts = merged(spark, first, batch, NEXT)
    assert (counts.inserted, counts.changed, counts.unchanged) == (0, 0, 2)
    assert sorted(map(str, second.collect())) == sorted(map(str, first.select(second.columns).collect()))


def test_history_value_to_null_is_a_change(spark):
    first, _ = merged(spark, None, [("a", "M", 30, "GT")], LOAD)
    _, counts = merged(spark, first, [("a", "M", 30, None)], NEXT)
    assert counts.changed == 1


def test_quality_lines(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (None, "y")], "id int, s string")
    assert quality.check_unique(df, "t", "id").first().failures == 1
    lines = {r.column_name: r.failures for r in quality.check_not_null(df, "t", ["id", "s"]).collect()}
    assert lines == {"id": 2, "s": 1}
    report = quality.dq_report([quality.check_unique(df, "t", "id"), quality.check_not_null(df, "t", ["s"])])
    assert [r.passed for r in report.collect()] == [False, False]


def test_rules_ignore_unknown_outcomes(spark):
    df = spark.createDataFrame([(None,), (0,), (5,)], "code int")
    profile = quality.rule_profile(df, {"outside": ~F.col("code").between(1, 6)}, "n").first()
    assert (profile.n, profile.outside) == (3, 1)


def test_split_overlap(spark):
    df = spark.createDataFrame([(1, "TRAIN"), (1, "TRAIN"), (2, "TRAIN"), (2, "EVAL")], "t int, s string")
    assert quality.split_overlap(df, "t", "s", "n").first().n == 1


def test_kpi(spark):
    df = spark.createDataFrame([(126.39,), (15.0,), (None,)], "v double")
    got = [(r.estado_kpi, r.variacion_pct) for r in measures.kpi_status(df, "v").collect()]
    assert got == [("rojo", -742.6), ("verde", 0.0), (None, None)]


def test_drill_down_leaves_out_blanks(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 2), (None, None)], "y int, q int")
    got = measures.drill_down(df, ["y", "q"], {"n": F.count(F.lit(1))}, F.col("y").isNotNull()).collect()
    assert sorted((r.nivel, r.n) for r in got) == [(0, 2), (1, 2), (2, 1), (2, 1)]


def test_error_metrics_with_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 3.0)], "a double, p double")
    got = df.agg(*agg.error_metrics("", F.col("a"), F.col("p"))).first()
    assert (got.rmse, got.mae, got.mape_pct) == (1.0, 1.0, 50.0)


def test_one_scan_gives_null_and_rule_lines(spark):
    df = spark.createDataFrame([(1, None), (None, -2.0), (3, 5.0)], "id int, amount double")
    checks = quality.check_table(df, "t", ["id", "amount"], {"negative": F.col("amount") < 0})
    assert [(r.check_name, r.column_name, r.failures) for r in checks.collect()] == [
        ("not_null", "id", 1), ("not_null", "amount", 1), ("rule", "negative", 1)]
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_sketched_percentiles_are_close_to_the_exact_ones(spark):
    df, frame = skewed(spark)
    got = df.agg(F.percentile_approx("v", [0.5, 0.9, 0.99], 10000).alias("p")).first().p
    ranks = [(frame["v"] <= value).mean() for value in got]
    assert all(abs(rank - p) < 2e-3 for rank, p in zip(ranks, (0.5, 0.9, 0.99)))


def plain_history(rows):
    """Versions per key from all rows at once: {(key, version): (value, from, to)}."""
    out, by_key = {}, {}
    for key, at, value in rows:
        by_key.setdefault(key, {})[at] = value
    for key, seen in by_key.items():
        opened = [(at, v) for i, (at, v) in enumerate(sorted(seen.items())) if i == 0 or v != sorted(seen.items())[i - 1][1]]
        for n, (at, v) in enumerate(opened, 1):
            out[key, n] = (v, at, opened[n][0] if n < len(opened) else None)
    return out


def late_rows(spark, rows):
    return spark.createDataFrame(rows, "k int, at int, color string")


def held_history(store):
    return {(r.k, r.version): (r.color, r.valid_from, r.valid_to) for r in store.dimension().collect()}


def test_history_is_the_same_in_any_order_of_arrival(spark, tmp_path, many_slices):
    rng = random.Random(5)
    rows = [(k, at, rng.choice(["red", "blue", None])) for k in (1, 2, 3, None) for at in rng.sample(range(100), 12)]
    rows += [(9, at, rng.choice(["red", "blue"])) for at in range(300)]  # a hot key, over several slices
    for turn in range(2):
        rng.shuffle(rows)
        store = LateHistory(spark, str(tmp_path / str(turn)), "k", ["color"], "at", buckets=4)
        for i in range(0, len(rows), 120):
            store.apply(late_rows(spark, rows[i:i + 120]))
        assert held_history(store) == plain_history(rows)
        assert store.dimension().where("is_current").count() == 5


def test_a_batch_rewrites_its_buckets_only_and_a_failed_one_nothing(spark, tmp_path):
    root = str(tmp_path / "h")
    store = LateHistory(spark, root, "k", ["color"], "at", buckets=16)
    assert store.dimension() is None and store.apply(late_rows(spark, [])) == []
    rows = [(k, 10, "red") for k in range(40)]
    assert len(store.apply(late_rows(spark, rows))) > 8
    before, reader = published(spark, root), store.dimension()
    touched = store.apply(late_rows(spark, [(7, 5, "blue"), (7, 5, "blue")]))
    after = published(spark, root)
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == {f"bucket-{touched[0]}"}
    assert held_history(store) == plain_history([*rows, (7, 5, "blue")]) and reader.count() == 40
    with pytest.raises(ValueError):
        store.apply(late_rows(spark, [(7, None, "x")]))
    broken = late_rows(spark, [(7, 6, "x")]).withColumn("color", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        store.apply(broken)
    assert published(spark, root) == after
    store.apply(late_rows(spark, [(7, 5, "blue")]))
    store.apply(late_rows(spark, [(7, 5, "green")]))  # the later batch stands
    assert held_history(store) == plain_history([*rows, (7, 5, "green")])
    with pytest.raises(ValueError):
        LateHistory(spark, root, "k", ["color"], "at", buckets=8)

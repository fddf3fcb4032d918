import itertools
import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cauce.operators import arima, evaluate, explain, features, model_store, models, series, shapley
from cauce.operators.series import Origin
from cauce.sources import publish, scratch


@pytest.fixture(scope="module")
def view(spark):
    """Labels that follow one number and one category; the other number is noise."""
    rng = np.random.default_rng(3)
    n = 900
    x, noise = rng.uniform(0, 10, n), rng.uniform(0, 10, n)
    place = rng.choice(["A", "B", None], n)
    price = 3 * x + np.where(place == "A", 5, 0) + rng.normal(0, 0.1, n)
    frame = pd.DataFrame({"row": np.arange(n), "x": x, "noise": noise, "place": place, "price": price,
                          "dear": (price > 18).astype(int),
                          "split_set": np.where(np.arange(n) < 600, "TRAIN", np.where(np.arange(n) < 750, "EVAL", "TEST"))})
    frame.loc[5, "x"] = np.nan
    return spark.createDataFrame(frame).withColumn("x", F.nanvl("x", F.lit(None).cast("double")))


PRICE = models.Inputs("price", ("x", "noise"), ("place",))
DEAR = models.Inputs("dear", ("x", "noise"), ("place",))


def test_linear_model_learns_and_explains(spark, view):
    trained = models.fit_linear(view, PRICE, l2=0.001)
    pred = models.score(view.where("split_set = 'TEST'"), trained)
    quality = evaluate.evaluate_regression(pred, "price", "prediction").first()
    assert quality.r2 > 0.99
    weights = {r.variable: r.peso for r in explain.model_weights(spark, trained, view).collect()}
    assert abs(weights["x"] - 3) < 0.1 and abs(weights["noise"]) < 0.1
    info = models.training_info(spark, trained).collect()
    assert info[0].iteration == 0 and info[-1].loss < info[0].loss


def test_tuned_trees_choose_on_eval_and_rank_inputs(spark, view):
    trials = ({"maxDepth": 1, "stepSize": 0.1}, {"maxDepth": 4, "stepSize": 0.3})
    trained = models.fit_gbt_tuned(view, PRICE, trials, trees=8)
    table = models.trial_info(spark, trained).collect()
    assert [r.trial_id for r in table] == [2, 1] and table[0].is_optimal and not table[1].is_optimal
    ranked = explain.feature_importance(spark, trained, view).collect()
    assert ranked[0].feature == "x" and abs(sum(r.porcentaje_contribucion for r in ranked) - 100) < 0.1
    train = view.where("split_set = 'TRAIN'")
    overall = explain.global_explain(view.where("split_set = 'EVAL'"), trained, train, "m").collect()
    assert overall[0].variable == "x"
    rows = explain.explain_rows(view.where("split_set = 'TEST'").limit(5), trained, train, ["row"], 2).collect()
    assert len(rows) == 10 and {r["rank"] for r in rows} == {1, 2}


def test_classifiers(view):
    for trained in (models.fit_logistic(view, DEAR), models.fit_forest_tuned(
            view, DEAR, ({"maxDepth": 4, "numTrees": 5, "subsamplingRate": 0.8},))):
        pred = models.score(view.where("split_set = 'TEST'"), trained, probability=True)
        quality = evaluate.evaluate_classification(pred, "dear", "prediction", "probability_1").first()
        assert quality.accuracy > 0.85 and quality.roc_auc > 0.9


def test_unseen_category_is_scored(spark, view):
    trained = models.fit_linear(view, PRICE)
    new = spark.createDataFrame([(1.0, 2.0, "nowhere")], "x double, noise double, place string")
    assert models.score(new, trained).first().prediction is not None


def test_curve_is_monotone_and_area_matches_pairs(spark):
    rng = np.random.default_rng(5)
    score = np.round(rng.uniform(0, 1, 400), 2)
    label = (rng.uniform(0, 1, 400) < score).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"y": label, "p": score}))
    curve = evaluate.roc_curve(df, "y", "p", 1000).orderBy(F.desc("threshold")).collect()
    assert all(a.recall <= b.recall and a.false_positive_rate <= b.false_positive_rate for a, b in zip(curve, curve[1:]))
    assert curve[-1].recall == 1.0 and curve[-1].true_negatives == 0
    pos, neg = score[label == 1], score[label == 0]
    exact = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    assert abs(evaluate.exact_auc(df, "y", "p").first().roc_auc - exact) < 1e-12


def test_score_that_equals_a_threshold_counts_there(spark):
    df = spark.createDataFrame([(i % 2, i / 100) for i in range(101)], "y int, p double")
    for row in evaluate.roc_curve(df, "y", "p", 100).collect():
        assert row.true_positives + row.false_positives == sum(i / 100 >= row.threshold for i in range(101))


def test_missing_labels_count_in_no_metric(spark):
    rows = [(1, 1.0, 0.9), (0, 0.0, 0.2)]
    with_null = spark.createDataFrame([*rows, (None, 1.0, 0.7)], "y int, c double, p double")
    plain = spark.createDataFrame(rows, "y int, c double, p double")
    got, want = (evaluate.evaluate_classification(x, "y", "c", "p").first() for x in (with_null, plain))
    assert (got.log_loss, got.roc_auc) == (want.log_loss, want.roc_auc)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 1.0, 0.9), (1, 0.0, 0.0)], "y int, c double, p double")
    got = evaluate.evaluate_classification(df, "y", "c", "p").first()
    assert got.accuracy == 0.5 and got.roc_auc is None


def test_split_has_no_overlap(spark):
    days = [date(2022, 9, 15), date(2022, 9, 16), date(2022, 10, 31), date(2022, 11, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    split = features.temporal_split(F.col("d"), date(2022, 9, 16), date(2022, 11, 1))
    assert [r[0] for r in df.select(split).collect()] == ["TRAIN", "EVAL", "EVAL", "TEST"]


def weekly(days=200, start=date(2022, 1, 3), noise=0.0, seed=0):
    rng = np.random.default_rng(seed)
    pattern = [100, 110, 120, 130, 150, 80, 60]
    return [(start + timedelta(days=i), float(pattern[i % 7] + rng.normal(0, noise))) for i in range(days)]


def frame(spark, rows, key="s"):
    return spark.createDataFrame([(key, d, v) for d, v in rows], "k string, day date, n double")


def test_gaps_are_interpolated(spark):
    df = frame(spark, [(date(2024, 1, 1), 10.0), (date(2024, 1, 4), 40.0)])
    got = series.fill_days(df, ["k"], "day", "n").orderBy("day").collect()
    assert [(r.n, r.was_missing) for r in got] == [(10.0, False), (20.0, True), (30.0, True), (40.0, False)]


def test_steady_week_is_continued(spark):
    rows = weekly()
    origin = Origin("w", rows[160][0], 20)
    got = series.rolling_origin(frame(spark, rows), ["k"], "day", "n", [origin]).orderBy("fecha").collect()
    assert len(got) == 20
    assert max(abs(r.error) for r in got if not is_holiday(r.fecha)) < 1.0


def is_holiday(day):
    return day in {date(2022, 6, 19), date(2022, 6, 20), date(2022, 7, 4)}


def test_interval_holds_the_value_and_widens(spark):
    rows = weekly(220, noise=3.0)
    got = series.rolling_origin(frame(spark, rows), ["k"], "day", "n", [Origin("w", rows[180][0], 21)]).orderBy("fecha").collect()
    assert all(r.limite_inferior < r.viajes_predichos < r.limite_superior for r in got)
    widths = [r.limite_superior - r.limite_inferior for r in got]
    assert all(a <= b + 0.2 for a, b in zip(widths, widths[1:])) and widths[-1] > widths[0]


def test_days_without_an_actual_stay_open(spark):
    rows = weekly(100, noise=2.0)
    rolled = series.rolling_origin(frame(spark, rows), ["k"], "day", "n", [Origin("w", rows[-2][0], 31)])
    known = rolled.where("viajes_reales IS NOT NULL")
    assert rolled.count() == 31 and known.count() == 1
    assert series.forecast_metrics(rolled).first().dias_evaluados == 1


def test_many_series_and_windows_in_one_plan(spark):
    both = frame(spark, weekly(noise=2.0), "a").unionByName(frame(spark, weekly(noise=2.0, seed=1), "b"))
    origins = [Origin("w1", date(2022, 4, 1), 10), Origin("w2", date(2022, 5, 1), 5)]
    counts = series.rolling_origin(both, ["k"], "day", "n", origins).groupBy("k", "ventana").count().collect()
    assert {(r.k, r.ventana): r["count"] for r in counts} == {("a", "w1"): 10, ("a", "w2"): 5, ("b", "w1"): 10, ("b", "w2"): 5}


def test_spike_is_an_anomaly(spark):
    rows = weekly(150, noise=2.0)
    rows[100] = (rows[100][0], 500.0)
    got = series.detect_anomalies(frame(spark, rows), ["k"], "day", "n")
    hit = got.where(F.col("fecha") == F.lit(rows[100][0])).first()
    assert hit.is_anomaly and hit.anomaly_probability > 0.999


def test_decomposition_adds_up(spark):
    parts = series.decompose(frame(spark, weekly(60, noise=1.0)), ["k"], "day", "n", 10)
    past = parts.where("tipo = 'history'")
    gap = F.abs(F.col("valor") - sum(F.col(c) for c in ("tendencia", "estacionalidad", "festivo", "pico", "escalon", "residuo")))
    assert past.agg(F.max(gap)).first()[0] < 1e-9 and parts.where("tipo = 'forecast'").count() == 10


def test_spike_step_and_holiday_land_in_their_own_part(spark):
    rows = weekly(500, noise=1.0)
    day = {name: i for i, (d, _) in enumerate(rows) for name, at in (("fourth", date(2022, 7, 4)), ("fourth again", date(2023, 5, 1))) if d == at}
    planted = [(d, v + (400 if i == 90 else 0) + (60 if i >= 300 else 0) + (25 if i == day["fourth"] else 0)) for i, (d, v) in enumerate(rows)]
    got = {r.fecha: r for r in series.decompose(frame(spark, planted), ["k"], "day", "n", 10).where("tipo = 'history'").collect()}
    assert got[rows[90][0]].pico > 380 and got[rows[91][0]].pico < 10
    assert abs(got[rows[250][0]].escalon + 60) < 5 and got[rows[400][0]].escalon == 0
    assert 15 < got[rows[day["fourth"]][0]].festivo < 25
    assert max(abs(r.residuo) for r in got.values()) < 20


def test_each_holiday_has_its_own_effect_also_ahead(spark):
    rows = weekly(1000, start=date(2020, 1, 6), noise=1.0)
    effect = {(7, 4): -30.0, (12, 25): 50.0, (12, 24): 20.0}
    planted = [(d, v + effect.get((d.month, d.day), 0.0)) for d, v in rows]
    training = series.training_sets(frame(spark, planted), ["k"], "day", "n", [Origin("w", date(2022, 6, 20), 200)])
    fits = series.fit_series(training, ["k"], "day", "n")
    held = fits.first().holidays
    assert -30 < held["independence"] < -15 and 40 < held["christmas"] < 52 and 10 < held["christmas-1"] < 21
    ahead = {r.day: r.holiday_effect for r in series.forecast(fits, ["k"], "day").collect()}
    assert ahead[date(2022, 7, 4)] == held["independence"] and ahead[date(2022, 12, 24)] == held["christmas-1"] and ahead[date(2022, 8, 3)] == 0


def test_null_keys_and_several_rows_of_a_day(spark):
    rows = [(None, d, v) for d, v in weekly(60, noise=1.0)]
    data = spark.createDataFrame(rows + [("s", d, v) for _, d, v in rows] + [("s", rows[5][1], rows[5][2] + 2)], "k string, day date, n double")
    filled = series.fill_days(data, ["k"], "day", "n")
    assert filled.count() == 120 and filled.where("was_missing").count() == 0
    assert filled.where("k = 's'").where(F.col("day") == F.lit(rows[5][1])).first().n == rows[5][2] + 1
    assert series.detect_anomalies(data, ["k"], "day", "n").groupBy("k").count().collect().__len__() == 2
    rolled = series.rolling_origin(data, ["k"], "day", "n", [Origin("w", rows[50][1], 5)])
    assert rolled.where("k IS NULL AND viajes_reales IS NOT NULL").count() == 5


def test_days_without_a_value_at_the_ends_stay_open(spark):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(5)]
    df = frame(spark, [(days[0], None), (days[1], 1.0), (days[3], 3.0), (days[4], None)])
    got = series.fill_days(df, ["k"], "day", "n").orderBy("day").collect()
    assert [r.n for r in got] == [None, 1.0, 2.0, 3.0, None] and [r.was_missing for r in got] == [True, False, True, False, True]
    empty = series.fill_days(frame(spark, [(days[0], None), (days[2], None)]), ["k"], "day", "n").collect()
    assert [r.n for r in empty] == [None] * 3


def test_values_after_the_cutoff_change_no_forecast(spark):
    days = [date(2022, 1, 1) + timedelta(days=i) for i in range(120)]
    rows = [(d, 100.0 + 10 * (i % 7) + i % 3) for i, d in enumerate(days) if i not in (89, 90)]
    later = [(d, v * 50 if d > days[89] else v) for d, v in rows]
    origin = [Origin("w", days[89], 14)]
    got = [series.rolling_origin(frame(spark, x), ["k"], "day", "n", origin).orderBy("fecha").collect() for x in (rows, later)]
    assert [r.viajes_predichos for r in got[0]] == [r.viajes_predichos for r in got[1]]
    assert [r.fecha for r in got[0]] == days[90:104]  # days of the window, though the cutoff day has no row


def test_short_and_noise_free_series_stay(spark):
    days = [date(2022, 1, 1) + timedelta(days=i) for i in range(60)]
    short = frame(spark, [(d, 5.0) for d in days[:5]], "short")
    data = short.union(frame(spark, [(d, 20.0) for d in days], "flat"))
    training = series.training_sets(data, ["k"], "day", "n", [Origin("w", series.OPEN_END, 10)])
    fits = series.fit_series(training, ["k"], "day", "n")
    ahead = series.forecast(fits, ["k"], "day").collect()
    assert {(r.k, r.basis) for r in ahead} == {("short", "repeat"), ("flat", "fitted")} and len(ahead) == 20
    assert {r.prediccion for r in ahead if r.k == "short"} == {5.0}
    assert series.fit_quality(fits, ["k"]).count() == 2
    assert series.detect_anomalies(data, ["k"], "day", "n").count() == 65


def test_a_lasting_step_is_taken_out_and_the_forecast_stands_on_the_new_level(spark):
    rows = weekly(150, noise=2.0)
    moved = [(d, n + (80 if i >= 110 else 0)) for i, (d, n) in enumerate(rows)]
    origin = [Origin("w", rows[139][0], 10)]
    fits = [series.fit_series(series.training_sets(frame(spark, x), ["k"], "day", "n", origin), ["k"], "day", "n").first()
            for x in (rows, moved)]
    assert [f.steps for f in fits] == [0, 1] and fits[1].sigma2 < 2 * fits[0].sigma2
    ahead = series.rolling_origin(frame(spark, moved), ["k"], "day", "n", origin).collect()
    assert max(abs(r.error) for r in ahead if not is_holiday(r.fecha)) < 15


def test_spikes_and_noise_are_no_steps(spark):
    rows = weekly(150, noise=2.0)
    rows[60] = (rows[60][0], 900.0)
    training = series.training_sets(frame(spark, rows), ["k"], "day", "n", [Origin("w", series.OPEN_END, 5)])
    assert series.fit_series(training, ["k"], "day", "n").first().steps == 0


def simulated(rng, n, ar=(0.0, 0.0), weekly_ar=0.0, ma=(0.0, 0.0), weekly_ma=0.0, drift=0.0, again=False):
    """A weekly pattern whose differences by a week (once more if ``again``) follow the given terms."""
    e, w = rng.normal(0, 1, n + 30), np.zeros(n + 30)
    for t in range(8, n + 30):
        w[t] = (drift + ar[0] * w[t - 1] + ar[1] * w[t - 2] + weekly_ar * w[t - 7] + e[t] + ma[0] * e[t - 1] + ma[1] * e[t - 2] + weekly_ma * e[t - 7])
    z = np.cumsum(w[30:]) if again else w[30:]
    out = 5000.0 + 50 * (np.arange(n) % 7)
    for i in range(7, n):
        out[i] = out[i - 7] + z[i]
    return out


def test_orders_and_coefficients_of_simulated_series_are_found(spark):
    rng = np.random.default_rng(4)
    n = 1500
    planted = {"white": {}, "ar1": {"ar": (0.6, 0.0)}, "ma1": {"ma": (0.6, 0.0)}, "weekly_ma": {"weekly_ma": -0.6}, "weekly_ar": {"weekly_ar": 0.5},
               "drift": {"ar": (0.5, 0.0), "drift": 0.5}, "again": {"ma": (0.4, 0.0), "again": True}}
    days = [date(2018, 1, 1) + timedelta(days=i) for i in range(n)]
    rows = [(k, d, float(v)) for k, terms in planted.items() for d, v in zip(days, simulated(rng, n, **terms))]
    training = series.training_sets(spark.createDataFrame(rows, "k string, day date, n double"), ["k"], "day", "n", [Origin("w", series.OPEN_END, 5)])
    fits = {r.k: r for r in series.fit_series(training, ["k"], "day", "n").collect()}
    found = {k: dict(zip(arima.TERMS, r.coefficients)) for k, r in fits.items()}
    # the test for a steady level errs now and then on lags that hang together
    steady = {k for k, r in fits.items() if r.d == 0}
    assert "again" not in steady and len(steady) >= 5
    assert fits["white"].n_terms <= 1 and all(0.8 < fits[k].sigma2 < 1.2 for k in steady)
    for name, term, value in (("ar1", "ar1", 0.6), ("ma1", "ma1", 0.6), ("weekly_ma", "sma1", -0.6), ("weekly_ar", "sar1", 0.5), ("drift", "drift", 0.5)):
        assert name not in steady or abs(found[name][term] - value) < 0.25


def test_elimination_solves_the_chosen_columns_only(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=50)
    full = np.column_stack([x, y])
    matrix = F.lit((full.T @ full).tolist())
    a = spark.range(1).select(arima.swept(matrix, F.lit([0, 2])).alias("a")).first().a
    want, sse, _, _ = np.linalg.lstsq(x[:, [0, 2]], y, rcond=None)
    assert np.allclose([a[0][3], a[2][3], a[3][3]], [*want, sse[0]])
    twice = np.column_stack([x[:, 0], x[:, 0], y])
    none = spark.range(1).select(arima.swept(F.lit((twice.T @ twice).tolist()), F.lit([0, 1])).alias("a")).first().a
    assert none[2][2] is None


def test_projection_and_impulse_follow_the_recursion(spark):
    c = [0.3, 0.5, -0.2, 0.1, 0.4, 0.2, -0.3]
    w, e, y = ([float(v) for v in np.random.default_rng(k).normal(size=7)] for k in range(3))
    args = [F.lit(v) for v in (w, e)] + [F.lit(0.7), F.lit(y), F.lit(c), F.lit(1), F.lit(c[0])]
    row = spark.range(1).select(arima.projected(F.lit(10), *args).alias("p"), arima.impulse(F.lit(10), F.lit(c), F.lit(1)).alias("s")).first()

    def follow(w, e, z, y, drift):
        out, w, e, y = [], list(w), list(e), list(y)
        for _ in range(10):
            new = drift + c[1] * w[0] + c[2] * w[1] + c[3] * w[6] + c[4] * e[0] + c[5] * e[1] + c[6] * e[6]
            z += new
            w, e, y = [new, *w[:6]], [0.0, *e[:6]], [y[6] + z, *y[:6]]
            out.append(y[0])
        return out

    one = [1.0] + [0.0] * 6
    assert np.allclose(row.p, follow(w, e, 0.7, y, c[0])) and np.allclose(row.s, [1.0, *follow(one, one, 1.0, one, 0.0)])


def test_explanations_of_rows_that_share_a_key_stay_apart(spark):
    view = spark.createDataFrame([(i % 2, float(i), float(2 * i), "a", "TRAIN" if i % 3 else "EVAL") for i in range(60)],
                                 "key int, x double, fare double, c string, split_set string")
    trained = models.fit_linear(view, models.Inputs("fare", ("x",), ("c",)))
    got = explain.explain_rows(view.limit(14), trained, view, ["key"], 2).collect()
    assert len(got) == 28


def test_trees_take_categories_of_any_number(spark):
    view = spark.createDataFrame([(float(i % 7), float(i % 200), f"c{i % 200}", "TRAIN" if i % 3 else "EVAL") for i in range(900)],
                                 "x double, fare double, c string, split_set string")
    trained = models.fit_gbt_tuned(view, models.Inputs("fare", ("x",), ("c",)), trials=({"maxDepth": 2},), trees=2)
    assert len(trained.trials) == 1


def test_models_are_published_and_read_in_another_session(spark, tmp_path):
    root = str(tmp_path)
    view = spark.createDataFrame([(float(i % 7), float(3 * (i % 7) + 1), i % 2, f"c{i % 3}", "TRAIN" if i % 3 else "EVAL") for i in range(300)],
                                 "x double, fare double, y int, c string, split_set string")
    fitted = {"line": models.fit_linear(view, models.Inputs("fare", ("x",), ("c",))),
              "trees": models.fit_gbt_tuned(view, models.Inputs("fare", ("x",), ("c",)), trials=({"maxDepth": 2}, {"maxDepth": 3}), trees=2),
              "classes": models.fit_logistic(view, models.Inputs("y", ("x",), ("c",)))}
    other = spark.newSession()
    for name, trained in fitted.items():
        model_store.publish_model(spark, root, name, trained)
        again = model_store.load_model(other, root, name)
        assert again.inputs == trained.inputs and again.history == trained.history and again.trials == trained.trials
        assert models.score(view, again).collect() == models.score(view, trained).collect()
    before = publish.published(spark, root)["line"]
    model_store.publish_model(spark, root, "line", models.fit_linear(view, models.Inputs("fare", ("x",), ())))
    assert publish.published(spark, root)["line"] != before and model_store.load_model(spark, root, "line").inputs.categorical == ()
    with pytest.raises(KeyError):
        model_store.load_model(spark, root, "none")


def by_subsets(spark, trained, path, x):
    """Shapley values of one row by all coalitions: inputs outside of one follow the counts of both branches."""
    trained.model.write().save(path)
    nodes = {(r.treeID, r.id): r for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()}
    forest = type(trained.model).__name__.startswith("RandomForest")

    def worth(tree, at, inside):
        node = nodes[tree, at]
        if node.leftChild < 0:
            return node.impurityStats[1] / sum(node.impurityStats) if forest else node.prediction
        ways = [worth(tree, c, inside) for c in (node.leftChild, node.rightChild)]
        slot, split, categories = node.split
        if slot in inside:
            return ways[0] if (x[slot] in split if categories >= 0 else x[slot] <= split[0]) else ways[1]
        n = [nodes[tree, c].rawCount for c in (node.leftChild, node.rightChild)]
        return (n[0] * ways[0] + n[1] * ways[1]) / sum(n)

    def game(inside):
        trees = sorted({t for t, _ in nodes})
        weights = [1 / len(trees)] * len(trees) if forest else trained.model.treeWeights
        return sum(w * worth(t, 0, inside) for t, w in zip(trees, weights))

    d, out = len(x), []
    for j in range(d):
        others = [i for i in range(d) if i != j]
        out.append(sum(math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) * (game({*s, j}) - game(set(s)))
                       for k in range(d) for s in itertools.combinations(others, k)))
    return out, game(set())


def test_attributions_of_trees_equal_all_coalitions(spark, view, tmp_path):
    train, rows = view.where("split_set = 'TRAIN'"), view.where("split_set = 'TEST'").orderBy("row").limit(6)
    for name, trained in (("boosted", models.fit_gbt_tuned(view, PRICE, ({"maxDepth": 4, "stepSize": 0.3},), trees=4)),
                          ("forest", models.fit_forest_tuned(view, DEAR, ({"maxDepth": 5, "numTrees": 4, "subsamplingRate": 0.8},)))):
        got = {r.row: r for r in shapley.attributions(rows, trained, train, ["row"]).collect()}
        slots = {r.row: r.features.toArray() for r in trained.prepare.transform(rows).collect()}
        assert len(got) == 6
        for i, (row, r) in enumerate(sorted(got.items())):
            want, base = by_subsets(spark, trained, f"{tmp_path}/{name}{i}", slots[row])
            assert np.allclose(r.attributions, want, atol=1e-12) and abs(r.base - base) < 1e-12
            assert abs(r.base + sum(r.attributions) - r.score) < 1e-12


def test_attributions_of_linear_models_add_up(spark, view):
    train, rows = view.where("split_set = 'TRAIN'"), view.where("split_set = 'TEST'")
    line = models.fit_linear(view, PRICE, l2=0.001)
    got = shapley.attributions(rows, line, train, ["row", "x"]).collect()
    assert max(abs(r.base + sum(r.attributions) - r.score) for r in got) < 1e-9
    mean = train.agg(F.avg("x")).first()[0]
    weight = {r.variable: r.peso for r in explain.model_weights(spark, line, view).collect()}["x"]
    assert all(abs(r.attributions[0] - weight * (r.x - mean)) < 1e-3 for r in got)
    odds = shapley.attributions(rows, models.fit_logistic(view, DEAR), train).collect()
    assert max(abs(r.base + sum(r.attributions) - r.score) for r in odds) < 1e-9


def test_attributions_of_missing_and_repeated_rows_and_of_none(spark, view):
    trained = models.fit_gbt_tuned(view, PRICE, ({"maxDepth": 3, "stepSize": 0.3},), trees=2)
    rows = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (2, 3.0, 1.0, "new")], "score int, x double, noise double, place string")
    got = shapley.attributions(rows.withColumnRenamed("score", "key"), trained, view, ["key"]).orderBy("key").collect()
    assert len(got) == 3 and got[0] == got[1] and all(abs(r.base + sum(r.attributions) - r.score) < 1e-12 for r in got)
    assert shapley.attributions(rows.limit(0), trained, view).count() == 0


def random_tree(rng, depth, slots):
    """A full tree over a few slots, so that paths ask for one more than once; the last slot holds categories 0 to 4."""
    nodes, todo = {}, [(0, 0, 1000.0)]
    while todo:
        at, level, n = todo.pop()
        leaf = level == depth or (level > 2 and rng.random() < 0.2)
        slot = int(rng.integers(slots))
        split = dict(featureIndex=slot, numCategories=5, leftCategoriesOrThreshold=[float(c) for c in range(5) if rng.random() < 0.5]) \
            if slot == slots - 1 else dict(featureIndex=slot, numCategories=-1, leftCategoriesOrThreshold=[rng.random()])
        nodes[at] = dict(id=at, prediction=rng.normal(), impurityStats=[], rawCount=n, leftChild=-1 if leaf else 2 * at + 1,
                         rightChild=-1 if leaf else 2 * at + 2, split=split)
        if not leaf:
            part = rng.uniform(0.1, 0.9)
            todo += [(2 * at + 1, level + 1, n * part), (2 * at + 2, level + 1, n * (1 - part))]
    return nodes


def flat(nodes, slots):
    """The leaves of a tree as the flat form states them."""
    value, start, conditions, sets, todo = [], [0], [], [], [(0, {})]
    while todo:
        at, met = todo.pop()
        node = nodes[at]
        if node["leftChild"] < 0:
            value.append(node["prediction"])
            for slot, (low, high, kept, share) in sorted(met.items()):
                conditions.append((slot, low, high, -1 if kept is None else len(sets), share))
                if kept is not None:
                    sets.append(kept)
            start.append(len(conditions))
            continue
        slot, split = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"]
        low, high, kept, share = met.get(slot, (-np.inf, np.inf, None, 1.0))
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            part = share * nodes[child]["rawCount"] / node["rawCount"]
            if slot == slots - 1:
                way = np.isin(np.arange(5), split) == left
                todo.append((child, {**met, slot: (low, high, way if kept is None else kept & way, part)}))
            else:
                todo.append((child, {**met, slot: (low, min(high, split[0]), None, part) if left else (max(low, split[0]), high, None, part)}))
    kinds = (np.int32, float, float, np.int32, float)
    return shapley.Leaves(np.array(value), np.array(start), *[np.array(c, k) for c, k in zip(zip(*conditions), kinds)], tuple(sets))


@pytest.mark.parametrize("n", [0, 3, 5000])
def test_blocks_of_any_size_agree_with_the_flat_leaves(n):
    rng = np.random.default_rng(5)
    nodes = random_tree(rng, 9, 6)
    tree, leaf = shapley.build_tree(nodes, 1.0, False), flat(nodes, 6)
    x = rng.uniform(0, 1, (6, n))
    x[5] = rng.integers(0, 5, n)
    assert abs(tree.base() - leaf.base()) < 1e-12
    assert np.allclose(shapley.tree_values(x, tree), shapley.shapley_values(x, leaf), atol=1e-12)


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_the_nodes_of_the_trees_stay_off_the_driver(spark, view, monkeypatch, kind):
    """The driver gets a row for each tree at a time, and no more of them than fit its part."""
    trained = models.fit_gbt_tuned(view, PRICE, ({"maxDepth": 6, "stepSize": 0.3},), trees=5) if kind == "boosted" else \
        models.fit_forest_tuned(view, DEAR, ({"maxDepth": 8, "numTrees": 5, "subsamplingRate": 0.8},))
    train, rows = view.where("split_set = 'TRAIN'"), view.where("split_set = 'TEST'")
    got, collect = [], type(view).collect
    monkeypatch.setattr(type(view), "collect", lambda df: got.append(collect(df)) or got[-1])
    monkeypatch.setattr(shapley, "PART", 1, raising=False)
    each = shapley.attributions(rows, trained, train)
    assert max(map(len, got)) <= trained.model.getNumTrees < trained.model.totalNumNodes
    assert sum("packed" in r for found in got for r in found) == trained.model.getNumTrees
    assert max(sum("packed" in r for r in found) for found in got) == 1
    assert max(abs(r.base + sum(r.attributions) - r.score) for r in collect(each)) < 1e-12


def test_a_loaded_model_is_explained_without_saving_it_again(spark, view, tmp_path, monkeypatch):
    trained = models.fit_gbt_tuned(view, PRICE, ({"maxDepth": 3, "stepSize": 0.3},), trees=3)
    root = model_store.publish_model(spark, str(tmp_path), "boosted", trained)
    loaded, rows = model_store.load_model(spark, str(tmp_path), "boosted"), view.where("split_set = 'TEST'")
    want = [tuple(r) for r in shapley.attributions(rows, trained, view, ["row"]).orderBy("row").collect()]
    with monkeypatch.context() as m:
        m.setattr(type(loaded.model), "write", lambda model: pytest.fail("saved again"))
        assert [tuple(r) for r in shapley.attributions(rows, loaded, view, ["row"]).orderBy("row").collect()] == want
    scratch.remove(spark, root)  # as a vacuum of old versions does
    assert [tuple(r) for r in shapley.attributions(rows, loaded, view, ["row"]).orderBy("row").collect()] == want


def test_many_conditions_on_a_path_agree_with_few_rows_and_many():
    rng = np.random.default_rng(2)
    d = 9
    leaf = shapley.Leaves(np.array([2.0]), np.array([0, d]), np.arange(d, dtype=np.int32), np.full(d, -np.inf), rng.uniform(0, 1, d),
                          np.full(d, -1, np.int32), rng.uniform(0.05, 1, d), ())
    x = rng.uniform(0, 1, (d, 2000))
    every = shapley.shapley_values(x, leaf)
    assert np.allclose(every[:, :50], shapley.shapley_values(x[:, :50], leaf), atol=1e-13)
    game = 2.0 * np.all(x <= leaf.high[:, None], axis=0)
    assert np.allclose(every.sum(axis=0) + leaf.base(), game, atol=1e-12)

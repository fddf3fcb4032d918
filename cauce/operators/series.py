"""Daily series: gap filling, seasonal forecasts with intervals, backtests, decomposition, anomalies.

Per series and training window: gaps are interpolated, holidays, lasting steps and spikes taken out,
then a seasonal ARIMA of searched order is fitted (``operators.arima``). All windows run in one plan.
Every Spark window below spans the days of one series, a number bounded by the calendar; frames
only look back, so the work per day does not grow with the series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from cauce.functions.casts import steady_round
from cauce.functions.dates import near_us_holiday
from cauce.operators import arima
from cauce.operators.aggregates import coverage_pct, error_metrics
from cauce.operators.joins import join_null_safe
from cauce.sources.scratch import materialise

WEEK = 7


@dataclass(frozen=True)
class Origin:
    """A training window that ends at ``cutoff`` and is projected ``horizon`` days ahead."""

    name: str
    cutoff: date
    horizon: int


# The four expanding windows of the yearly backtest.
ORIGINS = (Origin("R1_pron_sep", date(2022, 8, 31), 30), Origin("R2_pron_oct", date(2022, 9, 30), 31),
           Origin("R3_pron_nov", date(2022, 10, 31), 30), Origin("R4_pron_dic", date(2022, 11, 30), 31))


#: Cutoff of a window that takes the whole series.
OPEN_END = date(9999, 12, 31)


def normal_quantile(confidence: float) -> float:
    """Two-sided normal quantile by bisection of the error function."""
    low, high = 0.0, 10.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if math.erf(middle / math.sqrt(2)) < confidence else (low, middle)
    return (low + high) / 2


def central_probability(z: Column) -> Column:
    """P(|Z| <= z) for z >= 0, by the rational approximation of erf (error below 2e-7)."""
    x = z / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return 1 - poly * F.exp(-(x * x))


def fill_days(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """One row per day and series; missing days are interpolated between their neighbours.

    Days before the first and after the last known value stay NULL. Rows of one day and series are
    averaged; NULL keys are a series like any other, rows without a day are left out.
    """
    keys = list(keys)
    daily = df.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.avg(F.col(value).cast("double")).alias(value))
    whole = Window.partitionBy(*keys)
    bounds = daily.withColumns({"_a": F.min(day).over(whole), "_b": F.max(day).over(whole), "_any": F.max(value).over(whole)})
    known = bounds.where(F.col(value).isNotNull() | (F.col("_any").isNull() & (F.col(day) == F.col("_a"))))
    order = whole.orderBy(day)
    paired = known.withColumns({"_next": F.lead(day).over(order), "_v1": F.lead(value).over(order), "_first": F.lag(day).over(order).isNull()})
    start = F.when(F.col("_first"), F.col("_a")).otherwise(F.col(day))
    stop = F.coalesce(F.date_sub("_next", 1), F.col("_b"))
    spread = paired.withColumn("_day", F.explode(F.sequence(start, stop)))
    part = F.try_divide(F.date_diff("_day", day), F.date_diff("_next", day))
    filled = F.when(F.col("_day") == F.col(day), F.col(value)).when(
        F.col("_day") > F.col(day), F.col(value) + (F.col("_v1") - F.col(value)) * part)
    missing = (F.col("_day") != F.col(day)) | F.col(value).isNull()
    return spread.select(*keys, F.col("_day").alias(day), filled.alias(value), missing.alias("was_missing"))


def _windows(df: DataFrame, day: str, origins: Sequence[Origin]) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(o.name).alias("ventana"), F.lit(o.cutoff).alias("_cutoff"),
                 F.lit(o.horizon).alias("_horizon")) for o in origins])
    spread = df.withColumn("_w", F.explode(entries)).select(*df.columns, "_w.*")
    return spread.where(F.col(day) <= F.col("_cutoff"))


def _level_steps(df: DataFrame, group: list[str], day: str, value: str, limit: float = 3.0,
                 least: float = 0.1) -> DataFrame:
    """Lift the days before a lasting change of level by its size, ``_lift``; ``_steps`` counts the changes.

    A step begins where the median of the seven weekly differences from that day on, less the usual
    one, is beyond ``limit`` scaled median deviations and ``least`` of the mean level, and no day
    less than a week away moves more. A series whose differences have no spread is left as it is.
    """
    whole = Window.partitionBy(*group)
    order = whole.orderBy(day)
    ahead = order.rowsBetween(0, WEEK - 1)
    diffed = df.withColumn("_x", F.col(value) - F.lag(value, WEEK).over(order))
    centred = diffed.withColumn("_x", F.col("_x") - F.median("_x").over(whole))
    ranked = F.sort_array(F.collect_list("_x").over(ahead))
    moved = centred.withColumns({
        "_mad": 1.4826 * F.median(F.abs("_x")).over(whole), "_level": F.abs(F.avg(value).over(whole)),
        "_move": F.when(F.size(ranked) == WEEK, F.get(ranked, F.lit(WEEK // 2))),
        "_score": F.abs(F.round(F.avg("_x").over(ahead), 6))})
    large = (F.col("_mad") > 0) & (F.abs("_move") > F.greatest(limit * F.col("_mad"), least * F.col("_level")))
    gated = moved.withColumn("_score", F.when(large, F.col("_score")))
    before = F.max("_score").over(order.rowsBetween(1 - WEEK, -1))
    after = F.max("_score").over(order.rowsBetween(1, WEEK - 1))
    peak = (F.col("_score") > F.coalesce(before, F.lit(-1.0))) & (F.col("_score") >= F.coalesce(after, F.lit(-1.0)))
    stepped = gated.withColumn("_step", F.coalesce(F.when(peak, F.col("_move")), F.lit(0.0)))
    so_far = F.sum("_step").over(order.rowsBetween(Window.unboundedPreceding, 0))
    lifted = stepped.withColumn("_lift", F.sum("_step").over(whole) - so_far)
    return lifted.withColumns({value: F.col(value) + F.col("_lift"), "_steps": F.count(F.when(F.col("_step") != 0, 1)).over(whole)}).drop(
        "_x", "_mad", "_level", "_move", "_score", "_step")


def _beside(value: Column, day: str, group: list[str]) -> Column:
    """Values of the same weekday in the three weeks before and after, without NULLs, in order of size."""
    order = Window.partitionBy(*group).orderBy(day)
    near = [F.lag(value, WEEK * k).over(order) for k in (1, 2, 3)] + [F.lead(value, WEEK * k).over(order) for k in (1, 2, 3)]
    return F.sort_array(F.array_compact(F.array(*near)))


def _middle(values: Column) -> Column:
    """Median of a sorted array, NULL for an empty one."""
    n = F.size(values)
    return F.when(n > 0, (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2)


def _clip_spikes(df: DataFrame, group: list[str], day: str, value: str, limit: float = 3.0) -> DataFrame:
    """Bring values back to within ``limit`` scaled median deviations of the same weekday around; keep what is cut off as ``_spike``.

    A series of which more than half the days do not deviate at all is left as it is.
    """
    usual = df.withColumn("_usual", _middle(_beside(F.col(value), day, group)))
    deviation = F.col(value) - F.col("_usual")
    bounded = usual.withColumn("_tol", limit * 1.4826 * F.median(F.abs(deviation)).over(Window.partitionBy(*group)))
    clipped = F.greatest(F.col("_usual") - F.col("_tol"), F.least(F.col("_usual") + F.col("_tol"), F.col(value)))
    kept = F.when(F.col("_tol") > 0, F.coalesce(clipped, F.col(value))).otherwise(F.col(value))
    cut = bounded.withColumn("_kept", kept)
    return cut.withColumn("_spike", F.col(value) - F.col("_kept")).withColumn(value, F.col("_kept")).drop("_usual", "_tol", "_kept")


#: What a holiday's mean deviation is shrunk by: one observation keeps 1 / (1 + RIDGE) of it.
RIDGE = 0.25


def _remove_holidays(df: DataFrame, group: list[str], day: str, value: str) -> DataFrame:
    """Take each holiday's own effect out, also that of the days before and after; ``_tag`` names the holiday, ``_holiday`` is the effect.

    Effects are the ridge regression of the deviations from the same weekday around (without such days) on one
    indicator per holiday and day; no day has two of them, so its normal equations are diagonal.
    """
    tagged = df.withColumn("_tag", near_us_holiday(F.col(day)))
    near = _beside(F.when(F.col("_tag").isNull(), F.col(value)), day, group)
    usual = F.when(F.size(near) > 0, F.aggregate(near, F.lit(0.0), lambda a, x: a + x) / F.size(near))
    marked = tagged.withColumn("_off", F.when(F.col("_tag").isNotNull(), F.col(value) - usual))
    same = Window.partitionBy(*group, "_tag")
    effect = F.when(F.col("_tag").isNotNull(), F.sum("_off").over(same) / (F.count("_off").over(same) + RIDGE))
    met = marked.withColumn("_holiday", F.coalesce(effect, F.lit(0.0))).drop("_off")
    return met.withColumn(value, F.col(value) - F.col("_holiday"))


def training_sets(df: DataFrame, keys: Sequence[str], day: str, value: str,
                  origins: Sequence[Origin]) -> DataFrame:
    """Adjusted series per window, with what each adjustment took out and the differences to model.

    ``_raw`` less ``_holiday`` and ``_spike`` plus ``_lift`` is the adjusted value. Each window is cut
    at its cutoff first and only then filled, so no later value reaches a fit. Written once, since
    the fit, the decomposition and the anomalies all read it. Days without a value at an end of a
    series are left out.
    """
    group = [*keys, "ventana"]
    cut = arima.spread_out(_windows(df.select(*keys, day, value), day, origins), [*group, "_cutoff", "_horizon"])
    filled = fill_days(cut, [*group, "_cutoff", "_horizon"], day, value).where(F.col(value).isNotNull()).withColumn("_raw", F.col(value))
    steady = _level_steps(_remove_holidays(filled, group, day, value), group, day, value)
    adjusted = _clip_spikes(steady, group, day, value)
    return materialise(arima.differenced(adjusted, group, day, value), "training")


def fit_series(training: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """One row per series and window: the order with the least AIC, its coefficients, and what a projection starts from.

    ``model`` is ``(p,q)(P,Q)`` with ``+drift`` where one is fitted, over weekly differences that are
    differenced once more where ``d`` is 1; ``coefficients`` are those of ``arima.TERMS``; of equal
    orders the one with fewer coefficients is taken. The variance is NULL with fewer than three days to fit.
    ``holidays`` maps a tag to its effect; ``steps`` and ``spikes`` count what was taken out.
    """
    group = [*keys, "ventana"]
    tag = F.struct(F.col("_tag").alias("key"), F.col("_holiday").alias("value"))
    more = [F.max("_horizon").alias("_horizon"), F.max("_cutoff").alias("_cutoff"), F.max("_steps").alias("steps"),
            F.count(F.when(F.abs("_spike") > 1e-9, 1)).alias("spikes"),
            F.map_from_entries(F.collect_set(F.when(F.col("_tag").isNotNull(), tag))).alias("holidays")]
    fits = arima.fit_orders(arima.with_shocks(training, group, day), group, day, value, more)
    variance = F.when(F.col("n") > 2, F.col("sse") / F.greatest(F.lit(1), F.col("n") - F.col("n_terms")))
    return materialise(fits.withColumn("sigma2", variance), "fits")  # a row per series and window, read several times


def _effect(holidays: Column, day: Column) -> Column:
    return F.coalesce(F.try_element_at(holidays, near_us_holiday(day)), F.lit(0.0))


def forecast(fits: DataFrame, keys: Sequence[str], day: str, confidence: float = 0.95) -> DataFrame:
    """Projected value with interval for each day of the horizon, counted from the window's cutoff.

    ``holiday_effect`` is the part of the value that a holiday adds. A series too short to fit
    repeats its last week, or its mean on weekdays it has not had, without bounds; ``basis`` tells
    the two apart.
    """
    group = [*keys, "ventana"]
    known = F.col("n") > 2
    # days without a row before the cutoff are stepped over
    gap = F.when(F.col("_cutoff") < F.lit(OPEN_END), F.date_diff("_cutoff", "last_day")).otherwise(0)
    none = F.array_repeat(F.lit(0.0), len(arima.TERMS))
    usable = fits.withColumns({
        "basis": F.when(known, "fitted").otherwise("repeat"), "_gap": gap, "_steps": F.col("_horizon") + gap,
        "_c": F.when(known, F.col("coefficients")).otherwise(none), "_again": F.when(known, F.col("d")).otherwise(0)})
    ahead = arima.projected(F.col("_steps"), F.col("last_w"), F.col("last_e"), F.get("last_z", F.lit(0)), F.col("last_y"), F.col("_c"),
                            F.col("_again"), F.get("_c", F.lit(0)))
    shock = arima.impulse(F.col("_steps"), F.col("_c"), F.col("_again"))
    spread = usable.withColumns({"_values": ahead, "_psi": shock}).select(*group, "last_day", "holidays", "sigma2", "basis", "_gap", "_psi", F.posexplode("_values").alias("_h", "_value"))
    so_far = F.aggregate(F.slice("_psi", F.lit(1), F.col("_h") + 1), F.lit(0.0), lambda a, x: a + x * x)
    target = F.date_add("last_day", F.col("_h") + 1)
    dated = spread.where(F.col("_h") >= F.col("_gap")).withColumns({day: target, "_var": F.when(F.col("basis") == "fitted", F.col("sigma2") * so_far)})
    effect = _effect(F.col("holidays"), F.col(day))
    reach = normal_quantile(confidence) * F.sqrt("_var")
    centre = F.col("_value") + effect
    return dated.select(*group, day, centre.alias("prediccion"), (centre - reach).alias("limite_inferior"),
                        (centre + reach).alias("limite_superior"), "basis", effect.alias("holiday_effect"))


def rolling_origin(df: DataFrame, keys: Sequence[str], day: str, value: str,
                   origins: Sequence[Origin] = ORIGINS, confidence: float = 0.95) -> DataFrame:
    """Forecasts of all windows against what came; days without an actual keep NULL errors."""
    training = training_sets(df, keys, day, value, origins)
    predicted = forecast(fit_series(training, keys, day, value), keys, day, confidence)
    actual = df.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.avg(value).cast(df.schema[value].dataType).alias("viajes_reales"))
    error = F.col("prediccion") - F.col("viajes_reales")
    return join_null_safe(predicted, actual, [*keys, day], "left").select(
        *keys, "ventana", F.col(day).alias("fecha"), steady_round("prediccion", 1).alias("viajes_predichos"),
        steady_round("limite_inferior", 1).alias("limite_inferior"),
        steady_round("limite_superior", 1).alias("limite_superior"), "viajes_reales",
        steady_round(error, 1).alias("error"),
        steady_round(F.try_divide(error, F.col("viajes_reales")), 4).alias("error_pct"))


def forecast_metrics(rolled: DataFrame, by: Sequence[str] = ("ventana",), digits: int = 1) -> DataFrame:
    """Days with actuals, RMSE, MAE, MAPE and interval coverage per window."""
    actual, predicted = F.col("viajes_reales"), F.col("viajes_predichos")
    rmse, mae, _ = error_metrics("_viajes", actual, predicted, digits)
    return rolled.where(actual.isNotNull()).groupBy(*by).agg(
        F.count(actual).alias("dias_evaluados"), rmse, mae,
        steady_round(100 * F.avg(F.abs("error_pct")), 2).alias("mape_pct"),
        coverage_pct(actual, F.col("limite_inferior"), F.col("limite_superior")).alias("cobertura_ic_pct"),
    ).orderBy(*by)


def fit_quality(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Observations, chosen order, variance, log-likelihood and AIC per window, and which adjustments were made.

    Likelihood and AIC are NULL for a series without noise or too short for a variance.
    """
    n, k = F.col("n"), F.col("n_terms")
    spread = F.when(n > 2, F.try_divide(F.col("sse"), n))
    likelihood = F.when(spread > 0, -n / 2 * (F.ln(2 * math.pi * spread) + 1))
    order = lambda at: F.substring("model", at, 1).cast("int")
    return fits.select(
        *keys, "ventana", "n", "model", order(2).alias("p"), "d", order(4).alias("q"), order(7).alias("seasonal_p"), order(9).alias("seasonal_q"),
        F.col("model").endswith("+drift").alias("has_drift"), F.col("sigma2").alias("variance"),
        likelihood.alias("log_likelihood"), (2 * (k + 1) - 2 * likelihood).alias("aic"),
        (F.size("holidays") > 0).alias("has_holiday_effect"), (F.col("spikes") > 0).alias("has_spikes_and_dips"),
        (F.col("steps") > 0).alias("has_step_changes"))


#: Days on either side that the local regression of a trend looks at, and the rounds of its reweighting.
REACH, ROUNDS = 14, 3


def _local_line(points: Column, at: Column) -> Column:
    """The value at day number ``at`` of a line through ``points`` (day ``t``, value ``x``, weight ``u``), near ones
    counting more (tricube)."""
    kernel = F.array(*[F.lit((1 - (k / REACH) ** 3) ** 3) for k in range(REACH)])
    placed = F.transform(points, lambda p: F.struct(
        (p["t"] - at).cast("double").alias("o"), (F.get(kernel, F.abs(p["t"] - at)) * p["u"]).alias("w"), p["x"].alias("x")))

    def add(a: Column, p: Column) -> Column:
        return F.struct((a["s0"] + p["w"]).alias("s0"), (a["s1"] + p["w"] * p["o"]).alias("s1"), (a["s2"] + p["w"] * p["o"] * p["o"]).alias("s2"),
                        (a["t0"] + p["w"] * p["x"]).alias("t0"), (a["t1"] + p["w"] * p["o"] * p["x"]).alias("t1"))

    def line(a: Column) -> Column:
        det = a["s0"] * a["s2"] - a["s1"] * a["s1"]
        return F.when(det > 1e-9 * a["s0"] * a["s0"], (a["s2"] * a["t0"] - a["s1"] * a["t1"]) / det).otherwise(F.try_divide(a["t0"], a["s0"]))

    return F.aggregate(placed, F.struct(*[F.lit(0.0).alias(c) for c in ("s0", "s1", "s2", "t0", "t1")]), add, line)


def trend_and_season(df: DataFrame, group: list[str], day: str, value: str) -> DataFrame:
    """Add ``_trend`` and ``_season``: a robust local line and the week's pattern around it, fitted in turns.

    Every round fits lines to the values without season, then the season (one number per weekday, with
    mean zero) to the values without trend, and weighs days less the more they stand out.
    """
    whole = Window.partitionBy(*group)
    order = whole.orderBy(day).rowsBetween(1 - REACH, REACH - 1)
    weekday = Window.partitionBy(*group, "_dow")
    now = df.withColumns({"_t": F.date_diff(F.col(day), F.lit(date(1970, 1, 1))), "_dow": F.dayofweek(day),
                          "_season": F.lit(0.0), "_u": F.lit(1.0)})
    for _ in range(ROUNDS):
        points = F.collect_list(F.struct(F.col("_t").alias("t"), (F.col(value) - F.col("_season")).alias("x"), F.col("_u").alias("u"))).over(order)
        lined = now.withColumn("_points", points).withColumn("_trend", F.coalesce(_local_line(F.col("_points"), F.col("_t")), F.col(value))).drop("_points")
        mean = F.try_divide(F.sum(F.col("_u") * (F.col(value) - F.col("_trend"))).over(weekday), F.sum("_u").over(weekday))
        patterned = lined.withColumn("_season", F.coalesce(mean, F.lit(0.0)))
        seasons = [F.max(F.when(F.col("_dow") == k, F.col("_season"))).over(whole) for k in range(1, WEEK + 1)]
        level = F.aggregate(F.array_compact(F.array(*seasons)), F.lit(0.0), lambda a, x: a + x) / F.size(F.array_compact(F.array(*seasons)))
        centred = patterned.withColumn("_mean", level).withColumn("_season", F.col("_season") - F.col("_mean")).drop("_mean")
        left = centred.withColumn("_left", F.abs(F.col(value) - F.col("_trend") - F.col("_season")))
        limited = left.withColumn("_limit", 6 * F.median("_left").over(whole))
        ratio = F.col("_left") / F.col("_limit")
        now = limited.withColumn("_u", F.when(F.col("_limit") <= 1e-9, 1.0).when(ratio < 1, (1 - ratio * ratio) * (1 - ratio * ratio)).otherwise(0.0)).drop("_left", "_limit")
    return now.drop("_t", "_u")


def decompose(df: DataFrame, keys: Sequence[str], day: str, value: str, horizon: int = 30) -> DataFrame:
    """Parts of each day and then of the projected days: trend, week, holiday, spike, change of level and residual.

    The parts add up to ``valor``. ``escalon`` is the distance to the last level, ``pico`` what a
    spike or dip stands out by. Coming days have a season, a holiday part, and the rest as trend.
    """
    keys = list(keys)
    group = [*keys, "ventana"]
    training = training_sets(df, keys, day, value, [Origin("full", OPEN_END, horizon)])
    parted = materialise(trend_and_season(arima.spread_out(training, group), group, day, value), "parts")
    history = parted.select(
        *keys, F.col(day).alias("fecha"), F.lit("history").alias("tipo"), F.col("_raw").alias("valor"), F.col("_trend").alias("tendencia"),
        F.col("_season").alias("estacionalidad"), F.col("_holiday").alias("festivo"), F.col("_spike").alias("pico"), (-F.col("_lift")).alias("escalon"),
        (F.col(value) - F.col("_trend") - F.col("_season")).alias("residuo"))
    seasons = parted.groupBy(*keys, F.dayofweek(day).alias("_dow")).agg(F.first("_season").alias("_season"))
    ahead = forecast(fit_series(training, keys, day, value), keys, day).withColumn("_dow", F.dayofweek(day))
    season = F.coalesce("_season", F.lit(0.0))
    future = join_null_safe(ahead, seasons, [*keys, "_dow"], "left").select(
        *keys, F.col(day).alias("fecha"), F.lit("forecast").alias("tipo"), F.col("prediccion").alias("valor"),
        (F.col("prediccion") - season - F.col("holiday_effect")).alias("tendencia"), season.alias("estacionalidad"),
        F.col("holiday_effect").alias("festivo"), "limite_inferior", "limite_superior")
    return history.unionByName(future, allowMissingColumns=True)


def detect_anomalies(df: DataFrame, keys: Sequence[str], day: str, value: str,
                     threshold: float = 0.95) -> DataFrame:
    """Days whose one-step error is too large to be chance, with bounds and probability.

    What is expected follows from the cleaned days before, with the day's holiday and level put
    back; the value is the one that came. Every day of every series stays: where nothing can be
    expected yet, bounds and probability are NULL. A series without noise has its expectation as
    bounds, and any other value is an anomaly.
    """
    keys = list(keys)
    group = [*keys, "ventana"]
    training = training_sets(df, keys, day, value, [Origin("full", OPEN_END, 1)])
    fits = fit_series(training, keys, day, value).select(*group, "coefficients", "sigma2", F.col("d").alias("_again"))
    met = join_null_safe(arima.with_shocks(training, group, day), fits, group)
    order = Window.partitionBy(*group).orderBy(day)
    guess = F.lag(value, WEEK).over(order) + F.when(F.col("_again") == 1, F.lag("_z").over(order)).otherwise(0.0)
    for i in range(len(arima.TERMS)):
        c = F.get("coefficients", F.lit(i))
        guess = guess + F.when(c == 0, 0.0).otherwise(c * F.get("_terms", F.lit(i)))
    seen = met.withColumn("_expected", guess + F.col("_holiday") - F.col("_lift"))
    deviation = F.abs(F.col("_raw") - F.col("_expected"))
    reach = normal_quantile(threshold) * F.sqrt("sigma2")
    scored = seen.withColumn("_p", F.when(F.col("sigma2") > 1e-9, central_probability(F.try_divide(deviation, F.sqrt("sigma2"))))
                             .when(F.col("sigma2") <= 1e-9, (deviation > 1e-6).cast("double")))
    return scored.select(
        *keys, F.col(day).alias("fecha"), F.col("_raw").alias("valor"),
        F.coalesce(F.col("_p") > threshold, F.lit(False)).alias("is_anomaly"), steady_round("_p", 4).alias("anomaly_probability"),
        steady_round(F.col("_expected") - reach, 2).alias("limite_inferior"),
        steady_round(F.col("_expected") + reach, 2).alias("limite_superior"))

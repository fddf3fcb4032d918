"""M: daily series per order priority; N: the layout benchmark."""

from __future__ import annotations

from datetime import date

from cauce.operators import arima, series
from cauce.operators.aggregates import union_aligned
from cauce.operators.series import Origin
from cauce.plans import layout
from cauce.sources import tables
from cauce.sources.scratch import materialise, new_path
from pyspark.sql import functions as F
from workload import data
from workload.data import once, table
from workload.registry import query, rnd

KEYS, DAY, VALUE = ["o_orderpriority"], "day", "n"
ORIGINS = (Origin("R1", date(2000, 8, 31), 30), Origin("R2", date(2000, 9, 30), 31), Origin("R3", date(2000, 10, 31), 30),
           Origin("R4", date(2001, 7, 31), 31))
LAST = Origin("full", date(9999, 12, 31), 30)


def daily_orders(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


_SERIES_SQL = """s AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1, 2),
  days AS (SELECT k, CAST(unnest(generate_series(min(d)::TIMESTAMP, max(d)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM s GROUP BY k),
  marked AS (SELECT k, d, v, last_value(v IGNORE NULLS) OVER b AS v0, last_value(kd IGNORE NULLS) OVER b AS d0,
    first_value(v IGNORE NULLS) OVER a AS v1, first_value(kd IGNORE NULLS) OVER a AS d1
    FROM (SELECT days.k, days.d, CAST(n AS DOUBLE) AS v, CASE WHEN n IS NOT NULL THEN days.d END AS kd
          FROM days LEFT JOIN s ON s.k = days.k AND s.d = days.d)
    WINDOW b AS (PARTITION BY k ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           a AS (PARTITION BY k ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  filled AS (SELECT k, d, CASE WHEN v IS NULL THEN v0 + (v1 - v0) * ((d - d0) / (d1 - d0)) ELSE v END AS y,
    v IS NULL AS was_missing FROM marked)"""


def _holiday(d: str) -> str:
    """Name of the US federal holiday of a day, else NULL."""
    dated = " ".join(f"WHEN month({d}) = {m} AND (day({d}) = {n} OR (day({d}) = {n} + 1 AND isodow({d}) = 1)) THEN '{name}'" for name, m, n in (
        ("new_year", 1, 1), ("juneteenth", 6, 19), ("independence", 7, 4), ("veterans", 11, 11), ("christmas", 12, 25)))
    nth = " ".join(f"WHEN month({d}) = {m} AND isodow({d}) = {w} AND ceil(day({d}) / 7) = {k} THEN '{name}'" for name, m, w, k in (
        ("king", 1, 1, 3), ("presidents", 2, 1, 3), ("labor", 9, 1, 1), ("columbus", 10, 1, 2), ("thanksgiving", 11, 4, 4)))
    return f"CASE WHEN month({d}) = 5 AND isodow({d}) = 1 AND month({d} + 7) = 6 THEN 'memorial' {dated} {nth} END"


def _near(d: str) -> str:
    return f"coalesce({_holiday(d)}, ({_holiday(f'({d} + 1)')}) || '-1', ({_holiday(f'({d} - 1)')}) || '+1')"


def _beside(y: str) -> str:
    near = ", ".join(f"lag({y}, {7 * k}) OVER o, lead({y}, {7 * k}) OVER o" for k in (1, 2, 3))
    return f"list_sort(list_filter([{near}], lambda x: x IS NOT NULL))"


def _sums(vector, use: str) -> str:
    """The matrix of all sums of products."""
    return "[" + ", ".join(f"coalesce(sum(({x}) * ({y})) FILTER (WHERE {use}), 0)::DOUBLE" for x in vector for y in vector) + "]"


def _swept(m: str, pivots: str, n: int) -> str:
    """``m`` with the pivots swept, one list reduction over the pivots."""
    k, i, j = "p[1]::INTEGER", f"((i - 1) // {n})", f"((i - 1) % {n})"
    pivot = f"(CASE WHEN a[{k} * {n} + {k} + 1] > 1e-9 * {m}[{k} * {n} + {k} + 1] THEN a[{k} * {n} + {k} + 1] END)"
    row, column = f"a[{k} * {n} + {j} + 1]", f"a[{i} * {n} + {k} + 1]"
    cell = (f"CASE WHEN {i} = {k} AND {j} = {k} THEN 1 / {pivot} WHEN {i} = {k} THEN {row} / {pivot} WHEN {j} = {k} THEN -{column} / {pivot} "
            f"ELSE v - {column} * {row} / {pivot} END")
    return f"list_reduce(list_prepend({m}, list_transform({pivots}, lambda q: [q::DOUBLE])), lambda a, p: list_transform(a, lambda v, i: {cell}))"


_LAGS = [f"l{j}" for j in arima.LONG]
_N1, _N2 = len(_LAGS) + 2, len(arima.TERMS) + 1
_LONG_GUESS = " + ".join(["c[1]"] + [f"c[{i + 2}] * {x}" for i, x in enumerate(_LAGS)])
_INPUTS = ["1.0", "l1", "l2", "l7", "e1", "e2", "e7"]


def _model_sql(origins) -> str:
    rows = ", ".join(f"('{o.name}', DATE '{o.cutoff}', {o.horizon})" for o in origins)
    orders = ", ".join(f"('{name}', {terms}::INTEGER[])" for name, terms in arima.candidates())
    variance = "sum(x * x)" + "".join(f" + {2 * (1 - j / (arima.MEMORY + 1))!r} * coalesce(sum(x * x{j}), 0)" for j in range(1, arima.MEMORY + 1))
    return f"""{_SERIES_SQL}, origins(w, cutoff, horizon) AS (VALUES {rows}),
  seen AS (SELECT w, cutoff, horizon, k, d, CAST(n AS DOUBLE) AS n FROM s JOIN origins ON d <= cutoff),
  every AS (SELECT w, cutoff, horizon, k, CAST(unnest(generate_series(min(d)::TIMESTAMP, max(d)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d
    FROM seen GROUP BY 1, 2, 3, 4),
  around AS (SELECT e.*, n, (SELECT max(d) FROM seen x WHERE x.w = e.w AND x.k = e.k AND x.d <= e.d) AS d0,
    (SELECT min(d) FROM seen x WHERE x.w = e.w AND x.k = e.k AND x.d >= e.d) AS d1 FROM every e LEFT JOIN seen USING (w, cutoff, horizon, k, d)),
  cut AS (SELECT a.w, a.cutoff, a.horizon, a.k, a.d, CASE WHEN a.n IS NULL THEN p.n + (q.n - p.n) * ((a.d - d0) / (d1 - d0)) ELSE a.n END AS y
    FROM around a JOIN seen p ON p.w = a.w AND p.k = a.k AND p.d = d0 JOIN seen q ON q.w = a.w AND q.k = a.k AND q.d = d1),
  tagged AS (SELECT *, {_near('d')} AS tag FROM cut),
  usual AS (SELECT *, {_beside('CASE WHEN tag IS NULL THEN y END')} AS near FROM tagged WINDOW o AS (PARTITION BY w, k ORDER BY d)),
  effects AS (SELECT w, k, tag, sum(y - list_avg(near)) / (count(*) + {series.RIDGE}) AS eff FROM usual WHERE tag IS NOT NULL AND len(near) > 0 GROUP BY 1, 2, 3),
  plain AS (SELECT w, cutoff, horizon, k, d, u.y AS raw, tag, coalesce(eff, 0) AS e, u.y - coalesce(eff, 0) AS y FROM usual u LEFT JOIN effects USING (w, k, tag)),
  dif AS (SELECT *, y - lag(y, 7) OVER (PARTITION BY w, k ORDER BY d) AS dd FROM plain),
  mid AS (SELECT w, k, median(dd) AS dm, abs(avg(y)) AS lvl FROM dif GROUP BY 1, 2),
  dev AS (SELECT w, k, dm, lvl, 1.4826 * median(abs(dd - dm)) AS mad FROM dif JOIN mid USING (w, k) GROUP BY 1, 2, 3, 4),
  seven AS (SELECT dif.*, lvl, mad, CASE WHEN count(dd) OVER f = 7 THEN median(dd - dm) OVER f END AS m7,
    abs(round(avg(dd - dm) OVER f, 6)) AS a7 FROM dif JOIN dev USING (w, k)
    WINDOW f AS (PARTITION BY w, k ORDER BY d ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING)),
  gated AS (SELECT *, CASE WHEN mad > 0 AND abs(m7) > greatest(3.0 * mad, 0.1 * lvl) THEN a7 END AS score FROM seven),
  stepped AS (SELECT *, CASE WHEN score > coalesce(max(score) OVER (o ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), -1)
    AND score >= coalesce(max(score) OVER (o ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING), -1) THEN m7 END AS step
    FROM gated WINDOW o AS (PARTITION BY w, k ORDER BY d)),
  lifts AS (SELECT *, coalesce(sum(step) OVER (PARTITION BY w, k ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS lift FROM stepped),
  lifted AS (SELECT w, cutoff, horizon, k, d, raw, tag, e, step, lift, y + lift AS y FROM lifts),
  amid AS (SELECT *, list_median({_beside('y')}) AS m FROM lifted WINDOW o AS (PARTITION BY w, k ORDER BY d)),
  tols AS (SELECT w, k, {3.0 * 1.4826!r} * median(abs(y - m)) AS t FROM amid GROUP BY 1, 2),
  adjusted AS (SELECT w, cutoff, horizon, k, d, raw, tag, e, lift, step, y AS uncut,
    CASE WHEN t > 0 AND m IS NOT NULL THEN greatest(m - t, least(m + t, y)) ELSE y END AS y FROM amid JOIN tols USING (w, k)),
  diffed AS (SELECT *, y - lag(y, 7) OVER (PARTITION BY w, k ORDER BY d) AS z FROM adjusted),
  centred AS (SELECT *, z - avg(z) OVER (PARTITION BY w, k) AS x FROM diffed),
  running AS (SELECT *, CASE WHEN x IS NOT NULL THEN sum(x) OVER (o ROWS UNBOUNDED PRECEDING) END AS sx,
    {", ".join(f"lag(x, {j}) OVER o AS x{j}" for j in range(1, arima.MEMORY + 1))} FROM centred WINDOW o AS (PARTITION BY w, k ORDER BY d)),
  tested AS (SELECT w, k, coalesce(CASE WHEN {variance} > 1e-9 THEN sum(sx * sx) / (count(x) * ({variance})) END > {arima.STEADY}, false)::INTEGER AS dif1
    FROM running GROUP BY 1, 2),
  modelled AS (SELECT r.*, dif1, CASE WHEN dif1 = 1 THEN z - lag(z) OVER (PARTITION BY w, k ORDER BY d) ELSE z END AS wv FROM running r JOIN tested USING (w, k)),
  lagged AS (SELECT *, {", ".join(f"lag(wv, {j}) OVER o AS l{j}" for j in arima.LONG)} FROM modelled WINDOW o AS (PARTITION BY w, k ORDER BY d)),
  stage1 AS (SELECT w, k, count(*) FILTER (WHERE wv IS NOT NULL AND l21 IS NOT NULL) AS n1,
    {_sums(["1.0", *_LAGS, "wv"], "wv IS NOT NULL AND l21 IS NOT NULL")} AS g FROM lagged GROUP BY 1, 2),
  swept1 AS (SELECT w, k, n1, {_swept("g", str(list(range(_N1 - 1))), _N1)} AS sw FROM stage1),
  long AS (SELECT w, k, n1 >= {arima.LONG_DAYS} AND sw[{_N1 * _N1}] IS NOT NULL AS has_long,
    list_transform(range(0, {_N1 - 1}), lambda i: sw[i * {_N1} + {_N1}]) AS c FROM swept1),
  shocks AS (SELECT *, CASE WHEN has_long AND wv IS NOT NULL AND l21 IS NOT NULL THEN wv - ({_LONG_GUESS}) END AS sh FROM lagged JOIN long USING (w, k)),
  paired AS (SELECT *, lag(sh, 1) OVER o AS e1, lag(sh, 2) OVER o AS e2, lag(sh, 7) OVER o AS e7, max(d) OVER (PARTITION BY w, k) AS last_day
    FROM shocks WINDOW o AS (PARTITION BY w, k ORDER BY d)),
  usable AS (SELECT *, wv IS NOT NULL AND CASE WHEN has_long THEN l7 IS NOT NULL AND e7 IS NOT NULL ELSE l1 IS NOT NULL END AS u FROM paired),
  stage2 AS (SELECT w, k, count(*) FILTER (WHERE u) AS n, max(dif1) AS dif1, bool_or(has_long) AS has_long, max(last_day) AS last_day, avg(y) AS mean,
    max(horizon) AS horizon, max(cutoff) AS cutoff, count(step) AS steps, count(*) FILTER (WHERE abs(uncut - y) > 1e-9) AS spikes,
    list(coalesce(wv, 0) ORDER BY d DESC) FILTER (WHERE last_day - d < 7) AS last_w, list(coalesce(sh, 0) ORDER BY d DESC) FILTER (WHERE last_day - d < 7) AS last_e,
    list(y ORDER BY d DESC) FILTER (WHERE last_day - d < 7) AS last_y, arg_max(coalesce(z, 0), d) AS last_z,
    {_sums([f"coalesce({x}, 0)" for x in [*_INPUTS, "wv"]], "u")} AS g FROM usable GROUP BY 1, 2),
  orders(model, terms) AS (VALUES {orders}),
  tried AS (SELECT w, k, n, model, terms, len(terms) AS p, {_swept("g", "terms", _N2)} AS sw FROM stage2 JOIN orders ON
    (has_long OR len(list_filter(terms, lambda t: t > 1)) = 0) AND (dif1 = 0 OR NOT list_contains(terms, 0)) AND (len(terms) = 0 OR n > 4 * len(terms))),
  solved AS (SELECT w, k, n, model, p, greatest(0, sw[{_N2 * _N2}]) AS sse, sw[{_N2 * _N2}] IS NOT NULL AS ok,
    list_transform(range(0, {_N2 - 1}), lambda i: CASE WHEN list_contains(terms, i::INTEGER) THEN sw[i * {_N2} + {_N2}] ELSE 0 END) AS c FROM tried),
  best AS (SELECT w, k, model, p, sse, c FROM solved
    WHERE ok AND abs(c[3]) < 0.99 AND c[3] + c[2] < 0.99 AND c[3] - c[2] < 0.99 AND (c[4] = 0 OR abs(c[2]) + abs(c[3]) + abs(c[4]) < 0.99)
    QUALIFY row_number() OVER (PARTITION BY w, k ORDER BY round(n * ln(greatest(1e-9, sse / n)) + 2 * p, 4), p, model) = 1),
  fits AS (SELECT *, sse / greatest(1, n - p) AS sigma2, CASE WHEN cutoff < DATE '9999-12-31' THEN cutoff - last_day ELSE 0 END AS gap
    FROM stage2 JOIN best USING (w, k))"""


def _recursion(name: str, start: str, drift: str) -> str:
    """One row a step: the last week of differences, shocks and values, latest first."""
    new = f"{drift} + c[2] * ws[1] + c[3] * ws[2] + c[4] * ws[7] + c[5] * es[1] + c[6] * es[2] + c[7] * es[7]"
    return f"""{name}(w, k, h, ws, es, z, ys) AS ({start} UNION ALL
    SELECT w, k, h + 1, list_prepend(nw, ws[1:6]), list_prepend(0.0::DOUBLE, es[1:6]), nz, list_prepend(ys[7] + nz, ys[1:6]) FROM (
      SELECT *, nw + CASE WHEN dif1 = 1 THEN z ELSE 0 END AS nz FROM (
        SELECT x.*, dif1, {new} AS nw FROM {name} x JOIN fits USING (w, k) WHERE h < horizon + gap)))"""


_Z = series.normal_quantile(0.95)
_ONE = "[1.0, 0, 0, 0, 0, 0, 0]::DOUBLE[]"
_FORECAST_SQL = f"""{_recursion('steps', "SELECT w, k, 0, last_w::DOUBLE[], last_e::DOUBLE[], last_z::DOUBLE, last_y::DOUBLE[] FROM fits", 'c[1]')},
  {_recursion('shock', f"SELECT w, k, 0, {_ONE}, {_ONE}, 1.0::DOUBLE, {_ONE} FROM fits", '0')},
  wide AS (SELECT w, k, h, sum(ys[1] * ys[1]) OVER (PARTITION BY w, k ORDER BY h ROWS UNBOUNDED PRECEDING) AS v FROM shock),
  dated AS (SELECT s.w, s.k, s.ys[1] AS y, CAST(last_day + CAST(s.h AS INTEGER) AS DATE) AS target, {_Z!r} * sqrt(sigma2 * v) AS reach
    FROM steps s JOIN fits f ON f.w = s.w AND f.k = s.k JOIN wide x ON x.w = s.w AND x.k = s.k AND x.h = s.h - 1 WHERE s.h > gap),
  projected AS (SELECT t.w, t.k, target, y + coalesce(eff, 0) AS p, coalesce(eff, 0) AS e, reach
    FROM (SELECT *, {_near('target')} AS tag FROM dated) t LEFT JOIN effects x ON x.w = t.w AND x.k = t.k AND x.tag = t.tag)"""
_ROLLED_SQL = f"""rolled AS (SELECT p.k AS o_orderpriority, p.w AS ventana, target AS fecha, {rnd('p', 1)} AS viajes_predichos,
    {rnd('p - reach', 1)} AS limite_inferior, {rnd('p + reach', 1)} AS limite_superior, n AS viajes_reales,
    {rnd('p - n', 1)} AS error, {rnd('(p - n) / n', 4)} AS error_pct
    FROM projected p LEFT JOIN s ON s.k = p.k AND s.d = target)"""
_METRICS = f"""count(viajes_reales) AS dias_evaluados, {rnd('sqrt(avg(pow(viajes_predichos - viajes_reales, 2)))', 1)} AS rmse_viajes,
    {rnd('avg(abs(viajes_predichos - viajes_reales))', 1)} AS mae_viajes, {rnd('100 * avg(abs(error_pct))', 2)} AS mape_pct,
    {rnd('100.0 * count(*) FILTER (WHERE viajes_reales BETWEEN limite_inferior AND limite_superior) / count(viajes_reales)', 2)}
      AS cobertura_ic_pct"""


def _training(spark, sf, name="origins", origins=ORIGINS):
    return once(spark, sf, f"training-{name}", lambda: series.training_sets(
        daily_orders(spark, sf), KEYS, DAY, VALUE, origins))


def _plain(df, digits):
    """Rounded columns without negative zeros, for comparison with the oracle."""
    return df.withColumns({c: F.when(F.abs(F.round(c, d)) == 0, 0.0).otherwise(F.round(c, d)) for c, d in digits.items()})


def _z0(expression: str, digits: int) -> str:
    return f"CASE WHEN round({expression}, {digits}) = 0 THEN 0.0 ELSE round({expression}, {digits}) END"


_TERM_SQL = ", ".join(f"{_z0(f'c[{i + 1}]', 4)} AS {t}" for i, t in enumerate(arima.TERMS))


@query("m01_fit_series", f"""WITH RECURSIVE {_model_sql(ORIGINS)} SELECT k AS o_orderpriority, w AS ventana, n, model, dif1 AS d, steps, spikes,
    {_TERM_SQL}, {_z0('sigma2', 4)} AS sigma2, last_day FROM fits""")
def m01(spark, sf):
    fits = series.fit_series(_training(spark, sf), KEYS, DAY, VALUE).withColumns(
        {t: F.get("coefficients", F.lit(i)) for i, t in enumerate(arima.TERMS)})
    numbers = (*arima.TERMS, "sigma2")
    return _plain(fits.select("o_orderpriority", "ventana", "n", "model", "d", "steps", "spikes", "last_day", *numbers), dict.fromkeys(numbers, 4))


@query("m01_holiday_effects", f"""WITH {_model_sql(ORIGINS)} SELECT k AS o_orderpriority, w AS ventana, tag AS holiday, {_z0('eff', 4)} AS effect FROM effects""")
def m01_holidays(spark, sf):
    fits = series.fit_series(_training(spark, sf), KEYS, DAY, VALUE)
    return _plain(fits.select("o_orderpriority", "ventana", F.explode("holidays").alias("holiday", "effect")), {"effect": 4})


@query("m02_forecast", f"""WITH RECURSIVE {_model_sql([LAST])}, {_FORECAST_SQL} SELECT k AS o_orderpriority, w AS ventana, target AS day, round(p, 3) AS prediccion,
    round(p - reach, 3) AS limite_inferior, round(p + reach, 3) AS limite_superior, 'fitted' AS basis, {_z0('e', 3)} AS holiday_effect FROM projected""")
def m02(spark, sf):
    ahead = series.forecast(series.fit_series(_training(spark, sf, "last", [LAST]), KEYS, DAY, VALUE), KEYS, DAY)
    return _plain(ahead.withColumns({c: F.round(c, 3) for c in ("prediccion", "limite_inferior", "limite_superior")}), {"holiday_effect": 3})


@query("m03_rolling_origin", f"WITH RECURSIVE {_model_sql(ORIGINS)}, {_FORECAST_SQL}, {_ROLLED_SQL} SELECT * FROM rolled")
def m03(spark, sf):
    return series.rolling_origin(daily_orders(spark, sf), KEYS, DAY, VALUE, ORIGINS)


@query("m04_forecast_metrics", f"""WITH RECURSIVE {_model_sql(ORIGINS)}, {_FORECAST_SQL}, {_ROLLED_SQL} SELECT o_orderpriority, ventana, {_METRICS}
    FROM rolled WHERE viajes_reales IS NOT NULL GROUP BY 1, 2""")
def m04(spark, sf):
    rolled = series.rolling_origin(daily_orders(spark, sf), KEYS, DAY, VALUE, ORIGINS)
    return series.forecast_metrics(rolled, ["o_orderpriority", "ventana"])


@query("m05_single_window", f"""WITH RECURSIVE {_model_sql(ORIGINS[2:3])}, {_FORECAST_SQL}, {_ROLLED_SQL} SELECT ventana, {_METRICS}
    FROM rolled WHERE viajes_reales IS NOT NULL GROUP BY 1""")
def m05(spark, sf):
    rolled = series.rolling_origin(daily_orders(spark, sf), KEYS, DAY, VALUE, ORIGINS[2:3])
    return series.forecast_metrics(rolled)


@query("m06_fit_quality", f"""WITH {_model_sql(ORIGINS)} SELECT k AS o_orderpriority, w AS ventana, n, model, model[2]::INTEGER AS p, dif1 AS d, model[4]::INTEGER AS q,
    model[7]::INTEGER AS seasonal_p, model[9]::INTEGER AS seasonal_q, model LIKE '%+drift' AS has_drift, {_z0('sigma2', 4)} AS variance,
    CASE WHEN sse > 0 THEN round(-n / 2 * (ln(2 * pi() * sse / n) + 1), 3) END AS log_likelihood,
    CASE WHEN sse > 0 THEN round(2 * (p + 1) + n * (ln(2 * pi() * sse / n) + 1), 3) END AS aic,
    EXISTS (SELECT 1 FROM effects x WHERE x.w = fits.w AND x.k = fits.k) AS has_holiday_effect, spikes > 0 AS has_spikes_and_dips, steps > 0 AS has_step_changes FROM fits""")
def m06(spark, sf):
    quality = series.fit_quality(series.fit_series(_training(spark, sf), KEYS, DAY, VALUE), KEYS)
    return _plain(quality, {"variance": 4, "log_likelihood": 3, "aic": 3})


def _season_rounds() -> str:
    """The rounds of lines and weekly patterns, each weighing days by what the last one left."""
    out = ["r0 AS (SELECT w, k, d, raw, e, lift, uncut - y AS spike, y, date_diff('day', DATE '1970-01-01', d) AS t, isodow(d) AS wd, 0.0::DOUBLE AS se, 1.0::DOUBLE AS u FROM adjusted)"]
    moment = lambda power, x: f"list_sum(list_transform(pts, lambda q: q.u * pow(1 - pow(abs(q.t - t) / {series.REACH}, 3), 3) * pow((q.t - t)::DOUBLE, {power}){x}))"
    for r in range(series.ROUNDS):
        out.append(f"""p{r} AS (SELECT *, list({{'t': t, 'x': y - se, 'u': u}}) OVER (PARTITION BY w, k ORDER BY d
          ROWS BETWEEN {series.REACH - 1} PRECEDING AND {series.REACH - 1} FOLLOWING) AS pts FROM r{r}),
          m{r} AS (SELECT * EXCLUDE (pts{', tr' if r else ''}), {moment(0, '')} AS s0, {moment(1, '')} AS s1, {moment(2, '')} AS s2, {moment(0, ' * q.x')} AS t0, {moment(1, ' * q.x')} AS t1 FROM p{r}),
          t{r} AS (SELECT *, coalesce(CASE WHEN s0 * s2 - s1 * s1 > 1e-9 * s0 * s0 THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) WHEN s0 <> 0 THEN t0 / s0 END, y) AS tr FROM m{r}),
          w{r} AS (SELECT w, k, wd, coalesce(sum(u * (y - tr)) / nullif(sum(u), 0), 0) AS pat FROM t{r} GROUP BY 1, 2, 3),
          c{r} AS (SELECT w, k, wd, pat - avg(pat) OVER (PARTITION BY w, k) AS pat FROM w{r}),
          a{r} AS (SELECT t{r}.* EXCLUDE (se), pat AS se, abs(y - tr - pat) AS lf FROM t{r} JOIN c{r} USING (w, k, wd)),
          l{r} AS (SELECT w, k, 6 * median(lf) AS lim FROM a{r} GROUP BY 1, 2),
          r{r + 1} AS (SELECT w, k, d, raw, e, lift, spike, y, t, wd, se, tr, CASE WHEN lim <= 1e-9 THEN 1.0 WHEN lf < lim THEN pow(1 - pow(lf / lim, 2), 2) ELSE 0 END AS u
            FROM a{r} JOIN l{r} USING (w, k))""")
    return ", ".join(out)


@query("m07_decompose", f"""WITH RECURSIVE {_model_sql([LAST])}, {_FORECAST_SQL}, {_season_rounds()},
    week AS (SELECT w, k, wd, any_value(se) AS se FROM r{series.ROUNDS} GROUP BY 1, 2, 3)
    SELECT k AS o_orderpriority, d AS fecha, 'history' AS tipo, {_z0('raw', 3)} AS valor, {_z0('tr', 3)} AS tendencia, {_z0('se', 3)} AS estacionalidad,
      {_z0('e', 3)} AS festivo, {_z0('spike', 3)} AS pico, {_z0('(-lift)', 3)} AS escalon, {_z0('(y - tr - se)', 3)} AS residuo,
      NULL AS limite_inferior, NULL AS limite_superior FROM r{series.ROUNDS}
    UNION ALL SELECT k, target, 'forecast', {_z0('p', 3)}, {_z0('(p - coalesce(se, 0) - e)', 3)}, {_z0('coalesce(se, 0)', 3)}, {_z0('e', 3)}, NULL, NULL, NULL,
      {_z0('(p - reach)', 3)}, {_z0('(p + reach)', 3)} FROM projected LEFT JOIN (SELECT k, wd, se FROM week) USING (k) WHERE wd = isodow(target)""")
def m07(spark, sf):
    parts = series.decompose(daily_orders(spark, sf), KEYS, DAY, VALUE)
    numbers = ("valor", "tendencia", "estacionalidad", "festivo", "pico", "escalon", "residuo", "limite_inferior", "limite_superior")
    return _plain(parts, dict.fromkeys(numbers, 3))


_ERF = "(1 - t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * exp(-x * x))"
_GUESS = " + ".join(f"CASE WHEN f.c[{i + 1}] = 0 THEN 0 ELSE f.c[{i + 1}] * ({x}) END" for i, x in enumerate(_INPUTS))


@query("m08_detect_anomalies", f"""WITH {_model_sql([Origin('full', date(9999, 12, 31), 1)])},
    g AS (SELECT *, lag(y, 7) OVER o AS before, lag(z) OVER o AS z1 FROM paired WINDOW o AS (PARTITION BY w, k ORDER BY d)),
    g2 AS (SELECT g.k, g.d, raw, before + CASE WHEN g.dif1 = 1 THEN z1 ELSE 0 END + {_GUESS} + e - lift AS expected, sigma2
      FROM g JOIN fits f ON f.w = g.w AND f.k = g.k),
    g3 AS (SELECT *, CASE WHEN sigma2 > 1e-9 THEN abs(raw - expected) / sqrt(sigma2) / sqrt(2) END AS x FROM g2),
    g4 AS (SELECT *, 1 / (1 + 0.3275911 * x) AS t FROM g3), g5 AS (SELECT *, {_ERF} AS pr FROM g4)
    SELECT k AS o_orderpriority, d AS fecha, raw AS valor, coalesce(pr > 0.95, false) AS is_anomaly, {rnd('pr', 4)} AS anomaly_probability,
    {rnd(f'expected - {_Z!r} * sqrt(sigma2)', 2)} AS limite_inferior, {rnd(f'expected + {_Z!r} * sqrt(sigma2)', 2)} AS limite_superior
    FROM g5""")
def m08(spark, sf):
    return series.detect_anomalies(daily_orders(spark, sf), KEYS, DAY, VALUE)


@query("m09_series_fill", f"""WITH {_SERIES_SQL} SELECT k AS o_orderpriority, d AS day, round(y, 6) AS n, was_missing FROM filled""")
def m09(spark, sf):
    return series.fill_days(daily_orders(spark, sf), KEYS, DAY, VALUE).withColumn("n", F.round("n", 6))


# ---------------------------------------------------------------- N
def plain_trips(spark, sf):
    """The clean trips written as they come."""
    def write():
        path = new_path(spark, "trips-plain")
        tables.load_idempotent(data.trips(spark, sf), path)
        return path
    return spark.read.parquet(once(spark, sf, "trips-plain", write))


def partitioned_trips(spark, sf):
    """The same trips by month, clustered by zones."""
    def write():
        path = new_path(spark, "trips-monthly")
        monthly = plain_trips(spark, sf).withColumn("pickup_month", F.trunc("pickup_date", "month"))
        tables.write_partitioned(monthly, path, "pickup_month", ["pickup_location_id", "dropoff_location_id"],
                                 block_bytes=4 << 20)
        return path
    return spark.read.parquet(once(spark, sf, "trips-monthly", write))


def clustered_trips(spark, sf, alike: bool = True):
    """The same trips clustered by both zones alike, or sorted by one after the other; small row groups, as the tables are small."""
    name = "trips-interleaved" if alike else "trips-sorted"

    def write():
        path = new_path(spark, name)
        if alike:
            tables.write_clustered(plain_trips(spark, sf), path, CLUSTER, block_bytes=8 << 10)
        else:
            plain_trips(spark, sf).repartitionByRange(*CLUSTER).sortWithinPartitions(*CLUSTER).write.option(
                "parquet.block.size", 8 << 10).parquet(path)
        return path
    return spark.read.parquet(once(spark, sf, name, write))


CLUSTER = ("pickup_location_id", "dropoff_location_id")
ZONES = (132, 138, 237, 238, 239, 161, 142, 141, 170, 114)
MARCH = (date(1998, 3, 1), date(1998, 3, 31))
SUMMER = (date(1998, 6, 1), date(1998, 8, 31))
SEPTEMBER = (date(1998, 9, 1), date(1998, 9, 30))
#: A zone with departures in that month at every scale of the supplied tables.
BUSY_ZONE = 244
WINTER = (date(1998, 1, 1), date(1998, 2, 28))
JULY_DAY = date(1998, 7, 15)


#: What each benchmark query reads: a period, and columns besides the partition.
READS = {
    "n01_month_daily": (MARCH, ("pickup_date", "total_amount")),
    "n02_quarter_zones": (SUMMER, ("pickup_date", "pickup_location_id", "fare_amount", "trip_distance")),
    "n03_zone_destinations": (SEPTEMBER, ("pickup_date", "pickup_location_id", "dropoff_location_id", "fare_amount")),
    "n04_weekday_hours": (WINTER, ("pickup_date", "pickup_datetime", "trip_duration_minutes")),
    "n05_day_two_columns": ((JULY_DAY, JULY_DAY), ("pickup_date", "trip_distance")),
}


def bytes_read(spark, sf, name: str) -> tuple[int, int]:
    """Column bytes of a benchmark query on the plain and on the partitioned trips.

    N5 is about columns, so its first figure is all columns of the day on the partitioned trips.
    """
    period, columns = READS[name]
    left = layout.months_of(partitioned_trips(spark, sf), *period)
    if name == "n05_day_two_columns":
        return layout.scanned_bytes(left), layout.scanned_bytes(left, columns)
    return layout.scanned_bytes(plain_trips(spark, sf), columns), layout.scanned_bytes(left, columns)


def benchmark_pair(spark, sf, name: str):
    """The two runs that a benchmark query compares."""
    plain, monthly = plain_trips(spark, sf), partitioned_trips(spark, sf)
    if name == "n05_day_two_columns":
        return lambda: layout.day_wide(monthly, JULY_DAY), lambda: layout.day_narrow(monthly, JULY_DAY)
    return lambda: BENCHMARK[name](plain), lambda: BENCHMARK[name](monthly)


def _within(period) -> str:
    return f"pickup_date BETWEEN DATE '{period[0]}' AND DATE '{period[1]}'"


BENCHMARK = {
    "n01_month_daily": lambda df: layout.daily_revenue(df, *MARCH),
    "n02_quarter_zones": lambda df: layout.zone_averages(df, *SUMMER, ZONES),
    "n03_zone_destinations": lambda df: layout.zone_destinations(df, *SEPTEMBER, BUSY_ZONE),
    "n04_weekday_hours": lambda df: layout.weekday_hours(df, *WINTER),
    "n05_day_two_columns": lambda df: layout.day_narrow(df, JULY_DAY),
}


@query("n01_month_daily", f"""WITH {data.TRIPS_SQL} SELECT pickup_date, count(*) AS viajes, {rnd('sum(total_amount)', 2)} AS revenue
    FROM trips WHERE {_within(MARCH)} GROUP BY 1""")
def n01(spark, sf):
    return BENCHMARK["n01_month_daily"](partitioned_trips(spark, sf))


@query("n02_quarter_zones", f"""WITH {data.TRIPS_SQL} SELECT pickup_location_id, count(*) AS viajes,
    {rnd('avg(fare_amount)', 2)} AS fare_promedio, {rnd('avg(trip_distance)', 2)} AS dist_promedio FROM trips
    WHERE {_within(SUMMER)} AND pickup_location_id IN {ZONES} GROUP BY 1""")
def n02(spark, sf):
    return BENCHMARK["n02_quarter_zones"](partitioned_trips(spark, sf))


@query("n03_zone_destinations", f"""WITH {data.TRIPS_SQL} SELECT pickup_location_id, dropoff_location_id, count(*) AS viajes,
    {rnd('sum(fare_amount)', 2)} AS revenue FROM trips WHERE {_within(SEPTEMBER)} AND pickup_location_id = {BUSY_ZONE}
    GROUP BY 1, 2 ORDER BY viajes DESC, dropoff_location_id LIMIT 25""")
def n03(spark, sf):
    return BENCHMARK["n03_zone_destinations"](partitioned_trips(spark, sf))


_HOURS = f"""hour(pickup_datetime) AS hora, count(*) AS viajes, {rnd('avg(trip_duration_minutes)', 2)} AS duracion_prom
    FROM trips WHERE {_within(WINTER)} GROUP BY 1, 2"""


@query("n04_weekday_hours", f"WITH {data.TRIPS_SQL} SELECT strftime(pickup_date, '%Y-%u') AS semana, {_HOURS}")
def n04(spark, sf):
    return BENCHMARK["n04_weekday_hours"](partitioned_trips(spark, sf))


@query("n04_iso_week_hours", f"WITH {data.TRIPS_SQL} SELECT strftime(pickup_date, '%G-%V') AS semana, {_HOURS}")
def n04w(spark, sf):
    return layout.weekday_hours(partitioned_trips(spark, sf), *WINTER, true_week=True)


@query("n05_day_two_columns", f"""WITH {data.TRIPS_SQL} SELECT count(*) AS viajes, {rnd('avg(trip_distance)', 2)} AS dist_prom
    FROM trips WHERE pickup_date = DATE '{JULY_DAY}'""")
def n05(spark, sf):
    return BENCHMARK["n05_day_two_columns"](partitioned_trips(spark, sf))


@query("n05_day_all_columns", f"""WITH {data.TRIPS_SQL}, w AS (SELECT count(*) AS n FROM trips WHERE pickup_date = DATE '{JULY_DAY}')
    SELECT least(n, 100) AS n_rows FROM w""")
def n05w(spark, sf):
    """A LIMIT without an order may return any rows, so only their number is compared."""
    return layout.day_wide(partitioned_trips(spark, sf), JULY_DAY).agg(F.count(F.lit(1)).alias("n_rows"))


@query("n06_compare_runs")
def n06(spark, sf):
    """Column bytes after pruning and time of each benchmark query: plain against partitioned, for N5 all columns against two."""
    def measure():
        runs = []
        for name in BENCHMARK:
            pair = zip(("STD", "OPT"), bytes_read(spark, sf, name), benchmark_pair(spark, sf, name))
            runs += [(name, variant, size, layout.timed(run, 1)) for variant, size, run in pair]
        return layout.run_log(spark, runs)
    return layout.compare_runs(once(spark, sf, "run-log", measure))


@query("n06_run_facts", " UNION ALL ".join(f"SELECT '{name}' AS prueba, true AS fewer_bytes, true AS timed" for name in BENCHMARK))
def n06f(spark, sf):
    """What must hold of any run: all queries are there, pruning leaves fewer bytes, both were timed."""
    return n06(spark, sf).select("prueba", (F.col("bytes_opt") < F.col("bytes_std")).alias("fewer_bytes"),
                                 (F.col("ms_std").isNotNull() & F.col("ms_opt").isNotNull()).alias("timed"))


@query("n07_day_probe", f"""WITH {data.TRIPS_SQL} SELECT {rnd('sum(fare_amount)', 2)} AS revenue_dia FROM trips
    WHERE pickup_date = DATE '{JULY_DAY}'""")
def n07(spark, sf):
    return layout.day_revenue(partitioned_trips(spark, sf), JULY_DAY)


@query("n03_zone_arrivals", f"""WITH {data.TRIPS_SQL} SELECT date_trunc('month', pickup_date)::DATE AS mes, count(*) AS viajes,
    {rnd('sum(fare_amount)', 2)} AS revenue FROM trips WHERE dropoff_location_id = {BUSY_ZONE} GROUP BY 1""")
def n03a(spark, sf):
    """A filter on the second cluster column alone."""
    return layout.zone_arrivals(clustered_trips(spark, sf), BUSY_ZONE)


@query("n06_cluster_pruning")
def n06c(spark, sf):
    """Row groups that statistics leave for a filter on either cluster column alone, sorted against interleaved."""
    return union_aligned([
        layout.row_groups(clustered_trips(spark, sf, alike), {c: (BUSY_ZONE, BUSY_ZONE)}).select(
            F.lit(c).alias("columna"), F.lit("interleaved" if alike else "sorted").alias("variante"), "*",
            F.round(100 * (1 - F.col("groups_left") / F.col("groups")), 2).alias("saltados_pct"))
        for c in CLUSTER for alike in (True, False)])


@query("n06_cluster_facts", f"""WITH {data.TRIPS_SQL}, n AS (SELECT count(*) AS n FROM trips)
    SELECT unnest(['pickup_location_id', 'dropoff_location_id']) AS columna, n AS n_rows, true AS most_are_skipped, true AS none_is_lost FROM n""")
def n06cf(spark, sf):
    """Interleaved, either column alone skips over half of the row groups; all rows of the zone are in those left."""
    found = n06c(spark, sf).where("variante = 'interleaved'")
    trips = plain_trips(spark, sf).agg(*[F.count_if(F.col(c) == BUSY_ZONE).alias(c) for c in CLUSTER])
    held = trips.select(F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("held")) for c in CLUSTER])).alias("_h")).select("_h.*")
    return found.join(held, "columna").select(
        "columna", "n_rows", (2 * F.col("groups_left") < F.col("groups")).alias("most_are_skipped"),
        (F.col("held") <= F.col("rows_left")).alias("none_is_lost"))

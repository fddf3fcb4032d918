"""Seasonal ARIMA of searched order for many series at once, from sums.

Orders are fitted by two regressions. A long autoregression gives the shocks of each day; then the
differenced value is regressed on its own lags, on lagged shocks, and on the lags of one week.
The normal equations of all candidate orders are parts of one matrix of sums per series, so a
series is read twice whatever the number of candidates; each candidate is solved by sweeping its
columns of that matrix, and the one with the least AIC stays. All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cauce.operators.joins import join_null_safe

WEEK = 7
#: Lags of the long autoregression, which reach over three weeks.
LONG = (1, 2, 3, 4, 5, 6, 7, 8, 14, 21)
#: Fewest days with all these lags for a long autoregression; a shorter series has no shock terms.
LONG_DAYS = 40
#: Inputs of the second regression, in the order of the coefficients.
TERMS = ("drift", "ar1", "ar2", "sar1", "ma1", "ma2", "sma1")
#: Critical value of the test for a level that stays (1 %).
STEADY = 0.739
#: Days over which that test sums up how far values hang together.
MEMORY = 14


def candidates() -> list[tuple[str, list[int]]]:
    """Name and term numbers of all orders: up to two lags of either kind, a weekly one of each, drift or not."""
    out = []
    for p in range(3):
        for q in range(3):
            for sp in range(2):
                for sq in range(2):
                    for drift in range(2):
                        terms = [0] * drift + [1, 2][:p] + [3] * sp + [4, 5][:q] + [6] * sq
                        out.append((f"({p},{q})({sp},{sq})" + "+drift" * drift, terms))
    return out


# --- small matrices as arrays of rows --------------------------------------------------------

def sum_matrix(vector: Sequence[str], use: str) -> Column:
    """All sums of products of the named columns over the rows where ``use`` holds, as rows of a symmetric matrix.

    Written as one SQL text, since it is parsed much quicker than it is put together.
    """
    n = len(vector)
    sums = {(i, j): f"coalesce(sum(CASE WHEN {use} THEN {vector[i]} * {vector[j]} END), 0D)" for i in range(n) for j in range(i, n)}
    return F.expr("array(" + ", ".join("array(" + ", ".join(sums[min(i, j), max(i, j)] for j in range(n)) + ")" for i in range(n)) + ")")


def cell(matrix: Column, i: Column | int, j: Column | int) -> Column:
    return F.get(F.get(matrix, F.lit(i) if isinstance(i, int) else i), F.lit(j) if isinstance(j, int) else j)


def swept(matrix: Column, pivots: Column) -> Column:
    """The matrix with the pivot rows solved for and taken out of all others: their last entries are the regression's
    coefficients, the last cell its squared error. Without a usable pivot (a column that the others explain) that
    cell becomes NULL."""
    def sweep(a: Column, k: Column) -> Column:
        usable = F.when(cell(a, k, k) > 1e-9 * cell(matrix, k, k), cell(a, k, k))
        scaled = F.array(F.transform(F.get(a, k), lambda x: x / usable))  # a list of one, to be worked out once
        return F.get(F.transform(scaled, lambda r: F.transform(a, lambda row, i: F.when(i == k, r).otherwise(
            F.zip_with(row, r, lambda x, y: x - F.get(row, k) * y)))), F.lit(0))

    # cells of a type that may be NULL, or a NULL one would be read back as zero
    start = F.transform(matrix, lambda row: F.transform(row, lambda x: F.when(x.isNotNull(), x)))
    return F.aggregate(pivots, start, sweep)


def spread_out(df: DataFrame, group: list[str]) -> DataFrame:
    """One task for few groups each, also where their rows are few bytes: the work per row is large."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *group)


# --- differences ---------------------------------------------------------------------------

def differenced(df: DataFrame, group: list[str], day: str, value: str) -> DataFrame:
    """Add ``_z`` (difference by a week), ``_d`` (1 if the level of that does not stay and it is differenced once
    more), ``_w`` (the series to model) and ``_lags`` (its values at ``LONG``); days are complete.

    The test for a steady level sets the squared running sums of the centred ``_z`` against its variance over two weeks.
    """
    whole = Window.partitionBy(*group)
    order = whole.orderBy(day)
    z = df.withColumn("_z", F.col(value) - F.lag(value, WEEK).over(order))
    centred = z.withColumn("_x", F.col("_z") - F.avg("_z").over(whole))
    so_far = F.when(F.col("_x").isNotNull(), F.sum("_x").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    lagged = centred.withColumns({"_s": so_far, **{f"_x{j}": F.lag("_x", j).over(order) for j in range(1, MEMORY + 1)}})
    variance = F.sum(F.col("_x") * F.col("_x")).over(whole)
    for j in range(1, MEMORY + 1):
        variance = variance + 2 * (1 - j / (MEMORY + 1)) * F.coalesce(F.sum(F.col("_x") * F.col(f"_x{j}")).over(whole), F.lit(0.0))
    n = F.count("_x").over(whole)
    statistic = F.try_divide(F.sum(F.col("_s") * F.col("_s")).over(whole), n * F.when(variance > 1e-9, variance))
    tested = lagged.withColumn("_d", F.when(statistic > STEADY, 1).otherwise(0)).drop("_x", "_s", *[f"_x{j}" for j in range(1, MEMORY + 1)])
    ready = tested.withColumn("_w", F.when(F.col("_d") == 1, F.col("_z") - F.lag("_z").over(order)).otherwise(F.col("_z")))
    return ready.withColumn("_lags", F.array(*[F.lag("_w", j).over(order) for j in LONG]))


# --- fit -----------------------------------------------------------------------------------

def with_shocks(training: DataFrame, group: list[str], day: str) -> DataFrame:
    """Add ``_long`` (whether the series bears a long autoregression) and ``_terms``: the inputs of the second regression.

    The shock of a day is what the long autoregression leaves; without one there are no shocks.
    """
    training = spread_out(training, group)
    lags = [F.get("_lags", F.lit(i)) for i in range(len(LONG))]
    full = F.col("_w").isNotNull() & ~F.exists("_lags", lambda x: x.isNull())
    n = len(LONG) + 2
    named = training.select(*group, "_w", full.alias("_full"), *[x.alias(f"_l{j}") for x, j in zip(lags, LONG)])
    sums = named.groupBy(*group).agg(sum_matrix(["1D", *[f"_l{j}" for j in LONG], "_w"], "_full").alias("_sums"), F.count(F.when(F.col("_full"), 1)).alias("_n"))
    solved = sums.withColumn("_swept", swept(F.col("_sums"), F.array(*[F.lit(i) for i in range(n - 1)])))
    last = cell(F.col("_swept"), n - 1, n - 1)
    long = solved.select(
        *group, ((F.col("_n") >= LONG_DAYS) & last.isNotNull()).alias("_long"),
        F.transform(F.sequence(F.lit(0), F.lit(n - 2)), lambda i: cell(F.col("_swept"), i, n - 1)).alias("_coefficients"))
    met = join_null_safe(training, long, group)
    guess = F.get("_coefficients", F.lit(0))
    for i, lag in enumerate(lags):
        guess = guess + F.get("_coefficients", F.lit(i + 1)) * lag
    order = Window.partitionBy(*group).orderBy(day)
    shocked = met.withColumn("_e", F.when(F.col("_long") & full, F.col("_w") - guess))
    terms = [F.lit(1.0), *[F.get("_lags", F.lit(LONG.index(j))) for j in (1, 2, WEEK)], *[F.lag("_e", j).over(order) for j in (1, 2, WEEK)]]
    return shocked.withColumn("_terms", F.array(*terms)).drop("_coefficients")


def fit_orders(shocked: DataFrame, group: list[str], day: str, value: str, more: Sequence[Column] = ()) -> DataFrame:
    """One row per group: ``n``, ``model``, ``d``, ``coefficients`` (of ``TERMS``), ``n_terms`` (their number), ``sse``,
    ``last_day``, ``mean`` and the last week of ``_w``, ``_e``, ``_z`` and the value, latest first.

    ``more`` are further aggregates over the same rows.
    """
    size = len(TERMS) + 1
    use = F.col("_w").isNotNull() & F.when(F.col("_long"), ~F.exists("_terms", lambda x: x.isNull())).otherwise(F.get("_terms", F.lit(1)).isNotNull())
    vector = [F.coalesce(F.get("_terms", F.lit(i)), F.lit(0.0)).alias(f"_t{i}") for i in range(len(TERMS))]
    back = F.date_diff(F.col("_last"), F.col(day))
    recent = F.sort_array(F.collect_list(F.when(back < WEEK, F.struct(
        back.alias("back"), F.col("_w").alias("w"), F.col("_e").alias("e"), F.col("_z").alias("z"), F.col(value).alias("y")))))
    sums = (
        shocked.select("*", use.alias("_use"), *vector, F.max(day).over(Window.partitionBy(*group)).alias("_last"))
        .groupBy(*group).agg(
            F.count(F.when(F.col("_use"), 1)).alias("n"), F.max("_d").alias("d"), F.max("_long").alias("_long"),
            sum_matrix([*[f"_t{i}" for i in range(len(TERMS))], "_w"], "_use").alias("_sums"),
            F.max(day).alias("last_day"), F.avg(value).alias("mean"), recent.alias("_recent"), *more)
    )
    every = F.expr("array(" + ", ".join(f"named_struct('name', '{name}', 'terms', CAST(array({', '.join(map(str, terms))}) AS array<int>))"
                                        for name, terms in candidates()) + ")")
    n = F.col("n")

    def solved(c: Column) -> Column:
        return F.struct(c["name"].alias("model"), c["terms"].alias("terms"), swept(F.col("_sums"), c["terms"]).alias("a"))

    def judged(x: Column) -> Column:
        sse = F.greatest(F.lit(0.0), cell(x["a"], size - 1, size - 1))
        held = F.transform(F.sequence(F.lit(0), F.lit(size - 2)), lambda i: F.when(
            F.array_contains(x["terms"], i), cell(x["a"], i, size - 1)).otherwise(0.0))
        return F.struct(F.size(x["terms"]).alias("n_terms"), x["model"].alias("model"), held.alias("coefficients"), sse.alias("sse"))

    def scored(x: Column) -> Column:
        one, two, weekly = (F.get(x["coefficients"], F.lit(i)) for i in (1, 2, 3))
        # lags that fade: the triangle of two lags, and together with a weekly lag all of them below one
        fades = (F.abs(two) < 0.99) & (two + one < 0.99) & (two - one < 0.99) & (
            (weekly == 0) | (F.abs(one) + F.abs(two) + F.abs(weekly) < 0.99))
        aic = F.round(n * F.ln(F.greatest(F.lit(1e-9), F.try_divide(x["sse"], n))) + 2 * x["n_terms"], 4)
        return F.struct(F.when(fades, aic).alias("aic"), x["n_terms"].alias("n_terms"), x["model"].alias("model"),
                        x["coefficients"].alias("coefficients"), x["sse"].alias("sse"))

    allowed = F.filter(every, lambda c: (
        (F.col("_long") | ~F.exists(c["terms"], lambda t: t > 1)) & ((F.col("d") == 0) | ~F.array_contains(c["terms"], F.lit(0)))
        & ((F.size(c["terms"]) == 0) | (n > 4 * F.size(c["terms"])))))
    best = F.array_min(F.filter(F.transform(F.transform(F.transform(allowed, solved), judged), scored), lambda x: x["aic"].isNotNull()))
    nothing = F.struct(F.lit(None).cast("double").alias("aic"), F.lit(0).alias("n_terms"), F.lit("(0,0)(0,0)").alias("model"),
                       F.array_repeat(F.lit(0.0), len(TERMS)).alias("coefficients"), F.lit(0.0).alias("sse"))
    chosen = sums.withColumn("_best", F.coalesce(best, nothing))

    def last_week(name: str, lacking: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(WEEK - 1)), lambda i: F.coalesce(F.get("_recent", i)[name], lacking))

    return chosen.select(
        *group, "n", "_best.model", "d", "_best.n_terms", "_best.coefficients", "_best.sse", "_best.aic", "last_day", "mean",
        last_week("w", F.lit(0.0)).alias("last_w"), last_week("e", F.lit(0.0)).alias("last_e"), last_week("z", F.lit(0.0)).alias("last_z"),
        last_week("y", F.col("mean")).alias("last_y"), *[c for c in sums.columns if c not in (
            *group, "n", "d", "_long", "_sums", "last_day", "mean", "_recent")])


# --- projection ----------------------------------------------------------------------------

def projected(steps: Column, w: Column, e: Column, z: Column, y: Column, coefficients: Column, d: Column, drift: Column) -> Column:
    """The next ``steps`` values as an array; ``w``, ``e`` and ``y`` are the last week, latest first, ``z`` the last difference.

    Each step adds up the terms, undoes the differences and moves the week on; coming shocks are zero.
    """
    c = [F.get(coefficients, F.lit(i)) for i in range(len(TERMS))]

    def push(values: Column, new: Column) -> Column:
        return F.concat(F.array(new), F.slice(values, 1, WEEK - 1))

    def step(state: Column, _: Column) -> Column:
        at = lambda name, lag: F.get(state[name], F.lit(lag - 1))
        new_w = (drift + c[1] * at("w", 1) + c[2] * at("w", 2) + c[3] * at("w", WEEK)
                 + c[4] * at("e", 1) + c[5] * at("e", 2) + c[6] * at("e", WEEK))
        new_z = F.when(d == 1, state["z"]).otherwise(0.0) + new_w
        new_y = at("y", WEEK) + new_z
        return F.struct(push(state["w"], new_w).alias("w"), push(state["e"], F.lit(0.0)).alias("e"), new_z.alias("z"),
                        push(state["y"], new_y).alias("y"), F.concat(state["out"], F.array(new_y)).alias("out"))

    start = F.struct(w.alias("w"), e.alias("e"), z.alias("z"), y.alias("y"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda state: state["out"])


def impulse(steps: Column, coefficients: Column, d: Column) -> Column:
    """What a shock of one adds to the value of its day and of the following ``steps`` days."""
    one = F.array(*[F.lit(1.0 if i == 0 else 0.0) for i in range(WEEK)])
    return F.concat(F.array(F.lit(1.0)), projected(steps, one, one, F.lit(1.0), one, coefficients, d, F.lit(0.0)))

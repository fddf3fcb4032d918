"""Model quality from predictions, as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cauce.functions.casts import steady_round
from cauce.operators.aggregates import rounded_avg, union_aligned
from cauce.operators.order import in_slices


def mean_squared_error(label: Column, prediction: Column) -> Column:
    return F.avg((prediction - label) * (prediction - label))


def log_loss(label: Column, probability: Column, tiny: float = 1e-15) -> Column:
    p = F.greatest(F.lit(tiny), F.least(F.lit(1 - tiny), probability))
    return F.avg(-F.when(label == 1, F.ln(p)).when(label == 0, F.ln(1 - p)))


def evaluate_regression(pred: DataFrame, label: str, prediction: str, model: str = "model",
                        digits: int | None = 4) -> DataFrame:
    """MSE, MAE, RMSE and R2; the total variation comes from the same pass."""
    y, error = F.col(label), F.col(prediction) - F.col(label)
    sums = pred.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
                    F.var_pop(y).alias("_variance"))
    values = {"mse": F.col("mse"), "mae": F.col("mae"), "rmse": F.sqrt("mse"),
              "r2": 1 - F.try_divide(F.col("mse"), F.col("_variance"))}
    return sums.select(F.lit(model).alias("modelo"), *[
        (v if digits is None else steady_round(v, digits)).alias(n) for n, v in values.items()])


def roc_curve(pred: DataFrame, label: str, probability: str, thresholds: int = 100) -> DataFrame:
    """Counts and rates at evenly spaced thresholds, highest first.

    A score counts at a threshold it equals. Scores are binned first, so only the bins are ordered;
    the bin is the last threshold not above the score, compared as it is, since the product of a
    score and the number of bins may round to either side.
    """
    p = F.col(probability)
    guess = F.floor(p * thresholds)
    exact = F.when((guess + 1) / thresholds <= p, guess + 1).when(guess / thresholds > p, guess - 1).otherwise(guess)
    bin_ = F.least(exact, F.lit(thresholds)).cast("int")
    bins = pred.groupBy(bin_.alias("_bin")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    frame = pred.sparkSession.range(0, thresholds + 1).select(F.col("id").cast("int").alias("_bin"))
    full = frame.join(bins, "_bin", "left").na.fill(0, ["_pos", "_neg"])
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    counts = full.select(
        (F.col("_bin") / thresholds).alias("threshold"),
        F.sum("_pos").over(above).alias("true_positives"),
        F.sum("_neg").over(above).alias("false_positives"),
        F.sum("_pos").over(whole).alias("_p"), F.sum("_neg").over(whole).alias("_n"))
    return counts.select(
        "threshold",
        F.try_divide(F.col("true_positives"), F.col("_p")).alias("recall"),
        F.try_divide(F.col("false_positives"), F.col("_n")).alias("false_positive_rate"),
        "true_positives", "false_positives",
        (F.col("_n") - F.col("false_positives")).alias("true_negatives"),
        (F.col("_p") - F.col("true_positives")).alias("false_negatives"))


def roc_auc(curve: DataFrame) -> DataFrame:
    """Area under the curve by trapezoids, starting from the origin."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("threshold"))
    before_x = F.coalesce(F.lag("false_positive_rate").over(order), F.lit(0.0))
    before_y = F.coalesce(F.lag("recall").over(order), F.lit(0.0))
    strips = curve.select(
        ((F.col("false_positive_rate") - before_x) * (F.col("recall") + before_y) / 2).alias("_area"))
    return strips.agg(F.sum("_area").alias("roc_auc"))


def exact_auc(pred: DataFrame, label: str, probability: str) -> DataFrame:
    """Share of pairs of a positive and a negative that are ordered rightly, ties counting half.

    Equal scores are counted first and then ordered in slices; one class alone gives NULL.
    """
    y = F.col(label)
    counts = pred.where(y.isin(0, 1)).groupBy(F.col(probability).alias("_p")).agg(
        F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))
    ordered = in_slices(counts, ["_p"], "_pos", "_upto", total="_positives")
    above = (F.col("_positives") - F.col("_upto")).cast("double") + F.col("_pos") / 2
    return ordered.agg(F.try_divide(
        F.sum(F.col("_neg") * above), F.sum("_neg") * F.max("_positives").cast("double")).alias("roc_auc"))


def evaluate_classification(pred: DataFrame, label: str, prediction: str, probability: str,
                            model: str = "model", digits: int | None = 4) -> DataFrame:
    """Accuracy, precision, recall, F1, log loss in one pass, and the exact AUC; NULL labels count in none."""
    y, p = F.col(label), F.col(prediction)
    hits = F.count_if((y == 1) & (p == 1))
    counts = pred.agg(
        F.count_if(y == p).alias("_right"), F.count(F.lit(1)).alias("_all"), hits.alias("_tp"),
        F.count_if(p == 1).alias("_called"), F.count_if(y == 1).alias("_true"),
        log_loss(y, F.col(probability)).alias("log_loss"))
    area = exact_auc(pred, label, probability).scalar()
    values = {
        "accuracy": F.try_divide(F.col("_right"), F.col("_all")),
        "precision": F.try_divide(F.col("_tp"), F.col("_called")),
        "recall": F.try_divide(F.col("_tp"), F.col("_true")),
        "f1": F.try_divide(2 * F.col("_tp"), F.col("_called") + F.col("_true")),
        "roc_auc": area, "log_loss": F.col("log_loss"),
    }
    return counts.select(F.lit(model).alias("modelo"), *[
        (v if digits is None else steady_round(v, digits)).alias(n) for n, v in values.items()])


def confusion_matrix(pred: DataFrame, label: str, prediction: str, model: str = "model") -> DataFrame:
    """Expected class by row, predicted class by column."""
    return pred.groupBy(F.col(label).cast("int").alias("expected_label")).agg(
        F.lit(model).alias("modelo"),
        F.count_if(F.col(prediction) == 0).alias("_0"), F.count_if(F.col(prediction) == 1).alias("_1"),
    ).select("modelo", "expected_label", "_0", "_1").orderBy("expected_label")


def metrics_table(regressions: list[DataFrame], classifications: list[DataFrame]) -> DataFrame:
    """All models in one table; metrics a model does not have are NULL."""
    parts = [r.select("modelo", F.lit("Regresion").alias("tipo"), "mse", "mae", "rmse", "r2")
             for r in regressions]
    parts += [c.select("modelo", F.lit("Clasificacion").alias("tipo"), "accuracy", "roc_auc",
                       F.col("f1").alias("f1_score")) for c in classifications]
    names = {"modelo": "string", "tipo": "string", "mse": "double", "mae": "double", "rmse": "double",
             "r2": "double", "accuracy": "double", "roc_auc": "double", "f1_score": "double"}
    whole = union_aligned(parts)
    for name, kind in names.items():
        if name not in whole.columns:
            whole = whole.withColumn(name, F.lit(None).cast(kind))
    return whole.select(*names)


def calibration(pred: DataFrame, label: str, probability: str) -> DataFrame:
    """Real rate and mean probability per probability decile."""
    known = pred.where(F.col(probability).isNotNull())
    return known.groupBy(
        F.round(F.floor(F.col(probability) * 10) / 10, 1).alias("bucket_probabilidad")
    ).agg(F.count(F.lit(1)).alias("n_viajes"),
          rounded_avg(label, 4).alias("tasa_real_high_tip"),
          rounded_avg(probability, 4).alias("probabilidad_promedio")).orderBy("bucket_probabilidad")


def error_by_day(pred: DataFrame) -> DataFrame:
    """Mean real and predicted fare and the error, per day."""
    return pred.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("n_viajes"),
        rounded_avg("fare_real", 3).alias("fare_real_prom"),
        rounded_avg("fare_predicho", 3).alias("fare_pred_prom"),
        steady_round(F.sqrt(F.avg(F.col("error_usd") * F.col("error_usd"))), 3).alias("rmse_dia"),
        steady_round(100 * F.avg(F.abs("error_pct")), 2).alias("mape_dia_pct")).orderBy("pickup_date")


def error_summary(pred: DataFrame) -> DataFrame:
    return pred.agg(
        F.count(F.lit(1)).alias("n_viajes_test"),
        steady_round(F.sqrt(F.avg(F.col("error_usd") * F.col("error_usd"))), 4).alias("rmse_test_usd"),
        steady_round(F.avg(F.abs("error_usd")), 4).alias("mae_test_usd"),
        steady_round(100 * F.avg(F.abs("error_pct")), 2).alias("mape_test_pct"))

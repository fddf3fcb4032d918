"""What drives a model: gains, weights, and the additive attributions of its scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.operators.aggregates import share_of_total
from cauce.operators.models import Trained, slot_names, source_of
from cauce.operators.shapley import attributions


def feature_importance(spark: SparkSession, trained: Trained, df: DataFrame, top: int = 15) -> DataFrame:
    """Gain per input column with its share, largest first."""
    gains: dict[str, float] = {}
    for slot, gain in zip(slot_names(trained, df), trained.model.featureImportances.toArray()):
        name = source_of(slot, trained)
        gains[name] = gains.get(name, 0.0) + float(gain)
    table = spark.createDataFrame(list(gains.items()), "feature string, importancia double")
    shares = share_of_total(table, "importancia", "porcentaje_contribucion")
    return shares.withColumn("importancia", F.round("importancia", 4)).orderBy(
        F.desc("importancia"), "feature").limit(top)


def model_weights(spark: SparkSession, trained: Trained, df: DataFrame) -> DataFrame:
    """Weight per processed input, largest absolute value first."""
    pairs = zip(slot_names(trained, df), trained.model.coefficients.toArray())
    rows = [(slot.split("_", 2)[2], float(w)) for slot, w in pairs]
    rows.append(("__INTERCEPT__", float(trained.model.intercept)))
    return spark.createDataFrame(rows, "variable string, peso double").withColumn(
        "peso", F.round("peso", 4)).orderBy(F.desc(F.abs("peso")), "variable")


def global_explain(rows: DataFrame, trained: Trained, train: DataFrame, model: str, top: int = 15) -> DataFrame:
    """Mean absolute attribution per input over all the rows."""
    each = attributions(rows, trained, train)
    means = each.agg(F.array(*[F.struct(F.lit(c).alias("variable"), F.round(F.avg(F.abs(F.col("attributions")[i])), 4).alias("importancia"))
                               for i, c in enumerate(trained.inputs.columns)]).alias("_all"))
    return means.select(F.lit(model).alias("modelo"), F.explode("_all").alias("_e")).select("modelo", "_e.*").orderBy(
        F.desc("importancia"), "variable").limit(top)


def explain_rows(rows: DataFrame, trained: Trained, train: DataFrame, key: Sequence[str], k: int = 4) -> DataFrame:
    """The k strongest attributions of each row, also of rows that share ``key``, with the score and the base they start from."""
    entries = F.array(*[F.struct(F.abs(F.col("attributions")[i]).alias("size"), F.lit(c).alias("feature"), F.col("attributions")[i].alias("attribution"))
                        for i, c in enumerate(trained.inputs.columns)])
    strongest = F.slice(F.sort_array(entries, asc=False), 1, k)
    return attributions(rows, trained, train, key).select(*key, "score", "base", F.posexplode(strongest).alias("_pos", "_e")).select(
        *key, "score", "base", (F.col("_pos") + 1).alias("rank"), "_e.feature", "_e.attribution")

"""Supervised models with MLlib: fit on TRAIN, choose on EVAL, predict on TEST."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from cauce.operators.evaluate import log_loss, mean_squared_error
from cauce.sources.scratch import materialise

# Trial settings of the two tuned models, drawn from the candidate lists
# depth {6, 10} x rate {0.05, 0.1} x sample {0.8, 1.0} and
# depth {8, 12, 16} x trees {40, 60} x sample {0.6, 0.8, 0.99}.
GBT_TRIALS = ({"maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8},
              {"maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 1.0},
              {"maxDepth": 10, "stepSize": 0.1, "subsamplingRate": 0.8})
FOREST_TRIALS = ({"maxDepth": 8, "numTrees": 40, "subsamplingRate": 0.6},
                 {"maxDepth": 8, "numTrees": 60, "subsamplingRate": 0.8},
                 {"maxDepth": 12, "numTrees": 40, "subsamplingRate": 0.99},
                 {"maxDepth": 16, "numTrees": 60, "subsamplingRate": 0.8})


@dataclass(frozen=True)
class Inputs:
    """Label and input columns of a model."""

    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical]


@dataclass(frozen=True)
class Trained:
    """A fitted chain from raw input columns to predictions, with its training record.

    ``saved`` is the folder that the model was loaded from, if it was.
    """

    prepare: PipelineModel
    model: object
    inputs: Inputs
    history: tuple[float, ...] = ()
    trials: tuple[dict, ...] = field(default=())
    saved: str | None = field(default=None, compare=False)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepare.transform(df))


def preparation(inputs: Inputs, one_hot: bool) -> Pipeline:
    """Missing numbers take the mean, unseen or missing categories their own slot."""
    numbers = [f"_num_{c}" for c in inputs.numeric]
    indexed = [f"_idx_{c}" for c in inputs.categorical]
    stages = [
        Imputer(strategy="mean", inputCols=list(inputs.numeric), outputCols=numbers),
        StringIndexer(inputCols=list(inputs.categorical), outputCols=indexed,
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
    ]
    coded = indexed
    if one_hot:
        coded = [f"_hot_{c}" for c in inputs.categorical]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=False))
    stages.append(VectorAssembler(inputCols=[*numbers, *coded], outputCol="features"))
    return Pipeline(stages=stages)


def slot_names(trained: Trained, df: DataFrame) -> list[str]:
    """Name of each vector slot, read from the metadata the assembler leaves on the column."""
    numeric = {c: F.col(c).cast("double") for c in trained.inputs.numeric}
    prepared = trained.prepare.transform(df.limit(0).withColumns(numeric))
    attributes = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    return [name for _, name in slots]


def source_of(slot: str, trained: Trained) -> str:
    for prefix in ("_num_", "_idx_", "_hot_"):
        if slot.startswith(prefix):
            rest = slot[len(prefix):]
            return max((c for c in trained.inputs.columns if rest == c or rest.startswith(c + "_")), key=len)
    return slot


def _doubles(df: DataFrame, inputs: Inputs) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in inputs.numeric})


def _prepared(view: DataFrame, inputs: Inputs, one_hot: bool, weighted: bool = False):
    """Fitted preparation and the TRAIN and EVAL vectors, written once for the many fitting passes."""
    known = _doubles(view.where(F.col("split_set").isin("TRAIN", "EVAL")), inputs).withColumn(
        "label", F.col(inputs.label).cast("double"))
    prepare = preparation(inputs, one_hot).fit(known.where("split_set = 'TRAIN'"))
    vectors = prepare.transform(known).select("split_set", "features", "label")
    if weighted:
        vectors = vectors.withColumn("weight", class_weight(known))
    vectors = materialise(vectors, "vectors")
    return prepare, vectors.where("split_set = 'TRAIN'"), vectors.where("split_set = 'EVAL'")


def class_weight(known: DataFrame) -> Column:
    """n / (classes * n of the class), counted on TRAIN."""
    counts = {r["label"]: r["n"] for r in known.where("split_set = 'TRAIN'").groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for label, n in counts.items():
        weight = F.when(F.col("label") == label, F.lit(total / (len(counts) * n))).otherwise(weight)
    return weight


def positive_probability(vector: str = "probability") -> Column:
    return vector_to_array(F.col(vector))[1]


def fit_linear(view: DataFrame, inputs: Inputs, l2: float = 0.05, iterations: int = 30) -> Trained:
    """Ridge regression on TRAIN by iterative solver, so that its loss history exists."""
    prepare, train, _ = _prepared(view, inputs, one_hot=True)
    model = LinearRegression(regParam=l2, elasticNetParam=0.0, maxIter=iterations, solver="l-bfgs").fit(train)
    return Trained(prepare, model, inputs, tuple(model.summary.objectiveHistory))


def fit_logistic(view: DataFrame, inputs: Inputs, l1: float = 0.001, l2: float = 0.05,
                 iterations: int = 40) -> Trained:
    """Elastic-net logistic regression on TRAIN with balanced class weights."""
    prepare, train, _ = _prepared(view, inputs, one_hot=True, weighted=True)
    model = LogisticRegression(regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2), maxIter=iterations,
                               weightCol="weight").fit(train)
    return Trained(prepare, model, inputs, tuple(model.summary.objectiveHistory))


def _bins(prepare, least: int = 64) -> int:
    """Bins of a tree: one for each label of the widest category, its slot for unseen ones included."""
    widest = [len(labels) for stage in prepare.stages if hasattr(stage, "labelsArray") for labels in stage.labelsArray]
    return max([least, *(n + 1 for n in widest)])


def _best_trial(make: Callable[[dict], object], trials: Sequence[dict], train: DataFrame, evaluation: DataFrame,
                loss: Callable[[DataFrame], Column]):
    """Fit every setting on TRAIN; the least EVAL loss wins."""
    fitted, record = [], []
    for number, setting in enumerate(trials, start=1):
        model = make(setting).fit(train)
        losses = [model.transform(part).agg(loss(part)).first()[0] for part in (train, evaluation)]
        fitted.append(model)
        record.append({"trial_id": number, "hyperparameters": dict(setting), "training_loss": losses[0],
                       "eval_loss": losses[1], "status": "SUCCEEDED"})
    best = min(range(len(record)), key=lambda i: record[i]["eval_loss"])
    for i, row in enumerate(record):
        row["is_optimal"] = i == best
    return fitted[best], tuple(record)


def fit_gbt_tuned(view: DataFrame, inputs: Inputs, trials: Sequence[dict] = GBT_TRIALS, trees: int = 30,
                  seed: int = 42) -> Trained:
    prepare, train, evaluation = _prepared(view, inputs, one_hot=False)
    model, record = _best_trial(
        lambda s: GBTRegressor(maxIter=trees, seed=seed, maxBins=_bins(prepare), **s), trials, train, evaluation,
        lambda _: mean_squared_error(F.col("label"), F.col("prediction")))
    return Trained(prepare, model, inputs, trials=record)


def fit_forest_tuned(view: DataFrame, inputs: Inputs, trials: Sequence[dict] = FOREST_TRIALS,
                     seed: int = 42) -> Trained:
    prepare, train, evaluation = _prepared(view, inputs, one_hot=False, weighted=True)
    model, record = _best_trial(
        lambda s: RandomForestClassifier(weightCol="weight", seed=seed, maxBins=_bins(prepare), **s), trials, train,
        evaluation, lambda _: log_loss(F.col("label"), positive_probability()))
    return Trained(prepare, model, inputs, trials=record)


def training_info(spark, trained: Trained) -> DataFrame:
    """Loss per iteration."""
    rows = [(i, float(loss)) for i, loss in enumerate(trained.history)]
    return spark.createDataFrame(rows, "iteration int, loss double")


def trial_info(spark, trained: Trained) -> DataFrame:
    """One row per trial, best EVAL loss first."""
    names = sorted({k for t in trained.trials for k in t["hyperparameters"]})
    rows = [(t["trial_id"], *[float(t["hyperparameters"][n]) for n in names], t["training_loss"],
             t["eval_loss"], t["status"], t["is_optimal"]) for t in trained.trials]
    columns = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(
        rows, f"trial_id int, {columns}, training_loss double, eval_loss double, status string, "
              "is_optimal boolean").orderBy("eval_loss")


def score(df: DataFrame, trained: Trained, probability: bool = False) -> DataFrame:
    """Rows with their prediction, and the probability of class 1 for classifiers."""
    scored = trained.transform(_doubles(df, trained.inputs))
    extra = [positive_probability().alias("probability_1")] if probability else []
    return scored.select(*df.columns, F.col("prediction"), *extra)


def predict_fare(view: DataFrame, trained: Trained, split: str = "TEST") -> DataFrame:
    """Holdout fares: real, predicted, error and relative error."""
    scored = score(view.where(F.col("split_set") == split), trained)
    real, predicted = F.col("fare_amount"), F.col("prediction")
    return scored.select(
        "pickup_date", "pickup_borough", "dropoff_borough", "trip_distance", "trip_duration_minutes",
        real.alias("fare_real"), predicted.alias("fare_predicho"),
        F.round(predicted - real, 4).alias("error_usd"),
        F.round(F.try_divide(predicted - real, F.nullif(real, F.lit(0))), 4).alias("error_pct"))


def predict_tip(view: DataFrame, trained: Trained, split: str = "TEST") -> DataFrame:
    """Holdout tips: real class, predicted class, probability of a high tip."""
    scored = score(view.where(F.col("split_set") == split), trained, probability=True)
    return scored.select(
        "pickup_date", "pickup_borough", "fare_amount", "trip_distance",
        F.col("high_tip").alias("real_high_tip"),
        F.col("prediction").cast("int").alias("predicted_high_tip"),
        F.col("probability_1").alias("prob_high_tip"))

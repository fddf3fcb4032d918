"""Features, time splits and balance tables for supervised models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from cauce.functions.casts import safe_divide, steady_round
from cauce.functions.maps import bucketize, flag
from cauce.operators.aggregates import rounded_avg
from cauce.operators.joins import role_play
from cauce.operators.rows import filter_and_drop
from cauce.sources.tables import schema_table

# Holidays of the trip year.
HOLIDAYS = tuple(date.fromisoformat(d) for d in (
    "2022-01-01", "2022-01-17", "2022-02-21", "2022-05-30", "2022-06-20", "2022-07-04",
    "2022-09-05", "2022-10-10", "2022-11-11", "2022-11-24", "2022-12-25", "2022-12-26"))
# Airport zones and busiest zones.
AIRPORT_ZONES = (132, 138)
HOT_ZONES = (132, 138, 237, 238, 239, 161, 142, 141, 170, 114, 48, 186, 90, 79)
# Upper edges of the distance buckets.
DISTANCE_EDGES = [(1, "0-1 mi"), (3, "1-3 mi"), (6, "3-6 mi"), (12, "6-12 mi")]
DISTANCE_LAST = "12+ mi"

# Model inputs, in the order the models list them.
NUMERIC = ("trip_distance", "trip_duration_minutes", "avg_speed_mph", "passenger_count",
           "pickup_hour", "pickup_dow", "pickup_month",
           "is_weekend", "is_rush_am", "is_rush_pm", "is_night", "is_holiday",
           "is_airport_pickup", "is_airport_dropoff", "is_hot_zone", "extra", "tolls_amount")
CATEGORICAL = ("pickup_borough", "dropoff_borough", "vendor_id_str", "distance_bucket")
# What the non-feature columns are for.
ROLES = {"fare_amount": "OBJETIVO (label)", "split_set": "SPLIT (no feature)",
         "pickup_date": "REFERENCIA (no feature)", "pickup_datetime": "REFERENCIA (no feature)"}
ROLE_FEATURE = "ENTRADA (feature)"


@dataclass(frozen=True)
class FeatureConfig:
    """Cut dates and lists that depend on the data at hand."""

    train_until: date = date(2022, 9, 16)
    eval_until: date = date(2022, 11, 1)
    holidays: tuple[date, ...] = HOLIDAYS
    airports: tuple[int, ...] = AIRPORT_ZONES
    hot_zones: tuple[int, ...] = HOT_ZONES
    high_tip: float = 0.20


def temporal_split(day: Column, train_until: date, eval_until: date) -> Column:
    """TRAIN before the first cut, EVAL before the second, TEST after; never random."""
    return (F.when(day < F.lit(train_until), "TRAIN")
            .when(day < F.lit(eval_until), "EVAL").otherwise("TEST"))


def trip_features(trips: DataFrame, zones: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Split, time, physical, place and context features, control columns, and both labels."""
    day, moment = F.col("pickup_date"), F.col("pickup_datetime")
    hour, weekday = F.hour(moment), F.dayofweek(moment)
    origin, destination = F.col("pickup_location_id"), F.col("dropoff_location_id")
    placed = role_play(trips, zones, "location_id", {
        "pickup_location_id": {"borough": "pickup_borough"},
        "dropoff_location_id": {"borough": "dropoff_borough"}})
    speed = safe_divide(F.col("trip_distance"), F.col("trip_duration_minutes") / 60)
    made = {
        "split_set": temporal_split(day, config.train_until, config.eval_until),
        "pickup_hour": hour, "pickup_dow": weekday, "pickup_month": F.month(moment),
        "is_weekend": flag(weekday.isin(1, 7)), "is_rush_am": flag(hour.between(6, 9)),
        "is_rush_pm": flag(hour.between(16, 19)), "is_night": flag((hour >= 22) | (hour < 5)),
        "is_holiday": flag(day.isin(*[F.lit(d) for d in config.holidays])),
        "avg_speed_mph": F.round(speed, 2),
        "is_airport_pickup": flag(origin.isin(*config.airports)),
        "is_airport_dropoff": flag(destination.isin(*config.airports)),
        "is_hot_zone": flag(origin.isin(*config.hot_zones)),
        "vendor_id_str": F.col("vendor_id").cast("string"),
        "distance_bucket": bucketize(F.col("trip_distance"), DISTANCE_EDGES, DISTANCE_LAST),
        "high_tip": flag(F.col("tip_ratio") >= config.high_tip),
    }
    order = ["split_set", "pickup_hour", "pickup_dow", "pickup_month", "is_weekend", "is_rush_am",
             "is_rush_pm", "is_night", "is_holiday", "trip_distance", "trip_duration_minutes",
             "avg_speed_mph", "passenger_count", "pickup_borough", "dropoff_borough", "is_airport_pickup",
             "is_airport_dropoff", "is_hot_zone", "extra", "tolls_amount", "vendor_id_str",
             "distance_bucket", "rate_code", "payment_type", "fare_amount", "high_tip", "pickup_date",
             "pickup_datetime"]
    return placed.select(*[made[c].alias(c) if c in made else F.col(c) for c in order])


def fare_view(features: DataFrame) -> DataFrame:
    """Metered trips for the fare model."""
    return filter_and_drop(features, F.col("rate_code") == 1, ["rate_code", "payment_type", "high_tip"])


def tip_view(features: DataFrame) -> DataFrame:
    """Card trips with a fare of at least 3 for the tip model."""
    keep = (F.col("payment_type") == 1) & (F.col("fare_amount") >= 3)
    return filter_and_drop(features, keep, ["rate_code", "payment_type"])


def split_balance(features: DataFrame) -> DataFrame:
    """Rows, share, period and label statistics of each split."""
    total = features.agg(F.count(F.lit(1))).scalar()
    return features.groupBy("split_set").agg(
        F.count(F.lit(1)).alias("n_registros"),
        F.min("pickup_date").alias("desde"), F.max("pickup_date").alias("hasta"),
        rounded_avg("fare_amount", 3).alias("fare_medio"),
        steady_round(F.stddev("fare_amount"), 3).alias("fare_stddev"),
        rounded_avg("high_tip", 4).alias("tasa_high_tip"),
    ).withColumn("pct", F.round(100 * F.col("n_registros") / total, 2)).orderBy("desde")


def class_balance(view: DataFrame, label: str = "high_tip", split: str = "TRAIN") -> DataFrame:
    chosen = view.where(F.col("split_set") == split)
    total = chosen.agg(F.count(F.lit(1))).scalar()
    counts = chosen.groupBy(label).agg(F.count(F.lit(1)).alias("n_viajes"))
    return counts.withColumn("pct", F.round(100 * F.col("n_viajes") / total, 2)).orderBy(label)


def feature_inventory(view: DataFrame, roles: Mapping[str, str] = ROLES) -> DataFrame:
    """Name, type and role of every column."""
    role = F.lit(ROLE_FEATURE)
    for column, name in roles.items():
        role = F.when(F.col("column") == column, F.lit(name)).otherwise(role)
    return schema_table(view).select("position", "column", "data_type", role.alias("rol")).orderBy("position")


def feature_info(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Range, mean, deviation, NULLs and number of categories per model input."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("input"), F.col(c).cast("double").alias("v"),
                 F.lit(None).cast("string").alias("label")) for c in numeric
    ] + [
        F.struct(F.lit(c).alias("input"), F.lit(None).cast("double").alias("v"),
                 F.col(c).cast("string").alias("label")) for c in categorical
    ])
    is_category = F.col("input").isin(*categorical) if categorical else F.lit(False)
    missing = F.when(is_category, F.col("label").isNull()).otherwise(F.col("v").isNull())
    return df.select(F.explode(cells).alias("_c")).select("_c.*").groupBy("input").agg(
        F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"),
        F.stddev("v").alias("stddev"), F.count_if(missing).alias("null_count"),
        F.count_distinct("label").alias("category_count"))

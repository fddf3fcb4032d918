"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Joins, loads and fits are timed as such. The raw trips, the zones and the feature table are derived
inputs: they are written in the warm-up run and only read in the timed ones; no headline query reads
another one's result. The
layout queries run on the plain and on the partitioned trips, N5 with all and with two columns of
a day: the median of three warm runs, and the column bytes in the files left after pruning. The flights load runs from raw orders to the
written fact and also gives rows per second.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from cauce.operators import models
from cauce.operators.series import rolling_origin
from cauce.plans import flights
from cauce.session import build_session
from cauce.sources.scratch import new_path
from cauce.sources.tables import load_idempotent
from workload import data, forecasting, learning, load_all
from workload.registry import QUERIES

AGGREGATES = ("b02_clean_trips", "b03_rule_profile", "c04_star_join", "d04_distribution", "d06_agg_daily",
              "d07_hourly_profile", "d09_payment_comparison", "d10_top_routes", "d16_having", "d29_describe", "d32_exact_median", "d34_histogram", "d35_box_plot",
              "e05_keep_first", "c01_header_detail_join", "j08_split_overlap", "l01_trip_features",
              "l14_evaluate_classification")


def seconds(run, times: int = 3) -> float:
    """Median of warm runs."""
    run()
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 4)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def layout_runs(spark, sf: str) -> tuple[dict[str, float], dict[str, dict]]:
    times, sizes = {}, {}
    for name in forecasting.BENCHMARK:
        plain, monthly = forecasting.benchmark_pair(spark, sf, name)
        times[f"{name}_plain"] = seconds(lambda: drain(plain()))
        times[name] = seconds(lambda: drain(monthly()))
        whole, left = forecasting.bytes_read(spark, sf, name)
        sizes[name] = {"bytes_plain": whole, "bytes_partitioned": left,
                       "reduction_pct": round(100 * (1 - left / whole), 2)}
    return times, sizes


def flights_load(spark, sf: str) -> tuple[float, int]:
    rows = data.table(spark, sf, "orders").count()

    def run() -> None:
        clean = flights.transform_flights(data.raw_flights(spark, sf), ["file_order"])
        star = flights.load_star(clean, data.LOAD_TS, order=["file_order"])
        load_idempotent(star.fact, new_path(spark, "fact"))

    taken = seconds(run, 1)
    return taken, int(rows / taken)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("cauce-bench", master=f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    times, sizes = layout_runs(spark, sf)
    times["flights_load"], rate = flights_load(spark, sf)
    for name in AGGREGATES:
        times[name] = seconds(lambda: drain(QUERIES[name](spark, sf)))
    times["m03_rolling_origin"] = seconds(lambda: drain(rolling_origin(
        forecasting.daily_orders(spark, sf), forecasting.KEYS, forecasting.DAY, forecasting.VALUE,
        forecasting.ORIGINS)), 1)
    times["l07_fit_linear"] = seconds(lambda: models.fit_linear(learning.fare_view(spark, sf), learning.FARE), 1)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "layout": sizes, "flights_rows_per_sec": rate,
    }))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()

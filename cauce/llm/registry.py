"""The queries of this folder and the SQL of those that SQL can state."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("toxicity", "quality_model", "secrets", "chat", "substrings", "topk", "bpe", "simhash", "rules", "packing",
           "merkle", "alignment", "sharding")


def query(name: str, sql: str | None = None):
    """Register a query, with its oracle where SQL can state one."""
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def load_all() -> None:
    """Import every operator module; each registers its query."""
    for name in MODULES:
        importlib.import_module(f"cauce.llm.{name}")


def findable(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it; on a cluster it is installed there."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

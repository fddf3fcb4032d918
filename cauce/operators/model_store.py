"""Models that outlive a session: preparation, model, history and trials under one version, published by a pointer."""

from __future__ import annotations

import importlib
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from cauce.operators.models import Inputs, Trained
from cauce.sources.publish import publish, published, read_text, replace_text


def publish_model(spark: SparkSession, root: str, name: str, trained: Trained) -> str:
    """Write a version of the model and make it the published one; gives its path.

    Its parts are written first, so a reader gets the old version or the whole new one; earlier
    versions stay until ``sources.publish.vacuum`` removes them.
    """
    path = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    trained.prepare.write().save(f"{path}/prepare")
    trained.model.write().save(f"{path}/model")
    kind = type(trained.model)
    facts = {"class": f"{kind.__module__}.{kind.__qualname__}", "label": trained.inputs.label, "numeric": trained.inputs.numeric,
             "categorical": trained.inputs.categorical, "history": [float(x) for x in trained.history], "trials": list(trained.trials)}
    replace_text(spark, f"{path}/facts.json", json.dumps(facts))
    publish(spark, root, {name: path})
    return path


def load_model(spark: SparkSession, root: str, name: str) -> Trained:
    """The published version of a model, without a fit; KeyError if there is none."""
    path = published(spark, root)[name]
    facts = json.loads(read_text(spark, f"{path}/facts.json"))
    module, _, kind = facts["class"].rpartition(".")
    if not module.startswith("pyspark.ml."):
        raise ValueError(f"{facts['class']} is no model of the library")
    model = getattr(importlib.import_module(module), kind).load(f"{path}/model")
    inputs = Inputs(facts["label"], tuple(facts["numeric"]), tuple(facts["categorical"]))
    return Trained(PipelineModel.load(f"{path}/prepare"), model, inputs, tuple(facts["history"]), tuple(facts["trials"]), f"{path}/model")

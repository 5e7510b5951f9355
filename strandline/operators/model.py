"""Random forests over labelled features: fitted, kept as files, applied, and fitted many at once for cross-validation and scans."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from typing import Any

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.detect import balanced_sample
from strandline.sources.files import join_path, read_bytes, write_bytes


def train_forest(labelled: DataFrame, features: Sequence[str], key: str, ntree: int = 50, mtry: int | str = "auto", balance: bool = True, fp_multiple: float = 1.0, seed: int = 1):
    """A fitted forest on TP against FP rows; with balance, at most fp_multiple FP rows for each TP row."""
    rows = balanced_sample(labelled, fp_multiple, key) if balance else labelled.where("label in ('TP', 'FP')")
    x = VectorAssembler(inputCols=list(features), outputCol="__x", handleInvalid="skip").transform(rows).withColumn("__y", (F.col("label") == "TP").cast("double"))
    return RandomForestClassifier(featuresCol="__x", labelCol="__y", numTrees=ntree, featureSubsetStrategy=str(mtry), seed=seed).fit(x)


def score_forest(model, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """rows with prob, the forest's probability of TP."""
    x = VectorAssembler(inputCols=list(features), outputCol="__x", handleInvalid="skip").transform(rows)
    return model.transform(x).withColumn("prob", vector_to_array("probability")[1]).drop("__x", "rawPrediction", "probability", "prediction")


#: Fits that run at the same time; each is a handful of Spark jobs that share the cluster.
AT_ONCE = 4


def all_at_once(calls: Sequence[Callable[[], Any]], at_once: int = AT_ONCE) -> list:
    """The results of calls that start Spark jobs, in their order; at most at_once of them run at a time."""
    with ThreadPoolExecutor(max(1, min(at_once, len(calls) or 1))) as pool:
        return list(pool.map(lambda c: c(), calls))


def cross_validate(labelled: DataFrame, features: Sequence[str], key: str, cv_it: int = 2, cv_split: float = 0.75, at_once: int = AT_ONCE, **options) -> DataFrame:
    """(iteration, key, label, prob) of the rows left out, over cv_it repeats that fit on cv_split of the rows, several at a time."""

    def part(i: int) -> DataFrame:
        u = F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(1000)) / 1000
        held = labelled.where(u >= cv_split)
        scored = score_forest(train_forest(labelled.where(u < cv_split), features, key, seed=i, **options), held, features)
        return scored.select(F.lit(i).alias("iteration"), key, "label", "prob")

    return reduce(DataFrame.unionByName, all_at_once([partial(part, i) for i in range(cv_it)], at_once))


def save_forest(model: RandomForestClassificationModel, features: Sequence[str], folder: str) -> str:
    """The model and the names of its features as files; the folder, which is what a process that makes a model returns."""
    model.write().overwrite().save(join_path(folder, "forest"))
    write_bytes(SparkSession.active(), join_path(folder, "features.json"), json.dumps(list(features)).encode())
    return folder


def load_forest(spark: SparkSession, folder: str) -> tuple[RandomForestClassificationModel, list[str]]:
    return RandomForestClassificationModel.load(join_path(folder, "forest")), json.loads(read_bytes(spark, join_path(folder, "features.json")))


def train_process(features: Sequence[str], key: str) -> Callable:
    """A process that fits a forest on its first input by its parameters (ntree, mtry, balance_tpfp, fp_multiple); its output is the model's folder, so its
    outfile should say `.model`."""

    def fn(inputs: Sequence[DataFrame], params: dict[str, str], folder: str) -> str:
        options = {"ntree": int(params.get("ntree", 50)), "mtry": params.get("mtry", "auto"), "balance": params.get("balance_tpfp", "y") == "y", "fp_multiple": float(params.get("fp_multiple", 1.0)), "seed": int(params.get("seed", 1))}
        return save_forest(train_forest(inputs[0], features, key, **options), features, folder)

    return fn


def apply_process(inputs: Sequence[DataFrame], params: dict[str, str]) -> DataFrame:  # noqa: ARG001
    """A process of two inputs, the folder of a model (as its node gives it) and rows with its features: the rows with prob."""
    model, rows = inputs if inputs[0].columns == ["path"] or "path" in inputs[0].columns else inputs[::-1]
    forest, features = load_forest(rows.sparkSession, model.first().path)
    return score_forest(forest, rows, features)

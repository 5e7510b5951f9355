"""Fitted models as outputs of nodes that others take."""

import threading
import time

from pyspark.sql import functions as F

from strandline.operators import model
from strandline.plans.engine import Engine
from strandline.plans.graph import Compiler, Registry, Scope


def labelled(spark, n=400):
    return spark.range(n).select("id", (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"), F.when(F.col("id") % 10 > 6, "TP").otherwise("FP").alias("label"))


def plan(spark, tmp_path, calls, tree, loop=False):
    registry = Registry()
    registry.process("Load")(lambda inputs, params: labelled(spark))
    fit = model.train_process(["a", "b"], "id")
    registry.process("Train", "OneUpstream", ("GetLoad",), outfile="forest.model")(lambda inputs, params, folder: calls.append(params["ntree"]) or fit(inputs, params, folder))
    registry.process("Apply", "TwoUpstream_noCon", ("GetLoad", "GetTrain"))(model.apply_process)
    train = {"pipe": "OneUpstream", "OneUpstream": {"process": "Train", "GetLoad": {"process": "Load"}}}
    whole = {"loop_on": "Train", **train} if loop else {"pipe": "TwoUpstream_noCon", "TwoUpstream_noCon": {"process": "Apply", "GetLoad": {"process": "Load"}, "GetTrain": train}}
    return Engine(spark, registry, f"file://{tmp_path}/store"), Compiler(registry).compile(whole, Scope({"Train": {"parameters": tree}}))


def test_train_and_apply_from_a_plan_and_reuse(spark, tmp_path):
    calls = []
    engine, node = plan(spark, tmp_path, calls, {"ntree": "7", "fp_multiple": "2", "mtry": "all"})
    engine.run(node)
    rows = engine.result(node).collect()
    assert len(rows) == 400 and sum((r.prob > 0.5) == (r.label == "TP") for r in rows) > 390 and calls == ["7"]
    engine.store.drop([node.fingerprint])
    assert [n.name for n in node.walk() if n.fingerprint in engine.run(node).reused] and calls == ["7"]
    path = next(engine.store.get(n.fingerprint).first().path for n in node.walk() if n.name == "Train")
    forest, features = model.load_forest(spark, path)
    assert forest.getNumTrees == 7 and features == ["a", "b"]
    # other parameters are another model
    other, changed = plan(spark, tmp_path, calls, {"ntree": "3", "mtry": "all"})
    other.run(changed)
    assert calls == ["7", "3"]


def test_models_of_a_scan_are_fitted_together_and_collected(spark, tmp_path):
    calls = []
    engine, node = plan(spark, tmp_path, calls, {"ntree": ["2", "3", "4"]}, loop=True)
    engine.run(node)
    assert sorted(calls) == ["2", "3", "4"]
    folders = sorted(r.path for r in engine.result(node).collect())
    assert [f.rsplit("/", 1)[1] for f in folders] == ["1_forest.model", "2_forest.model", "3_forest.model"]
    assert [model.load_forest(spark, f)[0].getNumTrees for f in folders] == [2, 3, 4]


def test_a_bounded_number_runs_at_once():
    now, most, lock = [0], [0], threading.Lock()

    def call(i):
        def run():
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(0.05)
            with lock:
                now[0] -= 1
            return i

        return run

    assert model.all_at_once([call(i) for i in range(10)], 3) == list(range(10)) and 2 <= most[0] <= 3
    assert model.all_at_once([]) == []


def test_repeats_at_once_are_those_one_by_one(spark):
    df = labelled(spark, 200)
    one, three = (sorted(tuple(r) for r in model.cross_validate(df, ["a", "b"], "id", cv_it=3, ntree=3, at_once=k).collect()) for k in (1, 3))
    assert one == three and {r[0] for r in one} == {0, 1, 2}

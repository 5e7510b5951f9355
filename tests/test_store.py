"""Publication by several drivers, collection of what nothing uses, edits carried on, programs with a limit."""

import itertools
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from strandline.functions import shared
from strandline.operators import segments
from strandline.operators.review import merge_edits
from strandline.plans.engine import Engine, ReviewPending
from strandline.plans.graph import Compiler, Registry, Scope
from strandline.plans.methods import profile_of, run_lines
from strandline.sources import files


def simple(spark, root, n="10", patience=60.0):
    registry = Registry()
    registry.process("Load")(lambda inputs, params: spark.range(int(params["n"])).withColumn("x", F.lit(1)))
    registry.process("Double", "OneUpstream", ("GetLoad",))(lambda inputs, params: inputs[0].withColumn("x", F.col("x") * 2))
    node = Compiler(registry).compile({"pipe": "OneUpstream", "OneUpstream": {"process": "Double", "GetLoad": {"process": "Load"}}}, Scope({"Load": {"parameters": {"n": n}}}))
    engine = Engine(spark, registry, root)
    engine.store.patience = patience
    return engine, node


def test_two_drivers_at_once_give_one_entry(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    engines = [simple(spark, root) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        runs = list(pool.map(lambda x: x[0].run(x[1]), engines))
    engine, node = engines[0]
    folder = tmp_path / "s" / "cache" / node.fingerprint
    assert [x for x in os.listdir(folder) if x.startswith("data-")] == [engine.store.entry(node.fingerprint)["path"].rsplit("/", 1)[1]]
    assert not [x for x in os.listdir(folder) if x.startswith(("claim", "manifest-"))] and all(r.outputs == runs[0].outputs for r in runs)
    assert engine.result(node).count() == 10


def test_a_claim_left_behind_is_taken_over(spark, tmp_path):
    engine, node = simple(spark, f"file://{tmp_path}/s", patience=0.3)
    (tmp_path / "s" / "cache" / node.fingerprint).mkdir(parents=True)
    (tmp_path / "s" / "cache" / node.fingerprint / "claim").touch()
    engine.run(node)
    assert engine.result(node).count() == 10


def test_unreachable_tables_and_half_made_data_go(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    engine, node = simple(spark, root)
    other, unused = simple(spark, root, "7")
    engine.run(node)
    other.run(unused)
    half = tmp_path / "s" / "cache" / node.fingerprint / "data-half"
    half.mkdir()
    assert engine.store.sweep([node]) == []  # all of it is fresh
    gone = engine.store.sweep([node], grace_s=0)
    assert sorted(x.rsplit("/", 1)[1] for x in gone) == sorted([unused.fingerprint, "data-half"])
    assert engine.result(node).count() == 10 and not engine.store.has(unused.fingerprint) and not half.exists()
    assert engine.run(node).reused


def test_a_run_leaves_no_intermediate_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_dir", lambda s: f"file://{tmp_path}/shared")
    registry = Registry()
    registry.process("Number")(lambda inputs, params: segments.row_numbers(spark.range(50), ["id"]))
    node = Compiler(registry).compile({"process": "Number"}, Scope({}))
    engine = Engine(spark, registry, f"file://{tmp_path}/s")
    engine.run(node)
    assert sorted(r.Selection for r in engine.result(node).collect()) == list(range(1, 51))
    assert os.listdir(tmp_path / "shared") == []
    with shared.scratch():
        assert segments.row_numbers(spark.range(5), ["id"]).count() == 5 and os.listdir(tmp_path / "shared")
    assert os.listdir(tmp_path / "shared") == []


# ---------------------------------------------------------------- review


def test_three_way_merge_of_every_case(spark):
    values = [None, "a", "b", "c"]
    cases = list(enumerate(itertools.product(values, repeat=3)))
    frame = lambda k: spark.createDataFrame([(i, c[k], "x") for i, c in cases if c[k] is not None], "id int, v string, w string")
    merged, conflicts = merge_edits(frame(0), frame(1), frame(2), ["id"])
    want, clash = {}, set()
    for i, (b, e, p) in cases:
        take = p if b == e else e
        if take is not None:
            want[i] = take
        if b != e and b != p and e != p:
            clash.add(i)
    assert {r.id: r.v for r in merged.collect()} == want and merged.columns == ["id", "v", "w"]
    rows = {r.id: r for r in conflicts.collect()}
    assert set(rows) == clash and all((rows[i].edited and rows[i].edited.v) == cases[i][1][1] for i in clash)


def test_a_null_in_a_row_is_no_missing_row(spark):
    df = lambda v: spark.createDataFrame([(1, v)], "id int, v string")
    merged, conflicts = merge_edits(df("a"), df(None), df("a"), ["id"])
    assert [tuple(r) for r in merged.collect()] == [(1, None)] and conflicts.count() == 0


def test_edits_survive_a_change_upstream(spark, tmp_path):
    rows = {"1": [(1, "x"), (2, "x"), (3, "x")], "2": [(1, "x"), (2, "y"), (3, "y"), (4, "x")]}

    def plan(version):
        registry = Registry()
        registry.process("Load")(lambda inputs, params: spark.createDataFrame(rows[params["v"]], "id int, note string"))
        registry.process("Edit", "OneUpstream", ("GetLoad",), review=True, review_key=("id",))(None)
        node = Compiler(registry).compile({"pipe": "OneUpstream", "OneUpstream": {"process": "Edit", "GetLoad": {"process": "Load"}}}, Scope({"Load": {"parameters": {"v": version}}}))
        return Engine(spark, registry, f"file://{tmp_path}/s"), node

    engine, node = plan("1")
    with pytest.raises(ReviewPending) as stop:
        engine.run(node)
    assert stop.value.pending.conflicts is None
    engine.accept(stop.value.pending, spark.createDataFrame([(1, "mine"), (2, "mine"), (3, "x")], "id int, note string"))
    engine.run(node)
    again, changed = plan("2")
    with pytest.raises(ReviewPending) as stop:
        again.run(changed)
    pending = stop.value.pending
    assert sorted(map(tuple, spark.read.parquet(pending.path).collect())) == [(1, "mine"), (2, "mine"), (3, "y"), (4, "x")]
    assert [(r.id, r.base.note, r.edited.note, r.proposed.note) for r in spark.read.parquet(pending.conflicts).collect()] == [(2, "x", "mine", "y")]
    again.accept(pending)
    again.run(changed)
    assert sorted(map(tuple, again.result(changed).collect())) == [(1, "mine"), (2, "mine"), (3, "y"), (4, "x")]


# ---------------------------------------------------------------- programs


def test_a_hanging_program_ends_in_a_stated_error(spark):
    with pytest.raises(Exception, match="took more than 1 seconds"):
        run_lines(spark.range(3), ["sleep", "600"], "id long", limit_s=1).collect()
    assert run_lines(spark.range(3), ["cat"], "id long", limit_s=60).count() == 3


def test_cores_of_a_stage(spark):
    from types import SimpleNamespace

    assert profile_of(spark, 2) is None and profile_of(spark, None) is None
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077"))
    assert profile_of(cluster, 2).taskResources["cpus"].amount == 2.0


def test_a_claim_is_given_once(spark, tmp_path):
    path = f"file://{tmp_path}/claim"
    assert [files.create_if_absent(spark, path) for _ in range(3)] == [True, False, False]

"""Changed parts are made again alone; scans whose process takes all points at once."""

import os

import pytest
from pyspark.sql import functions as F

from strandline.operators import detect
from strandline.plans.engine import Engine
from strandline.plans.graph import Compiler, PlanError, Registry, Scope
from strandline.sources import files
from strandline.sources.order import PART, POINT


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("id,v\n" + "".join(f"{i},{v}\n" for i, v in rows))
    os.utime(folder / name, (1, sum(v for _, v in rows) + len(rows)))  # times differ whatever the clock says


def parted(spark, tmp_path, store, seen, parameter="2"):
    registry = Registry()
    registry.process("Load", part_folder=lambda p: f"file://{tmp_path}/in")(lambda names, p: seen["read"].append(len(names)) or files.read_csv(spark, names, "id long, v long", positions=True))

    @registry.process("Times", "OneUpstream", ("GetLoad",), by_part=True)
    def times(inputs, params):
        seen["times"].append(sorted(r[0] for r in inputs[0].select(PART).distinct().collect()))
        return inputs[0].withColumn("v", F.col("v") * int(params["by"])).where("v <> 0")

    @registry.process("Total", "OneUpstream", ("GetTimes",))
    def total(inputs, params):
        seen["total"].append(1)
        return inputs[0].agg(F.sum("v").alias("v"), F.count("*").alias("n"))

    plan = {"pipe": "OneUpstream", "OneUpstream": {"process": "Total", "GetTimes": {"pipe": "OneUpstream", "OneUpstream": {"process": "Times", "GetLoad": {"process": "Load"}}}}}
    node = Compiler(registry).compile(plan, Scope({"Times": {"parameters": {"by": parameter}}}))
    return Engine(spark, registry, f"file://{tmp_path}/{store}"), node


def test_one_changed_file_of_many_is_made_again_alone(spark, tmp_path):
    seen = {"read": [], "times": [], "total": []}
    for k in range(100):
        write(tmp_path / "in", f"f{k:02d}.csv", [(k * 10 + i, k + i) for i in range(3)])
    engine, node = parted(spark, tmp_path, "store", seen)
    times = node.children[0]
    first = engine.run(node)
    assert len(first.parts["Times"]["made"]) == 100 and seen["read"] == [100]
    before = engine.store.entry(times.fingerprint)["parts"]
    again = engine.run(node)
    assert not again.made and not again.parts and seen["total"] == [1]

    write(tmp_path / "in", "f42.csv", [(420, 1000), (421, 7), (422, 8), (423, 9)])
    second = engine.run(node)
    assert second.parts["Load"] == second.parts["Times"] == {"made": ["f42.csv"], "kept": [f"f{k:02d}.csv" for k in range(100) if k != 42], "gone": []}
    assert seen["read"] == [100, 1] and seen["times"][-1] == ["f42.csv"] and seen["total"] == [1, 1]
    after = engine.store.entry(times.fingerprint)["parts"]
    assert {p for p in after if after[p] != before[p]} == {"f42.csv"}
    assert not files.exists(spark, before["f42.csv"]["path"]) and files.exists(spark, after["f42.csv"]["path"])
    fresh, same = parted(spark, tmp_path, "fresh", {"read": [], "times": [], "total": []})
    fresh.run(same)
    assert engine.result(node).collect() == fresh.result(same).collect()
    assert sorted(map(tuple, engine.result(times).collect())) == sorted(map(tuple, fresh.result(same.children[0]).collect()))


def test_parts_that_come_go_or_give_no_rows(spark, tmp_path):
    seen = {"read": [], "times": [], "total": []}
    write(tmp_path / "in", "a.csv", [(1, 5)])
    write(tmp_path / "in", "b.csv", [(2, 0)])  # nothing is left of it
    engine, node = parted(spark, tmp_path, "store", seen)
    assert engine.run(node).parts["Times"]["made"] == ["a.csv", "b.csv"]
    assert [tuple(r) for r in engine.result(node).collect()] == [(10, 1)]
    (tmp_path / "in" / "a.csv").unlink()
    write(tmp_path / "in", "c.csv", [(3, 4)])
    assert engine.run(node).parts["Times"] == {"made": ["c.csv"], "kept": ["b.csv"], "gone": ["a.csv"]}
    assert [tuple(r) for r in engine.result(node).collect()] == [(8, 1)]
    # other parameters are another table, whose parts are all made
    other, changed = parted(spark, tmp_path, "store", seen, "3")
    assert other.run(changed).parts["Times"]["made"] == ["b.csv", "c.csv"]
    for f in ("b.csv", "c.csv"):
        (tmp_path / "in" / f).unlink()
    engine.run(node)
    assert [tuple(r) for r in engine.result(node).collect()] == [(None, 0)]


def test_a_process_by_part_must_keep_the_column(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [(1, 5)])
    registry = Registry()
    registry.process("Load", part_folder=lambda p: f"file://{tmp_path}/in")(lambda names, p: files.read_csv(spark, names, "id long, v long", positions=True))
    registry.process("Bad", "OneUpstream", ("GetLoad",), by_part=True)(lambda inputs, params: inputs[0].agg(F.count("*").alias("n")))
    node = Compiler(registry).compile({"pipe": "OneUpstream", "OneUpstream": {"process": "Bad", "GetLoad": {"process": "Load"}}}, Scope({}))
    with pytest.raises(PlanError, match="part"):
        Engine(spark, registry, f"file://{tmp_path}/store").run(node)


# ---------------------------------------------------------------- scans


def scan(spark, tmp_path, points, cutoffs, outfile):
    registry = Registry()
    registry.process("Load")(lambda inputs, params: spark.createDataFrame([(i, (i * 37 % 100) / 100 if i % 11 else None) for i in range(60)], "id int, prob double").withColumn("Selection", F.lit(0)))
    fn = (lambda inputs, p: detect.apply_cutoffs(inputs[0], p)) if points else (lambda inputs, p: detect.apply_cutoff(inputs[0], float(p["cutoff"])))
    registry.process("Cut", "OneUpstream", ("GetLoad",), outfile=outfile, points=points)(fn)
    plan = {"loop_on": "Cut", "pipe": "OneUpstream", "OneUpstream": {"process": "Cut", "GetLoad": {"process": "Load"}}}
    node = Compiler(registry).compile(plan, Scope({"Cut": {"parameters": {"cutoff": cutoffs}}}))
    engine = Engine(spark, registry, f"file://{tmp_path}/{points}-{outfile}-{len(cutoffs)}")
    engine.run(node)
    return engine, node


@pytest.mark.parametrize("outfile", ["table.txt", "table.csv.gz"])
def test_all_points_at_once_give_what_the_branches_give(spark, tmp_path, outfile):
    cutoffs = ["0.5", "0.25", "0.9", "0.5", "2", "-1", "0.37"]
    (one, a), (each, b) = (scan(spark, tmp_path, p, cutoffs, outfile) for p in (True, False))
    assert (a.kind, b.kind) == ("scan", "combine") and a.fingerprint == b.fingerprint and len(a.points) == len(b.children) == 6
    key = (lambda r: r.Selection) if outfile.endswith(".txt") else tuple
    got, want = (sorted((tuple(r) for r in x.result(n).select("id", "prob", "Selection").collect()), key=lambda r: r[2] if outfile.endswith(".txt") else r) for x, n in ((one, a), (each, b)))
    assert got == want and key


def test_a_thousand_points_are_one_plan_without_unions(spark, tmp_path):
    cutoffs = [f"{k / 1000:.3f}" for k in range(1000)]
    engine, node = scan(spark, tmp_path, True, cutoffs, "table.csv.gz")
    assert len(node.children) == 1 and len(node.points) == 1000
    rows = engine._build(node, [engine.store.get(node.children[0].fingerprint) if engine.store.has(node.children[0].fingerprint) else spark.createDataFrame([(1, 0.5)], "id int, prob double")])
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()
    probs = [(i * 37 % 100) / 100 for i in range(60) if i % 11]
    assert engine.result(node).count() == sum(p >= float(c) for p in probs for c in cutoffs)


def test_one_branch_or_other_inputs_are_no_scan(spark, tmp_path):
    _, node = scan(spark, tmp_path, True, ["0.5", "0.5"], "table.csv.gz")
    assert node.kind == "process"


def test_evaluation_at_cutoffs_against_each_of_them(spark):
    rows = [((i * 37 % 100) / 100 if i % 11 else None, int(i % 3 == 0)) for i in range(80)]
    df = spark.createDataFrame(rows, "prob double, hit int")
    cutoffs = ["0.5", "0.1", "1.5", "0.50"]
    points = spark.createDataFrame(list(enumerate(cutoffs)), f"{POINT} int, cutoff string")
    for r in detect.perf_at_cutoffs(df, points, "prob", "hit").collect():
        c = float(cutoffs[r[POINT]])
        tp, fp = (sum(1 for p, h in rows if p is not None and p >= c and h == x) for x in (1, 0))
        assert (r.tp, r.fp, r.fn) == (tp, fp, sum(h for _, h in rows) - tp)
    assert detect.perf_at_cutoffs(df, points, "prob", "hit").count() == 4 and detect.perf_at_cutoffs(df.limit(0), points, "prob", "hit").count() == 4

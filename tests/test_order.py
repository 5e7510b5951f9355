"""Rows keep the order in which they stand: from files, through the store, a scan and its combining node."""

import random

import pytest

from strandline.operators import combine
from strandline.plans.engine import Engine
from strandline.plans.graph import Compiler, PlanError, Registry, Scope, process_node
from strandline.plans.params import bind
from strandline.sources import files, order


def scanned(spark, tmp_path, outfile, names, read, cut=lambda df: df):
    registry = Registry()
    registry.process("Load")(lambda inputs, params: read(params["file"]))
    registry.process("Pass", "OneUpstream", ("GetLoad",), outfile=outfile)(lambda inputs, params: cut(inputs[0]))
    plan = {"loop_on": "Load", "pipe": "OneUpstream", "OneUpstream": {"process": "Pass", "GetLoad": {"process": "Load"}}}
    node = Compiler(registry).compile(plan, Scope({"Load": {"parameters": {"file": list(names)}}}))
    engine = Engine(spark, registry, f"file://{tmp_path}/store")
    engine.run(node)
    return engine, node


def test_selections_are_numbered_as_they_stand(spark, tmp_path):
    tables = {"a": [30, 10, 20], "b": [5, 7, 1]}
    engine, node = scanned(spark, tmp_path, "table.txt", tables, lambda n: spark.createDataFrame([(x, n) for x in tables[n]], "x int, n string"))
    got = [(r.x, r.n) for r in sorted(engine.result(node).collect(), key=lambda r: r.Selection)]
    assert got == [(30, "a"), (10, "a"), (20, "a"), (5, "b"), (7, "b"), (1, "b")]
    assert [r.Selection for r in sorted(engine.result(node).collect(), key=lambda r: r.Selection)] == [1, 2, 3, 4, 5, 6]


def test_islands_of_file_groups_follow_the_rows_as_they_stand(spark, tmp_path):
    head = "FileName,StartTime,Duration,SegStart,SegDur,DiffTime\n"
    at = {"a": "10:00:00", "b": "10:00:10", "c": "10:00:20", "d": "11:00:00"}
    (tmp_path / "one.csv").write_text(head + "".join(f"{n},2024-01-01 {at[n]},10,0,10,1\n" for n in "bac"))
    (tmp_path / "two.csv").write_text(head + f"d,2024-01-01 {at['d']},10,0,10,1\n")
    engine, node = scanned(spark, tmp_path, "FileGroupFormat.csv.gz", ["one.csv", "two.csv"], lambda n: files.read_file_group(spark, f"file://{tmp_path}/{n}"))
    assert {r.FileName: r.DiffTime for r in engine.result(node).collect()} == {"b": 1, "a": 2, "c": 3, "d": 4}
    listed = files.read_file_groups(spark, f"file://{tmp_path}", "one.csv,two.csv", order=None)
    assert {r.FileName: r.DiffTime for r in listed.collect()} == {"b": 1, "a": 2, "c": 3, "d": 4}
    by_time = files.read_file_groups(spark, f"file://{tmp_path}", "one.csv,two.csv")
    assert {r.FileName: r.DiffTime for r in by_time.collect()} == {"a": 1, "b": 1, "c": 1, "d": 2}


def test_files_in_many_pieces_and_parts(spark, tmp_path):
    rng = random.Random(1)
    values = [rng.randrange(10**6) for _ in range(5000)]
    (tmp_path / "big.txt").write_text("x\tpad\n" + "".join(f"{v}\t{'p' * 50}\n" for v in values))
    for k in range(12):  # parts of unlike sizes, which Spark packs by size
        (tmp_path / "parts").mkdir(exist_ok=True)
        (tmp_path / "parts" / f"part-{k:05d}-x.csv").write_text("x\n" + "".join(f"{v}\n" for v in values[k * 400 : (k + 1) * 400 - k * 30]))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = files.read_selections(spark, f"file://{tmp_path}/big.txt", "x int, pad string").where("x % 3 <> 0")
        assert df.rdd.getNumPartitions() > 5
        assert [r.x for r in order.in_order(df).collect()] == [v for v in values if v % 3]
        got = combine.combine_selections([df, files.read_csv(spark, f"file://{tmp_path}/parts", "x int", positions=True)])
        want = [v for v in values if v % 3] + [v for k in range(12) for v in values[k * 400 : (k + 1) * 400 - k * 30]]
        assert [r.x for r in sorted(got.collect(), key=lambda r: r.Selection)] == want
        # once more through a write: the order is that of the numbers
        got.repartition(5).write.parquet(f"file://{tmp_path}/again")
        assert [r.x for r in order.in_order(spark.read.parquet(f"file://{tmp_path}/again")).collect()] == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_store_keeps_the_written_order_and_exports_in_it(spark, tmp_path):
    tables = {"a": list(range(200, 0, -1)), "b": [3, 1, 2]}
    engine, node = scanned(spark, tmp_path, "plain.csv.gz", tables, lambda n: spark.createDataFrame([(x, n) for x in tables[n]], "x int, n string").repartition(7).orderBy(order.F.desc("x")), lambda df: df.where("x <> 2"))
    stored = engine.store.get(node.fingerprint)
    want = [(x, n) for n in "ab" for x in sorted(tables[n], reverse=True) if x != 2]
    assert [(r.x, r.n) for r in order.in_order(stored).collect()] == want
    assert order.POSITION not in engine.result(node).columns
    run = engine.run(node, export=True)
    assert run.reused
    lines = [(r.x, r.n) for r in order.in_order(files.read_csv(spark, f"file://{tmp_path}/store/outputs/{node.name}/{node.fingerprint}/{node.name}", "x int, n string", positions=True)).collect()]
    assert lines == want


def test_positions_of_tables_without_rows_or_order(spark):
    empty = spark.createDataFrame([], "x int, Selection int")
    assert combine.combine_selections([empty, empty]).count() == 0
    a = spark.createDataFrame([(2,), (1,)], "x int")
    assert [(r.x, r.Selection) for r in combine.combine_selections([empty, a, empty, a]).orderBy("Selection").collect()] == [(2, 1), (1, 2), (2, 3), (1, 4)]


def split_plan(spark, tmp_path, key, splits, seen):
    registry = Registry()
    registry.process("Load")(lambda inputs, params: spark.range(0, 1000).selectExpr("id", "id % 7 as g").repartition(4))
    registry.process("Mark", "OneUpstream", ("GetLoad",), split_key=key)(lambda inputs, params: seen.append(inputs[0].columns) or inputs[0].withColumn("twice", order.F.col("id") * 2))
    node = Compiler(registry).compile({"pipe": "OneUpstream", "OneUpstream": {"process": "Mark", "GetLoad": {"process": "Load"}}}, Scope({"Mark": {"parameters": {}, "arguments": {"splits": str(splits)}}}))
    engine = Engine(spark, registry, f"file://{tmp_path}/{key}-{splits}")
    engine.run(node)
    return engine.result(node), node


@pytest.mark.parametrize("key", [None, "g"])
def test_splits_with_and_without_a_key(spark, tmp_path, key):
    seen = []
    out, node = split_plan(spark, tmp_path, key, 3, seen)
    assert len(seen) == 3 and all("split_ID" not in c for c in seen)
    assert sorted((r.id, r.twice) for r in out.select("id", "twice").collect()) == [(i, 2 * i) for i in range(1000)]
    assert node.kind == "gather" and node.fingerprint == split_plan(spark, tmp_path, key, 1, [])[1].fingerprint


def test_a_process_without_input_has_nothing_to_split():
    registry = Registry()
    registry.process("Load")(None)
    with pytest.raises(PlanError):
        process_node(registry.get("Load"), bind({"Load": {"parameters": {}, "arguments": {"splits": "2"}}}, "Load"), [])


def test_the_hash_deals_repeated_rows_alike_and_all_rows_once(spark):
    df = spark.createDataFrame([(i % 50, None if i % 3 else "x") for i in range(600)], "a int, b string")
    split = combine.split_numbers(df, 4)
    assert split.groupBy("a", "b").agg(order.F.countDistinct("split_ID").alias("n")).where("n > 1").count() == 0
    assert split.count() == 600 and split.select("split_ID").distinct().count() == 4

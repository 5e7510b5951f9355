import gzip
import io
import tarfile

import pytest
from pyspark.sql import functions as F

from strandline.operators import combine
from strandline.plans import engine as en
from strandline.plans import loaders, methods, params
from strandline.plans.fingerprint import fingerprint
from strandline.plans.graph import Compiler, PlanError, Registry, Scope, scan_points
from strandline.sources import files

TEXT = """
# a comment
Global:
    cache: [root]
    root: /data
    note:
        > two
        > lines
Job:
    Cut:
        parameters:
            cutoff: 0.5
            group:
                - b
                - a
        arguments:
            splits: 3
    Train*:
        parameters:
            methodID: rf
            methodvers: v1
            trees: 10
    novel:
        Cut:
            parameters:
                cutoff: 0.9
"""


def test_nested_text_round_trip():
    tree = params.parse(TEXT)
    assert tree["Global"]["note"] == "two\nlines" and tree["Job"]["Cut"]["parameters"]["group"] == ["b", "a"]
    assert params.parse(params.dump(tree)) == tree
    assert params.parse("") == {} and params.parse("a:") == {"a": ""}
    for bad in ("a: 1\na: 2", "a\n", "a:\n  b: 1\n c: 2", "- x\ny: 1"):
        with pytest.raises(params.ParameterError):
            params.parse(bad)


def test_overlay_and_lookup():
    tree = params.parse(TEXT)["Job"]
    assert params.overlay(tree, "novel")["Cut"]["parameters"]["cutoff"] == "0.9"
    assert tree["Cut"]["parameters"]["cutoff"] == "0.5"
    assert params.find_section(tree, "TrainModel")[0] == "Train" and params.find_section(tree, "MyTrain")[0] == "Train"
    assert params.find_section(tree, "Other") is None
    with pytest.raises(params.ParameterError):
        params.overlay({"a-b": "x"}, "c")


def test_binding():
    tree = params.parse(TEXT)["Job"]
    b = params.bind(tree, "TrainX")
    assert b.method == params.Method("rf", "v1") and dict(b.params) == {"trees": "10"} and b.arguments["splits"] == "1"
    assert params.bind(tree, "Cut").params["group"] == "a,b" and params.bind(tree, "Cut", 1).params["group"] == "b"
    assert params.bind(tree, "Nothing").params == {}
    assert params.inject("[a]", {"a": "[b]", "b": "1"}) == "1"
    for names in ({"a": "[b]", "b": "[a]"}, {}):
        with pytest.raises(params.ParameterError):
            params.inject("[a]", names)


def test_fingerprints():
    a = fingerprint("op", ["x"], {"p": "1", "q": "2"})
    assert a == fingerprint("op", ["x"], {"q": "2", "p": "1"})
    assert len({a, fingerprint("op", ["x"], {"p": "2", "q": "2"}), fingerprint("op", ["y"], {"p": "1", "q": "2"}), fingerprint("op", ["x"], {"p": "12", "q": ""}), fingerprint("op", ["x"], {"p": "1", "q": "2"}, rerun_key="1")}) == 5


def _registry():
    r = Registry()

    @r.process("Load", outfile="FileGroupFormat.csv.gz")
    def load(inputs, p):
        spark = r.spark
        r.calls.append(("Load", p.get("group")))
        return spark.range(int(p.get("n", 4))).withColumn("group", F.lit(p.get("group")))

    @r.process("Cut", "OneUpstream", ("GetLoad",))
    def cut(inputs, p):
        r.calls.append(("Cut", p["cutoff"]))
        return inputs[0].where(F.col("id") >= float(p["cutoff"]))

    @r.process("Join", "TwoUpstream", ("GetLoad", "GetCut"))
    def join(inputs, p):
        r.calls.append(("Join", None))
        return inputs[0].join(inputs[1].select("id"), "id")

    r.process("Review", "OneUpstream", ("GetCut",), review=True)(None)
    r.calls = []
    return r


TREE = {
    "Load": {"parameters": {"n": "4", "group": ["g2", "g1", "g3"]}, "arguments": {"cpu": "1"}},
    "Cut": {"parameters": {"cutoff": ["1", "2"]}},
    "deep": {"Load": {"parameters": {"n": "9"}}},
}
CUT = {"pipe": "Cut.pipe", "Cut.pipe": {"GetLoad": {"process": "Load"}}}


def test_shapes_and_edges():
    c = Compiler(_registry())
    node = c.compile({"pipe": "TwoUpstream", "TwoUpstream": {"process": "Join", "GetLoad": {"process": "Load"}, "GetCut": {"process": "Cut"}}}, Scope(TREE))
    assert [x.name for x in node.children] == ["Cut", "Load"] and [x.name for x in node.children[0].children] == ["Load"]
    assert node.children[0].children[0].fingerprint == node.children[1].fingerprint
    assert c.compile(CUT, Scope(TREE)).fingerprint != c.compile({**CUT, "params_drop": "deep"}, Scope(TREE)).fingerprint
    other = {**TREE, "Load": {**TREE["Load"], "arguments": {"cpu": "99"}}}
    assert c.compile(CUT, Scope(TREE)).fingerprint == c.compile(CUT, Scope(other)).fingerprint
    with pytest.raises(PlanError):
        c.compile({"pipe": "Nowhere"}, Scope(TREE))


def test_scans():
    assert scan_points(TREE, ["Load", "Cut"]) == [{"Load": i, "Cut": j} for i in range(3) for j in range(2)]
    c = Compiler(_registry())
    node = c.compile({**CUT, "loop_on": ["Load", "Cut"]}, Scope(TREE))
    assert node.kind == "combine" and len(node.children) == 6
    assert len(c.compile({**CUT, "loop_on": "Cut"}, Scope(TREE, no_over=1)).walk().__next__().name) and c.compile({**CUT, "loop_on": "Cut"}, Scope(TREE, no_over=1)).kind == "process"
    # an inner loop wins over an inherited index, and reset_loop forgets it
    inner = {**CUT, "loop_on": "Cut"}
    outer = {"pipe": "Review.pipe", "Review.pipe": {"GetCut": inner}, "loop_on": "Load"}
    n = c.compile(outer, Scope(TREE))
    assert len(n.children) == 3 and all(len(x.children[0].children) == 2 for x in n.children)
    reset = {**outer, "Review.pipe": {"GetCut": {**inner, "reset_loop": "y"}}}
    assert c.compile(reset, Scope(TREE)).kind == "process"
    with pytest.raises(params.ParameterError):
        c.compile({**CUT, "loop_on": "Nothing"}, Scope(TREE))


def test_jobs_and_includes():
    loaded = {"part.nt": {"process": "Load"}, "again.nt": {"pipe_link": {"name": "again.nt"}}, "P3.nt": CUT}

    def load(name):
        if name not in loaded:
            raise FileNotFoundError(name)
        return loaded[name]

    c = Compiler(_registry(), {"P1": CUT, "P2": {**CUT, "params_drop": "deep"}}, {"J": ["P2", "K"], "K": ["P1", "P3"], "L": ["L"]}, load)
    assert c.job_pipelines("J") == ["P1", "P2", "P3"]
    assert len(c.job("J", Scope(TREE)).children) == 3
    for bad in ("L", "missing"):
        with pytest.raises(PlanError):
            c.job_pipelines(bad)
    link = {"pipe": "Cut.pipe", "Cut.pipe": {"GetLoad": {"pipe_link": {"name": "part.nt"}}}}
    assert c.compile(link, Scope(TREE)).fingerprint == c.compile(CUT, Scope(TREE)).fingerprint
    with pytest.raises(PlanError):
        c.compile({"pipe_link": {"name": "again.nt"}}, Scope(TREE))


def test_incremental_runs(spark, tmp_path):
    r = _registry()
    r.spark = spark
    eng = en.Engine(spark, r, f"file://{tmp_path}")
    c = Compiler(r, {"A": {"pipe": "TwoUpstream", "TwoUpstream": {"process": "Join", "GetLoad": {"process": "Load"}, "GetCut": {"process": "Cut"}}}}, {"J": ["A"]})
    tree = {**TREE, "Cut": {"parameters": {"cutoff": "1"}}}
    job = c.job("J", Scope(tree))
    first = eng.run(job, export=True, definition=tree)
    assert len(r.calls) == 3 and sorted(x.id for x in eng.result(job.children[0]).collect()) == [1, 2, 3]
    assert list(first.outputs) == ["Join"] and "to make" not in eng.explain(job.children[0]).splitlines()[0]
    out = f"{tmp_path}/outputs/J/{job.fingerprint}"
    assert params.parse(open(f"{out}/parameters_archive.nt").read())["Cut"] == tree["Cut"]
    r.calls.clear()
    again = eng.run(job)
    assert r.calls == [] and again.made == []
    rerun = c.job("J", Scope({**tree, "Cut": {"parameters": {"cutoff": "1"}, "arguments": {"hard_rerun": "y"}}}))
    assert rerun.fingerprint == job.fingerprint
    eng.run(rerun)
    assert [n for n, _ in r.calls] == ["Cut", "Join"]
    r.calls.clear()
    trim = c.job("J", Scope({**tree, "Cut": {"parameters": {"cutoff": "1"}, "arguments": {"trim_tree": "y"}}}))
    eng.run(trim)
    assert r.calls == []  # the final table stands, so what was trimmed above it is not needed


def test_scan_results_and_collapse(spark, tmp_path):
    r = _registry()
    r.spark = spark
    eng = en.Engine(spark, r, f"file://{tmp_path}")
    node = Compiler(r).compile({**CUT, "loop_on": ["Load", "Cut"]}, Scope(TREE))
    eng.run(node)
    got = sorted((x.group, x.id) for x in eng.result(node).collect())
    assert got == sorted((g, i) for g in ("g1", "g2", "g3") for cut in (1, 2) for i in range(cut, 4))
    assert combine.distinct_branches([node, node]) == [node]


def test_review(spark, tmp_path):
    r = _registry()
    r.spark = spark
    eng = en.Engine(spark, r, f"file://{tmp_path}")
    tree = {**TREE, "Cut": {"parameters": {"cutoff": "1"}}}
    node = Compiler(r).compile({"pipe": "Review.pipe", "Review.pipe": {"GetCut": CUT}}, Scope(tree))
    with pytest.raises(en.ReviewPending) as e:
        eng.run(node)
    eng.accept(e.value.pending, spark.read.parquet(e.value.pending.path).where("id > 2"))
    eng.run(node)
    assert [x.id for x in eng.result(node).collect()] == [3]


def test_commands():
    b = params.Bound("P", "P", {}, {}, {"language": "R", "wrapper": "True", "venv": "conda", "venv_name": "e", "pass_sub_to_wrapper": "True"}, params.Method("m", "v1"))
    direct = ["Rscript", "/r/methods/P/m/m-v1.R", "a", "b"]
    assert methods.command("/r", b, ["a", "b"]) == ["conda", "run", "-n", "e", "Rscript", "/r/methods/P/PWrapper.R", "/r", "a", "b", *direct]
    assert methods.command("/r", params.Bound("P", "P", descriptors={"runtype": "bin"}, method=params.Method("m", "2")), ["x", "y"], ";") == ["/r/methods/P/m/m2", "x;y"]
    assert methods.separator("';'") == ";" and methods.separator(None) == " "
    with pytest.raises(methods.MethodError):
        methods.separator(";")


def test_lines_hold_any_value():
    for sep in ("\t", ",", "|"):
        for row in (["a", None], ["", r"\N"], ["t\tb", "n\nl"], ["\\", "r\r"], [sep, f"x{sep}{sep}y"], ["\\s\\n", "é"]):
            assert methods.from_line(methods.to_line(row, sep), sep) == row


def test_external_method_with_awkward_values(spark):
    rows = [(1, 'a "q" b', 1.5), (2, None, None), (3, "tab\there\nand line\r", -0.25), (4, "", 0.0), (5, r"\N \t", 1e300)]
    df = spark.createDataFrame(rows, "id long, x string, d double").repartition(2)
    for sep in ("\t", ";"):
        assert sorted(methods.run_lines(df, ["cat"], "id long, x string, d double", sep).collect()) == rows
    assert methods.run_lines(df.limit(0), ["cat"], "id long, x string, d double").count() == 0
    typed = df.selectExpr("id", "cast(id as decimal(10,2)) as money", "timestamp_ntz'2024-03-10 02:30:00.123456' as t")
    assert sorted(methods.run_lines(typed, ["cat"], "id long, money decimal(10,2), t timestamp_ntz").collect()) == sorted(typed.collect())


def test_one_program_runs_per_partition(spark):
    df = spark.range(30_000).repartition(3)
    assert [r.n for r in methods.run_lines(df, ["wc", "-l"], "n string").collect()] == ["10000"] * 3
    # a program that stops reading early and one that gives other fields than asked for
    assert methods.run_lines(df, ["head", "-n", "2"], "id long").count() == 6
    with pytest.raises(Exception, match="fields instead of"):
        methods.run_lines(df, ["cat"], "a long, b long").collect()
    with pytest.raises(methods.MethodError):
        methods.run_lines(df, ["cat"], "a long", "ab")


def test_external_method(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    assert sorted(methods.run_lines(df, ["tr", "ab", "AB"], "id long, x string").collect()) == [(1, "A"), (2, "B")]
    with pytest.raises(Exception, match="ended with"):
        methods.run_lines(df, ["false"], "id long, x string").collect()


def test_sources_and_sinks(spark, tmp_path):
    root = f"file://{tmp_path}"
    text = "FileName,StartTime,Duration,SegStart,SegDur,Site\nf1,2024-01-01 00:00:00,10,0,10,s\n"
    with gzip.open(tmp_path / "fg.csv.gz", "wt") as f:
        f.write(text)
    df = files.read_file_group(spark, f"{root}/fg.csv.gz")
    assert dict(df.dtypes)["StartTime"] == "timestamp_ntz" and dict(df.dtypes)["Site"] == "string" and df.count() == 1
    (tmp_path / "bad.csv").write_text("FileName,Duration\nx,1\n")
    with pytest.raises(ValueError, match="StartTime"):
        files.peek_schema(spark, f"{root}/bad.csv")
    files.write_single_csv(df.drop("StartTime"), f"{root}/one.csv.gz")
    assert gzip.open(tmp_path / "one.csv.gz", "rt").read().startswith("FileName,Duration")
    files.write_single_csv(spark.range(3).toDF("Selection"), f"{root}/sel.txt", "\t")
    assert files.read_selections(spark, f"{root}/sel.txt", "Selection long").count() == 3
    with tarfile.open(tmp_path / "a.tgz", "w:gz") as tar:
        for name, data in (("d/x.png", b"1"), ("../../y.png", b"22")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    assert sorted(bytes(r.content) for r in files.archive_members(spark, f"{root}/a.tgz").collect()) == [b"1", b"22"]
    made = files.export(spark, f"{root}/a.tgz", f"{root}/out")
    assert sorted(p.rsplit("/", 1)[1] for p in made) == ["x.png", "y.png"] and (tmp_path / "out" / "y.png").read_bytes() == b"22"
    assert files.export(spark, f"{root}/fg.csv.gz", f"{root}/out") == [f"{root}/out/fg.csv"] and (tmp_path / "out" / "fg.csv").read_text() == text
    got = {r.uri.rsplit("/", 1)[1]: r.status.split(":")[0] for r in files.fetch_missing(spark, [f"{root}/sel.txt", f"{root}/none", f"{root}/fg.csv"], f"{root}/out").collect()}
    assert got == {"sel.txt": "copied", "none": "error", "fg.csv": "present"}
    assert len(files.upload(spark, f"{root}/out", f"{root}/up")) == 4 and (tmp_path / "up" / "x.png").exists()
    kept = combine.collect_artifacts(spark, [f"{root}/out/x.png", f"{root}/out/y.png"], f"{root}/all", "p.png")
    assert [p.rsplit("/", 1)[1] for p in kept] == ["1_p.png", "2_p.png"]


def test_loops_over_artifacts(spark, tmp_path):
    r = _registry()
    r.spark = spark

    @r.process("Plot", "OneUpstream", ("GetLoad",), outfile="plot.png")
    def plot(inputs, p, folder):
        path = f"{folder}/plot.png"
        files.write_bytes(spark, path, f"{inputs[0].first().group}".encode())
        return path

    @r.process("Pack", "OneUpstream", ("GetLoad",), outfile="model.tgz")
    def pack(inputs, p, folder):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz") as tar:
            info = tarfile.TarInfo("deep/in.txt")
            info.size = 2
            tar.addfile(info, io.BytesIO(inputs[0].first().group.encode()))
        files.write_bytes(spark, f"{folder}/model.tgz", out.getvalue())
        return f"{folder}/model.tgz"

    eng = en.Engine(spark, r, f"file://{tmp_path}/s")
    for name, want in (("Plot", {"1_plot.png": "g1", "2_plot.png": "g2", "3_plot.png": "g3"}), ("Pack", {"1_model/in.txt": "g1", "2_model/in.txt": "g2", "3_model/in.txt": "g3"})):
        node = Compiler(r).compile({"pipe": f"{name}.pipe", f"{name}.pipe": {"GetLoad": {"process": "Load"}}, "loop_on": "Load"}, Scope(TREE))
        eng.run(node, export=True)
        paths = [x.path for x in eng.result(node).collect()]
        assert {"/".join(p.rsplit("/", 2)[1:]) if name == "Pack" else p.rsplit("/", 1)[1]: files.read_bytes(spark, p).decode() for p in paths} == want
        r.calls.clear()
        assert eng.run(node).made == [] and r.calls == []
    assert (tmp_path / "s" / "outputs" / "combine").exists()


def test_a_plan_runs_external_methods(spark, tmp_path):
    r = _registry()
    r.spark = spark
    r.process("Mark", "TwoUpstream", ("GetLoad", "GetCut"), lines="id long, group string, note string")(None)
    where = tmp_path / "methods" / "Mark" / "m"
    where.mkdir(parents=True)
    (where / "m-v1.py").write_text("import os, sys\ntable, word = sys.argv[1:]\nassert os.path.isdir(table.removeprefix('file:'))\nfor line in sys.stdin:\n    print(line.rstrip('\\n') + '\\t' + word)\n")
    (where / "m-v2.py").write_text("import sys\nsys.exit('no luck')\n")
    eng = en.Engine(spark, r, f"file:{tmp_path}/s", methods_root=str(tmp_path))
    spec = {"pipe": "TwoUpstream", "TwoUpstream": {"process": "Mark", "GetLoad": {"process": "Load"}, "GetCut": {"process": "Cut"}}}
    tree = lambda v: {**TREE, "Load": {"parameters": {"n": "4", "group": "g"}}, "Cut": {"parameters": {"cutoff": "2"}}, "Mark": {"parameters": {"methodID": "m", "methodvers": v, "word": "w"}, "descriptors": {"language": "Python"}}}
    node = Compiler(r).compile(spec, Scope(tree("v1")))
    eng.run(node)
    assert sorted((x.id, x.group, x.note) for x in eng.result(node).collect()) == [(2, "g", "w"), (3, "g", "w")]
    with pytest.raises(Exception, match="no luck"):
        eng.run(Compiler(r).compile(spec, Scope(tree("v2"))))
    with pytest.raises(PlanError):
        en.Engine(spark, r, f"file:{tmp_path}/t").run(node)


def test_splits_are_nodes(spark, tmp_path):
    r = _registry()
    r.spark = spark

    @r.process("Sum", "OneUpstream", ("GetLoad",), split_key="id")
    def total(inputs, p):
        r.calls.append(("Sum", inputs[0].count()))
        return inputs[0].agg(F.sum("id").alias("s"))

    eng = en.Engine(spark, r, f"file://{tmp_path}")
    spec = {"pipe": "OneUpstream", "OneUpstream": {"process": "Sum", "GetLoad": {"process": "Load"}}}
    tree = lambda k: {"Load": {"parameters": {"n": "10", "group": "g"}}, "Sum": {"parameters": {}, "arguments": {"splits": k}}}
    node = Compiler(r).compile(spec, Scope(tree("3")))
    assert [n.kind for n in node.walk()].count("split") == 3 and node.kind == "gather"
    # how it is split is no part of what it is
    assert node.fingerprint == Compiler(r).compile(spec, Scope(tree("1"))).fingerprint
    eng.run(node)
    assert sorted(x.s for x in eng.result(node).collect()) == [12, 15, 18]
    assert sorted(n for name, n in r.calls if name == "Sum") == [3, 3, 4] and [n for n, _ in r.calls].count("Load") == 1
    for bad in ("0", "-1"):
        with pytest.raises(PlanError):
            Compiler(r).compile(spec, Scope(tree(bad)))


def test_scatter_gives_each_split_a_partition(spark):
    df = spark.range(100).selectExpr("case when id < 3 then null else id end as k")
    got = combine.scatter(df, 4, "k").withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.collect_set("split_ID").alias("s"), F.count("*").alias("n")).collect()
    assert sorted((r.p, r.s) for r in got) == [(0, [1]), (1, [2]), (2, [3]), (3, [4])] and sum(r.n for r in got) == 100


def test_loaders_and_settings(spark, tmp_path):
    (tmp_path / "pipelines").mkdir()
    (tmp_path / "pipelines" / "P9.nt").write_text("pipe: Cut.pipe\nCut.pipe:\n    GetLoad:\n        process: Load\n")
    (tmp_path / "project.nt").write_bytes(b"\xef\xbb\xbf" + TEXT.encode())
    assert loaders.load_tree(spark, f"file://{tmp_path}/project.nt") == params.parse(TEXT)
    c = Compiler(_registry(), load=loaders.pipelines_from(spark, f"file://{tmp_path}/pipelines"))
    assert c.compile(c.pipeline("P9"), Scope(TREE)).fingerprint == c.compile(CUT, Scope(TREE)).fingerprint
    with pytest.raises(PlanError):
        c.pipeline("P8")
    assert loaders.read_settings("# note\n\nHASHLEN=6\nA=b=c\nEMPTY=\n") == {"HASHLEN": "6", "A": "b=c", "EMPTY": ""}
    with pytest.raises(ValueError, match="line 2"):
        loaders.read_settings("A=1\nno value\n")
    x = loaders.Context.of({"HASHLEN": "6"}, {"custom_argument_seperator": "';'", "GCS_output": "y", "GCS_path": "gs://b/p"})
    assert (x.argument_separator, x.fingerprint_length, x.upload_to) == (";", 6, "gs://b/p")
    assert loaders.Context.of({}, {"GCS_output": "", "GCS_path": "gs://b/p"}).upload_to is None
    with pytest.raises(ValueError):
        loaders.Context.of({}, {"GCS_output": "y"})


def test_outputs_are_uploaded(spark, tmp_path):
    r = _registry()
    r.spark = spark
    tree = {**TREE, "Cut": {"parameters": {"cutoff": "1"}}}
    c = Compiler(r, {"A": CUT}, {"J": ["A"]})
    eng = en.Engine(spark, r, f"file://{tmp_path}/s", context=loaders.Context(upload_to=f"file://{tmp_path}/up"))
    eng.run(c.job("J", Scope({**tree, "Load": {"parameters": {"n": "4", "group": "g"}}})), export=True, definition=tree)
    assert (tmp_path / "up" / "manifest.json").exists() and (tmp_path / "up" / "parameters_archive.nt").exists() and (tmp_path / "up" / "Cut").is_dir()


def test_the_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from strandline.functions.shared import shared_dir

    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))


def test_listed_file_groups(spark, tmp_path):
    head = "FileName,StartTime,Duration,SegStart,SegDur"
    (tmp_path / "a.csv").write_text(f"{head},Site\nf2,2024-01-01 00:00:10,10,0,10,s\nf1,2024-01-01 00:00:00,10,0,10,s\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(f"{head},Depth\nf3,2024-01-02 00:00:00,10,0,10,7\n")
    out = files.read_file_groups(spark, f"file://{tmp_path}", ["a.csv", "b.csv.gz"])
    assert sorted((r.FileName, r.Site, r.Depth, r.DiffTime) for r in out.collect()) == [("f1", "s", None, 1), ("f2", "s", None, 1), ("f3", None, "7", 2)]


def test_random_forest(spark):
    from strandline.operators.model import cross_validate

    rows = [(i, float(i % 10), float(i % 3), "TP" if i % 10 > 6 else "FP") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label string")
    out = cross_validate(df, ["a", "b"], "id", cv_it=1, ntree=5, fp_multiple=2.0).collect()
    assert out and sum((r.prob > 0.5) == (r.label == "TP") for r in out) / len(out) > 0.95

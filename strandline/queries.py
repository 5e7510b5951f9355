"""Registered queries of the workflow operators, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions import scalars
from strandline.functions.shared import shared_dir
from strandline.operators import combine, detect, segments
from strandline.operators.model import apply_process, train_process
from strandline.plans.engine import Engine, ancestors, descendants
from strandline.plans.graph import Compiler, Registry, Scope, process_node, scan_points
from strandline.plans.methods import run_lines
from strandline.plans.params import at_index, bind
from strandline.sources.files import copy_file, delete, join_path, list_files, read_csv, read_file_group, read_file_groups, read_selections, write_csv, write_single_csv
from strandline.sources.order import PART
from strandline.sources.streams import read_gzip_csv

TOLERANCE_US = 180_000_000
CAP_S = 900.0
ORDER = ["StartTime", "event_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segment_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as segments: each lasts value * 6 seconds from its time."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", F.concat(F.lit("user_"), "user_id").alias("FileName"), F.col("ts").alias("StartTime"), F.lit(0.0).alias("SegStart"), (F.col("value") * 6).alias("SegDur"))


_SEGMENTS = """seg AS (
  SELECT event_id, user_id, event_type, ts AS StartTime, value * 6 AS SegDur, epoch_us(ts) AS true_start_us, epoch_us(ts) + round(value * 6 * 1000000)::BIGINT AS true_end_us FROM events
)"""


def segment_bounds(spark, sf_dir):
    return segments.segment_bounds(segment_view(spark, sf_dir)).select("event_id", "true_start_us", "true_end_us")


def segment_islands(spark, sf_dir):
    return segments.islands(segment_view(spark, sf_dir), ORDER, TOLERANCE_US).select("event_id", "DiffTime")


def segment_islands_by_user(spark, sf_dir):
    return segments.islands(segment_view(spark, sf_dir), ORDER, TOLERANCE_US, ["user_id"]).select("event_id", "user_id", "DiffTime")


def segment_islands_capped(spark, sf_dir):
    return segments.islands(segment_view(spark, sf_dir), ORDER, TOLERANCE_US, cap_seconds=CAP_S).select("event_id", "DiffTime")


def segment_islands_one_chain(spark, sf_dir):
    """Every segment joined to the next one, so that only the cap cuts: one island over all rows."""
    return segments.islands(segment_view(spark, sf_dir), ORDER, 1 << 60, cap_seconds=CAP_S).select("event_id", "DiffTime")


def islands_of_arriving_files(spark, sf_dir):
    """Segments arrive in files that hold them in no order, two files a batch; the islands of each user as they stand in the end."""
    from strandline.streaming.islands import current_islands, groups_for, island_stream

    place = f"{shared_dir(spark)}/arriving-{uuid.uuid4().hex}"
    view = segment_view(spark, sf_dir).select("user_id", "event_id", "StartTime", "SegStart", "SegDur")
    view.repartition(6, F.xxhash64("event_id")).write.parquet(f"{place}/in")
    stream = spark.readStream.schema(view.schema).option("maxFilesPerTrigger", 2).parquet(f"{place}/in")
    size = spark.read.parquet(f"{place}/in").agg(F.count("*").alias("n"), (F.unix_micros(F.max("StartTime").cast("timestamp")) - F.unix_micros(F.min("StartTime").cast("timestamp"))).alias("span")).first()
    groups = groups_for(size.n, size.span or 0)
    island_stream(stream, ["user_id"], "event_id", f"{place}/runs", f"{place}/state", TOLERANCE_US, groups=groups).awaitTermination()
    return current_islands(spark.read.parquet(f"{place}/runs"), ["user_id"], TOLERANCE_US).select("user_id", "DiffTime", "segments", "start_us", "end_us")


def island_rollup(spark, sf_dir):
    return segments.island_rollup(segments.islands(segment_view(spark, sf_dir), ORDER, TOLERANCE_US))


def union_renumber(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id").withColumn("Selection", F.lit(0))
    return combine.combine_selections([e.where(F.col("event_type") == t) for t in ("click", "view", "error")], ["event_id"])


def union_schema_drift(spark, sf_dir):
    rows = combine.union_by_name([table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")], None)
    # whole numbers with nulls as text: readers of results disagree on their type
    return rows.select(*(F.col(c).cast("string") if t in ("int", "bigint") else F.col(c) for c, t in rows.dtypes))


def filegroup_combine(spark, sf_dir):
    v = segment_view(spark, sf_dir).withColumn("DiffTime", F.lit(0))
    parts = [v.where(F.col("event_type") == t) for t in ("view", "purchase")]
    return combine.combine_file_groups(parts, ORDER, TOLERANCE_US).select("event_id", "event_type", "DiffTime")


def param_scan_product(spark, sf_dir):
    regions = [r.r_name for r in table(spark, sf_dir, "region").select("r_name").collect()]  # a fixed dimension
    tree = {"Load": {"parameters": {"region": regions}}, "Cut": {"parameters": {"cutoff": ["0.5", "0.9"]}}}
    rows = [(at_index(regions, p["Load"]), at_index(["0.5", "0.9"], p["Cut"])) for p in scan_points(tree, ["Load", "Cut"])]
    points = spark.createDataFrame(rows, "r_name string, cutoff string")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return points.join(nations, "r_name").groupBy("r_name", "cutoff").agg(F.count("*").alias("nations"))


def param_scan_zip_sorted(spark, sf_dir):
    """Two list parameters of one process go through a scan together, each sorted by itself."""
    rows = []
    lists: dict[int, dict[str, list[str]]] = {}
    for r in table(spark, sf_dir, "nation").orderBy("n_regionkey", "n_nationkey").collect():  # a fixed dimension
        p = lists.setdefault(r.n_regionkey, {"names": [], "keys": []})
        p["names"].append(r.n_name)
        p["keys"].append(str(r.n_nationkey))
    for region, p in lists.items():
        tree = {"Load": {"parameters": p}}
        for point in scan_points(tree, ["Load"]):
            bound = bind(tree, "Load", point["Load"])
            rows.append((region, point["Load"], bound.params["names"], bound.params["keys"]))
    return spark.createDataFrame(rows, "n_regionkey int, scan_id int, n_name string, n_key string")


def branch_dedupe(spark, sf_dir):
    """One branch per nation whose process knows the region only: equal branches become one."""
    registry = Registry()
    registry.process("Load")(None)
    regions = [str(r.n_regionkey) for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]  # a fixed dimension
    branches = [process_node(registry.get("Load"), bind({"Load": {"parameters": {"region": x}}}, "Load"), []) for x in regions]
    return spark.createDataFrame([(b.fingerprint, int(b.bound.params["region"])) for b in combine.distinct_branches(branches)], "branch string, region int")


def scatter_gather(spark, sf_dir):
    split = combine.scatter(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), 4, "l_orderkey")
    return split.groupBy("split_ID").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def elapsed_dhms(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", scalars.elapsed_dhms(F.floor(F.col("value") * 1000)).alias("elapsed"))


def scalar_functions(spark, sf_dir):
    p = table(spark, sf_dir, "pages").where("url is not null")
    return p.select("page_id", scalars.uri_bucket("url").alias("bucket"), scalars.join_arguments(F.split("url", "/"), ",").alias("args"), scalars.stem_suffix(F.concat(F.lit("a/b"), F.col("page_id"), F.lit(".csv.gz")), "_edited").alias("edited"))


def _lineage():
    registry = Registry()
    for name, shape, up in (("Load", "NoUpstream", ()), ("Detect", "OneUpstream", ("GetLoad",)), ("Label", "TwoUpstream", ("GetLoad", "GetDetect")), ("Eval", "OneUpstream", ("GetLabel",))):
        registry.process(name, shape, up)(None)
    label = {"pipe": "TwoUpstream", "TwoUpstream": {"process": "Label", "GetLoad": {"process": "Load"}, "GetDetect": {"process": "Detect"}}}
    root = Compiler(registry).compile({"pipe": "OneUpstream", "OneUpstream": {"process": "Eval", "GetLabel": label}}, Scope({}))
    return root, {n.fingerprint: n.name for n in root.walk()}


def lineage_descendants(spark, sf_dir):
    root, names = _lineage()
    return spark.createDataFrame([(n, names[d]) for f, n in names.items() for d in descendants(root, f)], "node string, other string")


def lineage_ancestors(spark, sf_dir):
    root, names = _lineage()
    return spark.createDataFrame([(n.name, names[a]) for n in root.walk() for a in ancestors(n)], "node string, other string")


def _detections(spark, sf_dir):
    v = segments.segment_bounds(segment_view(spark, sf_dir)).select("event_id", "event_type", F.col("true_start_us").alias("start_us"), F.col("true_end_us").alias("end_us"))
    return v.where("event_type = 'click'").select(F.col("event_id").alias("det_id"), "start_us", "end_us"), v.where("event_type <> 'click'").select(F.col("event_id").alias("gt_id"), "start_us", "end_us")


def apply_cutoff(spark, sf_dir):
    return detect.apply_cutoff(table(spark, sf_dir, "events").select("event_id", "value"), 50.0, "value")


def assign_labels_iou(spark, sf_dir):
    d, g = _detections(spark, sf_dir)
    return detect.assign_labels(d, g).select("det_id", F.col("gt_id").cast("string").alias("gt_id"), F.round("iou", 9).alias("iou"), "label")


def assign_labels_with_truth(spark, sf_dir):
    d, g = _detections(spark, sf_dir)
    return detect.perf_eval(detect.assign_labels(d, g, 0.5, write_gt=True))


def merge_features_labels(spark, sf_dir):
    f = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    return detect.merge_features_labels(f, table(spark, sf_dir, "labels"), "doc_id")


def _scored(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    return rows.select("doc_id", "lang", (F.pmod(F.col("n_chars"), F.lit(100)) / 100).alias("prob"), "toxic")


def perf_eval(spark, sf_dir):
    label = F.when((F.col("prob") >= 0.5) & (F.col("toxic") == 1), "TP").when(F.col("prob") >= 0.5, "FP").when(F.col("toxic") == 1, "FN")
    return detect.perf_eval(_scored(spark, sf_dir).withColumn("label", label), ["lang"])


def perf_curve(spark, sf_dir):
    return detect.perf_curve(_scored(spark, sf_dir), "prob", "toxic")


def split_for_evaluation(spark, sf_dir):
    return detect.split_for_evaluation(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 5)


def reduce_by_field(spark, sf_dir):
    marks = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("label"), F.col("l_linestatus").alias("text"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return detect.reduce_by_field(orders, marks, "l_orderkey", ["R"], "O", union=False)


def reduce_by_field_union(spark, sf_dir):
    marks = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("label"), F.col("l_linestatus").alias("text"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return detect.reduce_by_field(orders, marks, "l_orderkey", ["R"], "O")


def format_truth(spark, sf_dir):
    return detect.format_truth(table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("signal_code")), "purchase")


def selection_fill(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return detect.fill_files(o, table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")


def runs_above(spark, sf_dir):
    return detect.runs_above(table(spark, sf_dir, "events"), "value", 50.0, ["ts", "event_id"], ["user_id"])


def detector_two_thresholds(spark, sf_dir):
    """Means over windows of three days that begin every day, of each user: events where they stay above one threshold and reach another."""
    day = 86_400_000_000
    samples = table(spark, sf_dir, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), "value")
    scores = detect.window_scores(samples, 3 * day, day, ["user_id"]).withColumn("mean", F.round("mean", 6))
    return detect.detect_events(scores, 3 * day, day, 20.0, 60.0, ["user_id"])


def balanced_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "TP").otherwise("FP").alias("label"))
    return detect.balanced_sample(rows, 2.0, "doc_id")


def external_method(spark, sf_dir):
    """Values that separated lines cannot hold as they are come through a program unchanged."""
    r = table(spark, sf_dir, "region")
    awkward = F.when(F.col("r_regionkey") == 0, F.lit('a "q" b')).when(F.col("r_regionkey") == 1, F.lit("tab\there")).when(F.col("r_regionkey") == 2, F.lit("")).when(F.col("r_regionkey") == 3, F.concat("r_name", F.lit("\\N\n\\")))
    return run_lines(r.select("r_regionkey", "r_name", awkward.alias("note")), ["cat"], "r_regionkey int, r_name string, note string")


def format_file_groups(spark, sf_dir):
    """Listed file-group files as one table: written as delimited files first, one gzipped."""
    e = table(spark, sf_dir, "events").where("event_type in ('view', 'purchase')")
    group = e.select("event_type", F.concat(F.lit("user_"), "user_id").alias("FileName"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("StartTime"), F.lit(10.0).alias("Duration"), F.lit(0.0).alias("SegStart"), (F.col("value") * 6).alias("SegDur"), "event_id")
    folder = f"{shared_dir(spark)}/file-groups-{uuid.uuid4().hex}"
    for kind, name in (("view", "views.csv"), ("purchase", "purchases.csv.gz")):
        write_csv(group.where(F.col("event_type") == kind).drop("event_type"), join_path(folder, name), gzip=name.endswith(".gz"))
    rows = read_file_groups(spark, folder, "views.csv,purchases.csv.gz", ["StartTime", F.col("event_id").cast("long")], TOLERANCE_US)
    return rows.select(F.col("event_id").cast("long").alias("event_id"), "FileName", "DiffTime")


def annotations_to_detections(spark, sf_dir):
    """Detections to an annotation tool's table, filled with files that have none, and back."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.concat(F.lit("user_"), "user_id").alias("FileName"), "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    base = 1_700_000_000_000_000
    found = e.where("event_type = 'error'").select(F.col("event_id").alias("det_id"), "FileName", (F.col("us") - base).alias("start_us"), (F.col("us") - base + F.round(F.col("value") * 1e6).cast("long")).alias("end_us"), F.lit("E").alias("label"), F.col("value").alias("prob"))
    shown = detect.to_annotations(found, e.select("FileName"))
    return detect.from_annotations(shown).select("det_id", "FileName", "start_us", "end_us", "label", F.round("prob", 6).alias("prob"))


def annotation_view(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.concat(F.lit("user_"), "user_id").alias("FileName"), "value")
    found = e.where("event_type = 'error'").select(F.col("event_id").alias("det_id"), "FileName", F.lit(500_000).cast("long").alias("start_us"), F.lit(2_000_000).cast("long").alias("end_us"), F.lit("E").alias("label"), F.lit(0.5).alias("prob"))
    shown = detect.to_annotations(found, e.select("FileName"))
    return shown.select("Begin File", F.col("Selection").cast("string").alias("Selection"), "Begin Time (s)", "End Time (s)", "Label")


def detection_features(spark, sf_dir):
    d, _ = _detections(spark, sf_dir)
    samples = segments.segment_bounds(segment_view(spark, sf_dir)).select(F.col("true_start_us").alias("time_us"), F.col("SegDur").alias("value"))
    return detect.detection_features(d, samples, 3, 60_000_000).select("det_id", "tile", "n", F.round("mean", 6).alias("mean"), F.round("peak", 6).alias("peak"))


def split_runs(spark, sf_dir):
    """A process that runs in three splits of its input, gathered by the engine."""
    registry = Registry()

    @registry.process("Load")
    def load(inputs, params):
        return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")

    @registry.process("Top", "OneUpstream", ("GetLoad",), split_key="o_custkey")
    def top(inputs, params):
        return inputs[0].groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("most"))

    node = Compiler(registry).compile({"pipe": "OneUpstream", "OneUpstream": {"process": "Top", "GetLoad": {"process": "Load"}}}, Scope({"Top": {"parameters": {}, "arguments": {"splits": "3"}}}))
    engine = Engine(spark, registry, f"{shared_dir(spark)}/split-{uuid.uuid4().hex}")
    engine.run(node)
    return engine.result(node)


def _in_order(spark, sf_dir, outfile, rows, read, order):
    """rows (with event_type) in a file a type, in an order that no column of theirs tells, through a scan over the files with a cutoff above."""
    folder = f"{shared_dir(spark)}/ordered-{uuid.uuid4().hex}"
    kinds = ("view", "purchase", "click")
    for kind in kinds:
        write_csv(rows.where(F.col("event_type") == kind).orderBy(*order), join_path(folder, kind), "\t" if outfile.endswith(".txt") else ",")
    registry = Registry()
    registry.process("Load")(lambda inputs, params: read(join_path(folder, params["file"])))
    registry.process("Cut", "OneUpstream", ("GetLoad",), outfile=outfile)(lambda inputs, params: detect.apply_cutoff(inputs[0], float(params["cutoff"]), "value"))
    tree = {"Load": {"parameters": {"file": list(kinds)}}, "Cut": {"parameters": {"cutoff": "10"}}}
    node = Compiler(registry).compile({"loop_on": "Load", "pipe": "OneUpstream", "OneUpstream": {"process": "Cut", "GetLoad": {"process": "Load"}}}, Scope(tree))
    engine = Engine(spark, registry, f"{shared_dir(spark)}/engine-{uuid.uuid4().hex}")
    engine.run(node)
    return engine.result(node)


def selections_in_file_order(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.lit(0).alias("Selection"))
    read = lambda path: read_selections(spark, path, "event_id long, event_type string, value double, Selection int")
    return _in_order(spark, sf_dir, "table.txt", rows, read, [F.md5(F.col("event_id").cast("string")), "event_id"]).select("event_id", "event_type", "Selection")


def file_groups_in_file_order(spark, sf_dir):
    e = segment_view(spark, sf_dir).withColumn("value", F.col("SegDur") / 6)
    following = F.lead("StartTime").over(Window.partitionBy("event_type").orderBy(F.desc("user_id"), "StartTime", "event_id"))
    gap = F.unix_micros(following.cast("timestamp")) - F.unix_micros(F.col("StartTime").cast("timestamp"))
    rows = e.withColumn("SegDur", F.when(F.col("event_id") % 3 == 0, F.lit(0.0)).otherwise(F.coalesce(gap / 1e6, F.lit(0.0)))).withColumn("StartTime", F.date_format("StartTime", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    rows = rows.select("event_id", "user_id", "event_type", "FileName", "StartTime", F.lit(1.0).alias("Duration"), "SegStart", "SegDur", "value", F.lit(0).alias("DiffTime"))
    read = lambda path: read_file_group(spark, path).withColumn("value", F.col("value").cast("double"))
    out = _in_order(spark, sf_dir, "FileGroupFormat.csv.gz", rows, read, [F.desc("user_id"), "StartTime", "event_id"])
    return out.select(F.col("event_id").cast("long").alias("event_id"), "event_type", "DiffTime")


def changed_part_remade(spark, sf_dir):
    """Files of events as parts: after the first run one file changes, one goes and one comes, and the second run makes just these."""
    place = f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")

    def put(k, rows):
        write_csv(rows.where(F.pmod("user_id", F.lit(10)) == k).select("event_id", "user_id", "value").coalesce(1), f"{place}/new")
        delete(spark, f"{place}/in/part{k}.csv")
        copy_file(spark, next(f for f in list_files(spark, f"{place}/new") if "/part-" in f), f"{place}/in/part{k}.csv")

    registry = Registry()
    registry.process("Load", part_folder=lambda params: f"{place}/in")(lambda files, params: read_csv(spark, files, "event_id long, user_id long, value double", positions=True))
    totals = lambda inputs, params: inputs[0].groupBy(PART).agg(F.first(F.element_at(F.split(PART, "[.]"), 1)).alias("part"), F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    registry.process("Totals", "OneUpstream", ("GetLoad",), by_part=True)(totals)
    node = Compiler(registry).compile({"pipe": "OneUpstream", "OneUpstream": {"process": "Totals", "GetLoad": {"process": "Load"}}}, Scope({}))
    engine = Engine(spark, registry, f"{place}/store")
    for k in range(9):
        put(k, events)
    engine.run(node)
    put(3, events.withColumn("value", F.col("value") * 2))
    delete(spark, f"{place}/in/part5.csv")
    put(9, events)
    second = engine.run(node).parts["Totals"]
    remade = F.broadcast(spark.createDataFrame([(x.split(".")[0], True) for x in second["made"]], "part string, remade boolean"))
    return engine.result(node).join(remade, "part", "left").select("part", "n", "total", F.coalesce("remade", F.lit(False)).alias("remade"))


def cutoff_scan_at_once(spark, sf_dir):
    """A scan over 1,000 cutoffs as one node and one aggregation."""
    registry = Registry()
    registry.process("Load")(lambda inputs, params: _scored(spark, sf_dir))
    registry.process("Evaluate", "OneUpstream", ("GetLoad",), points=True)(lambda inputs, points: detect.perf_at_cutoffs(inputs[0], points, "prob", "toxic"))
    tree = {"Load": {"parameters": {}}, "Evaluate": {"parameters": {"cutoff": [f"{k / 1000:.3f}" for k in range(1000)]}}}
    node = Compiler(registry).compile({"loop_on": "Evaluate", "pipe": "OneUpstream", "OneUpstream": {"process": "Evaluate", "GetLoad": {"process": "Load"}}}, Scope(tree))
    engine = Engine(spark, registry, f"{shared_dir(spark)}/scan-{uuid.uuid4().hex}")
    engine.run(node)
    return engine.result(node)


def forest_as_a_node(spark, sf_dir):
    """A forest fitted by one node and applied by another, twice: the second run reuses the model."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("value") >= 50).cast("double").alias("high"), (F.col("event_type") == "click").cast("double").alias("click"))
    registry = Registry()
    registry.process("Load")(lambda inputs, params: e)
    registry.process("Label", "OneUpstream", ("GetLoad",))(lambda inputs, params: inputs[0].withColumn("label", F.when(F.col("high") > 0, "TP").otherwise("FP")))
    registry.process("Train", "OneUpstream", ("GetLabel",), outfile="forest.model")(train_process(["high", "click"], "event_id"))
    registry.process("Apply", "TwoUpstream_noCon", ("GetLoad", "GetTrain"))(apply_process)
    train = {"pipe": "OneUpstream", "OneUpstream": {"process": "Train", "GetLabel": {"pipe": "OneUpstream", "OneUpstream": {"process": "Label", "GetLoad": {"process": "Load"}}}}}
    tree = {"Train": {"parameters": {"ntree": "5", "mtry": "all", "balance_tpfp": "n"}}}
    node = Compiler(registry).compile({"pipe": "TwoUpstream_noCon", "TwoUpstream_noCon": {"process": "Apply", "GetLoad": {"process": "Load"}, "GetTrain": train}}, Scope(tree))
    engine = Engine(spark, registry, f"{shared_dir(spark)}/model-{uuid.uuid4().hex}")
    engine.run(node)
    engine.store.drop([node.fingerprint])
    again = engine.run(node)
    model = next(n.fingerprint for n in node.walk() if n.name == "Train")
    return engine.result(node).select("event_id", (F.col("prob") >= 0.5).alias("found"), F.lit(model in again.reused).alias("model_reused"))


def gzip_file_by_many(spark, sf_dir):
    """Events in one named gzipped file, whose members are written, found, inflated and parsed by several tasks each."""
    path = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}.csv.gz"
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    write_single_csv(events.repartition(8, "event_id"), path)
    return read_gzip_csv(spark, [path], "event_id long, event_type string, value double", share=1 << 14)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        segment_bounds, segment_islands, segment_islands_by_user, segment_islands_capped, segment_islands_one_chain, islands_of_arriving_files, island_rollup, union_renumber, union_schema_drift, filegroup_combine,
        param_scan_product, param_scan_zip_sorted, branch_dedupe, scatter_gather, elapsed_dhms, scalar_functions, lineage_descendants, lineage_ancestors, apply_cutoff,
        assign_labels_iou, assign_labels_with_truth, merge_features_labels, perf_eval, perf_curve, split_for_evaluation, reduce_by_field, reduce_by_field_union,
        format_truth, selection_fill, runs_above, detector_two_thresholds, balanced_sample, external_method, format_file_groups, annotations_to_detections, annotation_view, detection_features, split_runs, selections_in_file_order, file_groups_in_file_order, changed_part_remade, cutoff_scan_at_once, forest_as_a_node,
        gzip_file_by_many,
    )
}

_ISLANDS = """num AS (
  SELECT *, 1 + coalesce(sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY {by} ORDER BY StartTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS DiffTime
  FROM (SELECT *, coalesce(abs(true_end_us - lead(true_start_us) OVER (PARTITION BY {by} ORDER BY StartTime, event_id)) <= 180000000, true) AS joined FROM {of})
)"""
_LINEAGE = """edge(a, b) AS (VALUES ('Load', 'Detect'), ('Load', 'Label'), ('Detect', 'Label'), ('Label', 'Eval')),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)"""
_INTERVALS = f"""{_SEGMENTS}, det AS (SELECT event_id AS det_id, true_start_us AS s, true_end_us AS e FROM seg WHERE event_type = 'click'),
gt AS (SELECT event_id AS gt_id, true_start_us AS s, true_end_us AS e FROM seg WHERE event_type <> 'click'),
pairs AS (
  SELECT det_id, gt_id, (least(det.e, gt.e) - greatest(det.s, gt.s)) / (greatest(det.e, gt.e) - least(det.s, gt.s)) AS iou
  FROM det JOIN gt ON det.s < gt.e AND gt.s < det.e WHERE det.e > det.s AND gt.e > gt.s
), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY det_id ORDER BY iou DESC, gt_id) AS n FROM pairs) WHERE n = 1)"""
_RATES = "CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall"
_SCORED = "scored AS (SELECT doc_id, lang, (n_chars % 100) / 100 AS prob, toxic FROM labels JOIN documents USING (doc_id))"
_MARKS = "SELECT o_orderkey AS l_orderkey, o_totalprice FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R') {op} EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND contains(l_linestatus, 'O'))"

SQL: dict[str, str] = {
    "segment_bounds": f"WITH {_SEGMENTS} SELECT event_id, true_start_us, true_end_us FROM seg",
    "segment_islands": f"WITH {_SEGMENTS}, {_ISLANDS.format(by='1', of='seg')} SELECT event_id, DiffTime FROM num",
    "segment_islands_by_user": f"WITH {_SEGMENTS}, {_ISLANDS.format(by='user_id', of='seg')} SELECT event_id, user_id, DiffTime FROM num",
    "segment_islands_capped": f"""
WITH RECURSIVE {_SEGMENTS}, {_ISLANDS.format(by='1', of='seg')},
placed AS (SELECT *, row_number() OVER (PARTITION BY DiffTime ORDER BY StartTime, event_id) AS i FROM num),
fold AS (
  SELECT DiffTime, i, event_id, StartTime, joined AND NOT (SegDur >= 900) AS joined, CASE WHEN NOT joined OR SegDur >= 900 THEN 0.0 ELSE SegDur END AS total FROM placed WHERE i = 1
  UNION ALL
  SELECT p.DiffTime, p.i, p.event_id, p.StartTime, p.joined AND NOT (f.total + p.SegDur >= 900), CASE WHEN NOT p.joined OR f.total + p.SegDur >= 900 THEN 0.0 ELSE f.total + p.SegDur END
  FROM fold f JOIN placed p ON p.DiffTime = f.DiffTime AND p.i = f.i + 1
)
SELECT event_id, 1 + coalesce(sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (ORDER BY StartTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS DiffTime FROM fold""",
    "segment_islands_one_chain": """
WITH RECURSIVE placed AS MATERIALIZED (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS i, round(value * 6 * 1000000)::BIGINT AS d FROM events),
fold AS (
  SELECT i, event_id, CASE WHEN d >= 900000000 THEN 0 ELSE d END AS total, d >= 900000000 AS cut FROM placed WHERE i = 1
  UNION ALL
  SELECT p.i, p.event_id, CASE WHEN f.total + p.d >= 900000000 THEN 0 ELSE f.total + p.d END, f.total + p.d >= 900000000 FROM fold f JOIN placed p ON p.i = f.i + 1
)
SELECT event_id, 1 + coalesce(sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS DiffTime FROM fold""",
    "islands_of_arriving_files": f"WITH {_SEGMENTS}, {_ISLANDS.format(by='user_id', of='seg')} SELECT user_id, DiffTime, count(*) AS segments, min(true_start_us) AS start_us, max(true_end_us) AS end_us FROM num GROUP BY user_id, DiffTime",
    "island_rollup": f"WITH {_SEGMENTS}, {_ISLANDS.format(by='1', of='seg')} SELECT DiffTime, count(*) AS segments, min(true_start_us) AS start_us, max(true_end_us) AS end_us, round(sum(SegDur), 4) AS total_dur FROM num GROUP BY DiffTime",
    "union_renumber": "SELECT event_id, event_type, user_id, row_number() OVER (ORDER BY CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END, event_id) AS Selection FROM events WHERE event_type IN ('click', 'view', 'error')",
    "union_schema_drift": "SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, c_acctbal, c_mktsegment FROM customer UNION ALL BY NAME SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey, s_acctbal FROM supplier",
    "filegroup_combine": f"""WITH {_SEGMENTS}, two AS (SELECT *, CASE event_type WHEN 'view' THEN 0 ELSE 1 END AS port FROM seg WHERE event_type IN ('view', 'purchase')),
flag AS (SELECT *, coalesce(abs(true_end_us - lead(true_start_us) OVER (ORDER BY port, StartTime, event_id)) <= 180000000, true) AS joined FROM two)
SELECT event_id, event_type, 1 + coalesce(sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (ORDER BY port, StartTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS DiffTime FROM flag""",
    "param_scan_product": "SELECT r_name, cutoff, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey, (VALUES ('0.5'), ('0.9')) c(cutoff) GROUP BY r_name, cutoff",
    "param_scan_zip_sorted": """WITH a AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS i FROM nation),
b AS (SELECT n_regionkey, n_nationkey::VARCHAR AS n_key, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey::VARCHAR) - 1 AS i FROM nation)
SELECT a.n_regionkey, a.i::INT AS scan_id, n_name, n_key FROM a JOIN b ON a.n_regionkey = b.n_regionkey AND a.i = b.i""",
    "branch_dedupe": """SELECT DISTINCT sha256('{"children":[],"method":["",""],"op":"Load","params":{"region":"' || n_regionkey || '"},"rerun_key":null}') AS branch, n_regionkey AS region FROM nation""",
    "scatter_gather": "SELECT (l_orderkey % 4 + 1)::INT AS split_ID, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1",
    "elapsed_dhms": "WITH s AS (SELECT event_id, floor(value * 1000)::BIGINT AS s FROM events) SELECT event_id, concat_ws(':', s // 86400, s % 86400 // 3600, s % 3600 // 60, s % 60) AS elapsed FROM s",
    "scalar_functions": r"SELECT page_id, regexp_extract(url, '^[a-z0-9+.-]+://([^/]+)', 1) AS bucket, array_to_string(string_split(regexp_replace(url, '[\r\n]', '', 'g'), '/'), ',') AS args, 'a/b' || page_id || '_edited.csv.gz' AS edited FROM pages WHERE url IS NOT NULL",
    "lineage_descendants": f"WITH RECURSIVE {_LINEAGE} SELECT a AS node, b AS other FROM reach",
    "lineage_ancestors": f"WITH RECURSIVE {_LINEAGE} SELECT b AS node, a AS other FROM reach",
    "apply_cutoff": "SELECT event_id, value FROM events WHERE value >= 50",
    "assign_labels_iou": f"WITH {_INTERVALS} SELECT det_id, CASE WHEN iou >= 0.15 THEN gt_id::VARCHAR END AS gt_id, round(coalesce(iou, 0), 9) AS iou, CASE WHEN iou >= 0.15 THEN 'TP' ELSE 'FP' END AS label FROM det LEFT JOIN best USING (det_id)",
    "assign_labels_with_truth": f"""WITH {_INTERVALS}, hit AS (SELECT det_id, CASE WHEN iou >= 0.5 THEN gt_id END AS gt_id FROM det LEFT JOIN best USING (det_id)),
sums AS (SELECT count(gt_id) AS tp, count(*) - count(gt_id) AS fp, (SELECT count(*) FROM gt WHERE gt_id NOT IN (SELECT gt_id FROM hit WHERE gt_id IS NOT NULL)) AS fn FROM hit)
SELECT tp, fp, fn, {_RATES} FROM sums""",
    "merge_features_labels": "SELECT doc_id, n_chars, lang, quality, toxic FROM documents JOIN labels USING (doc_id)",
    "perf_eval": f"""WITH {_SCORED}, sums AS (SELECT lang, count(*) FILTER (WHERE prob >= 0.5 AND toxic = 1) AS tp, count(*) FILTER (WHERE prob >= 0.5 AND toxic = 0) AS fp, count(*) FILTER (WHERE prob < 0.5 AND toxic = 1) AS fn FROM scored GROUP BY lang)
SELECT lang, tp, fp, fn, {_RATES} FROM sums""",
    "perf_curve": f"""WITH {_SCORED}, per AS (SELECT prob AS cutoff, sum(toxic) AS p, count(*) AS n FROM scored GROUP BY prob),
run AS (SELECT cutoff, sum(p) OVER w::BIGINT AS tp, (sum(n) OVER w - sum(p) OVER w)::BIGINT AS fp, ((SELECT sum(p) FROM per) - sum(p) OVER w)::BIGINT AS fn FROM per WINDOW w AS (ORDER BY cutoff DESC))
SELECT cutoff, tp, fp, fn, {_RATES} FROM run""",
    "split_for_evaluation": "SELECT o_orderkey, o_custkey, (o_custkey % 5 + 1)::INT AS fold FROM orders",
    "reduce_by_field": _MARKS.format(op="AND"),
    "reduce_by_field_union": _MARKS.format(op="OR"),
    "format_truth": "SELECT event_id, event_type AS signal_code FROM events WHERE event_type = 'purchase'",
    "selection_fill": "SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
    "runs_above": """WITH f AS (SELECT *, value >= 50 AS up, lag(value >= 50) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
r AS (SELECT *, sum(CASE WHEN up AND NOT coalesce(before, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f)
SELECT user_id, run::BIGINT AS run, count(*) AS n, max(value) AS peak FROM r WHERE up GROUP BY user_id, run""",
    "detector_two_thresholds": """WITH s AS (SELECT user_id, epoch_us(ts) AS t, value FROM events),
w AS (SELECT user_id, t // 86400000000 * 86400000000 - k * 86400000000 AS b, value FROM s, range(3) r(k)),
m AS (SELECT user_id, b, round(avg(value), 6) AS mean FROM w GROUP BY user_id, b),
o AS (SELECT *, CASE WHEN b - lag(b) OVER (PARTITION BY user_id ORDER BY b) = 86400000000 THEN 0 ELSE 1 END AS fresh FROM m WHERE mean >= 20),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY b) AS run FROM o),
e AS (SELECT user_id, min(b) AS start_us, max(b) + 259200000000 AS end_us, count(*) AS windows, max(mean) AS peak FROM r GROUP BY user_id, run HAVING max(mean) >= 60)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY start_us) AS event, start_us, end_us, windows, peak FROM e""",
    "balanced_sample": """WITH l AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'TP' ELSE 'FP' END AS label FROM labels), f AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS n FROM l)
SELECT doc_id, label FROM f WHERE label = 'TP' OR n <= 2 * (SELECT count(*) FROM l WHERE label = 'TP')""",
    "external_method": r"""SELECT r_regionkey, r_name, CASE r_regionkey WHEN 0 THEN 'a "q" b' WHEN 1 THEN 'tab' || chr(9) || 'here' WHEN 2 THEN '' WHEN 3 THEN r_name || '\N' || chr(10) || '\' END AS note FROM region""",
    "format_file_groups": f"""WITH {_SEGMENTS}, two AS (SELECT *, CASE event_type WHEN 'view' THEN 0 ELSE 1 END AS port FROM seg WHERE event_type IN ('view', 'purchase')),
flag AS (SELECT *, coalesce(abs(true_end_us - lead(true_start_us) OVER (ORDER BY port, StartTime, event_id)) <= 180000000, true) AS joined FROM two)
SELECT event_id, 'user_' || user_id AS FileName, 1 + coalesce(sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (ORDER BY port, StartTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS DiffTime FROM flag""",
    "annotations_to_detections": "SELECT event_id AS det_id, 'user_' || user_id AS FileName, epoch_us(ts) - 1700000000000000 AS start_us, epoch_us(ts) - 1700000000000000 + round(value * 1000000)::BIGINT AS end_us, 'E' AS label, round(value, 6) AS prob FROM events WHERE event_type = 'error'",
    "annotation_view": """WITH f AS (SELECT DISTINCT 'user_' || user_id AS name FROM events), d AS (SELECT event_id, 'user_' || user_id AS name FROM events WHERE event_type = 'error')
SELECT f.name AS "Begin File", event_id::VARCHAR AS "Selection", CASE WHEN event_id IS NOT NULL THEN 0.5::DOUBLE END AS "Begin Time (s)", CASE WHEN event_id IS NOT NULL THEN 2.0::DOUBLE END AS "End Time (s)", CASE WHEN event_id IS NOT NULL THEN 'E' END AS "Label" FROM f LEFT JOIN d USING (name)""",
    "detection_features": f"""WITH {_SEGMENTS}, det AS (SELECT event_id AS det_id, true_start_us - 60000000 AS s, true_end_us + 60000000 AS e FROM seg WHERE event_type = 'click'),
inside AS (SELECT det_id, least((true_start_us - s) * 3 // (e - s), 2)::INT AS tile, SegDur AS v FROM det JOIN seg ON true_start_us >= s AND true_start_us < e WHERE e > s)
SELECT det_id, tile, count(*) AS n, round(avg(v), 6) AS mean, round(max(v), 6) AS peak FROM inside GROUP BY det_id, tile""",
    "selections_in_file_order": "SELECT event_id, event_type, (row_number() OVER (ORDER BY event_type, md5(event_id::VARCHAR), event_id)) AS Selection FROM events WHERE event_type IN ('view', 'purchase', 'click') AND value >= 10",
    "file_groups_in_file_order": """WITH f AS (
  SELECT *, epoch_us(ts) AS s, lead(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY user_id DESC, ts, event_id) - epoch_us(ts) AS gap FROM events WHERE event_type IN ('view', 'purchase', 'click')
), g AS (SELECT *, s + CASE WHEN event_id % 3 = 0 THEN 0 ELSE coalesce(gap, 0) END AS e FROM f WHERE value >= 10),
j AS (SELECT *, coalesce(abs(e - lead(s) OVER (ORDER BY event_type, user_id DESC, ts, event_id)) <= 1000000, true) AS joined FROM g)
SELECT event_id, event_type, 1 + coalesce(sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (ORDER BY event_type, user_id DESC, ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS DiffTime FROM j""",
    "changed_part_remade": "SELECT 'part' || user_id % 10 AS part, count(*) AS n, round(sum(CASE WHEN user_id % 10 = 3 THEN 2 * value ELSE value END), 2) AS total, user_id % 10 IN (3, 9) AS remade FROM events WHERE user_id % 10 <> 5 GROUP BY user_id % 10",
    "cutoff_scan_at_once": f"""WITH {_SCORED}, c AS (SELECT printf('%.3f', k / 1000) AS cutoff FROM range(1000) t(k)),
sums AS (SELECT cutoff, count(*) FILTER (WHERE prob >= cutoff::DOUBLE AND toxic = 1) AS tp, count(*) FILTER (WHERE prob >= cutoff::DOUBLE AND toxic = 0) AS fp, count(*) FILTER (WHERE NOT prob >= cutoff::DOUBLE AND toxic = 1) AS fn FROM scored, c GROUP BY cutoff)
SELECT cutoff, tp, fp, fn, {_RATES} FROM sums""",
    "forest_as_a_node": "SELECT event_id, value >= 50 AS found, true AS model_reused FROM events",
    "gzip_file_by_many": "SELECT event_id, event_type, value FROM events",
    "split_runs": "SELECT o_custkey, count(*) AS n, max(o_totalprice) AS most FROM orders GROUP BY o_custkey",
}

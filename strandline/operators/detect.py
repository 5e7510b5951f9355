"""Detection-workflow operators: cutoff, labels by interval overlap, feature merge, evaluation, field reduction.

The semantics are this library's own where only names and parameters of an operator are known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators import sweep
from strandline.operators.segments import by_range, light, neighbour, ranged, row_numbers, running
from strandline.sources.order import POINT

def apply_cutoff(detections: DataFrame, cutoff: float, score: str = "prob") -> DataFrame:
    """Rows whose score is at least the cutoff; rows without a score go."""
    return detections.where(F.col(score) >= cutoff)


def _reached(df: DataFrame, points: DataFrame, cutoff: str, score: str) -> tuple[DataFrame, list[tuple[float, list]]]:
    """df's rows that reach a cutoff, with __n, how many of the different cutoffs they reach, and (cutoff, its rows of points) in rising
    order.  points is a row a point of a scan, so it fits the driver; a row's place among the cutoffs is found by halving."""
    at: dict[float, list] = {}
    for r in points.collect():
        at.setdefault(float(r[cutoff]), []).append(r)
    cuts = sorted(at)
    inner = [-float("inf"), *cuts, float("inf")]
    found = Bucketizer(splits=inner, inputCol="__s", outputCol="__n", handleInvalid="skip").transform(df.where(F.col(score).isNotNull()).withColumn("__s", F.col(score).cast("double")))
    return found.withColumn("__n", F.col("__n").cast("int")).where("__n > 0").drop("__s"), [(c, at[c]) for c in cuts]


def apply_cutoffs(detections: DataFrame, points: DataFrame, score: str = "prob", cutoff: str = "cutoff") -> DataFrame:
    """apply_cutoff() at every point of a scan at once: each row once for each point whose cutoff it reaches, with the point's number
    (order.POINT); no row meets a cutoff above its score."""
    rows, cuts = _reached(detections, points, cutoff, score)
    numbers = F.array(*[F.array(*[F.lit(r[POINT]) for r in rs]) for _, rs in cuts])
    return rows.withColumn(POINT, F.explode(F.flatten(F.slice(numbers, F.lit(1), F.col("__n"))))).drop("__n")


def perf_at_cutoffs(scored: DataFrame, points: DataFrame, score: str, positive: str, cutoff: str = "cutoff") -> DataFrame:
    """(order.POINT, cutoff, tp, fp, fn, precision, recall) of every point of a scan, score >= cutoff being detected, from one aggregation: rows are
    summed by how many cutoffs they reach, and the sums then run over the cutoffs."""
    rows, cuts = _reached(scored, points, cutoff, score)
    hit = F.col(positive).cast("long")
    all_true = scored.agg(F.coalesce(F.sum(hit), F.lit(0)).alias("__all"))
    per = rows.groupBy("__n").agg(F.sum(hit).alias("t"), F.count("*").alias("n"))
    place = scored.sparkSession.createDataFrame([(i + 1, r[POINT], r[cutoff]) for i, (_, rs) in enumerate(cuts) for r in rs], f"__n int, {POINT} int, cutoff string")
    # as many rows as there are points
    down = Window.orderBy(F.desc("__n")).rangeBetween(Window.unboundedPreceding, 0)
    sums = place.select("__n").distinct().join(per, "__n", "left").select("__n", F.sum(F.coalesce("t", F.lit(0))).over(down).alias("tp"), F.sum(F.coalesce("n", F.lit(0))).over(down).alias("n"))
    run = place.join(sums, "__n").crossJoin(F.broadcast(all_true)).select(POINT, "cutoff", "tp", (F.col("n") - F.col("tp")).alias("fp"), (F.col("__all") - F.col("tp")).alias("fn"))
    return run.select(POINT, "cutoff", "tp", "fp", "fn", *_rates(F.col("tp"), F.col("fp"), F.col("fn")))


def overlaps(detections: DataFrame, truth: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(det_id, gt_id, iou) of each detection and ground-truth interval that overlap by more than a point; see sweep.pairs()."""
    d, g = detections.where("end_us > start_us"), truth.where("end_us > start_us")
    pairs = sweep.pairs(d.select("det_id", *keys, "start_us", "end_us"), g.select("gt_id", *keys, "start_us", "end_us"), keys)
    inter = F.least("a.end_us", "b.end_us") - F.greatest("a.start_us", "b.start_us")
    union = F.greatest("a.end_us", "b.end_us") - F.least("a.start_us", "b.start_us")
    return pairs.select("a.det_id", "b.gt_id", (inter / union).alias("iou"))


def assign_labels(detections: DataFrame, truth: DataFrame, iou_thresh: float = 0.15, write_gt: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """detections with gt_id, iou and label: TP where the best overlap reaches the threshold, else FP (gt_id null).

    The best overlap is the largest iou, of equal ones the smallest gt_id.  write_gt appends the ground-truth
    intervals that no TP has for its best, as FN with det_id null.
    """
    d, g = detections.where("end_us > start_us"), truth.where("end_us > start_us")
    # of each range of time the best only: pairs grow with the square of how dense the intervals are
    near = sweep.closest(d.select("det_id", *keys, "start_us", "end_us"), g.select("gt_id", *keys, "start_us", "end_us"), "gt_id", keys)
    best = near.select("a.det_id", "b.gt_id", "iou").groupBy("det_id").agg(F.max(F.struct("iou", (-F.col("gt_id")).alias("__neg"))).alias("__b"))
    best = best.select("det_id", F.col("__b.iou").alias("iou"), (-F.col("__b.__neg")).alias("gt_id"))
    hit = F.col("iou") >= iou_thresh
    out = detections.join(best, "det_id", "left").withColumn("gt_id", F.when(hit, F.col("gt_id"))).withColumn("label", F.when(hit, "TP").otherwise("FP")).withColumn("iou", F.coalesce("iou", F.lit(0.0)))
    if not write_gt:
        return out
    missed = truth.join(out.where("label = 'TP'").select("gt_id"), "gt_id", "left_anti").withColumn("label", F.lit("FN")).withColumn("iou", F.lit(0.0))
    return out.unionByName(missed.select(*[c for c in missed.columns if c in out.columns]), allowMissingColumns=True)


def merge_features_labels(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; columns of the same name are the features'."""
    return features.join(labels.drop(*[c for c in labels.columns if c in features.columns and c != key]), key)


def _rates(tp: Column, fp: Column, fn: Column) -> list[Column]:
    return [F.when(tp + fp > 0, F.round(tp / (tp + fp), 6)).alias("precision"), F.when(tp + fn > 0, F.round(tp / (tp + fn), 6)).alias("recall")]


def perf_eval(labelled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, precision and recall per group."""
    n = lambda x: F.sum(F.when(F.col("label") == x, 1).otherwise(0)).alias(x.lower())
    sums = labelled.groupBy(*keys).agg(n("TP"), n("FP"), n("FN"))
    return sums.select(*keys, "tp", "fp", "fn", *_rates(F.col("tp"), F.col("fp"), F.col("fn")))


def perf_curve(scored: DataFrame, score: str, positive: str) -> DataFrame:
    """(cutoff, tp, fp, fn, precision, recall) at each distinct score, taking score >= cutoff as detected.

    Rows are summed per score first; the running sums then go over ranges of scores, each range starting from the
    sums of the ranges above it (one row per range on the driver).
    """
    per = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("cutoff")).agg(F.sum(F.col(positive).cast("long")).alias("p"), F.count("*").alias("n"))
    held = ranged(per.withColumn("__down", -F.col("cutoff")), ["__down"])
    rows, p, n = [], 0, 0
    for r in sorted(held.groupBy("__range").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect()):
        rows.append((r["__range"], p, n))
        p, n = p + r["p"], n + r["n"]
    w = Window.partitionBy("__range").orderBy("__row").rowsBetween(Window.unboundedPreceding, 0)
    out = by_range(held, rows or [(0, 0, 0)], "__range long, __p long, __n long")
    tp, seen = F.col("__p") + F.sum("p").over(w), F.col("__n") + F.sum("n").over(w)
    run = out.select("cutoff", tp.alias("tp"), (seen - tp).alias("fp"), (F.lit(p) - tp).alias("fn"))
    return run.select("cutoff", "tp", "fp", "fn", *_rates(F.col("tp"), F.col("fp"), F.col("fn")))


def split_for_evaluation(df: DataFrame, key: str, folds: int) -> DataFrame:
    """Whole file groups to folds 1..folds by the key's remainder."""
    return df.withColumn("fold", (F.pmod(F.col(key), F.lit(folds)) + 1).cast("int"))


def reduce_by_field(df: DataFrame, marks: DataFrame, key: str, labels: Sequence[str] | None = None, text: str | None = None, union: bool = True, label: str = "label", field: str = "text") -> DataFrame:
    """Rows of df whose file (key) has a mark with one of the labels and / or a mark whose field contains the text.

    union: one of the two is enough; otherwise a file needs both.  A criterion that is None is not used.
    """
    tests = [c for c in (F.col(label).isin(list(labels)) if labels is not None else None, F.col(field).contains(text) if text is not None else None) if c is not None]
    if not tests:
        return df
    hits = marks.groupBy(key).agg(*[F.max(F.coalesce(t, F.lit(False))).alias(f"__t{i}") for i, t in enumerate(tests)])
    cond = F.col("__t0")
    for i in range(1, len(tests)):
        cond = (cond | F.col(f"__t{i}")) if union else (cond & F.col(f"__t{i}"))
    return df.join(hits.where(cond).select(key), key, "left_semi")


def format_truth(marks: DataFrame, signal_code: str, column: str = "signal_code") -> DataFrame:
    return marks.where(F.col(column) == signal_code)


def fill_files(selections: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Every file with its selections; files without any have one row of nulls."""
    return files.join(selections, key, "left")


def runs_above(df: DataFrame, value: str, threshold: float, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Detections as maximal runs of consecutive rows of a key whose value is at least the threshold."""
    on = df.withColumn("__on", F.coalesce(F.col(value) >= threshold, F.lit(False)))
    new = (F.col("__on") & ~F.coalesce("__before_on", F.lit(False))).cast("long")
    if keys and light(df, keys):
        w = Window.partitionBy(*keys).orderBy(*order)
        marked = on.withColumn("__before_on", F.lag("__on").over(w)).withColumn("run", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        before = neighbour(ranged(on, [*keys, *order]), F.col("__on"), keys, "__before_on", forward=False)
        marked = running(before.withColumn("__new", new), F.col("__new"), keys, "run", inclusive=True)
    return marked.where("__on").groupBy(*keys, "run").agg(F.count("*").alias("n"), F.max(value).alias("peak"))


def window_scores(samples: DataFrame, length_us: int, step_us: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, start_us, n, mean, peak) of the samples (time_us, value) in windows of length_us that begin every step_us from time 0; windows overlap where the step
    is shorter.  A sample is counted in each window it is in, so none needs what another task has; windows without samples have no row.
    """
    if length_us <= 0 or step_us <= 0:
        raise ValueError("windows and steps have a length")
    last = F.floor(F.col("time_us") / step_us) * step_us
    begins = F.filter(F.transform(F.sequence(F.lit(0), F.lit((length_us - 1) // step_us)), lambda k: last - k * step_us), lambda b: b + length_us > F.col("time_us"))
    rows = samples.where("time_us is not null and value is not null").select(*keys, F.explode(begins).alias("start_us"), "value")
    return rows.groupBy(*keys, "start_us").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("peak"))


def detect_events(scores: DataFrame, length_us: int, step_us: int, low: float, high: float, keys: Sequence[str] = (), score: str = "mean") -> DataFrame:
    """(keys, event, start_us, end_us, windows, peak): runs of neighbouring windows whose score is at least `low`, of which one reaches `high`.

    scores: see window_scores().  The second threshold decides which runs are events, the first how far they go; event numbers, from 1, count a
    key's events in time.  A window that has no row ends a run.
    """
    if high < low:
        raise ValueError("the second threshold is not below the first")
    on = scores.where(F.col(score) >= low).select(*keys, "start_us", F.col(score).alias("__s"))
    new = lambda before: (before.isNull() | (F.col("start_us") - before > step_us)).cast("long")
    if keys and light(on, keys):
        w = Window.partitionBy(*keys).orderBy("start_us")
        runs = on.withColumn("__new", new(F.lag("start_us").over(w))).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        held = neighbour(ranged(on, [*keys, "start_us"]), F.col("start_us"), keys, "__last", forward=False)
        runs = running(held.withColumn("__new", new(F.col("__last"))), F.col("__new"), keys, "__run", inclusive=True)
    found = runs.groupBy(*keys, "__run").agg(F.min("start_us").alias("start_us"), (F.max("start_us") + length_us).alias("end_us"), F.count("*").alias("windows"), F.max("__s").alias("peak")).where(F.col("peak") >= high)
    if keys and light(found, keys):
        return found.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy("start_us")).cast("long").alias("event"), "start_us", "end_us", "windows", "peak")
    numbered = running(ranged(found, [*keys, "start_us"]), F.lit(1).cast("long"), keys, "event", inclusive=True)
    return numbered.select(*keys, "event", "start_us", "end_us", "windows", "peak")


#: Columns of an annotation tool's table and what they hold here; times are seconds from the start of the file.
ANNOTATION = {"Selection": "det_id", "Begin File": "FileName", "Begin Time (s)": "start_us", "End Time (s)": "end_us", "Label": "label", "Score": "prob"}


def to_annotations(detections: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Detections (det_id, FileName, start_us, end_us, label, prob; times from the start of the file) as an annotation tool's
    table.  With files (FileName), each file without detections has one row of nulls, so that it can be looked through too.
    """
    rows = fill_files(detections, files.select("FileName").distinct(), "FileName") if files is not None else detections
    seconds = lambda c: F.col(c) / 1_000_000
    return rows.select(*[(seconds(c) if c.endswith("_us") else F.col(c)).alias(name) for name, c in ANNOTATION.items()])


def from_annotations(table: DataFrame) -> DataFrame:
    """Detections from an annotation tool's table; rows without times (files without detections) go, and columns that the table
    lacks are null."""
    kinds = {"det_id": "long", "FileName": "string", "start_us": "long", "end_us": "long", "label": "string", "prob": "double"}
    have = {name: F.col(f"`{name}`") if name in table.columns else F.lit(None) for name in ANNOTATION}
    micro = lambda c: F.round(c.cast("double") * 1_000_000)
    out = table.select(*[(micro(have[name]) if c.endswith("_us") else have[name]).cast(kinds[c]).alias(c) for name, c in ANNOTATION.items()])
    return out.where("start_us is not null and end_us is not null")


def detection_features(detections: DataFrame, samples: DataFrame, tiles: int, buffer_us: int = 0, normalise: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """(det_id, tile, n, mean, peak) of the samples (time_us, value) in each detection, cut in `tiles` equal parts of its time.

    A detection reaches buffer_us beyond both its ends; end times are outside.  normalise: values count as distances from the
    detection's mean in its standard deviations (0 where that is 0).  Tiles without samples have no row; samples
    without value or time take no part.
    """
    wide = detections.select("det_id", *keys, (F.col("start_us") - buffer_us).alias("start_us"), (F.col("end_us") + buffer_us).alias("end_us"))
    points = samples.where("time_us is not null and value is not null").select(*keys, F.col("time_us").alias("start_us"), F.col("time_us").alias("end_us"), "value")
    met = sweep.pairs(wide.where("end_us > start_us"), points, keys, both=False)
    inside = met.select("a.det_id", F.col("a.start_us").alias("ds"), F.col("a.end_us").alias("de"), F.col("b.start_us").alias("t"), "b.value")
    tile = F.least(F.floor((F.col("t") - F.col("ds")) * tiles / (F.col("de") - F.col("ds"))), F.lit(tiles - 1)).cast("int")
    out = inside.groupBy("det_id", tile.alias("tile")).agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("peak"))
    if not normalise:
        return out
    per = inside.groupBy("det_id").agg(F.avg("value").alias("__m"), F.stddev_pop("value").alias("__s"))
    z = lambda c: F.when(F.col("__s") > 0, (F.col(c) - F.col("__m")) / F.col("__s")).otherwise(F.lit(0.0)).alias(c)
    return out.join(per, "det_id").select("det_id", "tile", "n", z("mean"), z("peak"))


def balanced_sample(labelled: DataFrame, fp_multiple: float, key: str, label: str = "label") -> DataFrame:
    """All TP rows and at most fp_multiple times as many FP rows, those of least key; equal keys in an arbitrary order.

    How many that are is known only when the rows are read: each FP row has its number among the FP rows, which is compared
    with the number of TP rows, one row.
    """
    tp = labelled.where(F.col(label) == "TP")
    fp = row_numbers(labelled.where(F.col(label) == "FP"), [key], "__n")
    most = tp.agg(F.floor(F.count("*") * F.lit(float(fp_multiple))).alias("__most"))
    return tp.unionByName(fp.join(F.broadcast(most), F.col("__n") <= F.col("__most")).drop("__n", "__most"))

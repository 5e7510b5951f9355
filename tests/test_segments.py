import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import scalars
from strandline.operators import combine, detect, segments

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, StartTime timestamp_ntz, SegStart double, SegDur double, site string"


def rows_to_df(spark, rows):
    """rows: (start in seconds or None, duration)"""
    data = [(i, None if s is None else T0 + dt.timedelta(microseconds=round(s * 1e6)), 0.0, float(d), "ab"[i % 2]) for i, (s, d) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def numbers(df, **options):
    return [r.DiffTime for r in sorted(segments.islands(df, ["id"], **options).collect())]


def sequential(rows, tol=1.0, cap=None):
    """The ordered loop that the operator stands for."""
    joined = []
    for i, (s, d) in enumerate(rows):
        nxt = rows[i + 1][0] if i + 1 < len(rows) else None
        joined.append(True if s is None or nxt is None else abs(round((s + d) * 1e6) - round(nxt * 1e6)) <= round(tol * 1e6))
    if cap is not None:
        total = 0.0
        for i, (_, d) in enumerate(rows):
            total = total + d if joined[i] else 0.0
            if total // cap > 0:
                joined[i], total = False, 0.0
    out, n = [], 1
    for j in joined:
        out.append(n)
        n += not j
    return out


@pytest.mark.parametrize(
    "rows,want",
    [
        ([(0, 10), (11, 5)], [1, 1]),  # exactly the tolerance
        ([(0, 10), (11.000001, 5)], [1, 2]),
        ([(0, 10), (8, 5)], [1, 2]),  # an overlap beyond the tolerance breaks too
        ([(0, 10), (9.5, 5)], [1, 1]),
        ([(0, 10), (None, 5), (100, 1)], [1, 1, 1]),  # missing bounds count as consecutive
        ([(0, 10)], [1]),
        ([], []),
    ],
)
def test_adjacency(spark, rows, want):
    assert numbers(rows_to_df(spark, rows)) == want


def test_cap_boundary(spark):
    rows = [(0, 5), (5, 5), (10, 5), (15, 5), (20, 5), (40, 5), (45, 5)]
    for cap in (5, 10, 10.0001, 15, 1000):
        assert numbers(rows_to_df(spark, rows), cap_seconds=cap) == sequential(rows, cap=cap)
    with pytest.raises(ValueError):
        segments.islands(rows_to_df(spark, rows), ["id"], cap_seconds=0)


@pytest.mark.parametrize("cap", [None, 12.0, 40.0])
def test_random_orders_over_ranges(spark, cap):
    rng = random.Random(1)
    rows, t = [], 0.0
    for _ in range(700):
        d = rng.choice([1.0, 2.5, 7.25])
        rows.append((t if rng.random() > 0.02 else None, d))
        t += d + rng.choice([0, 0, 0, 0.5, 1, 3, -2])
    assert numbers(rows_to_df(spark, rows), cap_seconds=cap) == sequential(rows, cap=cap)


def test_an_endless_cap_changes_nothing(spark):
    df = rows_to_df(spark, [(i * 3.0, 2.0 + i % 3) for i in range(60)])
    assert numbers(df) == numbers(df, cap_seconds=1e12)


def test_partitioned_numbering(spark):
    rows = [(i * 3.0, 1.0) for i in range(20)]
    df = rows_to_df(spark, rows)
    got = {r.id: r.DiffTime for r in segments.islands(df, ["id"], partition_by=["site"], cap_seconds=3).collect()}
    for site in (0, 1):
        mine = rows[site::2]
        assert [got[i] for i in range(site, 20, 2)] == sequential(mine, cap=3)


def test_a_key_of_most_rows_is_spread_over_ranges(spark):
    """Islands and runs of keys that reach over several ranges, begin and end inside them, or hold a null."""
    rng = random.Random(8)
    rows, at = [], 0
    for i in range(600):
        at += rng.choice([5, 5, 5, 5, 300])
        rows.append((i, T0 + dt.timedelta(seconds=at), 0.0, 5.0, rng.choice(["hot"] * 8 + ["a", "z", None])))
    df = spark.createDataFrame(rows, SCHEMA)
    held = segments.ranged(df, ["site", "StartTime", "id"])
    assert held.where("site = 'hot'").select("__range").distinct().count() > 1
    got = {r.id: r.DiffTime for r in segments.islands(df, ["StartTime", "id"], partition_by=["site"]).collect()}
    want = {}
    for site in ("hot", "a", "z", None):
        mine = [r for r in rows if r[4] == site]
        n = 1
        for r, after in zip(mine, [*mine[1:], None]):
            want[r[0]] = n
            if after and abs((after[1] - r[1]).total_seconds() - 5.0) > 1:
                n += 1
    assert got == want
    valued = df.withColumn("v", F.when(F.col("id") % 7 < 4, 1.0).when(F.col("id") % 7 < 6, 0.0))
    runs = sorted(((r.site or "", r.run, r.n) for r in detect.runs_above(valued, "v", 0.5, ["StartTime", "id"], ["site"]).collect()))
    want = []
    for site in ("hot", "a", "z", None):
        n, on = 0, False
        for r in (r for r in rows if r[4] == site):
            up = r[0] % 7 < 4
            if up and not on:
                n += 1
                want.append([site or "", n, 0])
            if up:
                want[-1][2] += 1
            on = up
    assert runs == sorted(map(tuple, want))


def test_input_is_not_changed(spark):
    df = rows_to_df(spark, [(0, 1)])
    assert segments.islands(df, ["id"]).columns == [*df.columns, "true_start_us", "true_end_us", "DiffTime"]


def test_row_numbers_and_union(spark):
    a = spark.range(30).withColumn("x", F.lit("a")).withColumn("Selection", F.lit(9))
    b = spark.range(5).withColumn("y", F.lit(1))
    out = combine.combine_selections([a, b], ["id"]).collect()
    assert sorted(r.Selection for r in out) == list(range(1, 36))
    assert all((r.Selection <= 30) == (r.x == "a") for r in out) and all(r.y is None for r in out if r.x == "a")
    with pytest.raises(ValueError):
        combine.union_by_name([])


def test_combine_kinds():
    assert combine.combine_kind("a.txt", True) == "selections"
    assert combine.combine_kind("x.tgz", True, "m.tar.gz") == "untar"
    assert combine.combine_kind("x.png", True, "x.png") == "copy"
    assert combine.combine_kind("FileGroupFormat.csv.gz", False) == "file_group"
    assert combine.combine_kind("other.bin", False) == "table"
    assert combine.never_combined("plot.png") and not combine.never_combined("a.tar.gz")


def test_overlap_join_over_buckets(spark):
    rng = random.Random(2)
    d = [(i, s, s + rng.randrange(0, 400)) for i in range(80) for s in [rng.randrange(5000)]]
    g = [(i, s, s + rng.randrange(0, 900)) for i in range(60) for s in [rng.randrange(5000)]]
    dd, gg = spark.createDataFrame(d, "det_id long, start_us long, end_us long"), spark.createDataFrame(g, "gt_id long, start_us long, end_us long")
    want = {(i, j): (min(e, y) - max(s, x)) / (max(e, y) - min(s, x)) for i, s, e in d for j, x, y in g if s < y and x < e and e > s and y > x}
    got = {(r.det_id, r.gt_id): r.iou for r in detect.overlaps(dd, gg).collect()}
    assert got == want
    # intervals of very unlike lengths meet few buckets each
    year = 365 * 86_400_000_000
    long_d = spark.createDataFrame([(1, 0, 40 * year), (2, 5, 700)], "det_id long, start_us long, end_us long")
    long_g = spark.createDataFrame([(7, 39 * year, 39 * year + 10), (8, -3 * year, 3 * year), (9, 699, 701), (10, 701, 702)], "gt_id long, start_us long, end_us long")
    assert sorted((r.det_id, r.gt_id) for r in detect.overlaps(long_d, long_g).collect()) == [(1, 7), (1, 8), (1, 9), (1, 10), (2, 8), (2, 9)]
    assert detect.overlaps(dd.limit(0), gg).count() == 0 and detect.overlaps(dd.limit(0), gg.limit(0)).count() == 0
    lab = detect.assign_labels(dd, gg, 0.2, write_gt=True).collect()
    assert sum(r.label != "FN" for r in lab) == 80
    hit = {r.gt_id for r in lab if r.label == "TP"}
    assert {r.gt_id for r in lab if r.label == "FN"} == {j for j, _, _ in g} - hit


def test_scalars(spark):
    df = spark.createDataFrame([("gs://bucket/a/b.nt", 93784, "x/y.tar.gz", ["a\nb", "c"])], "u string, s long, p string, v array<string>")
    r = df.select(scalars.uri_bucket("u"), scalars.uri_prefix("u"), scalars.elapsed_dhms("s"), scalars.stem_suffix("p", "_1"), scalars.stem_suffix(F.lit("noext"), "_1"), scalars.join_arguments("v"), scalars.is_injected(F.lit("[x]"))).first()
    assert list(r) == ["bucket", "a/b.nt", "1:2:3:4", "x/y_1.tar.gz", "noext_1", "ab c", True]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Europe/Berlin"])
def test_bounds_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.000001' as n, '1969-12-31 23:59:59.5' as s, timestamp'2024-03-10 02:30:00+00:00' as z")
        assert list(rows.select(scalars.epoch_micros("n"), scalars.epoch_micros("s")).first()) == [1710037800000001, -500000]
        bound = segments.segment_bounds(rows.selectExpr("z as StartTime", "0.5 as SegStart", "1.0 as SegDur")).first()
        assert (bound.true_start_us, bound.true_end_us) == (1710037800500000, 1710037801500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_annotations(spark):
    rows = [(1, "f1", 1_500_000, 2_000_001, "A", 0.5), (2, "f1", 0, 1, None, None)]
    df = spark.createDataFrame(rows, "det_id long, FileName string, start_us long, end_us long, label string, prob double")
    shown = detect.to_annotations(df, spark.createDataFrame([("f1",), ("f2",), ("f2",)], "FileName string"))
    assert shown.count() == 3 and shown.where("`Begin File` = 'f2' and Selection is null").count() == 1
    assert sorted(detect.from_annotations(shown).collect()) == rows
    few = detect.from_annotations(shown.drop("Score", "Label")).first()
    assert few.prob is None and few.label is None


def test_detection_features(spark):
    rng = random.Random(6)
    d = [(i, s, s + rng.randrange(1, 3000)) for i in range(30) for s in [rng.randrange(5000)]]
    x = [(rng.randrange(-500, 9000), rng.random()) for _ in range(400)] + [(None, 1.0), (5, None)]
    dd, xx = spark.createDataFrame(d, "det_id long, start_us long, end_us long"), spark.createDataFrame(x, "time_us long, value double")
    for norm in (False, True):
        got = {(r.det_id, r.tile): (r.n, r["mean"], r.peak) for r in detect.detection_features(dd, xx, 4, 50, norm).collect()}
        want = {}
        for i, s, e in d:
            s, e = s - 50, e + 50
            inside = [(t, v) for t, v in x if t is not None and v is not None and s <= t < e]
            m = sum(v for _, v in inside) / max(1, len(inside))
            sd = (sum((v - m) ** 2 for _, v in inside) / max(1, len(inside))) ** 0.5
            for t, v in inside:
                want.setdefault((i, min(3, (t - s) * 4 // (e - s))), []).append(((v - m) / sd if sd > 1e-12 else 0.0) if norm else v)
        assert got.keys() == want.keys()
        for k, (n, mean, peak) in got.items():
            assert n == len(want[k]) and abs(mean - sum(want[k]) / n) < 1e-6 and abs(peak - max(want[k])) < 1e-6


def test_perf_and_sampling(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(10) / 10, rng.randrange(2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, prob double, y int")
    for r in detect.perf_curve(df, "prob", "y").collect():
        assert r.tp == sum(y for _, p, y in rows if p >= r.cutoff) and r.fp == sum(1 - y for _, p, y in rows if p >= r.cutoff)
        assert r.fn == sum(y for _, p, y in rows if p < r.cutoff)
    lab = df.select("id", F.when(F.col("y") == 1, "TP").otherwise("FP").alias("label"))
    got = detect.balanced_sample(lab, 0.5, "id").collect()
    tp = sum(y for *_, y in rows)
    assert sorted(r.id for r in got if r.label == "FP") == sorted(i for i, _, y in rows if not y)[: int(tp * 0.5)]
    none = spark.createDataFrame([], "label string")
    assert detect.perf_eval(none).collect()[0].tp in (None, 0)

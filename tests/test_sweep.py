"""Interval pairs against brute force, and how evenly they are dealt out."""

import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import detect, segments, sweep


def frames(spark, a, b):
    return (spark.createDataFrame(a, "k string, a_id long, start_us long, end_us long"), spark.createDataFrame(b, "k string, b_id long, start_us long, end_us long"))


def got(a, b, keys, both=True):
    return sorted((r.a_id, r.b_id) for r in sweep.pairs(a, b, keys, both).select("a.a_id", "b.b_id").collect())


def brute(a, b, keyed, both=True):
    out = []
    for k, i, s, e in a:
        for m, j, t, f in b:
            if None in (s, e, t, f) or (keyed and (k is None or k != m)):
                continue
            if (s < f and t < e) if both else (s <= t < e):
                out.append((i, j))
    return sorted(out)


def case(seed):
    rng = random.Random(seed)

    def side(n, base):
        rows = []
        for i in range(n):
            s = rng.choice([rng.randrange(2000), rng.randrange(1000, 1010), 777])
            d = rng.choice([1, rng.randint(1, 30), rng.randint(1, 30), rng.randint(1, 600)])
            rows.append((rng.choice(["x", "x", "x", "y", "z", None]), base + i, s, s + d))
        rows += [("x", base + n, 0, 5000), ("y", base + n + 1, -100, 3000), ("x", base + n + 2, None, 5), ("x", base + n + 3, 5, None)]
        return rows + rows[:3]

    return side(150, 0), side(170, 1000)


@pytest.mark.parametrize("ranges", ["1", "4", "13"])
def test_pairs_against_brute_force(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        a, b = case(int(ranges))
        da, db = frames(spark, a, b)
        for keyed in (False, True):
            assert got(da, db, ["k"] if keyed else []) == brute(a, b, keyed)
        points = [(k, i, s, s) for k, i, s, _ in b if s is not None]
        _, dp = frames(spark, a[:1], points)
        assert got(da, dp, ["k"], both=False) == brute(a, points, True, both=False)
        assert got(da, dp, [], both=False) == brute(a, points, False, both=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_several_keys_and_wide_rows(spark):
    a = spark.range(40).selectExpr("id as a_id", "id % 2 as k", "cast(id % 3 as string) as m", "id * 10 as start_us", "id * 10 + 45 as end_us", "array(id) as extra")
    b = spark.range(40).selectExpr("id as b_id", "id % 2 as k", "cast(id % 3 as string) as m", "id * 10 + 3 as start_us", "id * 10 + 4 as end_us")
    rows = sweep.pairs(a, b, ["k", "m"]).select("a.a_id", "b.b_id", "a.extra").collect()
    want = [(i, j) for i in range(40) for j in range(40) if i % 2 == j % 2 and i % 3 == j % 3 and i * 10 < j * 10 + 4 and j * 10 + 3 < i * 10 + 45]
    assert sorted((r.a_id, r.b_id) for r in rows) == want and all(r.extra == [r.a_id] for r in rows)


def test_empty_sides(spark):
    a, b = frames(spark, case(1)[0], case(1)[1])
    assert got(a.limit(0), b, ["k"]) == [] and got(a, b.limit(0), []) == [] and got(a.limit(0), b.limit(0), []) == []


def test_a_dense_second_and_an_interval_of_years_are_dealt_out_evenly(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        year = 31_536_000_000_000
        at = F.when(F.col("id") % 3 == 0, 5 * year + F.col("id") % 1_000_000).otherwise(F.pmod(F.xxhash64("id"), F.lit(10 * year)))
        both = spark.range(40_000).select("id", at.alias("start_us")).withColumn("end_us", F.col("start_us") + 20)
        a = both.where("id % 2 = 0").withColumnRenamed("id", "a_id").unionByName(spark.createDataFrame([(-1, 0, 10 * year)], "a_id long, start_us long, end_us long"))
        b = both.where("id % 2 = 1").withColumnRenamed("id", "b_id")
        rows, places, _ = sweep.dealt(a, b, [], True, "start_us", "end_us")
        n = [r["count"] for r in rows.groupBy("__place").count().collect()]
        assert places >= 12 and max(n) <= 2 * median(n)
        assert sum(n) - 40_001 <= 3 * places  # the long interval once a range, and what is open at borders
        assert sweep.pairs(a, b).where("a.a_id = -1").count() == 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_pairs_come_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(sweep, "PAIRS", 7)
    rng = np.random.default_rng(2)
    start = np.sort(rng.integers(0, 50, 80))
    end, side, run, own = start + rng.integers(1, 30, 80), rng.integers(0, 2, 80), np.sort(rng.integers(0, 3, 80)), np.ones(80, bool)
    order = np.lexsort((side, start, run))
    start, end, side, run = start[order], end[order], side[order], run[order]
    parts = list(sweep.found(start, end, run, side, own, True))
    assert len(parts) > 3
    have = sorted((int(x), int(y)) for e, l in parts for x, y in zip(e, l, strict=True))
    assert have == sorted((i, j) for i in range(80) for j in range(80) if side[i] == 0 and side[j] == 1 and run[i] == run[j] and start[i] < end[j] and start[j] < end[i])


@pytest.mark.parametrize("seed", [3, 4])
def test_nearest_is_what_all_pairs_give(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(sweep, "ROWS", 50)

    def intervals(n, keys):
        key = rng.integers(0, keys, n)
        start = rng.integers(0, 3000, n)
        # few lengths, so that there are ties, and some that cover much
        return key, start, start + rng.choice([1, 7, 40, 41, 2500], n, p=[0.3, 0.3, 0.2, 0.19, 0.01])

    for n, m, keys in ((300, 2000, 1), (300, 2000, 9), (200, 1, 1), (1, 700, 1)):
        a, b = intervals(n, keys), intervals(m, keys)
        tie = rng.permutation(m)
        want = {}
        for i in range(n):
            iou = np.where(b[0] == a[0][i], sweep.iou_of(a[1][i], a[2][i], b[1], b[2]), 0.0)
            j = np.lexsort((tie, -iou))[0]
            if iou[j] > 0:
                want[i] = (j, iou[j])
        x, y, v = sweep.nearest(a, b, tie)
        assert {i: (j, q) for i, j, q in zip(x.tolist(), y.tolist(), v.tolist(), strict=True)} == want and len(x) == len(want)


@pytest.mark.parametrize("keys", [[], ["site"]])
def test_labels_take_the_best_of_bounded_ranges(spark, keys, monkeypatch):
    """Ranges hold so many rows whatever the session's partitions, and of a range each interval gives one row, not its pairs."""
    monkeypatch.setattr(segments, "RANGE_ROWS", 40)
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), int(s), int(s + rng.choice([5, 60, 900]))) for i, s in enumerate(rng.integers(0, 2000, 600))]
    d = spark.createDataFrame(rows[:200], "det_id long, site int, start_us long, end_us long")
    g = spark.createDataFrame(rows[200:], "gt_id long, site int, start_us long, end_us long")
    assert segments.ranged(g, ["start_us"]).select("__range").distinct().count() > 8
    near = sweep.closest(d, g, "gt_id", keys)
    assert near.count() < detect.overlaps(d, g, keys).count() / 3
    want = {}
    for r in detect.overlaps(d, g, keys).collect():
        want[r.det_id] = max(want.get(r.det_id, (0.0, 0)), (r.iou, -r.gt_id))
    got = detect.assign_labels(d, g, 1e-9, keys=keys).select("det_id", "gt_id", "iou").where("iou > 0").collect()
    assert {r.det_id: (r.iou, -r.gt_id) for r in got} == want

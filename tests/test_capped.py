"""Capped islands over ranges: the parts against the fold they stand for, and whole islands that reach over all ranges."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import detect, segments

T0 = dt.datetime(2024, 1, 1)


def fold(dur, broken, t, cap):
    """(rows cut, sum at the end)"""
    out = []
    for i, (d, b) in enumerate(zip(dur, broken, strict=True)):
        t += d
        if t >= cap:
            out.append(i)
            t = 0
        if b:
            t = 0
    return out, t


def ranges(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 40))
    dur = rng.integers(0, rng.choice([2, 5, 30]), n)
    broken = rng.random(n) < rng.choice([0, 0, 0.1, 0.5])
    dur[broken] = 0
    return dur, broken


@pytest.mark.parametrize("cap", [1, 3, 17, 60, 10_000])
def test_carry_and_cuts_of_a_range(cap):
    for seed in range(60):
        dur, broken = ranges(seed)
        d, limits, results = segments.carry_of(dur, broken, cap)
        for t in {0, 1, cap // 2, cap - 1} - {cap}:
            want_cuts, want = fold(dur, broken, t, cap)
            at = int(np.searchsorted(limits, cap - t))
            assert (int(results[at]) if at < len(limits) else t + d) == want, (seed, t)
            assert segments.cuts(dur, broken, t, cap).tolist() == want_cuts


@pytest.mark.parametrize("cap", [2, 17, 60, 400])
def test_ranges_put_together(cap):
    for seed in range(60):
        parts = [ranges(seed * 10 + k) for k in range(4)]
        one = segments.carry_of(*parts[0], cap)
        for p in parts[1:]:
            one = segments.after(one, segments.carry_of(*p, cap), cap)
        for t in {0, 1, cap // 2, cap - 1}:
            want = t
            for p in parts:
                want = fold(*p, want, cap)[1]
            d, limits, results = one
            at = int(np.searchsorted(limits, cap - t))
            assert (int(results[at]) if at < len(limits) else t + d) == want


def frame(spark, rows):
    schema = "id long, StartTime timestamp_ntz, SegStart double, SegDur double, site string"
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), 0.0, d, k) for i, (s, d, k) in enumerate(rows)], schema)


def expected(rows, cap):
    """DiffTime by a loop over whole microseconds, a key by itself."""
    out = {}
    for key in {k for _, _, k in rows}:
        mine = [(i, s, d or 0.0) for i, (s, d, k) in enumerate(rows) if k == key]
        total, number = 0, 1
        for (i, s, d), nxt in zip(mine, [*mine[1:], None], strict=True):
            out[i] = number
            joined = nxt is None or rows[i][1] is None or abs(s + d - nxt[1]) <= 1.0000001
            total = total + round(d * 1e6) if joined else 0
            if total >= round(cap * 1e6):
                joined, total = False, 0
            number += not joined
    return out


@pytest.mark.parametrize("parts,cap", [("1", 20.0), ("5", 20.0), ("16", 7.0), ("16", 400.0), ("16", 1e9)])
def test_one_island_of_all_rows(spark, parts, cap):
    rng = random.Random(4)
    rows, at = [], 0.0
    for _ in range(900):
        d = rng.choice([0.0, 1.0, 2.5, 7.25])
        rows.append((at, d, "a"))
        at += d
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = frame(spark, rows)
        held = segments.ranged(df, ["id"])
        n = [r["count"] for r in held.groupBy("__range").count().collect()]
        assert len(n) >= int(parts) * 0.8 and max(n) <= 900 / len(n) * 2.5  # spread over all tasks
        assert {r.id: r.DiffTime for r in segments.islands(df, ["id"], cap_seconds=cap).collect()} == expected(rows, cap)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("heavy", [True, False])
def test_keys_of_many_and_of_few_rows(spark, monkeypatch, heavy):
    if heavy:
        monkeypatch.setattr(segments, "KEY_ROWS", 0)
    rng = random.Random(9)
    rows, at = [], 0.0
    for _ in range(700):
        d = rng.choice([1.0, 2.5, 7.25])
        rows.append((at, d, rng.choice(["hot"] * 9 + ["b"])))
        at += rng.choice([d, d, d, d + 0.5, d + 30])
    df = frame(spark, rows)
    assert {r.id: r.DiffTime for r in segments.islands(df, ["id"], partition_by=["site"]).collect()} == expected(rows, 1e9)
    assert {r.id: r.DiffTime for r in segments.islands(df, ["id"], partition_by=["site"], cap_seconds=12.0).collect()} == expected(rows, 12.0)
    runs = sorted((r.site, r.run, r.n) for r in detect.runs_above(df, "SegDur", 2.0, ["id"], ["site"]).collect())
    want = []
    for key in ("b", "hot"):
        n, on = 0, False
        for _, d, k in rows:
            if k == key:
                if d >= 2.0 and not on:
                    n += 1
                    want.append([key, n, 0])
                if d >= 2.0:
                    want[-1][2] += 1
                on = d >= 2.0
    assert runs == sorted(map(tuple, want))


def test_missing_and_negative_durations_and_the_edge_of_the_cap(spark):
    rows = [(0.0, 0.1, "a")] + [(0.1 * i, 0.1, "a") for i in range(1, 30)]
    got = [r.DiffTime for r in segments.islands(frame(spark, rows), ["id"], cap_seconds=1.0).orderBy("id").collect()]
    assert got == [1 + i // 10 for i in range(30)]  # ten times 0.1 s are one second here
    rows = [(0.0, 5.0, "a"), (5.0, None, "a"), (5.0, -1.0, "a"), (4.0, 5.0, "a"), (9.0, 1.0, "a")]
    got = [r.DiffTime for r in segments.islands(frame(spark, rows), ["id"], cap_seconds=10.0).orderBy("id").collect()]
    assert got == [1, 1, 1, 1, 2]
    assert segments.islands(frame(spark, [(0.0, 1.0, "a")]).where(F.lit(False)), ["id"], cap_seconds=1.0).count() == 0

"""Overlapping windows and two thresholds against loops."""

import random

import pytest

from strandline.operators import detect, segments


def case(seed):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(-500, 4000), rng.choice([None, 0.0, 5.0, 5.0, 9.0])) for _ in range(260)] + [("a", None, 1.0)]


def loop(rows, length, step, low, high):
    held = {}
    for k, t, v in rows:
        if t is None or v is None:
            continue
        b = t // step * step
        while b + length > t:
            held.setdefault((k, b), []).append(v)
            b -= step
    out = []
    for key in {k for k, _ in held}:
        runs = []
        for b in sorted(b for k, b in held if k == key):
            mean = sum(held[key, b]) / len(held[key, b])
            if mean >= low:
                if not runs or b - runs[-1][-1][0] != step:
                    runs.append([])
                runs[-1].append((b, mean))
        n = 0
        for r in runs:
            if max(m for _, m in r) >= high:
                n += 1
                out.append((key, n, r[0][0], r[-1][0] + length, len(r), round(max(m for _, m in r), 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,step,heavy", [(100, 100, False), (100, 30, True), (250, 50, False), (40, 100, True)])
def test_windows_and_thresholds(spark, monkeypatch, length, step, heavy):
    if heavy:
        monkeypatch.setattr(segments, "KEY_ROWS", 0)
    rows = case(length + step)
    df = spark.createDataFrame(rows, "k string, time_us long, value double")
    scores = detect.window_scores(df, length, step, ["k"])
    got = [(r.k, r.event, r.start_us, r.end_us, r.windows, round(r.peak, 9)) for r in detect.detect_events(scores, length, step, 4.0, 6.0, ["k"]).collect()]
    assert sorted(got, key=repr) == loop(rows, length, step, 4.0, 6.0)


def test_without_keys_and_odd_settings(spark):
    rows = [("x", t, v) for _, t, v in case(3)]
    df = spark.createDataFrame(rows, "k string, time_us long, value double").drop("k")
    got = sorted((r.event, r.start_us, r.end_us) for r in detect.detect_events(detect.window_scores(df, 100, 20), 100, 20, 3.0, 7.0).collect())
    assert got == sorted(x[1:4] for x in loop(rows, 100, 20, 3.0, 7.0))
    with pytest.raises(ValueError):
        detect.detect_events(detect.window_scores(df, 100, 20), 100, 20, 7.0, 3.0)
    with pytest.raises(ValueError):
        detect.window_scores(df, 0, 20)
    assert detect.window_scores(df.limit(0), 10, 5).count() == 0

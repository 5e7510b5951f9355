import hashlib
import math
import random

import numpy as np

from strandline.llm import lloyd


def brute(rows, k, rounds, seed, dims, scale):
    """Rows (id, floats) by Python integers alone."""
    kept = [(i, [max(-lloyd.LARGEST, min(lloyd.LARGEST, math.floor(scale * x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    raw = lambda v: np.array(v, "<i4").tobytes()
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), raw(v), v) for i, v in kept)[:k]
    cents = [v for _, _, v in first]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        at = assigned()
        for n in range(len(cents)):
            mine = [v for (_, v), (_, m) in zip(kept, at, strict=True) if m == n]
            if mine:
                cents[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    at = assigned()
    out = []
    for (i, _), (d, n) in zip(kept, at, strict=True):
        within = sum(x for x, m in at if m == n)
        digest = hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()
        out.append((i, n, d, min(lloyd.LONG, within), min(lloyd.LONG, sum(x for x, _ in at)), sum(m == n for _, m in at), digest))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string")
    return sorted((tuple(r) for r in lloyd.cluster_vectors(df, **kw).collect()), key=repr)


def test_against_brute_force_with_ties_repeats_and_bad_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.25, 2.0]) for _ in range(3)]) for i in range(120)]
    rows += rows[:7] + [(500 + i, rows[3][1]) for i in range(60)]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [float("nan")] * 3), (905, [float("inf"), 0.0, 0.0]), (906, [1.0] * 4), (None, [3.0, 3.0, 3.0])]
    for rounds in (0, 1, 6):
        assert run(spark, rows, k=5, rounds=rounds, dims=3, scale=8) == brute(rows, 5, rounds, lloyd.SEED, 3, 8)


def test_values_out_of_range_and_negative_floors(spark):
    rows = [(i, [x, -x]) for i, x in enumerate((0.0, 0.3, -0.7, 1e30, -1e30, 3e38, 131072.0, 1.0))]
    assert run(spark, rows, k=3, rounds=4, dims=2, scale=1024) == brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 3, 4, lloyd.SEED, 2, 1024)


def test_fewer_vectors_than_centroids_equal_ones_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])]
    got = run(spark, rows, k=8, rounds=3, dims=2)
    assert got == brute(rows, 8, 3, lloyd.SEED, 2, lloyd.SCALE)
    assert len({c for i, c, *_ in got if i in (1, 2)}) == 1
    assert run(spark, [(1, None)], dims=2) == [] and run(spark, rows, k=8, dims=5) == []


def test_a_tie_goes_to_the_lower_number():
    at, dist = lloyd.nearest(np.array([[0, 0]]), np.array([[2, 0], [0, 2], [-2, 0]]))
    assert at.tolist() == [0] and dist.tolist() == [4]

"""Segments that arrive as files in any order give the islands of the batch operator."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import segments
from strandline.streaming import islands
from strandline.streaming.segments import incoming

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "site string, id long, StartTime timestamp_ntz, SegStart double, SegDur double"


def rows(seed):
    rng = random.Random(seed)
    out, at = [], 0.0
    for i in range(400):
        d = rng.choice([1.0, 2.0, 30.0])
        out.append((rng.choice(["a", "a", "a", "b"]), i, T0 + dt.timedelta(seconds=at), 0.0, d))
        at += rng.choice([d, d, d, d + 0.5, d + 20, d - 3, 0])
    return out


def batch(spark, data, tolerance):
    df = segments.islands(spark.createDataFrame(data, SCHEMA), ["StartTime", "id"], tolerance, ["site"])
    got = df.groupBy("site", "DiffTime").agg(F.count("*").alias("n"), F.min("true_start_us").alias("s"), F.max("true_end_us").alias("e"), F.sum(F.col("true_end_us") - F.col("true_start_us")).alias("t"))
    return sorted(tuple(r) for r in got.collect())


def write(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("site,id,StartTime,SegStart,SegDur\n" + "".join(f"{k},{i},{t.isoformat()},{a},{d}\n" for k, i, t, a, d in data))


@pytest.mark.parametrize("seed", [1])
def test_any_order_of_arrival_ends_as_the_batch(spark, tmp_path, seed):
    data = rows(seed)
    tolerance = 1_000_000
    mixed = data[:]
    random.Random(seed + 10).shuffle(mixed)
    place = lambda x: f"file://{tmp_path}/{x}"
    for k in range(4):
        write(tmp_path / "in", f"{k}.csv", mixed[k * 70 : (k + 1) * 70])

    def run(per):
        q = islands.island_stream(incoming(spark, place("in"), SCHEMA, per), ["site"], "id", place("runs"), place("state"), tolerance, bucket_us=120_000_000)
        q.awaitTermination()
        found = islands.current_islands(spark.read.parquet(place("runs")), ["site"], tolerance)
        return sorted((r.site, r.DiffTime, r.segments, r.start_us, r.end_us, r.total_us) for r in found.collect())

    assert run(1) == batch(spark, mixed[:280], tolerance)
    # the rest comes later: gaps close and islands break, and the stream goes on from its state
    write(tmp_path / "in", "late.csv", mixed[280:])
    assert run(5) == batch(spark, data, tolerance)


def test_a_late_segment_joins_two_islands_and_another_breaks_one(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    place = lambda x: f"file://{tmp_path}/{x}"

    def after(name, data):
        write(tmp_path / "in", name, data)
        islands.island_stream(incoming(spark, place("in"), SCHEMA), ["site"], "id", place("runs"), place("state"), bucket_us=1_000_000_000).awaitTermination()
        got = islands.current_islands(spark.read.parquet(place("runs")), ["site"]).collect()
        return sorted((r.DiffTime, r.segments) for r in got)

    assert after("a.csv", [("x", 1, at(0), 0.0, 10.0), ("x", 2, at(20), 0.0, 10.0)]) == [(1, 1), (2, 1)]
    assert after("b.csv", [("x", 3, at(10), 0.0, 10.0)]) == [(1, 3)]
    assert after("c.csv", [("x", 4, at(15), 0.0, 1.0)]) == [(1, 2), (2, 1), (3, 1)]
    # over the border of a bucket
    assert after("d.csv", [("x", 5, at(30), 0.0, 970.0), ("x", 6, at(1000), 0.0, 5.0)]) == [(1, 2), (2, 1), (3, 3)]


def test_many_keys_share_few_states(spark, tmp_path):
    """States are groups of a bucket, not its keys; keys of any type come back, and only those that a batch changed."""
    data = [(f"s{i % 200}", i, T0 + dt.timedelta(seconds=(i * 7919) % 1000 * 10), 0.0, 10.0) for i in range(600)]
    place = lambda x: f"file://{tmp_path}/{x}"

    def run():
        stream = incoming(spark, place("in"), SCHEMA).withColumn("part", (F.col("id") % 3).cast("decimal(5,1)"))
        q = islands.island_stream(stream, ["site", "part"], "id", place("runs"), place("state"), bucket_us=2_000_000_000, groups=3)
        q.awaitTermination()
        return q.recentProgress[-1].stateOperators[0].numRowsTotal

    write(tmp_path / "in", "a.csv", data[:500])
    assert run() <= 18  # six buckets
    write(tmp_path / "in", "b.csv", [*data[500:], ("late", 600, T0, 0.0, 10.0)])
    assert run() <= 18  # six buckets
    runs = spark.read.parquet(place("runs"))
    assert runs.where("site = 'late'").count() == 1
    df = spark.createDataFrame([*data, ("late", 600, T0, 0.0, 10.0)], SCHEMA).withColumn("part", (F.col("id") % 3).cast("decimal(5,1)"))
    want = segments.islands(df, ["StartTime", "id"], 1_000_000, ["site", "part"]).groupBy("site", "part", "DiffTime").agg(F.count("*"), F.min("true_start_us"), F.max("true_end_us"))
    got = islands.current_islands(runs, ["site", "part"]).select("site", "part", "DiffTime", "segments", "start_us", "end_us")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_states_do_not_grow_with_the_table():
    day = islands.BUCKET_US
    assert islands.groups_for(0, 0) == islands.groups_for(islands.HELD, 30 * day) == 1
    assert islands.groups_for(6_000_000, 29 * day) == 24
    assert islands.groups_for(36_000_000, 29 * day) == 146

"""Islands of segments that arrive in any order, kept up as they arrive.

Segments go by key and stretch of time (a bucket): a key of most rows is spread over its buckets, and the keys of a bucket are dealt by hash to a
number of groups, so that a state is a few thousand segments whether keys are many and small or few and large.  A state holds its segments in
order.  A segment that comes in joins an island, extends it, closes the gap between two, or breaks one that it comes to stand in: whatever it
does is seen from its neighbours in the order.  Each batch gives the runs of the keys' buckets that it changed, with a version; the latest version of
each, put together over the borders of buckets, is what the batch operator makes of all segments.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from strandline.operators.segments import TOLERANCE_US, adjacent, segment_bounds

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKET_US = 86_400_000_000
#: States of a bucket where the caller does not know how many segments come.
GROUPS = 16
#: Segments of a state that groups_for() aims at.
HELD = 1 << 13
#: Rows that a task packs at once.
PACK = 1 << 17
#: A bucket's runs: each one's number in it, first and last segment's bounds, number of segments and summed duration.
RUNS = "bucket long, version long, run int, first_start_us long, first_end_us long, start_us long, end_us long, last_end_us long, segments long, total_us long"


def runs_of(key: np.ndarray, start: np.ndarray, end: np.ndarray, tolerance_us: int) -> tuple[np.ndarray, pd.DataFrame]:
    """(first segment's place, runs) of consecutive segments of equal keys (numbers), which are in order; a key's runs are numbered from 0."""
    same = key[:-1] == key[1:]
    joined = same & (np.abs(end[:-1] - start[1:]) <= tolerance_us)
    at = np.flatnonzero(np.append(True, ~joined))
    stop = np.append(at[1:], len(start))
    new = np.flatnonzero(np.append(True, ~same))
    before = np.searchsorted(at, new)[np.searchsorted(new, at, "right") - 1]
    return at, pd.DataFrame(
        {
            "run": (np.arange(len(at)) - before).astype(np.int32), "first_start_us": start[at], "first_end_us": end[at], "start_us": start[at], "end_us": np.maximum.reduceat(end, at),
            "last_end_us": end[stop - 1], "segments": stop - at, "total_us": np.add.reduceat(end - start, at),
        }
    )


def names_of(keys: Sequence[str]) -> list[str]:
    return [*(f"k{i}" for i in range(len(keys))), "start", "end", "tie"]


def packed(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as out:
        out.write_table(t)
    return sink.getvalue().to_pybytes()


def unpacked(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def pack(held: list[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """(group, bucket, rows): the rows of a group and bucket as one, since Spark hands a state its rows one by one."""
    t = pa.Table.from_batches(held)
    group, bucket = (np.asarray(t.column(i)) for i in (0, 1))
    by = np.lexsort((bucket, group))
    t, group, bucket = t.take(pa.array(by)).combine_chunks(), group[by], bucket[by]
    at = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (bucket[1:] != bucket[:-1])))
    body = t.select(range(2, t.num_columns)).rename_columns(names)
    rows = [packed(body.slice(a, n)) for a, n in zip(at.tolist(), np.diff(np.append(at, len(t))).tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(group[at]), pa.array(bucket[at]), pa.array(rows, pa.binary())], names=["__group", "bucket", "rows"])


class Runs(StatefulProcessor):
    """The segments of a bucket's group as an Arrow table in one value: keys, bounds, and their order among equal starts."""

    def __init__(self, keys: Sequence[str], tolerance_us: int) -> None:
        self.keys, self.tolerance_us = list(keys), tolerance_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("segments", "rows binary, version long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803, ARG002
        names = names_of(self.keys)
        parts = [unpacked(x) for p in rows for x in p.iloc[:, -1]]
        came = sum(map(len, parts))
        version = 1
        if self.held.exists():
            old = self.held.get()
            parts.append(unpacked(old[0]))
            version = old[1] + 1
        t = pa.concat_tables(parts).combine_chunks()
        number = np.zeros(len(t), np.int64)
        for k in names[:-3]:
            code = np.asarray(t.column(k).combine_chunks().dictionary_encode().indices).astype(np.int64)
            _, number = np.unique(number * (code.max() + 1) + code, return_inverse=True)
        changed = np.zeros(number.max() + 1, bool)
        changed[number[:came]] = True
        start, end, tie = (np.asarray(t.column(c)) for c in names[-3:])
        by = np.lexsort((end, tie, start, number))
        t, number = t.take(pa.array(by)), number[by]
        self.held.update((packed(t), version))
        on = np.flatnonzero(changed[number])
        at, found = runs_of(number[on], start[by][on], end[by][on], self.tolerance_us)
        first = t.select(names[:-3]).take(pa.array(on[at])).to_pandas()
        for k, name in zip(names, self.keys, strict=False):
            found[name] = first[k]
        found["bucket"], found["version"] = key[1], version
        yield found[[*self.keys, *(x.split(" ")[0] for x in RUNS.split(", "))]]

    def close(self) -> None:
        pass


def groups_for(segments: int, span_us: int, bucket_us: int = BUCKET_US) -> int:
    """Groups of a bucket for so many segments over a span of time: states neither grow with the table nor become as many as its keys."""
    return max(1, segments // (HELD * (span_us // bucket_us + 1)))


def island_stream(stream: DataFrame, keys: Sequence[str], tie: str, target: str, checkpoint: str, tolerance_us: int = TOLERANCE_US, bucket_us: int = BUCKET_US, groups: int = GROUPS) -> StreamingQuery:
    """Keeps the runs of a stream of segments (keys, StartTime, SegStart, SegDur, tie) in the Parquet table `target`; ends once everything that
    is there has been taken, and goes on from there when it is started again.  tie: a whole number that orders segments of equal
    start.  Segments without a start or a duration have no place in an order of time and are left out; keys must not be null.
    groups: to how many states the keys of a bucket are dealt; it cannot change on the way.
    """
    spark = stream.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = segment_bounds(stream).where("true_start_us is not null and true_end_us is not null")
    group = (F.pmod(F.xxhash64(*keys), F.lit(groups)) if keys else F.lit(0)).cast("long").alias("__group")
    rows = rows.select(group, F.floor(F.col("true_start_us") / bucket_us).alias("bucket"), *keys, "true_start_us", "true_end_us", F.col(tie).cast("long").alias("__tie"))
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), RUNS])

    def packs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, n = names_of(keys), [], 0
        for rb in it:
            if rb.num_rows:
                held.append(rb)
                n += rb.num_rows
            if n >= PACK:
                yield from pack(held, names)
                held, n = [], 0
        if held:
            yield from pack(held, names)

    rows = rows.mapInArrow(packs, "__group long, bucket long, rows binary")
    runs = rows.groupBy("__group", "bucket").transformWithStateInPandas(Runs(keys, tolerance_us), schema, "Append", "None")
    return runs.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def current_islands(runs: DataFrame, keys: Sequence[str], tolerance_us: int = TOLERANCE_US, name: str = "DiffTime") -> DataFrame:
    """(keys, number, segments, start_us, end_us, total_us) of the islands that the latest versions of all buckets make together.

    Only runs are read, not segments.  The last run of a bucket and the first of the key's next one are one island if their
    neighbouring segments are consecutive.
    """
    newest = runs.groupBy(*keys, "bucket").agg(F.max("version").alias("version"))
    now = runs.join(newest, [*keys, "bucket", "version"])
    w = Window.partitionBy(*keys).orderBy("bucket", "run")
    joined = adjacent(F.lag("last_end_us").over(w), F.col("first_start_us"), tolerance_us) & F.lag("run").over(w).isNotNull()
    number = F.sum((~F.col("__joined")).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = now.withColumn("__joined", joined).withColumn(name, number)
    return marked.groupBy(*keys, name).agg(F.sum("segments").alias("segments"), F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("total_us").alias("total_us"))

"""Ordered segment operators: bounds, adjacency, gap-and-island numbering with an optional duration cap.

The order is global (partition columns, if any, come first in it).  It is never computed in one task: rows are dealt out
by ranges of the order and written once, each range is numbered by itself, and what a range needs of its neighbours
(the next range's first start, how many islands came before) is a row per range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.scalars import epoch_micros, micros
from strandline.functions.shared import discard, written

TOLERANCE_US = 1_000_000
#: Rows up to which a key's rows are ordered in one task.
KEY_ROWS = 1 << 20
#: Rows of a range on average, at most.
RANGE_ROWS = 1 << 18
#: Durations count up to this many microseconds (557 years) against a cap.
LONGEST_US = 1 << 44


def segment_bounds(df: DataFrame, start: str = "StartTime", seg_start: str = "SegStart", seg_dur: str = "SegDur") -> DataFrame:
    """df with true_start_us and true_end_us: start plus offset, and that plus duration, in whole microseconds."""
    # a timestamp with zone is a moment already
    moment = F.unix_micros(start) if dict(df.dtypes)[start] == "timestamp" else epoch_micros(start)
    first = moment + micros(seg_start)
    return df.withColumn("true_start_us", first).withColumn("true_end_us", first + micros(seg_dur))


def adjacent(end: Column, next_start: Column, tolerance_us: int = TOLERANCE_US) -> Column:
    """Consecutive unless the absolute gap exceeds the tolerance; a missing bound counts as consecutive."""
    return F.coalesce(F.abs(end - next_start) <= tolerance_us, F.lit(True))


def ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df written in ranges of the order, with __range and __row (the place within the range)."""
    # a range is held by one task, so it does not grow with the table
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    # the upper bits are the partition, the lower 33 the row in it
    return written(dealt.withColumn("__range", F.shiftright("__at", 33)).withColumn("__row", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at"), "ranges")


def by_range(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Joins one driver-made row per range (as many as shuffle partitions, or one for RANGE_ROWS rows)."""
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, schema)), "__range", "left")


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "Selection") -> DataFrame:
    """df with a 1-based number in the order over all rows; equal keys are numbered in an arbitrary order."""
    held = ranged(df, order)
    before, rows = 0, []
    for r in sorted(held.groupBy("__range").agg(F.count("*").alias("n")).collect()):
        rows.append((r["__range"], before))
        before += r["n"]
    out = by_range(held, rows or [(0, 0)], "__range long, __before long")
    return out.withColumn(name, F.col("__before") + F.col("__row") + 1).drop("__before", "__range", "__row")


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("k"))


def neighbour(held: DataFrame, value: Column, keys: Sequence[str], name: str, forward: bool = True) -> DataFrame:
    """Adds the value of the next (or previous) row in the order, null where that has other keys or does not exist.

    held: see ranged(), ordered by the keys first; so a key of many rows is spread over ranges.  What a range needs of its
    neighbours is one row per range.
    """
    item = F.struct(value.alias("v"), _key(keys).alias("k"))
    step, pick = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    edges = held.groupBy("__range").agg(pick(item, "__row").alias("__edge")).select("__range", step("__edge").over(Window.orderBy("__range")).alias("__edge"))
    inside = step(item).over(Window.partitionBy("__range").orderBy("__row"))
    out = held.join(F.broadcast(edges), "__range", "left").withColumn("__edge", F.coalesce(inside, "__edge"))
    return out.withColumn(name, F.when(F.col("__edge.k").eqNullSafe(_key(keys)), F.col("__edge.v"))).drop("__edge")


def running(held: DataFrame, value: Column, keys: Sequence[str], name: str, inclusive: bool) -> DataFrame:
    """Adds the sum of a whole-number value over the rows before each row of its keys (inclusive: and its own).

    Sums run over each range, on from what the ranges before it add up to; the sum at a key's first row is taken off.
    Per range one row comes to the driver for either.
    """
    w = Window.partitionBy("__range").orderBy("__row")
    before, rows = 0, []
    for r in sorted(held.groupBy("__range").agg(F.sum(value).alias("n")).collect()):
        rows.append((r["__range"], before))
        before += r["n"] or 0
    out = by_range(held, rows or [(0, 0)], "__range long, __before long")
    up_to = F.col("__before") + F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = out.withColumn("__up_to", up_to)
    if keys:
        out = neighbour(out, F.lit(True), keys, "__same", forward=False)
        begin = F.last(F.when(F.col("__same").isNull(), F.col("__up_to")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        out = out.withColumn("__begin", begin)
        carried, rows = None, []
        for r in sorted(out.groupBy("__range").agg(F.max_by("__begin", "__row").alias("b")).collect()):
            rows.append((r["__range"], carried))
            carried = r["b"] if r["b"] is not None else carried
        out = by_range(out, rows or [(0, 0)], "__range long, __carried long")
        out = out.withColumn("__up_to", F.col("__up_to") - F.coalesce("__begin", "__carried")).drop("__same", "__begin", "__carried")
    return out.withColumn(name, F.col("__up_to") + (value if inclusive else F.lit(0))).drop("__up_to", "__before")


def _flagged(held: DataFrame, tolerance_us: int, keys: Sequence[str]) -> DataFrame:
    """Adds __joined: whether a row is consecutive with the next one of its keys, or of the whole order without keys."""
    out = neighbour(held, F.col("true_start_us"), keys, "__next")
    return out.withColumn("__joined", adjacent(F.col("true_end_us"), F.col("__next"), tolerance_us)).drop("__next")


def _numbered(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Islands from __joined: 1 plus the number of breaks before the row."""
    # the last row of a key is joined to nothing, which is no break either
    return running(df, (~F.col("__joined")).cast("long"), keys, name, inclusive=False).withColumn(name, F.col(name) + 1)


def orbit_ends(total: np.ndarray, cap: int) -> np.ndarray:
    """For each place 0..n of a range without breaks: what has run up at its end, if the sum starts anew there.

    total: running sums of durations.  A place's successor is the one after the row at which the sum from it reaches the cap; pointers are doubled until
    each leads to the last start in the range.
    """
    n = len(total)
    before = np.append(0, total)
    last = np.searchsorted(total, before + cap) + 1  # n + 1: the cap is not reached any more
    jump = np.where(last <= n, last, np.arange(n + 1))
    while True:
        again = jump[jump]
        if (again == jump).all():
            return before[-1] - before[jump]
        jump = again


def carry_of(dur: np.ndarray, broken: np.ndarray, cap: int) -> tuple[int, np.ndarray, np.ndarray]:
    """What a range makes of the sum t that comes in, as (sum of durations, limits, results): the first limit that is at least cap - t
    gives what goes out; if none is, t plus the range's sum does.  Only the last stretch counts where an island ends inside."""
    ends = np.flatnonzero(broken)
    if len(ends):
        tail = np.cumsum(dur[ends[-1] + 1 :])
        return 0, np.array([cap]), orbit_ends(tail, cap)[:1]
    total = np.cumsum(dur)
    k = min(int(np.searchsorted(total, cap)) + 1, len(total))
    return (int(total[-1]), *_folded(total[:k], orbit_ends(total, cap)[1 : k + 1]))


def _folded(limits: np.ndarray, results: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring limits with one result as one."""
    on = np.append(results[1:] != results[:-1], True)
    return limits[on], results[on]


def after(first: tuple, then: tuple, cap: int) -> tuple[int, np.ndarray, np.ndarray]:
    """One carry_of() for two ranges in a row."""
    d, limits, results = first
    d2, limits2, results2 = then
    at = np.searchsorted(limits2, cap - results)
    through = np.where(at < len(limits2), results2[np.minimum(at, len(limits2) - 1)], results + d2)
    if limits[-1] < cap:
        limits, through = np.append(limits, limits2 + d), np.append(through, results2)
        k = min(int(np.searchsorted(limits, cap)) + 1, len(limits))
        limits, through = limits[:k], through[:k]
    return (d + d2, *_folded(limits, through))


def cuts(dur: np.ndarray, broken: np.ndarray, t: int, cap: int) -> np.ndarray:
    """Rows of a range at which the cap is reached, if the sum t comes in."""
    total = np.cumsum(dur)
    start = np.append(0, np.flatnonzero(broken) + 1)
    stop = np.append(start[1:], len(dur))
    base = np.append(0, total)[start]
    base[0] -= t
    long = np.flatnonzero((stop > start) & (np.append(0, total)[stop] - base >= cap))
    out = []
    for b, e in zip(base[long].tolist(), stop[long].tolist(), strict=True):
        at = int(np.searchsorted(total, b + cap))
        while at < e:
            out.append(at)
            at = int(np.searchsorted(total, int(total[at]) + cap))
    return np.array(out, dtype=np.int64)


def _range_arrays(it: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of one range, in order."""
    held = [rb for rb in it if rb.num_rows]
    if not held:
        return None
    t = pa.Table.from_batches(held)
    return t.take(pa.array(np.argsort(np.asarray(t.column("__row")), kind="stable")))


def _capped(flagged: DataFrame, cap_seconds: float, keys: Sequence[str]) -> DataFrame:
    """(__range, __row, keys, __joined): __joined with islands cut where the running sum of SegDur reaches the cap.

    The sum starts at 0 in each island.  What a range does to the sum that comes in is a step function, which each task works out for its
    range alone; where an island ends inside, it is one number.  Ranges inside one island are put together in doubling
    distances, so an island of all rows takes as many rounds as its number of ranges has digits in base two.  Then every range knows what comes in and is cut
    by itself.  Sums are whole microseconds, so no result depends on where ranges begin.
    """
    spark = flagged.sparkSession
    cap = max(1, round(cap_seconds * 1e6))
    dur = F.least(F.greatest(F.coalesce(micros("SegDur"), F.lit(0)), F.lit(0)), F.lit(min(cap, LONGEST_US)))
    ends = neighbour(flagged, F.lit(True), keys, "__same").withColumn("__ends", F.col("__same").isNull()) if keys else flagged.withColumn("__ends", F.lit(False))
    narrow = written(ends.select("__range", "__row", *keys, F.when(F.col("__joined"), dur).otherwise(F.lit(0)).cast("long").alias("__dur"), "__joined", "__ends"), "flags")
    there = sorted(r[0] for r in narrow.select("__range").distinct().collect())
    n = max(1, len(there))
    place = by_range(narrow, [(r, i) for i, r in enumerate(there)] or [(0, 0)], "__range long, __place int")

    def broken(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray(t.column("__dur")), ~np.asarray(t.column("__joined")) | np.asarray(t.column("__ends"))

    def sum_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _range_arrays(it)
        if t is not None:
            d, limits, results = carry_of(*broken(t), cap)
            p = t.column("__place")[0].as_py()
            if p == 0:  # nothing comes in
                at = int(np.searchsorted(limits, cap))
                d, limits, results = 0, np.array([cap]), np.array([results[at] if at < len(results) else d])
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([d], pa.int64()), pa.array([limits.tolist()], pa.list_(pa.int64())), pa.array([results.tolist()], pa.list_(pa.int64()))], names=["p", "d", "limits", "results"])

    schema = "p int, d long, limits array<long>, results array<long>"
    carries = written(place.repartitionById(n, F.col("__place")).mapInArrow(sum_up, schema), "carries")

    def join(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            rows = []
            for r in rb.to_pylist():
                one, two = ((r[f"{c}d"], np.array(r[f"{c}limits"]), np.array(r[f"{c}results"])) if r[f"{c}d"] is not None else None for c in ("f", ""))
                d, limits, results = after(one, two, cap) if one else two
                rows.append((r["p"], d, limits.tolist(), results.tolist()))
            yield pa.RecordBatch.from_pylist([dict(zip(("p", "d", "limits", "results"), x, strict=True)) for x in rows], schema=pa.schema([("p", pa.int32()), ("d", pa.int64()), ("limits", pa.list_(pa.int64())), ("results", pa.list_(pa.int64()))]))

    step = 1
    while step < n and carries.where(F.col("limits")[0] < cap).limit(1).count():
        before = carries.select((F.col("p") + step).alias("p"), *[F.col(c).alias(f"f{c}") for c in ("d", "limits", "results")])
        new = written(carries.join(before, "p", "left").mapInArrow(join, schema), "carries")
        discard(carries)
        carries, step = new, 2 * step
    out_of = {r.p: r.x for r in carries.select("p", F.col("results")[0].alias("x")).collect()}
    discard(carries)
    come_in = [out_of[i - 1] if i else 0 for i in range(n)] if there else [0]
    narrow_in = by_range(narrow, [(r, i, t) for i, (r, t) in enumerate(zip(there, come_in, strict=False))] or [(0, 0, 0)], "__range long, __place int, __in long")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _range_arrays(it)
        if t is not None:
            joined = np.asarray(t.column("__joined")).copy()
            joined[cuts(*broken(t), t.column("__in")[0].as_py(), cap)] = False
            t = t.select(["__range", "__row", *keys]).append_column("__joined", pa.array(joined))
            yield from t.to_batches(max_chunksize=1 << 16)

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    out = written(narrow_in.repartitionById(n, F.col("__place")).mapInArrow(cut, ", ".join(f"`{c}` {kinds[c]}" for c in ("__range", "__row", *keys, "__joined"))), "capped")
    discard(narrow)
    return out


def light(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no key has so many rows that one task should not order them; one count."""
    return (df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) <= KEY_ROWS


def islands(df: DataFrame, order: Sequence[str], tolerance_us: int = TOLERANCE_US, partition_by: Sequence[str] = (), cap_seconds: float | None = None, name: str = "DiffTime") -> DataFrame:
    """df (with StartTime, SegStart, SegDur) with true bounds and the number, from 1, of each row's island.

    A row belongs with the next one unless the gap between its end and the next start, in absolute value,
    exceeds the tolerance (so a large overlap breaks too, exactly the tolerance does not, and a missing bound does
    not).  With a cap, an island also ends at the row where its running duration reaches the cap; the sum then
    starts anew, and a row that is not joined to the next one is not counted.  The cap and durations count in whole microseconds (a sum of doubles may
    fall just short of the cap or on it as its rounding has it); missing and negative durations count as 0.  partition_by numbers each key by itself; the default
    is one global order.  order must be unique for results to be reproducible.  An empty table stays empty.
    """
    if cap_seconds is not None and cap_seconds <= 0:
        raise ValueError("cap_seconds must be positive")
    bounds = segment_bounds(df)
    if cap_seconds is None and partition_by and light(df, partition_by):
        w = Window.partitionBy(*partition_by).orderBy(*order)
        out = bounds.withColumn("__joined", adjacent(F.col("true_end_us"), F.lead("true_start_us").over(w), tolerance_us))
        breaks = F.sum((~F.col("__joined")).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return out.withColumn(name, F.coalesce(breaks, F.lit(0)) + 1).drop("__joined")
    held = ranged(bounds, [*partition_by, *order])
    out = _flagged(held, tolerance_us, partition_by)
    if cap_seconds is None:
        return _numbered(out, partition_by, name).drop("__range", "__row", "__joined")
    numbers = _numbered(_capped(out, cap_seconds, partition_by), partition_by, name).select("__range", "__row", name)
    return held.join(numbers, ["__range", "__row"]).drop("__range", "__row")


def island_rollup(numbered: DataFrame, keys: Sequence[str] = (), name: str = "DiffTime") -> DataFrame:
    """Rows, first start, last end and summed duration (s) of each island."""
    return numbered.groupBy(*keys, name).agg(F.count("*").alias("segments"), F.min("true_start_us").alias("start_us"), F.max("true_end_us").alias("end_us"), F.round(F.sum("SegDur"), 4).alias("total_dur"))

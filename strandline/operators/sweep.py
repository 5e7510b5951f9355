"""Pairs of intervals that overlap, by a sweep over ranges of time.

Both sides are sorted together by keys and start and cut into ranges of about as many rows each, whatever the times are: a dense second
is spread over several ranges, an empty year is part of one.  An interval belongs to the range in which it starts; only one that is still open where a
later range of its key begins is copied there, and only if something of the other side starts in that range.  A pair is found in the range
where its later interval starts, so none comes twice.  Within a range the partners of an interval that start after it and
before its end stand side by side in the order of starts: two places found by search give them all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators.segments import ranged

#: Pairs that a task gives out at once.
PAIRS = 1 << 18
#: nearest(): rows at once, neighbours looked at first on either side, rows of a box, boxes of a box, starts that are ordered by their ends.
ROWS, NEAR, LEAF, FAN, BLOCK = 1 << 11, 16, 16, 8, 256


def found(start: np.ndarray, end: np.ndarray, run: np.ndarray, side: np.ndarray, own: np.ndarray, both: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of side 0, row of side 1) of one range, about PAIRS at a time.

    Rows are in order, copies from earlier ranges first; run: number of the row's key, ascending.  Without `both` side 0
    must start first (or at the same time).
    """
    for first in (0, 1) if both else (0,):
        early = np.flatnonzero(side == first)
        late = np.flatnonzero((side != first) & own)
        if not len(early) or not len(late):
            continue
        # times as their rank, so that key and time are one number
        times, rank = np.unique(np.concatenate([start[late], end[early]]), return_inverse=True)
        place = run[late].astype(np.int64) * (len(times) + 1) + rank[: len(late)]
        stop = np.searchsorted(place, run[early].astype(np.int64) * (len(times) + 1) + rank[len(late) :])
        at = np.searchsorted(late, early)
        # copies are open at the beginning of the range
        n = np.maximum(stop - at, 0)
        upto = np.cumsum(n)
        i = 0
        while i < len(early):
            j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS)))
            some = n[i:j]
            e = np.repeat(early[i:j], some)
            l = late[np.repeat(at[i:j], some) + np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some)]
            if len(e):
                yield (e, l) if first == 0 else (l, e)
            i = j


def dealt(a: DataFrame, b: DataFrame, keys: Sequence[str], both: bool, start: str, end: str) -> tuple[DataFrame, int, dict[str, T.DataType]]:
    """(rows of both sides with the place of their range and copies of those open there, number of places, types of the sides' rows)."""
    struct = lambda df: F.struct(*[c for c in df.columns if c not in keys])
    kind = lambda df: df.select(struct(df).alias("x")).schema["x"].dataType
    kinds = {"a": kind(a), "b": kind(b)}

    def side(df: DataFrame, number: int) -> DataFrame:
        there = F.col(start).isNotNull() & F.col(end).isNotNull()
        for k in keys:
            there &= F.col(k).isNotNull()
        row = [struct(df).alias(n) if i == number else F.lit(None).cast(t).alias(n) for i, (n, t) in enumerate(kinds.items())]
        return df.where(there).select(*keys, F.col(start).cast("long").alias("__start"), F.col(end).cast("long").alias("__end"), F.lit(number).alias("__side"), F.xxhash64(struct(df)).alias("__tie"), *row)

    held = ranged(side(a, 0).unionByName(side(b, 1)), [*keys, "__start", "__side", "__tie"])
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("k"))
    # one row per range: where it begins, and whether anything starts there that a copy could meet
    edge = held.groupBy("__range").agg(F.min_by(F.struct(key.alias("k"), F.col("__start").alias("s")), "__row").alias("e"), F.max(F.col("__side") == 0).alias("a"), F.max(F.col("__side") == 1).alias("b"))
    edges = sorted(edge.select("__range", "e.k", "e.s", "a", "b").collect(), key=lambda r: r[0])
    spark = a.sparkSession
    last = list(range(len(edges)))  # of each range: the last of those after it that begin with the same key as it does
    for i in range(len(edges) - 2, -1, -1):
        if edges[i + 1].k == edges[i].k:
            last[i] = last[i + 1]
    # of each range: its place, where and with which key the next one begins, and how far that key reaches
    follow = [(e[0], i, last[i + 1], edges[i + 1].s, edges[i + 1].k) if i + 1 < len(edges) else (e[0], i, i, None, None) for i, e in enumerate(edges)]
    of_key = held.select(key.alias("k")).schema["k"].dataType.simpleString()
    ranges = F.broadcast(spark.createDataFrame(follow, f"__range long, __place int, __reach int, __next long, __key {of_key}"))
    lines = F.broadcast(spark.createDataFrame([([e.s for e in edges], [e.a for e in edges], [e.b for e in edges])], "__starts array<long>, __a array<boolean>, __b array<boolean>"))
    own = held.join(ranges, "__range")
    open_ = own.where((F.col("__reach") > F.col("__place")) & key.eqNullSafe(F.col("__key")) & (F.col("__end") > F.col("__next")))
    if not both:
        open_ = open_.where("__side = 0")
    # the last range of the key that begins before the end, by halving
    step = "IF(x.lo >= x.hi, x, IF(__starts[(x.lo + x.hi + 1) div 2] < __end, struct(CAST((x.lo + x.hi + 1) div 2 AS INT) AS lo, x.hi AS hi), struct(x.lo AS lo, CAST((x.lo + x.hi + 1) div 2 - 1 AS INT) AS hi)))"
    to = F.expr(f"aggregate(sequence(1, 32), struct(CAST(__place + 1 AS INT) AS lo, __reach AS hi), (x, i) -> {step}).lo")
    copies = open_.crossJoin(lines).withColumn("__p", F.explode(F.sequence(F.col("__place") + 1, to)))
    meets = F.when(F.col("__side") == 0, F.get("__b", F.col("__p"))).otherwise(F.get("__a", F.col("__p")))
    copies = copies.where(meets).select(F.col("__p").alias("__place"), F.lit(-1).cast("long").alias("__row"), *keys, "__start", "__end", "__side", "a", "b")
    rows = own.select("__place", "__row", *keys, "__start", "__end", "__side", "a", "b").unionByName(copies)
    return rows, max(1, len(edges)), kinds


def pairs(a: DataFrame, b: DataFrame, keys: Sequence[str] = (), both: bool = True, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """(a struct, b struct) of the rows of a and of b with equal keys whose times [start, end) meet; both=False: only those where b starts in a.

    Rows without keys or times find nothing.  Intervals of a must not be empty; those of b may be points with both=False.  The columns of
    a and b besides the keys are the fields of the structs.
    """
    rows, places, kinds = dealt(a, b, keys, both, start, end)

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, own, run = _range(it, keys)
        if t is None:
            return
        start, end, side = (np.asarray(t.column(c)) for c in ("__start", "__end", "__side"))
        left, right = (t.column(c).combine_chunks() for c in ("a", "b"))
        for x, y in found(start, end, run, side, own, both):
            yield pa.RecordBatch.from_arrays([left.take(pa.array(x)), right.take(pa.array(y))], names=["a", "b"])

    return rows.repartitionById(places, F.col("__place")).mapInArrow(meet, f"a {kinds['a'].simpleString()}, b {kinds['b'].simpleString()}")


def _range(it: Iterator[pa.RecordBatch], keys: Sequence[str]) -> tuple[pa.Table | None, np.ndarray, np.ndarray]:
    """(rows of a range in order, copies first; which are its own; number of each one's key)."""
    held = [rb for rb in it if rb.num_rows]
    if not held:
        return None, np.zeros(0, bool), np.zeros(0, np.int64)
    t = pa.Table.from_batches(held).combine_chunks()
    t = t.take(pa.array(np.argsort(np.asarray(t.column("__row")), kind="stable")))
    own = np.asarray(t.column("__row")) >= 0
    new = np.zeros(len(t), bool)
    base = int((~own).sum())
    for k in keys:
        col = t.column(k).combine_chunks()
        change = np.asarray(pc.not_equal(col[base + 1 :], col[base:-1]))
        new[base + 1 :] |= change
    return t, own, np.cumsum(new)


def iou_of(s: np.ndarray, e: np.ndarray, s2: np.ndarray, e2: np.ndarray) -> np.ndarray:
    """What two intervals share of what they cover; not positive where they do not meet."""
    return (np.minimum(e, e2) - np.maximum(s, s2)) / (np.maximum(e, e2) - np.minimum(s, s2))


def nearest(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, iou): of each interval of a that meets one of b with the same key, the one of largest iou, of equal ones that of least tie.

    a, b: numbers of keys, starts, ends, none empty.  Neighbours in the order of starts give an iou that is reached; boxes of starts and ends over
    b, halved in both by turns, then open only where no less is possible, so far fewer pairs are looked at than meet.
    """
    none = np.zeros(0, np.int64)
    if not len(a[0]) or not len(b[0]):
        return none, none, np.zeros(0)
    order = np.lexsort((b[1], b[0]))
    key, s, e = (x[order] for x in b)
    times, rank = np.unique(np.concatenate([s, a[1]]), return_inverse=True)
    at = np.searchsorted(key * (len(times) + 1) + rank[: len(s)], a[0] * (len(times) + 1) + rank[len(s) :])
    # runs of BLOCK starts, in the order of ends inside
    inner = np.lexsort((e, np.arange(len(s)) // BLOCK))
    boxed, k2, s2, e2 = order[inner], key[inner], s[inner], e[inner]
    levels, size = [], LEAF
    while True:
        cut = np.arange(0, len(s2), size)
        levels.append((np.minimum.reduceat(k2, cut), np.maximum.reduceat(k2, cut), np.minimum.reduceat(s2, cut), np.maximum.reduceat(s2, cut), np.minimum.reduceat(e2, cut), np.maximum.reduceat(e2, cut)))
        if len(cut) <= FAN:
            break
        size *= FAN
    out = []
    for lo in range(0, len(a[0]), ROWS):
        k, f, g = (x[lo : lo + ROWS] for x in a)
        by = np.clip(at[lo : lo + ROWS, None] + np.arange(-NEAR, NEAR), 0, len(s) - 1)
        q = np.where(key[by] == k[:, None], iou_of(f[:, None], g[:, None], s[by], e[by]), 0.0).max(1).clip(0.0)
        who, node = np.divmod(np.arange(len(k) * len(levels[-1][0])), len(levels[-1][0]))
        for d in range(len(levels) - 1, -1, -1):
            k_lo, k_hi, s_lo, s_hi, e_lo, e_hi = (x[node] for x in levels[d])
            x, y = f[who], g[who]
            inter = np.minimum(y, e_hi) - np.maximum(x, s_lo)
            on = (inter > 0) & (k_lo <= k[who]) & (k[who] <= k_hi) & (inter / (np.maximum(y, e_lo) - np.minimum(x, s_hi)) >= q[who])
            fan, last = (FAN, len(levels[d - 1][0])) if d else (LEAF, len(s2))
            who, node = np.repeat(who[on], fan), (node[on, None] * fan + np.arange(fan)).ravel()
            who, node = who[node < last], node[node < last]
        v = iou_of(f[who], g[who], s2[node], e2[node])
        on = (k2[node] == k[who]) & (v > 0) & (v >= q[who])
        who, node, v = who[on], boxed[node[on]], v[on]
        best = np.lexsort((tie[node], -v, who))
        best = best[np.append(True, who[best][1:] != who[best][:-1])[: len(best)]]
        out.append((who[best] + lo, node[best], v[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def closest(a: DataFrame, b: DataFrame, tie: str, keys: Sequence[str] = (), start: str = "start_us", end: str = "end_us") -> DataFrame:
    """(a struct, b struct, iou) of the rows of a and, of the rows of b that they meet in a range of time, that of largest iou, of equal ones that of
    least b.tie: a row for each range that an interval of a reaches.  Intervals must not be empty; see pairs() for the rest."""
    rows, places, kinds = dealt(a, b, keys, True, start, end)

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, own, run = _range(it, keys)
        if t is None:
            return
        start, end, side = (np.asarray(t.column(c)) for c in ("__start", "__end", "__side"))
        left, right = (t.column(c).combine_chunks() for c in ("a", "b"))
        # of two copies an earlier range has the pair
        for mine, theirs in ((own, np.ones(len(t), bool)), (~own, own)):
            i, j = np.flatnonzero((side == 0) & mine), np.flatnonzero((side == 1) & theirs)
            ties = np.asarray(pc.rank(pc.struct_field(right.take(pa.array(j)), tie), sort_keys="ascending", null_placement="at_end", tiebreaker="dense"))
            x, y, iou = nearest((run[i], start[i], end[i]), (run[j], start[j], end[j]), ties)
            for c in range(0, len(x), 1 << 16):
                some = slice(c, c + (1 << 16))
                yield pa.RecordBatch.from_arrays([left.take(pa.array(i[x[some]])), right.take(pa.array(j[y[some]])), pa.array(iou[some])], names=["a", "b", "iou"])

    return rows.repartitionById(places, F.col("__place")).mapInArrow(meet, f"a {kinds['a'].simpleString()}, b {kinds['b'].simpleString()}, iou double")

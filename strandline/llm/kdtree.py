"""Approximate nearest neighbours: stable projections in a kd-tree, verified until a chi-square test stops.

Vectors are scaled to length one, so the largest cosine is the least Euclidean distance.  A Gaussian
(2-stable) projection to m dimensions keeps distances in this sense: |projected difference|^2 / d^2 follows
a chi-square law with m degrees of freedom.  Projected neighbours come out of the kd-tree nearest first
and are verified on the original vectors; once a point as close as the k-th best so far would, with
probability `confidence`, have had a projected distance below the current one, the search stops.

The upper levels of the kd-tree cut the table into blocks, each of which is one row of a table that holds its
subtree and vectors.  A query is first answered in the block it falls into; the k-th best distance found there
says, by the same test, which other blocks can still hold a neighbour, and only those see the query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import batch, materialize

K = 5
PROJECTED = 20
CONFIDENCE = 0.93
LEAF = 256
#: Rows of a block: a 64th of all, but not outside these bounds; so blocks follow the rows alone.
BLOCK_ROWS = (1 << 13, 1 << 16)
#: Rows whose projections the upper levels' planes are fitted on, at most about this many.
SAMPLE = 1 << 16
#: Queries that one task answers in a block.
QUERIES = 1 << 12
SEED = 3


def chi2_quantile(p: float, m: int) -> float:
    """The p-quantile of the chi-square law with an even number m of degrees of freedom, by bisection of
    its closed distribution function 1 - exp(-x/2) * sum of (x/2)^i / i! for i < m/2."""

    def cdf(x: float) -> float:
        t, total = 1.0, 1.0
        for i in range(1, m // 2):
            t *= x / 2 / i
            total += t
        return 1 - math.exp(-x / 2) * total

    lo, hi = 0.0, 1.0
    while cdf(hi) < p:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def plane(dims: int, m: int, seed: int = SEED) -> np.ndarray:
    """The projection of vectors of this length."""
    return np.random.default_rng([seed, dims]).standard_normal((dims, m))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=-1, keepdims=True))


def box_distance(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distance of a point to boxes."""
    gap = np.maximum(np.maximum(low - q, q - high), 0)
    return (gap * gap).sum(axis=-1)


class ProjectedTree:
    """A kd-tree over projected points: split at the median of the widest side, leaves of LEAF points.

    `vectors` are in the order of the leaves; node i has the box low[i], high[i] and holds rows span[i]; kids[i] are its
    two parts, or -1 for a leaf.
    """

    def __init__(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, span: np.ndarray, kids: np.ndarray) -> None:
        self.vectors, self.low, self.high, self.span, self.kids = vectors, low, high, span, kids
        self.units = unit(vectors)
        self.plane = plane(vectors.shape[1], low.shape[1])
        self.points = self.units @ self.plane
        #: Rows of the leaves that searches have opened so far, whose projected distances were computed.
        self.opened = 0

    @staticmethod
    def build(vectors: np.ndarray, m: int = PROJECTED, leaf: int = LEAF) -> tuple[np.ndarray, ...]:
        """(order of the rows, low, high, span, kids)"""
        points = unit(vectors) @ plane(vectors.shape[1], m)
        order = np.arange(len(vectors))
        low, high, span, kids = [], [], [], []
        todo = [(0, len(vectors), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            me = len(low)
            p = points[order[a:b]]
            low.append(p.min(axis=0))
            high.append(p.max(axis=0))
            span.append((a, b))
            kids.append([-1, -1])
            if parent >= 0:
                kids[parent][side] = me
            if b - a > leaf and (high[me] > low[me]).any():
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(p[:, int(np.argmax(high[me] - low[me]))], half)]
                todo += [(a, a + half, me, 0), (a + half, b, me, 1)]
        return order, np.array(low), np.array(high), np.array(span, np.int64), np.array(kids, np.int64)

    def near(self, query: np.ndarray, k: int, stop: float, floor: float = -2.0) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, cosines) of the verified rows that can be among the k best and above `floor`, and how many were verified.

        `stop` is the chi-square quantile.  Nodes come off a heap by the least projected distance they can hold; of a
        leaf those rows are verified whose own projected distance r and the k-th best distance d so far leave r^2 < stop * d^2
        (d only falls, so the others stay out).  Once the heap's least distance fails that too, the search ends.
        """
        query = unit(query)
        q = query @ self.plane
        heap = [(0.0, 0)]
        rows, cos, verified = [], [], 0
        best = [floor] * k  # the k largest cosines, smallest first
        while heap:
            r2, i = heapq.heappop(heap)
            if r2 >= stop * max(0.0, 2 - 2 * best[0]):
                break
            if self.kids[i, 0] >= 0:
                kids = self.kids[i]
                for d, j in zip(box_distance(self.low[kids], self.high[kids], q).tolist(), kids.tolist(), strict=True):
                    heapq.heappush(heap, (d, j))
                continue
            a, b = self.span[i]
            self.opened += int(b - a)
            gap = self.points[a:b] - q
            mine = a + np.flatnonzero((gap * gap).sum(axis=1) < stop * max(0.0, 2 - 2 * best[0]))
            if not len(mine):
                continue
            c = self.units[mine] @ query
            verified += len(mine)
            rows.append(mine)
            cos.append(c)
            for x in np.sort(c)[::-1][:k].tolist():
                if x <= best[0]:
                    break
                heapq.heapreplace(best, x)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0), 0
        rows, cos = np.concatenate(rows), np.concatenate(cos)
        keep = cos >= best[0] - 1e-9
        return rows[keep], cos[keep], verified


def top_levels(points: np.ndarray, blocks: int) -> list[tuple[int, float, int, int]]:
    """The upper levels of the kd-tree as nodes (axis, cut, left, right), inner ones; a kid below 0 is block -1 - kid."""
    nodes: list[list] = []
    made = 0
    todo = [(points, blocks, -1, 0)]
    while todo:
        p, n, parent, side = todo.pop()
        spread = p.max(axis=0) - p.min(axis=0) if len(p) else np.zeros(1)
        if n == 1 or len(p) < 2 or not spread.any():
            me, made = -1 - made, made + 1
        else:
            me, axis = len(nodes), int(np.argmax(spread))
            left = n // 2
            cut = float(np.quantile(p[:, axis], left / n))
            nodes.append([axis, cut, 0, 0])
            low = p[:, axis] <= cut
            todo += [(p[low], left, me, 2), (p[~low], n - left, me, 3)]
        if parent >= 0:
            nodes[parent][side] = me
    return [tuple(x) for x in nodes]


def block_of(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    todo = [(np.arange(len(points)), 0 if nodes else -1)]
    while todo:
        rows, i = todo.pop()
        if i < 0:
            out[rows] = -1 - i
        elif len(rows):
            axis, cut, left, right = nodes[i]
            low = points[rows, axis] <= cut
            todo += [(rows[low], left), (rows[~low], right)]
    return out


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>), one vector per id.

    Vectors that are null, zero, empty, or hold null or non-finite components, and rows without an id,
    take no part.  Of several vectors under one id, the smallest in array order counts.
    """
    x = F.col(column)
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    fine = x.isNotNull() & F.col("vec_id").isNotNull() & ~F.exists(x, bad) & F.exists(x, lambda c: c != 0)
    v = vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: c.cast("double")).alias("v"))
    return v.groupBy("vec_id").agg(F.min("v").alias("v"))


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query; equal rows give equal bits wherever they stand."""
    dot = (rows * query).sum(axis=1)
    return dot / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, m: int = PROJECTED, confidence: float = CONFIDENCE, block_rows: tuple[int, int] = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query about its k nearest vectors of another id, by cosine.

    vectors, queries: see usable().  The score is the cosine of the original vectors in double precision;
    ties go to the smaller id; vectors of another length than the query's are not its candidates; fewer
    than k candidates: all; an empty table: no rows.  Equal vectors are indexed once, with their k + 1
    smallest ids, which is all that a top k can hold of them: one common vector makes no large group.

    Every row is indexed; the planes of the upper levels are fitted on about SAMPLE rows of least hash.  The result
    depends on the rows alone, not on how many cores or partitions there are.
    """
    spark = vectors.sparkSession
    rows = materialize(_classes(vectors, k), "near-vectors")
    asked = materialize(queries.select(F.col("vec_id").alias("query_id"), "v"), "near-queries")
    n = rows.count()
    stop = chi2_quantile(confidence, m)
    trees = materialize(_trees(rows, n, m, block_rows), "near-trees")
    # two points of m numbers for each block of some thousand rows
    boxes: dict[int, tuple[np.ndarray, ...]] = {}
    for dims, block, low, high in trees.select("dims", "block", F.expr(f"substring(low, 1, {8 * m})"), F.expr(f"substring(high, 1, {8 * m})")).orderBy("dims", "block").collect():
        boxes.setdefault(dims, []).append((block, np.frombuffer(low), np.frombuffer(high)))
    boxes = {d: tuple(np.array(x) for x in zip(*b, strict=True)) for d, b in boxes.items()}
    shared = spark.sparkContext.broadcast(boxes)
    schema = pa.schema([("query_id", pa.int64()), ("v", pa.list_(pa.float64())), ("floor", pa.float64()), ("dims", pa.int32()), ("block", pa.int32())])

    def visits(home: bool):
        """Each query (query_id, v, floor) with the block it falls into, or with the other blocks that the test leaves."""

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rb in it:
                for i in range(rb.num_rows):
                    v = np.asarray(rb.column("v")[i].values, dtype=np.float64)
                    if len(v) not in shared.value:
                        continue
                    block, low, high = shared.value[len(v)]
                    r2 = box_distance(low, high, unit(v) @ plane(len(v), m))
                    first = int(np.argmin(r2))
                    floor = rb.column("floor")[i].as_py()
                    go = np.array([first]) if home else np.flatnonzero(r2 < stop * (2 - 2 * floor))
                    go = go if home else go[go != first]
                    if len(go):
                        one = pa.array(np.zeros(len(go), np.int64))
                        yield batch(schema, [rb.column("query_id").slice(i, 1).take(one), rb.column("v").slice(i, 1).take(one), np.full(len(go), floor), np.full(len(go), len(v)), block[go]])

        return run

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            t = {c: left.column(c)[0].as_py() for c in left.column_names}
            dims, at = t["dims"], np.append(0, np.cumsum(np.frombuffer(t["counts"], np.int64)))
            ids, vs = np.frombuffer(t["ids"], np.int64), np.frombuffer(t["vs"]).reshape(-1, t["dims"])
            tree = ProjectedTree(vs, *(np.frombuffer(t[c]).reshape(-1, m) for c in ("low", "high")), *(np.frombuffer(t[c], np.int64).reshape(-1, 2) for c in ("span", "kids")))
            q_vs = np.asarray(right.column("v").combine_chunks().flatten(), dtype=np.float64).reshape(-1, dims)
            for q_id, floor, v in zip(right.column("query_id").to_pylist(), right.column("floor").to_pylist(), q_vs, strict=True):
                got, _, _ = tree.near(v, k + 1, stop, floor)
                if not len(got):
                    continue
                score = np.repeat(cosines(vs[got], v), at[got + 1] - at[got])
                own = np.concatenate([ids[at[g] : at[g + 1]] for g in got])
                score, own = score[own != q_id], own[own != q_id]
                order = np.lexsort((own, -score))[:k]
                out.append((np.full(len(order), q_id), own[order], score[order]))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 3
        return pa.table([pa.array(c.astype(t), p) for c, t, p in zip(cols, (np.int64, np.int64, np.float64), (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    def answer(visiting: DataFrame, name: str) -> DataFrame:
        """What the visited blocks find; a block that many queries visit is copied for each QUERIES of them."""
        held = materialize(visiting.mapInArrow(visits(name == "home"), "query_id long, v array<double>, floor double, dims int, block int"), f"near-{name}")
        load = held.groupBy("dims", "block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("salts"))
        left = trees.join(load, ["dims", "block"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        right = held.join(load, ["dims", "block"]).withColumn("salt", F.pmod(F.xxhash64("query_id"), F.col("salts")).cast("int")).drop("salts")
        keys = ["dims", "block", "salt"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
        return materialize(found, f"near-{name}-found")

    top = F.expr(f"slice(array_sort(collect_list(struct(-score as s, vec_id))), 1, {k})")
    first = answer(asked.withColumn("floor", F.lit(-2.0)), "home")
    floors = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    rest = asked.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
    found = first.union(answer(rest.select("query_id", "v", "floor"), "others"))
    ranked = found.groupBy("query_id").agg(top.alias("best")).select("query_id", F.posexplode("best").alias("p", "b"))
    return ranked.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))


def _trees(rows: DataFrame, n: int, m: int, block_rows: tuple[int, int]) -> DataFrame:
    """(dims, block, counts, ids, vs, low, high, span, kids): each block's rows in the order of its kd-tree's leaves."""
    size = min(max(n // 64, block_rows[0]), block_rows[1])
    blocks = max(1, -(-n // size))

    def project(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for i in range(rb.num_rows):
                v = np.asarray(rb.column("v")[i].values, dtype=np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([(unit(v) @ plane(len(v), m)).tobytes()], pa.binary())], names=["p"])

    nodes: list = []
    if blocks > 1:
        few = rows.where(F.pmod(F.xxhash64("v"), F.lit(max(1, n // SAMPLE))) == 0).select("v").mapInArrow(project, "p binary").toArrow()
        points = np.frombuffer(b"".join(few.column("p").to_pylist())).reshape(-1, m)
        nodes = top_levels(points[np.lexsort(points.T)], blocks)

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            lens = np.asarray(rb.column("v").value_lengths())
            for dims in np.unique(lens):
                pick = pa.array(np.flatnonzero(lens == dims))
                v = np.asarray(rb.column("v").take(pick).flatten(), dtype=np.float64).reshape(-1, dims)
                block = block_of(unit(v) @ plane(int(dims), m), nodes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), dims, np.int32)), pa.array(block.astype(np.int32)), rb.column("ids").take(pick), rb.column("v").take(pick)], names=["dims", "block", "ids", "v"])

    schema = pa.schema([("dims", pa.int32()), ("block", pa.int32())] + [(c, pa.binary()) for c in ("counts", "ids", "vs", "low", "high", "span", "kids")])

    def build(t: pa.Table) -> pa.Table:
        dims, ids = t.column("dims")[0].as_py(), t.column("ids").combine_chunks()
        v = np.asarray(t.column("v").combine_chunks().flatten(), dtype=np.float64).reshape(-1, dims)
        # the tree does not depend on the order in which rows arrive
        by = np.lexsort(v.T[::-1])
        order, low, high, span, kids = ProjectedTree.build(v[by], m)
        order = by[order]
        ids = ids.take(pa.array(order))
        cols = [np.asarray(ids.value_lengths(), dtype=np.int64), np.asarray(ids.flatten(), dtype=np.int64), v[order], low, high, span, kids]
        return pa.table([pa.array([x], f.type) for x, f in zip([dims, t.column("block")[0].as_py(), *(c.tobytes() for c in cols)], schema, strict=True)], schema=schema)

    return rows.mapInArrow(place, "dims int, block int, ids array<long>, v array<double>").groupBy("dims", "block").applyInArrow(build, "dims int, block int, counts binary, ids binary, vs binary, low binary, high binary, span binary, kids binary")


def _classes(vectors: DataFrame, k: int) -> DataFrame:
    """(v, ids): each distinct vector with its k + 1 smallest ids, cut per salt first so that no group is large."""
    cut = lambda x: F.expr(f"slice(array_sort({x}), 1, {k + 1})")
    first = vectors.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(256))).groupBy("v", "salt").agg(cut("collect_set(vec_id)").alias("ids"))
    return first.groupBy("v").agg(cut("array_distinct(flatten(collect_list(ids)))").alias("ids"))

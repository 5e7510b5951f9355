"""Exact top-k inner products over a bit-sliced index.

Rows are cut into blocks.  A block keeps, per dimension and bit, a bitmap over its rows of the (offset)
integer attribute.  A query's score is a sum of slices shifted by the set bits of its own components, so
the bitmaps are added with carry-save adders into the slices of the score; the top rows are then selected
from the most significant score slice downward, and the rows that tie at the boundary are resolved by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import batch, materialize

SCALE = 64
K = 20
BLOCK_ROWS = 1 << 16


class BitSlices:
    """The index of one block: ids ascending, slices[d][b] a bitmap over its rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        n, dims = values.shape
        self.low = values.min(axis=0) if n else np.zeros(dims, np.int64)
        self.n, self.words = n, (n + 63) // 64
        offset = (values - self.low).astype(np.uint64)
        bits = [int(x).bit_length() for x in offset.max(axis=0)] if n else [0] * dims
        self.full = np.array([(1 << b) - 1 for b in bits], dtype=np.int64)
        self.dim = np.repeat(np.arange(dims), bits)
        self.bit = np.concatenate([np.arange(b) for b in bits] or [np.zeros(0, np.int64)]).astype(np.int64)
        # row r of the first half is the bitmap of bit self.bit[r] of dimension self.dim[r]; the second half has the complements
        self.planes = np.zeros((2 * len(self.dim), self.words), dtype=np.uint64)
        flat = np.zeros(self.words * 64, dtype=bool)
        for r, (d, b) in enumerate(zip(self.dim, self.bit, strict=True)):
            flat[:n] = (offset[:, d] >> np.uint64(b)) & np.uint64(1)
            self.planes[r] = np.packbits(flat, bitorder="little").view(np.uint64)
        self.planes[len(self.dim) :] = ~self.planes[: len(self.dim)]

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of score - base, least significant first.

        A component q >= 0 adds the slices shifted by each set bit of q; for q < 0,
        q * u = |q| * (full - u) - |q| * full, so it adds the complements.
        """
        base = int(query @ self.low) + int(np.minimum(query, 0) @ self.full)
        q = query[self.dim]
        size, row = np.abs(q), np.arange(len(q)) + len(q) * (q < 0)
        picks = [(row[on], self.bit[on] + c) for c in range(int(size.max(initial=0)).bit_length()) for on in [(size >> c) & 1 == 1]]
        rows = np.concatenate([x for x, _ in picks] or [np.zeros(0, np.int64)])
        weight = np.concatenate([x for _, x in picks] or [np.zeros(0, np.int64)])
        order = np.argsort(weight, kind="stable")
        rows, weight = rows[order], weight[order]
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []  # bitmaps that came up from the weight below
        w, most = 0, int(weight[-1]) if len(weight) else -1
        while w <= most or carried:
            a, b = np.searchsorted(weight, [w, w + 1])
            stack = np.concatenate([self.planes[rows[a:b]], *carried])
            carried = []
            while len(stack) > 2:
                t = len(stack) // 3
                x, y, z = stack[:t], stack[t : 2 * t], stack[2 * t : 3 * t]
                one = x ^ y
                carried.append((x & y) | (one & z))
                one ^= z
                stack = np.concatenate([one, stack[3 * t :]])
            if len(stack) == 2:
                carried.append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
            out.append(stack[0] if len(stack) else np.zeros(self.words, np.uint64))
            w += 1
        return out, base

    def top(self, query: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows, best first, ties to the smaller id; the row with id `without` is left out."""
        if not self.n:
            return self.ids[:0], np.zeros(0, np.int64)
        slices, base = self.score_slices(query)
        valid = np.zeros(self.words * 64, dtype=bool)
        valid[: self.n] = True
        if without is not None:
            a, b = np.searchsorted(self.ids, [without, without + 1])
            valid[a:b] = False
        open_ = np.packbits(valid, bitorder="little").view(np.uint64)
        sure = np.zeros(self.words, np.uint64)
        have = 0
        for s in reversed(slices):
            high = open_ & s
            n = int(np.bitwise_count(high).sum())
            if have + n > k:
                open_ = high
            else:
                sure |= high
                have += n
                open_ = open_ & ~s
            if have == k:
                open_ = np.zeros_like(open_)
                break
        rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        # what is left open ties at the boundary; rows stand in id order
        rows = np.append(rows, np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))[: k - have])
        word, bit = rows // 64, (rows % 64).astype(np.uint64)
        score = np.full(len(rows), base, dtype=np.int64)
        for w, s in enumerate(slices):
            score += ((s[word] >> bit) & np.uint64(1)).astype(np.int64) << w
        order = np.lexsort((self.ids[rows], -score))
        return self.ids[rows][order], score[order]


def quantised(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of each component as double; rows that are null, or hold a
    null or non-finite component, and rows without an id take no part."""
    x = F.col(column)
    fine = x.isNotNull() & F.col("vec_id").isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k largest inner products with vectors of another id.

    vectors, queries: (vec_id, v array<long>), see quantised().  Rows of another length than the query's
    are not candidates of it.  Of several vectors under one id, the smallest in array order counts, so
    repeated rows are one.  Fewer than k candidates: all; an empty table: no rows.

    Candidates are dealt out by a hash of their id to blocks of about block_rows, queries to chunks of as
    many; each pair of a block and a chunk is one task's work (a stated query set against all rows, in
    blocks) and gives k rows a query.
    """
    spark = vectors.sparkSession
    rows = materialize(vectors.groupBy("vec_id").agg(F.min("v").alias("v")), "bits-vectors")
    asked = materialize(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "bits-queries")
    n, m = rows.count(), asked.count()
    blocks = max(1, -(-n // block_rows), min(spark.sparkContext.defaultParallelism // 2, n // 16384))
    chunks = max(1, -(-m // block_rows))

    def side(df: DataFrame, mine: int, other: int, key: str, by: str) -> DataFrame:
        """df's rows packed by part, once for each part of the other side."""
        deal = df.withColumn(key, F.pmod(F.xxhash64("vec_id"), F.lit(mine)).cast("int"))

        def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([(key, pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("vs", pa.binary())])
            for rb in it:
                ids, part = np.asarray(rb.column("vec_id")), np.asarray(rb.column(key))
                lens = np.asarray(rb.column("v").value_lengths())
                for dims in np.unique(lens[lens > 0]):
                    for p in np.unique(part[lens == dims]):
                        pick = np.flatnonzero((lens == dims) & (part == p))
                        v = np.asarray(rb.column("v").take(pa.array(pick)).flatten(), dtype=np.int64)
                        yield batch(schema, [[int(p)], [int(dims)], [ids[pick].tobytes()], [v.tobytes()]])

        packed = deal.mapInArrow(pack, f"{key} int, dims int, ids binary, vs binary")
        return packed.withColumn(by, F.explode(F.sequence(F.lit(0), F.lit(other - 1))))

    def gathered(t: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """dims: (ids, matrix)"""
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for dims, i, v in zip(t.column("dims").to_pylist(), t.column("ids").to_pylist(), t.column("vs").to_pylist(), strict=True):
            held.setdefault(dims, []).append((np.frombuffer(i, np.int64), np.frombuffer(v, np.int64).reshape(-1, dims)))
        return {d: (np.concatenate([i for i, _ in x]), np.concatenate([v for _, v in x])) for d, x in held.items()}

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        mine = gathered(left)
        for dims, (q_ids, q_vs) in gathered(right).items():
            if dims in mine:
                index = BitSlices(*mine[dims])
                for q, v in zip(q_ids.tolist(), q_vs, strict=True):
                    got, score = index.top(v, k, q)
                    out.append((np.full(len(got), q), got, score))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    left = side(rows, blocks, chunks, "block", "chunk").groupBy("block", "chunk")
    right = side(asked, chunks, blocks, "chunk", "block").groupBy("block", "chunk")
    found = left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score long")
    best = F.expr(f"slice(array_sort(collect_list(struct(-score as s, vec_id))), 1, {k})")
    ranked = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("p", "b"))
    return ranked.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))

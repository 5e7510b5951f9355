"""Centroid clustering by plain Lloyd rounds in integers.

Vectors are quantised once and written to the shared folder.  In each round the centroids (k rows of `dims` numbers) are
broadcast, `mapInPandas` computes squared differences to each of them in NumPy, and argmin takes the centroid of lowest number
among the nearest.  Each partition gives one row of sums per centroid, which a groupBy adds up, so a round moves k rows a
partition and brings k rows to the driver.  All arithmetic is on integers and exact: results do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import batch, materialize

DIMS = 64
SCALE = 1024
K = 8
ROUNDS = 10
SEED = 3
#: Quantised components beyond it count as it, so that squared distances of up to 2^6 components fit into a long.
LARGEST = 1 << 27
#: Rows whose distances a task computes at once.
ROWS = 1 << 13
LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v binary): floor(scale * x) of each component as double, as little-endian 32-bit integers, of the vectors that have
    exactly `dims` components, none of them null or non-finite."""
    x = F.col(column)
    fine = x.isNotNull() & (F.size(x) == dims) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.binary())])

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            flat = np.asarray(rb.column("x").flatten(), dtype=np.float64).reshape(-1, dims)
            raw = np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype("<i4")
            yield batch(schema, [rb.column("vec_id"), pa.array([r.tobytes() for r in raw], pa.binary())])

    kept = vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x"))
    return kept.mapInArrow(pack, "vec_id long, v binary")


def matrix(v: pd.Series, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(v), dtype="<i4").reshape(-1, dims).astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row, the lowest number among equals."""
    dist = np.empty((len(x), len(centroids)), dtype=np.int64)
    for c, centre in enumerate(centroids):
        d = x - centre
        dist[:, c] = np.einsum("ij,ij->i", d, d)
    best = dist.argmin(axis=1)
    return best, dist[np.arange(len(x)), best]


def first_centroids(rows: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The vectors whose ids have the k smallest sha256 of `seed:id`, in that order; of rows of one id, those smaller as bytes come first."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    got = rows.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return matrix(pd.Series([bytes(r.v) for r in got], dtype=object), dims)


def _sums(rows: DataFrame, centroids: np.ndarray, dims: int) -> list:
    """(cluster, n, s, inertia) of each centroid that has vectors: their number, componentwise sums and summed distances."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def partial(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = shared.value
        k = len(centres)
        n, s, far = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), [0] * k
        for part in it:
            for a in range(0, len(part), ROWS):
                x = matrix(part["v"].iloc[a : a + ROWS], dims)
                at, dist = nearest(x, centres)
                n += np.bincount(at, minlength=k)
                for c in np.unique(at):
                    mine = at == c
                    s[c] += x[mine].sum(axis=0)
                    d = dist[mine]
                    far[c] += (int((d >> 32).sum()) << 32) + int((d & 0xFFFFFFFF).sum())
        on = np.flatnonzero(n)
        if len(on):
            yield pd.DataFrame({"cluster": on.astype(np.int32), "n": n[on], "s": list(s[on]), "inertia": [Decimal(far[c]) for c in on]})

    parts = rows.select("v").mapInPandas(partial, "cluster int, n long, s array<long>, inertia decimal(38,0)")
    total = F.array(*[F.sum(F.col("s")[i]) for i in range(dims)])
    got = parts.groupBy("cluster").agg(F.sum("n").alias("n"), total.alias("s"), F.sum("inertia").alias("inertia")).collect()
    shared.unpersist()
    return got


def cluster_vectors(vectors: DataFrame, column: str = "embedding", k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, cluster_size, centroid_sha256) for each vector kept by quantised().

    Centroids start as the vectors whose ids hash lowest; each round assigns every vector to the nearest centroid (ties: the smaller
    number) and moves each centroid that has vectors to floor(sum / count), component by component; then vectors are assigned once
    more.  distance is squared; cluster_inertia and inertia are its sums over the cluster and over all rows (beyond a long: the
    largest one).  centroid_sha256 is the lowercase hex digest of the final centroid's components in decimal, joined by commas.

    Null vectors, other lengths, and null or non-finite components take no part; |components| beyond LARGEST / scale count as that.
    A null vec_id hashes as an empty text.  Repeated rows count each.  Fewer vectors than k: as many centroids as vectors, equal
    ones allowed (all vectors then fall to the lower number).  An empty table gives no rows.  Other columns are ignored.
    """
    rows = materialize(quantised(vectors, column, dims, scale), "lloyd-vectors")
    centroids = first_centroids(rows, k, seed, dims)
    for _ in range(rounds if len(centroids) else 0):
        before = centroids
        centroids = centroids.copy()
        for r in _sums(rows, centroids, dims):
            centroids[r.cluster] = [x // r.n for x in r.s]
        if (centroids == before).all():
            break  # the rounds that are left would change nothing
    last = {r.cluster: r for r in _sums(rows, centroids, dims)} if len(centroids) else {}
    inertia = min(LONG, sum(int(r.inertia) for r in last.values()))
    size = np.array([last[c].n if c in last else 0 for c in range(len(centroids))], np.int64)
    within = np.array([min(LONG, int(last[c].inertia)) if c in last else 0 for c in range(len(centroids))], np.int64)
    digest = np.array([hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids], dtype=object)
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def assign(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            for a in range(0, len(part), ROWS):
                some = part.iloc[a : a + ROWS]
                at, dist = nearest(matrix(some["v"], dims), shared.value)
                yield pd.DataFrame({"vec_id": some["vec_id"].to_numpy(), "cluster": at.astype(np.int32), "distance": dist, "cluster_inertia": within[at], "inertia": inertia, "cluster_size": size[at], "centroid_sha256": digest[at]})

    return rows.mapInPandas(assign, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, cluster_size long, centroid_sha256 string")

"""Shared pieces: the shared folder, packed shuffles, connected components, and text as numpy arrays.

Texts are handled a slice at a time: a slice is a run of whole rows of an Arrow batch whose UTF-8
bytes sit in one uint8 array.  All hashing is done over such arrays without a Python loop per word.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.shared import shared_dir

SLICE_BYTES = 1 << 21

# ---------------------------------------------------------------- shared folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._strandline_path = path  # type: ignore[attr-defined]
    return out


def discard(df: DataFrame) -> None:
    """Delete what materialize() wrote for df, once nothing reads it any more."""
    path = getattr(df, "_strandline_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_parts(spark: SparkSession) -> int:
    """How many parts a packed shuffle has: the session's shuffle partitions, which follow the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow; at a task's end its worker, which Spark keeps for later ones, gives back what its arrays took."""

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(it)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # a C library without it
            ctypes.CDLL(None).malloc_trim(0)

    return whole


# ---------------------------------------------------------------- 64-bit hashing

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer over uint64: xor-shifts and odd multiplications."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed pseudo-random odd numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_BASE) + U64(salt)) | U64(1)


_BYTE = seeds(256, 77)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for n positions."""
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, b in (("p", _BASE), ("i", _INV)):
            a = np.full(size, b, dtype=U64)
            a[0] = 1
            _POW[key] = np.multiply.accumulate(a)
    return _POW["p"][:n], _POW["i"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte values times powers of the base: span_hash() reads any substring's hash off it."""
    n = len(data)
    p, _ = _powers(n)
    out = np.empty(n + 1, dtype=U64)
    out[0] = 0
    np.cumsum(_BYTE[data] * p, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; it does not depend on where the span stands."""
    _, inv = _powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(U64))


def spans_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int = 2 * SLICE_BYTES) -> np.ndarray:
    """span_hash() of the spans of a text of any length (starts ascending), about `limit` bytes of it at a time, also within a span."""
    if len(data) <= limit:
        return span_hash(prefix_hash(data), start, end)
    out = np.empty(len(start), dtype=U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + limit)))
        lo, hi = int(start[i]), int(end[i:j].max())
        if j == i + 1 and hi - lo > limit:
            out[i] = _long_hash(data[lo:hi], limit)
        else:
            out[i:j] = span_hash(prefix_hash(data[lo:hi]), start[i:j] - lo, end[i:j] - lo)
        i = j
    return out


def _long_hash(data: np.ndarray, limit: int) -> np.uint64:
    """span_hash() of the whole of data, about `limit` bytes of it at a time."""
    total = 0
    for a in range(0, len(data), limit):
        total += int(prefix_hash(data[a : a + limit])[-1]) * pow(_BASE, a, 1 << 64)
    return mix(np.array([(total + len(data)) % (1 << 64)], dtype=U64))[0]


# ---------------------------------------------------------------- texts as arrays

#: The white space of the contracts: space and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole rows of at most limit bytes, or of one row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts, b"")
    n = len(texts)
    if n == 0:
        return
    _, off, buf = texts.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def words(data: np.ndarray, offs: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word (run of bytes that are not white space, or not in another set); words end with their row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    ink = ~blank[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    b = offs[:-1]
    b = b[b < n]
    first[b] = ink[b]
    e = offs[1:]
    e = e[e > 0] - 1
    last[e] = ink[e]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def distinct_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a span of each distinct content, number of its content for each span); data: uint8, or code points as uint32.

    Contents are told apart by a 64-bit hash and then held against each other, so that equal hashes of unlike contents do no harm.
    """
    n, salt = len(data), 0
    size = end - start
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pw, inv = _powers(n + 1)
    while True:
        w = mix(np.arange(256, dtype=U64) + U64(1 + salt))[data] if data.dtype == np.uint8 else mix(data.astype(U64) + U64(1 + salt))
        p = np.empty(n + 1, dtype=U64)
        p[0] = 0
        np.cumsum(w * pw[:n], out=p[1:])
        _, one, of = np.unique(mix((p[end] - p[start]) * inv[start] + size.astype(U64)), return_index=True, return_inverse=True)
        lead = one[of]
        if (size == size[lead]).all():
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            if (data[np.repeat(start, size) + at] == data[np.repeat(start[lead], size) + at]).all():
                return one, of
        salt += 1 << 32


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins, in sorted arrays."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal keys that each place of sorted arrays belongs to."""
    new = np.zeros(len(keys[0]), dtype=np.int64)
    new[run_starts(*keys)] = 1
    return np.cumsum(new) - 1


# ---------------------------------------------------------------- packed shuffles


class Packer:
    """Gathers arrays by part and gives them out as few rows (part, one binary per column).

    Memory is bounded by flush_at entries; a row holds what one flush has for one part.
    """

    def __init__(self, parts: int, names: list[str], flush_at: int = 500_000) -> None:
        self.parts, self.names, self.flush_at = parts, names, flush_at
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, part: np.ndarray, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(part):
            self.held.append((part.astype(np.int32), *cols))
            self.n += len(part)
        if self.n >= self.flush_at:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        cols = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        self.held, self.n = [], 0
        order = np.argsort(cols[0], kind="stable")
        cols = [c[order] for c in cols]
        at = run_starts(cols[0])
        ends = np.append(at[1:], len(order))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0][at], pa.int32())] + [pa.array([c[a:e].tobytes() for a, e in zip(at, ends, strict=True)], pa.binary()) for c in cols[1:]],
            names=["part", *self.names],
        )


def unpack(batches: Iterator[pa.RecordBatch], names: list[str], types: list[np.dtype]) -> list[np.ndarray]:
    """All entries of a partition of packed rows, column by column."""
    held: list[list[bytes]] = [[] for _ in names]
    for b in batches:
        for k, name in enumerate(names):
            held[k] += b.column(name).to_pylist()
    return [np.frombuffer(b"".join(x), dtype=t) for x, t in zip(held, types, strict=True)]


def packed_schema(names: list[str]) -> str:
    return ", ".join(["part int", *(f"{n} binary" for n in names)])


def deal(df: DataFrame, parts: int) -> DataFrame:
    """Part k to partition k."""
    return df.repartitionById(parts, F.col("part"))


def batch(schema: pa.Schema, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)


# ---------------------------------------------------------------- joins on keys that many rows share

#: A key is hot if it has more rows than this and than one in HOT_KEYS of all; so at most HOT_KEYS keys are.
HOT_ROWS = 512
HOT_KEYS = 1 << 16


def hot_keys(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, salts) of the hot keys among counts (keys, n), at most HOT_KEYS of them."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_ROWS, total // HOT_KEYS)
    return counts.where(F.col("n") > limit).select(*keys, F.ceil(F.col("n") / limit).cast("int").alias("salts"))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """left joined with right, which has few rows a key: the left rows of a hot key go to as many places as it has salts (by
    their column `spread`), and the key's right rows to each of them.  Left rows with a null key (they find nothing) spread too.
    """
    hot = F.broadcast(hot.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("salts").alias("__salts")))
    on, null = F.lit(True), F.lit(False)
    for k in keys:
        on &= F.col(k) == F.col(f"__{k}")
        null |= F.col(k).isNull()
    drop = [f"__{k}" for k in keys] + ["__salts"]
    salt = F.when(null, F.pmod(F.xxhash64(spread), F.lit(1 << 20))).otherwise(F.pmod(F.xxhash64(spread), F.coalesce("__salts", F.lit(1)))).cast("int")
    many = left.join(hot, on, "left").withColumn("__salt", salt).drop(*drop)
    few = right.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop(*drop)
    return many.join(few, [*keys, "__salt"], how).drop("__salt")


# ---------------------------------------------------------------- connected components

#: Edges that a task ties up at once; as many tasks work on the edges first as have about so many each.
EDGES = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges' nodes and the smallest node that each reaches over them (itself left out)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        # hang each end's root under the smaller of both, then shorten all ways
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    on = root != np.arange(len(nodes))
    return nodes[on], nodes[root[on]]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for each node of the edges (a long, b long): component is the smallest node reached.

    Each task first ties up what its own edges connect; then large-star and small-star steps (a grouped minimum and a
    join, salted for nodes of many edges) alternate, so that no component is ever gathered in one place, until a
    round leaves the edge set as it was.  Rounds grow with the logarithm of the longest path.  Null ends are ignored.
    """

    def tied(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def out() -> pa.RecordBatch:
            a, b = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for rb in it:
            held.append((np.asarray(rb.column("a")), np.asarray(rb.column("b"))))
            n += rb.num_rows
            if n >= EDGES:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    def tally(df: DataFrame):
        return df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()

    proper = edges.where("a is not null and b is not null and a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    proper = materialize(proper, name)
    tasks = -(-proper.count() // EDGES)
    e = materialize(proper.coalesce(max(1, tasks)).mapInArrow(tied, "a long, b long").distinct(), name)
    discard(proper)
    # what one task has tied up is done
    was = tally(e) if tasks > 1 else (0, None)
    while was[0]:
        e1 = e.mapInArrow(tied, "a long, b long")
        both = e1.union(e1.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"), name)
        hot = hot_keys(low, ["a"])
        # large star: each larger neighbour is tied to the smallest of the neighbourhood
        large = salted_join(both.where("b > a"), low.drop("n"), ["a"], "b", hot).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the node and its smaller neighbours are tied to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        new = materialize(small, name)
        now = tally(new)
        discard(e)
        discard(low)
        e = new
        if now == was:
            break
        was = now
    out = e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())
    return materialize(out, name + "-done")

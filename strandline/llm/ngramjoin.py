"""N-gram Jaccard join: blocked sparse products of the document by n-gram incidence matrix.

Rows of the matrix are the distinct n-gram sets ("classes": documents with equal sets are one row), columns
the n-grams, dealt out to blocks by ranges of their hash.  With the n-grams of every set in one global
order, sets of sizes x and y that link share at least ceil(t (x + y) / (1 + t)) n-grams, hence at least
min(l(x), l(y)) of their first x - ceil(t x) + l(x) ones: only that part of each row is multiplied, each
block adds its overlap counts, and pairs below the size-derived bounds are discarded.

The order puts the most frequent n-grams last (a bounded, broadcast set), so that passages which many
unlike documents share make no candidates.  Groups of many like documents are handled in two rounds: the
first takes, per column, only the products with a few hub rows, and links what is verified; the second takes
all remaining products between rows that are not yet connected: pair by pair where columns are short, and as tiles of whole
rows for the groups that long columns connect.  Every link is between full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import LOWER, U64, Packer, components, deal, discard, hot_keys, materialize, mix, packed_schema, run_starts, runs, salted_join, seeds, shuffle_parts, slices, spans_hash, trimmed, unpack, words

N = 5
NUM, DEN = 4, 5  # the threshold 0.8, exactly
#: An n-gram that more documents than this hold is frequent; of these the FREQUENT most frequent are moved to the end.
OFTEN = 16
FREQUENT = 1 << 21
#: A column with more rows than this is long; groups of rows that share long columns are multiplied as blocks of
#: whole rows, in tiles of TILE rows, instead of pair by pair.
LONG = 64
TILE = 512
#: Hub rows of each column in the first round.
HUBS = 2
_SIZE = np.int64((1 << 32) - 1)
_SALT = U64(0x51ED270B9F4A7C15)
_TAG = seeds(64, 5)


def shingles(data: np.ndarray, offs: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-word sequences of each text, ascending by hash within a row.

    A-Z count as a-z; a text of fewer words has its whole sequence as the only one; without words none.
    """
    data = LOWER[data]
    start, end, row = words(data, offs)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    w = spans_hash(data, start, end)
    k = len(w) - n + 1
    if k > 0:
        h = np.zeros(k, dtype=U64)
        for i in range(n):
            h += w[i : i + k] * _TAG[i]
        full = row[:k] == row[n - 1 :]
        h, r = mix(h[full] + _TAG[n]), row[:k][full]
    else:
        h, r = np.zeros(0, U64), np.zeros(0, np.int64)
    at = run_starts(row)
    size = np.diff(np.append(at, len(row)))
    short = size < n
    if short.any():
        a, s = at[short], size[short]
        g = np.zeros(len(a), dtype=U64)
        for i in range(n - 1):
            on = s > i
            g[on] += w[a[on] + i] * _TAG[i]
        r = np.concatenate([r, row[a]])
        h = np.concatenate([h, mix(g + _TAG[n] + s.astype(U64) * _TAG[n + 1])])
        by = np.argsort(r, kind="stable")
        r, h = r[by], h[by]
    at = np.append(run_starts(r), len(r))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        h[a:b].sort()
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return r[keep], h[keep]


def _rows(r: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, size and class (a hash of the whole set) of each row that has any."""
    at = run_starts(r)
    size = np.diff(np.append(at, len(r)))
    cls = mix(np.add.reduceat(mix(h ^ _SALT), at) + size.astype(U64)) if len(at) else np.zeros(0, U64)
    return at, size, cls.view(np.int64)


def least_overlap(x, y, num: int = NUM, den: int = DEN):
    """Size-derived bound: the least overlap of linked sets of sizes x and y."""
    return -(-num * (x + y) // (num + den))


def shared_bound(x):
    """l(x): how many n-grams of its prefix a set of size x shares with a linked one, that one's l permitting."""
    return 1 + x // 16


def prefix_size(x, num: int = NUM, den: int = DEN):
    return np.minimum(x, x - -(-num * x // den) + shared_bound(x))


def signatures(docs: DataFrame, n: int = N) -> DataFrame:
    """(doc_id, th, n_shingles, cls) for each row; th is xxhash64 of the text, cls is null where the set is empty."""

    def sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            size, cls = np.zeros(rb.num_rows, np.int64), np.zeros(rb.num_rows, np.int64)
            for a, _, data, offs in slices(rb.column("text")):
                r, h = shingles(data, offs, n)
                at, s, c = _rows(r, h)
                size[r[at] + a], cls[r[at] + a] = s, c
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), rb.column("th"), pa.array(size), pa.array(cls, mask=size == 0)], names=["doc_id", "th", "n_shingles", "cls"])

    th = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), th.alias("th"), "text").mapInArrow(trimmed(sign), "doc_id long, th long, n_shingles long, cls long")


def _print(h: np.ndarray, parts: int) -> np.ndarray:
    """Fingerprint of an n-gram for counting: 16 bits that name its part (of at most 65,536) and 32 more."""
    return ((h >> U64(16)) * U64(parts)) >> U64(16)


def _frequent(docs: DataFrame, n: int, parts: int) -> np.ndarray:
    """Sorted fingerprints of the at most FREQUENT n-grams that most documents hold; counts cover all documents.

    Fingerprints that n-grams share only place these n-grams together in the order.
    """
    parts = min(parts, 1 << 16)

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(parts, ["f"])
        seen: set[int] = set()
        for rb in it:
            for _, _, data, offs in slices(rb.column("text")):
                r, h = shingles(data, offs, n)
                f = _print(h[_new_rows(r, h, seen)], parts)
                yield from packer.add((f >> U64(32)).astype(np.int32), f.astype(np.uint32))
        yield from packer.flush()

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], 0
        for rb in it:
            held += rb.column("f").to_pylist()
            part = rb.column("part")[0].as_py() if rb.num_rows else part
        f = np.sort(np.frombuffer(b"".join(held), np.uint32))
        at = run_starts(f)
        size = np.diff(np.append(at, len(f)))
        often = size > OFTEN
        yield pa.RecordBatch.from_arrays([pa.array(f[at[often]].astype(np.int64) + (part << 32)), pa.array(size[often])], names=["f", "n"])

    counted = deal(docs.select("text").mapInArrow(trimmed(emit), packed_schema(["f"])), parts).mapInArrow(trimmed(count), "f long, n long")
    top = counted.orderBy(F.desc("n"), "f").limit(FREQUENT).select("f").toArrow()
    return np.sort(np.asarray(top.column("f").combine_chunks(), dtype=np.int64)).view(U64) if top.num_rows else np.zeros(0, U64)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    """Blocks of columns: equal ranges of the hash range."""
    return ((h >> U64(32)) * U64(parts) >> U64(32)).astype(np.int32)


def _new_rows(r: np.ndarray, h: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which entries belong to rows whose class this task meets for the first time."""
    at, size, cls = _rows(r, h)
    new = np.zeros(len(at), dtype=bool)
    for i, c in enumerate(cls.tolist()):
        if c not in seen:
            seen.add(c)
            new[i] = True
    return np.repeat(new, size)


_POST = ["list", "cls", "n"]


def _postings(docs: DataFrame, n: int, num: int, den: int, parts: int) -> DataFrame:
    """Packed (list, cls, n): the columns of the prefix incidence that at least two classes share.

    n is a row's size in its lower 32 bits and above them the number of its n-grams that are not frequent.
    """
    spark = docs.sparkSession
    last = spark.sparkContext.broadcast(_frequent(docs, n, parts))  # 8 bytes each, at most FREQUENT of them

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(parts, ["h", "cls", "n"])
        seen: set[int] = set()
        hot = last.value
        for rb in it:
            for _, _, data, offs in slices(rb.column("text")):
                r, h = shingles(data, offs, n)
                new = _new_rows(r, h, seen)
                r, h = r[new], h[new]
                at, size, cls = _rows(r, h)
                if not len(at):
                    continue
                f = _print(h, min(parts, 1 << 16))
                is_hot = hot[np.minimum(np.searchsorted(hot, f), len(hot) - 1)] == f if len(hot) else np.zeros(len(h), bool)
                # rank in the global order (frequent ones last, then by hash) within the row
                colder = np.cumsum(~is_hot)
                colder -= np.repeat(colder[at] - ~is_hot[at], size)
                cold_in_row = np.repeat(np.add.reduceat((~is_hot).astype(np.int64), at), size)
                place = np.arange(len(h)) - np.repeat(at, size)
                rank = np.where(is_hot, cold_in_row + place - colder, colder - 1)
                take = rank < np.repeat(prefix_size(size, num, den), size)
                # how many n-grams are the row's own or nearly so: the hub of a group of copies should have few
                shape = np.repeat(size + (np.add.reduceat((~is_hot).astype(np.int64), at) << 32), size)
                yield from packer.add(_part(h[take], parts), h[take], np.repeat(cls, size)[take], shape[take])
        yield from packer.flush()

    def lists(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, cls, size = unpack(it, ["h", "cls", "n"], [U64, np.dtype("i8"), np.dtype("i8")])
        by = np.argsort(h)
        run = runs(h[by])
        by = by[np.bincount(run)[run] > 1] if len(run) else by
        h, cls, size = h[by], cls[by], size[by]
        by = np.lexsort((cls, h))
        h, cls, size = h[by], cls[by], size[by]
        by = run_starts(h, cls)
        h, cls, size = h[by], cls[by], size[by]
        run = runs(h)
        keep = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
        h, cls, size = h[keep], cls[keep], size[keep]
        packer = Packer(1, _POST, 1 << 62)
        list(packer.add(np.zeros(len(h), np.int32), h.view(np.int64), cls, size))
        yield from packer.flush()

    packed = docs.select("text").mapInArrow(trimmed(emit), packed_schema(["h", "cls", "n"]))
    return materialize(deal(packed, parts).mapInArrow(trimmed(lists), packed_schema(_POST)), "ngram-postings")


_PAIR = "a long, b long, na long, nb long, shared long"


def _counted(a, b, na, nb) -> pa.RecordBatch:
    """Pairs with how often each stands there, the smaller class first."""
    swap = a > b
    a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
    by = np.lexsort((b, a))
    at = run_starts(a[by], b[by])
    n = np.diff(np.append(at, len(by)))
    f = by[at]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[f], b[f], na[f], nb[f], n)], names=["a", "b", "na", "nb", "shared"])


def _fits(na, nb, num: int, den: int):
    """Size-derived: sets of these sizes can link."""
    return np.minimum(na, nb) * den >= np.maximum(na, nb) * num


def _above(pairs: DataFrame) -> DataFrame:
    """Adds the blocks' counts and discards pairs below the bound min(l(na), l(nb))."""
    total = pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("shared").alias("shared"))
    return total.where(F.col("shared") >= 1 + F.floor(F.least("na", "nb") / 16))


def _stars(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Products of each column's rows with its hubs: the HUBS rows with the fewest n-grams of their own for their size
    (the middle of a group of edited copies), of equal ones those of least mixed class."""

    def stars(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for i in range(rb.num_rows):
                key, cls, n = (np.frombuffer(rb.column(c)[i].as_py(), np.int64) for c in _POST)
                own, n = n >> 32, n & _SIZE
                by = np.lexsort((mix(cls.view(U64)), own / np.maximum(n, 1), key))
                key, cls, n = key[by], cls[by], n[by]
                at = run_starts(key)
                size = np.diff(np.append(at, len(key)))
                place = np.arange(len(key)) - np.repeat(at, size)
                got = []
                for k in range(HUBS):
                    hub = np.repeat(at, size) + k
                    on = np.flatnonzero(place > k)
                    on = on[_fits(n[on], n[hub[on]], num, den)]
                    got.append((hub[on], on))
                hub, on = (np.concatenate(x) for x in zip(*got, strict=True))
                if len(on):
                    yield _counted(cls[hub], cls[on], n[hub], n[on])

    return postings.mapInArrow(trimmed(stars), _PAIR)


def _unrolled(postings: DataFrame) -> DataFrame:
    """(list, cls, n, long) of each entry; long: whether its column is."""

    def unroll(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for i in range(rb.num_rows):
                key, cls, n = (np.frombuffer(rb.column(c)[i].as_py(), np.int64) for c in _POST)
                at = run_starts(key)
                size = np.diff(np.append(at, len(key)))
                cols = [key, cls, n & _SIZE, np.repeat(size > LONG, size), np.repeat(cls[at], size)]
                for a in range(0, len(key), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 16)]) for x in cols], names=["list", "cls", "n", "long", "head"])

    return postings.mapInArrow(trimmed(unroll), "list long, cls long, n long, long boolean, head long")


def _blocks(entries: DataFrame) -> DataFrame:
    """(cls, block): rows that long columns connect; block is the least class of each."""
    edges = entries.where("long and cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b")).distinct()
    return components(edges, "ngram-blocks").select(F.col("node").alias("cls"), F.col("component").alias("block"))


def _across(entries: DataFrame, joined: DataFrame, blocks: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """Products of short columns between rows that are not connected yet and stand in no common block.

    joined: (node, component).  Rows without a block count as a block of their own.
    """
    placed = entries.where("not long").join(joined.withColumnRenamed("node", "cls"), "cls", "left").join(blocks, "cls", "left")
    placed = placed.select("list", "cls", "n", F.coalesce("component", "cls").alias("component"), F.coalesce("block", "cls").alias("block"))
    # a column's rows come together in sorted order and stream by; none is gathered by key
    dealt = placed.repartition(parts, "list").sortWithinPartitions("list", "component", "cls")

    def pairs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None
        for rb in it:
            cols = tuple(np.asarray(rb.column(c)) for c in ("list", "cls", "n", "component", "block"))
            if rest is not None:
                cols = tuple(np.concatenate(x) for x in zip(rest, cols, strict=True))
            cut = int(np.searchsorted(cols[0] == cols[0][-1], True)) if len(cols[0]) else 0
            rest = tuple(x[cut:] for x in cols)
            yield from _cross_pairs(*(x[:cut] for x in cols), num, den)
        if rest is not None:
            yield from _cross_pairs(*rest, num, den)

    return dealt.mapInArrow(trimmed(pairs), _PAIR)


def _rows_of(asked: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(cls, grams): the full rows of the asked (doc_id, asked) classes, taken from their texts."""

    def full(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            ask = np.asarray(rb.column("asked"))
            for a, _, data, offs in slices(rb.column("text")):
                r, h = shingles(data, offs, n)
                at, size, cls = _rows(r, h)
                mine = [(c, h[s : s + k].tobytes()) for s, k, c in zip(at.tolist(), size.tolist(), cls.tolist(), strict=True) if ask[r[s] + a] == c]
                if mine:
                    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in mine], pa.int64()), pa.array([x for _, x in mine], pa.binary())], names=["cls", "grams"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(asked, "doc_id").select("asked", "text").mapInArrow(trimmed(full), "cls long, grams binary")


def _block_links(blocks: DataFrame, joined: DataFrame, classes: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(a, b): links inside the blocks, between components, as many as it takes to connect what links connect.

    Blocks that are one component already fall out first.  The rows of the others are put in tiles of about TILE: by size
    class (linked sets are in the same or in neighbouring ones) and by component where that fills tiles of its own.  Each pair of
    tiles that can hold a link between components is one product of full rows, with overlaps accumulated over the n-grams
    that both have; it gives at most one link a row.
    """
    base = np.log(den / num * 1.01)
    placed = blocks.join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    spans = placed.groupBy("block").agg(F.count("*").alias("n"), (F.min("component") < F.max("component")).alias("open"))
    spans = materialize(spans, "ngram-spans")
    if spans.where("open").isEmpty():
        return _no_links(docs)
    open_ = salted_join(placed, spans.where("open").select("block"), ["block"], "cls", hot_keys(spans, ["block"]))
    open_ = open_.join(classes, "cls").withColumn("level", F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(float(base))).cast("int"))
    open_ = materialize(open_.select("cls", "block", "component", "level", "doc_id"), "ngram-open")
    lots = materialize(open_.groupBy("block", "level", "component").agg(F.count("*").alias("n")), "ngram-lots")
    # components that fill tiles of their own, and all others of a level together
    own = lots.where(F.col("n") >= TILE // 2).select("block", "level", "component", F.ceil(F.col("n") / TILE).cast("int").alias("own"))
    rest = lots.where(F.col("n") < TILE // 2).groupBy("block", "level").agg(F.sum("n").alias("n"))
    hot_rest = hot_keys(rest, ["block", "level"])
    rest = rest.select("block", "level", F.ceil(F.col("n") / TILE).cast("int").alias("mixed"))
    rows = salted_join(open_, own, ["block", "level", "component"], "cls", hot_keys(lots, ["block", "level", "component"]), "left")
    rows = salted_join(rows, rest, ["block", "level"], "cls", hot_rest, "left")
    part = F.when(F.col("own").isNotNull(), F.pmod(F.xxhash64("cls"), F.col("own"))).otherwise(F.pmod(F.xxhash64("component"), F.col("mixed")))
    owner = F.when(F.col("own").isNotNull(), F.col("component"))
    rows = rows.withColumn("owner", owner).withColumn("tile", F.xxhash64("block", "level", F.coalesce("owner", F.lit(0)), F.col("own").isNull(), part))
    rows = materialize(rows.select("cls", "block", "component", "level", "doc_id", "owner", "tile"), "ngram-tiled")
    tiles = rows.groupBy("tile").agg(F.first("block").alias("block"), F.first("level").alias("level"), F.first("owner").alias("owner"))
    later = tiles.select(F.col("tile").alias("j"), "block", F.col("owner").alias("owner_j"), F.explode(F.array("level", F.col("level") - 1)).alias("level"), F.col("level").alias("level_j"))
    pairs = tiles.withColumnRenamed("tile", "i").join(later, ["block", "level"])
    pairs = pairs.where((F.col("level") < F.col("level_j")) | (F.col("i") <= F.col("j"))).where(F.col("owner").isNull() | F.col("owner_j").isNull() | (F.col("owner") != F.col("owner_j")))
    sides = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("tile"))
    wanted = materialize(rows.join(sides, "tile").select("cls", "component", "tile", "i", "j"), "ngram-wanted")
    asked = rows.join(wanted.select("cls").distinct(), "cls").select("doc_id", F.col("cls").alias("asked"))
    grams = _rows_of(asked, docs, n).dropDuplicates(["cls"])
    many = wanted.groupBy("cls").agg(F.count("*").alias("n"))
    full = salted_join(wanted, grams, ["cls"], "j", hot_keys(many, ["cls"]))

    def multiply(t: pa.Table) -> pa.Table:
        cls, comp, tile = (np.asarray(t.column(c).combine_chunks()) for c in ("cls", "component", "tile"))
        sets = [np.frombuffer(x.as_buffer(), U64) for x in t.column("grams").combine_chunks()]
        same = t.column("i")[0].as_py() == t.column("j")[0].as_py()
        a, b = tile_links(sets, comp, tile, same, num, den)
        return pa.table([pa.array(cls[a]), pa.array(cls[b])], names=["a", "b"])

    return full.groupBy("i", "j").applyInArrow(multiply, "a long, b long")


def tile_links(sets: list[np.ndarray], comp: np.ndarray, tile: np.ndarray, same: bool, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows (a, b) of a tile pair (of one tile where `same`) that connect components not yet connected."""
    if not sets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    gram = np.concatenate(sets)
    by = np.argsort(gram, kind="stable")
    col = runs(gram[by])
    shared = np.bincount(col)[col] > 1
    row, col = row[by][shared], col[shared]
    col = runs(col)
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    cuts = np.searchsorted(col, np.arange(0, (int(col[-1]) + 1 if len(col) else 0) + 2048, 2048))
    for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        part = np.zeros((len(sets), 2048), np.float32)
        part[row[s:e], col[s:e] - k * 2048] = 1
        overlap += part @ part.T
    least = num * (size[:, None] + size[None, :])
    hit = np.triu(overlap.astype(np.int64) * (num + den) >= least, 1) & (comp[:, None] != comp[None, :])
    if not same:
        hit &= tile[:, None] != tile[None, :]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    a, b = [], []
    for i, j in np.argwhere(hit).tolist():
        x, y = find(int(comp[i])), find(int(comp[j]))
        if x != y:
            parent[x] = y
            a.append(i)
            b.append(j)
    return np.array(a, np.int64), np.array(b, np.int64)


def _cross_pairs(key, cls, n, comp, block, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components and blocks within each run of keys (sorted by key and component), in bounded pieces."""
    if not len(key):
        return
    at = run_starts(key)
    size = np.diff(np.append(at, len(key)))
    several = comp[at] != comp[at + size - 1]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def flush() -> pa.RecordBatch | None:
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        ok = (comp[i] != comp[j]) & (block[i] != block[j]) & _fits(n[i], n[j], num, den)
        return _counted(cls[i[ok]], cls[j[ok]], n[i[ok]], n[j[ok]]) if ok.any() else None

    for m in np.unique(size[several]).tolist():
        first = at[several & (size == m)]
        x, y = np.triu_indices(m, 1)
        step = max(1, 200_000 // len(x))
        blocks = (((first[k : k + step, None] + x).ravel(), (first[k : k + step, None] + y).ravel()) for k in range(0, len(first), step))
        for b in blocks:
            held.append(b)
            count += len(b[0])
            if count >= 400_000:
                if (rb := flush()) is not None:
                    yield rb
                held, count = [], 0
    if held and (rb := flush()) is not None:
        yield rb


def _no_links(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(a, b) of the pairs whose full sets link.  Full rows of the classes that occur in pairs are taken from their texts."""
    if pairs.isEmpty():
        return _no_links(docs)
    asked = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct().join(classes, "cls").select("doc_id", F.col("cls").alias("asked"))

    sets = materialize(_rows_of(asked, docs, n), "ngram-rows")
    # a hub has many pairs: they are split, and its row goes to each split
    hot_a, hot_b = (hot_keys(pairs.groupBy(x).agg(F.count("*").alias("n")), [x]) for x in ("a", "b"))
    right = salted_join(pairs.select("a", "b"), sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb")), ["b"], "a", hot_b)
    both = salted_join(right, sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), ["a"], "b", hot_a).select("a", "b", "ga", "gb")

    def link(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            ok = np.zeros(rb.num_rows, dtype=bool)
            for i in range(rb.num_rows):
                x = np.frombuffer(rb.column("ga")[i].as_buffer(), U64)
                y = np.frombuffer(rb.column("gb")[i].as_buffer(), U64)
                z = np.concatenate([x, y])
                z.sort()
                both = int((z[1:] == z[:-1]).sum())
                ok[i] = both * den >= num * (len(z) - both)
            yield pa.RecordBatch.from_arrays([rb.column("a").filter(pa.array(ok)), rb.column("b").filter(pa.array(ok))], names=["a", "b"])

    out = materialize(both.mapInArrow(trimmed(link), "a long, b long"), "ngram-links")
    discard(sets)
    return out


def jaccard_components(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id, th, cls, component) for each row of docs (doc_id, text).

    Rows link whose sets of distinct n-word shingles have a Jaccard similarity of at least num / den (exactly);
    component_id is the smallest doc_id reachable by links, the row's own included.  th is xxhash64 of
    the text; cls names the row's set and component its group of sets.

    Null and wordless texts: no shingles, cls null, linked with nothing.  Rows without doc_id link with
    nothing and have component_id null.  Repeated rows, and rows of one doc_id with other texts, are rows of their
    own.  Other columns are ignored; an empty table gives an empty result.
    """
    parts = shuffle_parts(docs.sparkSession)
    signed = materialize(signatures(docs, n), "ngram-signatures")
    named = docs.where("doc_id is not null")
    classes = signed.where("doc_id is not null and cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("n"))
    classes = materialize(classes, "ngram-classes")
    first_docs = classes.select("cls", "doc_id")
    postings = _postings(named, n, num, den, parts)
    first = materialize(_above(_stars(postings, num, den)), "ngram-stars")
    links = _verified(first, named, first_docs, n, num, den)
    joined = components(links, "ngram-components")
    entries = _unrolled(postings)
    blocks = _blocks(entries)
    second = materialize(_above(_across(entries, joined, blocks, num, den, parts)).join(first, ["a", "b"], "left_anti"), "ngram-across")
    more = _verified(second, named, first_docs, n, num, den)
    inside = materialize(_block_links(blocks, joined, classes.drop("n"), named, n, num, den), "ngram-inside")
    # the first round's components stand where the second found nothing
    whole = joined if more.isEmpty() and inside.isEmpty() else components(links.union(more).union(inside), "ngram-components")
    # nothing that follows reads these any more
    for done in (postings, first, second, links, more, inside):
        discard(done)
    # sets that link with nothing are their own component
    linked = materialize(whole.withColumnRenamed("node", "cls").join(first_docs, "cls"), "ngram-linked")
    of = materialize(linked.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")), "ngram-of")
    by_class = salted_join(linked.select("cls", "component"), of.drop("n"), ["component"], "cls", hot_keys(of, ["component"]))
    by_class = first_docs.join(by_class, "cls", "left").select("cls", F.coalesce("component", "cls").alias("component"), F.coalesce("component_id", "doc_id").alias("component_id"))
    alone = F.col("doc_id").isNull()
    out = salted_join(signed, by_class, ["cls"], "doc_id", hot_keys(classes, ["cls"]), "left")
    return out.select("doc_id", "n_shingles", F.when(alone, None).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"), "th", "cls", "component")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id (one of its repeated rows).

    Rows without words or without doc_id belong to no group and all stay.
    """
    names = docs.columns
    found = jaccard_components(docs.select("doc_id", "text"), **options).where("cls is not null and doc_id = component_id")
    keep = found.groupBy("doc_id", "component").agg(F.min("th").alias("th")).select("doc_id", "th")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("__row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    free = rows.where("not worded or doc_id is null").select("__row")
    kept = rows.where("worded").join(keep, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]).select("__row")
    return kept.union(free).select("__row.*")

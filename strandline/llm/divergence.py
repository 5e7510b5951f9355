"""Divergence of sources from each other and of their terms from their language, counted behind a sketch.

A first pass over the texts adds each document's distinct terms to a count-min sketch per task; the sketches are merged cell by cell.
A cell never holds less than the number of documents of any term that falls on it, so a term one of whose cells stays below the
threshold cannot be kept: the second pass drops its occurrences before anything is shuffled.  What survives is counted exactly per
source and language.  Sources are compared by a join on the terms that both have; the terms that only one of them has are summed from
the number of its terms of each count, and those that neither has from their number alone, so zero counts are never written out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import LOWER, SLICE_BYTES, U64, deal, distinct_spans, materialize, mix, run_starts, seeds, shuffle_parts, slices, spans_hash, words

MIN_DOCS = 3
TOP = 200
UNIT = 1_000_000_000
#: Rows of the sketch.
DEPTH = 3
#: Cells of a row of the sketch: about 32 a document, a power of two between these.  A cell takes two bits, so the merged sketch that is
#: broadcast has 24 MB at most; where the terms outgrow it, it lets more of them through and the result stays the same.
WIDTH = (1 << 14, 1 << 25)
CELLS_A_DOCUMENT = 32
#: Cells stop counting here, so a higher threshold is filtered at this one.
FULL = 3
#: Cells of a row of the shuffle that merges sketches.
BLOCK = 1 << 16
#: Distinct terms, and entries of source and term, that a task holds before it gives them out.
TERMS, ENTRIES = 1 << 19, 1 << 22
#: Sources over all languages up to which their totals are broadcast; beyond that they are joined.
SOURCES = 1 << 16

#: Bytes that no term holds: ASCII other than letters.
APART = np.ones(256, dtype=bool)
APART[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_ROW = seeds(DEPTH, 1313)


def _parts(data: np.ndarray, offs: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A slice as it is; a longer text by about `limit` bytes at a time, cut where no term stands."""
    if len(offs) > 2 or len(data) <= 2 * limit:
        yield data, offs
        return
    a = 0
    while a < len(data):
        b = a + limit
        while b < len(data) and not APART[data[b : b + limit]].any():
            b += limit
        if b < len(data):
            b += int(APART[data[b : b + limit]].argmax())
        yield data[a:b], np.array([0, len(data[a:b])])
        a = b


def _distinct(keys: list[np.ndarray]) -> np.ndarray:
    return keys[0] if len(keys) == 1 else np.unique(np.concatenate(keys)) if keys else np.zeros(0, U64)


class Groups:
    """A task's numbers for the pairs of language and source of its rows, null as ''; a language alone is a group too."""

    def __init__(self) -> None:
        self.number: dict[tuple[str, str | None], int] = {}
        self.lang: list[str] = []
        self.source: list[str | None] = []

    def _of(self, lang: str, source: str | None) -> int:
        g = self.number.setdefault((lang, source), len(self.lang))
        if g == len(self.lang):
            self.lang.append(lang)
            self.source.append(source)
        return g

    def of(self, rb: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(group, group of the language) of each row."""
        lang, source = (rb.column(c).fill_null("").dictionary_encode() for c in ("lang", "source"))
        langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
        pair, at = np.unique(np.asarray(lang.indices).astype(np.int64) << 32 | np.asarray(source.indices), return_inverse=True)
        mine = np.array([self._of(langs[k >> 32], sources[k & 0xFFFFFFFF]) for k in pair.tolist()], np.int64)
        whole = np.array([self._of(langs[k >> 32], None) for k in pair.tolist()], np.int64)
        return mine[at], whole[at]


def seeds_of(rb: pa.RecordBatch) -> np.ndarray:
    """A number for the language of each row, null as ''."""
    d = rb.column("lang").fill_null("").dictionary_encode()
    each = [int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in d.dictionary.to_pylist()]
    return np.array(each, dtype=U64)[np.asarray(d.indices)] if each else np.zeros(0, U64)


class Sketch:
    """Count-min cells of DEPTH rows, which stop at FULL."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.cells = np.zeros(DEPTH * width, np.uint8)

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        for j in range(DEPTH):
            yield (mix(keys * _ROW[j]) & U64(self.width - 1)).astype(np.int64) + j * self.width

    def add(self, keys: np.ndarray) -> None:
        """One document for each of the keys."""
        for at in self.places(keys):
            at, n = np.unique(at, return_counts=True)
            self.cells[at] = np.minimum(self.cells[at] + np.minimum(n, FULL), FULL)

    def estimate(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), FULL, np.uint8)
        for at in self.places(keys):
            np.minimum(out, self.cells[at], out=out)
        return out


def pack(cells: np.ndarray) -> bytes:
    """Four cells a byte."""
    c = cells.reshape(-1, 4)
    return (c[:, 0] | c[:, 1] << 2 | c[:, 2] << 4 | c[:, 3] << 6).tobytes()


def unpack_cells(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    return np.stack([b >> s & 3 for s in (0, 2, 4, 6)], axis=1).reshape(-1)


def sketch_of(docs: DataFrame, width: int, limit: int = SLICE_BYTES) -> Sketch:
    """The merged sketch of documents a (lang, term), over all rows of docs (lang, text).

    Tasks merge the blocks that are dealt to them as these come in, so none holds more than its share of one sketch.
    """
    block = min(BLOCK, width)
    parts = min(shuffle_parts(docs.sparkSession), DEPTH * width // block)

    def gather(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(width)
        for rb in it:
            seed = seeds_of(rb)
            for a, b, data, offs in slices(rb.column("text"), limit):
                data = LOWER[data]
                mine = seed[a:b]
                keys, rows = [], mix(np.arange(b - a, dtype=U64))
                for some, at in _parts(data, offs, limit):
                    start, end, row = words(some, at, APART)
                    h = spans_hash(some, start, end)
                    _, one = np.unique(h ^ rows[row], return_index=True)
                    keys.append(mix(h[one] ^ mine[row[one]]))
                sketch.add(_distinct(keys))
        cells = sketch.cells.reshape(-1, block)
        on = np.flatnonzero(cells.any(axis=1))
        for i in range(0, len(on), 64):
            some = on[i : i + 64]
            yield pa.RecordBatch.from_arrays([pa.array(some % parts, pa.int32()), pa.array(some, pa.int32()), pa.array([pack(cells[k]) for k in some], pa.binary())], names=["part", "block", "cells"])

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for rb in it:
            for k, raw in zip(rb.column("block").to_pylist(), rb.column("cells").to_pylist(), strict=True):
                new = unpack_cells(raw)
                held[k] = np.minimum(held[k] + new, FULL) if k in held else new
        for k, cells in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(cells)], pa.binary())], names=["block", "cells"])

    merged = deal(docs.select("lang", "text").mapInArrow(gather, "part int, block int, cells binary"), parts).mapInArrow(merge, "block int, cells binary")
    out = Sketch(width)
    for r in merged.collect():  # DEPTH * width / 4 bytes at most
        out.cells[r.block * block : (r.block + 1) * block] = unpack_cells(bytes(r.cells))
    return out


def count_terms(docs: DataFrame, min_docs: int = MIN_DOCS, width: int | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """(lang, term, docs, counts array of (source, n)) for each term in at least min_docs documents of its language.

    docs: (lang, source, text), a row is a document.  Counts are exact: the sketch only leaves out what cannot be kept.
    """
    spark = docs.sparkSession
    if width is None:
        width = 1 << max(0, CELLS_A_DOCUMENT * docs.count() - 1).bit_length()
        width = min(max(width, WIDTH[0]), WIDTH[1])
    sketch = sketch_of(docs, width, limit)
    shared = spark.sparkContext.broadcast((width, pack(sketch.cells)))
    least = min(min_docs, FULL)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(shared.value[0])
        sketch.cells = unpack_cells(shared.value[1])
        groups = Groups()
        term: dict[bytes, int] = {}
        # an entry is a term's number and a group's: its occurrences there, or its documents where the group is a language
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            by = np.argsort(keys, kind="stable")
            at = run_starts(keys[by])
            return keys[by][at], np.add.reduceat(n[by], at)

        def out() -> Iterator[pa.RecordBatch]:
            keys, n = merged()
            number, group = keys >> 32, keys & 0xFFFFFFFF
            tongues = sorted(set(groups.lang))
            lang = np.array([tongues.index(x) for x in groups.lang])[group]
            by = np.lexsort((lang, number))
            number, group, lang, n = number[by], group[by], lang[by], n[by]
            texts, names, tongue = list(term), pa.array(groups.source, pa.string()), pa.array(tongues, pa.string())
            row = run_starts(number, lang)
            ends = np.append(row[1:], len(n))
            for i in range(0, len(row), 1 << 14):
                a, lo, hi = row[i : i + (1 << 14)], int(row[i]), int(ends[min(i + (1 << 14), len(row)) - 1])
                entry = pa.StructArray.from_arrays([names.take(pa.array(group[lo:hi])), pa.array(n[lo:hi], pa.int64())], names=["source", "n"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(a - lo, hi - lo).astype(np.int32)), entry)
                spelled = pa.array([texts[k].decode("utf-8", "replace") for k in number[a].tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([tongue.take(pa.array(lang[a])), spelled, lists], names=["lang", "term", "counts"])

        for rb in it:
            mine, whole = groups.of(rb)
            seed = seeds_of(rb)
            for a, b, data, offs in slices(rb.column("text"), limit):
                data = LOWER[data]
                seen = []
                for some, at in _parts(data, offs, limit):
                    start, end, row = words(some, at, APART)
                    on = sketch.estimate(mix(spans_hash(some, start, end) ^ seed[a:b][row])) >= least
                    start, end, row = start[on], end[on], row[on]
                    if not len(start):
                        continue
                    one, of = distinct_spans(some, start, end)
                    raw = some.tobytes()
                    number = np.array([term.setdefault(raw[x:y], len(term)) for x, y in zip(start[one].tolist(), end[one].tolist(), strict=True)], np.int64)[of]
                    held.append(np.unique(number << 32 | mine[a:b][row], return_counts=True))
                    seen.append(np.unique(number << 32 | row))
                    size += len(held[-1][0])
                if seen:
                    once = _distinct(seen)
                    held.append(np.unique(once >> 32 << 32 | whole[a:b][once & 0xFFFFFFFF], return_counts=True))
                    size += len(held[-1][0])
                if size >= ENTRIES:
                    held = [merged()]
                    size = len(held[0][0])
                if held and (size >= ENTRIES // 2 or len(term) >= TERMS):
                    yield from out()
                    term, held, size = {}, [], 0
        if held:
            yield from out()

    found = docs.select("lang", "source", "text").mapInArrow(count, "lang string, term string, counts array<struct<source:string,n:long>>")
    each = found.repartition("lang", "term").select("lang", "term", F.explode("counts").alias("c")).select("lang", "term", "c.source", "c.n")
    summed = each.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    whole = F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("docs")
    kept = summed.groupBy("lang", "term").agg(whole, F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n"))).alias("counts")).where(F.col("docs") >= min_docs)
    return materialize(kept, "divergence-terms")


def share(n: Column, all_: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / all_), by long division in two steps of 10^5 and 10^4, so that no product leaves a long."""
    x = (n + 1) * 100_000
    return 1 + F.call_function("div", x, all_) * 10_000 + F.call_function("div", (x % all_) * 10_000, all_)


def gain(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, width: int | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and which terms set it apart.

    docs: (lang, source, text); null counts as ''.  A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased; a language
    keeps the terms in at least min_docs of its documents (rows).  With N occurrences of its V kept terms, a group gives a term of which it has
    n the share p = 1 + floor(10^9 (n + 1) / (N + V)).  Part `pair`: item is another source of the language, value the sum of floor((p - q)^2 / q)
    over all kept terms, q being the other's share.  Part `term`: item is a kept term with a larger share here than in the language,
    value the same of these two; the first `top` ranks.  Ranks go by value, the largest first, then by item in bytes.

    A group without terms is compared like the others; a language without kept terms gives pairs of value 0; a source alone in its language has
    no pairs; an empty table gives no rows.  Repeated rows are documents of their own; other columns are ignored.  Counts are exact up to 9 * 10^13
    occurrences a language; each sum stays within a long as shares sum to 10^9 + V.
    """
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    terms = count_terms(docs, min_docs, width, limit)
    cells = terms.select("lang", "term", F.explode("counts").alias("c")).select("lang", "term", "c.source", "c.n")
    per = cells.groupBy("lang", "source").agg(F.sum("n").alias("occ"), F.count("*").alias("has"))
    tongues = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum(F.expr("aggregate(counts, 0L, (s, c) -> s + c.n)")).alias("all"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = docs.select("lang", "source").distinct().join(per, ["lang", "source"], "left").join(tongues, ["lang"], "left")
    groups = groups.select("lang", "source", zero("occ"), zero("has"), zero("v"), (zero("occ") + zero("v")).alias("d"), (zero("all") + zero("v")).alias("lang_d"))
    # the share of a term that the group does not have; without kept terms there is none
    groups = materialize(groups.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("d")))), "divergence-groups")
    few = groups.count() <= SOURCES

    def totals(side: str) -> DataFrame:
        g = groups.where("v > 0").select("lang", *[F.col(c).alias(f"{side}_{c}") for c in ("source", "d", "p0")])
        return F.broadcast(g) if few else g

    x, y = F.col("x"), F.col("y")
    # terms that two sources of a language have
    rest = F.expr("slice(counts, at + 2, size(counts))")
    both = terms.select("lang", "counts", F.posexplode("counts").alias("at", "x")).select("lang", "x", F.explode(rest).alias("y"))
    both = both.select("lang", x["source"].alias("a_source"), x["n"].alias("a_n"), y["source"].alias("b_source"), y["n"].alias("b_n"))
    both = both.join(totals("a"), ["lang", "a_source"]).join(totals("b"), ["lang", "b_source"])
    both = both.withColumns({"a_p": share(F.col("a_n"), F.col("a_d")), "b_p": share(F.col("b_n"), F.col("b_d"))})

    def more(s: str, o: str) -> Column:
        """What a term that both have adds to the sum from s to o beyond the three parts that follow."""
        c = {k: F.col(k) for k in (f"{s}_p", f"{o}_p", f"{s}_p0", f"{o}_p0")}
        return gain(c[f"{s}_p"], c[f"{o}_p"]) - gain(c[f"{s}_p"], c[f"{o}_p0"]) - gain(c[f"{s}_p0"], c[f"{o}_p"]) + gain(c[f"{s}_p0"], c[f"{o}_p0"])

    both = both.groupBy("lang", "a_source", "b_source").agg(F.sum(more("a", "b")).alias("ab"), F.sum(more("b", "a")).alias("ba"))
    both = both.select("lang", F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.col("ab").alias("value")), F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item"), F.col("ba").alias("value")))).alias("x")).select("lang", "x.*")
    # terms of one source against the share of what the other lacks, by how many terms it has of each count
    spread = cells.groupBy("lang", "source", "n").agg(F.count("*").alias("m")).withColumnRenamed("source", "a_source").join(totals("a"), ["lang", "a_source"])
    spread = spread.withColumn("p", share(F.col("n"), F.col("a_d"))).join(totals("b"), "lang").where("a_source <> b_source")
    p, a0, b0 = F.col("p"), F.col("a_p0"), F.col("b_p0")
    ways = F.array(
        F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item"), (F.col("m") * (gain(p, b0) - gain(a0, b0))).alias("value")),
        F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item"), (F.col("m") * (gain(b0, p) - gain(b0, a0))).alias("value")),
    )
    single = spread.select("lang", F.explode(ways).alias("x")).select("lang", "x.*").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # every pair, as if no term were in either
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = groups.join(F.broadcast(other) if few else other, "lang").where("source <> item").select("lang", "source", "item", F.coalesce(F.col("v") * gain(F.col("p0"), F.col("q0")), F.lit(0)).alias("value"))
    pairs = base.unionByName(single).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(best)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    # terms with a larger share than in the language
    known = groups.where("v > 0").select("lang", "source", "d", "lang_d")
    mine = terms.select("lang", F.col("term").alias("item"), F.expr("aggregate(counts, 0L, (s, c) -> s + c.n)").alias("lang_n"), F.explode("counts").alias("c")).select("lang", "item", "lang_n", "c.source", "c.n")
    mine = mine.join(F.broadcast(known) if few else known, ["lang", "source"])
    mine = mine.withColumns({"p": share(F.col("n"), F.col("d")), "q": share(F.col("lang_n"), F.col("lang_d"))}).where("p > q")
    mine = mine.select("lang", "source", "item", gain(F.col("p"), F.col("q")).alias("value")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pairs.unionByName(mine.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

"""Removal of repeated substrings over a sparse, distributed suffix order (deep-shallow sorting).

Every window of `length` bytes is owned by one anchor: the k-gram inside it with the least hash (the leftmost
such).  The consecutive windows that one anchor owns form a segment.  Equal windows own equal anchors at equal distances, so
suffixes can be sorted apart for each anchor: first one suffix per segment (from its first window to the end of its
last), which finds the segments that occur again as a whole; then, where an anchor still has several different
segments, the suffixes at all their windows.  Both are ordered by their bytes: multikey quicksort (three-way, on 8-byte
characters) to a shallow depth, then a blind trie for each group that still has a common prefix.

Segments travel in two steps: their names alone say which anchors stand in more than one; only those are then sent with
their bytes.  No anchor is gathered that has too many different segments: what each task would send is counted first, over
all documents, and segments of heavier anchors are cut into parts that share more bytes (first length - 8, and if that
is too many as well, the whole window).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import U64, deal, materialize, mix, prefix_hash, run_starts, runs, shuffle_parts, slices, span_hash, trimmed

LENGTH = 100
GRAM = 32
#: Bytes of texts whose windows a task hashes at once: some 100 bytes a byte.
SLICE = 1 << 20
SHALLOW = 32


@dataclass(frozen=True)
class Limits:
    """What bounds a task's state; results do not depend on it."""

    #: A name (anchor, or part of one) is heavy if tasks would send more segments of it than this and than one in `many`
    #: of all; so at most `many` names are heavy, and they are broadcast (8 bytes each).
    heavy: int = 512
    many: int = 1 << 20
    #: Neighbouring windows that a part of a heavy name's segment takes, level by level; the last are single windows.
    spreads: tuple[int, ...] = (9, 1)
    #: Segments that a task holds before it folds and sends them, and that a part of the shuffle holds on average.
    flush: int = 250_000
    #: Windows that are put in order at once.
    batch: int = 1 << 18


_POSITION = U64((1 << 24) - 1)
#: A shape is the number of windows + _LEAD * how far the anchor stands behind the first one.
_LEAD = 1 << 16

# ---------------------------------------------------------------- sorting


class BlindTrie:
    """A compact trie that stores branching depths and bytes only; a key is compared in full once, at its leaf.

    Keys are equally long byte strings.  Leaves hold the numbers of equal keys.
    """

    def __init__(self) -> None:
        self.root: list | None = None

    def insert(self, key: bytes, number: int) -> None:
        # a leaf is [None, key, numbers], an inner node [depth, {byte: child}]
        if self.root is None:
            self.root = [None, key, [number]]
            return
        node = self.root
        while node[0] is not None:
            kids = node[1]
            node = kids.get(key[node[0]]) or next(iter(kids.values()))
        if node[1] == key:
            node[2].append(number)
            return
        apart = int.from_bytes(node[1], "big") ^ int.from_bytes(key, "big")
        lcp = len(key) - (apart.bit_length() + 7) // 8
        other = node[1][lcp]
        parent, node = None, self.root
        while node[0] is not None and node[0] < lcp:
            parent, node = node, node[1][key[node[0]]]
        if node[0] == lcp:
            node[1][key[lcp]] = [None, key, [number]]
            return
        inner = [lcp, {other: node, key[lcp]: [None, key, [number]]}]
        if parent is None:
            self.root = inner
        else:
            parent[1][key[parent[0]]] = inner

    def classes(self) -> Iterator[list[int]]:
        """The numbers of each distinct key, in key order."""
        todo = [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if node[0] is None:
                yield node[2]
            else:
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]


def multikey_quicksort(raw: bytes, starts: np.ndarray, group: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the suffixes sorted within their group (group is ascending) by their first `shallow` bytes, and for
    each place whether it begins a group of equal ones.

    Every round splits all open groups three ways around a pivot (the median of three) at the group's own depth: less and
    greater stay at that depth, equal goes 8 bytes deeper.  shallow is a multiple of 8, and raw has as much after each start.
    """
    n = len(starts)
    order, new, depth = np.arange(n), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
    if not n:
        return order, new
    at = run_starts(group)
    new[at] = True
    eight = np.lib.stride_tricks.as_strided(np.frombuffer(raw, np.uint8), (max(0, len(raw) - 7), 8), (1, 1))
    size = np.diff(np.append(at, n))
    open_ = np.flatnonzero(np.repeat(size > 1, size)) if shallow else np.zeros(0, np.int64)
    while len(open_):
        at = np.flatnonzero(new[open_])
        size = np.diff(np.append(at, len(open_)))
        char = eight[starts[order[open_]] + depth[open_]].view(">u8").ravel().astype(U64)
        a, b, c = char[at], char[at + size // 2], char[at + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), size)
        less, same = char < pivot, char == pivot
        n_less, n_same = np.cumsum(less), np.cumsum(same)
        b_less, b_same = n_less[at] - less[at], n_same[at] - same[at]
        g_less, g_same = n_less[at + size - 1] - b_less, n_same[at + size - 1] - b_same
        n_less -= np.repeat(b_less, size)
        n_same -= np.repeat(b_same, size)
        here = np.repeat(at, size)
        rank = np.where(less, n_less - 1, np.where(same, np.repeat(g_less, size) + n_same - 1, np.repeat(g_less + g_same, size) + np.arange(len(open_)) - here - n_less - n_same))
        to = here + rank
        moved = np.empty_like(open_)
        moved[to] = order[open_]
        order[open_] = moved
        deeper = np.zeros(len(open_), dtype=bool)
        deeper[to[same]] = True
        depth[open_[deeper]] += 8
        new[open_[at + g_less]] = True
        over = g_less + g_same < size
        new[open_[(at + g_less + g_same)[over]]] = True
        at = np.flatnonzero(new[open_])
        size = np.diff(np.append(at, len(open_)))
        open_ = open_[np.repeat(size > 1, size) & (depth[open_] < shallow)]
    return order, new


def deep_shallow(raw: bytes, starts: np.ndarray, group: np.ndarray, length: int | np.ndarray = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the suffixes at `starts`, cut to `length` bytes (one number, or one each that is the same
    throughout a group), sorted within their group (group is ascending), and for each place in the order whether it
    begins a new group or differs from the one before.
    """
    n = len(starts)
    lens = np.broadcast_to(np.asarray(length, dtype=np.int64), n)
    shallow = min(shallow, int(lens.min()) if n else 0) // 8 * 8
    order, new = multikey_quicksort(raw, starts, group, shallow)
    a = np.flatnonzero(new)
    b = np.append(a[1:], n)
    for a, b in zip(a[b - a > 1].tolist(), b[b - a > 1].tolist(), strict=True):  # noqa: B020
        members = order[a:b]
        size = int(lens[members[0]])
        keys = [raw[s + shallow : s + size] for s in starts[members].tolist()]
        if keys.count(keys[0]) == len(keys):
            continue  # a trie of one leaf
        trie = BlindTrie()
        for key, m in zip(keys, members.tolist(), strict=True):
            trie.insert(key, m)
        at = a
        for same in trie.classes():
            new[at] = True
            order[at : at + len(same)] = same
            at += len(same)
    return order, new


# ---------------------------------------------------------------- segments of a text


def segments(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first window, number of windows, name of the anchor, lead, digest) of each segment; windows count from the row's
    start, lead is how far the anchor stands behind the first window.  A window lies inside one row.  The digest (of a
    segment's bytes) serves to estimate loads only.
    """
    out = []
    step = SLICE
    pieces = [(0, len(data))] if len(data) <= 2 * step else [(a, min(len(data), a + step + length - 1)) for a in range(0, max(1, len(data) - length + 1), step)]
    for lo, hi in pieces:
        d = data[lo:hi]
        n = len(d) - length + 1
        if n <= 0:
            continue
        p = prefix_hash(d)
        i = np.arange(len(d) - gram + 1)
        h = span_hash(p, i, i + gram)
        low = (h & ~_POSITION) | i.astype(U64)
        w, have = length - gram + 1, 1
        while have * 2 <= w:
            low = np.minimum(low[: len(low) - have], low[have:])
            have *= 2
        if have < w:
            low = np.minimum(low[: len(low) - (w - have)], low[w - have :])
        start = np.arange(n)
        row = np.searchsorted(offs, start + lo, "right") - 1
        fine = start + lo + length <= offs[row + 1]
        start, row, anchor = start[fine], row[fine], (low[:n][fine] & _POSITION).astype(np.int64)
        if not len(start):
            continue
        at = run_starts(anchor, row)
        s1 = start[at]
        s2 = start[np.append(at[1:], len(start)) - 1]
        # anchors have the least hashes of all; mixed again, their names spread over the whole range
        out.append((row[at], s1 + lo - offs[row[at]], s2 - s1 + 1, mix(h[anchor[at]] + U64(1)), anchor[at] - s1, span_hash(p, s1, s2 + length)))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U64), z, np.zeros(0, U64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Segments:
    """Segments in document order: name (of the anchor, or of what shares more bytes), document, place, shape, and where their
    bytes stand in raw."""

    def __init__(self, raw: bytes, length: int, name, doc, th, pos, shape, start, ordered: bool = False) -> None:
        by = slice(None) if ordered else np.lexsort((pos, th, doc))
        self.raw, self.length = raw, length
        self.name, self.doc, self.th, self.pos, self.shape, self.start = (x[by] for x in (name, doc, th, pos, shape, start))

    @property
    def windows(self) -> np.ndarray:
        return self.shape % _LEAD

    def at(self, pick: np.ndarray) -> Segments:
        return Segments(self.raw, self.length, *(x[pick] for x in (self.name, self.doc, self.th, self.pos, self.shape, self.start)), ordered=True)

    def fold(self) -> np.ndarray:
        """For each segment the first one (in document order) of equal name, shape and bytes, through their suffix order."""
        by = np.lexsort((self.shape, self.name))
        order, new = deep_shallow(self.raw, self.start[by], runs(self.name[by], self.shape[by]), self.windows[by] + self.length - 1)
        x, at = by[order], np.flatnonzero(new)
        first = np.empty(len(x), np.int64)
        if len(x):
            first[x] = np.repeat(np.minimum.reduceat(x, at), np.diff(np.append(at, len(x))))
        return first

    def parts(self, spread: int) -> Segments:
        """The segments cut where their windows' distance to the anchor leaves a range of `spread` distances; the bytes that all
        windows of the range have in common name each part.  Equal windows have equal distances and so equal names."""
        n, lead = self.windows, self.shape // _LEAD
        seg = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
        r = (lead[seg] - k) // spread
        at = run_starts(seg, r)
        s, first, r = seg[at], k[at], r[at]
        count = np.diff(np.append(at, len(seg)))
        core, size = self.start[s] + lead[s] - r * spread, self.length - spread + 1
        common = np.empty(len(s), U64)
        for a in range(0, len(s), 1 << 14):
            some = core[a : a + (1 << 14)].tolist()
            at = np.arange(len(some)) * size
            common[a : a + len(some)] = span_hash(prefix_hash(np.frombuffer(b"".join([self.raw[x : x + size] for x in some]), np.uint8)), at, at + size)
        name = mix(common ^ mix(self.name[s] + (r * 64 + spread).astype(U64)))
        return Segments(self.raw, self.length, name, self.doc[s], self.th[s], self.pos[s] + first, count + _LEAD * (lead[s] - first), self.start[s] + first, ordered=True)

    def repeated_windows(self, batch: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(doc, th, lo, hi) of the bytes in windows that an earlier segment of the name has too.

        The suffixes at all windows are sorted by name and distance to the anchor, at most about `batch` at once; of a name
        with more windows some distances at a time.
        """
        by = np.argsort(self.name, kind="stable")
        group = runs(self.name[by])
        by = by[np.bincount(group)[group] > 1] if len(by) else by
        if not len(by):
            return
        at = run_starts(self.name[by])
        ends = np.append(at[1:], len(by))
        total = np.cumsum(self.windows[by])
        a = 0
        while a < len(at):
            before = total[at[a] - 1] if at[a] else 0
            b = max(a + 1, int(np.searchsorted(total[ends - 1], before + batch, "right")))
            mine = by[at[a] : ends[b - 1]]
            step = _LEAD if total[ends[b - 1] - 1] - before <= batch else max(1, batch // len(mine))
            for lo in range(0, int((self.shape[mine] // _LEAD).max()) + 1, step):
                yield from self._late(mine, lo, lo + step)
            a = b

    def _late(self, mine: np.ndarray, lo: int, hi: int) -> Iterator[tuple[np.ndarray, ...]]:
        """repeated_windows() of some names, of windows whose distance to the anchor is in [lo, hi)."""
        lead = self.shape[mine] // _LEAD
        first, last = np.maximum(0, lead - hi + 1), np.minimum(self.windows[mine], lead - lo + 1)
        n = np.maximum(0, last - first)
        seg = np.repeat(np.arange(len(mine)), n)
        k = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n) + first[seg]
        key = runs(self.name[mine])[seg] * _LEAD + lead[seg] - k
        by = np.argsort(key, kind="stable")
        group = runs(key[by])
        several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        by, group = by[several], group[several]
        seg, k = mine[seg[by]], k[by]
        order, new = deep_shallow(self.raw, self.start[seg] + k, group, self.length)
        at = np.flatnonzero(new)
        if not len(at):
            return
        x = seg[order]
        late = order[x > np.repeat(np.minimum.reduceat(x, at), np.diff(np.append(at, len(x))))]
        late = late[np.lexsort((k[late], seg[late]))]
        s, k = seg[late], k[late]
        if len(s):
            new = np.append(True, (s[1:] != s[:-1]) | (k[1:] != k[:-1] + 1))
            at = np.flatnonzero(new)
            end = np.append(at[1:], len(s)) - 1
            yield self.doc[s[at]], self.th[s[at]], self.pos[s[at]] + k[at], self.pos[s[at]] + k[end] + self.length


# ---------------------------------------------------------------- packed rows: (part, kind, n, size, blob)

_PACKED = "part int, kind int, n int, size long, blob binary"
_PACKED_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("size", pa.int64()), ("blob", pa.binary())])
_SEGMENT = [np.dtype("u4"), np.dtype("i8"), np.dtype("i8"), np.dtype("i4"), np.dtype("u4")]
_RUN = [np.dtype("i8")] * 4


def _pack(kind: int, part: np.ndarray, cols: list[np.ndarray], raw: bytes = b"", start: np.ndarray | None = None, size: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row per part with the columns of its entries one after the other, and after them the entries' bytes."""
    if not len(part):
        return
    by = np.argsort(part, kind="stable")
    at = run_starts(part[by])
    ends = np.append(at[1:], len(by))
    rows: list[tuple] = []
    for a, b in zip(at.tolist(), ends.tolist(), strict=True):
        mine = by[a:b]
        blob = b"".join([c[mine].tobytes() for c in cols])
        if start is not None:
            blob += b"".join([raw[s : s + n] for s, n in zip(start[mine].tolist(), size[mine].tolist(), strict=True)])
        rows.append((int(part[mine[0]]), kind, b - a, len(blob), pa.compress(blob, "zstd", asbytes=True)))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PACKED_SCHEMA.types, strict=True)], schema=_PACKED_SCHEMA)


def _unpack(rows: list[tuple[int, int, bytes]], types: list[np.dtype]) -> tuple[list[np.ndarray], bytes]:
    """The columns of all rows' entries and their bytes."""
    cols: list[list[np.ndarray]] = [[] for _ in types]
    rest = []
    for n, size, blob in rows:
        raw = pa.decompress(blob, size, "zstd", asbytes=True)
        o = 0
        for c, t in zip(cols, types, strict=True):
            c.append(np.frombuffer(raw, t, n, o))
            o += n * t.itemsize
        rest.append(raw[o:])
    return [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(cols, types, strict=True)], b"".join(rest)


def _doc_part(doc: np.ndarray, th: np.ndarray, parts: int) -> np.ndarray:
    return (mix(doc.astype(U64) * U64(3) + th.astype(U64)) % U64(parts)).astype(np.int32)


def _name_part(name: np.ndarray, parts: int) -> np.ndarray:
    return ((name >> U64(32)) * U64(parts) >> U64(32)).astype(np.int32)


def _pack_runs(doc, th, lo, hi, parts: int) -> Iterator[pa.RecordBatch]:
    yield from _pack(1, _doc_part(doc, th, parts), [x.astype(np.int64) for x in (doc, th, lo, hi)])


def _flushes(it: Iterator[pa.RecordBatch], length: int, gram: int, flush: int) -> Iterator[Segments]:
    """The segments of a task's rows, about `flush` at a time."""
    held: list[tuple] = []
    texts: list[bytes] = []
    count = size = 0

    def out() -> Segments:
        return Segments(b"".join(texts), length, *(np.concatenate(x) for x in zip(*held, strict=True)))

    for rb in it:
        ids, ths = np.asarray(rb.column("doc_id")), np.asarray(rb.column("th"))
        for a, _, data, offs in slices(rb.column("text"), SLICE):
            row, pos, n, anchor, lead, _ = segments(data, offs, length, gram)
            if len(row):
                held.append((anchor, ids[row + a], ths[row + a], pos, n + _LEAD * lead, offs[row] + pos + size))
                texts.append(data.tobytes())
                count, size = count + len(row), size + len(data)
            if count >= flush:
                yield out()
                held, texts, count, size = [], [], 0, 0
    if held:
        yield out()


def _folded(s: Segments, heavy: list[np.ndarray], spreads: tuple[int, ...]) -> Iterator[tuple[Segments, Segments | None]]:
    """(segments that are first in s, their later equals): all of s, those of heavy names in parts."""
    for spread, names in zip((*spreads, None), (*heavy, None), strict=False):
        first = s.fold()
        lead = first == np.arange(len(first))
        if names is None or not len(names):
            yield s.at(lead), s.at(~lead)
            return
        on = np.isin(s.name, names)
        yield s.at(lead & ~on), s.at(~lead & ~on)
        # later equals of a heavy name are late as a whole; only first ones are cut
        yield s.at(np.zeros(0, np.int64)), s.at(~lead & on)
        s = s.at(lead & on).parts(spread)


def _heavy(base: DataFrame, length: int, gram: int, known: list[np.ndarray], parts: int, limits: Limits) -> tuple[np.ndarray, int]:
    """(names of which tasks would send too many segments, number of segments in all), given the heavy names before."""

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if known:
            for s in _flushes(it, length, gram, limits.flush):
                s = s.at(np.isin(s.name, known[0]))
                *_, (first, _) = _folded(s, known, limits.spreads)
                yield from _pack(0, _name_part(first.name, parts), [first.name])
            return
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            name, digest = (np.concatenate(x) for x in zip(*held, strict=True))
            by = np.lexsort((digest, name))
            name = name[by[run_starts(name[by], digest[by])]]
            yield from _pack(0, _name_part(name, parts), [name])

        for rb in it:
            for _, _, data, offs in slices(rb.column("text"), SLICE):
                *_, name, _, digest = segments(data, offs, length, gram)
                held.append((name, digest))
                n += len(name)
                if n >= limits.flush:
                    yield from out()
                    held, n = [], 0
        if n:
            yield from out()

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (name,), _ = _unpack(_rows(it, 0), [np.dtype("u8")])
        name = np.sort(name)
        at = run_starts(name)
        n = np.diff(np.append(at, len(name)))
        # what is not heavy counts into the total only
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([len(name)])], names=["name", "n"])
        if (n > limits.heavy).any():
            yield pa.RecordBatch.from_arrays([pa.array(name[at[n > limits.heavy]].view(np.int64)), pa.array(n[n > limits.heavy])], names=["name", "n"])

    counted = materialize(deal(base.select("doc_id", "th", "text").mapInArrow(trimmed(emit), _PACKED), parts).mapInArrow(trimmed(count), "name long, n long"), "suffix-heavy")
    total = counted.where("name is null").agg(F.sum("n")).first()[0] or 0
    top = counted.where(F.col("name").isNotNull() & (F.col("n") > max(limits.heavy, total // limits.many))).select("name").toArrow()
    return np.sort(np.asarray(top.column("name").combine_chunks(), dtype=np.int64).view(U64)) if top.num_rows else np.zeros(0, U64), total


def _rows(it: Iterator[pa.RecordBatch], kind: int) -> list[tuple[int, int, bytes]]:
    return [(n, s, b) for rb in it for k, n, s, b in zip(*(rb.column(c).to_pylist() for c in ("kind", "n", "size", "blob")), strict=True) if k == kind]


def repeated_spans(base: DataFrame, length: int = LENGTH, gram: int = GRAM, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, th, lo binary, hi binary): for each document with repeats its maximal byte runs [lo, hi) to remove,
    as int64 arrays.  base: (doc_id, th, text), th names the text; other columns do no harm.  See dedup_substrings().

    The result is joined with base on (doc_id, th) once more; both joins then use one shuffle of base.
    """
    spark = base.sparkSession
    own = base.where("doc_id is not null").select("doc_id", "th", "text")
    names, total = _heavy(own, length, gram, [], shuffle_parts(spark), limits)
    known = [names]
    # a task's share is about limits.flush segments, whatever the session's number of partitions
    parts = max(shuffle_parts(spark), -(-total // limits.flush))
    while len(names) and len(known) < len(limits.spreads):
        names, _ = _heavy(own, length, gram, known, parts, limits)
        known.append(names)
    heavy = spark.sparkContext.broadcast(known)  # at most limits.many names a level

    # kind 0: segments without their bytes, dealt by name; kind 1: runs known as repeated inside the task, dealt by document
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _flushes(it, length, gram, limits.flush):
            for first, late in _folded(s, heavy.value, limits.spreads):
                yield from _pack_runs(late.doc, late.th, late.pos, late.pos + late.windows + (length - 1), parts)
                yield from _pack(0, _name_part(first.name, parts), _columns(first.name, first.doc, first.th, first.pos, first.shape))

    # kind 1 as above; kind 2: the segments whose names others have too, dealt by document
    def share(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, me = [], 0
        for rb in it:
            kind = np.asarray(rb.column("kind"))
            if (kind == 1).any():
                yield rb.filter(pa.array(kind == 1))
            if (kind == 0).any():
                me = rb.column("part")[int(np.argmax(kind == 0))].as_py()
                mine += _rows(iter([rb]), 0)
        (name, doc, th, pos, shape), _ = _unpack(mine, _SEGMENT)
        by = np.argsort(name, kind="stable")
        group = runs(name[by])
        by = by[np.bincount(group)[group] > 1] if len(by) else by
        full = name[by].astype(np.int64) | (np.int64(me) << 32)
        yield from _pack(2, _doc_part(doc[by], th[by], parts), [full, doc[by], th[by], pos[by].astype(np.int64), shape[by].astype(np.int64)])

    held = materialize(deal(own.mapInArrow(trimmed(cut), _PACKED), parts).mapInArrow(trimmed(share), _PACKED), "suffix-shared")

    def asked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (name, doc, th, pos, shape), _ = _unpack(_rows(it, 2), [np.dtype("i8")] * 5)
        by = np.lexsort((pos, th, doc))
        name, doc, th, pos, shape = (x[by] for x in (name, doc, th, pos, shape))
        at = run_starts(doc, th)
        ends = np.append(at[1:], len(doc))
        for i in range(0, len(at), 4096):
            rows = [(doc[a], th[a], np.concatenate([name[a:b], pos[a:b], shape[a:b]]).tobytes()) for a, b in zip(at[i : i + 4096].tolist(), ends[i : i + 4096].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "th", "segs"])

    requests = deal(held.where("kind = 2"), parts).mapInArrow(trimmed(asked), "doc_id long, th long, segs binary")

    # the segments that documents are asked for, with their bytes, dealt by name
    def fetch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list[np.ndarray]] = [[] for _ in range(6)]
        texts: list[bytes] = []
        n = size = 0

        def out() -> Iterator[pa.RecordBatch]:
            name, doc, th, pos, shape, start = (np.concatenate(c) for c in cols)
            yield from _pack(0, (name >> 32).astype(np.int32), _columns(name.astype(U64), doc, th, pos, shape), b"".join(texts), start, shape % _LEAD + length - 1)

        for rb in it:
            rb = rb.filter(rb.column("segs").is_valid())
            for i in range(rb.num_rows):
                name, pos, shape = np.frombuffer(rb.column("segs")[i].as_buffer(), np.int64).reshape(3, -1)
                text = rb.column("text")[i].as_py().encode()
                for c, x in zip(cols, (name, np.full(len(name), rb.column("doc_id")[i].as_py()), np.full(len(name), rb.column("th")[i].as_py()), pos, shape, pos + size), strict=True):
                    c.append(x)
                texts.append(text)
                n, size = n + len(name), size + len(text)
                if n >= limits.flush or size >= 1 << 25:
                    yield from out()
                    cols, texts, n, size = [[] for _ in range(6)], [], 0, 0
        if n:
            yield from out()

    found = base.join(requests, ["doc_id", "th"], "left").mapInArrow(trimmed(fetch), _PACKED)

    def sort(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (name, doc, th, pos, shape), raw = _unpack(_rows(it, 0), _SEGMENT)
        name, pos, shape = name.astype(U64), pos.astype(np.int64), shape.astype(np.int64)
        start = np.cumsum(shape % _LEAD + length - 1) - (shape % _LEAD + length - 1)
        # a repeated row of documents brings its segments again
        by = np.lexsort((pos, th, doc, name))
        by = by[run_starts(name[by], doc[by], th[by], pos[by])]
        s = Segments(raw, length, *(x[by] for x in (name, doc, th, pos, shape, start)))
        lead = s.fold()
        lead = lead == np.arange(len(lead))
        late = s.at(~lead)
        yield from _pack_runs(late.doc, late.th, late.pos, late.pos + late.windows + (length - 1), parts)
        for run in s.at(lead).repeated_windows(limits.batch):
            yield from _pack_runs(*run, parts)

    def merged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (doc, th, lo, hi), _ = _unpack(_rows(it, 1), _RUN)
        order = np.lexsort((lo, th, doc))
        doc, th, lo, hi = (x[order] for x in (doc, th, lo, hi))
        if not len(doc):
            return
        at = run_starts(doc, th)
        ends = np.append(at[1:], len(doc))
        rows = []
        for a, b in zip(at.tolist(), ends.tolist(), strict=True):
            reach = np.maximum.accumulate(hi[a:b])
            gap = np.flatnonzero(lo[a + 1 : b] > reach[:-1]) + 1
            rows.append((doc[a], th[a], lo[a:b][np.append(0, gap)].tobytes(), reach[np.append(gap - 1, b - a - 1)].tobytes()))
            if len(rows) == 4096:
                yield _spans(rows)
                rows = []
        if rows:
            yield _spans(rows)

    sorted_runs = deal(found, parts).mapInArrow(trimmed(sort), _PACKED)
    return deal(held.where("kind = 1").union(sorted_runs), parts).mapInArrow(trimmed(merged), "doc_id long, th long, lo binary, hi binary")


def _columns(name, doc, th, pos, shape) -> list[np.ndarray]:
    """A segment's columns as they travel; of the name the part keeps what is cut off here."""
    return [x.astype(t) for x, t in zip((name & U64(0xFFFFFFFF), doc, th, pos, shape), _SEGMENT, strict=True)]


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    d, t, lo, hi = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(lo, pa.binary()), pa.array(hi, pa.binary())], names=["doc_id", "th", "lo", "hi"])


def dedup_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_text: bool = True, keep: tuple[str, ...] = (), limits: Limits = Limits()) -> DataFrame:
    """docs' rows as (doc_id, text, n_bytes, n_removed, n_spans, kept_sha256, *keep) with repeated bytes removed.

    A byte goes if it lies in a string of `length` bytes that also starts earlier: in a document of
    smaller doc_id, or earlier in the same one; strings are judged on the input.  text holds what is left, where
    a character that lost only some of its bytes is kept whole (a removal ends at whole characters), while the
    other columns count bytes exactly; keep_text=False leaves text out.

    Null text: empty.  Rows without doc_id are returned as they are and serve no other row.  Rows of one
    doc_id with different texts count as documents of their own, in order of a hash of the text; repeated
    equal rows (doc_id and text) all get the result of one.  Other columns are ignored but for those named
    in keep (names of result columns excepted); an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    names = [c for c in keep if c not in _OUT.names]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"), *(F.col(c).alias(f"__keep_{c}") for c in names))
    joined = base.join(repeated_spans(base, length, gram, limits), ["doc_id", "th"], "left")

    def apply(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a in range(0, rb.num_rows, 256):
                out = []
                for doc_id, text, lo, hi in zip(*(rb.slice(a, 256).column(c).to_pylist() for c in ("doc_id", "text", "lo", "hi")), strict=True):
                    raw = text.encode()
                    los, his = (np.frombuffer(x or b"", np.int64).tolist() for x in (lo, hi))
                    kept, at = [], 0
                    for s, e in zip(los, his, strict=True):
                        kept.append(raw[at:s])
                        at = e
                    kept.append(raw[at:])
                    left = whole_characters(raw, los, his) if keep_text else None
                    out.append((doc_id, left, len(raw), sum(his) - sum(los), len(los), hashlib.sha256(b"".join(kept)).hexdigest()))
                cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _OUT.types, strict=True)]
                yield pa.RecordBatch.from_arrays(cols + [rb.slice(a, 256).column(f"__keep_{c}") for c in names], names=_OUT.names + names)

    kinds = dict(docs.dtypes)
    return joined.mapInArrow(trimmed(apply), "doc_id long, text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + "".join(f", `{c}` {kinds[c]}" for c in names))


_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def whole_characters(raw: bytes, los: list[int], his: list[int]) -> str:
    """raw without the runs, each shortened to whole UTF-8 characters."""
    kept, at = [], 0
    for s, e in zip(los, his, strict=True):
        while s < e and raw[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
            e -= 1
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return b"".join(kept).decode()

"""Sampled SentencePiece encoding: forward filtering, backward sampling over the piece lattice.

The lattice of a text has an arc for each vocabulary piece that fits at a place, and a byte-fallback arc for
each character that is no piece itself.  A segmentation is drawn with probability proportional to the
product of its arcs' weights: forward sums are filtered left to right, then arcs are drawn right to left with
numbers hashed from a seed, the row key and the place, so a row's segmentation does not depend on how rows are
batched.  No piece crosses from a letter to a following blank, so the lattice falls apart into chunks (a run of
blanks and the word after it); forward sums are taken once for each distinct chunk of a slice.  A long chunk, as of a script without
blanks, falls apart further at the places that no piece crosses: every path goes through them, so the parts are drawn apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import U64, mix, seeds, slices, trimmed

#: The vocabulary file where the session does not name another one.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_SETTING = "strandline.pieces.model"
THETA = 0.5
SEED = 9
#: log weight of a fallback byte
BYTE = -14.0
BLANK = 0x2581
#: stands for a literal U+2581 in a text, which no piece may match
LITERAL = 0x110000
SLICE = 1 << 20
#: Characters of a chunk beyond which it is looked for places that no piece crosses; characters that are looked at once.
LONG = 512
WINDOW = 1 << 16

_B = 0xD1342543DE82EF95 | 1
_INV = pow(_B, -1, 1 << 64)
_MUL = seeds(3, 99)


def _powers(n: int, base: int) -> np.ndarray:
    a = np.full(max(n, 1), base, dtype=U64)
    a[0] = 1
    return np.multiply.accumulate(a)


class Pieces:
    """A vocabulary with byte fallback: pieces by hash, their weights, and what each decodes to.

    Weights: a merge vocabulary has ranks, not probabilities; piece number r from the start of the merges has
    log weight -theta * log(r + 2) (Zipf's law).
    """

    def __init__(self, path: str = MODEL, theta: float = THETA) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_id = np.full(256, -1, np.int64)
        self.out: list[bytes] = []
        strings, ids = [], []
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.out.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.out.append(b"")
            else:
                self.out.append(p.replace("▁", " ").encode())
                strings.append(p)
                ids.append(i)
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary has no byte fallback")
        ids_ = np.array(ids)
        self.longest = max(map(len, strings))
        low = ids_.min()
        h = np.array([int(self._hash_of(s)) for s in strings], dtype=U64)
        by = np.argsort(h)
        self.hash, self.id = h[by], ids_[by]
        if len(np.unique(h)) != len(h):
            raise ValueError("two pieces share a hash")
        self.logw = -theta * np.log(self.id - low + 2.0)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hash & U64((1 << 20) - 1)).astype(np.int64)] = True
        self.theta = theta

    @staticmethod
    def _hash_of(s: str) -> np.uint64:
        cp = np.frombuffer(s.encode("utf-32-le"), np.uint32)
        v = mix(cp.astype(U64)) * _powers(len(cp), _B)
        return mix(np.array([v.sum(dtype=U64) + U64(len(cp))], dtype=U64))[0]

    def fallback(self, cp: int) -> list[int]:
        if cp == LITERAL:
            raw = "▁".encode()
        elif cp == BLANK:
            raw = b" "
        else:
            raw = chr(cp).encode("utf-8", "surrogateescape")
        return [int(self.byte_id[b]) for b in raw]

    # ---------------------------------------------------------------- encoding

    def uncrossed(self, s: np.ndarray) -> np.ndarray:
        """Places inside a chunk s, a window at a time, that no piece crosses."""
        out = []
        for a in range(0, len(s), WINDOW):
            lo, hi = max(0, a - self.longest), min(len(s), a + WINDOW + self.longest)
            end, begin, _, _ = self.lattice(s[lo:hi], np.array([0]), np.array([hi - lo]))
            over = np.bincount(begin + 1, minlength=hi - lo + 2) - np.bincount(end, minlength=hi - lo + 2)
            free = np.flatnonzero(np.cumsum(over)[: hi - lo] == 0) + lo
            out.append(free[(free >= max(a, 1)) & (free < a + WINDOW)])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def lattice(self, s: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """Arcs of chunks s[first : first + length]: (end place, begin place, id or -1, log weight), sorted by end."""
        n = len(s)
        pw, inv = _powers(n + 1, _B), _powers(n + 1, _INV)
        p = np.zeros(n + 1, dtype=U64)
        np.cumsum(mix(s.astype(U64)) * pw[:n], out=p[1:])
        room = np.arange(n) - np.repeat(first, length) + 1  # characters of the chunk up to and with this one
        end, begin, num, w = [], [], [], []
        known = np.zeros(n, bool)
        for k in range(1, min(self.longest, int(length.max())) + 1):
            e = np.flatnonzero(room >= k) + 1
            h = mix((p[e] - p[e - k]) * inv[e - k] + U64(k))
            on = np.flatnonzero(self.maybe[(h & U64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hash, h[on]), len(self.hash) - 1)
            ok = self.hash[at] == h[on]
            e, at = e[on[ok]], at[ok]
            end.append(e.astype(np.int32))
            begin.append((e - k).astype(np.int32))
            num.append(self.id[at].astype(np.int32))
            w.append(self.logw[at])
            if k == 1:
                known[e - 1] = True
        odd = np.flatnonzero(~known)
        end.append((odd + 1).astype(np.int32))
        begin.append(odd.astype(np.int32))
        num.append(np.full(len(odd), -1, np.int32))
        c = s[odd]
        size = np.where(c < 0x80, 1, np.where(c < 0x800, 2, np.where((c >= 0xDC80) & (c <= 0xDCFF), 1, np.where(c < 0x10000, 3, np.where(c == LITERAL, 3, 4)))))
        w.append(self.theta * BYTE * size)
        del pw, inv, p, room
        by = np.argsort(np.concatenate(end), kind="stable")
        return tuple(np.concatenate(x)[by] for x in (end, begin, num, w))

    def forward(self, first: np.ndarray, length: np.ndarray, end: np.ndarray, begin: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first arc of each place, cumulated probability of each arc within its end place, log sum at each place).

        Places count like end: place e stands after s[e - 1]; the sum before a chunk's first character is 1.
        """
        n = int(length.sum())
        alpha = np.zeros(n + 1)
        head = np.searchsorted(end, np.arange(n + 2))
        depth = np.arange(1, n + 1) - np.repeat(first, length)  # of place 1..n within its chunk
        order = np.argsort(depth, kind="stable") + 1
        cut = np.searchsorted(depth[order - 1], np.arange(1, int(length.max()) + 2))
        score = np.empty(len(end))
        starts = np.zeros(n + 1, bool)
        starts[first] = True
        for d in range(len(cut) - 1):
            place = order[cut[d] : cut[d + 1]]
            a, m = head[place], head[place + 1] - head[place]
            off = np.cumsum(m) - m
            arcs = np.repeat(a - off, m) + np.arange(int(m.sum()))
            b = begin[arcs]
            x = w[arcs] + np.where(starts[b] & (b == np.repeat(place, m) - d - 1), 0.0, alpha[b])
            top = np.maximum.reduceat(x, off)
            ex = np.exp(x - np.repeat(top, m))
            total = np.add.reduceat(ex, off)
            alpha[place] = top + np.log(total)
            score[arcs] = ex / np.repeat(total, m)
        cum = np.cumsum(score)
        # probabilities cumulate within a place
        base = np.append(0.0, cum)[head[:-1]]
        cum -= np.repeat(base, np.diff(head))
        return head, cum, alpha

    def encode(self, data: np.ndarray, offs: np.ndarray, key: np.ndarray, seed: int = SEED, limit: int = 2 * SLICE) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): a segmentation of each row's text; key is a 64-bit number of each row.

        A blank is put before a text, as the vocabulary expects; an empty text has no pieces.  A row of more than `limit`
        bytes is encoded by that much at a time, cut where a chunk begins; the result is the same.
        """
        if len(offs) != 2 or len(data) <= limit:
            return self._encode(data, offs, key, seed)[:2]
        begins = np.flatnonzero((data[1:] == 32) & (data[:-1] != 32)) + 1
        cuts = np.unique(np.append(begins[np.minimum(np.searchsorted(begins, np.arange(limit, len(data), limit)), len(begins) - 1)] if len(begins) else [], [0, len(data)])).astype(np.int64)
        inner: set[int] = set()  # cuts inside a long chunk
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = a + limit
            while at < b - limit:
                at = self._inner_cut(data[:b], at)
                if at < b:
                    inner.add(at)
                at += limit
        cuts = np.unique(np.append(cuts, sorted(inner))).astype(np.int64)
        out, chunks = [], 0
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            ids, _, n = self._encode(data[a:b], np.array([0, b - a]), key, seed, a == 0, chunks, (a in inner, b in inner))
            out.append(ids)
            chunks += n
        ids = np.concatenate(out)
        return ids, np.array([0, len(ids)])

    def _inner_cut(self, data: np.ndarray, at: int) -> int:
        """The first place from `at` on that is inside a chunk longer than LONG and that no piece crosses; the end of data if there is none."""
        while at < len(data):
            lo = max(0, at - 4 * (LONG + self.longest))
            while lo > 0 and data[lo] & 0xC0 == 0x80:
                lo -= 1
            hi = min(len(data), at + 4 * WINDOW)
            while hi < len(data) and data[hi] & 0xC0 == 0x80:
                hi += 1
            s, _ = codepoints(data[lo:hi], np.array([0, hi - lo]), False)
            width = np.where(s < 0x80, 1, np.where(s == BLANK, 1, np.where(s < 0x800, 2, np.where((s >= 0xDC80) & (s <= 0xDCFF), 1, np.where(s < 0x10000, 3, np.where(s == LITERAL, 3, 4))))))
            byte = lo + np.cumsum(width) - width
            # so far from blanks that the chunk is long, whichever side is looked at
            blank = np.flatnonzero(s == BLANK)
            free = self.uncrossed(s)
            left = blank[np.searchsorted(blank, free) - 1] if len(blank) else np.full(len(free), -1)
            left = np.where((len(blank) == 0) | (np.searchsorted(blank, free) == 0), -1 if lo == 0 else -LONG - 1, left)
            free = free[(byte[free] >= at) & (free - left > LONG)]
            if len(free):
                return int(byte[free[0]])
            at = hi if hi < len(data) else len(data)
        return len(data)

    def _encode(self, data: np.ndarray, offs: np.ndarray, key: np.ndarray, seed: int, lead: bool = True, before: int = 0, open_: tuple[bool, bool] = (False, False)) -> tuple[np.ndarray, np.ndarray, int]:
        """encode(), and how many chunks there are; lead: whether a blank goes before a text, before: chunks that a row had already, open_: whether
        the first and the last chunk are parts of long ones."""
        s, at = codepoints(data, offs, lead)
        n_rows = len(offs) - 1
        if not len(s):
            return np.zeros(0, np.int64), np.zeros(n_rows + 1, np.int64), 0
        row = np.repeat(np.arange(n_rows), np.diff(at))
        blank = s == BLANK
        begins = blank.copy()
        begins[1:] &= ~blank[:-1] | (row[1:] != row[:-1])
        begins[at[:-1][np.diff(at) > 0]] = True
        first = np.flatnonzero(begins)
        length = np.diff(np.append(first, len(s)))
        long = length > LONG
        long[:1] |= open_[0]
        long[-1:] |= open_[1]
        if long.any():
            first = np.unique(np.concatenate([first, *[f + self.uncrossed(s[f : f + n]) for f, n in zip(first[long].tolist(), length[long].tolist(), strict=True)]]))
            length = np.diff(np.append(first, len(s)))
        # distinct chunks
        p = np.zeros(len(s) + 1, dtype=U64)
        np.cumsum(mix(s.astype(U64)) * _powers(len(s), _B), out=p[1:])
        h = mix((p[first + length] - p[first]) * _powers(len(s) + 1, _INV)[first] + length.astype(U64))
        c_row = row[first]
        del p, row, blank, begins  # a slice is hashed before its lattice is laid
        _, one, of = np.unique(h, return_index=True, return_inverse=True)
        u_len = length[one]
        u_first = np.cumsum(u_len) - u_len
        u = s[np.repeat(first[one] - u_first, u_len) + np.arange(int(u_len.sum()))]
        if (length != u_len[of]).any():
            raise ValueError("two chunks share a hash")
        del s, h
        end, begin, num, w = self.lattice(u, u_first, u_len)
        head, cum, _ = self.forward(u_first, u_len, end, begin, w)
        del end, w
        # backward sampling, one arc of each chunk a round
        place, stop = u_first[of] + length, u_first[of]
        number = np.arange(len(first)) - np.searchsorted(c_row, c_row) + before
        base = mix(key.astype(np.int64).view(U64)[c_row] * _MUL[0] + U64(seed * int(_MUL[1]) % (1 << 64))) + number.astype(U64) * _MUL[2]
        live = np.arange(len(first))
        got_chunk, got_arc, t = [], [], 0
        while len(live):
            draw = (mix(base[live] ^ mix(np.array([t + 1], dtype=U64))[0]) >> U64(11)).astype(np.float64) * 2.0**-53
            arc = head[place[live]]
            last = head[place[live] + 1] - 1
            go = np.flatnonzero((draw >= cum[arc]) & (arc < last))
            while len(go):
                arc[go] += 1
                go = go[(draw[go] >= cum[arc[go]]) & (arc[go] < last[go])]
            got_chunk.append(live)
            got_arc.append(arc)
            place[live] = begin[arc]
            live = live[place[live] > stop[live]]
            t += 1
        chunk, arc = np.concatenate(got_chunk), np.concatenate(got_arc)
        turn = np.repeat(np.arange(len(got_chunk)), [len(x) for x in got_chunk])
        by = np.lexsort((-turn, chunk))
        chunk, arc = chunk[by], arc[by]
        ids, owner = num[arc], c_row[chunk]
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            chars = u[begin[arc[odd]]]
            kinds, which = np.unique(chars, return_inverse=True)
            spelled = [self.fallback(int(c)) for c in kinds]
            size = np.ones(len(ids), np.int64)
            size[odd] = np.array([len(x) for x in spelled])[which]
            where = np.cumsum(size) - size
            ids, owner = np.repeat(ids, size), np.repeat(owner, size)
            for k in range(max(map(len, spelled))):
                b = np.array([x[k] if k < len(x) else -1 for x in spelled])[which]
                ids[where[odd][b >= 0] + k] = b[b >= 0]
        return ids, np.searchsorted(owner, np.arange(n_rows + 1)), len(first)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's bytes: exactly those that were encoded."""
        raw = b"".join(map(self.out.__getitem__, ids.tolist()))
        return raw[1:] if raw[:1] == b" " else raw


def codepoints(data: np.ndarray, offs: np.ndarray, lead: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each non-empty row with a blank before (where lead) and blanks for spaces, and the rows' offsets.

    Bytes that are no UTF-8 become lone surrogates, so they come back as they were.
    """
    raw = data.tobytes()
    size = np.diff(offs)
    try:
        cp = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        c = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        n = c[offs[1:]] - c[offs[:-1]]
    except UnicodeDecodeError:
        rows = [np.frombuffer(raw[a:b].decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        n, cp = np.array([len(x) for x in rows]), np.concatenate(rows)
    cp = np.where(cp == BLANK, LITERAL, np.where(cp == 32, BLANK, cp)).astype(np.uint32)
    full = (size > 0).astype(np.int64) * lead
    at = np.append(0, np.cumsum(n + full))
    out = np.full(int(at[-1]), BLANK, np.uint32)
    out[np.arange(len(cp)) + np.repeat(np.cumsum(full), n)] = cp
    return out, at


def encode_sampled(docs: DataFrame, model: str | None = None, theta: float = THETA, seed: int = SEED, ids: bool = True, check: bool = True, copy: str | None = None) -> DataFrame:
    """(doc_id, ids, n_pieces, ids_sha256, decoded_sha256, lossless) for each row of docs (doc_id, text).

    ids is a sampled segmentation of the whole text, the same at every run for equal doc_id, text, theta and
    seed; ids_sha256 is of its numbers as little-endian int32; with check, the pieces are decoded again and
    decoded_sha256 and lossless say what came back (null without).  ids=False leaves ids null.

    copy names a column of docs with the number, from 1, of a row among its copies: each copy has a segmentation of its own,
    the first that of a row without copies; the column is returned too, after doc_id.

    Null text: ids null, n_pieces 0, lossless true, digests of the empty string; empty text: no ids.
    Null doc_id: keyed as 0.  Repeated rows are encoded alike; other columns are ignored; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model or docs.sparkSession.conf.get(MODEL_SETTING, MODEL), theta))  # the size of the vocabulary
    schema = pa.schema([("doc_id", pa.int64()), *([("copy", pa.int32())] if copy else []), ("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("lossless", pa.bool_())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for rb in it:
            docs_ = rb.column("doc_id")
            key = np.asarray(docs_.fill_null(0))
            if copy:
                again = np.asarray(rb.column("copy")).astype(np.int64)
                key = np.where(again > 1, mix(key.view(U64) ^ mix(again.view(U64))).view(np.int64), key)
            null = np.asarray(rb.column("text").is_null())
            for a, b, data, offs in slices(rb.column("text"), SLICE):
                got, at = v.encode(data, offs, key[a:b], seed)
                got = got.astype(np.int32)
                raw = data.tobytes()
                digest, back, same = [], [], []
                for i in range(b - a):
                    mine = got[at[i] : at[i + 1]]
                    digest.append(hashlib.sha256(mine.astype("<i4").tobytes()).hexdigest())
                    if check:
                        text = v.decode(mine)
                        back.append(hashlib.sha256(text).hexdigest())
                        same.append(text == raw[offs[i] : offs[i + 1]])
                    else:
                        back.append(None)
                        same.append(None)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(got), mask=pa.array(null[a:b])) if ids else pa.nulls(b - a, pa.list_(pa.int32()))
                cols = [docs_.slice(a, b - a), *([rb.column("copy").slice(a, b - a)] if copy else []), lists, pa.array(np.diff(at)), pa.array(digest), pa.array(back, pa.string()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    extra = [F.col(copy).cast("int").alias("copy")] if copy else []
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *extra)
    return base.mapInArrow(trimmed(run), "doc_id long, " + ("copy int, " if copy else "") + "ids array<int>, n_pieces long, ids_sha256 string, decoded_sha256 string, lossless boolean")


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model or encoded.sparkSession.conf.get(MODEL_SETTING, MODEL)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a in range(0, rb.num_rows, 64):
                part = rb.slice(a, 64)
                texts = [None if x is None else shared.value.decode(np.array(x, dtype=np.int64)).decode("utf-8", "replace") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


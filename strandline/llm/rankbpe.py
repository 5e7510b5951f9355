"""BPE encoding and decoding with word ends, by contiguous rank arrays.

A word is an array of parts and an array of the ranks of adjacent parts.  The least rank is looked for, its boundary is deleted, and
the two ranks beside it are looked up again, until no adjacent parts merge.  Words of like length are rows of one matrix, so a
step does this for all of them; each distinct word of a slice is encoded once.  In a word of more than SHORT bytes a scan for each merge would
cost the square of its length: there all places of the least rank are merged at once (from the left, where they overlap), which
comes to the same as a merge never makes a pair of lower rank.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import SPACE, distinct_spans, slices

VOCABULARY_SETTING = "strandline.bpe.vocabulary"
SHORT = 64
SLICE = 1 << 21
#: Words whose ids a task keeps between slices.
CACHE = 1 << 17
NONE = np.iinfo(np.int32).max
BLANK, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 255
# fixed values of the vocabulary's format: the rule by which texts fall apart into words, and the sequence of steps before it
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase"]
ENDINGS = (("s", "t", "m", "d"), ("re", "ve", "ll"))
#: Texts that have no other code points are in composed form as they stand.
COMPOSED = re.compile("[^\\x00-\u02ff\u0391-\u03a1\u03b1-\u03c9\u0400-\u0482\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u3001-\u3029\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3]")


def vocabulary_path(spark: SparkSession) -> str:
    """The vocabulary file: the session's setting, or that of the public tokenizers package."""
    path = spark.conf.get(VOCABULARY_SETTING, None)
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stands for itself, the others count up from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class RankBpe:
    """A byte-level BPE vocabulary with word ends: lower case, white space dropped."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        model = j["model"]
        steps = [x["type"] for x in (j["normalizer"] or {}).get("normalizers", [])]
        split = (j["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        plain = not any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in j["added_tokens"])
        if steps != STEPS or split[0].get("pattern") != {"Regex": PATTERN} or not split[0].get("invert") or j["decoder"] or j["post_processor"] or not plain:
            raise ValueError("this vocabulary has other rules than those built here")
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.made = np.array([vocab["".join(p)] for p in pairs], np.int32)
        key = left << 32 | right
        self.by = np.argsort(key).astype(np.int32)
        self.key = key[self.by]
        if len(np.unique(self.key)) != len(self.key):
            raise ValueError("a pair merges twice")
        born = np.full(max(vocab.values()) + 1, -1, np.int64)
        np.maximum.at(born, self.made, np.arange(len(pairs)))
        if (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge makes a part of a pair of lower rank")
        self.token = [b""] * (max([*vocab.values(), *(a["id"] for a in j["added_tokens"])]) + 1)
        for t, i in vocab.items():
            self.token[i] = t.encode()
        self.special = {a["content"]: a["id"] for a in j["added_tokens"]}
        for t, i in self.special.items():
            self.token[i] = t.encode()
        self.apart = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._start()

    def _start(self) -> None:
        self.kind = np.full(0x110000, UNKNOWN, np.uint8)
        self.lower = np.arange(0x110000, dtype=np.uint32)
        self.wide: dict[str, str] = {}  # code points whose lower case is several
        self.cache: dict[bytes, bytes] = {}
        self.compose = None
        self._learn(np.arange(128))

    def __getstate__(self) -> dict:
        """What a task learns as it goes is not sent along."""
        return {k: v for k, v in self.__dict__.items() if k not in ("kind", "lower", "wide", "cache", "compose")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._start()

    # ---------------------------------------------------------------- texts to words

    def _learn(self, points: np.ndarray) -> None:
        """Classes and lower case of code points not met before, as the tables of the public library have them."""
        from tokenizers import Regex, normalizers, pre_tokenizers

        small = normalizers.Lowercase()
        chars = [chr(c) for c in points.tolist()]
        for c, ch in zip(points.tolist(), chars, strict=True):
            low = small.normalize_str(ch)
            if len(low) == 1:
                self.lower[c] = ord(low)
            else:
                self.wide[ch] = low
        todo = np.array([c for c in {ord(x) for ch in chars for x in (ch, *small.normalize_str(ch))} if self.kind[c] == UNKNOWN], np.int64)
        text = "".join(map(chr, todo.tolist()))
        self.kind[todo] = OTHER
        for number, what in ((BLANK, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
            for got, _ in pre_tokenizers.Split(Regex(what), "removed", invert=True).pre_tokenize_str(text):
                self.kind[[ord(x) for x in got]] = number

    def _composed(self, text: str) -> str:
        if self.compose is None:
            from tokenizers import normalizers

            self.compose = normalizers.NFC()
        return self.compose.normalize_str(text)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code points in lower case, start and end of each word, text of each word)."""
        texts = [t if t.isascii() or not COMPOSED.search(t) else self._composed(t) for t in texts]

        def points() -> np.ndarray:
            return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)

        cp = points()
        beyond = np.unique(cp[cp >= 128])
        new = beyond[self.kind[beyond] == UNKNOWN]
        if len(new):
            self._learn(new)
        wide = [c for c in map(chr, beyond.tolist()) if c in self.wide] if self.wide else []
        if wide:
            for c in wide:
                texts = [t.replace(c, self.wide[c]) for t in texts]
            cp = points()
        cp = self.lower[cp]
        n = len(cp)
        offs = np.append(0, np.cumsum([len(t) for t in texts]))
        kind = self.kind[cp]
        new_run = kind == NUMBER
        new_run[:1] = True
        new_run[1:] |= kind[1:] != kind[:-1]
        new_run[offs[offs < n]] = True
        at = np.flatnonzero(new_run)
        stop = np.append(at[1:], n)[: len(at)]
        ink = kind[at] != BLANK
        start, end = at[ink], stop[ink]
        # an apostrophe that stands alone takes an ending from the letters after it
        k = np.flatnonzero((end[:-1] - start[:-1] == 1) & (start[1:] == end[:-1]) & (kind[start[1:]] == LETTER)) if len(start) > 1 else np.zeros(0, np.int64)
        k = k[(cp[start[k]] == ord("'"))]
        row = np.searchsorted(offs, start, "right") - 1
        k = k[row[k] == row[k + 1]]
        if len(k):
            first, room = cp[start[k + 1]], end[k + 1] - start[k + 1]
            second = cp[np.minimum(start[k + 1] + 1, n - 1)]
            takes = np.isin(first, [ord(x) for x in ENDINGS[0]]).astype(np.int64)
            for a, b in ENDINGS[1]:
                takes[(room > 1) & (first == ord(a)) & (second == ord(b))] = 2
            end[k] += takes
            start[k + 1] += takes
            left = start < end
            start, end, row = start[left], end[left], row[left]
        return cp, start, end, row

    # ---------------------------------------------------------------- words to ids

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NONE where they do not merge (or one is -1)."""
        want = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.by[at], NONE).astype(np.int32)

    def merge_short(self, parts: np.ndarray) -> np.ndarray:
        """Rows of ids, filled with -1, with everything merged."""
        m, width = parts.shape
        done = np.full((m, width), -1, np.int32)
        rank = self.ranks(parts[:, :-1], parts[:, 1:]) if width > 1 else np.zeros((m, 0), np.int32)
        rows = np.arange(m)
        while len(rows) and rank.shape[1]:
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(rows)), at]
            over = least == NONE
            if over.any():
                done[rows[over], : parts.shape[1]] = parts[over]
                go = ~over
                rows, parts, rank, at, least = rows[go], parts[go], rank[go], at[go], least[go]
                if not len(rows):
                    return done
            here = np.arange(len(rows))
            col = np.arange(parts.shape[1])[None, :]
            made = self.made[least]
            # the boundary after `at` goes: what stands behind moves up
            parts = np.take_along_axis(parts, np.minimum(col + (col > at[:, None]), parts.shape[1] - 1), axis=1)[:, :-1]
            col = col[:, : rank.shape[1]]
            rank = np.take_along_axis(rank, np.minimum(col + (col > at[:, None]), rank.shape[1] - 1), axis=1)[:, :-1]
            parts[here, at] = made
            right = at < rank.shape[1]
            rank[here[right], at[right]] = self.ranks(made[right], parts[here[right], at[right] + 1])
            left = at > 0
            rank[here[left], at[left] - 1] = self.ranks(parts[here[left], at[left] - 1], made[left])
        done[rows, : parts.shape[1]] = parts
        return done

    def merge_long(self, tok: np.ndarray) -> np.ndarray:
        """ids of one word of any length."""
        n = len(tok)
        tok = tok.copy()
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        rank = np.append(self.ranks(tok[:-1], tok[1:]), NONE).astype(np.int32)
        alive = np.ones(n, bool)
        places: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def push(at: np.ndarray) -> None:
            at = at[rank[at] != NONE]
            by = at[np.argsort(rank[at], kind="stable")]
            r = rank[by]
            cut = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else []
            for a, b in zip(cut, np.append(cut[1:], len(r)), strict=True) if len(r) else ():
                k = int(r[a])
                if k not in places:
                    places[k] = []
                    heapq.heappush(heap, k)
                places[k].append(by[a:b])

        push(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # of places that overlap, every other one from the left
            new = np.append(True, after[at[:-1]] != at[1:])
            nth = np.arange(len(at))
            at = at[(nth - np.maximum.accumulate(np.where(new, nth, 0))) % 2 == 0]
            gone = after[at]
            tok[at] = self.made[r]
            alive[gone] = False
            rank[gone] = NONE
            after[at] = after[gone]
            more = after[at] < n
            before[after[at[more]]] = at[more]
            rank[at] = NONE
            rank[at[more]] = self.ranks(tok[at[more]], tok[after[at[more]]])
            first = at[before[at] >= 0]
            prev = before[first]
            rank[prev] = self.ranks(tok[prev], tok[first])
            push(np.unique(np.concatenate([at, prev])))
        return tok[alive]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """ids of each word (UTF-8, not empty) as little-endian 32-bit integers."""
        out = [b""] * len(words)
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size) - size
        ids = self.inner[data]
        ids[first + size - 1] = self.final[data[first + size - 1]]
        for i in np.flatnonzero(size > SHORT).tolist():
            out[i] = self.merge_long(ids[first[i] : first[i] + size[i]]).astype("<u4").tobytes()
        low = 0
        for width in (4, 6, 8, 10, 12, 16, 24, 32, 48, SHORT):
            these = np.flatnonzero((size > low) & (size <= width))
            low = width
            for a in range(0, len(these), 1 << 14):
                some = these[a : a + (1 << 14)]
                col = np.arange(width)[None, :]
                parts = np.where(col < size[some, None], ids[np.minimum(first[some, None] + col, len(ids) - 1)], -1)
                got = self.merge_short(parts)
                kept = (got >= 0).sum(axis=1).tolist()
                for i, g, n in zip(some.tolist(), got.astype("<u4"), kept, strict=True):
                    out[i] = g[:n].tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian 32-bit integers; the strings of special tokens in a text are those tokens."""
        part, owner, put = [], [], {}
        for i, t in enumerate(texts):
            for k, x in enumerate(self.apart.split(t) if self.apart and any(s in t for s in self.special) else [t]):
                if k % 2:
                    put[len(part)] = np.array([self.special[x]], "<u4").tobytes()
                part.append("" if k % 2 else x)
                owner.append(i)
        cp, start, end, row = self.words(part)
        one, of = distinct_spans(cp, start, end)
        size = (end - start)[one]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        text = np.ascontiguousarray(cp[np.repeat(start[one], size) + at], "<u4").tobytes().decode("utf-32-le", "surrogatepass")
        cut = np.cumsum(size).tolist()
        words = [text[a:b].encode("utf-8", "surrogatepass") for a, b in zip([0, *cut], cut, strict=False)]
        new = [w for w in words if w not in self.cache]
        fresh = dict(zip(new, self.merge(new), strict=True)) if new else {}
        known = [self.cache[w] if w in self.cache else fresh[w] for w in words]
        if len(self.cache) + len(fresh) > CACHE:
            self.cache.clear()
        self.cache.update((w, x) for w, x in fresh.items() if len(w) <= SHORT)
        bound = np.searchsorted(row, np.arange(len(part) + 1)).tolist()
        seq = of.tolist()
        got = [put[i] if i in put else b"".join(map(known.__getitem__, seq[a:b])) for i, (a, b) in enumerate(zip(bound[:-1], bound[1:], strict=True))]
        if len(part) == len(texts):
            return got
        out = [[] for _ in texts]
        for i, x in zip(owner, got, strict=True):
            out[i].append(x)
        return [b"".join(x) for x in out]

    def decode(self, ids: bytes) -> bytes:
        """The tokens' strings with blanks between them, in UTF-8: the vocabulary names no decoder."""
        return b" ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def pieces(data: bytes, limit: int = SLICE) -> Iterator[bytes]:
    """A long text by about `limit` bytes at a time, cut before white space, or else before a sign after a letter or digit, so that
    no word, composed character or special token is cut; where there is neither, a piece is longer."""
    if len(data) <= 2 * limit:
        yield data
        return
    raw = np.frombuffer(data, np.uint8)
    alnum = np.zeros(256, bool)
    alnum[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    sign = np.zeros(256, bool)
    sign[[b for b in range(33, 127) if not alnum[b] and chr(b) not in "'|"]] = True
    a = 0
    while a < len(raw):
        b = a + limit
        while b < len(raw):
            some = raw[b : b + limit]
            fits = SPACE[some]
            if not fits.any():
                fits = sign[some] & alnum[raw[b - 1 : b - 1 + len(some)]]
            if fits.any():
                b += int(fits.argmax())
                break
            b += len(some)
        yield data[a:b]
        a = b


def encode_words(docs: DataFrame, vocabulary: str | None = None, ids: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) for each row of docs (doc_id, text).

    ids are those of the whole text, as the public tokenizers library gives them without special tokens around it; ids_sha256 is of them as
    little-endian unsigned 32-bit integers, decoded_sha256 of what they decode to.  ids=False leaves ids null.

    Null text: ids null, n_tokens 0, digests of nothing; empty text and text of white space: no ids.  Bytes that are no UTF-8 count as
    U+FFFD.  Null doc_ids stay, repeated rows are encoded alike, other columns are ignored, an empty table gives an empty result.  A
    long text is encoded by pieces of about 2 MB that end between words; only a word itself is never cut.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(RankBpe(vocabulary or vocabulary_path(spark)))  # the size of the vocabulary
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for rb in it:
            null = np.asarray(rb.column("text").is_null())
            for a, b, data, offs in slices(rb.column("text"), SLICE):
                raw = data.tobytes()
                if b - a == 1:
                    texts = [x.decode("utf-8", "replace") for x in pieces(raw)]
                    coded = (v.encode([x])[0] for x in texts)
                    groups: list = [coded]
                else:
                    groups = [[x] for x in v.encode([raw[x:y].decode("utf-8", "replace") for x, y in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)])]
                count, one, back, kept = [], [], [], []
                for group in groups:
                    n, h, d, held = 0, hashlib.sha256(), hashlib.sha256(), []
                    for x in group:
                        if x:
                            h.update(x)
                            d.update((b" " if n else b"") + v.decode(x))
                            n += len(x) // 4
                            if ids:
                                held.append(x)
                    count.append(n)
                    one.append(h.hexdigest())
                    back.append(d.hexdigest())
                    kept.append(b"".join(held))
                if ids:
                    flat = np.frombuffer(b"".join(kept), "<i4")
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(flat), mask=pa.array(null[a:b]))
                else:
                    lists = pa.nulls(b - a, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([rb.column("doc_id").slice(a, b - a), lists, pa.array(count, pa.int64()), pa.array(one), pa.array(back)], schema=schema)

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_words(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null text.  Case and white space do not come back: the vocabulary drops them."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(RankBpe(vocabulary or vocabulary_path(spark)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a in range(0, rb.num_rows, 64):
                part = rb.slice(a, 64)
                texts = [None if x is None else shared.value.decode(np.array(x, "<u4").tobytes()).decode() for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")

"""Toxicity: noisy-channel restoration of obfuscated words, then a linear score of the restored text.

Every word is a noisy observation: each of its characters stands in a lattice for the letters it may have been (leetspeak), or for
nothing (separators, repetition).  Viterbi decoding picks the path that is likeliest under a character trigram model,
counted over all documents and mixed with one of the learned vocabulary.  A word whose lattice has one path only, itself,
needs no decoding: that is so unless it holds a mark of the channel or two equal characters in a row.  A word of
digits alone is a number.  Runs of two or more single letters are read as one word if that is the likelier reading.
The restored words and their beginnings are the features of a logistic regression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import LOWER, U64, distinct_spans, run_starts, slices, spans_hash, trimmed, words

#: Bound of what is learned from: labelled rows that are fitted.
FIT_ROWS = 8000
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)
#: Fixed channel: what a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SEPARATORS = ".-_~'`^"
#: Costs of what the channel does, in nats.
COST = {"space": 0.5, "leet": 1.0, "digit": 4.0, "drop_mark": 6.0, "drop_separator": 0.3, "drop_repeat": 2.2, "any": 3.0}
SYMBOLS = 28  # a-z, other letters, anything else

_letter = np.zeros(256, bool)
_letter[97:123] = True
_leet = np.zeros(256, bool)
_leet[[ord(c) for c in LEET]] = True
_sep = np.zeros(256, bool)
_sep[[ord(c) for c in SEPARATORS]] = True
_edge = np.zeros(256, bool)
_edge[[ord(c) for c in ".,;:?\"'()[]{}<>*%&#-_=/\\~^`"]] = True
_tail = _edge.copy()
_tail[ord("!")] = True
_symbol = np.full(256, 27, np.int64)
_symbol[97:123] = np.arange(26)
_symbol[128:] = 26


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals in UTF-8 as small letters."""
    out = LOWER[data]
    if len(out) > 1:
        lead = np.flatnonzero(data[:-1] == 0xC3) + 1
        low = data[lead]
        out[lead] = np.where((low >= 0x80) & (low <= 0x9E) & (low != 0x97), low + 0x20, low)
    return out


@dataclass
class Tokens:
    """The words of a slice: spans of lower-case text, those with one reading and those with several, and runs of single letters."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    odd_start: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    odd_end: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    odd_row: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    runs: list[tuple[int, str]] = field(default_factory=list)  # (row, letters parted by blanks)
    runs_start: list[int] = field(default_factory=list)

    @property
    def noisy(self) -> list[tuple[int, str]]:
        """(row, observed) of everything with several readings."""
        return self.runs + [(int(r), self.spelled(a, b)) for a, b, r in zip(self.odd_start, self.odd_end, self.odd_row, strict=True)]

    @property
    def noisy_start(self) -> list[int]:
        return self.runs_start + self.odd_start.tolist()

    def spelled(self, a: int, b: int) -> str:
        return self.data[a:b].tobytes().decode("utf-8", "replace")


def tokens(data: np.ndarray, offs: np.ndarray) -> Tokens:
    """Words without the marks around them; words whose lattice has several paths are set apart as noisy observations."""
    data = lower(data)
    start, end, row = words(data, offs)
    # a tail of three or more $ is no letter
    three = np.flatnonzero(end - start >= 3)
    three = three[(data[end[three] - 1] == 36) & (data[end[three] - 2] == 36) & (data[end[three] - 3] == 36)]
    while len(three):
        three = three[(end[three] > start[three]) & (data[np.maximum(end[three] - 1, 0)] == 36)]
        end[three] -= 1
    for lut, edge in ((_edge, 0), (_tail, 1)):
        act = np.arange(len(start))
        while len(act):
            at = start[act] if edge == 0 else end[act] - 1
            act = act[(start[act] < end[act]) & lut[data[np.minimum(at, len(data) - 1)]]]
            if edge == 0:
                start[act] += 1
            else:
                end[act] -= 1
    full = end > start
    start, end, row = start[full], end[full], row[full]
    if not len(start):
        return Tokens(data, start, end, row)

    def count(mask: np.ndarray) -> np.ndarray:
        c = np.zeros(len(data) + 1, np.int32)
        np.cumsum(mask, out=c[1:], dtype=np.int32)
        return c[end] - c[start]

    size = end - start
    twice = np.zeros(len(data), bool)
    twice[1:] = (data[1:] == data[:-1]) & (data[1:] < 128)
    c = np.zeros(len(data) + 1, np.int32)
    np.cumsum(twice, out=c[1:], dtype=np.int32)
    # a pair counts where both characters are inside the word
    pairs = c[end] - c[np.minimum(start + 1, end)]
    number = count((data >= 48) & (data <= 57)) == size
    noisy = ~number & (count(_leet[data] | _sep[data] | (data == 42)) + pairs > 0)
    # two or more single letters (or marks that stand for one, not digits alone) in a row
    single = (size == 1) & (_letter[data[start]] | _leet[data[start]])
    at = run_starts(single, row)
    n = np.diff(np.append(at, len(single)))
    letters = np.add.reduceat(_letter[data[start]] & single, at)
    spaced = single[at] & (n > 1) & (letters > 0)
    out = Tokens(data, start, end, row)
    for a, k in zip(at[spaced].tolist(), n[spaced].tolist(), strict=True):
        noisy[a : a + k] = False
        single[a : a + k] = False
        start[a] = -1 - start[a]  # the run stands here; its other words go
        start[a + 1 : a + k] = np.iinfo(np.int64).min
        out.runs.append((int(row[a]), " ".join(data[end[a : a + k] - 1].tobytes().decode("latin-1"))))
        out.runs_start.append(int(end[a]) - 1)
    plain, odd = (start >= 0) & ~noisy, (start >= 0) & noisy
    out.start, out.end, out.row = start[plain], end[plain], row[plain]
    out.odd_start, out.odd_end, out.odd_row = start[odd], end[odd], row[odd]
    return out


# ---------------------------------------------------------------- language model and decoding


def _class(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else 26 if c > "\x7f" else 27


class CharModel:
    """Trigrams over letter classes: the corpus and the vocabulary half and half, backed off to shorter ones."""

    def __init__(self, corpus: np.ndarray, vocabulary: list[str] = ()) -> None:
        own = np.zeros((SYMBOLS,) * 3)
        for w in vocabulary:
            s = [27, 27, *map(_class, w), 27]
            for i in range(2, len(s)):
                own[s[i - 2], s[i - 1], s[i]] += 1
        p = self._smooth(corpus.reshape((SYMBOLS,) * 3).astype(float))
        if len(vocabulary):
            p = 0.5 * p + 0.5 * self._smooth(own)
        self.logp = np.log(p).tolist()
        self.decode = lru_cache(maxsize=200_000)(self._decode)

    def __getstate__(self) -> dict:
        return {"logp": self.logp}

    def __setstate__(self, s: dict) -> None:
        self.logp = s["logp"]
        self.decode = lru_cache(maxsize=200_000)(self._decode)

    @staticmethod
    def _smooth(n: np.ndarray) -> np.ndarray:
        one = n.sum((0, 1)) + 1.0
        one /= one.sum()
        two = n.sum(0)
        two = (two + 2 * one) / (two.sum(1, keepdims=True) + 2)
        return (n + 2 * two[None]) / (n.sum(2, keepdims=True) + 2)

    def _decode(self, seen: str) -> str:
        """The likeliest word behind the observed one; single letters parted by blanks: words, parted by blanks, or one word."""
        if " " not in seen:
            return self._viterbi(seen)[0]
        letters = seen.split(" ")
        apart = [self._viterbi(x) for x in letters]
        joined, p = self._viterbi("".join(letters))
        return joined if p - COST["space"] * (len(letters) - 1) > sum(q for _, q in apart) else " ".join(w for w, _ in apart if w)

    def _viterbi(self, seen: str) -> tuple[str, float]:
        """The likeliest path and its log-probability: Viterbi over states of the last two letter classes."""
        states: dict[tuple[int, int], tuple[float, str]] = {(27, 27): (0.0, "")}
        before = ""
        for ch in seen:
            if ch in LEET:
                options = [(c, COST["leet"]) for c in LEET[ch]] + [("", COST["drop_mark"])]
                if ch.isdigit():
                    options.append((ch, COST["digit"]))
            elif ch == "*":
                options = [(chr(97 + i), COST["any"]) for i in range(26)] + [("", COST["any"])]
            elif ch in SEPARATORS:
                options = [("", COST["drop_separator"])]
            else:
                options = [(ch, 0.0)]
            if ch == before:
                options.append(("", COST["drop_repeat"]))
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (p, text) in states.items():
                row = self.logp[a][b]
                for c, cost in options:
                    key, q = ((b, _class(c)), p - cost + row[_class(c)]) if c else ((a, b), p - cost)
                    if key not in new or new[key][0] < q:
                        new[key] = (q, text + c)
            states, before = new, ch
        best, text = max((p + self.logp[a][b][27], text) for (a, b), (p, text) in states.items())
        return text, best

    def restore(self, text: str) -> str:
        """The words of the text in their order, each as the channel reads it, joined by single spaces."""
        raw = np.frombuffer(text.encode(), np.uint8)
        t = tokens(raw, np.array([0, len(raw)]))
        found = [(a, t.data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(t.start.tolist(), t.end.tolist(), strict=True)]
        found += [(a, self.decode(w)) for a, (_, w) in zip(t.noisy_start, t.noisy, strict=True)]
        return " ".join(w for _, w in sorted(found) if w)


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigrams of letter classes over the whole texts of all documents (28^3 sums)."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for rb in it:
            for _, _, data, offs in slices(rb.column("text")):
                # rows are kept apart by two blanks
                s = np.full(len(data) + 2 * len(offs), 27, np.int32)
                place = np.arange(len(data)) + 2 * np.searchsorted(offs, np.arange(len(data)), "right")
                s[place] = _symbol[lower(data)]
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "n"])

    out = np.zeros(SYMBOLS**3, np.int64)
    for r in docs.select("text").mapInArrow(trimmed(count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r.gram] = r.n
    return out


# ---------------------------------------------------------------- features and model


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which words, feature hash): each whole word, and the beginnings of those that go on."""
    yield np.arange(len(start)), spans_hash(data, start, end)
    for k in PREFIXES:
        long = np.flatnonzero(end - start > k)
        yield long, spans_hash(data, start[long], start[long] + k) ^ U64(k)


def features(data: np.ndarray, offs: np.ndarray, lm: CharModel) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature hash) of a slice's words, plain and restored; not distinct."""
    t = tokens(data, offs)
    if len(t.start):
        for which, h in _hashes(t.data, t.start, t.end):
            yield t.row[which], h
    # each different word is read once: (its number, its row) of every place, then the restored words of each number
    one, of = distinct_spans(t.data, t.odd_start, t.odd_end)
    seen = [t.spelled(a, b) for a, b in zip(t.odd_start[one].tolist(), t.odd_end[one].tolist(), strict=True)] + [x for _, x in t.runs]
    number = np.concatenate([of, len(one) + np.arange(len(t.runs))]).astype(np.int64)
    row = np.concatenate([t.odd_row, np.array([r for r, _ in t.runs], np.int64)])
    found = [(k, w.encode()) for k, x in enumerate(seen) for w in lm.decode(x).split(" ") if w]
    if found:
        mine = np.array([k for k, _ in found])
        lens = np.array([len(w) for _, w in found])
        end = np.cumsum(lens)
        for which, h in _hashes(np.frombuffer(b"".join(w for _, w in found), np.uint8), end - lens, end):
            first = np.searchsorted(mine[which], np.arange(len(seen) + 1))
            n = np.diff(first)[number]
            yield np.repeat(row, n), h[np.repeat(first[number], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.lexsort((h, row))
    at = run_starts(row[by], h[by])
    return row[by][at], h[by][at]


@dataclass
class ToxicityModel:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float
    lm: CharModel

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes & U64(0xFFFF)).astype(np.int64)] = True

    def hits(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, feature number) of a slice."""
        rows, nums = [], []
        for r, h in features(data, offs, self.lm):
            on = np.flatnonzero(self.maybe[(h & U64(0xFFFF)).astype(np.int64)])
            k = np.searchsorted(self.hashes, h[on])
            k = np.minimum(k, max(0, len(self.hashes) - 1))
            ok = self.hashes[k] == h[on] if len(self.hashes) else np.zeros(len(on), bool)
            rows.append(r[on[ok]])
            nums.append(k[ok])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        m = max(1, len(self.hashes))
        key = np.unique(np.concatenate(rows) * m + np.concatenate(nums))
        return key // m, key % m

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        r, k = self.hits(data, offs)
        z = np.bincount(r, weights=self.weights[k], minlength=len(offs) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(modulus: int, rest: int):
    """Whether crc32 of doc_id as text has that remainder; false without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, rest: int, fit_rows: int) -> DataFrame:
    """(doc_id, text, y) of at most fit_rows labelled rows outside the held-out part, those of least hashed doc_id; of texts under one
    doc_id the one of least hash."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(modulus, rest))
    few = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(fit_rows)
    # at most fit_rows rows of two numbers
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few.distinct()), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "y")


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, rest: int = 2, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from labels (doc_id, toxic) of rows outside the held-out part, at most fit_rows of them.

    Features are all restored words and beginnings that at least two toxic rows hold, and far more often than others.
    The character model counts all documents.  Rows with another label than 0 and 1 and
    rows without doc_id teach nothing; without labels of both kinds every score is the mean label (0.5 without any).
    """
    corpus = char_counts(docs)
    lm = CharModel(corpus)
    sample = labelled_sample(docs, labels, label, modulus, rest, fit_rows).repartition(max(1, docs.sparkSession.sparkContext.defaultParallelism)).persist()

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {0: [], 1: []}
        for rb in it:
            y = np.asarray(rb.column("y"))
            for a, _, data, offs in slices(rb.column("text")):
                got = list(features(data, offs, lm))
                if got:
                    r, h = _distinct(np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got]))
                    for k in (0, 1):
                        held[k].append(h[y[r + a] == k])
        for k in (0, 1):
            if held[k]:
                h = np.sort(np.concatenate(held[k]))
                at = run_starts(h)
                n = np.diff(np.append(at, len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(np.full(len(at), k)), pa.array(n)], names=["h", "y", "n"])

    lots = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    pos, neg = lots.get(1, 0), lots.get(0, 0)
    empty = lambda p: ToxicityModel(np.zeros(0, U64), np.zeros(0), math.log(p / (1 - p)), lm)
    if not pos or not neg:
        sample.unpersist()
        return empty(min(max((pos / (pos + neg)) if pos + neg else 0.5, 1e-6), 1 - 1e-6))
    side = lambda k: F.sum(F.when(F.col("y") == k, F.col("n")).otherwise(0))
    table = sample.mapInArrow(trimmed(count), "h long, y long, n long").groupBy("h").agg(side(1).alias("t"), side(0).alias("f"))
    lift = ((F.col("t") + 0.1) / pos) / ((F.col("f") + 0.5) / neg)
    chosen = table.where((F.col("t") >= 2) & (lift >= 8)).select("h").toArrow()  # words of the sample's rows
    hashes = np.sort(np.asarray(chosen.column("h").combine_chunks(), dtype=np.int64).view(U64)) if chosen.num_rows else np.zeros(0, U64)
    if not len(hashes):
        sample.unpersist()
        return empty(pos / (pos + neg))
    first = ToxicityModel(hashes, np.zeros(len(hashes)), 0.0, lm)

    def hits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            y = np.asarray(rb.column("y"))
            for a, b, data, offs in slices(rb.column("text")):
                r, k = first.hits(data, offs)
                per = np.split(k, np.searchsorted(r, np.arange(1, b - a)))
                yield pa.RecordBatch.from_arrays([pa.array(y[a:b]), pa.array([x.astype(np.int32).tobytes() for x in per], pa.binary()), pa.array(_vocabulary(first, data, offs, y[a:b]), pa.list_(pa.string()))], names=["y", "on", "vocab"])

    # at most fit_rows rows, in an order of their own, so that sums and with them weights agree to the bit between runs
    rows = sorted(sample.mapInArrow(trimmed(hits), "y int, on binary, vocab array<string>").collect(), key=lambda r: (r.y, bytes(r.on)))
    sample.unpersist()
    ys = np.array([r.y for r in rows], dtype=float)
    on = [np.frombuffer(r.on, np.int32) for r in rows]
    r, k = np.repeat(np.arange(len(on)), [len(x) for x in on]), np.concatenate(on).astype(np.int64)
    weights, bias = _logistic(r, k, ys, len(hashes))
    vocabulary = sorted({w for x in rows for w in x.vocab})
    return ToxicityModel(hashes, weights, bias, CharModel(corpus, vocabulary))


def _vocabulary(model: ToxicityModel, data: np.ndarray, offs: np.ndarray, y: np.ndarray) -> list[list[str]]:
    """Per row, the plain whole words of toxic rows that are features."""
    out: list[list[str]] = [[] for _ in y]
    t = tokens(data, offs)
    if len(t.start):
        h = spans_hash(t.data, t.start, t.end)
        for i in np.flatnonzero(np.isin(h, model.hashes) & (y[t.row] == 1)).tolist():
            out[t.row[i]].append(t.data[t.start[i] : t.end[i]].tobytes().decode("utf-8", "replace"))
    return [sorted(set(x)) for x in out]


def _logistic(r: np.ndarray, k: np.ndarray, y: np.ndarray, m: int, rounds: int = 400, rate: float = 0.1, ridge: float = 3e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features by Adam over the full batch."""
    w, mean, var = np.zeros(m + 1), np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(r, weights=w[k], minlength=len(y)) + w[m]
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        grad = np.append(np.bincount(k, weights=g[r], minlength=m), g.sum()) + ridge * np.append(w[:m], 0)
        mean, var = 0.9 * mean + 0.1 * grad, 0.999 * var + 0.001 * grad**2
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.999**t)) + 1e-8)
    return w[:m], float(w[m])


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted, *keep) for each row; the score rests on the whole text alone.

    Null and empty texts get the score of a text without features; rows without doc_id are scored too
    (held_out false); repeated rows score alike; an empty table gives an empty result.  Columns of keep that have the
    name of a result column are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of the sample's words and 28^3 log-probabilities
    others = [c for c in keep if c not in ("doc_id", "text", "held_out", "score", "predicted")]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(4, 2).alias("held_out"), "text", *(F.col(c).alias(f"__keep_{c}") for c in others))
    last = [(c, "text" if c == "text" else f"__keep_{c}") for c in keep if c in ("text", *others)]

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rb in it:
            s = np.full(rb.num_rows, 0.0)
            for a, b, data, offs in slices(rb.column("text")):
                s[a:b] = m.scores(data, offs)
            cols = [rb.column("doc_id"), rb.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), *(rb.column(c) for _, c in last)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted", *(n for n, _ in last)])

    kinds = dict(docs.dtypes)
    return base.mapInArrow(trimmed(score), "doc_id long, held_out boolean, score double, predicted int" + "".join(f", `{n}` {kinds[n]}" for n, _ in last))

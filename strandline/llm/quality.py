"""Quality: gated-attention multiple-instance learning over the passages of a document.

A document is a bag of passages (runs of PASSAGE bytes, cut at white space).  Each passage is encoded from the hashed
words and word pairs it holds, whose embeddings are learned, and from character statistics; attention weights,
softmax(w . (tanh(V h) * sigmoid(U h))), are learned from document labels alone, and the score is read off the
attention-weighted sum of the encodings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import LOWER, SPACE, U64, discard, materialize, mix, run_starts, slices, spans_hash, words
from strandline.llm.toxicity import held_out, labelled_sample

#: At most this many labelled rows are fitted, on all their passages.
FIT_ROWS = 6000
#: Labelled rows a part of the fitted bags; each part gives one sum of gradients a round.
FIT_PART = 512
#: Bytes of a text, and passages, that are worked on at once.
PIECE = 1 << 20
SOME = 2048
THRESHOLD = 0.3
PASSAGE = 512
HIDDEN = 16
ATTENTION = 8
ROUNDS = 50
SEED = 7

_digit = np.zeros(256, bool)
_digit[48:58] = True
_upper = np.zeros(256, bool)
_upper[65:91] = True
_lower = np.zeros(256, bool)
_lower[97:123] = True
_high = np.zeros(256, bool)
_high[128:] = True
_stop = np.zeros(256, bool)
_stop[[ord(c) for c in ".,;:"]] = True
_line = np.zeros(256, bool)
_line[10] = True
_other = ~(_digit | _upper | _lower | _high | _stop | SPACE)
#: The kinds of bytes whose shares describe a passage.
KINDS = (_digit, _upper, _lower, _high, _stop, _line, _other)
_class = np.zeros(256, np.int64)
for _i, _k in enumerate(KINDS):
    _class[_k] = _i + 1
#: Rows of the embedding that hashed words and word pairs share.
BUCKETS = 256
STATS = len(KINDS) + 6 + (len(KINDS) + 1) ** 2
WIDTH = STATS + BUCKETS


def passages(data: np.ndarray, offs: np.ndarray, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, features) of the passages of each text, at least one a row; features are WIDTH numbers.

    A passage takes whole words until it has PASSAGE bytes; a text without words is one passage of zeros.  The last BUCKETS
    numbers say how often the words and word pairs of each hash occur: sqrt(count), scaled to length one.  base: where in its text a
    piece of one begins.
    """
    start, end, row = words(data, offs)
    n_rows = len(offs) - 1
    if not len(start):
        return np.arange(n_rows), np.zeros((n_rows, WIDTH))
    block = (start + base - offs[row]) // PASSAGE
    at = run_starts(row, block)
    last = np.append(at[1:], len(start)) - 1
    a, b, r = start[at], end[last], row[at]
    size = (b - a).astype(float)
    count = (last - at + 1).astype(float)
    f = np.zeros((len(at), WIDTH))
    k = len(KINDS) + 1
    kinds, grid = np.zeros((len(at), k)), np.zeros((len(at), k * k))
    for lo in range(int(a[0]), int(b[-1]), PIECE):
        hi = min(lo + PIECE, int(b[-1]))
        one, end_ = int(np.searchsorted(a, lo, "right")) - 1, int(np.searchsorted(a, hi))
        of = np.zeros(hi - lo, np.int64)
        of[a[one + 1 : end_] - lo] = 1
        np.cumsum(of, out=of)
        c = _class[data[lo:hi]]
        inside = np.arange(lo, hi) < b[one:end_][of]
        kinds[one:end_] += np.bincount(of[inside] * k + c[inside], minlength=(end_ - one) * k).reshape(-1, k)
        # how kinds of bytes follow each other
        before = np.append(_class[data[lo - 1]] if lo else 0, c[:-1])
        inside[a[one:end_][a[one:end_] >= lo] - lo] = False
        grid[one:end_] += np.bincount(of[inside] * (k * k) + before[inside] * k + c[inside], minlength=(end_ - one) * k * k).reshape(-1, k * k)
    f[:, : len(KINDS)] = kinds[:, 1:] / size[:, None]
    col = len(KINDS)
    # words: mean length, share of the common case of repetition (a word that the passage has already), capital words
    h = spans_hash(data, start, end)
    pid = np.repeat(np.arange(len(at)), last - at + 1)
    by = np.lexsort((h, pid))
    again = np.ones(len(by), bool)
    again[run_starts(pid[by], h[by])] = False
    f[:, col] = (end - start).astype(float).cumsum()[last] - np.append(0, (end - start).astype(float).cumsum())[at]
    f[:, col] /= count * 10
    f[:, col + 1] = np.bincount(pid[by], weights=again, minlength=len(at)) / count
    edge = _other[data[end - 1]]
    f[:, col + 2] = np.bincount(pid, weights=edge, minlength=len(at)) / count
    f[:, col + 3] = np.bincount(pid, weights=(end - start == 1), minlength=len(at)) / count
    f[:, col + 4] = np.bincount(pid, weights=_upper[data[start]] & _upper[data[end - 1]], minlength=len(at)) / count
    f[:, col + 5] = np.log1p(size) / 7
    f[:, col + 6 : STATS] = grid / size[:, None]
    # words (a-z for A-Z) and pairs of neighbouring words
    low = spans_hash(LOWER[data], start, end)
    pair_of = np.flatnonzero(pid[1:] == pid[:-1])
    both = mix(low[pair_of] * U64(3) + low[pair_of + 1])
    bucket = np.concatenate([pid * BUCKETS + (low % U64(BUCKETS)).astype(np.int64), pid[pair_of] * BUCKETS + (both % U64(BUCKETS)).astype(np.int64)])
    held = np.sqrt(np.bincount(bucket, minlength=len(at) * BUCKETS).reshape(len(at), BUCKETS))
    f[:, STATS:] = held / np.sqrt((held * held).sum(axis=1, keepdims=True))
    empty = np.setdiff1d(np.arange(n_rows), r, assume_unique=False)
    if len(empty):
        r, f = np.concatenate([r, empty]), np.concatenate([f, np.zeros((len(empty), WIDTH))])
        by = np.argsort(r, kind="stable")
        r, f = r[by], f[by]
    return r, f


def long_passages(data: np.ndarray, limit: int = PIECE) -> Iterator[np.ndarray]:
    """Features of the passages of one text, as passages() gives them, about `limit` bytes of it at a time: a piece ends where a passage does."""
    a = 0
    while a < len(data):
        b = (a + limit) // PASSAGE * PASSAGE
        while b < len(data):  # the first word that begins here or later opens a passage
            some = data[b - 1 : b + limit]
            opens = np.flatnonzero(SPACE[some[:-1]] & ~SPACE[some[1:]])
            if len(opens):
                b += int(opens[0])
                break
            b += limit
        b = min(b, len(data))
        f = passages(data[a:b], np.array([0, b - a]), a)[1]
        if f.any() or (a == 0 and b == len(data)):
            yield f
        a = b


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, row: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
        """Everything on the way to the score; row ascending, at least one passage a row, x standardised."""
        p = self.p
        h = np.maximum(x @ p["W"] + p["b"], 0)
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        at = run_starts(row)
        n = np.diff(np.append(at, len(row)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a = e / np.repeat(np.add.reduceat(e, at), n)
        z = np.add.reduceat(a[:, None] * h, at)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -40, 40)))
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": y, "at": at, "n": n}

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if len(offs) == 2 and len(data) > 2 * PIECE:
            return np.array([self.pooled(long_passages(data))[1]])
        row, x = passages(data, offs)
        return self.forward(row, self.standard(x))["y"]

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """(encodings, both factors of the gate, attention before the softmax) of passages."""
        p = self.p
        h = np.maximum(self.standard(x) @ p["W"] + p["b"], 0)
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        return h, t, s, (t * s) @ p["w"]

    def pooled(self, parts: Iterable[np.ndarray]) -> tuple[np.ndarray, float, float, float]:
        """(weighted encoding, score, largest attention, sum of attention) of one document whose passages come in parts: largest value, sum and
        weighted sum of a softmax can be carried on."""
        top, total, z = -np.inf, 0.0, np.zeros(len(self.p["c"]))
        for x in parts:
            h, _, _, e = self.encoded(x)
            new = max(top, float(e.max()))
            a = np.exp(e - new)
            keep = np.exp(top - new) if total else 0.0
            top, total, z = new, total * keep + float(a.sum()), z * keep + a @ h
        z = z / max(total, 1e-300)
        return z, float(1 / (1 + np.exp(-np.clip(z @ self.p["c"] + self.p["d"], -40, 40)))[0]), top, total


def gradients(model: QualityModel, row: np.ndarray, x: np.ndarray, y: np.ndarray, total: int | None = None) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy over `total` documents (these), by each parameter; x standardised."""
    p, o = model.p, model.forward(row, x)
    gy = (o["y"] - y) / (total or len(y))
    g = {"c": o["z"].T @ gy, "d": np.array([gy.sum()])}
    gz = np.repeat(gy[:, None] * p["c"], o["n"], axis=0)
    ga = (gz * o["h"]).sum(1)
    ge = o["a"] * (ga - np.repeat(np.add.reduceat(o["a"] * ga, o["at"]), o["n"]))
    _passage_gradients(model, g, x, o["h"], o["t"], o["s"], o["a"], gz, ge)
    return g


def _passage_gradients(model: QualityModel, g: dict[str, np.ndarray], x: np.ndarray, h: np.ndarray, t: np.ndarray, s: np.ndarray, a: np.ndarray, gz: np.ndarray, ge: np.ndarray) -> None:
    """What passages add to g, from the gradients of their documents' encodings (gz) and of their attention (ge)."""
    p = model.p
    gts = ge[:, None] * p["w"]
    gt, gs = gts * s * (1 - t**2), gts * t * s * (1 - s)
    gh = (a[:, None] * gz + gt @ p["V"].T + gs @ p["U"].T) * (h > 0)
    for k, v in (("w", (t * s).T @ ge), ("V", h.T @ gt), ("U", h.T @ gs), ("W", x.T @ gh), ("b", gh.sum(0))):
        g[k] = g[k] + v if k in g else v


def long_gradients(model: QualityModel, parts: list[np.ndarray], y: float, total: int) -> dict[str, np.ndarray]:
    """gradients() of one document whose passages come in parts, not standardised."""
    z, score, top, mass = model.pooled(parts)
    gy = (score - y) / total
    g = {"c": z * gy, "d": np.array([gy])}
    gz = gy * model.p["c"]
    for x in parts:
        h, t, s, e = model.encoded(x)
        a = np.exp(e - top) / mass
        _passage_gradients(model, g, model.standard(x), h, t, s, a, np.broadcast_to(gz, h.shape), a * (h @ gz - z @ gz))
    return g


def beginning(mean: np.ndarray, scale: np.ndarray, seed: int = SEED) -> QualityModel:
    rng = np.random.default_rng(seed)
    d = len(mean)
    p = {"W": rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "w": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
    return QualityModel(mean, scale, p)


def descend(model: QualityModel, gradient: Callable[[QualityModel], dict[str, np.ndarray]], rounds: int = ROUNDS, ridge: float = 1e-4, rate: float = 0.05) -> QualityModel:
    """Adam over the gradient of all documents, with steps that get shorter to the end."""
    p = model.p
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        g = gradient(model)
        for k in p:
            grad = g[k] + ridge * p[k]
            m1[k] = 0.9 * m1[k] + 0.1 * grad
            m2[k] = 0.99 * m2[k] + 0.01 * grad**2
            p[k] = p[k] - rate * (1 - 0.9 * (step - 1) / rounds) * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
    return model


def train(row: np.ndarray, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, seed: int = SEED) -> QualityModel:
    """A model of bags that are at hand as arrays."""
    model = beginning(x.mean(0), x.std(0) + 1e-3, seed)
    xs = model.standard(x)
    return descend(model, lambda m: gradients(m, row, xs, y), rounds)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, rest: int = 0, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> QualityModel:
    """Learn from labels (doc_id, quality) of rows outside the held-out part, at most fit_rows of them, on all their passages.

    Executors turn the sampled texts into bags of passage features (2 bytes a number, a row a text), which are written to the shared folder
    once.  Each round sends the parameters to the parts of that table and brings back one sum of gradients from each; no bag comes
    to the driver.  Without labels of both kinds every score is the mean label (0.5 without any).
    """
    sample = labelled_sample(docs, labels, label, modulus, rest, fit_rows)

    def bags(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            y = np.asarray(rb.column("y"))
            for a, b, data, offs in slices(rb.column("text"), PIECE):
                if b - a == 1 and len(data) > 2 * PIECE:
                    held = [b"".join(f.astype(np.float16).tobytes() for f in long_passages(data))]
                else:
                    r, f = passages(data, offs)
                    f = f.astype(np.float16)
                    at = np.searchsorted(r, np.arange(b - a + 1))
                    held = [f[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([rb.column("doc_id").slice(a, b - a), pa.array(y[a:b]), pa.array(held, pa.large_binary()).cast(pa.binary())], names=["doc_id", "y", "bag"])

    made = sample.mapInArrow(bags, "doc_id long, y int, bag binary")
    parts = max(1, -(-min(fit_rows, labels.where(F.col(label).isin(0, 1)).count()) // FIT_PART))
    table = materialize(made.repartition(parts, F.xxhash64("doc_id")).sortWithinPartitions("doc_id", "y"), "quality-bags")

    def sizes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, docs_, ones, s, q = 0, 0, 0, np.zeros(WIDTH), np.zeros(WIDTH)
        for rb in it:
            docs_ += rb.num_rows
            ones += int(np.asarray(rb.column("y")).sum())
            for bag in rb.column("bag"):
                for x in _parts(bag.as_py()):
                    n, s, q = n + len(x), s + x.sum(0), q + (x * x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([docs_]), pa.array([ones]), pa.array([np.concatenate([s, q]).tobytes()], pa.binary())], names=["n", "docs", "ones", "sums"])

    got = table.mapInArrow(sizes, "n long, docs long, ones long, sums binary").collect()  # a row a part
    n, total, ones = (sum(r[k] for r in got) for k in ("n", "docs", "ones"))
    if not ones or ones == total:
        discard(table)
        share = min(max(ones / total if total else 0.5, 1e-6), 1 - 1e-6)
        p = {"W": np.zeros((WIDTH, 1)), "b": np.zeros(1), "V": np.zeros((1, 1)), "U": np.zeros((1, 1)), "w": np.zeros(1), "c": np.zeros(1), "d": np.array([np.log(share / (1 - share))])}
        return QualityModel(np.zeros(WIDTH), np.ones(WIDTH), p)
    s, q = np.split(np.sum([np.frombuffer(r.sums) for r in got], axis=0), 2)
    mean = s / n
    model = beginning(mean, np.sqrt(np.maximum(q / n - mean**2, 0)) + 1e-3)

    def of_all(m: QualityModel) -> dict[str, np.ndarray]:
        def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g: dict[str, np.ndarray] = {}
            held: list[np.ndarray] = []
            ys: list[float] = []

            def add(new: dict[str, np.ndarray]) -> None:
                for k, v in new.items():
                    g[k] = g[k] + v if k in g else v

            def flush() -> None:
                if held:
                    add(gradients(m, np.repeat(np.arange(len(held)), [len(x) for x in held]), m.standard(np.concatenate(held)), np.array(ys), total))
                    held.clear()
                    ys.clear()

            for rb in it:
                for y, bag in zip(rb.column("y").to_pylist(), rb.column("bag"), strict=True):
                    parts = list(_parts(bag.as_py(), np.float16))
                    if len(parts) > 1:
                        add(long_gradients(m, parts, y, total))
                        continue
                    held.append(parts[0].astype(np.float32))
                    ys.append(y)
                    if sum(map(len, held)) >= SOME:
                        flush()
            flush()
            if g:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([np.asarray(g[k], float).reshape(-1) for k in sorted(g)]).tobytes()], pa.binary())], names=["g"])

        flat = np.sum([np.frombuffer(r.g) for r in table.select("y", "bag").mapInArrow(part, "g binary").collect()], axis=0)
        cut = np.cumsum([m.p[k].size for k in sorted(m.p)])[:-1]
        return {k: v.reshape(m.p[k].shape) for k, v in zip(sorted(m.p), np.split(flat, cut), strict=True)}

    descend(model, of_all, rounds)
    discard(table)
    return model


def _parts(bag: bytes, kind: type = np.float32) -> Iterator[np.ndarray]:
    """A bag's features, SOME passages at a time."""
    x = np.frombuffer(bag, np.float16).reshape(-1, WIDTH)
    for a in range(0, len(x), SOME):
        yield x[a : a + SOME].astype(kind, copy=False)


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; the score rests on the whole text alone.

    Null and empty texts are scored as one passage without bytes; rows without doc_id are scored too (held_out
    false); repeated rows score alike; other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            s = np.zeros(rb.num_rows)
            for a, b, data, offs in slices(rb.column("text"), PIECE):
                s[a:b] = shared.value.scores(data, offs)
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), rb.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(5, 0).alias("held_out"), "text")
    return base.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")

import numpy as np
import pytest

from strandline.llm import quality as ql
from strandline.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return ql.fit_quality(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_accuracy(spark, model):
    rows = ql.score_quality(table(spark, SF, "documents"), model).join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_passages_cover_whole_words_of_each_text():
    texts = ["one two " * 300, "", "   ", "x" * 5000, "a b"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.append(0, np.cumsum([len(t) for t in texts]))
    row, x = ql.passages(data, offs)
    assert np.bincount(row).tolist() == [5, 1, 1, 1, 1]
    assert np.isfinite(x).all() and (x[row == 1] == 0).all()


def test_attention_weighs_passages():
    rng = np.random.default_rng(2)
    rows, x, y = [], [], []
    for i in range(300):
        n, bad = rng.integers(1, 9), i % 2
        f = rng.normal(0, 1, (n, 5))
        if bad:
            f[rng.integers(n), 0] += 8
        rows += [i] * n
        x.append(f)
        y.append(bad)
    row, x, y = np.array(rows), np.concatenate(x), np.array(y, float)
    m = ql.train(row, x, y, rounds=600)
    o = m.forward(row, m.standard(x))
    assert np.mean((o["y"] > 0.5) == (y == 1)) > 0.97
    assert np.allclose(np.add.reduceat(o["a"], o["at"]), 1)


def _small(seed, docs=5, width=6):
    rng = np.random.default_rng(seed)
    n = rng.integers(1, 5, docs)
    row = np.repeat(np.arange(docs), n)
    p = {k: rng.normal(0, 0.7, shape) for k, shape in {"W": (width, 4), "b": 4, "V": (4, 3), "U": (4, 3), "w": 3, "c": 4, "d": 1}.items()}
    model = ql.QualityModel(np.zeros(width), np.ones(width), p)
    return model, row, rng.normal(0, 1, (len(row), width)), rng.integers(0, 2, docs).astype(float)


def _loss(model, row, x, y):
    p = model.forward(row, x)["y"]
    return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))


@pytest.mark.parametrize("name", ["W", "b", "V", "U", "w", "c", "d"])
def test_gradient_matches_differences(name):
    for seed in range(3):
        model, row, x, y = _small(seed)
        got = ql.gradients(model, row, x, y)[name]
        flat = model.p[name].reshape(-1)
        for i in range(len(flat)):
            was, step = flat[i], 1e-6
            flat[i] = was + step
            up = _loss(model, row, x, y)
            flat[i] = was - step
            down = _loss(model, row, x, y)
            flat[i] = was
            assert abs(got.reshape(-1)[i] - (up - down) / (2 * step)) < 1e-6


def test_forward_against_a_plain_loop():
    model, row, x, _ = _small(8, docs=7)
    p, o = model.p, model.forward(row, x)
    for d in range(7):
        h = [np.maximum(v @ p["W"] + p["b"], 0) for v in x[row == d]]
        e = np.array([p["w"] @ (np.tanh(p["V"].T @ v) / (1 + np.exp(-(p["U"].T @ v)))) for v in h])
        a = np.exp(e) / np.exp(e).sum()
        z = sum(w * v for w, v in zip(a, h, strict=True))
        assert np.allclose(o["y"][d], 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0]))))
        assert np.allclose(o["a"][row == d], a)


def test_scores_against_a_plain_loop(spark, model):
    """The query's score of whole texts, passage by passage."""
    texts = ["one two three. " * 80, "A short text", "", "xyz " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in ql.score_quality(df, model).collect()}
    for i, t in enumerate(texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        _, x = ql.passages(raw, np.array([0, len(raw)]))
        p = model.p
        h = [np.maximum(v @ p["W"] + p["b"], 0) for v in model.standard(x)]
        e = np.array([p["w"] @ (np.tanh(p["V"].T @ v) / (1 + np.exp(-(p["U"].T @ v)))) for v in h])
        a = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
        z = sum(w * v for w, v in zip(a, h, strict=True))
        assert abs(got[i] - 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))) < 1e-6


def test_hashed_words_of_a_passage():
    data = np.frombuffer(b"The cat the CAT", np.uint8)
    _, x = ql.passages(data, np.array([0, 15]))
    counts = np.sort((x[0, ql.STATS :] ** 2)[x[0, ql.STATS :] > 0])
    # the, cat twice each; the-cat twice, cat-the once: 7 in all
    assert np.allclose(counts, [1 / 7, 2 / 7, 2 / 7, 2 / 7])


def test_edge_cases(spark, model):
    rows = [(1, None), (2, ""), (None, "text"), (3, "y" * 300_000), (3, "y" * 300_000), (4, "é " * 9)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = ql.score_quality(df, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({round(r.score, 9) for r in got if r.doc_id in (1, 2)}) == 1
    assert ql.score_quality(df.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert [r.score for r in ql.score_quality(docs, ql.fit_quality(docs, labels)).collect()] == [0.5]


def test_a_long_text_by_pieces_has_the_same_passages_and_score(model):
    rng = np.random.default_rng(6)
    parts = [b"".join(bytes(rng.integers(97, 123, rng.integers(1, 12)).astype(np.uint8)) + b" " * int(rng.integers(1, 4)) for _ in range(4000)), b"x" * 30_000, b" " * 5000, b"a. B,c\n" * 2000]
    for text in (b"".join(parts), b" " * 9000 + parts[0], parts[1], b" " * 9000, b""):
        data = np.frombuffer(text, np.uint8)
        _, whole = ql.passages(data, np.array([0, len(data)]))
        for limit in (512, 1024, 7000):
            got = list(ql.long_passages(data, limit))
            if got:
                assert np.allclose(np.concatenate(got), whole)
                z, score, _, _ = model.pooled(got)
                assert abs(score - model.forward(np.zeros(len(whole), int), model.standard(whole))["y"][0]) < 1e-9
            else:
                assert not text


def test_gradients_of_a_document_in_parts():
    for seed in range(4):
        model, row, x, y = _small(seed, docs=1)
        x = np.concatenate([x, x[::-1] * 0.5, x * 2])
        row = np.zeros(len(x), int)
        want = ql.gradients(model, row, model.standard(x), y, 3)
        got = ql.long_gradients(model, [x[:1], x[1:3], x[3:]], float(y[0]), 3)
        assert all(np.allclose(got[k], want[k]) for k in want)


def test_the_gradient_over_parts_of_the_table_is_that_of_all_passages(spark, monkeypatch):
    """One round of the distributed fit against the same round over one array; no passage is left out."""
    rng = np.random.default_rng(1)
    texts = ["word " * int(rng.integers(1, 900)) if i % 3 else " ".join("ab"[j % 2] * int(rng.integers(1, 9)) for j in range(300)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "doc_id long, quality int")
    kept = [i for i, in docs.select("doc_id").where(~ql.held_out(5, 0)).collect()]
    row, x = ql.passages(np.frombuffer("".join(texts[i] for i in kept).encode(), np.uint8), np.append(0, np.cumsum([len(texts[i]) for i in kept])))
    x = x.astype(np.float16).astype(np.float32)
    want = ql.train(row, x, np.array([float(i % 3 == 0) for i in kept]), rounds=3)
    for some in (2048, 3):
        monkeypatch.setattr(ql, "SOME", some)
        got = ql.fit_quality(docs, labels, rounds=3)
        assert np.allclose(got.mean, want.mean, atol=1e-6) and all(np.allclose(got.p[k], want.p[k], atol=1e-3) for k in want.p)
    again = ql.fit_quality(docs, labels, rounds=3)
    assert all((got.p[k] == again.p[k]).all() for k in got.p)


def test_a_hash_of_one_long_span():
    from strandline.llm.common import prefix_hash, span_hash, spans_hash

    data = np.frombuffer(b"ab cd" * 4000, np.uint8)
    start, end = np.array([0, 3, 5000]), np.array([2, 4500, 19_000])
    assert (spans_hash(data, start, end, limit=1000) == span_hash(prefix_hash(data), start, end)).all()

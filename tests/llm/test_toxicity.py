import numpy as np
import pytest

from strandline.llm import toxicity as tx
from strandline.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return tx.fit_toxicity(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_accuracy(spark, model):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = tx.score_toxicity(docs, model).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.toxic for r in rows])
    assert len(rows) > 50 and right > 0.9
    assert sum(r.predicted for r in rows if r.toxic == 1) >= 0.6 * sum(r.toxic for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("seen", ["1d10t", "i.d.i.o.t", "iiidiot", "idiooot", "!d!0t", "m0r0n", "l0ser", "5tup1d", "s-c-u-m", "w0rthle55", "tr@sh"])
def test_obfuscated_words_are_restored(seen):
    lm = tx.CharModel(np.ones(28**3), ["idiot", "moron", "loser", "stupid", "scum", "worthless", "trash", "clown"])
    assert lm.decode(seen) in ("idiot", "moron", "loser", "stupid", "scum", "worthless", "trash", "clown")


def test_restored_text():
    lm = tx.CharModel(np.ones(28**3), ["idiot", "moron"])
    assert lm.restore("you, are an i d i o t and 'M0R0N'!!!") == "you are an idiot and moron"
    assert lm.restore("Ábc 2024 plain.$$$") == "ábc 2024 plain"


def test_each_word_has_a_lattice():
    lm = tx.CharModel(np.ones(28**3), ["idiot", "moron", "letter", "id"])
    assert lm.restore("an iidiot, $c.um m.o.r.o.n letter 1337") == "an idiot scum moron letter 1337"
    # two single letters are one word only where that is likelier
    assert lm.restore("i d") == "id" and tx.CharModel(np.eye(28)[:, None, :].repeat(28, 1).ravel() + 0.01, []).decode("x y") == "x y"
    # only the identity: no decoding needed
    for word in ("plain", "ábc", "2024", "one"):
        t = tx.tokens(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())]))
        assert not t.noisy and len(t.start) == 1
        assert lm.decode(word) == word or word.isdigit()


def test_kept_columns_of_result_names(spark, model):
    df = spark.createDataFrame([(1, "a text", "s", 7)], "doc_id long, text string, score string, other int")
    out = tx.score_toxicity(df, model, keep=("doc_id", "text", "score", "other"))
    assert out.columns == ["doc_id", "held_out", "score", "predicted", "text", "other"] and out.first().other == 7


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    lm = tx.CharModel(rng.integers(1, 50, 28**3))

    def score(seen, spelled):
        """Best cost of one spelled-out choice per character."""
        a = b = 27
        p = 0.0
        for ch, c in zip(seen, spelled, strict=True):
            p -= (tx.COST["drop_repeat"] if c == "" and ch not in tx.LEET else tx.COST["drop_mark"] if c == "" else 0.0 if c == ch and ch not in tx.LEET else tx.COST["digit"] if c == ch else tx.COST["leet"])
            if c:
                k = tx._class(c)
                p += lm.logp[a][b][k]
                a, b = b, k
        return p + lm.logp[a][b][27]

    import itertools

    for seen in ("1d10t", "a6b", "s$x9"):
        options = [[*tx.LEET[c], "", *([c] if c.isdigit() else [])] if c in tx.LEET else [c] for c in seen]
        best = max(itertools.product(*options), key=lambda s: score(seen, s))
        assert lm.decode(seen) == "".join(best)


def test_edge_cases(spark, model):
    rows = [(1, None), (2, ""), (None, "idiot"), (3, "x" * 200_000), (3, "x" * 200_000), (4, "a b c d e f"), (5, "$$$ !!! ...")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, score string")
    got = tx.score_toxicity(df, model).collect()
    assert len(got) == len(rows) and not any(np.isnan(r.score) for r in got)
    assert tx.score_toxicity(df.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    m = tx.fit_toxicity(docs, labels)
    assert [r.score for r in tx.score_toxicity(docs, m).collect()] == [0.5]


def test_score_against_a_plain_loop(spark, model):
    """The query's score of whole texts, word by word: restored words and their beginnings, each once, times their weights."""
    docs = table(spark, SF, "documents").where("doc_id % 9 = 0").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in docs} | {-1: "you 1d10t, s-c-u-m i d i o t l0ser l0ser!!", -2: "ALL the aaa bbb a.b.c $$$ 2024 x y z"}
    got = {r.doc_id: r.score for r in tx.score_toxicity(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))

    def hashed(word):
        raw = np.frombuffer(word, np.uint8)
        yield int(tx.spans_hash(raw, np.array([0]), np.array([len(raw)]))[0])
        for k in tx.PREFIXES:
            if len(raw) > k:
                yield int(tx.spans_hash(raw, np.array([0]), np.array([k]))[0] ^ np.uint64(k))

    seen = 0
    for i, text in texts.items():
        on = {h for w in model.lm.restore(text).split(" ") if w for h in hashed(w.encode()) if h in weight}
        seen += bool(on)
        z = sum(weight[h] for h in on) + model.bias
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(z, -40, 40)))) < 1e-9
    assert seen > 5


def test_fits_agree_to_the_bit(spark, model):
    again = tx.fit_toxicity(table(spark, SF, "documents").repartition(3), table(spark, SF, "labels"))
    assert (again.hashes == model.hashes).all() and (again.weights == model.weights).all() and again.bias == model.bias

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from strandline.llm import pieces as pc


@pytest.fixture(scope="module")
def vocab():
    return pc.Pieces()


def encode(v, texts, key=None, seed=9):
    raws = [t if isinstance(t, bytes) else t.encode() for t in texts]
    data = np.frombuffer(b"".join(raws), np.uint8)
    offs = np.append(0, np.cumsum([len(r) for r in raws])).astype(np.int64)
    ids, at = v.encode(data, offs, np.array(key if key is not None else range(len(texts)), dtype=np.int64), seed)
    return [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


TEXTS = ["hello world", "", " ", "  two  blanks ", "\n\ttab", "naïve ſtraße ﬁ", "▁literal▁ ▁", "日本語 テスト 🙂🙂", "<s> <0x0A> </s> <unk>", "a" * 500, "x", "   ", b"\xff\xfe bad \x80utf"]


def test_lossless(vocab):
    for t, ids in zip(TEXTS, encode(vocab, TEXTS), strict=True):
        raw = t if isinstance(t, bytes) else t.encode()
        assert vocab.decode(ids) == raw


def test_rows_do_not_depend_on_their_batch(vocab):
    together = encode(vocab, TEXTS)
    for i, t in enumerate(TEXTS):
        assert (encode(vocab, [t], [i])[0] == together[i]).all()
    other = encode(vocab, ["a longer text with several words in it " * 5] * 2, [1, 2])
    assert other[0].tolist() != other[1].tolist()


def test_probabilities_are_those_of_all_segmentations(vocab):
    """Forward sums and draws against an enumeration of every path."""
    word = "the"
    s = "▁" + word
    index = {}
    for h, i, w in zip(vocab.hash, vocab.id, vocab.logw, strict=True):
        index[int(h)] = (int(i), w)
    paths = {}
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        at = [0] + [i + 1 for i, c in enumerate(cuts) if c] + [len(s)]
        parts = [index.get(int(vocab._hash_of(s[a:b]))) for a, b in zip(at, at[1:], strict=False)]
        if all(parts):
            paths[tuple(i for i, _ in parts)] = math.exp(sum(w for _, w in parts))
    total = sum(paths.values())
    n = 20_000
    drawn = Counter(tuple(x.tolist()) for x in encode(vocab, [word] * n))
    assert set(drawn) <= set(paths)
    for p, w in paths.items():
        want = w / total
        assert abs(drawn[p] / n - want) < 4 * math.sqrt(want * (1 - want) / n) + 1e-4


def test_data_frame(spark, vocab):
    rows = [(1, "some text here"), (1, "some text here"), (2, None), (None, "no id"), (3, ""), (4, "é " * 3000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, ids string")
    out = pc.encode_sampled(df)
    got = out.collect()
    assert len(got) == 6 and all(r.lossless for r in got)
    assert len({tuple(r.ids) for r in got if r.doc_id == 1}) == 1
    assert [r.ids for r in got if r.doc_id == 2] == [None]
    assert [r.ids for r in got if r.doc_id == 3] == [[]]
    back = sorted(((r.doc_id, r.text) for r in pc.decode_pieces(out).collect()), key=str)
    assert back == sorted(rows, key=str)
    assert pc.encode_sampled(df.limit(0)).count() == 0


def test_long_rows_in_pieces():
    rng = random.Random(17)
    v = pc.Pieces()
    text = "".join(rng.choice(["word ", "  two", "é", "▁x ", "\n", "abc", " 99 "]) for _ in range(3000))
    data = np.frombuffer(text.encode(), np.uint8)
    key, offs = np.array([7]), np.array([0, len(data)])
    whole, _ = v.encode(data, offs, key)
    for limit in (50, 997, len(data) - 1):
        ids, at = v.encode(data, offs, key, limit=limit)
        assert ids.tolist() == whole.tolist() and at.tolist() == [0, len(ids)]
    assert v.decode(whole) == text.encode()
    solid = np.frombuffer(b"x" * 500, np.uint8)
    assert v.decode(v.encode(solid, np.array([0, 500]), key, limit=90)[0]) == b"x" * 500


def _blank_free(seed, n):
    rng = np.random.default_rng(seed)
    return "".join(rng.choice(list("日本語中文的是在thequickAB+/09aeé"), n))


def test_parts_of_a_long_chunk_have_the_probabilities_of_the_whole():
    v = pc.Pieces()
    s, _ = pc.codepoints(np.frombuffer(_blank_free(1, 900).encode(), np.uint8), np.array([0, len(_blank_free(1, 900).encode())]))
    whole = v.lattice(s, np.array([0]), np.array([len(s)]))
    head, cum, _ = v.forward(np.array([0]), np.array([len(s)]), whole[0], whole[1], whole[3])
    at = np.append(0, v.uncrossed(s))
    assert len(at) > 100
    parts = v.lattice(s, at, np.diff(np.append(at, len(s))))
    head2, cum2, _ = v.forward(at, np.diff(np.append(at, len(s))), parts[0], parts[1], parts[3])
    # the same arcs, and at each place the same shares of them
    assert all((a == b).all() for a, b in zip(whole[:3], parts[:3], strict=True)) and np.allclose(cum, cum2)


def test_a_long_text_without_blanks_by_pieces(monkeypatch):
    v = pc.Pieces()
    for seed, text in enumerate((_blank_free(2, 9000), _blank_free(3, 3000) + " word " + _blank_free(4, 5000), "a b c " * 50 + _blank_free(5, 4000), "x" * 3000)):
        data = np.frombuffer(text.encode(), np.uint8)
        want, _ = v.encode(data, np.array([0, len(data)]), np.array([seed]), limit=1 << 30)
        monkeypatch.setattr(pc, "WINDOW", 100 + 150 * seed)
        for limit in (1500, 4000):
            got, _ = v.encode(data, np.array([0, len(data)]), np.array([seed]), limit=limit)
            assert v.decode(got) == text.encode() and (got == want).all(), (seed, limit)


def test_ten_megabytes_without_blanks():
    import time

    v = pc.Pieces()
    for alphabet, size in (("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 2_000_000), ("的是在日本語中文字漢検索画面水曜", 700_000)):
        data = np.frombuffer("".join(np.random.default_rng(1).choice(list(alphabet), size)).encode(), np.uint8)
        began = time.process_time()
        ids, _ = v.encode(data, np.array([0, len(data)]), np.array([1]))
        assert v.decode(ids) == data.tobytes() and time.process_time() - began < 40

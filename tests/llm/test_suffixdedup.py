import hashlib
import random

import numpy as np
import pytest

from strandline.llm import suffixdedup as sd


def brute(rows, length):
    """rows: (doc_id, text) in document order; per row the sorted set of removed byte places."""
    seen, out = set(), []
    for _, text in rows:
        raw, gone = text.encode(), set()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone |= set(range(i, i + length))
            seen.add(w)
        out.append(gone)
    return out


def expected(rows, length):
    out = {}
    for (doc_id, text), gone in zip(rows, brute(rows, length), strict=True):
        raw = text.encode()
        spans = sum(1 for i in gone if i - 1 not in gone)
        out[doc_id] = (len(raw), len(gone), spans, hashlib.sha256(bytes(b for i, b in enumerate(raw) if i not in gone)).hexdigest())
    return out


def test_deep_shallow_sorts_and_splits():
    rng = random.Random(1)
    text = "".join(rng.choice("ab") for _ in range(3000)) + "xyz" * 100 + "q" * 300
    raw = text.encode()
    starts = np.arange(len(raw) - 100)
    group = np.sort(np.array([rng.randrange(3) for _ in starts]))
    order, new = sd.deep_shallow(raw, starts, group, 100, 32)
    keys = [(group[i], raw[starts[i] : starts[i] + 100]) for i in order]
    assert keys == sorted(keys)
    assert list(new) == [i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))]


def test_blind_trie():
    rng = random.Random(2)
    keys = [bytes(rng.choice(b"ab") for _ in range(8)) for _ in range(500)]
    trie = sd.BlindTrie()
    for i, k in enumerate(keys):
        trie.insert(k, i)
    got = [(keys[c[0]], sorted(c)) for c in trie.classes()]
    assert got == sorted((k, [i for i, x in enumerate(keys) if x == k]) for k in set(keys))


def _docs():
    rng = random.Random(3)
    w = lambda n: " ".join("".join(rng.choice("abcdéñ") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    passage, base = w(30), w(120)
    texts = [base, w(50), passage + w(20), w(10) + passage, base, base[:300] + "X" + base[301:], "ab" * 300, "", "short", "z" * 99, "z" * 100, "z" * 250, base[150:400]]
    words = base.split()
    for i in range(12):
        v = list(words)
        v[i * 7] = "edit%d" % i
        texts.append(" ".join(v))
    texts += [w(5) + base[10:110] + w(3), passage[:150], passage * 3, w(3000) + passage + w(10)]
    return [(7 * i, t) for i, t in enumerate(texts)]


def test_multikey_quicksort_orders_and_splits():
    rng = random.Random(4)
    for kinds, n in (("ab", 3000), ("abcdefgh \x00\xff", 3000), ("a", 200)):
        raw = "".join(rng.choice(kinds) for _ in range(n)).encode("latin-1")
        starts = np.array([rng.randrange(len(raw) - 40) for _ in range(n)])
        group = np.sort(np.array([rng.randrange(5) for _ in starts]))
        for shallow in (0, 8, 32):
            order, new = sd.multikey_quicksort(raw, starts, group, shallow)
            assert sorted(order.tolist()) == list(range(n))
            keys = [(group[i], raw[starts[i] : starts[i] + shallow]) for i in order]
            assert keys == sorted(keys)
            assert list(new) == [i == 0 or keys[i] != keys[i - 1] for i in range(n)]


@pytest.mark.parametrize("heavy,flush,batch", [(512, 250_000, 1 << 21), (1, 250_000, 1 << 21), (2, 40, 50)])
def test_against_brute_force(spark, heavy, flush, batch):
    limits = sd.Limits(heavy=heavy, flush=flush, batch=batch)
    rows = _docs()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_spans string")
    for length, gram in ((100, 32), (40, 16)):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup_substrings(df, length, gram, limits=limits).collect()}
        assert got == expected(rows, length)


@pytest.mark.parametrize("spreads", [(9, 1), (9,), (1,), (30, 5)])
def test_heavy_anchors_are_split_exactly(spark, spreads):
    limits = sd.Limits(heavy=3, flush=60, batch=500, spreads=spreads)
    rng = random.Random(9)
    line = "this very common line of text stands in all documents, whatever else they say."
    w = lambda: "".join(rng.choice("abcde ") for _ in range(150))
    rows = [(i, w() + (line if i % 3 else line[:60] + line) + ("same tail of thirty bytes here" if i % 2 else "") + w()) for i in range(120)]
    rows += [(200 + i, rows[i][1][40:260]) for i in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup_substrings(df, limits=limits).collect()}
    assert got == expected(rows, 100)
    base = df.selectExpr("doc_id", "xxhash64(text) as th", "text")
    first, total = sd._heavy(base, 100, 32, [], 4, limits)
    again, _ = sd._heavy(base, 100, 32, [first], 4, limits)
    assert len(first) and total > len(rows) and (len(again) > 0 or spreads == (1,))


def test_nulls_repeats_and_empty_tables(spark):
    long = "abcdefghij" * 3 + "".join(chr(97 + i * 7 % 26) for i in range(120))
    rows = [(1, long), (1, long), (2, None), (None, long), (3, long + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text, r.n_removed, r.n_spans) for r in sd.dedup_substrings(df).collect()]
    assert sorted(got, key=str) == sorted([(1, long, 0, 0), (1, long, 0, 0), (2, "", 0, 0), (None, long, 0, 0), (3, "!", len(long), 1)], key=str)
    assert sd.dedup_substrings(df.limit(0)).count() == 0


def test_removals_end_at_whole_characters():
    raw = "aéb".encode()
    assert sd.whole_characters(raw, [2], [4]) == "aé"
    assert sd.whole_characters(raw, [0], [2]) == "éb"
    assert sd.whole_characters(raw, [1], [3]) == "ab"


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(sd, "SLICE_BYTES", 500)
    rng = random.Random(5)
    raw = "".join(rng.choice("abc ") for _ in range(4000)).encode()
    data, offs = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    row, pos, cnt, anchor, _, _ = sd.segments(data, offs)
    assert (np.diff(np.sort(np.concatenate([np.arange(p, p + c) for p, c in zip(pos, cnt, strict=True)]))) == 1).all()
    assert cnt.sum() == len(raw) - 99

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strandline.llm import common
from strandline.llm import ngramjoin as nj


def shingle_set(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute(rows, num=4, den=5):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) * den >= num * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def documents(seed, groups=12, near=14):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, out = text(60), []
    for g in range(groups):
        base = text(rng.choice([6, 12, 40, 80, 200]))
        for _ in range(rng.randrange(1, near)):
            v = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            out.append(v)
        out += [passage + text(rng.choice([15, 100])) for _ in range(4)]
    # chains: each links to the next only
    v = text(100)
    for i in range(10):
        v = list(v)
        v[i * 9], v[i * 9 + 4] = "x%d" % i, "y%d" % i
        out.append(v)
    out += [["a"], ["A"], ["b", "c"], ["b", "C", "d"], [], ["é", "É"]]
    rng.shuffle(out)
    return [(3 * i + 1, (" " if i % 5 else "\n\t").join(v)) for i, v in enumerate(out)]


@pytest.mark.parametrize("seed,often,long,tile", [(1, 16, 64, 1024), (2, 2, 3, 4), (3, 1000, 5, 1024)])
def test_against_brute_force(spark, monkeypatch, seed, often, long, tile):
    for name, value in (("OFTEN", often), ("LONG", long), ("TILE", tile)):
        monkeypatch.setattr(nj, name, value)
    rows = documents(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_components(df).collect())
    assert got == brute(rows)


def test_tile_links():
    rng = np.random.default_rng(5)
    base = rng.choice(10_000, 60, replace=False).astype(np.uint64)
    sets = [np.unique(np.append(rng.choice(base, rng.integers(40, 60), replace=False), rng.integers(20_000, 30_000, rng.integers(0, 6)).astype(np.uint64))) for _ in range(40)]
    comp, tile = np.arange(40), np.arange(40) % 2
    linked = lambda i, j: len(np.intersect1d(sets[i], sets[j])) * 5 >= 4 * len(np.union1d(sets[i], sets[j]))

    def groups(edges):
        label = list(range(40))
        for i, j in edges:
            label = [label[i] if x == label[j] else x for x in label]
        return [label.index(x) for x in label]

    for same in (True, False):
        a, b = nj.tile_links(sets, comp, tile, same, 4, 5)
        assert all(linked(i, j) and (same or tile[i] != tile[j]) for i, j in zip(a, b, strict=True))
        want = [(i, j) for i in range(40) for j in range(i) if linked(i, j) and (same or tile[i] != tile[j])]
        assert groups(want) == groups(list(zip(a.tolist(), b.tolist(), strict=True)))
    assert nj.tile_links([], np.zeros(0, int), np.zeros(0, int), True, 4, 5)[0].tolist() == []


def test_spans_of_long_texts():
    rng = np.random.default_rng(9)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    start = np.sort(rng.integers(0, 4800, 300))
    end = start + rng.integers(1, 200, 300)
    whole = common.span_hash(common.prefix_hash(data), start, end)
    for limit in (1, 77, 1000, 10_000):
        assert (common.spans_hash(data, start, end, limit) == whole).all()


def test_a_very_long_text(spark):
    words = ["w%d" % (i * 7919 % 100_003) for i in range(900_000)]
    text = " ".join(words)
    other = " ".join(["x"] * 3 + words[:-3])
    df = spark.createDataFrame([(5, text), (3, other), (9, "one two")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.jaccard_components(df).collect()}
    assert len(text) > 2 * common.SLICE_BYTES
    assert got[5] == (len(shingle_set(text)), 3) and got[3][1] == 3 and got[9] == (1, 9)


def test_shingles_of_a_slice():
    texts = ["A b  c d E f", "", None, "x y", "a B c d e", "é" * 3]
    got = {}
    for a, _, data, offs in common.slices(pa.array(texts)):
        r, h = nj.shingles(data, offs)
        for i in range(len(offs) - 1):
            got[a + i] = h[r == i]
    assert [len(got[i]) for i in range(6)] == [2, 0, 0, 1, 1, 1]
    assert np.isin(got[4], got[0]).all()


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "a b c"), (4, "A B C"), (5, " "), (4, "other words here")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, cls string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 1, 1), (2, 0, 2), (3, 0, 3), (None, 1, None), (4, 1, 1), (5, 0, 5), (4, 1, 4)], key=str)
    kept = sorted(((r.doc_id, r.text, r.cls) for r in nj.one_of_each(df).collect()), key=str)
    assert kept == sorted([(1, "a b c", "clash"), (2, None, "clash"), (3, "", "clash"), (None, "a b c", "clash"), (5, " ", "clash"), (4, "other words here", "clash")], key=str)
    assert nj.jaccard_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("hot,edges_a_task", [(512, 1 << 20), (512, 9), (2, 9)])
def test_components(spark, monkeypatch, hot, edges_a_task):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    monkeypatch.setattr(common, "EDGES", edges_a_task)
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (100, 102), (7, 7), (None, 3)] + [(500, 600 + i) for i in range(50)] + [(620, 499)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    got = {r.node: r.component for r in common.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100} | {499: 499, 500: 499} | {600 + i: 499 for i in range(50)}
    assert common.components(df.limit(0)).count() == 0


def test_stars():
    rng = np.random.default_rng(3)
    for n, m in ((50, 30), (50, 80), (2000, 1900)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        label = list(range(n))
        for _ in range(n):
            before = list(label)
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                label[x] = label[y] = min(label[x], label[y])
            if before == label:
                break
        node, least = common.stars(a, b)
        assert dict(zip(node.tolist(), least.tolist(), strict=True)) == {i: x for i, x in enumerate(label) if i != x}
    # a long path in mixed order
    order = rng.permutation(3000)
    node, least = common.stars(order[:-1], order[1:])
    assert len(node) == 2999 and (least == 0).all()


def test_salted_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    left = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 100), (3, 101), (None, 102), (None, 103)], "k long, x long")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "k long, y string")
    hot = common.hot_keys(left.groupBy("k").count().withColumnRenamed("count", "n"), ["k"])
    assert [(r.k, r.salts) for r in hot.collect()] == [(1, 14)]
    rows = sorted(((r.x, r.y) for r in common.salted_join(left, right, ["k"], "x", hot, "left").collect()))
    assert rows == [(i, "a") for i in range(40)] + [(100, "b"), (101, None), (102, None), (103, None)]
    assert common.salted_join(left, right, ["k"], "x", hot).count() == 41


def test_hot_groups_keep_the_result(spark, monkeypatch):
    """Hubs, components and classes of many rows, all salted, and blocks in many tiles."""
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    monkeypatch.setattr(common, "EDGES", 20)
    for name, value in (("OFTEN", 2), ("LONG", 3), ("TILE", 4), ("HUBS", 1), ("FREQUENT", 50)):
        monkeypatch.setattr(nj, name, value)
    rows = documents(7, groups=8)
    rows += [(5000 + i, rows[3][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_components(df).collect())
    assert got == brute(rows)


def test_a_block_of_many_rows(spark):
    """One block of many sets, nearly all of which the hubs connect already: connected rows are not multiplied with each other."""
    rng = random.Random(21)
    base = ["b%d" % i for i in range(60)]
    rows = []
    for i in range(6000):
        v = list(base)
        v[0] = "x%d" % i
        rows.append((i, " ".join(v)))
    # the same passage with a fifth or more of other words: in the block, linked with nothing
    rows += [(6000 + i, " ".join(base[:50] + ["y%d_%d" % (i, j) for j in range(25)])) for i in range(40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in nj.jaccard_components(df).collect()}
    assert got == {i: 0 for i in range(6000)} | {6000 + i: 6000 + i for i in range(40)}

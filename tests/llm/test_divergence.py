import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandline.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=3, top=200):
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        got = TERM.findall((text or "").translate(LOW))
        docs[lang].update(set(got))
        count[lang, source].update(got)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(c, kept=kept, v=v):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, k + 1) for k, (i, x) in enumerate(ranked[:most])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, i, 0) for i, r in enumerate(rows)], "lang string, source string, text string, value long, n int")


def corpus():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    rows = []
    for _ in range(400):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "a", "b", "é", None])
        rows.append((lang, source, rng.choice([" ", "-", "1", "\n"]).join(rng.choice(words).upper() if rng.random() < 0.2 else rng.choice(words[: 40 if source == "a" else 300]) for _ in range(rng.randint(0, 40)))))
    rows += [("en", "empty", None), ("en", "empty", ""), ("en", "marks", "123 --"), ("fr", "few", "one two"), ("fr", "few2", "one"), ("it", "alone", "uno uno"), ("it", "alone", "uno"), ("it", "alone", "Uno due"), ("en", "b", "x" * 5000), ("", "", "a")]
    return rows + [("en", "copies", "same text again")] * 50 + [("de", "one", "wort " * 3000)]


@pytest.mark.parametrize("width", [None, 16])
def test_against_brute_force(spark, width):
    rows = corpus()
    for min_docs, top in ((3, 200), (1, 5), (7, 1)):
        got = sorted(tuple(r) for r in divergence.audit_sources(frame(spark, rows), min_docs, top, width).collect())
        assert got == brute(rows, min_docs, top)


def test_long_texts_in_pieces_and_early_output(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(divergence, "TERMS", 20)
    monkeypatch.setattr(divergence, "ENTRIES", 60)
    got = sorted(tuple(r) for r in divergence.audit_sources(frame(spark, rows), limit=300).collect())
    assert got == brute(rows)


def test_totals_by_join_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 0)
    assert sorted(tuple(r) for r in divergence.audit_sources(frame(spark, corpus())).collect()) == brute(corpus())


def test_nothing_in_nothing_out(spark):
    df = frame(spark, corpus())
    assert divergence.audit_sources(df.limit(0)).count() == 0
    got = divergence.audit_sources(frame(spark, [("en", "a", None), ("en", "b", "")])).collect()
    assert sorted(tuple(r) for r in got) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_a_saturated_sketch_changes_nothing(spark):
    df = frame(spark, corpus()).selectExpr("coalesce(lang, '') lang", "coalesce(source, '') source", "text")
    wide, narrow = ({(r.lang, r.term): (r.docs, sorted((c.source, c.n) for c in r.counts)) for r in divergence.count_terms(df, width=w).collect()} for w in (1 << 14, 16))
    assert wide == narrow
    # with room enough most terms of one document go before the shuffle
    once = frame(spark, [("en", "a", " ".join("".join(chr(97 + (i * 31 + k * 7) % 26) for k in range(1, 9)) + "z" * (i // 26) for i in range(400)))])
    cells = divergence.sketch_of(once, 1 << 14).cells
    assert (cells < divergence.FULL).mean() > 0.99


def test_cells_pack_and_stop():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 4, 64).astype(np.uint8)
    assert (divergence.unpack_cells(divergence.pack(cells)) == cells).all()
    s = divergence.Sketch(8)
    keys = rng.integers(0, 1 << 60, 50).astype(np.uint64)
    s.add(keys)
    assert (s.estimate(keys) >= 1).all() and s.cells.max() == divergence.FULL

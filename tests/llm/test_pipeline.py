import numpy as np

import corpus_pipeline as cp
from strandline.llm import mixing, pieces, toxicity
from strandline.llm.common import materialize, table
from tests.llm.test_ngramjoin import brute as brute_groups
from tests.llm.test_suffixdedup import brute as brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns

    # toxicity: exactly the rows that the fitted model scores below its threshold stay
    model = toxicity.fit_toxicity(docs, table(spark, SF, "labels"))
    scored = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    kept = materialize(cp.drop_toxic(spark, docs, SF), "t1")
    assert sorted(kept.columns) == sorted(columns)
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    assert [i for i, _ in rows] == sorted(i for i, s in scored.items() if s < toxicity.THRESHOLD)

    # near duplicates: the smallest id of each component
    one = materialize(cp.drop_near_duplicates(spark, kept, SF), "t2")
    left = {d for d, _, c in brute_groups(rows) if d == c}
    assert sorted(one.columns) == sorted(columns)
    assert sorted((r.doc_id, r.text) for r in one.collect()) == [r for r in rows if r[0] in left]

    # repeats: removed bytes, to whole characters
    rows = [r for r in rows if r[0] in left]
    cut = materialize(cp.cut_repeats(spark, one, SF), "t3")
    assert sorted(cut.columns) == sorted(columns)
    got = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert len(got) == len(rows)
    for (doc_id, text), gone in zip(rows, brute_repeats(rows, 100), strict=True):
        raw = text.encode()
        at, keep = 0, []
        for ch in text:
            n = len(ch.encode())
            if not all(i in gone for i in range(at, at + n)):
                keep.append(ch)
            at += n
        assert at == len(raw) and got[doc_id] == ("".join(keep), len(keep))

    # mixing: each row as often as planned
    mixed = materialize(cp.mix(spark, cut, SF), "t4")
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(cut).collect()}
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert sorted(mixed.columns) == sorted(columns) and count == {k: n for k, n in plan.items() if n}

    # encoding: ids of every row, which decode to its text
    v = pieces.Pieces()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    out = cp.encode(spark, mixed, SF).collect()
    assert len(out) == sum(count.values())
    assert sorted((r.doc_id, r.copy) for r in out) == sorted((d, k) for d, n in count.items() for k in range(1, (n if texts[d].split() else 1) + 1) for _ in range(1 if texts[d].split() else n))
    several = {}
    for r in out:
        if len(r.ids) > 40:
            several.setdefault(r.doc_id, []).append(tuple(r.ids))
    assert any(len(x) > 1 for x in several.values()) and all(len(set(x)) == len(x) for x in several.values())
    # the first copy's is that of the document itself
    alone = {r.doc_id: r.ids for r in pieces.encode_sampled(mixed.dropDuplicates(["doc_id"])).collect()}
    assert all(r.ids == alone[r.doc_id] for r in out if r.copy == 1)
    assert all(r.lossless and v.decode(np.array(r.ids, dtype=np.int64)).decode() == texts[r.doc_id] for r in out)


def test_run_counts_rows(spark):
    assert cp.run(spark, SF).count() > 0


def test_stages_take_nulls_empty_tables_and_further_columns(spark, tmp_path):
    long = " ".join("word%d" % i for i in range(80))
    rows = [(1, long, "en", "a", 5), (1, long, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0), (None, long, "de", None, 3), (4, long + " more", "en", "a", 9), (5, "  ", "en", "b", 2), (6, "short", "en", "b", 5)]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component string, score double")
    spark.createDataFrame([(1, 0, 0), (6, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table_ in (docs, docs.limit(0)):
        at = table_
        for name, stage in cp.STAGES:
            at = materialize(stage(spark, at, str(tmp_path)), f"edge-{name}")
            if name != "sentencepiece":
                assert at.columns == list(cp.COLUMNS)
        assert at.count() == 0 if table_ is not docs else at.where("not lossless").count() == 0

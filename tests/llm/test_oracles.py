"""Queries that SQL can express against their SQL."""

import duckdb
import pytest

from strandline.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = c.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(x)] for x in sorted(names)) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(r[x] for x in sorted(names)) for r in df.collect()), key=repr)
    assert got == want


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and set(SQL) <= set(QUERIES)

"""Every query with SQL gives the rows that DuckDB gives."""

import math
import os

import duckdb
import pytest

from firmscope.plans import agent_queries, domain_queries, evidence_fold_queries, evidence_queries, extract_queries, firm_queries, log_queries, report_queries, search_queries, text_queries, verification_queries  # noqa: F401
from firmscope.plans.registry import QUERIES, SQL

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.6g}")
    return int(v) if isinstance(v, bool) else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = rows(df.columns, df.collect()), rows(rel.columns, rel.fetchall())
    assert len(got) == len(want) and got
    bad = [(g, w) for g, w in zip(got, want, strict=True) if [str(x) for x in g] != [str(x) for x in w] and not all((a == b) or (isinstance(a, (int, float)) and isinstance(b, (int, float)) and abs(a - b) <= 1e-5 * max(1, abs(b))) for a, b in zip(g, w, strict=True))]
    assert not bad, bad[:3]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0

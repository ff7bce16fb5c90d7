"""Every registered query against its DuckDB oracle on whole sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from itemwise.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return repr(round(v, 9)) if isinstance(v, float) else repr(v)
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order)
                                           for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.SQL) == set(catalog.QUERIES)
    assert set(entry.queries()) >= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["source_id", "recom_id"]
    assert df.count() == 150

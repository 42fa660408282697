"""Every registered query against its DuckDB oracle on sf0.001, plus the
layered = one-shot consistency check."""

import duckdb
import pytest

import __spark_entry__ as E
from oracle.check import digest
from oracle.types import duck_type
from emporia.plans.catalog import QUERIES
from emporia.sources.tables import TABLES, table_path

SMALL = "/root/testdata/sf0.001"
# The text queries are checked in tests/llm.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_date", "window_start", "window_end", "gmv", "top5_ids", "top5_product_ids"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[name]
    rel = con.sql(sql)
    otypes = {c: duck_type(t) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == otypes
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_layered_equals_one_shot(spark):
    q = E.queries()
    a = q["ads_wide"](spark, SMALL)
    b = q["one_shot_ads"](spark, SMALL).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

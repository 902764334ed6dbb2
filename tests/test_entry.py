import pytest

import __spark_entry__ as entry


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ep", "n_gaps", "max_gap_ms", "n_large"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def tables():
    import duckdb

    con = duckdb.connect()
    for t in ("events", "documents", "labels", "conversations", "benchmark", "pages", "part"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return con


def shown(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


# queries of the training-data operators have tests of their own
@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op") or n.startswith("oped")))
def test_catalogue_against_sql(spark, tables, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    cur = tables.execute(entry.oracle_sql()[name])
    cols = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted([shown(r[i]) for i in at] for r in cur.fetchall())
    assert sorted(df.columns) == cols and sorted([shown(r[c]) for c in cols] for r in df.collect()) == want

import pytest

from tapelake.llm import queries

from ..conftest import SMALL


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    assert df.count() > 0


def test_dedup_against_sql(spark):
    import duckdb

    c = duckdb.connect()
    for t in ("accepted", "staged_candidates"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = set(c.execute(queries.SQL["p3_found"]).fetchall())
    assert {tuple(r) for r in queries.QUERIES["p3_found"](spark, SMALL).collect()} == want

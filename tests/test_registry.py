import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, ordered

#: One query per area; tools/check_oracle.py runs all of them.
SPOT = ["e1_ranking", "d11_describe", "i7_oof_features", "j13_glcm", "j14_edges", "c9_neighbours", "h10_report", "l2_dedup_stream", "k11_linear_batch"]


@pytest.mark.parametrize("name", SPOT)
def test_query_equals_its_sql(spark, small, name):
    duck = duckdb.connect()
    for table in TABLES.split():
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    df = entry.queries()[name](spark, small)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(result.fetchall(), columns)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 130


def test_entry(spark):
    assert entry.entry(spark).count() == 4

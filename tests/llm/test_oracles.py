from collections import Counter

import duckdb
import pytest
from lodestar.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = queries.queries()[name](spark, sf).select(*columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())

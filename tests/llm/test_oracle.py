import duckdb
import pytest

from riskgraph.llm import queries
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    con.register("got", got)
    columns = ", ".join(sorted(got.columns))
    con.execute(f"CREATE TABLE want AS {queries.ORACLES[name]}")
    for a, b in (("got", "want"), ("want", "got")):
        left = f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b}"
        assert con.execute(f"SELECT count(*) FROM ({left})").fetchone()[0] == 0

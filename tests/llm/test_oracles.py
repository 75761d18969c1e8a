"""The SQL twins against their queries, on small tables and on dirt."""

import duckdb
import pytest

from creditmart.llm.queries import LLM_ORACLES, LLM_QUERIES
from creditmart.llm import sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        duck.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    found = duck.execute(LLM_ORACLES[name])
    columns, want = [d[0] for d in found.description], found.fetchall()
    result = LLM_QUERIES[name](spark, SF)
    assert sorted(result.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, result.select(columns).collect()))) == sorted(map(repr, want))


def test_sql_on_dirt():
    duck = duckdb.connect()
    duck.execute("create table documents as select * from (values (1, null), (2, ''), (3, 'a b c a b c')) t(doc_id, text)")
    duck.execute("create table benchmark as select * from (values (7, 'B, c'), (8, null), (9, '')) t(item_id, text)")
    assert [r[:3] for r in sorted(duck.execute(sql.repeats(2)).fetchall())] == [(1, 0, 0), (2, 0, 0), (3, 6, 0)]
    assert [r[1:4] for r in sorted(duck.execute(sql.leaks()).fetchall())] == [(0, 0, 0), (0, 0, 0), (6, 4, 1)]

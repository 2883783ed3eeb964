"""The SQL of the llm queries against the queries, on the given tables."""

import pytest

import __spark_entry__ as entry
from adtrail.llm.oracle import ORACLE
from adtrail.llm.queries import QUERIES
from tests.compare import difference, duck


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_and_sql_agree(spark, small, name):
    df = QUERIES[name](spark, small)
    cur = duck(small).execute(ORACLE[name])
    rows = [tuple(r) for r in df.collect()]
    assert difference(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_entry_lists_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert all(any(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)) and "pipeline" in QUERIES

"""Text queries against their SQL twins on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import database, rows_of
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return database(small)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, con, small, name):
    df = QUERIES[name](spark, small)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert ours and ours == theirs
    assert sorted(df.columns) == sorted(d[0] for d in cursor.description)


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} >= {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())

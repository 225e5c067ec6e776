"""Queries with SQL against DuckDB on sf0.001, and registration of all of them."""

import pytest
from conftest import SMOKE

from recspark import llm


def canonical(rows):
    return sorted(repr(tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query_equals_sql(spark, duck, name):
    df = llm.QUERIES[name](spark, SMOKE)
    cols = sorted(df.columns)
    cur = duck.execute(llm.SQL[name])
    assert sorted(d[0] for d in cur.description) == cols
    other = duck.execute(f"SELECT {', '.join(cols)} FROM ({llm.SQL[name]})").fetchall()
    assert canonical(df.select(*cols).collect()) == canonical(other) and other


def test_one_query_per_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names

import duckdb
import pytest

import __spark_entry__ as entry


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n in __import__("corpuskiln.plans.registry", fromlist=["x"]).queries()))
def test_query_equals_sql(spark, data, name):
    import os

    db = duckdb.connect()
    for p in os.listdir(data):
        db.execute(f"CREATE VIEW {p.split('.')[0]} AS SELECT * FROM '{data}/{p}'")
    df = entry.queries()[name](spark, data)
    got = _rows(df.columns, df.collect())
    cur = db.execute(entry.oracle_sql()[name])
    assert got == _rows([c[0] for c in cur.description], cur.fetchall())

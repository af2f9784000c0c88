"""Every query with an SQL statement gives the same rows as that statement."""

import pytest

import __spark_entry__ as driver
from tabloom.plans.oracle import ORACLE
from tabloom.plans.queries import QUERIES

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}


def canonical(value):
    if value is None:
        return "null"
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    return repr(value)


def test_every_statement_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, folder, name):
    frame = QUERIES[name](spark, folder)
    cursor = duck.execute(ORACLE[name])
    described = {column[0]: str(column[1]) for column in cursor.description}
    assert {c: TYPES[t] for c, t in frame.dtypes} == described
    names = sorted(described)
    order = [list(described).index(n) for n in names]
    expected = sorted(tuple(canonical(row[i]) for i in order) for row in cursor.fetchall())
    actual = sorted(tuple(canonical(row[n]) for n in names) for row in frame.collect())
    assert actual == expected
    assert actual


def test_entry(spark):
    row = driver.entry(spark).first()
    assert row["auc"] > 0.9 and 0.8 < row["accuracy"] <= 1 and row["scored_rows"] > 0

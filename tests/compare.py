"""A Spark result against DuckDB rows: names, types and values, in any order."""

import math

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def assert_same(df, relation, may_be_empty=False):
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    declared = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == declared
    places = [relation.columns.index(c) for c in columns]
    ours = sorted(tuple(_cell(row[c]) for c in columns) for row in df.collect())
    theirs = sorted(tuple(_cell(row[i]) for i in places) for row in relation.fetchall())
    assert ours == theirs
    assert ours or may_be_empty, "no rows compared"

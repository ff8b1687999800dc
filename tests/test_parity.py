"""Every registered query with checking SQL, value by value; the others for their shape."""

import math

import pytest

from tomewise.queries import ORACLES, QUERIES


def canonical(rows, names):
    def cell(v):
        if isinstance(v, float):
            return (1, "nan" if math.isnan(v) else repr(v))
        return (0, "") if v is None else (2, str(v))

    return sorted(tuple(cell(r[c]) for c in names) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, duck, sf):
    got = QUERIES[name](spark, sf).toArrow()
    want = duck.sql(ORACLES[name]).to_arrow_table()
    names = sorted(got.schema.names)
    assert names == sorted(want.schema.names)
    assert canonical(got.to_pylist(), names) == canonical(want.to_pylist(), names)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)

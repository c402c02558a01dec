"""Every query with SQL gives what DuckDB gives; every other one runs."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from lekhani import queries as core


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return tuple(v) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(name, spark, data, con):
    df = core.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in columns) for r in df.collect()]
    if name not in core.ORACLES:
        assert rows
        return
    found = con.execute(core.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    assert Counter(rows) == Counter(tuple(norm(r[i]) for i in place) for r in found.fetchall())

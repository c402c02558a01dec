"""Every query on empty tables, and on tables of nulls, ends with a defined result."""

import pytest

from lekhani.llm import queries


def _made(spark, data, path, nulls):
    from pathlib import Path

    for f in Path(data).glob("*.parquet"):
        df = spark.read.parquet(str(f))
        out = df.limit(0)
        if nulls:
            row = spark.createDataFrame([tuple([None] * len(df.columns))] * 2, df.schema)
            out = out.union(row)
        out.write.parquet(str(path / f.name))
    return str(path)


@pytest.fixture(scope="module")
def empty(spark, data, tmp_path_factory):
    return _made(spark, data, tmp_path_factory.mktemp("empty"), False)


@pytest.fixture(scope="module")
def null(spark, data, tmp_path_factory):
    return _made(spark, data, tmp_path_factory.mktemp("null"), True)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(name, spark, empty):
    assert queries.QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_tables_of_nulls(name, spark, null):
    found = queries.QUERIES[name](spark, null).collect()
    assert not found or not name.endswith("_found")

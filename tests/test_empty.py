"""Every query of the core on empty tables and on tables of nulls ends."""

from pathlib import Path

import pytest

from lekhani import queries


def _made(spark, data, path, nulls):
    for f in Path(data).glob("*.parquet"):
        df = spark.read.parquet(str(f))
        out = df.limit(0)
        if nulls:
            out = out.union(spark.createDataFrame([tuple([None] * len(df.columns))] * 2, df.schema))
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
    found = queries.QUERIES[name](spark, empty).collect()
    assert not found or name == "partition_rows"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_tables_of_nulls(name, spark, null):
    queries.QUERIES[name](spark, null).collect()

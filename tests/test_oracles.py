"""Every query against its DuckDB twin on the sf0.01 tables, value by value."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from oracle_twins import ORACLES
from sheafline.plans import QUERIES

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}

@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_twin(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    twin = duck.execute(ORACLES[name])
    described = {column[0]: str(column[1]) for column in twin.description}
    expected_rows = twin.fetchall()
    columns = sorted(result.columns)
    assert columns == sorted(described)
    kinds = {f.name: TYPES[f.dataType.simpleString()] for f in result.schema}
    assert {c: kinds[c] for c in columns} == {c: described[c] for c in columns}
    order = [list(described).index(c) for c in columns]
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    expected = Counter(tuple(row[i] for i in order) for row in expected_rows)
    assert got == expected
    assert got, "an empty result proves nothing"

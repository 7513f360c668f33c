"""Every registered query against its SQL, on the smallest test tables."""

import os

import duckdb
import pandas as pd
import pytest

from conftest import TESTDATA
from retailpulse.plans.catalogue import REGISTRY

FOLDER = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def _text(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if pd.isna(value) else repr(value + 0.0)
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def _canonical(frame: pd.DataFrame):
    columns = sorted(frame.columns)
    return sorted(tuple(_text(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(name, spark, duck):
    registered = REGISTRY[name]
    result = registered.run(spark, FOLDER).toPandas()
    if registered.sql is None:
        assert len(result) > 0
        return
    expected = duck.execute(registered.sql).df()
    assert sorted(result.columns) == sorted(expected.columns)
    assert _canonical(result) == _canonical(expected)


def test_names_are_unique_and_lower_case():
    assert all(name == name.lower() for name in REGISTRY)

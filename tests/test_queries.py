"""Every registered query against its SQL, whole tables on both sides."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from tallyroad.plans import oracle
from tallyroad.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = all_queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for column in df.columns:
        df[column] = [None if pd.isna(v) else str(v) for v in df[column].astype(object)]
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLE[name]).df()
    assert sorted(result.columns) == sorted(expected.columns)
    assert len(result) == len(expected) > 0
    for column in result.columns:
        if result[column].notna().all() and expected[column].notna().all():
            assert result[column].dtype.kind == expected[column].dtype.kind, column
            if result[column].dtype.kind == "i":
                assert result[column].dtype == expected[column].dtype, column
        else:
            # Integer columns with nulls come out as floats on both sides.
            for side in (result, expected):
                if side[column].dtype.kind == "f":
                    side[column] = side[column].astype("Int64")
    pd.testing.assert_frame_equal(canonical(result), canonical(expected), check_dtype=False)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0

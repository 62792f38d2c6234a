"""Run a registered query and its SQL side by side."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(rows: pd.DataFrame) -> list[tuple]:
    rows = rows[sorted(rows.columns)].astype(object)
    rows = rows.where(~rows.isna(), None)
    values = [
        tuple(v.item() if isinstance(v, np.generic) else v for v in row)
        for row in rows.itertuples(index=False, name=None)
    ]
    return sorted(values, key=repr)


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def assert_same(spark_rows, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    expected = con.sql(sql)
    spark_types = {name: SAME_TYPE[kind] for name, kind in spark_rows.dtypes}
    oracle_types = dict(zip(expected.columns, map(str, expected.types)))
    assert spark_types == oracle_types
    actual, wanted = canonical(spark_rows.toPandas()), canonical(expected.df())
    assert len(actual) == len(wanted)
    different = [(a, w) for a, w in zip(actual, wanted) if a != w]
    assert not different, different[:3]
    return len(actual)

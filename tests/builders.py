"""Hand-made messages and orders."""

import json

from orderflow import schema as S


def message(**fields) -> str:
    """A good message; a field given as ``...`` is left out."""
    whole = {
        S.REQUEST_ID: "2024010100095877800000012",
        S.NOTIFY_TIME: "20240101001000000",
        S.PROVINCE_CODE: "100",
        S.RESULT: "0000",
        S.FEE: "500",
        S.SERVICE: S.NOTIFY_SERVICE,
    } | fields
    return json.dumps({name: value for name, value in whole.items() if value is not ...})


def messages(spark, *texts):
    rows = [(str(i), text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "key string, value string")


def records(spark, *rows):
    """Rows of (text, topic, partition, offset)."""
    full = [(str(i), *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, S.MESSAGE_SCHEMA)


def dimension(spark, names):
    return spark.createDataFrame(list(names.items()), S.DIMENSION_SCHEMA)


def as_set(df):
    return {tuple(row) for row in df.collect()}

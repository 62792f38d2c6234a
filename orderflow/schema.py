"""Message fields, codes and row types shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Field names, codes and time format of the order messages.
REQUEST_ID = "requestId"
NOTIFY_TIME = "receiveNotifyTime"
PROVINCE_CODE = "provinceCode"
RESULT = "bussinessRst"
FEE = "chargefee"
SERVICE = "serviceName"
SUCCESS_CODE = "0000"
NOTIFY_SERVICE = "reChargeNotifyReq"
TIME_DIGITS = 17  # yyyyMMddHHmmssSSS
DAY_DIGITS = 8  # yyyyMMdd

# What a Kafka read returns once key and value are cast to text.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("result_code", T.StringType()),
        T.StructField("is_success", T.BooleanType()),
        T.StructField("fee", T.IntegerType()),
        T.StructField("start_ts", T.TimestampType()),
        T.StructField("end_ts", T.TimestampType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("province_code", T.StringType()),
        T.StructField("day", T.DateType()),
    ]
)

DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("province_code", T.StringType()),
        T.StructField("province", T.StringType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("grp", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("from_offset", T.LongType()),
        T.StructField("until_offset", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class MessageRules:
    """How one job reads messages.

    ``trim`` strips blanks around result, request id and end time. ``service``
    keeps one service only, and then a message without a service is unusable.
    """

    trim: bool = False
    service: str | None = None


NOTIFY_RULES = MessageRules(service=NOTIFY_SERVICE)
ALL_ORDERS_RULES = MessageRules(trim=True)

"""The province codes orders carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.schema import DIMENSION_SCHEMA

# Province code and name, one pair per line.
_PROVINCES = """\
100 北京
200 广东
210 上海
220 天津
230 重庆
240 辽宁
250 江苏
270 湖北
280 四川
290 陕西
311 河北
351 山西
371 河南
431 吉林
451 黑龙江
471 内蒙古
531 山东
551 安徽
571 浙江
591 福建
731 湖南
771 广西
791 江西
851 贵州
871 云南
891 西藏
898 海南
931 甘肃
951 宁夏
971 青海
991 新疆
"""


def provinces(spark: SparkSession) -> DataFrame:
    """The dimension to use where no dimension file is given."""
    return spark.createDataFrame(
        [tuple(line.split(" ")) for line in _PROVINCES.splitlines()], DIMENSION_SCHEMA
    )

from builders import as_set, dimension

from orderflow.operators import lookup
from orderflow.session import settings
from orderflow.sources.dimension import read_province_dimension
from orderflow.sources.provinces import provinces


def orders(spark):
    return spark.createDataFrame(
        [("a", "1")] * 3 + [("b", "2"), ("c", "9"), ("d", "9")], "id string, province_code string"
    )


def test_left_keeps_and_inner_drops_unknown_codes(spark):
    names = dimension(spark, {"1": "North", "2": "South"})
    left = lookup.attach_province(orders(spark), names, "left")
    inner = lookup.attach_province(orders(spark), names, "inner")
    assert left.filter("province IS NULL").count() == 2
    assert (left.count(), inner.count()) == (6, 4)


def test_sums_and_orders_get_the_same_provinces(spark):
    names = dimension(spark, {"1": "North", "2": "South", "3": "North"})
    for how in ("left", "inner"):
        single = lookup.attach_province(orders(spark), names, how).groupBy("province").count()
        sums = lookup.provinces_of_sums(orders(spark).groupBy("province_code").count(), names, how)
        assert as_set(single) == as_set(sums.groupBy("province").sum("count"))


def test_unknown_codes_are_counted(spark):
    names = dimension(spark, {"1": "North", "2": "South"})
    assert as_set(lookup.unknown_province_codes(orders(spark), names)) == {("9", 2)}


def test_dimension_file(spark, tmp_path):
    path = tmp_path / "dimension.txt"
    path.write_text("100 North\n200 South\nshort\n\n100 Later more\n300 East", encoding="utf-8")
    assert as_set(read_province_dimension(spark, str(path))) == {
        ("100", "Later"),
        ("200", "South"),
        ("300", "East"),
    }


def test_built_in_provinces(spark):
    rows = provinces(spark)
    assert rows.count() == 31
    assert rows.select("province_code").distinct().count() == 31
    assert rows.filter("province_code = '100'").first()["province"] == "北京"


def test_a_dimension_is_measured_before_it_is_broadcast(spark):
    names = dimension(spark, {"1": "North", "2": "South"})
    assert lookup.is_small(names) and lookup.is_small(names.limit(0))
    for size, small in (("-1", False), ("50b", False), ("1k", True), ("10MB", True), ("1g", True)):
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": size}):
            assert lookup.is_small(names) is small, size
    many = spark.range(lookup.MEASURED_ROWS + 1).selectExpr("cast(id as string) as province_code", "'x' as province")
    assert not lookup.is_small(many)

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import columns as C
from marquee.functions.amounts import exact_sum, ratio, share


def values(spark, expression, rows, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_age_bands_and_null(spark):
    ages = [19, 20, 29, 30, 39, 40, 49, 50, None]
    expected = ["Dưới 20", "20-29", "20-29", "30-39", "30-39", "40-49", "40-49", "50+", "50+"]
    assert values(spark, C.age_group, ages, "int") == expected
    assert values(spark, lambda v: C.age_group(v, "?"), [None, 60], "int") == ["?", "50+"]


def test_sessions_from_clock(spark):
    clocks = ["11:59", "12:00", "16:59", "17:00", "19:59", "20:00", "abc", None, "", " 9:30", "8.0:00"]
    expected = ["Sáng", "Chiều", "Chiều", "Tối sớm", "Tối sớm", "Tối muộn", "Tối muộn", "Tối muộn", "Tối muộn", "Sáng", "Sáng"]
    assert values(spark, lambda v: C.show_session(C.hour_of_clock(v)), clocks) == expected


def test_whole_number(spark):
    texts = ["12", " 7 ", "-3", "+4", "12.7", "12.", "x", "1x", "", None, "99999999999"]
    assert values(spark, C.whole_number, texts) == [12, 7, -3, 4, 12, 12, None, None, None, None, None]


def test_finite_number(spark):
    texts = ["90000", "-1.5", "1e3", "x", "", None, "NaN", "Infinity", "1e16", "2e15"]
    assert values(spark, C.finite_number, texts) == [90000.0, -1.5, 1000.0, None, None, None, None, None, None, 2e15]


def test_address_parts(spark):
    addresses = ["a / b/ c ", "a/b", None, ""]
    assert values(spark, lambda v: C.address_part(v, 1), addresses) == ["b", "b", None, None]
    assert values(spark, lambda v: C.address_part(v, 2), addresses) == ["c", None, None, None]


def test_gender(spark):
    codes = ["m", "FEMALE", "Nam", "nữ", None]
    assert values(spark, C.gender_label, codes) == ["Male", "Female", "Other", "Other", "Other"]
    wide = values(spark, lambda v: C.gender_label(v, schemas.GENDER_CODES_VI), codes)
    assert wide == ["Male", "Female", "Male", "Female", "Other"]


def test_channel(spark):
    assert values(spark, C.channel, ["WEBS001", "C001", "webs1", None]) == ["Online", "Offline", "Offline", "Offline"]


def test_flags(spark):
    assert values(spark, C.is_yes, ["Có", " Có ", "Không", None]) == [True, True, False, False]
    assert values(spark, lambda v: C.is_yes(v, null_value=None), ["Có", None]) == [True, None]
    assert values(spark, C.is_couple, ["ĐÔI", "đôi", "ĐÔI ", "ĐƠN", None]) == [True, True, True, False, False]


def test_minutes(spark):
    texts = ["181 minutes", "Not Available", "", None, "about 90 or 95"]
    assert values(spark, C.first_number, texts) == [181, None, None, None, 90]


def test_weekdays(spark):
    days = [datetime.date(2019, 5, d) for d in (3, 4, 5, 6)]
    assert values(spark, C.iso_weekday, days, "date") == [5, 6, 7, 1]
    assert values(spark, C.is_weekend, days, "date") == [False, True, True, False]


def test_exact_sum_of_many_cents(spark):
    df = spark.range(300_000).select((F.lit(0.1) + (F.col("id") % 2) * -0.3).alias("v"))
    assert df.agg(exact_sum(F.col("v"))).first()[0] == Decimal("-15000.00")


@pytest.mark.parametrize("rows, expected", [
    ([1e13, 0.01, -5.25], "9999999999994.76"), ([None, None], None), ([-0.01], "-0.01"),
    ([0.004] * 1000, "4.00"), ([47521.123, 0.0005, -1.5], "47519.6235"), ([2e15, 0.125, None], "2000000000000000.125"),
    ([1.0, float("nan"), float("inf"), float("-inf"), 1e300], "1.00"), ([float("nan")], None), ([1e-15, 3e-15], "0.000000000000004"),
])
def test_exact_sum_edges(spark, rows, expected):
    df = spark.createDataFrame([(v,) for v in rows], "v double")
    assert df.agg(exact_sum(F.col("v"))).first()[0] == (expected and Decimal(expected))


def test_exact_sum_of_any_decimals(spark):
    pick = random.Random(12)
    amounts = [round(pick.uniform(-1, 1) * 10 ** pick.randrange(0, 7), pick.randrange(0, 8)) for _ in range(3000)]
    for parts in (1, 7):
        df = spark.createDataFrame([(v,) for v in amounts], "v double").repartition(parts)
        assert df.agg(exact_sum(F.col("v"))).first()[0] == sum(Decimal(repr(v)) for v in amounts)


def test_exact_sum_beyond_one_word(spark):
    df = spark.range(2_000_000).select(F.lit(9e10).alias("v"))
    assert df.agg(exact_sum(F.col("v"))).first()[0] == Decimal("180000000000000000.00")


def test_share_rounds_ties_up(spark):
    df = spark.createDataFrame([(9999,), (50001,)], "n bigint").select(share(F.col("n")).alias("p"))
    assert sorted(r[0] for r in df.collect()) == [16.67, 83.34]


def test_share_of_small_amounts(spark):
    df = spark.createDataFrame([(0.004,), (0.012,)], "v double").select(share(F.col("v").cast("decimal(38,15)")).alias("p"))
    assert sorted(r[0] for r in df.collect()) == [25.0, 75.0]


def test_ratio_of_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(5).cast("decimal(24,2)"), F.lit(0))).first()[0] is None

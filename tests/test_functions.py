from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from loamline import functions as fn
from loamline.functions.times import OFFSET_PATTERN


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], _schema(values)) if values else None
    df = row if row is not None else spark.range(1)
    return df.select(expression.alias("x")).first().x


def _schema(values):
    kinds = {str: "string", float: "double", int: "int", type(None): "double", datetime: "timestamp"}
    return ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())


@pytest.mark.parametrize(
    "text, depth",
    [
        ("Soil Moisture 40cm (Sandy Loam)#0", 40),
        ("Soil Temperature 10 cm", 10),
        ("Soil Salinity 80CM", 80),
        ("Soil Moisture", None),
        ("Soil Moisture 99999999999999999999cm", None),
        ("20 cm then 30 cm", 20),
    ],
)
def test_depth(spark, text, depth):
    assert one(spark, fn.depth_cm(F.col("t")), t=text) == depth


@pytest.mark.parametrize(
    "text, texture",
    [
        ("a (Clayey Loam)#1", "Clayey Loam"),
        ("a (Loam)", "Loam"),
        ("a (Clay)", "Clay"),
        ("a (Silty Loam)", None),
        ("a (clay)", None),
        ("a", None),
    ],
)
def test_texture(spark, text, texture):
    assert one(spark, fn.soil_texture(F.col("t")), t=text) == texture


def test_measure_order_differs_from_leftmost_word(spark):
    text = "Salinity and Moisture"
    assert one(spark, fn.measure_type(F.col("t")), t=text) == "Moisture"
    assert one(spark, fn.first_measure_word(F.col("t")), t=text) == "Salinity"
    assert one(spark, fn.first_measure_word(F.col("t")), t="Conductivity 10cm") == "Conductivity"
    assert one(spark, fn.measure_type(F.col("t")), t="Conductivity 10cm") is None
    assert one(spark, fn.probe_suffix(F.col("t")), t="x#12") == "12"
    assert one(spark, fn.clean_text(F.lit(None).cast("string"))) == ""
    assert one(spark, fn.clean_text(F.col("t")), t="  a b ") == "a b"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-01T10:00:00+11:00", datetime(2023, 12, 31, 23)),
        ("2024-01-01T10:00:00Z", datetime(2024, 1, 1, 10)),
        ("2024-01-01T10:00:00.123+11:00", None),
        ("bad", None),
        ("2024-02-30T00:00:00+00:00", None),
    ],
)
def test_offset_timestamp(spark, text, expected):
    t = fn.offset_timestamp(F.col("t"), OFFSET_PATTERN)
    assert one(spark, t, t=text) == expected


def test_default_timestamp_reads_fractions(spark):
    t = fn.offset_timestamp(F.col("t"), None)
    assert one(spark, t, t="2024-01-01T10:00:00.5+11:00") == datetime(2023, 12, 31, 23, 0, 0, 500000)
    assert one(spark, t, t="bad") is None


@pytest.mark.parametrize(
    "parts, expected",
    [
        ((2024, 2, 29), date(2024, 2, 29)),
        ((2024, 2, 30), None),
        ((2024, None, 1), None),
        ((2024, 1, None), None),
        ((2024, 123, 1), None),
        ((24, 1, 5), None),
    ],
)
def test_calendar_date(spark, parts, expected):
    df = spark.createDataFrame([parts], "y int, m int, d int")
    assert df.select(fn.calendar_date(F.col("y"), F.col("m"), F.col("d"))).first()[0] == expected


def test_row_mean(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), (10.0, None, 20.0, None), (0.0, 0.0, 0.0, 0.0)],
        "a double, b double, c double, d double",
    )
    assert [r[0] for r in df.select(fn.row_mean(*map(F.col, "abcd"))).collect()] == [None, 15.0, 0.0]


@pytest.mark.parametrize(
    "moisture, rain, expected",
    [
        (20.0, None, True),
        (20.0, 1.0, True),
        (20.0, 2.0, False),
        (30.0, 0.0, False),
        (None, 1.0, None),
        (None, 5.0, False),
    ],
)
def test_irrigation_flag(spark, settings, moisture, rain, expected):
    flag = fn.irrigation_needed(F.col("m"), F.col("r"), settings)
    assert one(spark, flag, m=moisture, r=rain) is expected


@pytest.mark.parametrize(
    "measure, value, kept",
    [
        ("Moisture", 0.0, True),
        ("Moisture", 100.0, True),
        ("Moisture", 100.01, False),
        ("Temperature", -10.0, True),
        ("Temperature", 60.0, True),
        ("Temperature", 60.5, False),
        ("Salinity", 10.0, True),
        ("Salinity", 10.01, False),
        ("Salinity", float("nan"), False),
        ("Moisture", float("nan"), False),
        ("Moisture", None, False),
        ("Battery", 1.0, False),
    ],
)
def test_limits(spark, settings, measure, value, kept):
    by_name = fn.within_limits(F.lit(measure), F.col("v"), settings)
    by_text = fn.plausible(F.lit(f"Soil {measure} 10cm"), F.col("v"), settings)
    for test in (by_name, by_text):
        df = spark.createDataFrame([(value,)], "v double")
        assert (df.filter(test).count() == 1) is kept


def test_zones(spark):
    t = datetime(2024, 1, 1, 14)
    ntz = F.lit(t).cast("timestamp_ntz")
    assert one(spark, fn.civil_date(ntz)) == date(2024, 1, 1)
    assert one(spark, fn.civil_date(ntz, "Australia/Sydney")) == date(2024, 1, 2)
    assert one(spark, fn.civil_date(F.lit(t), "Australia/Sydney", True)) == date(2024, 1, 2)
    late = F.lit(datetime(2024, 1, 1, 14, 40)).cast("timestamp_ntz")
    assert one(spark, fn.hour_start(late)) == t
    assert one(spark, fn.hour_start(late, "Asia/Kolkata")) == datetime(2024, 1, 1, 20)
    assert spark.range(1).select(fn.hour_start(late).alias("h")).dtypes == [("h", "timestamp_ntz")]

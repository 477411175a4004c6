from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loamline.operators.summary import day_of, summarize, texture_lookup, wide_column
from loamline.plans.gold import gold_daily, gold_hourly
from tests.conftest import plan_of, same_rows

SCHEMA = (
    "site_name string, site_id string, event_time timestamp, depth_cm int, measure_type string, "
    "soil_texture string, soil_value double, reading_count bigint"
)


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


EDGES = [
    ("A", "1", at(1), 10, "Moisture", "Clay", 20.0, 1),
    ("A", "1", at(1, 6), 10, "Moisture", "Loam", 30.0, 9),
    ("A", "1", at(1, 6), 50, "Moisture", None, 70.0, 1),
    ("A", "1", at(1, 6), 10, "Temperature", None, 15.0, 1),
    ("A", "1", at(2), 90, "Moisture", None, 40.0, 1),  # depth without a column
    ("B", "2", at(1), 10, "Temperature", "Clay", 12.0, 1),  # no moisture: no row
    ("B", "2", at(2), 80, "Moisture", None, 10.0, 1),
    ("B", "2", at(2), 80, "Salinity", None, 0.0, 1),
]


@pytest.fixture
def silver(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


def filtered_averages(silver, settings):
    """The summary as SQL text: one filtered average per column, and means over columns that are known."""
    cells = {
        wide_column(m, d): f"avg(soil_value) FILTER (WHERE measure_type = '{m}' AND depth_cm = {d})"
        for m in settings.ranges
        for d in settings.depths
    }

    def mean(depths):
        known = f"filter(array({', '.join(wide_column('Moisture', d) for d in depths)}), x -> x IS NOT NULL)"
        return f"aggregate({known}, 0D, (a, x) -> a + x) / nullif(size({known}), 0)"

    wide = ", ".join(f"{text} AS {name}" for name, text in cells.items())
    return silver.sparkSession.sql(
        f"""SELECT *, {mean(settings.shallow)} AS avg_moisture_shallow,
          {mean(settings.deep)} AS avg_moisture_deep
        FROM (SELECT site_name, site_id, CAST(event_time AS DATE) AS date, {wide}
          FROM {{silver}} GROUP BY ALL HAVING count_if(measure_type = 'Moisture') > 0)""",
        silver=silver,
    )


def test_summary_equals_filtered_averages(silver, settings, tables):
    for rows in (silver, tables.silver_soil()):
        fused = summarize(rows, day_of(rows, settings), "date", settings)
        with_texture = summarize(rows, day_of(rows, settings), "date", settings, texture=True)
        plain = filtered_averages(rows, settings)
        assert fused.columns == plain.columns

        def rounded(df):
            return df.select(*[F.round(c, 6).alias(c) if k == "double" else c for c, k in df.dtypes])

        assert same_rows(rounded(fused), rounded(plain))
        assert same_rows(rounded(with_texture.drop("soil_texture")), rounded(plain))


def test_edges(spark, silver, settings):
    weather = spark.createDataFrame(
        [(at(1).date(), None, 30.0, 1.0), (at(2).date(), 5.0, None, None)],
        "date date, rainfall_mm double, max_temp_c double, solar_exposure_mj double",
    )
    gold = {(r.site_id, r.date.day): r for r in gold_daily(silver, weather, settings).collect()}
    assert gold.keys() == {("1", 1), ("1", 2), ("2", 2)}
    first = gold["1", 1]
    assert first.moisture_10cm == 25.0  # mean of instants, whatever their reading counts
    assert (first.avg_moisture_shallow, first.avg_moisture_deep) == (25.0, 70.0)
    assert (first.temp_10cm, first.soil_texture, first.irrigation_needed) == (15.0, "Clay", True)
    unlisted = gold["1", 2]
    assert unlisted.avg_moisture_shallow is None and unlisted.irrigation_needed is False
    assert gold["2", 2].salinity_80cm == 0.0
    assert gold["2", 2].soil_texture == "Clay"  # texture also comes from other measures


def test_zone_moves_days(spark, silver, settings):
    sydney = settings.but(timezone="Australia/Sydney")
    rows = silver.withColumn("event_time", F.col("event_time") + F.expr("interval 14 hours"))
    ntz = rows.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    for df in (rows, ntz):
        days = summarize(df, day_of(df, sydney), "date", sydney)
        assert {r.date.day for r in days.select("date").collect()} == {2, 3}


def test_hourly(silver, settings):
    hours = gold_hourly(silver, settings)
    assert hours.count() == 4
    assert "rainfall_mm" not in hours.columns and "irrigation_needed" not in hours.columns


def test_texture_is_earliest(silver):
    rows = {r.site_id: r.soil_texture for r in texture_lookup(silver).collect()}
    assert rows == {"1": "Clay", "2": "Clay"}


def test_one_shuffle(spark, silver, settings, tmp_path):
    path = str(tmp_path / "silver")
    silver.write.partitionBy("measure_type").parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(summarize(stored, day_of(stored, settings), "date", settings))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    moisture = stored.filter("measure_type = 'Moisture'")
    assert "PartitionFilters: [isnotnull(measure_type" in plan_of(moisture)

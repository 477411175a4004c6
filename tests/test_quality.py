import pytest
from pyspark.sql import functions as F

from loamline.operators.quality import QualityError, assert_quality, quality_report
from tests.conftest import plan_of


@pytest.fixture
def good(tables):
    return tables.silver_soil()


@pytest.fixture
def limits(settings):
    return settings.but(min_rows=500)


def failed(df, settings, **kwargs):
    return [r.check_id for r in quality_report(df, settings, **kwargs).collect() if not r.passed]


def with_extra_row(df, **changes):
    """The table plus one changed copy of a row, moved in time so that it is no duplicate."""
    row = df.orderBy("site_id", "event_time", "depth_cm", "measure_type", "soil_texture").limit(1)
    extra = row.withColumn("event_time", F.col("event_time") - F.expr("interval 1 day"))
    return df.unionByName(extra.withColumns({c: F.expr(e) for c, e in changes.items()}))


def test_good_table_passes(good, limits):
    assert failed(good, limits, extra_ranges=True) == []
    assert assert_quality(good, limits) is good


@pytest.mark.parametrize(
    "check, changes",
    [
        ("Q3", {"site_name": "CAST(NULL AS STRING)"}),
        ("Q4", {"site_id": "CAST(NULL AS STRING)"}),
        ("Q5", {"measure_type": "'Battery'"}),
        ("Q6", {"depth_cm": "90"}),
        ("Q7", {"measure_type": "'Moisture'", "soil_value": "100.5D"}),
    ],
)
def test_one_bad_row_fails_one_check(good, limits, check, changes):
    assert failed(with_extra_row(good, **changes), limits) == [check]


def test_nan_moisture_is_not_out_of_range(good, limits):
    changes = {"measure_type": "'Moisture'", "soil_value": "double('NaN')"}
    assert failed(with_extra_row(good, **changes), limits) == []


def test_duplicates_count_null_textures(good, limits):
    untextured = good.filter("soil_texture IS NULL").limit(1)
    doubled = good.unionByName(untextured).unionByName(untextured)
    report = {r.check_id: r for r in quality_report(doubled, limits).collect()}
    assert report["Q8"].observed == 2 and not report["Q8"].passed


def test_counts_fail(good, settings):
    assert failed(good, settings.but(min_rows=580)) == ["Q1"]
    assert failed(good, settings.but(min_rows=500, min_sites=13)) == ["Q9"]


def test_columns(good, limits):
    lacking = good.drop("depth_cm", "soil_value")
    with pytest.raises(QualityError, match="missing_columns: 2 .*missing column depth_cm"):
        assert_quality(lacking, limits)
    assert "Q2" in failed(lacking, limits)
    with pytest.raises(QualityError, match="rows: .*>= 5000"):
        assert_quality(good, limits.but(min_rows=5000))


def test_extra_ranges(good, limits):
    hot = with_extra_row(good, measure_type="'Temperature'", soil_value="99D")
    assert failed(hot, limits) == []
    assert failed(hot, limits, extra_ranges=True) == ["extra"]


def test_gate_expands_no_rows_and_shuffles_keys_once(spark, limits):
    silver = spark.range(5000).select(
        F.concat(F.lit("s"), F.col("id") % 20).alias("site_name"),
        (F.col("id") % 20).cast("string").alias("site_id"),
        F.timestamp_seconds("id").alias("event_time"),
        F.lit(10).alias("depth_cm"),
        F.lit("Moisture").alias("measure_type"),
        F.lit(None).cast("string").alias("soil_texture"),
        F.lit(1.0).alias("soil_value"),
    )
    report = quality_report(silver, limits)
    assert all(r.passed for r in report.collect())
    plan = plan_of(report).split("Initial Plan")[0]
    assert "Expand" not in plan and "NestedLoop" not in plan
    shuffled = [line for line in plan.splitlines() if " Exchange hashpartitioning" in line]
    # one row for each site and task, and one narrow row for each key
    assert len(shuffled) == 2 and sum("site_name" in line for line in shuffled) == 1


def test_empty_table_has_a_report(good, limits):
    report = {r.check_id: r for r in quality_report(good.filter("false"), limits).collect()}
    assert len(report) == 9 and not report["Q1"].passed and report["Q8"].observed == 0

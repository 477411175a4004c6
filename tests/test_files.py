"""Readers, sinks and the pipeline on files in a temporary folder."""

import json
from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamline import session
from loamline.__main__ import main
from loamline.config import Settings
from loamline.demo import catalog
from loamline.plans import bronze
from loamline.plans.pipeline import Lake, Pipeline
from loamline.operators.quality import QualityError
from loamline.schemas import RAW_SOIL, SOIL_RECORD, require_columns
from loamline.session import clear_scratch, scratch_path, scratch_root, stored
from loamline.storage import names_in
from loamline.operators.keyed import absent_rows
from loamline.plans.silver import silver_weather
from loamline.sinks.jdbc import in_transaction, stage_name, swap_statements
from loamline.sinks import (
    append_absent,
    column_types,
    connection,
    for_database,
    rejects_path,
    replace_partitions,
    write_table,
)
from loamline.sources import pages
from loamline.sources import (
    page_after,
    read_if_exists,
    read_pages,
    read_sites_csv,
    read_table,
    read_weather_csv,
    weather_from_text,
    weather_text,
)
from tests.conftest import SF, plan_of, same_rows


def test_sites_csv(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text(
        "﻿Site_ID , Site_Name ,Property_Name,Latitude,Longitude\n"
        " 7 , North Lawn ,, -37.8 ,144.9\n"
        "7,Another name,x,1,2\n"
        ",No id,x,1,2\n"
        "x1,Bad id,x,1,2\n"
        "8,Bad latitude,x,south,2\n"
        "9,No place,x,,\n",
        encoding="utf-8",
    )
    text = read_sites_csv(spark, str(path))
    sites = {r.site_id: tuple(r)[1:] for r in bronze.sites_dimension(text).collect()}
    assert sites == {7: ("North Lawn", "", -37.8, 144.9), 9: ("No place", "x", None, None)}
    reasons = bronze.site_rows(text).filter("reject_reason IS NOT NULL")
    assert {r.reject_reason for r in reasons.collect()} == {
        "missing site_id", "bad site_id", "bad latitude",
    }


def test_weather_csv(spark, tmp_path):
    path = tmp_path / "rain.csv"
    path.write_text(
        "Product code,Station,Year,Month,Day,Rainfall amount,Period,Quality\n"
        "P,086,2024,1,31,1.5,1,Y\n"
        "P,086,2024,2,30,1.5,1,Y\n"
        "P,086,2024,2,,2,1,N\n"
        "P,086,2024,3,1,wet,,\n"
    )
    dated = bronze.weather_with_date(read_weather_csv(spark, str(path), "rainfall"))
    good = {r.date: (r.rainfall_mm, r.station_number) for r in bronze.accepted(dated, "date").collect()}
    assert good == {date(2024, 1, 31): (1.5, "086"), date(2024, 3, 1): (None, "086")}
    assert bronze.rejected(dated, "date").count() == 2


def test_weather_rejects_name_file_line_and_cell(spark, tmp_path):
    folder = tmp_path / "rain"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "Product code,Station,Year,Month,Day,Rainfall amount,Period,Quality\n"
        "P,086,2024,1,31,1.5,1,Y\n"
        "P,086,2024,3,1,wet,2.5x,\n"
        "P,086,2024,3,2, 4.5 ,,\n"
        "P,086,2024\n"
        "P,086,2024,3,4,1,1,Y,more\n"
    )
    (folder / "b.csv").write_text(
        "Product code,Station,Year,Month,Day,Rainfall amount,Period,Quality\n"
        "P,087,20x4,1,31,1.5,1,Y\n"
        "P,087,2024,2,30,7,,\n"
    )
    typed, aside = weather_from_text(weather_text(spark, str(folder), "rainfall"), "rainfall")
    assert same_rows(typed, read_weather_csv(spark, str(folder), "rainfall").withColumn(
        "rainfall_mm", F.when(F.col("day") == 2, 4.5).otherwise(F.col("rainfall_mm"))
    ))
    got = {(r.reason, r.column, r.cell, r.line, r.file[-5:]) for r in aside.collect()}
    assert got == {
        ("not double", "rainfall_mm", "wet", "P,086,2024,3,1,wet,2.5x,", "a.csv"),
        ("not double", "period_days", "2.5x", "P,086,2024,3,1,wet,2.5x,", "a.csv"),
        ("malformed line", None, None, "P,086,2024", "a.csv"),
        ("malformed line", None, None, "P,086,2024,3,4,1,1,Y,more", "a.csv"),
        ("not int", "year", "20x4", "P,087,20x4,1,31,1.5,1,Y", "b.csv"),
    }
    pipeline = Pipeline(spark, Lake(str(tmp_path / "lake")))
    assert pipeline.ingest_weather("rainfall", str(folder)) == (4, 8)
    rejects = read_table(spark, rejects_path(pipeline.lake.path("bronze", "weather_rainfall")))
    reasons = sorted(r.reason for r in rejects.collect())
    assert reasons == ["malformed line"] * 2 + ["no such day"] * 3 + ["not double"] * 2 + ["not int"]
    assert rejects.filter("reason = 'not double' AND source LIKE '%a.csv'").count() == 2


RECORD = {
    "local_time": "2024-01-01T10:00:00+11:00", "site_name": "S", "site_id": 5, "id": 12,
    "probe_id": 3, "probe_measure": "Soil Moisture 10cm", "soil_value": 0, "unit": "%",
}


def test_pages(spark, tmp_path):
    lines = [
        {"results": [RECORD, {**RECORD, "id": 13, "soil_value": None}]},
        {"results": []},
        {"total_count": 0},
        {"results": [{**RECORD, "id": "14", "soil_value": "high", "local_time": "soon"}]},
    ]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, lines)))
    rows = bronze.soil_from_records(read_pages(spark, str(tmp_path / "a.json")))
    good = {r.ID: r for r in bronze.accepted(rows, "event_time").collect()}
    assert {i: r.Soil_Value for i, r in good.items()} == {"12": 0.0, "13": None}
    assert good["12"].event_time == datetime(2023, 12, 31, 23)
    assert (good["12"].Site_ID, good["12"].Probe_ID) == ("5", "3")
    assert [r.ID for r in bronze.rejected(rows, "event_time").collect()] == ["14"]

    (tmp_path / "b.json").write_text(json.dumps({"results": [RECORD]}, indent=1))
    assert read_pages(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")]).count() == 4


def test_lines_of_a_page_are_told_by_how_they_begin(spark, tmp_path):
    """A line that cannot hold a page is not parsed; every other one is read as the parser reads it."""
    whole = json.dumps({"results": [{"id": "7"}], "total_count": 1})
    lines = [whole, f" \t{whole}", f"[{whole}]", "{", "[", "}", '"results": [', "null", "7", "{}", f"x{whole}", "\u00a0" + whole]
    (tmp_path / "lines.json").write_text("\n".join(lines), encoding="utf-8")
    (tmp_path / "whole.json").write_text(json.dumps(json.loads(whole), indent=2), encoding="utf-8")
    read = pages.landed_pages(pages.page_lines(spark, str(tmp_path)))
    assert "CASE WHEN RLIKE(value" in plan_of(read)
    plain = F.from_json(F.col("text"), pages.page_schema(SOIL_RECORD))
    parsed = spark.createDataFrame([(x,) for x in lines], "text string").select(plain.alias("page")).collect()
    want = [r.page.total_count if r.page else None for r in parsed]
    by_line = [r.page.total_count for r in read.collect() if r.file.endswith("lines.json")]
    assert sorted(by_line, key=str) == sorted(want, key=str) and by_line.count(1) >= 2
    (one,) = [r for r in read.collect() if r.file.endswith("whole.json")]
    assert [x.id for x in one.page.results] == ["7"] and one.page.total_count == 1


def test_mixed_pages_land_in_few_files(tables, monkeypatch):
    """The number of files grows far slower than that of pages, and no file has a folder of its own."""
    landed = []
    ingest = Pipeline.ingest_soil_pages
    monkeypatch.setattr(Pipeline, "ingest_soil_pages", lambda self, path: (landed.append(path), ingest(self, path))[1])
    assert catalog.queries()["json_pages_mixed"](tables.spark, SF).count() > 0
    found = [f for f in Path(landed[0]).rglob("*") if not f.name.startswith((".", "_"))]
    assert all(f.is_file() for f in found)
    # For each stretch of 5,000 readings one whole page and one that is cut off.
    stretches = -(-tables.read("events").count() // 5_000)
    pretty = [f.read_text() for f in found if f.read_text().startswith("{\n")]
    assert len(pretty) == 2 * stretches and sum(t.rstrip().endswith("}") for t in pretty) == stretches


def test_site_pages(spark, tables, tmp_path):
    site = {"site_id": 3, "site_name": "S", "property_name": "P", "latitude": -37.8, "longitude": None}
    pages = [{"results": [site, {**site, "latitude": 1}]}, {"results": [{**site, "site_id": None}]}]
    (tmp_path / "sites.json").write_text("\n".join(map(json.dumps, pages)))
    pipeline = Pipeline(spark, Lake(str(tmp_path / "lake")))
    assert pipeline.ingest_sites_pages(str(tmp_path / "sites.json")) == (1, 2)
    row = read_table(spark, pipeline.lake.path("bronze", "sites")).first()
    assert (row.site_id, row.latitude, row.longitude) == (3, -37.8, None)


def test_missing_table(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(ValueError, match="probe_id"):
        require_columns(spark.createDataFrame([("1",)], "id string"), RAW_SOIL)


def test_write_counts_and_replaces_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, measure_type string")
    assert write_table(df, path, partition_by=("measure_type",), stamps=("transformed_at",)) == 3
    assert replace_partitions(
        df.filter("v = 3").withColumn("v", F.lit(30)), path, ("measure_type",), ("transformed_at",)
    ) == 1
    assert sorted(r.v for r in read_table(spark, path).collect()) == [1, 2, 30]
    assert write_table(df, path, single_file=True) == 3
    assert len(read_table(spark, path).inputFiles()) == 1
    declared = read_table(spark, path, spark.createDataFrame([], "v int").schema)
    assert declared.columns == ["v"]


def test_scratch_path(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and "/x-" in first

    def other(master, **conf):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=conf, sparkContext=context)

    named = other("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_path(named, "y").startswith("hdfs:///shared/loamline-app-1/y-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(other("yarn"), "y")


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    assert scratch_root(spark).endswith(f"/loamline-{spark.sparkContext.applicationId}")
    root = str(tmp_path / "shared" / "app")
    monkeypatch.setattr(session, "scratch_root", lambda _: root)
    rows = stored(spark.range(5), "some")
    assert rows.count() == 5 and len(names_in(spark, root)) == 1
    clear_scratch(spark)
    assert names_in(spark, root) == [] and (tmp_path / "shared").exists()
    clear_scratch(spark)


def test_nothing_is_lost_at_ingest(spark, tmp_path):
    """Every record of every file is stored or set aside, by the batch and by the stream alike."""
    landing = tmp_path / "pages"
    landing.mkdir()
    lines = [
        {"results": [RECORD, {**RECORD, "id": None}], "total_count": 5},
        {"results": [{**RECORD, "id": 20, "local_time": "soon"}], "total_count": 5},
    ]
    cut = json.dumps({"results": [RECORD]})[:-9]
    (landing / "lines.json").write_text("\n".join(map(json.dumps, lines)) + f"\n\n{cut}\n")
    (landing / "page.json").write_text(json.dumps({"results": [{**RECORD, "id": 21}]}, indent=2))
    (landing / "broken.json").write_text(json.dumps({"results": [{**RECORD, "id": 22}]}, indent=2)[:-4])
    pipeline = Pipeline(spark, Lake(str(tmp_path / "lake")))
    assert pipeline.ingest_soil_pages(str(landing)) == (2, 5)
    assert pipeline.ingest_soil_pages(str(landing)).added == 0
    table = pipeline.lake.path("bronze", "soil_readings")
    aside = read_table(spark, rejects_path(table))
    assert sorted(r.reason for r in aside.collect()) == [
        "incomplete delivery", "missing id", "unreadable page", "unreadable page", "unreadable time",
    ]
    assert aside.filter("reason = 'unreadable time'").first().record.count('"id":"20"') == 1

    from loamline.streaming.ingest import ingest_pages

    other = str(tmp_path / "stream")
    ingest_pages(spark, str(landing), other, str(tmp_path / "check")).awaitTermination()
    columns = ["ID", "event_time", "Soil_Value"]
    assert same_rows(read_table(spark, table).select(columns), read_table(spark, other).select(columns))
    streamed = read_table(spark, rejects_path(other))
    assert same_rows(aside.select("reason", "record"), streamed.select("reason", "record"))


def test_late_rows_and_mixed_id_types(spark, tmp_path):
    pipeline = Pipeline(spark, Lake(str(tmp_path / "lake")))
    history = spark.createDataFrame(
        [("2024-03-01T00:00:00+00:00", "S", 5, 1, 3, "Soil Moisture 10cm", 20.0, "%")],
        "local_time string, site_name string, site_id bigint, id bigint, probe_id bigint, "
        "probe_measure string, soil_value double, unit string",
    )
    history.write.parquet(str(tmp_path / "history"))
    assert pipeline.ingest_soil(str(tmp_path / "history")) == (1, 0)
    (tmp_path / "late.json").write_text(json.dumps({"results": [RECORD]}))
    assert pipeline.ingest_soil_pages(str(tmp_path / "late.json")) == (1, 0)
    assert pipeline.silver_soil() == 2
    table = pipeline.lake.path("bronze", "soil_readings")
    assert {r.ID for r in read_table(spark, table).collect()} == {"1", "12"}
    numbers = spark.createDataFrame([(1, date(2024, 3, 1))], "ID bigint, event_day date")
    with pytest.raises(ValueError, match="ID is string, not bigint"):
        append_absent(numbers, table, ["ID"])


def test_keys_are_looked_up_in_the_days_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(str(i), date(2024, 1, 1 + i % 20)) for i in range(200)]
    old = spark.createDataFrame(rows, "ID string, event_day date")
    assert append_absent(old, path, ["ID"], day="event_day") == (200, 0)
    new = spark.createDataFrame([("3", date(2024, 1, 4)), ("x", date(2024, 1, 4))], old.schema)
    existing = read_table(spark, path).filter(F.col("event_day").isin([date(2024, 1, 4)]))
    rows = absent_rows(new, existing, ["ID"])
    plan = plan_of(rows)
    assert "PartitionFilters: [isnotnull(event_day" in plan or "event_day#" in plan.split("PartitionFilters: [")[1]
    assert "SortAggregate" not in plan
    assert append_absent(new, path, ["ID"], day="event_day") == (1, 0)
    assert read_table(spark, path).count() == 201


def test_repeated_days_of_weather_multiply_nothing(spark, settings):
    feeds = [
        spark.createDataFrame([(date(2024, 1, 1), float(v)) for v in (1, 2, 6)] + [(None, 5.0)], f"date date, {name} double")
        for name in ("rainfall_mm", "max_temp_c", "solar_exposure_mj")
    ]
    got = silver_weather(*feeds, settings).collect()
    assert [tuple(r) for r in got] == [(date(2024, 1, 1), 3.0, 3.0, 3.0)]
    assert silver_weather(*feeds, settings.but(weather_from=None)).count() == 1


def test_gold_scans_silver_once(spark, tables, settings, tmp_path):
    path = str(tmp_path / "silver")
    tables.silver_soil().write.parquet(path)
    from loamline.plans.gold import gold_hourly

    plan = plan_of(gold_hourly(read_table(spark, path), settings))
    assert plan.count("FileScan") == 1


def test_pages_by_last_key(spark):
    df = spark.range(10).withColumnRenamed("id", "key")
    first = [r.key for r in page_after(df, "key", 4).collect()]
    assert first == [0, 1, 2, 3]
    assert [r.key for r in page_after(df, "key", 4, first[-1]).collect()] == [4, 5, 6, 7]


def test_database_options(spark):
    assert connection("postgresql+psycopg2://me:p%40ss@db:5432/farm") == {
        "url": "jdbc:postgresql://db:5432/farm", "user": "me", "password": "p@ss",
    }
    assert connection("jdbc:x:y") == {"url": "jdbc:x:y"}
    df = spark.createDataFrame(
        [(1, 2, 3.0, float("nan"), "s", True, date(2024, 1, 1), datetime(2024, 1, 1, 5))],
        "a int, b bigint, c double, d double, e string, f boolean, g date, h timestamp",
    )
    out = for_database(df)
    assert dict(out.dtypes)["h"] == "timestamp_ntz"
    row = out.first()
    assert (row.c, row.d, row.h) == (3.0, None, datetime(2024, 1, 1, 5))
    assert column_types(out.schema) == "`a` INTEGER, `b` BIGINT, `f` BOOLEAN, `g` DATE, `h` TIMESTAMP"


def test_tables_are_swapped_in_one_transaction():
    log = []

    class Connection:
        def setAutoCommit(self, on):
            log.append(f"auto {on}")

        def createStatement(self):
            return SimpleNamespace(execute=lambda sql: log.append(sql) or ("boom" in sql and 1 / 0), close=lambda: None)

        def commit(self):
            log.append("commit")

        def rollback(self):
            log.append("rollback")

        def close(self):
            log.append("close")

    assert stage_name("gold.daily") == "gold.daily__stage"
    statements = swap_statements("gold.daily")
    assert statements == [
        "DROP TABLE IF EXISTS gold.daily",
        "ALTER TABLE gold.daily__stage RENAME TO daily",
    ]
    in_transaction(Connection(), statements)
    assert log == ["auto False", *statements, "commit", "close"]
    log.clear()
    with pytest.raises(ZeroDivisionError):
        in_transaction(Connection(), ["boom", "never"])
    assert log == ["auto False", "boom", "rollback", "close"]


def test_database_types_suit_sparks_parser(spark, tables):
    for df in (tables.gold_daily(), tables.gold_hourly()):
        declared = column_types(for_database(df).schema)
        assert {f.name for f in StructType.fromDDL(declared)} <= set(df.columns)


def test_settings_from_json(tmp_path):
    path = tmp_path / "c.json"
    sections = {
        "thresholds": {"soil_moisture_irrigate": 25, "moisture_max": 90, "min_rows": 7},
        "api": {"timezone": "Australia/Sydney"},
        "bounds": {"weather_from": None, "first_load": "2024-05-01"},
    }
    path.write_text(json.dumps(sections))
    s = Settings.from_json(str(path))
    assert (s.timezone, s.min_rows, s.min_sites) == ("Australia/Sydney", 7, 10)
    assert s.weather_from is None and s.first_load == datetime(2024, 5, 1)
    path.write_text("{}")
    assert Settings.from_json(str(path)) == Settings()
    path.write_text(json.dumps(sections))
    assert s.irrigate_below == 25 and s.ranges["Moisture"] == (0.0, 90.0)
    assert s.shallow == (10, 20, 30, 40) and s.deep == (50, 60, 70, 80)


def test_pipeline_equals_direct_computation(spark, tables, tmp_path):
    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    tables.raw_soil().write.parquet(raw)
    assert main(["ingest-soil", "--lake", lake, "--input", raw]) is None
    for feed in ("rainfall", "temperature", "solar"):
        path = str(tmp_path / feed)
        tables.raw_weather(feed).write.option("header", True).csv(path)
        main([f"ingest-{feed}", "--lake", lake, "--input", path])
    pipeline = Pipeline(spark, Lake(lake), Settings(min_rows=500))
    assert pipeline.silver_soil() == tables.silver_soil().count()
    pipeline.silver_weather()
    pipeline.validate()
    with pytest.raises(QualityError):
        Pipeline(spark, Lake(lake)).validate()
    assert pipeline.gold_daily() == tables.gold_daily().count()
    assert pipeline.gold_hourly() == tables.gold_hourly().count()

    def rounded(df):
        return df.select(*[F.round(c, 6).alias(c) if k == "double" else c for c, k in df.dtypes])

    stored = read_table(spark, f"{lake}/gold/daily_site_summary").drop("transformed_at")
    assert same_rows(rounded(tables.gold_daily()), rounded(stored))

    sites = str(tmp_path / "sites")
    tables.raw_sites().write.option("header", True).csv(sites)
    assert pipeline.ingest_sites_csv(sites) == (tables.raw_sites().count(), 0)
    assert pipeline.ingest_sites_csv(sites) == (0, 0)


def test_incremental_pages_pipeline(spark, tables, tmp_path):
    from loamline.demo.catalog import land_pages, raw_deliveries

    lake = Lake(str(tmp_path / "lake"))
    pipeline = Pipeline(spark, lake)
    first, second = raw_deliveries(tables)
    land_pages(tables, first, str(tmp_path / "p1"))
    land_pages(tables, second, str(tmp_path / "p2"))
    n = pipeline.ingest_soil_pages(str(tmp_path / "p1")).added
    assert pipeline.ingest_soil_pages([str(tmp_path / "p1"), str(tmp_path / "p2")]).added > 0
    assert pipeline.ingest_soil_pages(str(tmp_path / "p2")) == (0, 0)
    table = read_table(spark, lake.path("bronze", "soil_readings"))
    assert n == first.count() and table.count() == tables.raw_soil().count()
    assert table.select("ID").distinct().count() == table.count()


def test_no_python_and_no_cross_join_in_plans(spark, tables):
    from loamline.demo import catalog

    from tests.conftest import SF

    for name, run in catalog.queries().items():
        plan = plan_of(run(spark, SF))
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)

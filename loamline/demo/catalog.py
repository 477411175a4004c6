"""Named queries over the test tables, one per operator or report."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.config import Settings
from loamline.demo.tables import FEED_PRIORITIES, SHIFT_DAYS, Tables
from loamline.functions import (
    depth_cm,
    first_measure_word,
    measure_type,
    probe_suffix,
    soil_texture,
)
from loamline.functions.times import OFFSET_PATTERN
from loamline.operators import calendar, counts, keyed, quality, sets, summary
from loamline.plans import bronze, profile, replay, reports, silver
from loamline.plans.pipeline import Lake, Pipeline
from loamline.schemas import SILVER_SOIL, SILVER_WEATHER, WEATHER_CSV, WEATHER_VALUE, conform
from loamline.session import scratch_path, stored
from loamline.sinks import (
    append_absent,
    for_database,
    rejects_path,
    replace_partitions,
    replace_table,
    write_table,
)
from loamline.sources import (
    all_pages,
    high_water_mark,
    incremental_slice,
    page_of,
    range_slice,
    read_landed,
    read_pages,
    read_sites_csv,
    read_table,
    read_weather_csv,
    stored_high_water_mark,
    weather_from_text,
    weather_text,
)
from loamline.streaming.ingest import ingest_pages
from loamline.streaming.rollup import keep_hourly, read_hourly

Query = Callable[[SparkSession, str], DataFrame]

# The middle of the readings' month; a second delivery starts half a day earlier, so both overlap.
MIDDLE = datetime(2024, 1, 16)
SECOND_FROM = datetime(2024, 1, 15, 12)
PAGE_ROWS = 100
# Stretches of so many pages come in files that hold one page each.
FILE_PAGES = 50

SOIL = (
    "ID",
    "Site_Name",
    "Site_ID",
    "Probe_ID",
    "Probe_Measure",
    "Soil_Value",
    "Unit",
    "event_time",
)

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def comparable(df: DataFrame) -> DataFrame:
    """Doubles at six decimal places, timestamps as plain UTC.

    A mean such as 28.6409375 lies halfway between two results, and the noise of its summation order
    would decide. As a decimal of ten places the noise is gone and every engine rounds it up.
    """
    changed = {}
    for name, kind in df.dtypes:
        if kind == "double":
            changed[name] = F.round(F.col(name).cast("decimal(30,10)"), 6).cast("double")
        elif kind == "timestamp":
            changed[name] = F.convert_timezone(None, F.lit("UTC"), F.col(name))
    return df.withColumns(changed) if changed else df


def queries(settings: Settings = Settings()) -> dict[str, Query]:
    def bind(fn: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: comparable(fn(Tables(spark, sf_dir, settings)))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


# Bronze


@query
def bronze_soil(t: Tables) -> DataFrame:
    rows = bronze.soil_from_raw(t.raw_soil(), OFFSET_PATTERN)
    return bronze.accepted(rows, "event_time").select(*SOIL, "Local_Time", "json_featuretype")


@query
def bronze_weather(t: Tables) -> DataFrame:
    feeds = [
        t.bronze_weather(feed).select(
            F.lit(feed).alias("feed"), "date", F.col(value).alias("value")
        )
        for feed, value in WEATHER_VALUE.items()
    ]
    return feeds[0].unionByName(feeds[1]).unionByName(feeds[2])


@query
def probe_texts(t: Tables) -> DataFrame:
    text = F.col("Probe_Measure")
    return t.bronze_soil().select(
        "ID",
        depth_cm(text).alias("depth_cm"),
        measure_type(text).alias("measure_type"),
        first_measure_word(text).alias("measure_word"),
        soil_texture(text).alias("soil_texture"),
        probe_suffix(text).alias("probe_suffix"),
    )


# Silver and gold


@query
def silver_soil(t: Tables) -> DataFrame:
    return t.silver_soil()


@query
def silver_weather(t: Tables) -> DataFrame:
    return t.silver_weather()


@query
def texture_lookup(t: Tables) -> DataFrame:
    return summary.texture_lookup(t.silver_soil())


@query
def gold_daily(t: Tables) -> DataFrame:
    return t.gold_daily()


@query
def gold_hourly(t: Tables) -> DataFrame:
    return t.gold_hourly()


@query
def gold_daily_sydney(t: Tables) -> DataFrame:
    """Days of a zone eleven hours ahead of UTC."""
    return Tables(t.spark, t.sf_dir, t.settings.but(timezone="Australia/Sydney")).gold_daily()


@query
def quality_report(t: Tables) -> DataFrame:
    return quality.quality_report(t.silver_soil(), t.settings)


# Reports


def _latest(t: Tables) -> DataFrame:
    return reports.latest_day(t.silver_soil(), t.settings)


@query
def irrigation_status_latest(t: Tables) -> DataFrame:
    return reports.irrigation_status(t.gold_daily(), _latest(t))


@query
def moisture_trend_driest5(t: Tables) -> DataFrame:
    return reports.moisture_trend(t.gold_daily(), t.settings, 5, _latest(t))


@query
def site_series(t: Tables) -> DataFrame:
    return reports.site_series(t.gold_daily(), t.settings)


@query
def irrigation_days(t: Tables) -> DataFrame:
    return reports.irrigation_days(t.gold_daily())


@query
def irrigation_listing(t: Tables) -> DataFrame:
    return reports.irrigation_listing(t.gold_daily())


@query
def rain_response(t: Tables) -> DataFrame:
    return reports.rain_response(t.gold_daily())


# Profiles


@query
def feed_coverage(t: Tables) -> DataFrame:
    soil = t.bronze_soil().withColumn("date", F.to_date("event_time"))
    return profile.feed_coverage(
        {
            "soil": (soil, "date", "Soil_Value"),
            **{f: (t.bronze_weather(f), "date", v) for f, v in WEATHER_VALUE.items()},
        }
    )


@query
def measure_profile(t: Tables) -> DataFrame:
    return profile.measure_profile(t.bronze_soil())


@query
def weather_profile(t: Tables) -> DataFrame:
    return profile.weather_profile({f: (t.bronze_weather(f), v) for f, v in WEATHER_VALUE.items()})


@query
def reading_gaps(t: Tables) -> DataFrame:
    return profile.reading_gaps(t.bronze_soil())


@query
def site_measure_matrix(t: Tables) -> DataFrame:
    return profile.site_measure_matrix(t.bronze_soil())


@query
def sites_missing_measure(t: Tables) -> DataFrame:
    return profile.sites_missing_measure(t.bronze_soil())


@query
def site_coverage(t: Tables) -> DataFrame:
    return profile.site_coverage(t.bronze_soil())


@query
def coverage_classes(t: Tables) -> DataFrame:
    return profile.coverage_classes(t.bronze_soil())


@query
def depth_coverage_hist(t: Tables) -> DataFrame:
    return profile.depth_coverage(t.bronze_soil())


@query
def texture_consistency(t: Tables) -> DataFrame:
    return profile.texture_consistency(t.bronze_soil())


@query
def first_texture(t: Tables) -> DataFrame:
    return profile.first_texture(t.bronze_soil())


@query
def hash_probe_sites(t: Tables) -> DataFrame:
    return profile.hash_probe_sites(t.bronze_soil())


@query
def probe_suffix_overlap(t: Tables) -> DataFrame:
    return profile.hash_probe_overlap(t.bronze_soil())


@query
def probe_site_sets(t: Tables) -> DataFrame:
    """Intersection and difference of the sites with and without marked probes."""
    marked = F.col("Probe_Measure").contains("#0")
    with_mark = sets.values_where(t.bronze_soil(), "Site_Name", marked)
    without = sets.values_where(t.bronze_soil(), "Site_Name", ~marked)
    both = sets.in_both(with_mark, without).withColumn("kind", F.lit("both"))
    return both.unionByName(
        sets.only_left(without, with_mark).withColumn("kind", F.lit("only without"))
    )


@query
def probe_suffix_counts(t: Tables) -> DataFrame:
    return profile.suffix_counts(t.bronze_soil())


@query
def probe_text_counts(t: Tables) -> DataFrame:
    return counts.value_counts(t.bronze_soil(), "Probe_Measure")


@query
def measure_counts(t: Tables) -> DataFrame:
    return counts.value_counts(profile.with_measure(t.bronze_soil()), "measure_type")


@query
def depth_counts(t: Tables) -> DataFrame:
    return counts.value_counts(profile.with_depth(t.bronze_soil()), "depth_cm", by_value=True)


@query
def texture_counts(t: Tables) -> DataFrame:
    texture = soil_texture(F.col("Probe_Measure")).alias("soil_texture")
    return counts.value_counts(t.bronze_soil().select(texture), "soil_texture")


@query
def site_names(t: Tables) -> DataFrame:
    return t.bronze_soil().select("Site_Name", "Site_ID").distinct().orderBy("Site_Name", "Site_ID")


@query
def readings_per_month(t: Tables) -> DataFrame:
    return calendar.rows_per_month(t.bronze_soil(), "event_time")


@query
def missing_dates(t: Tables) -> DataFrame:
    gaps = [
        calendar.missing_dates(t.bronze_weather(feed)).withColumn("feed", F.lit(feed))
        for feed in WEATHER_VALUE
    ]
    return gaps[0].unionByName(gaps[1]).unionByName(gaps[2])


# Incremental ingest and keyed operations


@query
def time_chunks(t: Tables) -> DataFrame:
    span = t.bronze_soil().agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    return calendar.chunk_spans(span, F.col("lo"), F.col("hi"), t.settings)


@query
def high_water_mark_silver(t: Tables) -> DataFrame:
    return high_water_mark(t.silver_soil())


@query
def range_slice_second_half(t: Tables) -> DataFrame:
    return range_slice(t.bronze_soil(), MIDDLE, datetime(2024, 2, 1)).select(*SOIL)


@query
def third_page(t: Tables) -> DataFrame:
    """The third hundred of the readings in time order, newest first."""
    order = [F.desc("event_time"), F.desc(F.col("ID").cast("bigint"))]
    return page_of(t.bronze_soil().select(*SOIL), order, PAGE_ROWS, 2 * PAGE_ROWS)


@query
def page_numbers(t: Tables) -> DataFrame:
    """Every reading with the number of its page, newest first, from one pass."""
    order = [F.desc("event_time"), F.desc("number")]
    rows = t.bronze_soil().select("ID", F.col("ID").cast("bigint").alias("number"), "event_time")
    return all_pages(rows, order, PAGE_ROWS).select("ID", "event_time", "page")


@query
def high_water_mark_stored(t: Tables) -> DataFrame:
    """The last time of a table stored by day, and the ids that have it; only the newest day is read."""
    path = scratch_path(t.spark, "bronze")
    rows = t.bronze_soil().select(*SOIL).withColumn("event_day", F.to_date("event_time"))
    replace_table(rows, path, ("event_day",))
    last = stored_high_water_mark(t.spark, path)
    return range_slice(read_table(t.spark, path), last).select("ID", "event_time")


def _deliveries(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All readings in two deliveries that share half a day."""
    soil = t.bronze_soil().select(*SOIL)
    return (
        soil.filter(F.col("event_time") < F.lit(MIDDLE)),
        soil.filter(F.col("event_time") >= F.lit(SECOND_FROM)),
    )


@query
def incremental_rows(t: Tables) -> DataFrame:
    stored, _ = _deliveries(t)
    return incremental_slice(t.bronze_soil().select(*SOIL), stored, t.settings)


@query
def insert_if_absent(t: Tables) -> DataFrame:
    stored, new = _deliveries(t)
    return keyed.insert_if_absent(stored, new, ["ID"], ["event_time"])


@query
def duplicate_keys(t: Tables) -> DataFrame:
    return counts.duplicate_keys(t.bronze_soil(), ["Site_ID", "Probe_ID", "event_time"])


@query
def last_n_by_id(t: Tables) -> DataFrame:
    return replay.last_by_id(t.bronze_soil())


@query
def delete_by_key(t: Tables) -> DataFrame:
    soil = t.bronze_soil()
    return keyed.delete_keys(soil, replay.last_by_id(soil), ["ID"])


@query
def keyed_lookup(t: Tables) -> DataFrame:
    soil = t.bronze_soil()
    return keyed.matching_rows(
        soil, replay.last_by_id(soil), ["Site_ID", "Probe_ID", "event_time"]
    )


@query
def replay_difference(t: Tables) -> DataFrame:
    soil = t.bronze_soil()
    return replay.replay_difference(soil, soil, t.settings)


# Files and streams


@query
def parquet_partitioned(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "silver")
    write_table(t.silver_soil(), path, partition_by=("measure_type",), stamps=("transformed_at",))
    return read_table(t.spark, path).drop("transformed_at")


@query
def weather_csv(t: Tables) -> DataFrame:
    feeds = []
    for feed, value in WEATHER_VALUE.items():
        path = scratch_path(t.spark, f"csv-{feed}")
        t.raw_weather(feed).write.option("header", True).csv(path)
        rows = bronze.weather_with_date(read_weather_csv(t.spark, path, feed))
        feeds.append(
            bronze.accepted(rows, "date").select(
                F.lit(feed).alias("feed"), "date", F.col(value).alias("value")
            )
        )
    return feeds[0].unionByName(feeds[1]).unionByName(feeds[2])


@query
def weather_csv_rejects(t: Tables) -> DataFrame:
    """Lines and cells of weather files that do not fit, of which some were spoilt."""
    aside = []
    for feed, value in WEATHER_VALUE.items():
        path = scratch_path(t.spark, f"csv-{feed}")
        text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in WEATHER_CSV[feed].names]
        rows = t.raw_weather(feed).select(*text)
        spoilt = F.when(F.col("day") == "7", F.lit("wet")).when(F.col("day") == "9", F.lit(" "))
        cells = [spoilt.otherwise(F.col(c)) if c == value else F.col(c) for c in rows.columns]
        short = F.concat_ws(",", *rows.columns[:3])
        line = F.when(F.col("day") == "8", short).otherwise(F.concat_ws(",", *cells))
        header = t.spark.createDataFrame([(0, ",".join(rows.columns))], "n int, value string")
        lines = header.unionByName(rows.select(F.lit(1).alias("n"), line.alias("value")))
        lines.coalesce(1).sortWithinPartitions("n", "value").select("value").write.text(path)
        _, wrong = weather_from_text(weather_text(t.spark, path, feed), feed)
        aside.append(wrong.select(F.lit(feed).alias("feed"), "reason", "column", "cell", "line"))
    return aside[0].unionByName(aside[1]).unionByName(aside[2])


@query
def sites_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv-sites")
    padded = t.raw_sites().select(
        F.concat(F.lit(" "), F.col("site_id"), F.lit(" ")).alias("Site_ID "),
        F.concat(F.lit("  "), F.col("site_name")).alias(" Site_Name"),
        F.col("property_name").alias("Property_Name"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
    )
    padded.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return bronze.sites_dimension(read_sites_csv(t.spark, path))


def land_pages(
    t: Tables,
    rows: DataFrame,
    path: str,
    page: Column | None = None,
    paged: DataFrame | None = None,
) -> None:
    """Write raw readings as pages of at most 100 records, one page per line.

    ``paged`` holds the rows with further columns, from which ``page`` gives the page's number.
    """
    if page is None:
        page = F.floor(F.col("id").cast("bigint") / PAGE_ROWS)
    (
        (rows if paged is None else paged)
        .groupBy(page.alias("page"))
        .agg(F.collect_list(F.struct(*rows.columns)).alias("results"))
        .select(F.to_json(F.struct("results")).alias("value"))
        .write.mode("append")
        .text(path)
    )


@query
def json_pages(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "pages")
    land_pages(t, t.raw_soil(), path)
    rows = bronze.soil_from_records(read_pages(t.spark, path))
    return bronze.accepted(rows, "event_time").select(*SOIL)


@query
def landed_pages(t: Tables) -> DataFrame:
    """Readings of the second half of the month from the paged data source, which knows the bounds."""
    path = scratch_path(t.spark, "pages")
    land_pages(t, t.raw_soil(), path)
    some = read_landed(t.spark, path, f"{MIDDLE.isoformat()}+00:00", "2024-02-01", 256 << 10)
    # The source runs in Python; what follows does not.
    read = stored(some, "landed-rows")
    return bronze.accepted(bronze.soil_from_records(read), "event_time").select(*SOIL)


def raw_deliveries(t: Tables) -> tuple[DataFrame, DataFrame]:
    raw = t.raw_soil()
    time = F.col("local_time")
    return (
        raw.filter(time < F.lit(f"{MIDDLE.isoformat()}+00:00")),
        raw.filter(time >= F.lit(f"{SECOND_FROM.isoformat()}+00:00")),
    )


@query
def append_absent_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "bronze")
    for part in raw_deliveries(t):
        rows = bronze.soil_from_raw(part, OFFSET_PATTERN)
        append_absent(bronze.accepted(rows, "event_time"), path, ["ID"], ["event_time"])
    return read_table(t.spark, path).select(*SOIL)


@query
def append_absent_buckets(t: Tables) -> DataFrame:
    """Two overlapping deliveries into a table that is partitioned by a hash of the id."""
    path = scratch_path(t.spark, "bronze")
    for part in _deliveries(t):
        append_absent(part, path, ["ID"], ["event_time"], buckets=16)
    return read_table(t.spark, path).select(*SOIL)


@query
def replaced_partitions(t: Tables) -> DataFrame:
    """A versioned table of all readings, of which the days of the second half are then replaced."""
    path = scratch_path(t.spark, "versions")
    rows = t.bronze_soil().select(*SOIL).withColumn("event_day", F.to_date("event_time"))
    replace_table(rows, path, ("event_day",))
    later = read_table(t.spark, path).filter(F.col("event_day") >= F.lit(MIDDLE.date()))
    replace_partitions(later.withColumn("Unit", F.lit("new")), path, ("event_day",))
    return read_table(t.spark, path).select(*SOIL)


@query
def stream_dedup(t: Tables) -> DataFrame:
    landing = scratch_path(t.spark, "landing")
    table = scratch_path(t.spark, "bronze")
    checkpoint = scratch_path(t.spark, "checkpoint")
    for part in raw_deliveries(t):
        land_pages(t, part, landing)
        ingest_pages(t.spark, landing, table, checkpoint).awaitTermination()
    return read_table(t.spark, table).select(*SOIL)


@query
def stream_hourly(t: Tables) -> DataFrame:
    source, table = scratch_path(t.spark, "silver"), scratch_path(t.spark, "hourly")
    write_table(t.silver_soil(), source)
    stream = t.spark.readStream.schema(read_table(t.spark, source).schema).parquet(source)
    for running in keep_hourly(stream, t.settings, table, scratch_path(t.spark, "checkpoint")):
        running.awaitTermination()
    return read_hourly(t.spark, table)


# Ingest steps of the pipeline, with everything that can be wrong about their input


def _pipeline(t: Tables) -> Pipeline:
    return Pipeline(t.spark, Lake(scratch_path(t.spark, "lake")), t.settings)


def _bronze(t: Tables, pipeline: Pipeline) -> DataFrame:
    return read_table(t.spark, pipeline.lake.path("bronze", "soil_readings")).select(*SOIL)


def _faulty(t: Tables) -> DataFrame:
    """Raw readings of which some have no id and some no readable time."""
    number = F.col("id").cast("bigint")
    return (
        t.raw_soil()
        .withColumn("page", F.floor(number / PAGE_ROWS))
        .withColumn("local_time", F.when(number % 50 == 7, "soon").otherwise(F.col("local_time")))
        .withColumn("id", F.when(number % 50 != 13, F.col("id")))
    )


@query
def ingest_rejects(t: Tables) -> DataFrame:
    """What the page step sets aside, with the reason."""
    pipeline, landing = _pipeline(t), scratch_path(t.spark, "landing")
    rows = _faulty(t)
    land_pages(t, rows.drop("page"), landing, F.col("page"), rows)
    pipeline.ingest_soil_pages(landing)
    aside = read_table(t.spark, rejects_path(pipeline.lake.path("bronze", "soil_readings")))
    fields = ("id", "local_time", "site_id", "probe_measure", "soil_value")
    parts = [F.get_json_object("record", f"$.{name}").alias(name) for name in fields]
    return aside.select("reason", *parts).withColumn("soil_value", F.col("soil_value").cast("double"))


@query
def json_pages_mixed(t: Tables) -> DataFrame:
    """Pages on single lines and pages over whole files, some cut off, some records without an id."""
    pipeline, landing = _pipeline(t), scratch_path(t.spark, "landing")
    rows = _faulty(t)
    odd = F.coalesce(F.col("page") % 2 == 1, F.lit(False))
    lines, wholes = rows.filter(~odd), rows.filter(odd)
    land_pages(t, lines.drop("page"), landing, F.col("page"), lines)
    columns = [c for c in rows.columns if c != "page"]
    # A file's page holds more records than a line's, as each file costs time of its own; one row goes
    # to a file, without a folder for each.
    page = wholes.groupBy(
        F.floor(F.col("page") / FILE_PAGES).alias("file"), (F.col("page") % 10 == 9).alias("cut")
    ).agg(F.collect_list(F.struct(*columns)).alias("results"))
    text = F.to_json(F.struct("results"), {"pretty": "true"}).alias("value")
    cut = F.when(F.col("cut"), F.expr("substring(value, 1, length(value) - 5)"))
    (
        page.select("cut", text)
        .select(F.coalesce(cut, F.col("value")).alias("value"))
        .write.mode("append")
        .option("maxRecordsPerFile", 1)
        .text(landing)
    )
    pipeline.ingest_soil_pages(landing)
    return _bronze(t, pipeline)


@query
def ingest_pages_batch(t: Tables) -> DataFrame:
    """The later delivery lands first: rows far behind the table's last time are taken in as well."""
    pipeline = _pipeline(t)
    for part in reversed(raw_deliveries(t)):
        landing = scratch_path(t.spark, "landing")
        land_pages(t, part, landing)
        pipeline.ingest_soil_pages(landing)
    return _bronze(t, pipeline)


@query
def bronze_mixed_ids(t: Tables) -> DataFrame:
    """A historical file with numbers as ids, then pages with text, in one table."""
    pipeline = _pipeline(t)
    first, second = raw_deliveries(t)
    history, landing = scratch_path(t.spark, "history"), scratch_path(t.spark, "landing")
    numbers = {c: F.col(c).cast("bigint") for c in ("id", "site_id", "probe_id")}
    first.withColumns(numbers).drop("json_featuretype").write.parquet(history)
    pipeline.ingest_soil(history)
    land_pages(t, second, landing)
    pipeline.ingest_soil_pages(landing)
    return _bronze(t, pipeline)


@query
def database_rows(t: Tables) -> DataFrame:
    """Readings as a database takes them: times without a zone, NULL in place of NaN."""
    value = F.when(F.col("ID").cast("bigint") % 10 == 0, F.lit(float("nan"))).otherwise(
        F.col("Soil_Value")
    )
    instant = F.col("event_time").cast("timestamp")
    rows = t.bronze_soil().select("ID", value.alias("Soil_Value"), instant.alias("event_time"))
    return for_database(rows)


@query
def gold_daily_incremental(t: Tables) -> DataFrame:
    """Gold of half of the readings, brought up to date with the days of the other half."""
    pipeline = _pipeline(t)
    first, second = _deliveries(t)
    layers = {"silver": "soil_readings", "gold": "daily_site_summary"}
    silver_path, gold_path = [pipeline.lake.path(*item) for item in layers.items()]
    weather = conform(t.silver_weather(), SILVER_WEATHER)
    write_table(weather, pipeline.lake.path("silver", "weather_daily"))

    def refresh(bronze_rows: DataFrame) -> None:
        rows = silver.silver_soil(bronze_rows, t.settings)
        write_table(conform(rows, SILVER_SOIL), silver_path, partition_by=("measure_type",))

    refresh(first)
    pipeline.gold_daily()
    refresh(keyed.insert_if_absent(first, second, ["ID"], ["event_time"]))
    days = second.select(F.to_date("event_time").alias("date")).distinct()
    pipeline.gold_daily_days(days, gold_path)
    return read_table(t.spark, gold_path).drop("transformed_at")


@query
def silver_weather_repeated_days(t: Tables) -> DataFrame:
    """One value per order instead of one per day: many readings share a date in every feed."""
    feeds = []
    for feed, value in WEATHER_VALUE.items():
        orders = t.read("orders").filter(F.col("o_orderpriority").isin(*FEED_PRIORITIES[feed]))
        day = F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS)
        reading = F.when(F.col("o_custkey") % 7 != 0, (F.col("o_custkey") % 80).cast("double"))
        feeds.append(orders.select(day.alias("date"), reading.alias(value)))
    return silver.silver_weather(*feeds, t.settings)


@query
def sites_csv_repeated(t: Tables) -> DataFrame:
    """Two site lists that share ids; the row in the file that comes first by name counts."""
    path = scratch_path(t.spark, "csv-sites")
    again = t.raw_sites().withColumn("site_name", F.concat(F.lit("A much longer name of "), "site_name"))
    other = again.withColumn("site_id", F.col("site_id") + 1_000_000)
    t.raw_sites().write.option("header", True).csv(f"{path}/a")
    again.unionByName(other).write.option("header", True).csv(f"{path}/b")
    return bronze.sites_dimension(read_sites_csv(t.spark, [f"{path}/a", f"{path}/b"]))

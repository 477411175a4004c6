from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loamline.demo.catalog import land_pages, raw_deliveries
from loamline.plans.gold import gold_hourly
from loamline.streaming.ingest import first_seen, ingest_pages
from loamline.streaming.rollup import (
    append_closed_hours,
    hourly_stream,
    keep_hourly,
    late_rows,
    read_hourly,
)
from tests.conftest import same_rows

COLUMNS = ["ID", "Site_ID", "Probe_Measure", "Soil_Value"]


def test_ingest_is_idempotent_and_keeps_late_rows(spark, tables, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "bronze")
    early, late = raw_deliveries(tables)

    def run(checkpoint):
        query = ingest_pages(spark, landing, table, str(tmp_path / checkpoint), files_per_batch=2)
        query.awaitTermination()
        return spark.read.parquet(table)

    land_pages(tables, late, landing)  # the newer readings arrive first
    run("c1")
    land_pages(tables, early, landing)
    expected = tables.bronze_soil().select(*COLUMNS)
    assert same_rows(expected, run("c1").select(*COLUMNS))
    assert same_rows(expected, run("c1").select(*COLUMNS))  # nothing new
    assert same_rows(expected, run("c2").select(*COLUMNS))  # everything again, checkpoint lost


def test_first_seen(spark, tmp_path):
    rows = [("1", 0), ("1", 60), ("2", 30)]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, "ID string, s long").select(
        "ID", F.timestamp_seconds("s").alias("event_time")
    ).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("ID string, event_time timestamp").parquet(path)
    out = str(tmp_path / "out")
    first_seen(stream).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.ID for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_closed_hours_equal_the_batch_summary(spark, tables, settings, tmp_path):
    source, out = str(tmp_path / "silver"), str(tmp_path / "hours")
    tables.silver_soil().write.parquet(source)
    stored = spark.read.parquet(source)
    stream = spark.readStream.schema(stored.schema).parquet(source)
    append_closed_hours(hourly_stream(stream, settings), out, str(tmp_path / "c")).awaitTermination()
    last = stored.agg(F.max("event_time")).first()[0]
    batch = gold_hourly(stored, settings).drop("soil_texture")
    closed = batch.filter(F.col("hour") + F.expr("interval 1 hour") <= F.lit(last - timedelta(minutes=2)))

    def rounded(df):
        df = df.withColumn("hour", F.col("hour").cast("timestamp"))
        return df.select(*[F.round(c, 6).alias(c) if k == "double" else c for c, k in df.dtypes])

    assert 0 < closed.count() < batch.count()
    assert same_rows(rounded(closed), rounded(spark.read.parquet(out)))


def test_a_late_earlier_texture_corrects_written_hours(spark, settings, tmp_path):
    source, table, checkpoint = [str(tmp_path / n) for n in ("silver", "hourly", "check")]
    schema = (
        "site_name string, site_id string, event_time timestamp, depth_cm int, measure_type string, "
        "soil_texture string, soil_value double, reading_count long"
    )
    day = datetime(2024, 5, 1)

    def land(*rows):
        full = [(s, s, day + timedelta(hours=h), d, "Moisture", x, v, 1) for s, h, d, x, v in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.mode("append").parquet(source)
        queries = keep_hourly(spark.readStream.schema(schema).parquet(source), settings, table, checkpoint)
        for query in queries:
            query.awaitTermination()
        return queries, {(r.site_id, r.hour.hour): (r.soil_texture, r.moisture_10cm, r.moisture_20cm)
                         for r in read_hourly(spark, table).collect()}

    _, hours = land(("a", 8, 10, "Clay", 20.0), ("a", 9, 20, None, 30.0), ("b", 8, 20, "Loam", 5.0))
    assert hours == {("a", 8): ("Clay", 20.0, None), ("a", 9): ("Clay", None, 30.0), ("b", 8): (None, None, 5.0)}
    _, hours = land(("a", 12, 20, None, 31.0), ("c", 20, 10, "Sand", 1.0))
    assert hours[("a", 12)] == ("Clay", None, 31.0) and hours[("c", 20)] == ("Sand", 1.0, None)
    # Far behind the watermark: the hour itself is dropped, its texture is not.
    queries, hours = land(("a", 2, 10, "Loam", 40.0), ("b", 23, 20, None, 6.0))
    assert late_rows(queries[0]) == 1 and ("a", 2) not in hours
    assert {k: v[0] for k, v in hours.items()} == {
        ("a", 8): "Loam", ("a", 9): "Loam", ("a", 12): "Loam", ("b", 8): None, ("b", 23): None, ("c", 20): "Sand",
    }
    # A later texture, and the same delivery once more, change nothing.
    _, hours = land(("a", 23, 10, "Gravel", 41.0))
    assert hours[("a", 8)][0] == hours[("a", 23)][0] == "Loam"


def test_streamed_hours_equal_the_batch_over_several_batches(spark, tables, settings, tmp_path):
    source, table = str(tmp_path / "silver"), str(tmp_path / "hourly")
    silver = tables.silver_soil().withColumn("event_time", F.col("event_time").cast("timestamp"))
    silver.repartitionByRange(6, "event_time").sortWithinPartitions("event_time").write.parquet(source)
    stream = spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 2).parquet(source)
    for query in keep_hourly(stream, settings, table, str(tmp_path / "check"), late_by="60 days"):
        query.awaitTermination()
        assert len(query.recentProgress) > 1

    def rounded(df):
        return df.select(*[F.round(c, 6).alias(c) if k == "double" else c for c, k in df.dtypes])

    batch = gold_hourly(spark.read.parquet(source), settings)
    streamed = read_hourly(spark, table)
    assert set(streamed.columns) == set(batch.columns)
    assert same_rows(rounded(batch), rounded(streamed))

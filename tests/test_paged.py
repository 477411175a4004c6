"""Landed pages as a data source, pages of a sorted table, and the last time of a stored one."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loamline.sinks import replace_table, write_table
from loamline.sources import (
    all_pages,
    numbered_rows,
    page_of,
    read_landed,
    read_pages,
    read_table,
    stored_high_water_mark,
    stream_landed,
)
from loamline.sources.paged import PageRange, lines_in, opened
from tests.conftest import plan_of, same_rows


def land(folder, name, pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(p if isinstance(p, str) else json.dumps(p, ensure_ascii=False) + "\n" for p in pages))


def page(n, rows=10):
    stamp = f"2024-01-{n % 28 + 1:02d}T00:00:00+00:00"
    return {"results": [{"id": n * 100 + i, "local_time": stamp, "site_name": f"né {i}", "soil_value": i / 4} for i in range(rows)]}


@pytest.mark.parametrize("size", [1, 97, 700, 1 << 20])
def test_pages_are_read_whole_by_any_ranges(spark, tmp_path, size):
    folder = tmp_path / "pages"
    land(folder, "a.json", [page(n) for n in range(4)] + ["{broken\n", "\n", "[1]\n", '{"results": 7}\n'])
    land(folder, "b.json", [page(9), json.dumps(page(10))])
    land(folder, "_hidden.json", [page(11)])
    (folder / "empty.json").write_text("")
    text = (folder / "a.json").read_bytes()
    parts = [PageRange(str(folder / "a.json"), at, min(at + size, len(text))) for at in range(0, len(text), size)]
    system = opened(str(folder))[0]
    if size > 1:
        lines = [line for part in parts for line in lines_in(system, part)]
        assert b"".join(lines) == text
        got = read_landed(spark, str(folder), page_bytes=size)
        assert got.rdd.getNumPartitions() >= 2
        wanted = read_pages(spark, [str(folder / "a.json"), str(folder / "b.json")])
        assert same_rows(wanted.select(got.columns), got)
    else:
        starts = [0] + [i + 1 for i, b in enumerate(text[:-1]) if b == 10]
        assert [p.start for p in parts if list(lines_in(system, p))] == starts


def test_bounds_of_time_are_the_sources_own(spark, tmp_path):
    folder = tmp_path / "pages"
    land(folder, "a.json", [page(n) for n in range(20)] + [{"results": [{"id": 1}]}])
    rows = read_landed(spark, f"file:{folder}", page_bytes=2000)
    some = read_landed(spark, str(folder), "2024-01-05", "2024-01-07", 2000)
    assert some.count() == 20 and some.filter("id != '401'").count() == 19
    assert read_landed(spark, str(folder), start="2024-01-20").count() == 10
    assert read_landed(spark, str(folder), end="2024-01-02").count() == 10
    # Filters of one query leave others alone.
    assert rows.filter("local_time >= '2024-01-05' AND local_time < '2024-01-07'").count() == 20
    assert rows.count() == 201 and rows.filter("local_time IS NULL").count() == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, out, check = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        query = (
            stream_landed(spark, str(folder), page_bytes=500).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", check).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.read.parquet(out).count()

    land(folder, "b.json", [page(1), page(2)])
    assert run() == 20 == run()
    land(folder, "a.json", [page(3)])
    assert run() == 30
    assert spark.read.parquet(out).select("id").distinct().count() == 30


def test_all_pages_equal_each_page(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1, 2, 3, 50]), rng.random()) for i in range(1234)]
    df = spark.createDataFrame(rows, "id int, v int, w double").repartition(5)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    pages = all_pages(df, order, 100)
    got = pages.collect()
    assert len(got) == 1234 and {r.page for r in got} == set(range(13))
    for n in (0, 2, 12):
        assert {r.id for r in got if r.page == n} == {r.id for r in page_of(df, order, 100, n * 100).collect()}
    numbered = numbered_rows(df, order).orderBy(*order).collect()
    assert [r.row_number for r in numbered] == list(range(1234))
    assert numbered_rows(df.limit(0), order).count() == 0
    plan = plan_of(pages)
    # The only window sorts one row for each range.
    assert plan.split("Initial Plan")[0].count("Window [") == 1 and "rangepartitioning" not in plan


def test_last_time_comes_from_the_newest_day(spark, tmp_path, monkeypatch):
    from loamline.sources import incremental

    read = []
    mark = incremental.high_water_mark

    def counted(df, time="event_time"):
        read.append(df)
        return mark(df, time)

    monkeypatch.setattr(incremental, "high_water_mark", counted)
    start = datetime(2024, 3, 1)
    rows = [(i, start + timedelta(hours=7 * i), (start + timedelta(hours=7 * i)).date()) for i in range(40)]
    schema = "id int, event_time timestamp, event_day date"
    df = spark.createDataFrame(rows, schema)
    for write, name in ((write_table, "plain"), (replace_table, "versions")):
        path = str(tmp_path / name)
        write(df, path, partition_by=("event_day",))
        read.clear()
        assert stored_high_water_mark(spark, path) == rows[-1][1]
        assert len(read) == 1 and "PartitionFilters: [isnotnull(event_day" in plan_of(read[0])
        # A newer day without a single time, and rows without a day.
        odd = spark.createDataFrame([(1, None, date(2024, 6, 1)), (2, None, None)], schema)
        write(df.unionByName(odd), path, partition_by=("event_day",))
        read.clear()
        assert stored_high_water_mark(spark, path) == rows[-1][1] and len(read) == 2
        write(odd, path, partition_by=("event_day",))
        assert stored_high_water_mark(spark, path) is None
    assert stored_high_water_mark(spark, str(tmp_path / "nothing")) is None
    flat = str(tmp_path / "flat")
    write_table(df.drop("event_day"), flat)
    assert stored_high_water_mark(spark, flat) == rows[-1][1]
    write_table(df.limit(0), flat)
    assert stored_high_water_mark(spark, flat) is None
    assert read_table(spark, flat).count() == 0

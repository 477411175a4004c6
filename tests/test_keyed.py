from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loamline.operators import calendar, counts, keyed, sets
from loamline.plans import replay
from loamline.sinks import append_absent
from loamline.sources import high_water_mark, incremental_slice, range_slice
from tests.conftest import plan_of, same_rows

T0 = datetime(2024, 1, 1)
SCHEMA = "ID string, event_time timestamp, v double"


def rows(*items):
    return [(i, T0 + timedelta(minutes=m), v) for i, m, v in items]


@pytest.fixture
def old(spark):
    return spark.createDataFrame(rows(("1", 0, 1.0), ("2", 1, 2.0)), SCHEMA)


def test_insert_if_absent(spark, old):
    new = spark.createDataFrame(
        rows(("2", 1, 99.0), ("3", 5, 3.5), ("3", 4, 3.0), ("4", 6, None)) + [(None, T0, 1.0)], SCHEMA
    )
    out = {r.ID: r.v for r in keyed.insert_if_absent(old, new, ["ID"], ["event_time"]).collect()}
    # known ids stay as they are, of two new copies the earlier one counts, no id means no row
    assert out == {"1": 1.0, "2": 2.0, "3": 3.0, "4": None}


def test_many_copies_of_one_key(spark, old):
    copies = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("ID"),
        F.timestamp_seconds("id").alias("event_time"),
        F.col("id").cast("double").alias("v"),
    )
    out = keyed.absent_rows(copies, old, ["ID"], ["event_time"])
    assert out.filter("ID = 'hot'").collect()[0].v == 0.0
    assert out.count() == 20000 - 6667 + 1 - 2  # one row for the hot key, "1" and "2" are known
    assert out.select("ID").distinct().count() == out.count()


def test_table_is_not_shuffled_for_a_small_batch(spark, old, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).select(
        F.col("id").cast("string").alias("ID"), F.lit(T0).alias("event_time"), F.lit(1.0).alias("v")
    ).write.parquet(path)
    out = keyed.absent_rows(old, spark.read.parquet(path), ["ID"])
    out.collect()
    plan = plan_of(out).split("Initial Plan")[0]
    assert "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
    assert "ReadSchema: struct<ID:string>" in plan


def test_append_is_idempotent(spark, old, tmp_path):
    path = str(tmp_path / "bronze")
    assert append_absent(old, path, ["ID"], stamps=("ingested_at",)) == (2, 0)
    assert append_absent(old, path, ["ID"], stamps=("ingested_at",)) == (0, 0)
    more = spark.createDataFrame(rows(("2", 1, 2.0), ("9", 9, 9.0)), SCHEMA)
    assert append_absent(more, path, ["ID"], stamps=("ingested_at",)) == (1, 0)
    assert spark.read.parquet(path).count() == 3


def test_delete_and_lookup(spark, old):
    keys = spark.createDataFrame([("2",), ("7",)], "ID string")
    assert [r.ID for r in keyed.delete_keys(old, keys, ["ID"]).collect()] == ["1"]
    assert [r.ID for r in keyed.matching_rows(old, keys, ["ID"]).collect()] == ["2"]


def test_difference_counts_copies(spark, old):
    assert keyed.difference(old, old).count() == 0
    doubled = old.unionByName(old.filter("ID = '1'"))
    assert [(r.ID, r.side, r.copies) for r in keyed.difference(old, doubled).collect()] == [
        ("1", "right", 1)
    ]
    tripled = doubled.unionByName(old.filter("ID = '1'"))
    assert [(r.side, r.copies) for r in keyed.difference(tripled, old).collect()] == [("left", 2)]


def test_difference_looks_into_unequal_buckets_only(spark, tmp_path):
    path, other = str(tmp_path / "a"), str(tmp_path / "b")
    whole = spark.range(20000).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("t"),
        F.when(F.col("id") % 5 != 0, F.col("id") / 3).alias("v"),
    )
    whole.write.parquet(path)
    changed = whole.withColumn("v", F.when(F.col("id") == 17, -1.0).otherwise(F.col("v"))).filter("id != 40")
    changed.write.parquet(other)
    left, right = spark.read.parquet(path), spark.read.parquet(other)
    assert keyed.unequal_buckets(left, right, 4096).count() == 3
    found = keyed.difference(left, right)
    assert sorted((r.id, r.side, r.copies) for r in found.collect()) == [
        (17, "left", 1), (17, "right", 1), (40, "left", 1),
    ]
    plan = plan_of(found).split("Initial Plan")[0]
    assert plan.count("FileScan") == 4 and "BroadcastHashJoin" in plan
    assert keyed.difference(left, left.orderBy(F.desc("id"))).count() == 0


def test_difference_tells_null_places_zeros_and_nan(spark):
    schema = "a string, b string, v double"
    left = spark.createDataFrame([("x", None, 0.0), (None, "y", float("nan"))], schema)
    same = spark.createDataFrame([(None, "y", float("nan")), ("x", None, -0.0)], schema)
    assert keyed.difference(left, same).count() == 0
    moved = spark.createDataFrame([(None, "x", 0.0), (None, "y", float("nan"))], schema)
    assert {(r.a, r.b, r.side) for r in keyed.difference(left, moved).collect()} == {
        ("x", None, "left"), (None, "x", "right"),
    }


def test_replay_reads_the_table_twice(spark, tables, settings, tmp_path, monkeypatch):
    path = str(tmp_path / "soil")
    tables.bronze_soil().write.parquet(path)
    soil, source = spark.read.parquet(path), spark.read.parquet(path)
    scans = []
    ids = replay.last_ids

    def counted(table, n):
        scans.append(plan_of(replay.last_by_id(table.select("ID"), n)).count(path))
        return ids(table, n)

    monkeypatch.setattr(replay, "last_ids", counted)
    result = replay.replay_difference(source, soil, settings)
    assert scans == [1] and result.collect() == [(0, 0)]
    assert path not in plan_of(result).replace("replay", "")
    gone = source.filter("ID != (SELECT max(cast(ID AS bigint)) FROM parquet.`%s`)" % path)
    assert [tuple(r) for r in replay.replay_difference(gone, soil, settings).collect()] == [(1, 0)]


def test_high_water_mark_and_slice(spark, old, settings):
    assert high_water_mark(old).first()[0] == T0 + timedelta(minutes=1)
    empty = old.filter("false")
    assert high_water_mark(empty).first()[0] is None
    source = spark.createDataFrame(
        [("a", T0 - timedelta(minutes=1), 0.0), ("b", T0 - timedelta(minutes=2), 0.0),
         ("c", datetime(2022, 1, 1), 0.0)],
        SCHEMA,
    )
    assert {r.ID for r in incremental_slice(source, old, settings).collect()} == {"a"}
    for nothing in (empty, None):
        assert {r.ID for r in incremental_slice(source, nothing, settings).collect()} == {"a", "b"}


def test_range_slice_is_half_open_and_pushed_down(spark, old, tmp_path):
    out = range_slice(old, T0, T0 + timedelta(minutes=1))
    assert [r.ID for r in out.collect()] == ["1"]
    path = str(tmp_path / "t")
    old.write.parquet(path)
    plan = plan_of(range_slice(spark.read.parquet(path), T0, T0 + timedelta(minutes=1)))
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan


def test_replay_restores_the_table(tables, settings):
    soil = tables.bronze_soil()
    lost = keyed.delete_keys(soil, replay.last_by_id(soil), ["ID"])
    assert lost.count() == soil.count() - 10
    assert same_rows(soil, replay.replay(soil, soil, settings))


def test_time_chunks(spark, settings):
    def chunks(end):
        return [tuple(r) for r in calendar.time_chunks(spark, T0, end, settings).collect()]

    half = timedelta(hours=12)
    assert chunks(T0 + timedelta(hours=30)) == [
        (T0, T0 + half), (T0 + half, T0 + 2 * half), (T0 + 2 * half, T0 + timedelta(hours=30)),
    ]
    assert chunks(T0 + half) == [(T0, T0 + half)]
    assert chunks(T0) == [] and chunks(T0 - half) == []


def test_calendar(spark):
    df = spark.createDataFrame([("2024-01-30",), ("2024-02-02",), ("2024-05-01",), (None,)], "d string")
    df = df.select(F.to_date("d").alias("date"), F.to_timestamp("d").alias("t"))
    assert calendar.missing_dates(df).count() == 90
    months = {str(r.month_end): r.n for r in calendar.rows_per_month(df, "t").collect()}
    assert months == {
        "2024-01-31": 1, "2024-02-29": 1, "2024-03-31": 0, "2024-04-30": 0, "2024-05-31": 1,
    }
    assert calendar.missing_dates(df.filter("false")).count() == 0
    assert calendar.rows_per_month(df.filter("false"), "t").count() == 0


def test_counts(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, None), ("a", 2, "y"), ("b", None, "x"), (None, None, "x")],
        "g string, n int, t string",
    )
    assert [tuple(r) for r in counts.value_counts(df, "t").collect()] == [("x", 3), ("y", 1)]
    assert [tuple(r) for r in counts.value_counts(df, "n", by_value=True).collect()] == [(1, 2), (2, 1)]
    assert {tuple(r) for r in counts.count_matrix(df, "g", "t", ["x", "z"]).collect()} == {
        ("a", 1, 0), ("b", 1, 0), (None, 1, 0),
    }
    assert [tuple(r) for r in counts.distinct_histogram(df, ["g"], "n").collect()] == [(0, 2), (2, 1)]
    extra = counts.duplicate_keys(df, ["g", "n"])
    assert [tuple(r) for r in extra.collect()] == [("a", 1, 1)]
    known = counts.distinct_per_group(df, ["g"], "t", "n", ["x", "z"])
    assert {tuple(r) for r in known.collect()} == {("a", 2), ("b", 1), (None, 1)}
    wide = spark.range(1000).select((F.col("id") % 2).alias("g"), (F.col("id") % 90 * 10).alias("d"))
    for few in ((), (10, 20, 30), tuple(range(0, 630, 10))):
        got = counts.distinct_per_group(wide, ["g"], "d", "n", few)
        assert {tuple(r) for r in got.collect()} == {(0, 45), (1, 45)}
        assert "Expand" not in plan_of(got)
    first = counts.first_known(df, ["g"], "t", "n")
    assert {tuple(r) for r in first.collect()} == {("a", "x"), ("b", "x"), (None, "x")}


def test_sets(spark):
    df = spark.createDataFrame([("s", "p#0"), ("s", "p"), ("t", "p"), ("u", "q#0")], "site string, p string")
    sides = {r.site: (r.has, r.lacks) for r in
             sets.side_by_predicate(df, "site", F.col("p").contains("#0")).collect()}
    assert sides == {"s": (True, True), "t": (False, True), "u": (True, False)}
    marked = sets.values_where(df, "site", F.col("p").contains("#0"))
    plain = sets.values_where(df, "site", ~F.col("p").contains("#0"))
    assert [r.site for r in sets.in_both(marked, plain).collect()] == ["s"]
    assert [r.site for r in sets.only_left(plain, marked).collect()] == ["t"]

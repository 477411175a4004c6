"""Tables that are replaced as a whole, and tables in key buckets."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loamline import storage, versions
from loamline.sinks import append_absent, in_buckets, pruned, replace_partitions, replace_table
from loamline.sources import read_if_exists, read_table
from tests.conftest import plan_of, same_rows


def rows(spark, n, word="a", start=0):
    return spark.range(start, start + n).select("id", (F.col("id") % 3).alias("part"), F.lit(word).alias("word"))


def failing(df):
    """The rows, of which the last ones cannot be computed."""
    return df.withColumn("word", F.when(F.col("id") < 90, F.col("word")).otherwise(F.raise_error(F.lit("lost"))))


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    old = rows(spark, 100, "old")
    assert replace_table(old, path, partition_by) == 100
    for write in (replace_table, versions.append_version):
        with pytest.raises(Exception, match="lost"):
            write(failing(rows(spark, 100, "new")).repartition(8), path, partition_by)
        assert same_rows(old, read_table(spark, path))
    # What a driver leaves that was lost before it could clean up is no part of the table.
    rows(spark, 30, "lost").write.parquet(f"{path}/version=0000000002-lost")
    assert same_rows(old, read_table(spark, path))
    assert replace_table(rows(spark, 50, "new"), path, partition_by) == 50
    assert replace_table(rows(spark, 20, "newer"), path, partition_by) == 20
    assert same_rows(rows(spark, 20, "newer"), read_table(spark, path))
    assert len([n for n in storage.names_in(spark, path) if n.startswith("version=")]) == 2


def test_a_reader_sees_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(rows(spark, 10, "one"), path)
    reader = read_table(spark, path)
    replace_table(rows(spark, 30, "two"), path)
    assert same_rows(rows(spark, 10, "one"), reader) and read_table(spark, path).count() == 30
    # The job that replaces a table may read it.
    replace_table(read_table(spark, path).unionByName(rows(spark, 1, "three", 99)), path)
    assert read_table(spark, path).count() == 31
    assert versions.read_version(spark, path, commit=2).count() == 30
    assert versions.commits(spark, path) == [2, 3]


def test_partitions_are_replaced_in_one_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(rows(spark, 90), path, ("part",))
    new = rows(spark, 6, "b").filter("part != 0")
    assert replace_partitions(new, path, ("part",)) == 4
    assert same_rows(rows(spark, 90).filter("part = 0").unionByName(new), read_table(spark, path))
    one = read_table(spark, path).filter("part = 1")
    assert "PartitionFilters: [isnotnull(part" in plan_of(one)
    # Of the first version one partition is still part of the table, however many commits follow.
    for word in "cdef":
        replace_partitions(rows(spark, 6, word).filter("part = 2"), path, ("part",))
    got = read_table(spark, path)
    assert got.filter("part = 0").count() == 30 and got.filter("word = 'f'").count() == 2 == got.filter("part = 2").count()
    assert versions.append_version(rows(spark, 3, "g"), path, ("part",)) == 3
    assert read_table(spark, path).count() == got.count() + 3


def test_two_writers_cannot_make_the_same_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_table(rows(spark, 5), path)
    known = versions.commits
    calls = []

    def stale(session, place):
        calls.append(place)
        # What this writer saw before the other one committed.
        return [1] if len(calls) == 1 else known(session, place)

    replace_table(rows(spark, 7), path)
    monkeypatch.setattr(versions, "commits", stale)
    with pytest.raises(versions.CommitConflict):
        replace_table(rows(spark, 9), path)
    monkeypatch.undo()
    assert read_table(spark, path).count() == 7


def test_missing_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_if_exists(spark, path) is None and not versions.is_versioned(spark, path)
    with pytest.raises(AnalysisException):
        versions.read_version(spark, path)
    for partition_by in ((), ("part",)):
        assert replace_table(rows(spark, 0), path, partition_by) == 0
        assert read_table(spark, path).columns == ["id", "part", "word"] and read_if_exists(spark, path).count() == 0
    declared = rows(spark, 1).select("id").schema
    replace_table(rows(spark, 4), path)
    assert read_table(spark, path, declared).columns == ["id"]
    nulls = rows(spark, 4).withColumn("part", F.when(F.col("id") > 1, F.col("part")))
    replace_table(nulls, path, ("part",))
    assert same_rows(nulls, read_table(spark, path))


def test_small_batch_reads_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(2000).select(F.col("id").cast("string").alias("ID"), F.col("id").alias("v"))
    assert append_absent(old, path, ["ID"], buckets=64) == (2000, 0)
    new = spark.createDataFrame([("3", 0), ("x", 1), ("x", 2), (None, 3)], "ID string, v bigint")
    batch = in_buckets(new.filter("ID IS NOT NULL"), ["ID"], 64)
    existing = pruned(read_table(spark, path), batch, "key_bucket_64")
    plan = plan_of(existing)
    assert "PartitionFilters: [key_bucket_64" in plan and "PushedFilters: []" in plan
    assert existing.select("key_bucket_64").distinct().count() <= 2
    assert append_absent(new, path, ["ID"], ["v"], buckets=64) == (1, 1)
    assert append_absent(new, path, ["ID"], ["v"], buckets=64).added == 0
    stored = read_table(spark, path)
    assert stored.count() == 2001 and stored.filter("ID = 'x'").first().v == 1
    with pytest.raises(ValueError, match="key_bucket_8"):
        append_absent(new, path, ["ID"], buckets=8)
    with pytest.raises(ValueError, match="not by both"):
        append_absent(new, path, ["ID"], buckets=8, day="v")


def test_versions_take_keyed_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("1", 1), ("2", 2)], "ID string, v int")
    replace_table(in_buckets(old, ["ID"], 4), path, ("key_bucket_4",))
    more = spark.createDataFrame([("2", 9), ("3", 3)], "ID string, v int")
    assert append_absent(more, path, ["ID"], buckets=4) == (1, 0)
    assert {(r.ID, r.v) for r in read_table(spark, path).collect()} == {("1", 1), ("2", 2), ("3", 3)}
    assert versions.commits(spark, path) == [1, 2]

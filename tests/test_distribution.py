"""Exact statistics and gaps against a brute-force pandas computation."""

import math
import random
import struct

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loamline.functions import ordered_bits
from loamline.operators.distribution import describe
from loamline.operators.series import gap_counts
from tests.conftest import plan_of

CASES = {
    "one group holds most rows": [("hot", random.Random(1).gauss(20, 5)) for _ in range(4000)]
    + [("cold", float(i)) for i in range(7)],
    "ties": [("a", float(i % 3)) for i in range(1000)],
    "constant": [("a", 4.5)] * 50,
    "single and pair": [("a", 1.0), ("b", 1.0), ("b", 2.0)],
    "missing values": [("a", None), ("a", float("nan")), ("a", 3.0), ("b", None), (None, 7.0)],
    "outliers": [("a", 10.0**i) for i in range(-6, 12)] + [("a", -1e15), ("a", 3e15)],
    "random": [
        (g, v)
        for rng in [random.Random(7)]
        for _ in range(3000)
        for g in [rng.choice("abc")]
        for v in [rng.choice([rng.uniform(-5, 5), float(rng.randint(0, 4)), None])]
    ],
}
ROWS = [(None if g is None else f"{case}: {g}", v) for case, rows in CASES.items() for g, v in rows]


def expected(rows):
    frame = pd.DataFrame(rows, columns=["g", "v"])
    out = {}
    for group, part in frame.groupby("g", dropna=False):
        d = part["v"].astype(float).describe()
        key = None if pd.isna(group) else group
        out[key] = [d[c] for c in ("count", "mean", "std", "min", "25%", "50%", "75%", "max")]
    return out


def close(a, b):
    if a is None or b is None or math.isnan(b):
        return a is None and (b is None or math.isnan(b))
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("few_groups", [True, False])
def test_describe(spark, few_groups):
    df = spark.createDataFrame(ROWS, "g string, v double").repartition(5)
    want = expected(ROWS)
    got = {r[0]: list(r)[1:] for r in describe(df, ["g"], "v", few_groups=few_groups).collect()}
    assert got.keys() == want.keys()
    for group, values in want.items():
        assert all(close(a, b) for a, b in zip(got[group], values)), (group, got[group], values)


def test_describe_without_broadcast(spark):
    """The way taken when the statistics of the groups are too large to broadcast."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        test_describe(spark, False)
    finally:
        for key in limits:
            spark.conf.unset(key)


def test_weights_and_counts(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 2), ("a", 9.0, 1), ("a", None, 4)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    counts = {"nulls": lambda v: v.isNull(), "large": lambda v: v > 4}
    row = describe(df, ["g"], "v", weight="n", counts=counts).first()
    plain = pd.Series([1.0] * 3 + [5.0] * 2 + [9.0]).describe()
    got = [row[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
    assert all(close(a, b) for a, b in zip(got, plain))
    assert (row.nulls, row.large) == (4, 3)


def test_describe_scans_once(spark, tmp_path):
    path = str(tmp_path / "values")
    spark.createDataFrame(CASES["ties"], "g string, v double").write.parquet(path)
    result = describe(spark.read.parquet(path), ["g"], "v", few_groups=True)
    result.collect()
    assert plan_of(result).split("Initial Plan")[0].count("FileScan") == 1


def test_bits_follow_the_order_of_doubles(spark):
    rng = random.Random(11)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, math.inf, -math.inf]
    values += [1.7976931348623157e308, -1.7976931348623157e308]
    for e in (*range(-1074, 1024, 37), -1, 0, 1, 52, 53):
        two = math.ldexp(1.0, e)
        values += [two, math.nextafter(two, 0), math.nextafter(two, math.inf), -two, two * 1.1]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = df.select("v", ordered_bits(F.col("v")).alias("bits")).collect()
    for row in got:
        if row.v is None:
            assert row.bits is None
        else:
            stored = struct.unpack("<q", struct.pack("<d", abs(row.v)))[0]
            assert row.bits == (-stored if row.v < 0 else stored), row


def test_windows_are_bounded_whatever_the_number_of_values(spark):
    """Many different values close together: no window runs over more than one level's slices."""
    n = 300_000
    df = spark.range(n).select(F.lit("hot").alias("g"), (F.lit(20.0) + F.col("id") / 1e7).alias("v"))
    row = describe(df, ["g"], "v").first()
    want = [20.0 + (n - 1) * q / 1e7 for q in (0.25, 0.5, 0.75)]
    assert all(close(a, b) for a, b in zip((row.q25, row.q50, row.q75), want))
    bits = df.select(ordered_bits(F.col("v")).alias("b"))
    for level in range(1, 5):
        above, own = 64 - 16 * (level - 1), 64 - 16 * level
        parent = F.lit(0) if level == 1 else F.shiftright("b", above)
        sizes = bits.groupBy(parent.alias("p")).agg(F.count_distinct(F.shiftright("b", own)).alias("n"))
        assert sizes.agg(F.max("n")).first()[0] <= 1 << 16


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_gaps(spark, kind):
    rng = random.Random(3)
    rows = [
        ("hot" if rng.random() < 0.8 else "cold", rng.randrange(0, 3 * 86400, 60))
        for _ in range(2000)
    ] + [("lonely", 5), ("twice", 5), ("twice", 5), ("far", 0), ("far", 40 * 86400)]
    df = spark.createDataFrame(rows, "s string, at long").select(
        "s", F.timestamp_seconds("at").cast(kind).alias("event_time")
    )
    got = {(r.s, r.gap_seconds): r.n for r in gap_counts(df, ["s"]).collect()}
    want = {}
    frame = pd.DataFrame(rows, columns=["s", "at"]).sort_values(["s", "at"])
    for series, part in frame.groupby("s"):
        for gap, n in part["at"].diff().dropna().value_counts().items():
            want[(series, gap)] = n
    assert got == want

"""The silver quality gate: nine checks from counts by site and counts by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.config import MOISTURE, Settings
from loamline.functions import row_digest

# Columns that must exist and the key that must be unique.
REQUIRED = ("site_name", "site_id", "event_time", "depth_cm", "measure_type", "soil_value")
UNIQUE_KEY = ("site_id", "event_time", "depth_cm", "measure_type", "soil_texture")


class QualityError(ValueError):
    pass


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in REQUIRED if c not in df.columns]


def quality_report(silver: DataFrame, settings: Settings, extra_ranges: bool = False) -> DataFrame:
    """One row per check: what was observed, what is expected, whether it passed.

    Most checks are counts, taken by site so that the sites themselves come along: one row for each site
    and task is shuffled. Duplicates need the keys together; of each key 16 bytes and a count are
    shuffled, and copies in one task are counted before. No row is expanded.

    ``extra_ranges`` adds range checks for the measures other than moisture. Missing columns are a
    failed check like the others; the checks that need them then see NULL in their place.
    """
    missing = missing_columns(silver)
    silver = silver.withColumns(
        {
            c: F.lit(None).cast("double" if c == "soil_value" else "string")
            for c in [*missing, *(k for k in UNIQUE_KEY if k not in silver.columns)]
        }
    )

    def outside(measure: str):
        lo, hi = settings.ranges[measure]
        value = F.col("soil_value")
        broken = (value < lo) | ((value > hi) & ~F.isnan(value))
        return F.count_if((F.col("measure_type") == measure) & broken)

    observed = {
        "rows": F.count("*"),
        "null_site_name": F.count_if(F.col("site_name").isNull()),
        "null_site_id": F.count_if(F.col("site_id").isNull()),
        "unknown_measure": F.count_if(~F.col("measure_type").isin(*settings.ranges)),
        "unknown_depth": F.count_if(~F.col("depth_cm").isin(*settings.depths)),
        "moisture_out_of_range": outside(MOISTURE),
    }
    checks = [
        ("Q1", "rows", ">=", settings.min_rows),
        ("Q2", "missing_columns", "=", 0),
        ("Q3", "null_site_name", "=", 0),
        ("Q4", "null_site_id", "=", 0),
        ("Q5", "unknown_measure", "=", 0),
        ("Q6", "unknown_depth", "=", 0),
        ("Q7", "moisture_out_of_range", "=", 0),
        ("Q8", "duplicates", "=", 0),
        ("Q9", "sites", ">=", settings.min_sites),
    ]
    if extra_ranges:
        for m in settings.ranges:
            if m != MOISTURE:
                name = f"{m.lower()}_out_of_range"
                observed[name] = outside(m)
                checks.append(("extra", name, "=", 0))

    by_site = silver.groupBy("site_name").agg(*[c.alias(n) for n, c in observed.items()])
    sums = by_site.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in observed], F.count("site_name").alias("sites")
    )
    # NULL parts of a key count as values, so rows beyond the first of each key are its duplicates.
    high, low = row_digest(UNIQUE_KEY)
    by_key = silver.groupBy(high.alias("_high"), low.alias("_low")).agg(F.count("*").alias("_n"))
    repeated = by_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    both = sums.unionByName(repeated, allowMissingColumns=True)
    totals = both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
        "missing_columns", F.lit(len(missing)).cast("bigint")
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_id"),
                F.lit(name).alias("check_name"),
                F.col(name).alias("observed"),
                F.lit(f"{sign} {bound}").alias("expected"),
                (F.col(name) >= bound if sign == ">=" else F.col(name) == bound).alias("passed"),
            )
            for check, name, sign, bound in checks
        ]
    )
    return totals.select(F.inline(rows))


def assert_quality(silver: DataFrame, settings: Settings, extra_ranges: bool = False) -> DataFrame:
    """Raise when a check fails; otherwise return the table unchanged."""
    report = quality_report(silver, settings, extra_ranges).collect()  # a dozen rows at most
    failed = [f"{r.check_name}: {r.observed} (expected {r.expected})" for r in report if not r.passed]
    failed += [f"missing column {c}" for c in missing_columns(silver)]
    if failed:
        raise QualityError("silver quality checks failed: " + "; ".join(failed))
    return silver

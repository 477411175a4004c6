"""Exact summary statistics of a column, per group, without gathering a group in one task.

Mean and deviation come from ordinary partial aggregates. Exact quartiles need an order, and a
group may hold a large share of all rows, so the order is found by repeated refinement:

1. equal values are first counted together, so repeated values travel once;
2. every value is a 64-bit number of the same order, and its first 16 bits name its slice. Slices
   are counted with partial sums, and their totals give the rank at which each one starts;
3. only the slices that hold a wanted rank are cut again, by the next 16 bits, until after four
   levels a slice is one value.

Nothing is sorted but the slices of one level, of which a slice above has at most 65,536, whatever
the number of values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions import not_nan, ordered_bits

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
LEVEL_BITS = 16
LEVELS = 64 // LEVEL_BITS


def _same_group(by: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by])


def _with_group(left: DataFrame, right: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """Inner join on the group columns, where NULL is a group like any other."""
    added = [F.col(f"r.{c}") for c in right.columns if c not in by]
    condition = reduce(and_, [_same_group(by), *extra])
    return left.alias("l").join(right.alias("r"), condition).select("l.*", *added)


def describe(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    weight: str | None = None,
    counts: Mapping[str, Callable[[Column], Column]] | None = None,
    quantiles: Mapping[str, float] = QUARTILES,
    few_groups: bool = False,
    counted: bool = False,
) -> DataFrame:
    """count, mean, std, min, quantiles and max of ``value`` per group.

    NULL is left out of all of these, and NaN is taken as NULL. ``weight`` says how often a row
    counts. ``counts`` adds numbers of rows, NULL values included, whose value satisfies a predicate.
    ``few_groups`` may be set when the groups are bounded by construction (a fixed list of
    measures); their statistics are then broadcast. Otherwise Spark picks the join by size.
    ``counted`` may be set when each group has one row per value already; it saves a shuffle.
    """
    by = list(by)
    times = F.col(weight) if weight else F.lit(1)
    freq = df.select(
        *by,
        not_nan(F.col(value).cast("double")).alias("_v"),
        times.cast("bigint").alias("_w"),
    )
    if not counted:
        freq = freq.groupBy(*by, "_v").agg(F.sum("_w").alias("_w"))
    small = F.broadcast if few_groups else (lambda d: d)
    # A group's NULL is one row of ``freq``. It takes part with weight 0 instead of being filtered:
    # a filter would move into the scan of some branches and make them scan the input once more.
    known_rows = F.when(F.col("_v").isNotNull(), F.col("_w")).otherwise(0)

    extra = {
        name: F.coalesce(F.sum(F.when(predicate(F.col("_v")), F.col("_w"))), F.lit(0))
        for name, predicate in (counts or {}).items()
    }
    totals = freq.groupBy(*by).agg(
        F.sum(known_rows).alias("count"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        (F.sum(F.col("_v") * F.col("_w")) / F.nullif(F.sum(known_rows), F.lit(0))).alias("mean"),
        *[c.alias(name) for name, c in extra.items()],
    )
    # For the same reason its number is known: a join on a number that may be NULL filters, too.
    number = F.coalesce(ordered_bits(F.col("_v")), F.lit(0))
    bits = freq.select(*by, "_v", known_rows.alias("_w"), number.alias("_bits"))
    about = small(totals.select(*by, F.col("count").alias("_total"), F.col("mean").alias("_mean")))
    first = _with_group(bits, about, by).groupBy(*by, _slice(1)).agg(
        F.sum("_w").alias("_w"),
        F.first("_total").alias("_total"),
        F.sum(F.pow(F.col("_v") - F.col("_mean"), 2) * F.col("_w")).alias("_dev2"),
    )
    spread = first.groupBy(*by).agg(F.sum("_dev2").alias("_dev2"))
    wanted = _holding(first, by, [], "_slice1", quantiles)
    for level in range(2, LEVELS + 1):
        above = f"_slice{level - 1}"
        base = wanted.select(*by, F.col(above).alias("_at"), "_from", "_total")
        inside = _with_group(
            bits.withColumn(above, _slice(level - 1)), small(base), by, F.col(f"l.{above}") == F.col("r._at")
        )
        cut = inside.groupBy(*by, above, _slice(level)).agg(
            F.sum("_w").alias("_w"),
            F.first("_total").alias("_total"),
            F.first("_from").alias("_from"),
            F.min("_v").alias("_v"),
        )
        wanted = _holding(cut, by, [above], f"_slice{level}", quantiles)
    values = wanted.groupBy(*by).agg(*[_interpolated(q).alias(name) for name, q in quantiles.items()])
    deviation = F.sqrt(F.col("_dev2") / F.nullif(F.col("count") - 1, F.lit(0)))
    with_spread = totals.alias("l").join(spread.alias("r"), _same_group(by), "left").select("l.*", "r._dev2")
    return (
        with_spread.alias("l")
        .join(values.alias("r"), _same_group(by), "left")
        .select(
            *[F.col(f"l.{c}") for c in by],
            "count",
            "mean",
            F.when(F.col("count") > 0, deviation).alias("std"),
            "min",
            *quantiles,
            "max",
            *extra,
        )
    )


def _slice(level: int) -> Column:
    """The first ``level`` times 16 bits of a value, a number of the same order."""
    return F.shiftright("_bits", 64 - level * LEVEL_BITS).alias(f"_slice{level}")


def _holding(
    slices: DataFrame, by: Sequence[str], above: Sequence[str], name: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """The slices that hold a wanted rank, with the ranks ``_from`` and ``_to`` at which they start and end.

    The window runs over the slices of one slice of the level above, at most 65,536 rows.
    """
    in_order = Window.partitionBy(*by, *above).orderBy(name)
    start = F.col("_from") if above else F.lit(0)
    placed = slices.withColumn("_to", start + F.sum("_w").over(in_order)).withColumn(
        "_from", F.col("_to") - F.col("_w")
    )
    return placed.filter(
        reduce(
            or_,
            [
                (r >= F.col("_from")) & (r < F.col("_to"))
                for q in quantiles.values()
                for r in _ranks(q)
            ],
        )
    )


def _ranks(q: float) -> tuple[Column, Column]:
    """The two zero-based ranks between which quantile ``q`` of ``_total`` values lies."""
    position = (F.col("_total") - 1) * F.lit(q)
    return F.floor(position), F.ceil(position)


def _interpolated(q: float) -> Column:
    lower, upper = _ranks(q)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v")))

    share = F.first((F.col("_total") - 1) * F.lit(q) - lower)
    return at(lower) + (at(upper) - at(lower)) * share

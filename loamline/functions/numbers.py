"""Row-wise arithmetic and predicates, all inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamline.config import Settings


def row_mean(*cols: Column) -> Column:
    """Mean of the non-NULL values in a row; NULL when there are none."""
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cols])
    present = reduce(add, [c.isNotNull().cast("int") for c in cols])
    return total / F.nullif(present, F.lit(0))


def within_limits(measure: Column, value: Column, settings: Settings) -> Column:
    """TRUE when the value lies in its measure's range, ends included; NaN never does."""
    return reduce(
        or_,
        [(measure == m) & value.between(lo, hi) for m, (lo, hi) in settings.ranges.items()],
    )


def plausible(text: Column, value: Column, settings: Settings) -> Column:
    """``within_limits`` for the measure named in a probe text, as one chain of tests.

    A filter moves below the projection that names the measure, and would repeat that projection's
    expression in every branch. Testing the text itself looks for each word once, and the first
    word found decides, as it does in ``measure_type``.
    """
    ranges = iter(settings.ranges.items())
    measure, (lo, hi) = next(ranges)
    chain = F.when(text.contains(measure), value.between(lo, hi))
    for measure, (lo, hi) in ranges:
        chain = chain.when(text.contains(measure), value.between(lo, hi))
    return chain


def irrigation_needed(moisture: Column, rain_mm: Column, settings: Settings) -> Column:
    """Dry soil and no rain to speak of. An unknown rainfall counts as none; unknown moisture on a
    dry day gives NULL."""
    little_rain = rain_mm.isNull() | (rain_mm < settings.rain_cutoff_mm)
    return (moisture < settings.irrigate_below) & little_rain


def not_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ordered_bits(value: Column) -> Column:
    """A 64-bit number for each double, in the same order; equal numbers for equal values.

    The magnitude's number is the one that IEEE 754 stores it as: 2 ** 52 numbers for each power of
    two. Logarithms are only near, so an exponent that is one off is put right by the mantissa it gives.
    NaN is to be left out before; NULL stays NULL.
    """
    size = F.abs(value)
    guess = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    # 2 ** 1022 at most at a time, so that the scale of the least numbers is finite.
    scaled = size * F.pow(F.lit(2.0), -guess)
    up, down = scaled >= 2, (scaled < 1) & (guess > -1022)
    mantissa = F.when(up, scaled / 2).when(down, scaled * 2).otherwise(scaled)
    exponent = guess + F.when(up, 1).when(down, -1).otherwise(0) + 1023
    place = F.lit(2.0**52)
    number = exponent * F.lit(1 << 52) + ((mantissa - 1) * place).cast("bigint")
    bits = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(2047 << 52)).otherwise(number)
    return F.when(value < 0, -bits).otherwise(bits).cast("bigint")

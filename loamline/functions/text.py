"""What the free text of a probe's measure says: depth, measure, texture, probe number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamline.config import MEASURES

# Patterns that decide what is read out of a probe text.
DEPTH_PATTERN = r"(\d+)\s*[Cc][Mm]"
TEXTURE_PATTERN = r"\((Clay[^)]*|Sandy[^)]*|Loam[^)]*)\)"
SUFFIX_PATTERN = r"#(\d+)"
MEASURE_PATTERN = r"(Moisture|Temperature|Salinity|Conductivity)"


def _captured(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def depth_cm(text: Column) -> Column:
    """``40 cm`` or ``40CM`` → 40; NULL without a depth (or with one too long for an int)."""
    return F.regexp_extract(text, DEPTH_PATTERN, 1).try_cast("int")


def measure_type(text: Column, measures: tuple[str, ...] = MEASURES) -> Column:
    """The first of ``measures``, in the order given, that occurs anywhere in the text."""
    hits = [F.when(text.contains(m), F.lit(m)) for m in measures]
    return reduce(lambda a, b: F.coalesce(a, b), hits)


def first_measure_word(text: Column) -> Column:
    """The leftmost measure word, whichever it is; also knows Conductivity."""
    return _captured(text, MEASURE_PATTERN)


def soil_texture(text: Column) -> Column:
    """Texture in parentheses when it starts with Clay, Sandy or Loam; otherwise NULL."""
    return _captured(text, TEXTURE_PATTERN)


def probe_suffix(text: Column) -> Column:
    return _captured(text, SUFFIX_PATTERN)


def clean_text(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit(""))

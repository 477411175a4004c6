from loamline.functions.digests import row_digest
from loamline.functions.numbers import (
    irrigation_needed,
    not_nan,
    ordered_bits,
    plausible,
    row_mean,
    within_limits,
)
from loamline.functions.text import (
    clean_text,
    depth_cm,
    first_measure_word,
    measure_type,
    probe_suffix,
    soil_texture,
)
from loamline.functions.times import (
    calendar_date,
    civil_date,
    hour_start,
    iso_text,
    offset_timestamp,
    zoned,
)

__all__ = [
    "calendar_date",
    "civil_date",
    "clean_text",
    "depth_cm",
    "first_measure_word",
    "hour_start",
    "irrigation_needed",
    "iso_text",
    "measure_type",
    "not_nan",
    "plausible",
    "offset_timestamp",
    "ordered_bits",
    "probe_suffix",
    "row_digest",
    "row_mean",
    "soil_texture",
    "within_limits",
    "zoned",
]

from loamline.sources.files import read_sites_csv, read_table, read_weather_csv, weather_from_text, weather_text
from loamline.sources.incremental import (
    all_pages,
    high_water_mark,
    incremental_slice,
    numbered_rows,
    page_after,
    page_of,
    range_slice,
    read_if_exists,
    stored_high_water_mark,
)
from loamline.sources.paged import read_landed, stream_landed
from loamline.sources.pages import landed_pages, page_lines, page_schema, read_pages, records

__all__ = [
    "all_pages",
    "numbered_rows",
    "read_landed",
    "stored_high_water_mark",
    "stream_landed",
    "weather_from_text",
    "weather_text",
    "high_water_mark",
    "incremental_slice",
    "page_after",
    "page_of",
    "landed_pages",
    "page_lines",
    "page_schema",
    "range_slice",
    "read_if_exists",
    "read_pages",
    "read_sites_csv",
    "read_table",
    "read_weather_csv",
    "records",
]

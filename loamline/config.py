"""Thresholds and limits, held in one immutable object that every operator takes as a parameter."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta

# The numbers below decide which readings are kept and which days are flagged.
MOISTURE = "Moisture"
TEMPERATURE = "Temperature"
SALINITY = "Salinity"
MEASURES = (MOISTURE, TEMPERATURE, SALINITY)
DEPTHS_CM = (10, 20, 30, 40, 50, 60, 70, 80)
IRRIGATE_BELOW = 30.0
RAIN_CUTOFF_MM = 2.0
MOISTURE_RANGE = (0.0, 100.0)
TEMPERATURE_RANGE = (-10.0, 60.0)
SALINITY_RANGE = (0.0, 10.0)
WEATHER_FROM = date(2023, 9, 1)
FIRST_LOAD = datetime(2023, 1, 1)
OVERLAP = timedelta(minutes=2)
CHUNK = timedelta(hours=12)
MIN_ROWS = 1000
MIN_SITES = 10


def _ranges() -> dict[str, tuple[float, float]]:
    return {MOISTURE: MOISTURE_RANGE, TEMPERATURE: TEMPERATURE_RANGE, SALINITY: SALINITY_RANGE}


@dataclass(frozen=True)
class Settings:
    ranges: dict[str, tuple[float, float]] = field(default_factory=_ranges)
    depths: tuple[int, ...] = DEPTHS_CM
    shallow_to_cm: int = 40
    irrigate_below: float = IRRIGATE_BELOW
    rain_cutoff_mm: float = RAIN_CUTOFF_MM
    # None lifts either bound.
    weather_from: date | None = WEATHER_FROM
    first_load: datetime | None = FIRST_LOAD
    overlap: timedelta = OVERLAP
    chunk: timedelta = CHUNK
    min_rows: int = MIN_ROWS
    min_sites: int = MIN_SITES
    # Zone whose calendar decides days and hours; None takes the event time as it is.
    timezone: str | None = None

    @property
    def shallow(self) -> tuple[int, ...]:
        return tuple(d for d in self.depths if d <= self.shallow_to_cm)

    @property
    def deep(self) -> tuple[int, ...]:
        return tuple(d for d in self.depths if d > self.shallow_to_cm)

    def but(self, **changes) -> Settings:
        return replace(self, **changes)

    @classmethod
    def from_json(cls, path: str) -> Settings:
        """Read a JSON file; what it leaves out keeps its default.

        ``thresholds`` holds limits, the irrigation threshold and the gate's minimums (``min_rows``,
        ``min_sites``), ``api.timezone`` the zone of days and hours, ``bounds`` the first day of
        weather and the first load (``weather_from``, ``first_load``; null for no bound).
        """
        with open(path, encoding="utf-8") as fh:
            sections = json.load(fh)
        t, bounds = sections.get("thresholds", {}), sections.get("bounds", {})
        base = cls()

        def bound(name: str, kind):
            text = bounds.get(name, "")
            return getattr(base, name) if text == "" else text and kind.fromisoformat(text)

        ranges = {
            m: (float(t.get(f"{m.lower()}_min", lo)), float(t.get(f"{m.lower()}_max", hi)))
            for m, (lo, hi) in base.ranges.items()
        }
        return base.but(
            ranges=ranges,
            irrigate_below=float(t.get("soil_moisture_irrigate", base.irrigate_below)),
            min_rows=int(t.get("min_rows", base.min_rows)),
            min_sites=int(t.get("min_sites", base.min_sites)),
            timezone=sections.get("api", {}).get("timezone", base.timezone),
            weather_from=bound("weather_from", date),
            first_load=bound("first_load", datetime),
        )

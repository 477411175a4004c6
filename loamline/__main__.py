"""Run one pipeline step: ``python -m loamline gold-daily --lake /data/lake``."""

from __future__ import annotations

import argparse

from loamline.config import Settings
from loamline.plans.pipeline import Lake, Pipeline
from loamline.session import clear_scratch, get_spark
from loamline.sinks import Ingested

STEPS_WITH_INPUT = {
    "ingest-soil": lambda p, path: p.ingest_soil(path),
    "ingest-soil-pages": lambda p, path: p.ingest_soil_pages(path),
    "ingest-rainfall": lambda p, path: p.ingest_weather("rainfall", path),
    "ingest-temperature": lambda p, path: p.ingest_weather("temperature", path),
    "ingest-solar": lambda p, path: p.ingest_weather("solar", path),
    "ingest-sites": lambda p, path: p.ingest_sites_csv(path),
    "ingest-sites-pages": lambda p, path: p.ingest_sites_pages(path),
}
STEPS = {
    "silver-soil": Pipeline.silver_soil,
    "silver-weather": Pipeline.silver_weather,
    "validate": Pipeline.validate,
    "gold-daily": Pipeline.gold_daily,
    "gold-hourly": Pipeline.gold_hourly,
    "load": Pipeline.load,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loamline")
    parser.add_argument("step", choices=[*STEPS_WITH_INPUT, *STEPS])
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--input", help="file or folder an ingest step reads")
    parser.add_argument("--config", help="JSON file with thresholds")
    parser.add_argument("--timezone", help="zone whose calendar decides days and hours")
    args = parser.parse_args(argv)

    settings = Settings.from_json(args.config) if args.config else Settings()
    if args.timezone:
        settings = settings.but(timezone=args.timezone)
    pipeline = Pipeline(get_spark(f"loamline {args.step}"), Lake(args.lake), settings)
    if args.step in STEPS_WITH_INPUT:
        if not args.input:
            parser.error(f"{args.step} needs --input")
        result = STEPS_WITH_INPUT[args.step](pipeline, args.input)
    else:
        result = STEPS[args.step](pipeline)
    clear_scratch(pipeline.spark)
    if isinstance(result, Ingested):
        print(f"{args.step}: {result.added} rows added, {result.rejected} set aside")
    else:
        print(f"{args.step}: {'done' if result is None else f'{result} rows'}")


if __name__ == "__main__":
    main()

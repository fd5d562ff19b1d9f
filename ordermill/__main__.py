"""Command line: ``python -m ordermill <analysis> <input> <output> [--flat] [--splittable]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ordermill.plans import reports
from ordermill.session import stage, staging
from ordermill.sources import orders, readers, writers


def _popular_sizes(raw):
    return reports.dates_as_text(stage(reports.popular_sizes(orders.window_orders(raw)), "sizes"))


def _median_variety(raw):
    return reports.median_varieties(orders.variety_orders(raw)).orderBy("month", "state")


def _cancelled_share(raw):
    return reports.cancelled_share(orders.promo_orders(raw))


def _promo_percentiles(raw):
    return reports.promo_percentiles(orders.sku_orders(raw))


# name -> (analysis of the raw order table, output format); an analysis may count rows on the way
ANALYSES = {
    "clean-states": (reports.clean_states_counted, "csv"),
    "popular-sizes": (_popular_sizes, "csv"),
    "median-variety": (_median_variety, "csv"),
    "cancelled-share": (_cancelled_share, "parquet"),
    "promo-percentiles": (_promo_percentiles, "parquet"),
}


def _read(spark, path, splittable):
    if path.rstrip("/").endswith(".parquet"):
        return readers.read_parquet(spark, path)
    return readers.read_csv(spark, path, multi_line=False) if splittable else readers.read_records(spark, path)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ordermill", description=__doc__)
    parser.add_argument("analysis", choices=ANALYSES)
    parser.add_argument("input", help="order table: CSV with a header line, or *.parquet")
    parser.add_argument("output")
    parser.add_argument("--flat", action="store_true", help="one file, written by one task, instead of a folder")
    parser.add_argument("--splittable", action="store_true", help="no CSV field holds a line end, which spares the search for them")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"ordermill {args.analysis}").getOrCreate()
    analysis, file_format = ANALYSES[args.analysis]
    with staging(spark):
        result = analysis(_read(spark, args.input, args.splittable))
        result, counts = result if isinstance(result, tuple) else (result, None)
        if args.flat:
            writers.write_flat_file(result, args.output, file_format)
        elif file_format == "csv":
            writers.write_csv(result, args.output)
        else:
            writers.write_parquet(result, args.output)
        if counts is not None:
            print(", ".join(f"{name} {n}" for name, n in counts.get.items()))


if __name__ == "__main__":
    main()

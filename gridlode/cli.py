"""python -m gridlode.cli collect | aggregate | quality | update"""

from __future__ import annotations

import argparse
import datetime
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridlode.operators import metrics, quality
from gridlode.operators.points import parse_records
from gridlode.plans import update
from gridlode.sources import export, pages
from gridlode.sources.files import written
from gridlode.sources.html import table_records
from gridlode.sources.store import Store


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridlode")
    commands = top.add_subparsers(dest="command", required=True)
    for name, options in {
        "collect": {"--base-url": {"required": True}, "--source": {"default": "registry"}, "--start-page": {"type": int, "default": 1}, "--end-page": {"type": int}, "--output-dir": {"default": "data"}},
        "aggregate": {"--input": {"required": True}, "--output": {"required": True}, "--as-of": {"type": datetime.date.fromisoformat}},
        "quality": {"--store": {}, "--output-dir": {"default": "data"}, "--examples": {"type": int, "default": 5}, "--patterns": {"type": int, "default": 30}, "--top": {"type": int, "default": 10}, "--run-id": {"type": int}},
        "update": {"--base-url": {}, "--input": {}, "--source": {"default": "registry"}, "--store": {}, "--as-of": {"type": datetime.date.fromisoformat}},
    }.items():
        command = commands.add_parser(name)
        for option, kind in options.items():
            command.add_argument(option, **kind)
    return top


def main(argv: list[str] | None = None) -> int:
    args = arguments().parse_args(argv)
    if args.command in ("quality", "update") and not args.store:
        print("--store is required", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName(f"gridlode {args.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return {"collect": collect, "aggregate": aggregate, "quality": report, "update": run}[args.command](spark, args)


def collect(spark: SparkSession, args) -> int:
    """Pages to files. If a page fails, what came before it is written, and the exit code is 1."""
    failed = None
    try:
        raw = pages.collect_pages(spark, args.base_url, args.source, args.start_page, args.end_page)
    except pages.CollectError as e:
        failed, raw = e, e.partial
    raw = written(raw)
    parsed = written(parse_records(raw))
    by_place = ("source_page", "source_row_index")
    export.write_json(raw.orderBy(*by_place), os.path.join(args.output_dir, "raw.json"))
    export.write_json(parsed.orderBy(*by_place).drop("source_row_index"), os.path.join(args.output_dir, "parsed.json"))
    export.write_csv(parsed.orderBy(*by_place).drop("source_row_index"), os.path.join(args.output_dir, "parsed.csv"))
    counts = parsed.agg(F.count("*"), F.count("canonical_node_id"), F.count_if("needs_review")).first()
    print(f"raw={raw.count()} parsed={counts[0]} nodes={counts[1]} review={counts[2]}")
    if failed is not None:
        print(f"failed: {failed}", file=sys.stderr)
    return int(failed is not None)


def aggregate(spark: SparkSession, args) -> int:
    parsed = pages.parsed_json(spark, args.input)
    as_of = args.as_of or metrics.default_as_of(parsed).first()[0]
    nodes = metrics.aggregate_nodes(parsed, as_of)
    nodes = nodes.select("*", F.lit(0).alias("ambiguous_tu_count"), F.lit(0.0).alias("ambiguous_capacity_min_mw"), F.lit(0.0).alias("ambiguous_capacity_max_mw")).orderBy("canonical_node_id")
    (export.write_json if args.output.endswith(".json") else export.write_csv)(nodes, args.output)
    stats = metrics.stats(parsed).first().asDict()
    print(f"as_of={as_of} nodes={nodes.count()}")
    print(" ".join(f"{k}={v}" for k, v in stats.items()))
    return 0


def report(spark: SparkSession, args) -> int:
    """The quality of all legacy records; with a run's number, that of its canonical records."""
    store = Store(spark, args.store)
    rows = update.quality_rows_v1(store) if args.run_id is None else update.quality_rows_v2(store, args.run_id)
    found = quality.report(rows, args.examples, args.patterns)
    export.write_report(found, os.path.join(args.output_dir, "quality.json"))
    export.write_review_csv(rows, os.path.join(args.output_dir, "review.csv"))
    print(quality.render(found, args.top, "QUALITY" if args.run_id is None else "QUALITY_V2"))
    return 0


def run(spark: SparkSession, args) -> int:
    """From a registry, or from saved pages."""
    scanned = pages.saved_pages(spark, args.input) if args.input else pages.scan(spark, args.base_url)
    store = Store(spark, args.store)
    summary = update.run_update(spark, table_records(scanned, args.source), store, args.source, args.as_of)
    print(update.reports(store, summary))
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Command line: build the gold tables, profile the sources, export the result table."""

from __future__ import annotations

import argparse
import datetime
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from .plans import analytics, build, quality
from .session import tune
from .sinks.writers import export_result, land_bronze, replace_table, stage_tables
from .sources.readers import read_raw
from .sources.registry import SOURCES


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="barorail", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (
        ("build", "raw files to gold tables"),
        ("profile", "report on every raw source"),
        ("export", "consolidated result table as CSV"),
        ("land", "copy raw files to the bronze folders of a day"),
        ("stage", "one staging table per raw file"),
    ):
        command = commands.add_parser(name, help=text)
        command.add_argument("--env", choices=sorted(build.ENVIRONMENTS), default="preprod")
        command.add_argument("--raw", default="data/raw", help="folder of the raw files")
        command.add_argument("--gold", help="folder of the gold tables, instead of that of the environment")
        command.add_argument("--out", help="folder to write to (profile, export, land) or database (stage)")
        command.add_argument(
            "--split", action="store_true", help="read national exports in splits: no line breaks inside quotes"
        )
        command.add_argument("--day", type=datetime.date.fromisoformat, default=datetime.date.today())
    return parser


def run(spark: SparkSession, arguments: list[str] | None = None) -> DataFrame | list[str] | int | None:
    """Run one command and return what it made: a summary, the folders or tables, or a row count."""
    args = _parser().parse_args(arguments)
    tune(spark)
    env = build.ENVIRONMENTS[args.env]
    env = replace(env, gold_dir=args.gold or env.gold_dir, multiline=env.multiline and not args.split)
    if args.command == "build":
        tables = build.build(spark, args.raw, env, args.day)
        return build.build_summary(
            *(tables[n] for n in ("fact_regularite", "dim_stations_multipays", "dim_liaisons", "fact_fares"))
        )
    if args.command == "profile":
        sources = [
            (spec.filename, raw, spec.outlier_column)
            for name, spec in SOURCES.items()
            if spec.semicolon and (raw := read_raw(spark, args.raw, name, env.multiline)) is not None
        ]
        report = quality.profile_sources(sources)
        if args.out:
            replace_table(report, args.out)
            return spark.read.parquet(args.out)
        return report
    if args.command == "export":
        fact, lines, fares = (
            spark.read.parquet(f"{env.gold_dir}/{n}") for n in ("fact_regularite", "dim_liaisons", "fact_fares")
        )
        return export_result(analytics.consolidated(fact, lines, fares), args.out or f"{env.gold_dir}/resultats")
    if args.command == "land":
        return land_bronze(spark, args.raw, args.out or f"{env.gold_dir}/bronze", args.day, env.multiline)
    return stage_tables(spark, args.raw, args.out, env.multiline)


def main() -> None:
    spark = SparkSession.builder.appName("barorail").getOrCreate()
    result = run(spark)
    if isinstance(result, DataFrame):
        result.show(200, truncate=False)
    else:
        print(result)


if __name__ == "__main__":
    main()

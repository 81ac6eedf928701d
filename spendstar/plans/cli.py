"""Command line: ``python -m spendstar {generate,run,report,export}``.

Each command is a function of a session and its arguments, bound to its own parser.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from spendstar.plans import pipeline
from spendstar.session import build_session
from spendstar.sources.generator import write_events
from spendstar.sources.warehouse import Warehouse

Arguments = argparse.Namespace
Command = Callable[[SparkSession, Arguments], None]


def generate(spark: SparkSession, args: Arguments) -> None:
    """Write synthetic raw events as CSV."""
    print(write_events(spark, args.rows, args.seed, args.out))


def run(spark: SparkSession, args: Arguments) -> None:
    """Build, check and publish a warehouse run."""
    source = args.source
    if not source:
        folder = f"{args.warehouse.rstrip('/')}/raw/{Warehouse.new_run_id()}"
        source = write_events(spark, args.rows, args.seed, folder)
    done = pipeline.run(
        spark,
        source,
        args.warehouse,
        landing_uri=args.landing,
        multiline=args.multiline,
        credential_conf=args.credential_conf,
    )
    print(done.format())


def report(spark: SparkSession, args: Arguments) -> None:
    """Print the channel by month report, or write it as CSV."""
    rows = pipeline.report(spark, args.warehouse)
    if args.out:
        print(pipeline.write_report_csv(rows, args.out))
        return
    for line in pipeline.format_report(rows):
        print(line)


def export(spark: SparkSession, args: Arguments) -> None:
    """Write the marts extract as JSON."""
    now = datetime.now(UTC).isoformat(timespec="seconds").replace("+00:00", "Z")
    pipeline.export(spark, args.warehouse, args.out, now, args.seed, single_file=not args.parts)
    print(args.out)


def _command(commands, handler: Command, *options: tuple[str, dict]) -> None:
    parser = commands.add_parser(handler.__name__, help=handler.__doc__)
    for flag, settings in options:
        parser.add_argument(flag, **settings)
    parser.set_defaults(handler=handler)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="spendstar", description=__doc__.splitlines()[0])
    parser.add_argument("--master", help="Spark master, where spark-submit does not say")
    commands = parser.add_subparsers(dest="command")
    needed = {"required": True}
    rows, seed = ("--rows", {"type": int, "default": 5000}), ("--seed", {"type": int, "default": 42})
    warehouse, out = ("--warehouse", needed), ("--out", needed)
    _command(commands, generate, out, rows, seed)
    _command(
        commands,
        run,
        warehouse,
        ("--source", {"help": "raw CSV; events are generated without it"}),
        ("--landing", {"help": "place to stage the raw files first"}),
        ("--multiline", {"action": "store_true", "help": "cells may hold line breaks"}),
        ("--credential-conf", {"help": "Hadoop setting that the source needs"}),
        rows,
        seed,
    )
    _command(commands, report, warehouse, ("--out", {"help": "CSV folder instead of text"}))
    _command(
        commands,
        export,
        warehouse,
        out,
        ("--seed", {"type": int, "required": True}),
        ("--parts", {"action": "store_true", "help": "a folder of parts and a manifest instead of one file"}),
    )
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = build_parser()
    args = parser.parse_args(argv)
    if args.command is None:
        print(parser.format_help())
    else:
        args.handler(build_session(args.master), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())

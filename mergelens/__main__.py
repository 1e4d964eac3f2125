"""Command line: ``extract``, ``coverage`` and ``distinct``."""

from __future__ import annotations

import argparse
import json

from mergelens.config import ExtractionConfig
from mergelens.plans import extraction, reports
from mergelens.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="mergelens", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    extract = commands.add_parser("extract", help="landed pages to records")
    extract.add_argument("landing")
    extract.add_argument("output")
    extract.add_argument("run", help="name of the run; later names are newer")
    extract.add_argument("--settings", default="{}", help="JSON object of ExtractionConfig fields")
    for name in ("coverage", "distinct"):
        report = commands.add_parser(name, help=f"{name} report over result files")
        report.add_argument("path")
        report.add_argument("--format", default="envelope", choices=("envelope", "document", "indented", "parquet", "json"))
        report.add_argument("--save", help="folder for the report as JSON")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    if args.command == "extract":
        config = ExtractionConfig(**json.loads(args.settings))
        extraction.run_extraction(spark, args.landing, args.output, args.run, config)
        report = extraction.summaries(extraction.stored_records(spark, args.output))
    else:
        records = reports.read_results(
            spark, args.path, args.format, named=args.command == "distinct"
        )
        build = reports.coverage_report if args.command == "coverage" else reports.distinct_report
        report = build(records)
        if args.save:
            reports.write_report(report, args.save)
    for name, df in report.items():
        print(name)
        df.show(50, truncate=False)


if __name__ == "__main__":
    main()

"""Reports over result files: component coverage, distinct pull requests per repository."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mergelens.operators import stats
from mergelens.sources import envelopes as E
from mergelens.sources.json_scan import read_documents


def coverage_report(records: DataFrame) -> dict[str, DataFrame]:
    """Totals with percentages, top five repositories, top five authors."""
    return {
        "coverage": stats.coverage_percentages(stats.with_presence(records)),
        "top_repositories": stats.top_values(records, "repository_full_name", 5),
        "top_authors": stats.top_values(records, "author", 5),
    }


def distinct_report(records: DataFrame) -> dict[str, DataFrame]:
    """Distinct pull requests per repository and in total."""
    return {
        "repositories": stats.distinct_per_repository(records).orderBy("repository_name"),
        "totals": stats.distinct_totals(records),
    }


def read_results(spark: SparkSession, path: str, file_format: str, named: bool) -> DataFrame:
    """Records of envelope or indented files, or of Parquet or JSON lines with one record per row.

    ``document`` reads JSON documents of any layout and size, whatever the files are called.
    """
    pattern = E.ENVELOPE_PATTERN if named else None
    if file_format == "document":
        return read_documents(spark, path, "*", pattern)[0]
    if file_format == "indented":
        return E.read_indented(spark, path, name_pattern=pattern)[0]
    if file_format != "envelope":
        return E.read_records(spark, path, file_format)
    return E.records(E.read_envelopes(spark, path, name_pattern=pattern))


def write_report(report: dict[str, DataFrame], path: str) -> None:
    for name, df in report.items():
        df.write.mode("overwrite").json(f"{path}/{name}")

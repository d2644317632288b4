"""Report files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header, blanks for null. Part files follow the report's order; a report
    cut to its newest rows is one file."""
    report.write.mode(mode).csv(path, header=True, nullValue="", emptyValue="", encoding="UTF-8")


def write_json(payload: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, from the ``value`` column, written in parallel."""
    payload.select("value").write.mode(mode).text(path)

"""JSON report files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(report: DataFrame, path: str) -> None:
    """Write the JSON texts of reports below ``path``, one after another; parent folders are created."""
    report.select("report").write.mode("overwrite").text(path)

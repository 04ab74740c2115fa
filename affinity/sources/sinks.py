"""Sinks: predictions (S5, as lists or text), submission CSV (S6) and the metrics table.

Writers are plain DataFrame writes, so the output is produced by the
executors in parallel and a lost task is simply re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_predictions(recommendations: DataFrame, path: str) -> None:
    """Recommendations keep their ``array<bigint>`` column and go to parquet."""
    recommendations.write.mode("overwrite").parquet(path)


def write_prediction_lines(lines: DataFrame, path: str, header: str) -> None:
    """Predictions text (``id,[a, b]``), one line per row below a header line in every file."""
    # a CSV of one column whose separator does not occur, so that nothing is quoted
    lines.select(F.col("line").alias(header)).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def write_submission(submission: DataFrame, path: str) -> None:
    """Two-column CSV with a header: ``customer_id,list_product_id`` (``[a b]`` text)."""
    (submission.select("customer_id", "list_product_id")
     .write.mode("overwrite").option("header", True).csv(path))


def write_metrics(report: DataFrame, path: str) -> None:
    """The evaluation report (split, scorer if there are several, metric, value) as a table."""
    scorer = ["scorer"] if "scorer" in report.columns else []
    report.select("split", *scorer, "metric", F.col("value").cast("double")).write.mode("overwrite").parquet(path)


def write_csv(table: DataFrame, path: str) -> None:
    """A typed table as CSV that ``files.read_typed_csv`` reads back; missing values are empty."""
    (table.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "")
     .csv(path))

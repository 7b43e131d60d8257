"""Written results: audit and exports. The report history is in ``report_store``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import scalars as s
from lotwise.sources.schemas import AUDIT


def write_audit(
    spark: SparkSession, path: str, procedure: str, user_id: int, start: dt.datetime, end: dt.datetime
) -> None:
    """Append one record of a finished call."""
    elapsed = int((end - start) / dt.timedelta(milliseconds=1))
    row = spark.createDataFrame([(procedure, elapsed, user_id, start)], AUDIT)
    row.write.mode("append").parquet(path)


def export_detail(detail: DataFrame, path: str, day: s.DateLike) -> str:
    """Detail rows as CSV files with header in a folder named by day. Returns the folder."""
    folder = f"{path}/detail_{day}"
    detail.write.mode("overwrite").option("header", True).csv(folder)
    return folder


def export_weekly(rows: DataFrame, path: str, week: dt.date) -> str:
    """The customer's table as CSV in a folder named by the Monday of the week."""
    folder = f"{path}/weekly_{week - dt.timedelta(days=week.weekday())}"
    # Last column tells detail from total; the total is written behind the details.
    rows.orderBy("row_type", F.asc_nulls_first("customer_part"), "supplier", "mpn").write.mode(
        "overwrite"
    ).option("header", True).csv(folder)
    return folder

"""The daily job: report of a window into the history, retention, and the audit record of the run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from lotwise.constants import REPORT_CUSTOMERS
from lotwise.functions.scalars import DateLike
from lotwise.plans.incremental import backfill
from lotwise.plans.report import daily_report, resolve_window
from lotwise.sources.report_store import ReportStore
from lotwise.sources.sinks import write_audit
from lotwise.sources.tables import Tables


def run_daily(
    spark: SparkSession,
    t: Tables,
    history: str,
    audit: str,
    user_id: int,
    start: DateLike | None = None,
    end: DateLike | None = None,
    customers: Sequence[int] = REPORT_CUSTOMERS,
    as_of: dt.datetime | None = None,
) -> list[dt.date]:
    """Guard the window, replace its days in the history, drop days past retention, write the audit
    record. Returns the days dropped.

    The days and the sums of their weeks become visible together, see ``report_store``; days of the window without any
    row are emptied. A run that fails leaves the history as it was and no audit record, and can be repeated as it is.
    """
    began = dt.datetime.now()
    as_of = as_of or began
    first, behind = resolve_window(start, end, as_of)
    store = ReportStore(spark, history)
    report = daily_report(t, first, behind, customers, as_of)
    store.replace(report, [first + dt.timedelta(days=i) for i in range((behind - first).days)])
    expired = store.drop_expired(as_of)
    write_audit(spark, audit, "run_daily", user_id, began, dt.datetime.now())
    return expired


def run_backfill(
    spark: SparkSession,
    t: Tables,
    history: str,
    audit: str,
    user_id: int,
    start: dt.date,
    end: dt.date,
    customers: Sequence[int] = REPORT_CUSTOMERS,
    as_of: dt.datetime | None = None,
) -> list[dt.date]:
    """Compute the days in ``[start, end)`` whose source rows have changed since they were written, or that aren't
    there, in one job, and write the audit record. Returns the days computed."""
    began = dt.datetime.now()
    done = backfill(t, ReportStore(spark, history), start, end, customers, as_of or began)
    write_audit(spark, audit, "run_backfill", user_id, began, dt.datetime.now())
    return done

"""Scalar expressions and predicates. Every function takes and returns Columns, so all of
them stay inside generated code and simple ones reach the Parquet scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.constants import BLANK_PART_MARK, DPPM_SCALE, PART_PREFIX, UNKNOWN

DateLike = dt.date | dt.datetime | str


def ntz(value: DateLike) -> Column:
    """Zone-free timestamp literal from a date, datetime or ISO text."""
    return F.lit(_as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def _as_datetime(value: DateLike) -> dt.datetime:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return value


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text ---------------------------------------------------------------------------------


def strip_prefix(c: Column | str, prefix: str = PART_PREFIX) -> Column:
    """Drop ``prefix`` where the text starts with it, else return the text unchanged."""
    c = _col(c)
    n = len(prefix)
    return F.when(F.left(c, F.lit(n)) == prefix, F.substring(c, n + 1, 2**31 - 1)).otherwise(c)


def or_unknown(c: Column | str) -> Column:
    """Blank or NULL becomes ``Unknown``."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(UNKNOWN))


def or_default(c: Column | str, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def first_non_null(*cols: Column | str) -> Column:
    return F.coalesce(*[_col(c) for c in cols])


def full_name(first: Column | str, last: Column | str) -> Column:
    """Last name alone when the first name is blank. A NULL part makes the name NULL."""
    first, last = _col(first), _col(last)
    return F.when(first == "", last).otherwise(F.concat(first, F.lit(" "), last))


def text(*cols: Column | str) -> Column:
    """Cast to text and concatenate; NULL in any part gives NULL."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def split_values(c: Column | str, kind: type = str, separator: str = ",") -> Column:
    """Delimited text to an array of trimmed text or integers. Explode it to get rows.

    Blank entries are skipped; entries that are not numbers raise for ``int`` as a cast would.
    """
    parts = F.filter(F.transform(F.split(_col(c), separator, -1), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(parts, lambda p: p.cast("bigint")) if kind is int else parts


def as_list(values: str | Iterable | None, kind: type = str) -> list:
    """Driver-side form of ``split_values`` for call parameters: delimited text or any iterable."""
    if values is None:
        return []
    if isinstance(values, str):
        values = [p.strip() for p in values.split(",") if p.strip()]
    return [kind(v) for v in values]


# --- dates --------------------------------------------------------------------------------


def as_date(c: Column | str) -> Column:
    return _col(c).cast("date")


def add_days(c: Column | str, n: int) -> Column:
    return F.date_add(_col(c), n)


def minus_years(c: Column | str, n: int) -> Column:
    """Keeps the time of day."""
    return _col(c) - F.expr(f"INTERVAL {int(n)} YEAR")


def days_between(a: Column | str, b: Column | str) -> Column:
    return F.datediff(_col(b), _col(a))


def millis_between(a: Column | str, b: Column | str) -> Column:
    return F.timestamp_diff("MILLISECOND", _col(a), _col(b))


def local_clock(zone: str) -> Column:
    """Current wall-clock time in ``zone``, without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()))


def week_start(c: Column | str) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", _col(c)).cast("date")


def week_end(c: Column | str) -> Column:
    """Sunday of the week."""
    return F.date_add(week_start(c), 6)


# --- predicates ---------------------------------------------------------------------------


def in_list(c: Column | str, values: Sequence) -> Column:
    return _col(c).isin(list(values))


def in_window(c: Column | str, start: DateLike, end: DateLike) -> Column:
    """Half-open window ``[start, end)`` on a zone-free timestamp."""
    c = _col(c)
    return (c >= ntz(start)) & (c < ntz(end))


def between(c: Column | str, lo, hi) -> Column:
    """Closed range."""
    return _col(c).between(lo, hi)


def between_optional(c: Column | str, lo=None, hi=None) -> Column:
    """Closed range with open ends; NULL never passes."""
    c = _col(c)
    cond = c.isNotNull()
    if lo is not None:
        cond = cond & (c >= lo)
    if hi is not None:
        cond = cond & (c <= hi)
    return cond


def at_least(c: Column | str, n) -> Column:
    return _col(c) >= n


def has_prefix(c: Column | str, prefix: str = PART_PREFIX) -> Column:
    return _col(c).startswith(prefix)


def contains(c: Column | str, piece: str) -> Column:
    return _col(c).contains(piece)


def keep_part(supplier: Column | str, mpn: Column | str, part: Column | str) -> Column:
    """Reported part: carries the prefix and is not a marked part with blank supplier and MPN.

    Three-valued logic is intended: an unknown supplier or MPN drops a marked part only if the
    other one is blank or unknown too.
    """
    marked_blank = (_col(supplier) == "") & (_col(mpn) == "") & contains(part, BLANK_PART_MARK)
    return has_prefix(part) & ~marked_blank


def loaded_at(start, end, load, removal) -> Column:
    """A lot was on the machine at the start or at the end of a step.

    A step that encloses a shorter load does not match: only its two ends are tested.
    """
    start, end, load, removal = map(_col, (start, end, load, removal))

    def on(t):
        return (t >= load) & (removal.isNull() | (t <= removal))

    return on(start) | on(end)


def dppm(failed: Column | str, consumed: Column | str, scale: int = DPPM_SCALE) -> Column:
    """Ratio of sums times ``scale``; NULL when nothing was consumed."""
    return F.try_divide(F.sum(_col(failed)) * F.lit(scale), F.sum(_col(consumed)))

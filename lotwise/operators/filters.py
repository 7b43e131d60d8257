"""Optional filters of the history API.

A list of values is a call parameter. A short one goes into the plan as literals and is pushed to the scan. A long one becomes
a relation: one column of distinct values, looked up by a hash join. Spark's estimate of a relation of given values is exact,
so it is broadcast only if it is below ``spark.sql.autoBroadcastJoinThreshold``, and shuffled otherwise. A list may also be
given as a DataFrame of one column, of any size.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.constants import STATUS_LANGUAGE

#: Values that go into a plan as literals, at most.
LITERALS = 500


def filter_if(df: DataFrame, flag: bool, cond: Column) -> DataFrame:
    return df.filter(cond) if flag else df


def _given(values: Iterable | DataFrame) -> list | DataFrame:
    return values if isinstance(values, DataFrame) else list(values)


def relation(df: DataFrame, column: str, values: list | DataFrame) -> DataFrame:
    """The values as distinct rows of one column, named and typed as ``column`` of ``df``."""
    kind = df.schema[column].dataType
    if isinstance(values, DataFrame):
        only = values.columns[0]
        return values.select(F.col(only).cast(kind).alias(column)).distinct()
    text = isinstance(kind, T.StringType)
    rows = pa.table({column: pa.array(list(dict.fromkeys(values)), pa.string() if text else pa.int64())})
    return df.sparkSession.createDataFrame(rows).select(F.col(column).cast(kind).alias(column))


def _listed(df: DataFrame, column: str, values: list | DataFrame) -> DataFrame:
    """Rows of ``df`` whose value is in a list that isn't empty."""
    if isinstance(values, DataFrame) or len(values) > LITERALS:
        return df.join(relation(df, column, values), column, "left_semi")
    return df.filter(F.col(column).isin(values))


def member_if(df: DataFrame, column: str, values: Iterable | DataFrame) -> DataFrame:
    """Keep rows whose value is listed; an empty list keeps all."""
    values = _given(values)
    return df if isinstance(values, list) and not values else _listed(df, column, values)


def optional_in(
    df: DataFrame, column: str, values: Iterable | DataFrame, lookup: DataFrame, lookup_column: str | None = None
) -> DataFrame:
    """Keep rows whose value is listed and exists in its lookup table; an empty list keeps all.

    Short lists are pushed to both scans; what is left of the lookup table has at most as many keys as the list.
    """
    values = _given(values)
    if isinstance(values, list) and not values:
        return df
    key = lookup_column or column
    known = _listed(lookup, key, values).select(F.col(key).alias(column))
    return (df.filter(F.col(column).isin(values)) if isinstance(values, list) and len(values) <= LITERALS else df).join(
        known, column, "left_semi"
    )


def optional_not_in(
    df: DataFrame, column: str, values: Iterable | DataFrame, lookup: DataFrame, lookup_column: str | None = None
) -> DataFrame:
    """Drop rows whose value is listed and exists in its lookup table; an empty list keeps all.

    The filter also drops unknown values, as NOT IN does on a non-empty set.
    """
    values = _given(values)
    if isinstance(values, list) and not values:
        return df
    key = lookup_column or column
    known = _listed(lookup, key, values).select(F.col(key).alias(column))
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def status_in(df: DataFrame, values: Iterable, statuses: DataFrame, texts: DataFrame) -> DataFrame:
    """Keep tests whose status letter is listed and is a known status text."""
    values = list(values)
    if not values:
        return df
    letters = (
        texts.filter((F.col("language_id") == STATUS_LANGUAGE) & F.col("translation").isin(values))
        .join(statuses.select(F.col("test_status").alias("text_id")), "text_id", "left_semi")
        .select(F.col("translation").alias("test_status"))
    )
    return df.filter(F.col("test_status").isin(values)).join(letters, "test_status", "left_semi")

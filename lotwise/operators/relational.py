"""Small relational helpers: keyed counts, totals, unions, ordering, outer joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.constants import ABORT, FAIL, PASS
from lotwise.operators.collation import EXACT, Comparison
from lotwise.operators.intervals import micros


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def status_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pass, fail and abort records per key. Without keys an empty input gives one NULL row."""

    def hits(letter):
        return F.sum(F.when(F.col("test_status") == letter, 1).otherwise(0))

    aggs = [
        hits(PASS).alias("pass_records"),
        hits(FAIL).alias("fail_records"),
        hits(ABORT).alias("abort_records"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def rank_latest_load(df: DataFrame, keys: Sequence[str], name: str = "sort") -> DataFrame:
    """Number the loads of each key, latest first. Equal load times are ordered by lot id."""
    w = Window.partitionBy(*keys).orderBy(F.desc("load_time"), F.desc("grn_id"))
    return df.withColumn(name, F.row_number().over(w))


def top1(df: DataFrame, rank: str = "sort") -> DataFrame:
    return df.filter(F.col(rank) == 1)


#: Lot ids, moved up by LOT_SHIFT, stay below LOTS.
LOTS, LOT_SHIFT = 2 * 10**19, 2**63
EPOCH = dt.date(1970, 1, 1)


def load_rank(load_time: str = "load_time", grn_id: str = "grn_id") -> Column:
    """Load time and lot id as one number that orders like the two. Its maximum is kept in a hash table, whereas that of a
    struct has Spark sort the rows."""
    time = micros(F.col(load_time), EPOCH).cast("decimal(19,0)")
    lot = F.col(grn_id).cast("decimal(20,0)") + F.lit(Decimal(LOT_SHIFT))
    return (time * F.lit(Decimal(LOTS)) + lot).cast("decimal(38,0)")


def lot_of(rank: str = "rank") -> Column:
    return (F.pmod(F.col(rank), F.lit(Decimal(LOTS))) - F.lit(Decimal(LOT_SHIFT))).cast("long")


def latest_rank(df: DataFrame, keys: Sequence[str], compare: Comparison = EXACT) -> DataFrame:
    """Keys and the greatest ``rank``: combined before the shuffle, so a hot key shrinks to one row per task."""
    return compare.grouped(df, keys, F.max("rank").alias("rank"))


def latest_load(df: DataFrame, keys: Sequence[str], compare: Comparison = EXACT) -> DataFrame:
    """The first row of ``rank_latest_load`` as an aggregation: keys, load_time, grn_id. Use this where only lot and
    time are needed; without the time ``latest_rank`` does."""
    best = F.max(F.struct("load_time", "grn_id")).alias("best")
    return compare.grouped(df, keys, best).select(*keys, "best.load_time", "best.grn_id")


def union_bag(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_bag(*dfs).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag difference a minus b."""
    return a.exceptAll(b.select(*a.columns))


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Comparison = EXACT) -> DataFrame:
    """Full outer join; each key column holds whichever side is present."""
    return compare.joined(left, right, keys, "full_outer")


def with_text(df: DataFrame, id_col: str, name: str, texts: DataFrame) -> DataFrame:
    """Look up the translation of ``id_col`` in an already language-filtered text table."""
    t = texts.select(F.col("text_id").alias(id_col), F.col("translation").alias(name))
    return df.join(t, id_col, "inner")


def with_total(df: DataFrame, keys: Sequence[str], measure: str, label: str = "row_type") -> DataFrame:
    """Detail rows, one per key, plus one grand-total row, told apart by ``label``. The input is
    read once; the total is combined per task before it is moved."""
    sets = [[F.col(k) for k in keys], []]
    both = df.groupingSets(sets, *keys).agg(F.sum(measure).alias(measure), F.grouping_id().alias(label))
    return both.withColumn(label, F.when(F.col(label) == 0, "Detail").otherwise("Total"))


def with_totals(df: DataFrame, outer: Sequence[str], inner: Sequence[str], measure: str, label: str = "row_type") -> DataFrame:
    """Detail rows per ``outer`` and ``inner`` keys, a total per ``outer`` keys and a grand total, told apart by ``label``.

    One pass over the input: grouping sets, combined per task before they are moved. ``label`` comes from the id of the
    grouping set, so keys that are NULL themselves aren't taken for totals.
    """
    keys = [*outer, *inner]
    sets = [[F.col(k) for k in keys], [F.col(k) for k in outer], []]
    sums = df.groupingSets(sets, *keys).agg(F.sum(measure).alias(measure), F.grouping_id().alias(label))
    of_outer, of_all = (1 << len(inner)) - 1, (1 << len(keys)) - 1
    shown = F.when(F.col(label) == 0, "Detail").when(F.col(label) == of_outer, "Total").when(F.col(label) == of_all, "Grand total")
    return sums.withColumn(label, shown)


def ordered(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*cols)


def newest_first(df: DataFrame, time_col: str, *tie_breaks: str) -> DataFrame:
    """Newest first; the extra columns make the order total so that a row cap is repeatable."""
    return df.orderBy(F.desc(time_col), *[F.asc_nulls_first(c) for c in tie_breaks])


def cap(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of an ordered result; 0 means no cap."""
    return df.limit(n) if n else df

"""Text compared without case and trailing blanks, and shown as it is.

Sources that compare so hold one value in several spellings. Rewriting the text when a table is read would lose the
spelling. Here the text stays, and a key made of it, in capitals and without trailing blanks, stands beside it wherever texts
are grouped, joined or tested. Of a group's spellings the least one in binary order is shown, so the result doesn't depend
on order or partitioning; of two joined texts that of the left side is. Filters on such texts don't reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.constants import PART_PREFIX
from lotwise.functions import scalars as s

#: Text columns that are compared with other text, under the names that plans use.
COMPARED = frozenset(
    {"crd", "serial_number", "internal_part", "customer_part", "descr", "supplier", "mpn", "grn", "test_status", "component_type"}
)


def loose_key(c: Column | str) -> Column:
    return F.upper(F.rtrim(F.col(c) if isinstance(c, str) else c))


@dataclass(frozen=True)
class Comparison:
    """How texts are compared. Columns named in ``loose`` go by their keys, all others as they are."""

    loose: frozenset[str] = frozenset()

    def key(self, name: str) -> Column:
        return loose_key(name) if name in self.loose else F.col(name)

    def grouped(self, df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
        """Keys and aggregates; of the spellings of a key the least is shown."""
        texts = [k for k in keys if k in self.loose]
        if not texts:
            return df.groupBy(*keys).agg(*aggs)
        found = df.groupBy(*[self.key(k).alias(f"{k}__key") if k in self.loose else F.col(k) for k in keys])
        shown = found.agg(*[F.min(k).alias(k) for k in texts], *aggs).drop(*[f"{k}__key" for k in texts])
        return shown.select(*keys, *[c for c in shown.columns if c not in keys])

    def distinct(self, df: DataFrame) -> DataFrame:
        """One row for all that differ in spelling only."""
        if not self.loose.intersection(df.columns):
            return df.distinct()
        return self.grouped(df, df.columns, F.lit(1).alias("__one")).drop("__one")

    def joined(self, left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
        """Join on equal keys; each key column holds the left side's text, or the other one where there is no left side."""
        if not self.loose.intersection(keys):
            return left.join(right, list(keys), how)
        other = right.withColumnsRenamed({k: f"{k}__other" for k in keys})
        same = [self.key(k) == (loose_key(f"{k}__other") if k in self.loose else F.col(f"{k}__other")) for k in keys]
        both = left.join(other, reduce(Column.__and__, same), how)
        if how in ("left_anti", "left_semi"):
            return both
        rest = [c for c in (*left.columns, *right.columns) if c not in keys]
        return both.select(*[F.coalesce(k, f"{k}__other").alias(k) for k in keys], *rest)

    def is_in(self, name: str, values: Iterable[str]) -> Column:
        if name not in self.loose:
            return s.in_list(name, list(values))
        return self.key(name).isin([v.rstrip(" ").upper() for v in values])

    def or_unknown(self, name: str) -> Column:
        if name not in self.loose:
            return s.or_unknown(name)
        return s.or_unknown(F.when(F.rtrim(F.col(name)) == "", "").otherwise(F.col(name)))

    def keep_part(self, supplier: str, mpn: str, part: str) -> Column:
        return s.keep_part(self.key(supplier), self.key(mpn), self.key(part))

    def strip_prefix(self, name: str, prefix: str = PART_PREFIX) -> Column:
        if name not in self.loose:
            return s.strip_prefix(name, prefix)
        begins = F.upper(F.left(F.col(name), F.lit(len(prefix)))) == prefix.upper()
        return F.when(begins, F.substring(name, len(prefix) + 1, 2**31 - 1)).otherwise(F.col(name))


EXACT = Comparison()
LOOSE = Comparison(COMPARED)

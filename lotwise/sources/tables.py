"""Registry that maps logical table names to DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.operators.collation import EXACT, Comparison
from lotwise.sources.schemas import LOOKUPS, TABLES, struct


class Tables:
    """Named tables of one plant database.

    ``compare`` says how plans compare texts: as they are, or without case and trailing blanks (``collation.LOOSE``), in
    which case every text is still shown as the source has it. ``rtrim`` and ``upper_keys`` instead bring the text of sources that compare without case and
    trailing blanks to one form when a table is read, so that every later comparison is a plain
    binary one and keeps its Parquet pushdown.

    ``absent`` names the lookup tables that the source doesn't have; the keys of their view stand in
    for them. Any other table that can't be read is an error.
    """

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        rtrim: bool = False,
        upper_keys: bool = False,
        absent: Collection[str] = (),
        compare: Comparison = EXACT,
    ):
        if unknown := set(absent) - set(LOOKUPS):
            raise ValueError(f"only lookup tables can be absent, not {sorted(unknown)}")
        self._load = load
        self._absent = frozenset(absent)
        self.compare = compare
        self._rtrim = rtrim
        self._upper_keys = upper_keys
        self._seen: dict[str, DataFrame] = {}

    # --- where the tables live ---

    @classmethod
    def parquet(cls, spark: SparkSession, root: str, **kw) -> Tables:
        """One Parquet folder or file per table below ``root``."""
        return cls(lambda name: spark.read.parquet(f"{root}/{name}"), **kw)

    @classmethod
    def catalog(cls, spark: SparkSession, database: str | None = None, **kw) -> Tables:
        """Tables of the session catalog, for example bucketed by ``wip_id``."""
        return cls(lambda name: spark.table(f"{database}.{name}" if database else name), **kw)

    @classmethod
    def jdbc(
        cls, spark: SparkSession, url: str, partitions: Mapping[str, tuple[str, int, int, int]], **kw
    ) -> Tables:
        """Tables of a database. ``partitions`` names per table the split column, its lower and
        upper bound and the number of parallel reads; tables not named are read in one piece."""
        options = kw.pop("options", {})

        def load(name: str) -> DataFrame:
            reader = spark.read.format("jdbc").options(
                url=url, dbtable=name, preferTimestampNTZ=True, **options
            )
            if name in partitions:
                column, lower, upper, n = partitions[name]
                reader = reader.options(
                    partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=n
                )
            return reader.load()

        return cls(load, **kw)

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame], **kw) -> Tables:
        """Given DataFrames; a table that is not given is an error when it is asked for."""
        return cls(frames.__getitem__, **kw)

    # --- reading ---

    def table(self, name: str) -> DataFrame:
        if name not in self._seen:
            if name in self._absent:
                view, key = LOOKUPS[name]
                df = self.table(view).select(key).distinct()
            else:
                df = self._load(name)
            self._seen[name] = self._edge(df)
        return self._seen[name]

    __getitem__ = table

    def _edge(self, df: DataFrame) -> DataFrame:
        zoned = any(isinstance(f.dataType, T.TimestampType) for f in df.schema)
        if not (zoned or self._rtrim or self._upper_keys):
            return df

        def clean(f: T.StructField):
            c = F.col(f.name)
            if isinstance(f.dataType, T.TimestampType):
                # The model has plant-local times without zone.
                c = c.cast("timestamp_ntz")
            if isinstance(f.dataType, T.StringType):
                if self._rtrim:
                    c = F.rtrim(c)
                if self._upper_keys and f.name in KEY_TEXTS:
                    c = F.upper(c)
            return c.alias(f.name)

        return df.select(*[clean(f) for f in df.schema])


# Text columns that are compared with other text.
KEY_TEXTS = {"crd", "serial_number", "material", "vendor", "mpn", "grn", "test_status", "component_type"}

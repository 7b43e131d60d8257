"""Manufacturing tables derived from the star-schema test tables.

A table is derived once per application and written to the shared checkpoint folder, so that
queries read plain Parquet: filters and column lists reach the scan, and nothing is recomputed
when an executor is lost.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lotwise.sources.schemas import LOOKUPS
from lotwise.sources.staging import give_back, shared_folder
from lotwise.sources.star_recipes import RECIPES
from lotwise.sources.tables import Tables

STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Tables that grow with the scale factor.
LARGE = {
    "wp_wip", "wp_wip_route_steps", "wp_assembly_route_wip", "ct_component_use", "ct_component_use_bins",
    "qm_grn_replacement", "qm_test_data", "qm_data_rec", "qm_data_analysis", "qm_analysis", "qm_repair",
}

# Helper columns of the recipes that are not part of the model.
HELPERS = ("part_key",)

# The two records per test, without joining the tests to another table.
SPARK_FORM = {
    "qm_data_rec": """
        SELECT wip_id, process_id, process_id*2 + r AS data_id, part_key, concat('DL', r) AS data_label
        FROM qm_test_data LATERAL VIEW explode(sequence(0, 1)) records AS r
        WHERE test_status <> 'P'
    """
}

_written: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def needs(name: str) -> list[str]:
    """Tables a recipe reads, star tables included."""
    words = set(re.findall(r"\b[a-z_]+\b", RECIPES[name]))
    return [n for n in (*STAR, *RECIPES) if n in words and n != name]


# Input per core from which a scan of lineitem has work for every core as it is.
PER_CORE = 4_000_000


def _spread(spark: SparkSession, sf_dir: str) -> bool:
    """Whether lineitem is large enough for the scan's own splits. Files then need not be dealt again."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/lineitem.parquet")
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return size >= PER_CORE * spark.sparkContext.defaultParallelism


def _splits(spark: SparkSession, sf_dir: str) -> int:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").rdd.getNumPartitions()


def derive(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, T.StructType]:
    """Write one derived table, and those it reads, unless this application has done so. Returns
    its folder and schema, so that reading it needs no look into the files."""
    app = spark.sparkContext.applicationId
    key = (app, sf_dir, name)
    if key not in _written:
        # Own temp views and own settings, so the caller's session stays as it is.
        session = spark.newSession()
        session.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
        for n in needs(name):
            if n in STAR:
                df = session.read.parquet(f"{sf_dir}/{n}.parquet")
            else:
                path, schema = derive(spark, sf_dir, n)
                df = session.read.schema(schema).parquet(path)
            df.createOrReplaceTempView(n)
        path = star_folder(spark, sf_dir, name)
        rows = session.sql(SPARK_FORM.get(name, RECIPES[name]))
        if name in LARGE and not _spread(spark, sf_dir):
            # At least one file per core, so that small scale factors are read in parallel too.
            rows = rows.repartition(max(_splits(spark, sf_dir), spark.sparkContext.defaultParallelism))
        rows.write.mode("overwrite").parquet(path)
        _written[key] = (path, rows.schema)
        if name in LARGE:
            del df, rows
            give_back(spark)
    return _written[key]


def star_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where this application keeps what it has derived from the files in ``sf_dir``."""
    return f"{shared_folder(spark)}/{zlib.crc32(sf_dir.encode()):08x}/{name}"


def star_tables(spark: SparkSession, sf_dir: str) -> Tables:
    def load(name: str) -> DataFrame:
        path, schema = derive(spark, sf_dir, name)
        return spark.read.schema(schema).parquet(path).drop(*HELPERS)

    return Tables(load, absent=[name for name in LOOKUPS if name not in RECIPES])

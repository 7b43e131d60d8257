import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lotwise.session import local_session  # noqa: E402
from lotwise.sources.star import star_tables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "lotwise-tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def star(spark):
    return star_tables(spark, SMALL)


@pytest.fixture(scope="module")
def interpreted(spark):
    """Compiling and replanning a plan takes longer than running it on a handful of rows."""
    off = {
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.sql.adaptive.enabled": "false",
    }
    for k, v in off.items():
        spark.conf.set(k, v)
    yield
    for k in off:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.adaptive.enabled", "true")

"""Lists as literals and as relations give the same rows."""

import pytest
from plant import empty_tables

from lotwise.operators import filters


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(k, f"t{k}") for k in range(50)] + [(None, None)], "k int, name string")


def ids(df):
    return sorted(r["k"] for r in df.collect())


@pytest.mark.parametrize("literals", [0, 500])
def test_members(spark, rows, monkeypatch, literals):
    monkeypatch.setattr(filters, "LITERALS", literals)
    lookup = rows.filter("k % 2 = 0").select(rows.k.alias("key"))
    assert ids(filters.member_if(rows, "k", [1, 2, 2, 99])) == [1, 2]
    assert ids(filters.member_if(rows, "name", ["t7", "t8", "T9"])) == [7, 8]
    assert ids(filters.optional_in(rows, "k", [1, 2, 4, 99], lookup, "key")) == [2, 4]
    assert len(ids(filters.optional_not_in(rows, "k", [1, 2, 4, 99], lookup, "key"))) == 48
    plan = filters.member_if(rows, "k", range(40))._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftSemi" in plan) == (literals == 0)


def test_given_as_dataframe(spark, rows):
    wanted = spark.createDataFrame([("1",), ("3",), ("3",), (None,)], "v string")
    assert ids(filters.member_if(rows, "k", wanted)) == [1, 3]
    assert ids(filters.optional_in(rows, "k", wanted, rows.filter("k > 1"))) == [3]
    assert ids(filters.member_if(rows, "k", wanted.limit(0))) == []


def test_empty_list_keeps_all(rows):
    assert filters.member_if(rows, "k", []) is rows
    assert filters.optional_in(rows, "k", (), rows) is rows and filters.optional_not_in(rows, "k", (), rows) is rows


def test_long_list_is_broadcast_only_below_the_threshold(spark, rows):
    many = list(range(5000))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def plan(threshold):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        return filters.member_if(rows, "k", many)._jdf.queryExecution().sparkPlan().toString()

    try:
        assert "Broadcast" in plan("10485760") and "Broadcast" not in plan("1000")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert empty_tables(spark)["wp_wip"].count() == 0

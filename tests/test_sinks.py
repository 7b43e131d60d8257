import datetime as dt

from lotwise.sources import sinks

AS_OF = dt.datetime(2025, 1, 9, 8)


def test_audit(spark, tmp_path):
    path = str(tmp_path / "audit")
    for _ in range(2):
        sinks.write_audit(spark, path, "test_history", 5, AS_OF, AS_OF + dt.timedelta(milliseconds=1500))
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2 and rows[0].elapsed_ms == 1500 and rows[0].start_time == AS_OF


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("C1", "G1")], "crd string, grn string")
    folder = sinks.export_detail(df, str(tmp_path), "2025-01-08")
    assert folder.endswith("detail_2025-01-08")
    assert spark.read.csv(folder, header=True).collect() == df.collect()
    rows = [("p", "s", "m", 1, "Detail"), (None, None, None, 1, "Total")]
    week = spark.createDataFrame(rows, "customer_part string, supplier string, mpn string, q int, row_type string")
    folder = sinks.export_weekly(week, str(tmp_path), dt.date(2025, 1, 9))
    assert folder.endswith("weekly_2025-01-06")
    assert [r.row_type for r in spark.read.csv(folder, header=True).collect()] == ["Detail", "Total"]


def test_large_input_is_not_dealt_again(spark, monkeypatch):
    from conftest import SMALL

    from lotwise.sources import star

    assert not star._spread(spark, SMALL)
    dealt = star.star_tables(spark, SMALL)["qm_repair"]
    monkeypatch.setattr(star, "PER_CORE", 1)
    assert star._spread(spark, SMALL)
    again = star.star_tables(spark, f"{SMALL}/.")["qm_repair"]
    assert sorted(map(str, again.collect())) == sorted(map(str, dealt.collect()))
    assert len(again.inputFiles()) < len(dealt.inputFiles())

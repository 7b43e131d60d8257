import datetime as dt

import pytest

from lotwise.jobs import run_daily
from lotwise.sources.report_store import ReportStore
from lotwise.sources.tables import Tables

DAY = dt.date(2025, 1, 8)


def test_daily_job(spark, star, tmp_path):
    history, audit = str(tmp_path / "history"), str(tmp_path / "audit")

    def run(t, **kw):
        return run_daily(spark, t, history, audit, 5, **{"start": DAY, "as_of": dt.datetime(2025, 1, 9, 8), **kw})

    assert run(star) == []
    store = ReportStore(spark, history)
    first = store.days()
    rows = sorted(map(str, first.collect()))
    assert rows and {r.start_date for r in first.select("start_date").distinct().collect()} == {DAY}
    # A rerun leaves one copy.
    run(star)
    assert sorted(map(str, store.days().collect())) == rows
    assert [(r.user_id, n) for r, n in [(spark.read.parquet(audit).first(), spark.read.parquet(audit).count())]] == [(5, 2)]
    # A rerun without any row empties the day.
    names = ("wp_wip_route_steps", "qm_grn_replacement", "qm_repair")
    run(Tables(lambda name: star[name].limit(0) if name in names else star[name]))
    assert store.days().count() == 0 and store.index().days == {DAY: []} and store.index().weeks == {}
    # Days past retention go.
    run(star)
    assert run(star, start=dt.date(2025, 1, 9), as_of=dt.datetime(2027, 1, 20)) == [DAY, dt.date(2025, 1, 9)]


def test_window_guard_runs_first(spark, star, tmp_path):
    with pytest.raises(ValueError):
        run_daily(spark, star, str(tmp_path / "h"), str(tmp_path / "a"), 5, start=DAY, end=DAY)
    assert not any(tmp_path.iterdir())

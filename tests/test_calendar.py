import datetime as dt

from shelfmark import ReportCalendar
from shelfmark.functions.windows import LY, TY, in_calendar_year, ytd_window
from shelfmark.sources.fixtures import FIXTURE_CALENDAR


def test_iso_week_defaults():
    cal = ReportCalendar.for_date(dt.date(2025, 6, 15))
    assert cal.ty_start == dt.date(2024, 12, 30)
    assert cal.ly_start == dt.date(2024, 1, 1)
    assert cal.ly_end == dt.date(2024, 6, 17)
    assert (cal.novelty_cutoff_ty, cal.novelty_cutoff_ly) == (dt.date(2024, 12, 25), dt.date(2023, 12, 25))
    assert cal.profile_year == 2025


def test_leap_day():
    assert ReportCalendar.for_date(dt.date(2024, 2, 29)).ly_end == dt.date(2023, 3, 2)


def test_fixture_calendar():
    assert FIXTURE_CALENDAR.ty_start == dt.date(2001, 1, 1)
    assert FIXTURE_CALENDAR.ly_start == dt.date(2000, 1, 3)
    assert FIXTURE_CALENDAR.ly_end == dt.date(2000, 7, 3)


def test_windows_on_dates_and_timestamps(spark):
    cal = FIXTURE_CALENDAR
    days = ["2000-01-02", "2000-01-03", "2000-07-03", "2000-07-04", "2000-12-31", "2001-01-01", "2001-06-30", "2001-07-01"]
    for cast in ("DATE", "TIMESTAMP_NTZ", "TIMESTAMP"):
        df = spark.createDataFrame([(d,) for d in days], "s string").selectExpr("s", f"CAST(s AS {cast}) AS d")

        def kept(condition):
            return [r.s for r in df.filter(condition).orderBy("s").collect()]

        assert kept(ytd_window("d", cal, LY)) == ["2000-01-03", "2000-07-03"]
        assert kept(ytd_window("d", cal, TY)) == ["2001-01-01", "2001-06-30"]
        assert kept(ytd_window("d", cal, TY, bounded=False)) == ["2001-01-01", "2001-06-30", "2001-07-01"]
        assert kept(in_calendar_year("d", cal)) == ["2001-01-01", "2001-06-30", "2001-07-01"]


def test_last_day_of_the_window_includes_its_evening(spark):
    late = spark.sql("SELECT TIMESTAMP_NTZ'2000-07-03 23:59:59' AS d")
    assert late.filter(ytd_window("d", FIXTURE_CALENDAR, LY)).count() == 1

import datetime as dt

import pytest
from pyspark.sql import functions as F

from estate_helpers import AS_OF, ms, rows
from tallyboard.functions import numbers, text, time
from tallyboard.functions.html import extract_rows


def values(spark, column, *inputs, ddl="x string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(column.alias("v")).collect()]


def test_percent_rounds_half_up_and_is_null_on_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 800), (5, 0), (None, 4)], "n int, d int")
    assert [r[0] for r in df.select(numbers.percent(F.col("n"), F.col("d"))).collect()] == [33.33, 0.13, None, None]


def test_loose_real(spark):
    got = values(spark, numbers.loose_real(F.col("x")), "12.5", " 7", "12abc", "None", "", "-3e2", None)
    assert got == [12.5, 7.0, 12.0, 0.0, 0.0, -300.0, None]


def test_items_in(spark):
    assert values(spark, numbers.items_in(F.col("x")), "a", "a,b,c", "") == [1, 3, 1]


@pytest.mark.parametrize("given, want", [
    ("2023-11-03T10:00:00.000+0000", dt.datetime(2023, 11, 3, 10)),
    ("2023-11-03T10:00:00.250Z", dt.datetime(2023, 11, 3, 10, 0, 0, 250000)),
    ("2023-11-03T23:30:00-01:00", dt.datetime(2023, 11, 4, 0, 30)),
    ("2023-11-03T00:30:00+05:30", dt.datetime(2023, 11, 2, 19)),
    ("2023-11-03", dt.datetime(2023, 11, 3)),
    ("soon", None),
])
def test_iso_utc(spark, given, want):
    assert values(spark, time.iso_utc(F.col("x")), given) == [want]


def test_no_result_depends_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        stamp = time.iso_utc(F.col("x"))
        assert values(spark, time.ntz_to_ms(stamp), "2024-03-10T07:30:00Z") == [ms(2024, 3, 10, 7, 30)]
        assert values(spark, time.ms_to_date(F.col("x")), ms(2024, 1, 1), ms(2024, 1, 1) - 1, ddl="x bigint") == [
            dt.date(2024, 1, 1), dt.date(2023, 12, 31)]
        assert values(spark, time.ms_to_ntz(F.col("x")), ms(2024, 1, 1, 5), ddl="x bigint") == [dt.datetime(2024, 1, 1, 5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("given, want", [
    ("Jan 23", dt.date(2023, 1, 1)), ("March, 2024", dt.date(2024, 3, 1)), (" Sept 2025 ", dt.date(2025, 9, 1)),
    ("", None), (None, None), ("2024", None), ("Foo 24", None),
])
def test_month_year(spark, given, want):
    assert values(spark, time.month_year(F.col("x")), given) == [want]


def test_calendar_days_ignore_the_hour(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 23:59:00' a, timestamp_ntz'2024-01-02 00:01:00' b")
    assert df.select(time.calendar_days(F.col("a"), F.col("b"))).first()[0] == 1


def test_whole_days_since_truncates(spark):
    got = values(spark, time.whole_days_since(F.col("x"), AS_OF), ms(2024, 1, 31, 12), ms(2024, 1, 30, 12, 0, 1), ms(2024, 1, 24, 12), ddl="x bigint")
    assert got == [0, 0, 7]


def test_text_rules(spark):
    assert values(spark, text.strip_tags(F.col("x")), "<b>on</b> <i x=1>all</i>") == ["on all"]
    assert values(spark, text.version_family(F.col("x")), "3.8.0.627") == ["3.8"]
    assert values(spark, text.os_code(F.col("x")), "tag_win", "WINDOWS", "Linux") == ["WIN", "WIN", "LIN"]
    assert values(spark, text.drop_wildcard(F.col("x")), "3.7.x", "3.7") == ["3.7", "3.7"]


def test_display_cell(spark):
    got = values(spark, text.display_cell(F.col("x")), "1706659200000", "612272122559", "12.5", "abc", None)
    assert got == ["2024-01-31", "612272122559", "12.5", "abc", None]
    assert values(spark, text.cell_number(F.col("x")), "12.5", "3", "3a", None) == [12.5, 3.0, None, None]


def test_version_family(spark):
    assert values(spark, text.version_family(F.col("x")), "3.8.0.627", "3.10.0.1", "3", None) == ["3.8", "3.10", "3", None]


def test_unfinished_html_keeps_its_last_cell():
    assert extract_rows("<tbody><tr><td>AT&T", "tbody", "tr", "td") == [["AT&T"]]


def test_html_rows():
    html = """<table><thead><tr><th>h</th></tr></thead><tbody>
      <tr><td>3.7</td><td>Jan&nbsp;23</td><td></td></tr><tr><td> </td></tr><tr><td></td><td></td></tr>
      <tr><td><b>3.8</b> &amp; up<td>open cell</tr></tbody></table><tr><td>outside</td></tr>"""
    assert extract_rows(html, "tbody", "tr", "td") == [["3.7", "Jan\xa023", ""], [" "], ["3.8 & up", "open cell"]]
    assert extract_rows(None, "tbody", "tr", "td") == []

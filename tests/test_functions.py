from datetime import date

from pyspark.sql import functions as F

from termloom.functions import dates, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_times(spark):
    for raw, want in [("14:00", "14:00"), ("2:00 PM", "14:00"), ("오후 2시 30분", "14:30"), ("12 am", "00:00"), ("25:00", None), ("soon", None), (None, None)]:
        assert one(spark, raw, dates.normalize_time) == want


def test_dates(spark):
    for raw, want in [("2026.10.27", "2026-10-27"), ("10월 27일", "10-27"), ("27th Oct 2026", "2026-10-27"), ("2026-13-01", None), ("8/6", None), (None, None)]:
        assert one(spark, raw, dates.normalize_date) == want


def test_weekdays_weeks_and_ranges(spark):
    assert one(spark, "월욜", dates.normalize_weekday) == "Monday"
    assert one(spark, "xyz", dates.normalize_weekday) is None
    for raw, want in [("3", 3), ("3주차", 3), ("제3주", 3), ("week 3 (x)", 3), ("31", None), ("topic", None)]:
        assert one(spark, raw, dates.parse_week) == want
    assert one(spark, "9시부터 10시까지", dates.normalize_range_separators) == "9시~10시"
    assert one(spark, date(2026, 9, 3), lambda d: dates.first_on_or_after(d, F.lit(1)), "date") == date(2026, 9, 8)


def test_text(spark):
    assert one(spark, "SSyyllllaabbuuss\nhello", text.repair_doubled_runs) == "Syllabus\nhello"
    assert one(spark, "a.b [at] x.org, A.B@x.org", text.emails) == ["a.b@x.org"]
    assert one(spark, "tel 02-123-4567", text.phones) == ["02-123-4567"]
    assert one(spark, "Page 1 of 2 https://a.b/c 10:30 AM", text.is_low_content) is True
    assert one(spark, None, text.is_low_content) is True


def test_pipe_tables(spark):
    d = spark.createDataFrame([(1, "a|b\nc|d\n\ne|f"), (2, "none"), (3, None)], "doc_id int, text string")
    got = sorted((r.doc, r.table_no, r.row_no, tuple(r.cells)) for r in text.pipe_tables(d).collect())
    assert got == [(1, 1, 1, ("a", "b")), (1, 1, 2, ("c", "d")), (1, 2, 1, ("e", "f"))]

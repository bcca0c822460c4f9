"""Knowledge-base joins: periods to clock times, weeks to dates. The dimensions are configuration, checked before use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.dates import weekday_index, zero_pad

#: Dimensions are broadcast up to this many rows; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000


def _dim(dim: DataFrame) -> DataFrame:
    return F.broadcast(dim) if dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else dim


def resolve_periods(refs: DataFrame, periods: DataFrame) -> DataFrame:
    """refs (id, tt_key, periods: array<int>) with start, end, resolved_by, needs_review.

    periods: tt_key, period (may be fractional, `1.0`), start, end. All periods of a reference must be found.
    """
    p = _dim(periods.select("tt_key", F.col("period").cast("double").alias("period"), zero_pad(F.col("start")).alias("start"), zero_pad(F.col("end")).alias("end")))
    x = refs.select("id", "tt_key", F.explode_outer("periods").alias("n")).withColumn("period", F.col("n").cast("double")).join(p, ["tt_key", "period"], "left")
    got = x.groupBy("id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.every(F.col("start").isNotNull()).alias("all"))
    ok = F.col("all")
    return got.select("id", F.when(ok, F.col("start")).alias("start"), F.when(ok, F.col("end")).alias("end"), F.when(ok, "period_kb").alias("resolved_by"), (~ok).alias("needs_review"))


def resolve_weeks(refs: DataFrame, calendars: DataFrame) -> DataFrame:
    """refs (id, cal_key, week, weekday) with resolved_date, is_holiday, makeup_date, resolved_by, needs_review, reason.

    calendars: cal_key, term_start date, confidence, holidays and school_holidays array<date>, makeup map<date,date>.
    Only a term start of high confidence gives dates.
    """
    x = refs.join(_dim(calendars), "cal_key", "left")
    wd = weekday_index(F.col("weekday"))
    reason = F.when(F.col("term_start").isNull(), "calendar_missing").when(~F.lower(F.coalesce("confidence", F.lit("high"))).isin("high", "높음"), "low_confidence").when(wd.isNull(), "unknown_weekday")
    day = F.when(reason.isNull(), F.date_add(F.trunc("term_start", "week"), 7 * (F.col("week") - 1) + wd))
    x = x.withColumns({"resolved_date": day, "reason": reason})
    off = F.coalesce(F.array_contains(F.array_union("holidays", "school_holidays"), F.col("resolved_date")), F.lit(False))
    x = x.withColumn("is_holiday", off).withColumn("makeup_date", F.when(F.col("is_holiday"), F.try_element_at("makeup", F.col("resolved_date"))))
    lost = F.col("is_holiday") & F.col("makeup_date").isNull()
    return x.select("id", "resolved_date", "is_holiday", "makeup_date", F.when(F.col("resolved_date").isNotNull(), "academic_calendar_kb").alias("resolved_by"), (F.col("reason").isNotNull() | lost).alias("needs_review"), F.coalesce("reason", F.when(lost, "holiday_without_makeup")).alias("reason"))


def host_suffix_join(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """host, school: hosts that equal a domain or end with a dot and it; an equi-join on the suffixes of each host.

    A host that matches several schools gets none.
    """
    parts = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    x = hosts.select("host").distinct().select("host", suffix.alias("domain")).join(_dim(domains), "domain")
    return x.groupBy("host").agg(F.count_distinct("school").alias("n"), F.min("school").alias("school")).where("n = 1").select("host", "school")


def check_timetables(periods: DataFrame) -> DataFrame:
    """Rows that break start < end; a load with any is refused by the caller."""
    return periods.where(~(zero_pad(F.col("start")) < zero_pad(F.col("end"))) | F.col("start").isNull() | F.col("end").isNull())

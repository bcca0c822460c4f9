"""Weekly plans and calendars: alignment checks, date grouping, event de-duplication and the ICS sink."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plan_issues(rows: DataFrame) -> DataFrame:
    """Per plan (plan_id) the issues of its rows (week, topic, seq): what keeps a weekly plan from being trusted."""
    last = lambda value, order: F.lag(value).over(Window.partitionBy("plan_id").orderBy(order))
    x = rows.select("plan_id", "week", F.nullif(F.trim("topic"), F.lit("")).alias("topic"), last("week", "seq").alias("prev"))
    # Distinct values are counted where they begin in their order: an expansion would take another two shuffles of the rows.
    x = x.withColumns({"week_before": last("week", "week"), "topic_before": last("topic", "topic")})
    fresh = lambda c: F.count_if(F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"{c}_before")))
    a = x.groupBy("plan_id").agg(
        F.count("week").alias("n"), fresh("week").alias("d"), F.min("week").alias("lo"), F.max("week").alias("hi"),
        F.count_if(F.col("week") < F.col("prev")).alias("back"), F.count_if(F.col("topic").rlike(r"^\d{1,2}[./-]\d{1,2}|\.(?:pdf|pptx?|docx?)$")).alias("shift"),
        F.count("topic").alias("topics"), fresh("topic").alias("kinds"),
    )
    flag = lambda ok, name: F.when(ok, F.lit(name))
    none = F.col("n") == 0
    issues = F.array_compact(
        F.array(
            flag(none, "no_week_numbers"), flag(F.col("d") < F.col("n"), "duplicate_weeks"), flag(F.col("back") > 0, "weeks_not_monotonic"),
            flag(~none & ~((F.col("d") == F.col("n")) & (F.col("hi") - F.col("lo") + 1 == F.col("n"))), "week_gap"),
            flag(F.col("shift") >= 2, "column_shift"), flag((F.col("topics") >= 5) & (F.col("kinds") == 1), "uniform_topic"),
        )
    )
    return a.select("plan_id", F.col("n").alias("n_rows"), F.col("hi").alias("total_weeks"), issues.alias("issues"))


def plan_from_rows(issues: DataFrame, allow_gap: bool = True) -> DataFrame:
    """What becomes of each plan: kept, kept and flagged, week count only, or nothing."""
    only = lambda name: (F.size("issues") == 1) & (F.get("issues", F.lit(0)) == name)
    fate = F.when(F.size("issues") == 0, "kept").when(only("uniform_topic"), "weeks_only").when(only("week_gap") & F.lit(allow_gap), "flagged").otherwise("dropped")
    return issues.withColumn("fate", fate).withColumn("total_weeks", F.when(F.col("fate") != "dropped", F.col("total_weeks")))


def rows_from_dates(entries: DataFrame, least: int = 3) -> DataFrame:
    """doc_id, week, monday, topics: dated entries (doc_id, day, topic) by calendar week, at least `least` of them."""
    x = entries.withColumn("monday", F.to_date(F.trunc("day", "week")))
    per = Window.partitionBy("doc_id")
    x = x.withColumns({"first": F.min("monday").over(per), "n": F.count("*").over(per)}).where(F.col("n") >= least)
    g = x.groupBy("doc_id", "monday", "first").agg(F.array_sort(F.collect_set("topic")).alias("t"))
    return g.select("doc_id", (F.date_diff("monday", "first") / 7 + 1).cast("int").alias("week"), "monday", F.array_join("t", " / ").alias("topics"))


def merge_adjacent(events: DataFrame, gap: int = 30) -> DataFrame:
    """Runs of events (doc_id, page, type, char_start, char_end, title) of one type on a page, at most gap apart.

    An event of another type in between ends a run. Events that tie in position, type and title share a run. Of the
    titles the shortest stays, and a resolved_date, if there is such a column, is inherited by the run.
    """
    w = Window.partitionBy("doc_id", "page").orderBy("char_start", "char_end", "type", "title")
    new = (F.col("type") != F.lag("type").over(w)) | (F.col("char_start") - F.lag("char_end").over(w) > gap)
    x = events.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
    x = x.withColumn("run", F.sum("new").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    dated = [F.min_by("resolved_date", F.when(F.col("resolved_date").isNotNull(), F.col("char_start"))).alias("resolved_date")] if "resolved_date" in events.columns else []
    return x.groupBy("doc_id", "page", "run").agg(F.first("type").alias("type"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.min_by("title", F.struct(F.length("title"), "char_start", "title")).alias("title"), F.count("*").alias("merged"), *dated)


def drop_undated_when_dated(events: DataFrame) -> DataFrame:
    """Undated midterms and finals go where a dated one of the document exists."""
    dated = F.max(F.col("resolved_date").isNotNull().cast("int")).over(Window.partitionBy("doc_id", "type"))
    x = events.withColumn("__d", dated)
    return x.where(~(F.col("type").isin("midterm", "final") & F.col("resolved_date").isNull() & (F.col("__d") == 1))).drop("__d")


def merge_by_priority(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of events, those of the first source before those of the second with the same title and week or text."""
    x = first.withColumn("__p", F.lit(0)).unionByName(second.withColumn("__p", F.lit(1)))
    key = [F.col("doc_id"), F.substring("title", 1, 24), F.coalesce(F.col("week").cast("string"), F.col("raw"))]
    return x.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy("__p", "raw"))).where("__r = 1").drop("__r", "__p")


def ics_escape(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    for a, b in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\n", "\\n")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


@F.pandas_udf(T.StringType())
def ics_fold(lines: pd.Series) -> pd.Series:
    """Lines of at most 75 octets, cut between characters; continuation lines start with a blank."""

    def fold(s: str) -> str:
        out, room, cur = [], 75, ""
        for c in s:
            n = len(c.encode())
            if n > room:
                out.append(cur)
                cur, room = "", 74
            cur += c
            room -= n
        return "\r\n ".join([*out, cur])

    return lines.map(fold)


def until_utc(day: Column) -> Column:
    """End of a day in Seoul, nine hours ahead, as a UTC stamp."""
    return F.date_format(F.to_timestamp(F.concat(day.cast("string"), F.lit(" 23:59:59"))) - F.expr("interval 9 hours"), "yyyyMMdd'T'HHmmss'Z'")


def ics_events(events: DataFrame) -> DataFrame:
    """doc_id, ics: one calendar per document of confirmed events (uid, title, day, and for meetings start, end, until, exdates)."""
    stamp = lambda d, t: F.concat(F.date_format(d, "yyyyMMdd"), F.lit("T"), F.replace(t, F.lit(":"), F.lit("")), F.lit("00"))
    timed = F.col("start").isNotNull()
    zone = ";TZID=Asia/Seoul:"
    lines = F.array_compact(
        F.array(
            F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), "uid"), F.lit("DTSTAMP:19700101T000000Z"), ics_fold(F.concat(F.lit("SUMMARY:"), ics_escape(F.col("title")))),
            F.when(timed, F.concat(F.lit("DTSTART" + zone), stamp(F.col("day"), F.col("start")))).otherwise(F.concat(F.lit("DTSTART;VALUE=DATE:"), F.date_format("day", "yyyyMMdd"))),
            F.when(timed, F.concat(F.lit("DTEND" + zone), stamp(F.col("day"), F.col("end")))).otherwise(F.concat(F.lit("DTEND;VALUE=DATE:"), F.date_format(F.date_add("day", 1), "yyyyMMdd"))),
            F.when(F.col("until").isNotNull(), F.concat(F.lit("RRULE:FREQ=WEEKLY;UNTIL="), until_utc(F.col("until")))),
            F.when(F.size("exdates") > 0, F.concat(F.lit("EXDATE" + zone), F.array_join(F.transform("exdates", lambda d: stamp(d, F.col("start"))), ","))),
            F.lit("END:VEVENT"),
        )
    )
    per = events.select("doc_id", F.struct("day", "uid", F.array_join(lines, "\r\n").alias("s")).alias("x")).groupBy("doc_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    body = F.array_join(F.transform("x", lambda e: e["s"]), "\r\n")
    return per.select("doc_id", F.concat(F.lit("BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:-//termloom//EN\r\n"), body, F.lit("\r\nEND:VCALENDAR\r\n")).alias("ics"))

"""Plan tables with roles for columns, events of plan rows, undated events, compile guards and review sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.dates import parse_week

# What headers of weekly plans call their columns.
ROLES = {
    "week": r"(?i)^\s*(?:주차?|week(?:\s*no\.?)?|wk)\s*$",
    "dates": r"(?i)^\s*(?:기간|일자|날짜|dates?|period)\s*$",
    "topic": r"(?i)수업\s*내용|강의\s*내용|강의\s*주제|주제|topic|contents?|subject",
    "remarks": r"(?i)비고|과제|remarks?|notes?|assignments?",
}


def plan_rows(tables: DataFrame) -> DataFrame:
    """plan_id, seq, week, topic, remarks of tables (plan_id, header, rows) whose header names a week and a topic.

    A table without a header takes its first column as weeks where 3 and 60 % of its rows have one there, and the
    column with most text as topic.
    """
    where = lambda role: F.array_position(F.transform("header", lambda h: h.rlike(ROLES[role])), True).cast("int") - 1
    weeks = F.size(F.filter("rows", lambda r: parse_week(F.get(r, F.lit(0))).isNotNull()))
    bare = F.coalesce(F.size("header"), F.lit(0)) <= 0
    numeric = bare & (weeks >= F.greatest(F.lit(3), F.ceil(0.6 * F.size("rows"))))
    width = F.coalesce(F.array_max(F.transform("rows", lambda r: F.size(r))), F.lit(0))
    text_of = lambda i: F.aggregate("rows", F.lit(0), lambda n, r: n + F.coalesce(F.length(F.get(r, i)), F.lit(0)))
    others = F.when(width > 1, F.sequence(F.lit(1), width - 1))
    widest = F.array_max(F.transform(others, lambda i: F.struct(text_of(i).alias("n"), (-i).alias("i"))))
    x = tables.select("plan_id", "rows", *[F.when(~bare, where(r)).alias(r) for r in ROLES], numeric.alias("numeric"), (-widest["i"]).alias("widest"))
    x = x.withColumns({"week": F.when(F.col("numeric"), 0).otherwise(F.col("week")), "topic": F.when(F.col("numeric"), F.col("widest")).otherwise(F.col("topic"))})
    x = x.where("week >= 0 and topic >= 0").select("plan_id", *ROLES, F.posexplode("rows").alias("seq", "cells"))
    cell = lambda role: F.when(F.col(role) >= 0, F.nullif(F.trim(F.get("cells", F.col(role))), F.lit("")))
    return x.select("plan_id", "seq", parse_week(cell("week")).cast("int").alias("week"), cell("dates").alias("dates"), cell("topic").alias("topic"), cell("remarks").alias("remarks")).where("week is not null")


def event_kind(text: Column) -> Column:
    """struct<kind, type> a line speaks of: an assignment before an exam; null where class is off."""
    kind = lambda k, t: F.struct(F.lit(k).alias("kind"), F.lit(t).cast("string").alias("type"))
    return (
        F.when(text.rlike(r"(?i)휴강|공휴일|no\s+class|holiday"), None)
        .when(text.rlike(r"(?i)과제|레포트|assignment|homework"), kind("assignment", None))
        .when(text.rlike(r"(?i)중간\s*(?:고사|시험)|mid-?term"), kind("exam", "midterm"))
        .when(text.rlike(r"(?i)기말\s*(?:고사|시험)|final\s+exam"), kind("exam", "final"))
        .when(text.rlike(r"(?i)퀴즈|quiz"), kind("exam", "quiz"))
    )


def events_from_rows(rows: DataFrame) -> DataFrame:
    """plan_id, week, kind, type, title of plan rows; one per week, kind and type, topics before remarks."""
    x = rows.select("plan_id", "week", "seq", F.posexplode(F.array("topic", "remarks")).alias("i", "title")).withColumn("e", event_kind(F.col("title"))).where("e is not null")
    first = F.min(F.struct("seq", "i", "title")).alias("f")
    return x.groupBy("plan_id", "week", F.col("e.kind").alias("kind"), F.col("e.type").alias("type")).agg(first).select("plan_id", "week", "kind", "type", F.col("f.title").alias("title"))


def squashed(title: Column) -> Column:
    return F.lower(F.regexp_replace(title, r"[^\p{L}\p{N}]+", ""))


def collapse_undated(events: DataFrame) -> DataFrame:
    """Dated events, and of the undated ones the first (seq) of each document, type and title that says something."""
    key = squashed(F.col("title"))
    weak = key.isNull() | key.rlike(r"(?i)^(?:|\d+|주차(?:week)?|week[월화수목금토일]?|[월화수목금토일])$")
    undated = events.where(F.col("resolved_date").isNull() & ~weak).withColumn("__k", key)
    w = Window.partitionBy("doc_id", "type", "__k").orderBy("seq")
    kept = undated.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__k")
    return events.where("resolved_date is not null").unionByName(kept)


def document_years(events: DataFrame) -> DataFrame:
    """doc_id, doc_year: the academic year, else the most frequent year of dates, the smaller of a tie."""
    n = events.groupBy("doc_id", F.year("resolved_date").alias("y")).agg(F.count("*").alias("n"), F.max("academic_year").alias("a"))
    best = F.max(F.when(F.col("y").isNotNull(), F.struct("n", (-F.col("y")).alias("y"))))
    return n.groupBy("doc_id").agg(F.coalesce(F.max("a"), -best["y"]).cast("int").alias("doc_year"))


def compile_events(events: DataFrame, current_year: int | None = None) -> DataFrame:
    """events (doc_id, title, resolved_date, needs_review, academic_year) with day, bucket and reason; guards in order."""
    x = events.join(document_years(events), "doc_id")
    d, t, a = F.col("resolved_date"), F.coalesce(F.trim("title"), F.lit("")), F.col("academic_year")
    x = x.withColumn("day", F.when(F.year(d) == a - 1, F.add_months(d, 12)).otherwise(d))
    reason = (
        F.when(t.rlike(r"(?i)^(?:\d{1,2}\s*주차?|week\s*\d{1,2})$"), "week_marker")
        .when(t.rlike(r"(?i)매주|every\s+week|weekly"), "recurring")
        .when((t == "") | t.rlike(r"^\P{L}+$"), "no_event_title")
        .when(F.abs(F.year("day") - F.col("doc_year")) > 1, "year_apart")
        .when(F.year("day") < F.lit(current_year), "past")
        .when(F.col("day").isNull(), "undated")
        .when(F.coalesce("needs_review", F.lit(False)), "needs_review")
    )
    return x.withColumn("reason", reason).withColumn("bucket", F.when(reason.isNull(), "confirmed").otherwise("review"))


def round_robin(rows: DataFrame, label: str, key: str, order: list[str], n: int, twice: list[str] = ()) -> DataFrame:
    """n rows taken from the labels by turns in the given order, two a turn from those in `twice`; by key within one."""
    w = Window.partitionBy(label).orderBy(key)
    per = F.when(F.col(label).isin(*twice), 2).otherwise(1) if twice else F.lit(1)
    at = F.array_position(F.array(*map(F.lit, order)), F.col(label))
    first = rows.where(F.col(label).isin(*order)).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n)  # no label gives more
    return first.withColumn("turn", F.ceil(F.col("__r") / per).cast("int")).drop("__r").orderBy("turn", at, key).limit(n)

"""Event guards: what a document doesn't state is no event, what is scheduled already is not listed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.dates import normalize_date
from termloom.operators.candidates import date_kind

# Signs that a loose comparison leaves out.
SEPARATORS = r"(?U)[\s|;:,.()\[\]~\-–—/]+"
# Words of grading rubrics; a title of these alone names no assignment.
RUBRIC = [
    "출석", "발표", "참여", "토론", "퀴즈", "과제", "과제물", "보고서",
    "attendance", "presentation", "presentations", "participation", "quiz", "quizzes", "class", "regular", "optional", "and", "or", "etc",
    "assignment", "assignments", "individual", "weekly", "team", "report", "reports", "project", "projects", "problem", "set", "sets",
]
# The shapes of dates that count as evidence, and the mark of a week without class.
DATE_SHAPES = [
    r"\d{4}\s*[.\-/]\s*\d{1,2}\s*[.\-/]\s*\d{1,2}",
    r"(?:\d{4}\s*년\s*)?\d{1,2}\s*월\s*\d{1,2}\s*일",
    r"(?i)\d{1,2}(?:st|nd|rd|th)?\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*(?:\s+\d{4})?",
]
MONTH_DAY = r"\d{1,2}\s*[./-]\s*\d{1,2}(?![./-]?\d)"
NO_SESSION = r"(?i)no\s*(?:lab|class)|수업\s*없음|실험\s*없음|휴강"


def loose(text: Column) -> Column:
    """Lower case without separators; null is empty."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, ""))


def is_generic_title(title: Column) -> Column:
    """Whether a title has words and all of them are those of a rubric."""
    words = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit("[a-z가-힣]+"), F.lit(0))
    return (F.size(words) > 0) & F.forall(words, lambda w: w.isin(RUBRIC))


def document_dates(text: Column) -> Column:
    """The dates that a text states, as YYYY-MM-DD or MM-DD, distinct."""
    t = F.coalesce(text, F.lit(""))
    full = F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in DATE_SHAPES])
    short = F.transform(F.regexp_extract_all(t, F.lit(MONTH_DAY), F.lit(0)), lambda x: F.split(F.regexp_replace(x, r"\s", ""), "[./-]"))
    of = lambda p, i: F.get(p, F.lit(i)).cast("int")
    short = F.transform(short, lambda p: F.when(of(p, 0).between(1, 12) & of(p, 1).between(1, 31), F.format_string("%02d-%02d", of(p, 0), of(p, 1))))
    return F.array_distinct(F.array_compact(F.concat(F.transform(full, normalize_date), short)))


def is_evidenced(day: Column, dates: Column) -> Column:
    """Whether a date, or its month and day, is among the dates of a document."""
    return F.coalesce(F.array_contains(dates, day) | ((F.length(day) == 10) & F.array_contains(dates, F.substring(day, 6, 5))), F.lit(False))


def risk_gate(events: DataFrame, docs: DataFrame) -> DataFrame:
    """events (doc_id, seq, title, type, date_raw) with outlet, raw_reference, date_kind, resolved_date, needs_review.

    A title that the document (doc_id, text) doesn't state is dropped. Without a date, an assignment whose title is not
    generic goes to the outlet `undated`, an exam is a dated event of uncertain date, and anything else is dropped. An
    absolute date resolves only if the document states it; one that it doesn't state becomes uncertain.
    """
    known = docs.select("doc_id", loose(F.col("text")).alias("stated"), document_dates(F.col("text")).alias("dates"))
    title = F.substring(F.trim(F.coalesce("title", F.lit(""))), 1, 80)
    raw = F.nullif(F.nullif(F.trim("date_raw"), F.lit("")), F.lit("null"))
    x = events.withColumns({"title": title, "raw": raw, "type": F.when(F.col("type").isin("exam", "assignment"), F.col("type")).otherwise("other")}).join(known, "doc_id")
    x = x.where((F.col("title") == "") | F.contains("stated", loose(F.col("title"))))
    x = x.withColumns({"kind": date_kind(F.col("raw")), "iso": normalize_date(F.col("raw"))})
    found = is_evidenced(F.col("iso"), F.col("dates"))
    none = F.col("raw").isNull()
    outlet = F.when(~none | ((F.col("type") == "exam") & (F.col("title") != "")), "dated").when((F.col("type") == "assignment") & (F.col("title") != "") & ~is_generic_title(F.col("title")), "undated")
    absolute = ~none & (F.col("kind") == "absolute")
    resolved = F.when(absolute & found & (F.length("iso") == 10), F.col("iso"))
    kind = F.when(none | (absolute & F.col("iso").isNotNull() & ~found), "uncertain").otherwise(F.col("kind"))
    x = x.withColumns({"outlet": outlet, "resolved_date": resolved, "date_kind": kind}).where("outlet is not null")
    return x.select("doc_id", "seq", F.nullif("title", F.lit("")).alias("title"), "type", "outlet", F.coalesce("raw", F.lit("null")).alias("raw_reference"), "date_kind", "resolved_date", F.col("resolved_date").isNull().alias("needs_review"))


def _row_text(rows: DataFrame) -> DataFrame:
    """doc_id, line of plan rows (doc_id, topic, extras)."""
    return rows.select("doc_id", F.array_join(F.array_compact(F.concat(F.array("topic"), F.coalesce("extras", F.array().cast("array<string>")))), " ").alias("line"))


def _by_document(lines: DataFrame, name: str) -> DataFrame:
    """All loose lines of a document; as many as its plan has."""
    return lines.select("doc_id", loose(F.col("line")).alias("line")).where("line <> ''").groupBy("doc_id").agg(F.collect_set("line").alias(name))


def suppress_no_session_exams(events: DataFrame, rows: DataFrame) -> DataFrame:
    """events (doc_id, kind, title, raw_reference) but undated exams that a plan row without class names."""
    off = _by_document(_row_text(rows).where(F.col("line").rlike(NO_SESSION)), "off")
    title = loose(F.col("title"))
    undated = (F.col("kind") == "exam") & (F.coalesce("raw_reference", F.lit("null")) == "null")
    named = F.coalesce((title != "") & F.exists("off", lambda b: F.contains(b, title)), F.lit(False))
    return events.join(off, "doc_id", "left").where(~(undated & named)).select(*events.columns)


def suppress_scheduled(undated: DataFrame, dated: DataFrame, rows: DataFrame) -> DataFrame:
    """undated (doc_id, seq, title), the first of each loose title, but those that a dated event or a plan row has."""
    first = undated.withColumn("k", loose(F.col("title"))).where("k <> ''").groupBy("doc_id", "k").agg(F.min_by("title", "seq").alias("title"), F.min("seq").alias("seq"))
    events = _by_document(dated.select("doc_id", F.col("title").alias("line")), "events")
    x = first.join(events, "doc_id", "left").join(_by_document(_row_text(rows), "plan"), "doc_id", "left")
    k = F.col("k")
    has = F.coalesce(F.exists("events", lambda d: F.contains(d, k) | F.contains(k, d)), F.lit(False)) | F.coalesce(F.exists("plan", lambda w: F.contains(w, k)), F.lit(False))
    return x.where(~has).select("doc_id", "seq", "title")

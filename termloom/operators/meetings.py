"""Class meetings of records compiled against term calendars, and the summaries of their events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.dates import class_exdates, first_on_or_after

# The contract's notation of a slot, and titles that are labels or dates of a document.
SLOT = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+(\d{2}:\d{2})-(\d{2}:\d{2})$"
SHORT_DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
LABEL_TITLE = r"(?i)^\s*(?:\d{1,3}|week\s*\d+.*|제?\s*\d+\s*주차?.*|제출일|출제일|시험일|마감일?|날짜|일시)\s*$"
DOCUMENT_TITLE = r"(?i)출력일|인쇄일|작성일|발행일|갱신일|조회일|^Web\b|https?://|\bRetrieved\b|\bAccessed\b|\bdoi\b|\bpp?\.\s*\d|\d{4}[-.]\d{1,2}[-.]\d{1,2}\s*(?:오전|오후|am|pm)|유고\s*결석|무단\s*결석|출결|지각|조퇴|결석\s*\d"
EXAM_NAME = r"(?i)(?:중간고사|기말고사|중간시험|기말시험|기말|중간|퀴즈|quiz|midterm|final(?:\s*exam)?)\s*\d*"

SLOTS = "array<struct<day:string,start:string,end:string>>"
EVENT = "struct<bucket:string,kind:string,day:string,start:string,end:string,first:date,until:date,exdates:array<date>,reason:string>"


def parse_slots(notation: Column) -> Column:
    """Slots of `Mon 10:00-10:50 ; Wed 10:00-10:50`; none at all where a segment is of another form."""
    parts = F.filter(F.transform(F.split(F.coalesce(notation, F.lit("")), ";"), lambda s: F.trim(s)), lambda s: s != "")
    one = lambda s: F.struct(*[F.regexp_extract(s, SLOT, i).alias(n) for i, n in enumerate(("day", "start", "end"), 1)])
    return F.when(F.forall(parts, lambda s: s.rlike(SLOT)), F.transform(parts, one)).otherwise(F.array()).cast(SLOTS)


def event_summary(kind: Column, title: Column, course: Column) -> Column:
    """What an event is called: its title, the exam named in a long one, or the course where the title is a label."""
    t = F.coalesce(F.nullif(F.trim(title), F.lit("")), F.lit(""))
    label = F.when(kind == "exam", "시험").otherwise("과제")
    named = F.trim(F.regexp_extract(t, EXAM_NAME, 0))
    return F.when((t == "") | t.rlike(LABEL_TITLE), F.concat(F.coalesce(course, F.lit("수업")), F.lit(" ("), label, F.lit(")"))).when((kind == "exam") & (F.length(t) > 14) & (named != ""), named).otherwise(t)


def is_document_date(summary: Column) -> Column:
    """Whether a summary speaks of printing, citing or attendance, so that its date is no event."""
    return summary.rlike(DOCUMENT_TITLE)


def compile_meetings(records: DataFrame, calendars: DataFrame, office_hours: bool = False) -> DataFrame:
    """doc_id, bucket, kind, day, start, end, first, until, exdates, reason of the meetings of records.

    records: doc_id, status, raw_time, slots, several (sections), cal_key, and office (array of texts) if wanted;
    calendars: cal_key, term_start, term_end, weeks, holidays, school_holidays, confidence. Slots are a timetable in any
    case; they recur only in a term whose start is known with confidence, for 16 weeks if neither end nor weeks are
    given. Held without fixed times, a course has no meeting; what is open, mixed, unread or unstated goes to review.
    """
    ok = F.lower(F.coalesce("confidence", F.lit("high"))).isin("high", "높음") & F.col("term_start").isNotNull()
    end = F.coalesce("term_end", F.date_add("term_start", 7 * F.coalesce("weeks", F.lit(16)) - 1))
    none = F.array().cast("array<date>")
    cal = calendars.where(ok).select("cal_key", "term_start", end.alias("until"), F.coalesce("holidays", none).alias("holidays"), F.coalesce("school_holidays", none).alias("school_holidays"))
    x = records.join(cal, "cal_key", "left")
    several, status = F.coalesce("several", F.lit(False)), F.col("status")
    slots = F.coalesce("slots", F.array().cast(SLOTS))
    read = (F.size(slots) > 0) & F.col("raw_time").isNotNull() & ~several & ~F.coalesce(status.isin("async", "tba"), F.lit(False))
    known = F.col("term_start").isNotNull()
    reason = (
        F.when(status == "async", None).when(status == "tba", "time_to_be_announced").when(several, "several_sections")
        .when(F.col("raw_time").isNotNull() & ~read, "time_not_read").when(read & ~known, "no_calendar").when(F.col("raw_time").isNull() & (status == "not_specified"), "time_not_stated")
    )

    nothing = F.lit(None)
    event = lambda bucket, kind="class", day=nothing, start=nothing, end=nothing, first=nothing, until=nothing, ex=nothing, why=nothing: F.struct(
        F.lit(bucket).alias("bucket"), F.lit(kind).alias("kind"), day.alias("day"), start.alias("start"), end.alias("end"), first.alias("first"), until.alias("until"), ex.alias("exdates"), why.alias("reason")
    ).cast(EVENT)
    index = lambda d: F.array_position(F.array(*map(F.lit, SHORT_DAYS)), F.substring(d, 1, 3)).cast("int") - 1

    def recurring(s: Column) -> Column:
        first = first_on_or_after(F.col("term_start"), index(s["day"]))
        return event("confirmed", "class", s["day"], s["start"], s["end"], first, F.col("until"), class_exdates(first, F.col("until"), F.col("holidays"), F.col("school_holidays")))

    empty = F.array().cast(f"array<{EVENT}>")
    out = [
        F.when(read, F.transform(slots, lambda s: event("timetable", "class", s["day"], s["start"], s["end"]))).otherwise(empty),
        F.when(read & known, F.transform(slots, recurring)).otherwise(empty), F.when(reason.isNotNull(), F.array(event("review", why=reason))).otherwise(empty),
    ]
    if office_hours:
        out.append(F.coalesce(F.transform("office", lambda o: event("review", "office_hours", why=o)), empty))
    return x.select("doc_id", F.explode(F.concat(*out)).alias("e")).select("doc_id", "e.*")

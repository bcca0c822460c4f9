"""Weekly plans of documents: tables read by header or by week cells, fragments merged, dated tables and prose schedules.

A document's tables fit in one row; everything here is a column over that row, so nothing but the calendar years of a
document is joined. A null table, row or cell is an empty one; a document without a plan has none in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.dates import MONTHS, normalize_date, parse_week
from termloom.functions.text import once
from termloom.operators.lineage import computed

# What headers of weekly plans call their columns, explicit topics before contents.
WEEK_HEAD = r"(?i)^\s*(?:주\s*차?|week|wk|제?\s*\d*\s*주|차\s*시(?:\s*\(?times?\)?)?|회\s*차)\s*$"
DATE_HEAD = r"(?i)기간|날짜|일자|date|일정"
TOPIC_HEADS = [r"(?i)주제|제목|단원|topic|subject|title", r"(?i)내용|content"]
NO_TOPIC_HEAD = r"(?i)핵심어|키워드|keyword|목표|objective|방법|method|평가|과제|추가\s*설명|비고"
BOOK_HEAD = r"(?i)교재|범위|reading|chapter|자료"
REMARK_HEAD = r"(?i)비고|remark|note|기타"
# Week cells in words, cells that are dates or file names.
STRONG_WEEK = r"(?i)^(?:제\s*)?(?:week\s*\d{1,2}|\d{1,2}\s*(?:주차?|週))\s*(?:\([^)]*\))?$"
DATE_LIKE = r"\d{1,4}\s*[./\-]\s*\d{1,2}(?:\s*[./\-]\s*\d{1,2})?|\d{1,2}\s*월\s*\d{1,2}\s*일"
FILE_LIKE = r"(?i)\.(?:pdf|pptx?|hwp|docx?|zip)\b|week\s*\d+\s*$"
# Cues of events in plan rows, and lines that name a chapter.
EXAM_CUE = r"(?i)중간\s*고사|기말\s*고사|중간\s*시험|기말\s*시험|midterm|final\s*exam|\bexam\b|퀴즈|quiz|시험"
ASSIGNMENT_CUE = r"(?i)과제|assignment|homework|레포트|리포트|report\s*due|제출|presentation|발표"
NO_SESSION = r"(?i)no\s*(?:lab|class)|수업\s*없음|실험\s*없음|휴강"
OTHER_CUE = r"(?i)\[\s*(?:event|workshop|mentoring|mini\s*project)\s*\]|데모\s*데이"
CHAPTER = r"(?i)\bch(?:apter)?s?\.?\s*\d|챕터\s*\d|\d+\s*단원|\d+\s*장\b"
EXAM_WORDS = ["midterm", "mid", "term", "final", "exam", "exams", "quiz", "week", "중간", "기말", "시험", "고사", "퀴즈"]
# Headings of schedules in prose.
SCHEDULE_HEAD = r"(?i)schedule|weekly\s*plan|강의\s*계획|수업\s*계획|주별|주차별"

ROW = "struct<week:int,dates:string,topic:string,book:string,remarks:string,extras:array<string>>"
_SPACE = r"(?U)\s+"


def squeeze(c: Column) -> Column:
    """One line with single blanks; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), _SPACE, " "))


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _first(cells: Column, is_it) -> Column:
    """Place of the first cell that is it, or null."""
    return F.nullif(F.array_position(F.transform(cells, is_it), True), F.lit(0)).cast("int") - 1


def _head_role(c: Column) -> Column:
    """The first role whose name a header cell carries."""
    topic = ~c.rlike(NO_TOPIC_HEAD)
    return (
        F.when(c.rlike(WEEK_HEAD), "week").when(c.rlike(DATE_HEAD), "dates").when(topic & c.rlike(TOPIC_HEADS[0]), "topic")
        .when(topic & c.rlike(TOPIC_HEADS[1]), "contents").when(c.rlike(BOOK_HEAD), "book").when(c.rlike(REMARK_HEAD), "remarks").otherwise("")
    )


def _weights(rows: Column, width: Column, skip) -> Column:
    """array<struct<i, n>>: characters of every column but those to skip, which have none."""
    n = lambda i: F.aggregate(rows, F.lit(0), lambda s, r: s + F.coalesce(F.length(F.get(r, i)), F.lit(0)))
    return F.transform(F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(i.alias("i"), F.when(skip(i), 0).otherwise(n(i)).alias("n")))


def _leftmost_heavy(weights: Column) -> Column:
    """The leftmost column with at least half the characters of the fullest one."""
    heavy = lambda ws, peak: F.array_min(F.transform(F.filter(ws, lambda w: 2 * w["n"] >= peak), lambda w: w["i"]))
    return once(weights, lambda ws: once(F.array_max(F.transform(ws, lambda w: w["n"])), lambda peak: F.when(peak > 0, heavy(ws, peak))))


def plan_tables(tables: DataFrame) -> DataFrame:
    """doc_id, table_no, rows (array of week, dates, topic, book, remarks, extras) of the tables that are plans.

    tables: doc_id, table_no, header, rows. Columns are found by the header, else by a first column of weeks, else by
    the column with most week cells in words; a header that is itself a row of weeks counts as one. Where the topic
    column is empty on most week rows, the leftmost heavy column takes its place. A single row needs its week in words.
    """
    lines = F.transform(F.coalesce("rows", F.array().cast("array<array<string>>")), lambda r: F.coalesce(r, F.array().cast("array<string>")))
    head = F.transform(F.coalesce("header", F.array().cast("array<string>")), squeeze)
    x = tables.select("doc_id", "table_no", head.alias("head"), F.col("header"), lines.alias("raw"))
    row_like = F.exists("head", lambda h: h.rlike(STRONG_WEEK))
    x = x.select("doc_id", "table_no", F.when(row_like, F.array().cast("array<string>")).otherwise(F.col("head")).alias("head"), F.when(row_like, F.concat(F.array("header"), "raw")).otherwise(F.col("raw")).alias("raw"))
    x = x.withColumns({"rows": F.transform("raw", lambda r: F.transform(r, squeeze)), "roles": F.transform("head", _head_role)})
    width = F.coalesce(F.array_max(F.transform("rows", lambda r: F.size(r))), F.lit(0))
    x = x.withColumns({"width": width, "n": F.size("rows"), "hits": F.size(F.filter("rows", lambda r: parse_week(F.get(r, F.lit(0))).isNotNull()))})

    role = lambda name: _first(F.col("roles"), lambda r: r == name)
    topic = F.coalesce(role("topic"), role("contents"))
    named = role("week").isNotNull() & topic.isNotNull()
    numeric = (F.col("n") >= 3) & (F.col("width") >= 2) & (F.col("hits") >= F.greatest(F.lit(3), F.floor(0.6 * F.col("n"))))
    plain = F.transform("rows", lambda r: F.transform(r, lambda c: F.when(parse_week(c).isNull(), c)))
    weighed = once(plain, lambda rows: _weights(rows, F.col("width"), lambda i: i == 0))
    x = x.withColumn("fullest", F.when(numeric & ~named, -F.array_max(F.transform(weighed, lambda w: F.struct(w["n"].alias("n"), (-w["i"]).alias("i"))))["i"]))
    fullest = F.col("fullest")
    dated = lambda but: F.array_min(F.filter(F.sequence(F.lit(1), F.greatest(F.col("width") - 1, F.lit(1))), lambda i: (i != but) & F.exists("rows", lambda r: F.get(r, i).rlike(DATE_LIKE))))
    strong = F.flatten(F.transform("rows", lambda r: F.filter(F.transform(r, lambda c, i: F.when(c.rlike(STRONG_WEEK), i)), lambda i: i.isNotNull())))
    modal = once(strong, lambda xs: -F.array_max(F.transform(F.array_distinct(xs), lambda i: F.struct(F.size(F.filter(xs, lambda j: j == i)).alias("n"), (-i).alias("i"))))["i"])
    x = x.withColumn("map", F.when(named, F.struct(role("week").alias("week"), role("dates").alias("dates"), topic.alias("topic"), role("book").alias("book"), role("remarks").alias("remarks"))))
    nothing = F.lit(None).cast("int")
    other = F.when(numeric, F.struct(F.lit(0).alias("week"), dated(fullest).alias("dates"), fullest.alias("topic"), nothing.alias("book"), nothing.alias("remarks"))).when(modal.isNotNull(), F.struct(modal.alias("week"), nothing.alias("dates"), nothing.alias("topic"), nothing.alias("book"), nothing.alias("remarks")))
    x = x.withColumn("map", F.coalesce("map", other))  # without one, no row has a week

    at = lambda r, i: F.when(i.isNotNull(), _filled(F.get(r, i)))
    m = F.col("map")
    x = x.withColumn("weekly", F.filter("rows", lambda r: parse_week(at(r, m["week"])).isNotNull()))
    x = x.withColumn("filled", F.size(F.filter("weekly", lambda r: at(r, m["topic"]).isNotNull())))
    repair = (F.size("weekly") > 0) & (F.col("filled") < F.greatest(F.lit(1), F.floor(0.4 * F.size("weekly"))))
    better = _leftmost_heavy(_weights(F.col("weekly"), F.col("width"), lambda i: (i == m["week"]) | F.coalesce(i == m["dates"], F.lit(False))))
    x = x.withColumn("topic", F.when(repair, F.coalesce(better, m["topic"])).otherwise(m["topic"]))

    known = F.array(m["week"], m["dates"], F.col("topic"), m["book"], m["remarks"])
    split = lambda c: F.transform(F.split(F.coalesce(c, F.lit("")), r"\R"), squeeze)
    extras = lambda r: F.filter(F.flatten(F.transform(r, lambda c, i: F.when(F.exists(known, lambda k: k == i), F.array().cast("array<string>")).otherwise(split(c)))), lambda s: (s != "") & parse_week(s).isNull())
    build = lambda r, raw: F.struct(parse_week(at(r, m["week"])).alias("week"), at(r, m["dates"]).alias("dates"), at(r, F.col("topic")).alias("topic"), at(r, m["book"]).alias("book"), at(r, m["remarks"]).alias("remarks"), extras(raw).alias("extras")).cast(ROW)
    out = F.filter(F.zip_with("rows", "raw", build), lambda r: r["week"].isNotNull() | r["topic"].isNotNull())
    in_words = F.exists("rows", lambda r: F.coalesce(at(r, m["week"]).rlike(STRONG_WEEK), F.lit(False)))
    # Filters below this generator stay there; pushed through, they would carry all of the above with them.
    x = x.select("doc_id", "table_no", F.explode(F.array(F.struct(out.alias("rows"), in_words.alias("in_words")))).alias("z"))
    n_weeks = F.size(F.filter("z.rows", lambda r: r["week"].isNotNull()))
    return x.where((n_weeks >= 2) | ((n_weeks == 1) & F.col("z.in_words"))).select("doc_id", "table_no", "z.rows")


def weeks_of(rows: Column) -> Column:
    return F.filter(F.transform(rows, lambda r: r["week"]), lambda w: w.isNotNull())


def _contiguous(weeks: Column) -> Column:
    w = F.array_distinct(weeks)
    return F.coalesce(F.array_max(w) - F.array_min(w) + 1 == F.size(w), F.lit(True))


def issues_of(rows: Column) -> Column:
    """What keeps the rows of a plan from being trusted."""
    topics = F.filter(F.transform(rows, lambda r: r["topic"]), lambda t: t.isNotNull())
    return once(F.struct(weeks_of(rows).alias("w"), topics.alias("t")), lambda x: _issues(x["w"], x["t"]))


def _issues(w: Column, topics: Column) -> Column:
    shifted = F.size(F.filter(topics, lambda t: t.rlike(rf"^(?:{DATE_LIKE})$") | t.rlike(FILE_LIKE)))
    flag = lambda ok, name: F.when(ok, F.lit(name))
    full = F.array(
        flag(F.size(F.array_distinct(w)) < F.size(w), "duplicate_weeks"), flag(w != F.array_sort(w), "weeks_not_monotonic"),
        flag((F.array_max(w) - F.array_min(w) + 1 != F.size(w)) | (F.size(F.array_distinct(w)) < F.size(w)), "week_gap"),
        flag(shifted >= 2, "column_shift"), flag((F.size(w) >= 5) & (F.size(F.array_distinct(topics)) == 1), "uniform_topic"),
    )
    return F.when(F.size(w) == 0, F.array(F.lit("no_week_numbers"))).otherwise(F.array_compact(full))


def weekly_plans(tables: DataFrame) -> DataFrame:
    """doc_id, rows, total_weeks, needs_review, issues: one plan of each document that has one.

    Tables with disjoint weeks are pieces of one plan, taken by their first week. The merged plan is tried first, then
    single tables by size; the first without an issue wins, or one with gaps between pieces that have none inside.
    Without a winner the merged plan's issues stand: one repeated topic leaves the number of weeks only, others nothing.
    """
    return merge_fragments(plan_tables(tables))


def merge_fragments(fragments: DataFrame) -> DataFrame:
    """The plans (see weekly_plans) of pieces (doc_id, table_no, rows)."""
    piece = F.struct(F.coalesce(F.array_min(weeks_of(F.col("rows"))), F.lit(99)).alias("first"), "table_no", "rows")
    x = fragments.groupBy("doc_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))  # the tables of one document
    kind = f"struct<rows:array<{ROW}>,weeks:array<int>>"
    empty = F.struct(F.array().alias("rows"), F.array().alias("weeks")).cast(kind)

    def add(acc: Column, p: Column) -> Column:
        w = weeks_of(p["rows"])
        fits = (F.size(w) > 0) & ~F.arrays_overlap(acc["weeks"], w)
        return F.when(fits, F.struct(F.concat(acc["rows"], p["rows"]).alias("rows"), F.concat(acc["weeks"], w).alias("weeks")).cast(kind)).otherwise(acc)

    x = x.withColumns({"merged": F.aggregate("pieces", empty, add)["rows"], "whole": F.forall("pieces", lambda p: _contiguous(weeks_of(p["rows"])))})
    single = F.transform(F.array_sort(F.transform("pieces", lambda p, i: F.struct((-F.size(p["rows"])).alias("n"), i.alias("i"), p["rows"].alias("rows")))), lambda p: F.struct(p["rows"].alias("rows"), F.lit(False).alias("gaps")))
    tries = F.concat(F.array(F.struct(F.col("merged").alias("rows"), F.col("whole").alias("gaps"))), single)
    x = x.select("doc_id", F.transform(tries, lambda t: F.struct(t["rows"].alias("rows"), t["gaps"].alias("gaps"), issues_of(t["rows"]).alias("issues"))).alias("tries"))
    gap = F.array(F.lit("week_gap"))
    good = lambda t: (F.size(t["issues"]) == 0) | (t["gaps"] & (t["issues"] == gap))
    win = F.get(F.filter("tries", good), F.lit(0))
    x = x.select("doc_id", win.alias("win"), F.get("tries", F.lit(0)).alias("other"))
    won = F.col("win").isNotNull()
    total = F.when(won, F.array_max(weeks_of(F.col("win.rows")))).when(F.col("other.issues") == F.array(F.lit("uniform_topic")), F.array_max(weeks_of(F.col("other.rows"))))
    issues = F.coalesce("win.issues", "other.issues")
    return x.select("doc_id", F.when(won, F.col("win.rows")).otherwise(F.array().cast(f"array<{ROW}>")).alias("rows"), total.alias("total_weeks"), (F.size(issues) > 0).alias("needs_review"), issues.alias("issues"))


def topic_with_chapters(topic: Column, extras: Column) -> Column:
    """The topic with the lines that name a chapter, wrapped lines joined; null where only an exam is named."""
    none = F.array().cast("array<string>")

    def fold(acc: Column, line: Column) -> Column:
        last = F.element_at(acc, -1)
        return F.when((F.size(acc) > 0) & line.rlike("^[a-z0-9(]"), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat_ws(" ", last, line)))).otherwise(F.concat(acc, F.array(line)))

    lines = F.filter(F.aggregate(F.coalesce(extras, none), none, fold), lambda s: s.rlike(CHAPTER) & ~s.rlike(EXAM_CUE))
    out = _filled(F.concat_ws(", ", _filled(F.trim(topic)), _filled(F.array_join(lines, " "))))
    words = F.regexp_extract_all(F.lower(out), F.lit("([a-z가-힣]+)"), F.lit(1))
    return F.when((F.size(words) > 0) & F.forall(words, lambda w: w.isin(EXAM_WORDS)), None).otherwise(out)


def row_date(dates: Column) -> Column:
    """The first date of a range, as YYYY-MM-DD; null without a year."""
    d = normalize_date(F.get(F.split(dates, "[~〜–—]|부터"), F.lit(0)))
    return F.when(F.length(d) == 10, d)


def plan_events(plans: DataFrame) -> DataFrame:
    """doc_id, week, kind, type, title, resolved_date, needs_review of the rows of plans (doc_id, rows).

    Topic and remarks are one line, every extra its own. A week gives one event of a kind and type, by its first line;
    what names both an assignment and an exam is an assignment. Only a date in the row resolves an event.
    """
    x = plans.select("doc_id", F.posexplode("rows").alias("seq", "r")).where("r.week is not null")
    main = F.when(F.col("r.topic").isNotNull(), F.array(F.struct(F.substring("r.topic", 1, 80).alias("title"), F.concat_ws(" ", "r.topic", "r.remarks").alias("line"))))
    more = F.transform(F.coalesce("r.extras", F.array().cast("array<string>")), lambda s: F.struct(F.substring(s, 1, 80).alias("title"), s.alias("line")))
    x = x.select("doc_id", "seq", F.col("r.week").alias("week"), row_date(F.col("r.dates")).alias("resolved_date"), F.posexplode(F.concat(F.coalesce(main, F.array().cast("array<struct<title:string,line:string>>")), more)).alias("i", "s"))
    line = F.col("s.line")
    exam, task = line.rlike(EXAM_CUE), line.rlike(ASSIGNMENT_CUE)
    kind = F.when(line.rlike(NO_SESSION), None).when(line.rlike(OTHER_CUE) & ~exam, "other").when(task, "assignment").when(exam, "exam")
    what = F.when(line.rlike("(?i)중간|midterm"), "midterm").when(line.rlike("(?i)기말|final"), "final").when(line.rlike("(?i)퀴즈|quiz"), "quiz")
    x = x.withColumn("kind", kind).where("kind is not null").withColumn("type", F.when(F.col("kind") == "exam", what))
    per = F.when(F.col("kind") == "other", F.col("i"))  # tagged lines are events of their own
    first = x.groupBy("doc_id", "seq", "week", "kind", "type", "resolved_date", per.alias("line_no")).agg(F.min_by("s.title", "i").alias("title"))
    return first.select("doc_id", "week", "kind", "type", "title", "resolved_date", F.col("resolved_date").isNull().alias("needs_review"))


def month_day(cell: Column) -> Column:
    """struct<month, day> of the first date of a cell: `Sep 2`, `3월 11일`, `2026-03-11`, `3/11`; null without one."""
    en, ko, num = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s*(\d{1,2})\b", r"(\d{1,2})\s*월\s*(\d{1,2})\s*일", r"(?:\d{4}\s*[./\-])?\s*(\d{1,2})\s*[./\-]\s*(\d{1,2})\b"
    names = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    number = lambda m: m.try_cast("int")

    def read(c: Column, p: str, month) -> Column:
        day = lambda m: F.struct(month(m).alias("month"), F.regexp_extract(c, p, 2).try_cast("int").alias("day"))
        return once(F.regexp_extract(c, p, 1), lambda m: F.when(m != "", day(m)))

    md = once(cell, lambda c: F.coalesce(read(c, en, lambda m: F.try_element_at(names, F.lower(m))), read(c, ko, number), read(c, num, number)))
    return once(md, lambda x: F.when(x["month"].between(1, 12) & x["day"].between(1, 31), x))


def _days(entries: DataFrame) -> DataFrame:
    """entries (doc_id, place, md, year, ...) with their day: months far before the first one are of the next year."""
    first = F.first("md.month").over(Window.partitionBy("doc_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    year = F.col("year") + (F.col("md.month") < first - 6).cast("int")
    day = F.try_to_date(F.format_string("%04d-%02d-%02d", year, F.col("md.month"), F.col("md.day")))
    return computed(entries, "day", day).where("day is not null")


def dated_rows(tables: DataFrame, years: DataFrame) -> DataFrame:
    """doc_id, place, day, topic of the tables (doc_id, table_no, rows) with a column of dates; years: doc_id, year.

    The column in which most cells, two at least and 60 % of those filled, hold a date; its topic is the leftmost heavy
    column. Dates that don't exist are left out, and so are documents without a year.
    """
    rows = F.transform(F.coalesce("rows", F.array().cast("array<array<string>>")), lambda r: F.transform(F.coalesce(r, F.array().cast("array<string>")), squeeze))
    x = computed(tables.select("doc_id", "table_no", "rows"), "lines", rows).select("doc_id", "table_no", F.col("lines").alias("rows")).withColumn("width", F.coalesce(F.array_max(F.transform("rows", lambda r: F.size(r))), F.lit(0))).where("width >= 2")
    count = lambda i, ok: F.size(F.filter("rows", lambda r: F.coalesce(ok(F.get(r, i)), F.lit(False))))
    cols = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.struct(count(i, lambda c: month_day(c).isNotNull()).alias("n"), count(i, lambda c: c != "").alias("full"), (-i).alias("i")))
    best = -F.array_max(F.filter(cols, lambda c: c["n"] >= F.greatest(F.lit(2), F.floor(0.6 * c["full"]))))["i"]
    x = computed(x, "at", best).where("at is not null")
    x = computed(x, "topic_at", _leftmost_heavy(_weights(F.col("rows"), F.col("width"), lambda i: i == F.col("at")))).where("topic_at is not null")
    e = x.select("doc_id", "table_no", "at", "topic_at", F.posexplode("rows").alias("row_no", "r"))
    e = computed(e.select("doc_id", F.struct("table_no", "row_no").alias("place"), F.get("r", "at").alias("cell"), _filled(F.get("r", "topic_at")).alias("topic")), "md", month_day(F.col("cell"))).where("md is not null")
    return _days(e.join(years.select("doc_id", "year").where("year is not null"), "doc_id")).select("doc_id", "place", "day", "topic")


def prose_rows(docs: DataFrame, years: DataFrame, dry: int = 12, least: int = 3) -> DataFrame:
    """doc_id, place, day, topic of lines `date - topic` below a heading of a schedule; docs: doc_id, text.

    A block runs from a heading on while fewer than `dry` other lines stand between its dated lines; bullets and blank
    lines don't count. The first block of a document with `least` dated lines is taken.
    """
    lines = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\R")).alias("place", "s")).withColumn("s", F.trim("s"))
    lines = lines.where((F.col("s") != "") & ~F.col("s").rlike("^[•·▪‣]"))
    cut = r"^(.{3,28}?)\s*(?:[–—:]|\s-)\s*(?=\S)(.*)$"
    md = F.when(F.col("s").rlike(cut), month_day(F.regexp_extract("s", cut, 1)))
    x = lines.select("doc_id", "place", "s", md.alias("md"), (F.col("s").rlike(SCHEDULE_HEAD) & md.isNull()).alias("head"))
    w = Window.partitionBy("doc_id").orderBy("place")
    x = x.withColumn("n", F.row_number().over(w))
    known = F.last(F.when(F.col("head") | F.col("md").isNotNull(), F.col("n")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = x.where("head or md is not null").withColumn("known", known)
    fresh = F.col("head") | F.col("known").isNull() | (F.col("n") - F.col("known") > dry)
    x = x.withColumn("block", F.sum(fresh.cast("int")).over(w)).withColumn("under", F.first("head").over(Window.partitionBy("doc_id", "block").orderBy("place")))
    x = x.where("under and md is not null").withColumn("size", F.count("*").over(Window.partitionBy("doc_id", "block"))).where(F.col("size") >= least)
    x = x.withColumn("best", F.min("block").over(Window.partitionBy("doc_id"))).where("block = best")
    e = x.select("doc_id", "place", "md", _filled(F.regexp_extract("s", cut, 2)).alias("topic"))
    return _days(e.join(years.select("doc_id", "year").where("year is not null"), "doc_id")).select("doc_id", "place", "day", "topic")

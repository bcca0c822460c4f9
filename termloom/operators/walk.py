"""A document from its pages to classified candidates, dated entries, meeting status, label values and routed fields.

docs: doc_id and pages (array of page_no, text, tables with header and rows), as sources.files.read_documents gives them.
Null pages, tables, rows and texts are empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.dates import normalize_date
from termloom.functions.text import full_text, once
from termloom.operators import candidates, fields
from termloom.operators.skew import dealt

# Cues of the kinds of exams; labels too general for an event's title; statuses of a meeting.
EXAM_TYPES = {
    "midterm": r"(?i)중간\s*고사|중간\s*시험|중간|midterm(?:\s+exam)?",
    "final": r"(?i)기말\s*고사|기말\s*시험|기말|final(?:\s+exam)?",
    "quiz": r"(?i)퀴즈|quiz(?:\s*#?\d+)?",
}
GENERIC = r"(?i)^\s*(?:시험|고사|평가|성적|일정|이벤트|과제|숙제|주차|week|exams?|assignments?|homework|evaluation|schedule|grading|date|일자|날짜|\d+\s*주\s*차?|week\s*\d+|\d+\s*강(?:의)?|\d+\s*차\s*시)\s*$"
TBA = r"(?i)\bTBA\b|미정|추후\s*(?:공지|안내)"
ASYNC = r"(?i)사이버\s*강의|온라인\s*강의|비대면|원격\s*수업|동영상\s*강의|e-?learning"
DATE_SIGNATURE = r"(?i)\d{1,2}\s*월\s*\d{1,2}\s*일|\d{1,2}\s*[/.\-]\s*\d{1,2}|\d{1,4}\s*주\s*차?|week\s*\d+"
# Days and clock ranges of class times, and what marks office hours beside them.
DAY = r"(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\.?|[월화수목금토일](?:요일)?)"
CLASS_RUN = rf"(?<![가-힣A-Za-z]){DAY}(?:\s*[-~,/&·]\s*{DAY})*\s*\d{{1,2}}:\d{{2}}\s*[-~–]\s*\d{{1,2}}:\d{{2}}"
OFFICE_NEAR = r"(?i)면담|상담|office|오피스|조교|\bTA\b"
SECTION_WORD = r"(?i)^(?:목차|개요|평가|성적|교재|공지|강의\s*계획서?|수업\s*계획서?|syllabus|course\s+(?:syllabus|outline|information)|overview|schedule|grading|contents?)\W*$"


def cells(docs: DataFrame) -> DataFrame:
    """doc_id, page, table_no, row_no, col_no, row_label, col_label, next_cell, text of the cells that aren't empty."""
    p = docs.select("doc_id", F.explode("pages").alias("p"))
    t = p.select("doc_id", F.col("p.page_no").alias("page"), F.posexplode("p.tables").alias("table_no", "t"))
    r = t.select("doc_id", "page", "table_no", F.col("t.header").alias("head"), F.posexplode("t.rows").alias("row_no", "row"))
    c = r.select("doc_id", "page", "table_no", "row_no", "head", "row", F.posexplode("row").alias("col_no", "text")).where("trim(text) <> ''")
    some = lambda x: F.nullif(F.trim(x), F.lit(""))
    return c.select("doc_id", "page", "table_no", "row_no", "col_no", some(F.get("row", F.lit(0))).alias("row_label"), some(F.get("head", "col_no")).alias("col_label"), some(F.get("row", F.col("col_no") + 1)).alias("next_cell"), "text")


def walk(docs: DataFrame) -> DataFrame:
    """Candidates of every cell and page text; of equal texts of a page the last of a table stays, else the first.

    Cells and text of a page leave it by one generator, and are dealt once, by document.
    """
    none, bits = F.lit(None).cast("string"), lambda c, n: F.shiftleft(c.cast("long"), n)
    some = lambda x: F.nullif(F.trim(x), F.lit(""))
    each = lambda xs, f: F.flatten(F.filter(F.transform(xs, f), lambda a: a.isNotNull()))
    place = lambda i, j, k: bits(i, 50) + bits(j, 30) + bits(k, 20)
    unit = lambda is_table, row, col, at, text: F.struct(F.lit(is_table).alias("is_table"), row.alias("row_label"), col.alias("col_label"), at.alias("place"), text.alias("text"))
    of_row = lambda t, i, r, j: F.transform(r, lambda c, k: unit(True, some(F.get(r, F.lit(0))), some(F.get(t["header"], k)), place(i, j, k), c))
    in_tables = F.filter(each(F.col("p.tables"), lambda t, i: each(t["rows"], lambda r, j: of_row(t, i, r, j))), lambda u: F.trim(u["text"]) != "")
    in_text = F.array(unit(False, none, none, F.lit(0).cast("long"), F.col("p.text")))
    p = docs.select("doc_id", F.explode("pages").alias("p"))
    units = p.select("doc_id", F.col("p.page_no").alias("page"), F.explode(F.concat(F.coalesce(in_tables, F.slice(in_text, 1, F.lit(0))), in_text)).alias("u"))
    t = units.select("doc_id", "page", "u.is_table", none.alias("section"), "u.row_label", "u.col_label", "u.place", "u.text")
    found = candidates.extract(t).withColumn("seq", F.col("place") + F.col("char_start"))
    return candidates.last_table_hit_first(dealt(found, "doc_id", like=docs)).drop("seq", "place")


def run_pipeline(docs: DataFrame, classify=candidates.classify, block_events: bool = False) -> DataFrame:
    """Candidates with label, in_class and reject_reason; `classify` is any function that adds label and confidence."""
    return candidates.validate(classify(walk(docs)), block_events)


def matched_cue(context: Column) -> Column:
    """struct<type, cue>: the kind of exam that a context names, and the words that do."""
    out = None
    for name, pattern in EXAM_TYPES.items():
        hit = F.struct(F.lit(name).alias("type"), F.trim(F.regexp_extract(context, pattern, 0)).alias("cue"))
        out = F.when(context.rlike(pattern), hit) if out is None else out.when(context.rlike(pattern), hit)
    return out


def event_title(row_label: Column, section: Column, before: Column) -> Column:
    """The label of the row or section if it isn't general, else the phrase before the date on its line."""

    def label(c: Column) -> Column:
        t = F.regexp_replace(fields.cut_at_next_label(c), r"^[ :|·\-–—,\t]+|[ :|·\-–—,\t]+$", "")
        return once(t, lambda t: F.when(F.length(t).between(1, 80) & ~t.rlike(GENERIC), t))

    line = F.regexp_replace(F.substring_index(F.coalesce(before, F.lit("")), "\n", -1), r"^.*[;|•·]", "")
    line = F.regexp_replace(F.regexp_replace(line, r"[\s:|·,]+$", ""), r"(?U)^\W+", "")
    line = F.trim(F.regexp_replace(line, r"[#(\[{№_\-]+$", ""))
    phrase = once(line, lambda s: F.when(F.length(s).between(3, 80) & ~F.replace(s, F.lit(" "), F.lit("")).rlike(r"^\d+$") & ~s.rlike(r"^\p{Ll}") & ~s.rlike(GENERIC), s))
    return F.coalesce(label(row_label), label(section), phrase)


def date_signature(title: Column, raw: Column) -> Column:
    """The first date or week that a title or reference names, without blanks."""
    s = F.regexp_extract(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(raw, F.lit(""))), DATE_SIGNATURE, 0)
    return F.nullif(F.lower(F.regexp_replace(s, r"\s+", "")), F.lit(""))


def dated_entries(cands: DataFrame) -> DataFrame:
    """Exams and deadlines among classified candidates; only an absolute date with its year resolves, by the document."""
    x = cands.where(F.col("label").isin("exam_time", "assignment_deadline"))
    cue = matched_cue(F.concat_ws(" ", "section", "row_label", "col_label", "before", "after", "text"))
    exam = F.col("label") == "exam_time"
    title = event_title(F.col("row_label"), F.col("section"), F.col("before"))
    day = F.when(F.col("date_kind") == "absolute", normalize_date(F.col("text")))
    x = x.withColumns({"__cue": F.when(exam, cue), "__day": F.when(F.length(day) == 10, day)})
    return x.select(
        "doc_id", "page", "char_start", "char_end", F.when(exam, "exam").otherwise("assignment").alias("kind"), F.col("__cue.type").alias("type"), F.coalesce(title, "__cue.cue").alias("title"),
        F.col("text").alias("raw_reference"), "date_kind", F.col("__day").alias("resolved_date"), F.when(F.col("__day").isNotNull(), "in_document").alias("resolved_by"), F.col("__day").isNull().alias("needs_review"),
    )


def by_date_signature(events: DataFrame) -> DataFrame:
    """One event of each document, type and date signature: the shortest title, the first date; others stay.

    An event whose title and reference name no date is its own. events: doc_id, seq, type, title, raw_reference, resolved_date.
    """
    sig = date_signature(F.col("title"), F.col("raw_reference"))
    x = events.withColumn("__s", sig).withColumn("__own", F.when(sig.isNull(), F.col("seq")))
    best = F.min_by("title", F.struct(F.length("title"), "seq"))
    dated = F.min_by("resolved_date", F.when(F.col("resolved_date").isNotNull(), F.col("seq")))
    return x.groupBy("doc_id", "type", "__s", "__own").agg(F.min("seq").alias("seq"), best.alias("title"), F.min_by("raw_reference", "seq").alias("raw_reference"), dated.alias("resolved_date"), F.count("*").alias("merged")).drop("__s", "__own")


def meeting_status(text: Column, raw_time: Column, meets: Column) -> Column:
    """tba, present, async or not_specified: a stated time comes before any word on how the course is held."""
    return F.when(raw_time.rlike(TBA), "tba").when(F.coalesce(meets, F.lit(False)) | raw_time.isNotNull(), "present").when(text.rlike(ASYNC), "async").otherwise("not_specified")


def several_sections(times: Column, rooms: Column) -> Column:
    """Whether a document states three or more class times or rooms."""
    n = lambda c: F.size(F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x))))
    return (n(times) >= 3) | (n(rooms) >= 3)


def cell_values(docs: DataFrame) -> DataFrame:
    """doc_id, field, value, page, table_no, row_no, col_no: cells to the right of a label's cell that are no labels."""
    names = F.create_map(*[F.lit(x) for f, labels in fields.LABELS.items() for label in labels for x in (label, f)])
    field = lambda c: F.try_element_at(names, F.regexp_replace(F.lower(F.trim(c)), r"\s*[:：]$", ""))
    x = cells(docs).select("doc_id", field(F.col("text")).alias("field"), F.col("next_cell").alias("value"), "page", "table_no", "row_no", "col_no")
    return x.where(F.col("field").isNotNull() & F.col("value").isNotNull() & field(F.col("value")).isNull())


def fallback_class_time(text: Column, head: int = 1200) -> Column:
    """The first days with a clock range in the head of a text that no word for office hours stands near to."""
    text = F.substring(F.coalesce(text, F.lit("")), 1, head)
    parts = F.struct(F.split(text, f"(?is){CLASS_RUN}", -1).alias("gap"), F.regexp_extract_all(text, F.lit(f"(?is){CLASS_RUN}"), F.lit(0)).alias("run"))

    def free(x: Column) -> Column:
        before = lambda i: F.substring(F.get(x["gap"], i), -40, 40)
        # Five gaps with the runs between them hold the next 40 characters: a run has 10 at least.
        after = lambda i: F.substring(F.array_join(F.flatten(F.zip_with(F.slice(x["gap"], i + 2, 5), F.slice(x["run"], i + 2, 5), lambda g, r: F.array(F.coalesce(g, F.lit("")), F.coalesce(r, F.lit(""))))), ""), 1, 40)
        return F.get(F.filter(x["run"], lambda r, i: ~F.concat(before(i), F.lit(" "), after(i)).rlike(OFFICE_NEAR)), F.lit(0))

    return once(parts, free)


def title_cascade(text: Column) -> Column:
    """A labelled title, else one named within a line, else the first of eight lines that reads like a course title."""
    t = F.coalesce(text, F.lit(""))
    inline = fields.first_match(t, rf"(?i)(?:{'|'.join(fields.LABELS['title'])})\s*[:：]\s*([^\n|]{{2,60}})")
    lines = F.transform(F.slice(F.split(t, "\n"), 1, 8), lambda s: F.trim(s))
    reads = lambda s: F.length(s).between(4, 60) & s.rlike(r"\p{L}{2}") & ~s.rlike(SECTION_WORD) & ~s.rlike(r"[:：|@]|https?|\d{4}|대학교|(?i)university|college")
    return F.coalesce(fields.clean_title(fields.labelled_value(t, "title")), fields.clean_title(fields.cut_at_next_label(inline)), fields.clean_title(F.get(F.filter(lines, reads), F.lit(0))))


def route(docs: DataFrame, cands: DataFrame) -> DataFrame:
    """doc_id, field, source, value: the rule layer's fields, label cells, and what the candidates say of meetings."""
    text = docs.select("doc_id", full_text(F.coalesce("pages", F.array().cast(docs.schema["pages"].dataType))).alias("text"))
    rule = fields.rule_fields(text).drop("grading")
    names = [c for c in rule.columns if c != "doc_id"]
    rules = rule.select("doc_id", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in names])).alias("v")).select("doc_id", "v.field", F.lit("rule").alias("source"), "v.value")
    first = cell_values(docs).groupBy("doc_id", "field").agg(F.min_by("value", F.struct("page", "table_no", "row_no", "col_no")).alias("value"))
    meets = cands.where("in_class").groupBy("doc_id").agg(F.min_by("text", F.struct("page", "char_start")).alias("value"))
    rows = rules.unionByName(first.select("doc_id", "field", F.lit("cell").alias("source"), "value")).unionByName(meets.select("doc_id", F.lit("class_time").alias("field"), F.lit("subsystem").alias("source"), "value"))
    return rows.where("trim(value) <> ''")

"""Rule fields of a document: each from labelled or anchored evidence in the text; without it the field is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import blank_to_null, once

# The labels that name a field.
LABELS = {
    "title": ["교과목명", "과목명", "강의명", "course title", "course name"],
    "code": ["학수번호", "과목코드", "과목번호", "course code", "course no"],
    "instructor": ["담당교수", "교수명", "담당교강사", "instructor", "professor"],
    "department": ["개설학과", "학과", "소속", "department"],
    "location": ["강의실", "강의장소", "classroom", "room", "location"],
    "credits": ["학점", "credits", "credit"],
    "class_time": ["강의시간", "수업시간", "class time", "class hours"],
}
_ANY = "|".join(x for xs in LABELS.values() for x in xs)
_YEAR_TERM = r"(?i)(20\d\d)\s*(?:학년도|년도|년)?\s*[-,./]?\s*(?:제?\s*[12]\s*학기|봄|여름|가을|겨울|하계|동계|\b(?:spring|summer|fall|autumn|winter)\b)"
_TERM_YEAR = r"(?i)\b(?:spring|summer|fall|autumn|winter)\s*(?:semester|term)?,?\s*(20\d\d)\b"
_SEASON = r"(?i)(?<!\d)(제?\s*[12]\s*학기|(?:봄|여름|가을|겨울)\s*학기|(?:하계|동계)\s*(?:학기|계절)|\b(?:spring|summer|fall|autumn|winter)\b)"
_CODE = r"(?<!(?i:classroom|room|강의실|office|building)\s{0,3}[:：]?\s{0,3})\b(?!(?:ISBN|ISSN|ISO|RFC|COVID|HTTP)\b)([A-Z]{2,4}[- ]?\d{3,5}(?:-\d{1,2})?)\b"


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    return blank_to_null(F.regexp_extract(text, pattern, group))


def cut_at_next_label(value: Column) -> Column:
    return F.regexp_replace(value, rf"(?i)\s+(?:{_ANY})\s*[:：|].*$", "")


def labelled_values(text: Column, field: str) -> Column:
    """Values of `label: value` lines of the field, each cut where another label begins, distinct, in order."""
    found = F.regexp_extract_all(text, F.lit(rf"(?im)^[\s|*•-]*(?:{'|'.join(LABELS[field])})\s*[:：|]\s*(\S[^\n]{{0,119}})"), F.lit(1))
    tidy = F.transform(found, lambda v: F.regexp_replace(cut_at_next_label(v), r"[\s|]+$", ""))
    return F.array_distinct(F.filter(tidy, lambda v: (v != "") & ~v.rlike(rf"(?i)^(?:{_ANY})\s*[:：]?$")))


def labelled_value(text: Column, field: str) -> Column:
    return F.get(labelled_values(text, field), F.lit(0))


def academic_year(text: Column) -> Column:
    """The year next to a term; years of full dates or of copyright lines are no evidence."""
    y = F.coalesce(first_match(text, _YEAR_TERM), first_match(text, _TERM_YEAR), first_match(text, r"(20\d\d)\s*학년도")).cast("int")
    return once(y, lambda y: F.when(y.between(2000, 2035), y))


def term(text: Column) -> Column:
    """봄, 여름, 가을 or 겨울 by the first term named."""
    name = lambda t: F.when(t.rlike("봄|spring|1"), "봄").when(t.rlike("여름|하계|summer"), "여름").when(t.rlike("가을|fall|autumn|2"), "가을").when(t.rlike("겨울|동계|winter"), "겨울")
    return once(F.lower(first_match(text, _SEASON)), name)


def course_code(text: Column, head: int = 500) -> Column:
    """A labelled code, else the first code in the head that names no room."""
    return F.coalesce(first_match(labelled_value(text, "code"), r"([A-Za-z]{0,4}[- ]?\d{3,7}(?:-\d{1,2})?)"), first_match(F.substring(text, 1, head), _CODE))


def clean_title(title: Column) -> Column:
    t = F.regexp_replace(F.trim(title), r"\s*(?:학점|(?i:credits?))\s*[:：]?\s*\d+(?:\.\d)?\s*$", "")
    t = F.trim(F.regexp_replace(t, r"^[\"'「『<\[]+|[\"'」』>\]]+$", ""))
    return once(t, lambda t: F.when(F.length(t).between(2, 60) & ~t.rlike(r"^\P{L}+$"), t))


def title_ko(title: Column) -> Column:
    return F.when(title.rlike("[가-힣]"), F.trim(F.regexp_replace(title, r"\s*\([A-Za-z][A-Za-z0-9 ,&:'-]{2,}\)\s*$", "")))


def title_en(title: Column) -> Column:
    return F.when(title.rlike("[가-힣]"), first_match(title, r"\(([A-Za-z][A-Za-z0-9 ,&:'-]{2,})\)\s*$")).otherwise(title)


def clean_instructor(name: Column) -> Column:
    n = F.regexp_replace(name, r"\S+@\S+|[(<\[].*$", "")
    n = F.regexp_replace(n, r"(?i)^\s*(?:담당\s*)?(?:교수|교강사|강사|instructor|professor|prof\.?|dr\.?)\s*[:：]?\s+", "")
    n = F.trim(F.regexp_replace(n, r"(?i)\s*(?:교수님?|강사|박사|ph\.?\s?d\.?)\s*,?\s*$", ""))
    return once(n, lambda n: F.when(F.length(n).between(2, 40) & ~n.rlike(r"\d"), n))


def room(meeting: Column) -> Column:
    """The room in the last parenthesis of a meeting text; clock times and periods are no rooms."""
    inner = first_match(meeting, r"\(([^()]+)\)\s*$")
    whole = F.trim(meeting)
    return F.when(whole.rlike(r"^[\p{L}\d]+-\d+\([A-Z]\)$"), whole).when(inner.rlike(r"\d:\d\d|^[\d,\s~-]+$|^[A-Z]$"), None).otherwise(inner)


def credits(text: Column) -> Column:
    """A labelled number of credits, 10 at most."""
    c = first_match(labelled_value(text, "credits"), r"^(\d{1,3}(?:\.\d)?)").cast("double")
    return once(c, lambda c: F.when(c <= 10, c))


def grading(text: Column) -> Column:
    """array<struct<name, weight>> of the first line with a cue whose two or more shares sum to 95 to 105 percent."""
    pair = r"([\p{L}][\p{L} ]{0,20}?)\s*[:(]?\s*(\d{1,3})\s*%"

    def shares(line: Column) -> Column:
        names = F.regexp_extract_all(line, F.lit(pair), F.lit(1))
        weights = F.transform(F.regexp_extract_all(line, F.lit(pair), F.lit(2)), lambda w: w.cast("int"))
        return F.arrays_zip(names.alias("name"), weights.alias("weight"))

    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x["weight"])
    cue = r"(?i)평가|성적|출석|시험|고사|grading|assessment|evaluation|attendance|exam|midterm|final"
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(cue) & s.contains("%"))
    return F.get(F.filter(F.transform(lines, shares), lambda xs: (F.size(xs) >= 2) & total(xs).between(95, 105)), F.lit(0))


def rule_fields(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of fields per document. A null or empty text gives nulls; repeated rows stay; extra columns go."""
    t = F.col(text_col)
    x = docs.select(F.col(id_col), t.alias("__t"), clean_title(labelled_value(t, "title")).alias("__title"), labelled_value(t, "class_time").alias("__time"), labelled_value(t, "location").alias("__at"))
    t, title, raw_time = F.col("__t"), F.col("__title"), F.col("__time")  # computed once, below what reads them
    return x.select(
        id_col, academic_year(t).alias("academic_year"), term(t).alias("term"), course_code(t).alias("course_code"),
        title_ko(title).alias("title_ko"), title_en(title).alias("title_en"), clean_instructor(labelled_value(t, "instructor")).alias("instructor"),
        labelled_value(t, "department").alias("department"), F.when(~raw_time.rlike(r"^\d+$"), raw_time).alias("class_time"),
        F.coalesce("__at", room(raw_time)).alias("location"), credits(t).alias("credits"), grading(t).alias("grading"),
    )

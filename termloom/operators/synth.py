"""Synthetic candidates for training, their integrity, prompts for label drafts, and titles of several courses in a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.functions.text import compose_input
from termloom.operators import candidates

# The share of each label.
MIX = {"class_schedule": 8, "exam_time": 3, "assignment_deadline": 2, "instructor_office_hours": 2, "ta_office_hours": 2, "policy_text": 2, "weekly_plan": 1, "unknown": 2}
# Cues that a row of a label carries, in the classifier's words.
CUES = {
    "class_schedule": ["Class time", "강의시간", "수업시간"], "exam_time": ["Midterm exam", "기말고사", "Quiz"], "assignment_deadline": ["Homework", "과제 제출", "레포트 마감"],
    "instructor_office_hours": ["Office hours", "면담", "상담"], "ta_office_hours": ["조교 면담", "조교 상담", "Teaching assistant office hours"],
    "policy_text": ["성적 평가", "출결 규정", "Grading policy"], "weekly_plan": ["Weekly plan week", "주차별 강의계획", "진도"], "unknown": ["교재", "학점", "Prerequisite"],
}
# Headings that a text of several syllabuses repeats, and words of headings that name no course.
HEADING = r"(?m)^\s*([^\n]{2,40}?)\s*(?:강의계획서|수업계획서|강의계획안|Course\s+Syllabus)\s*[\(（]?[^)\n]{0,18}[\)）]?\s*$"
NO_COURSE = r"(?i)차시|장애|지원|관련|계획|운영|개요|평가|성적|목표|출석|교재|정보|안내|대학교|대학원|university|college|오전|오후|[ap]\.?m\.?\b|\d{1,2}:\d{2}|^\s*\d|\d{1,2}\s*[/월]\s*\d{1,2}"


def _draw(seed: int, name: str, values: list[str]) -> Column:
    """One of the values by a hash of seed, row and name, so that every run draws the same."""
    return F.get(F.array(*map(F.lit, values)), F.pmod(F.xxhash64(F.lit(seed), "id", F.lit(name)), F.lit(len(values))).cast("int"))


def generate(spark: SparkSession, n: int, seed: int = 42, mix: dict[str, int] = MIX) -> DataFrame:
    """About n candidates with labels in the shares of the mix, one at least of each; a row carries a cue of its label."""
    total, ends, at = sum(mix.values()), [], 0
    for label, w in mix.items():
        at += max(1, int(n * w / total + 0.5))
        ends.append((label, at))
    label = F.lit(None).cast("string")
    for name, end in reversed(ends):
        label = F.when(F.col("id") < end, name).otherwise(label)
    x = spark.range(at).withColumn("label", label)
    day = _draw(seed, "day", ["Mon", "Tue", "Wed", "Thu", "Fri", "월", "화", "수", "목", "금"])
    hour = (F.pmod(F.xxhash64(F.lit(seed), "id", F.lit("hour")), F.lit(9)) + 9).cast("int")
    meeting = F.format_string("%s %02d:00-%02d:50", day, hour, hour)
    week = (F.pmod(F.xxhash64(F.lit(seed), "id", F.lit("week")), F.lit(15)) + 1).cast("string")
    date = _draw(seed, "date", ["2026-04-22", "2026-06-10", "2026-12-15", "10월 27일"])
    dated = F.col("label").isin("exam_time", "assignment_deadline")
    in_week = F.col("label") == "weekly_plan"
    weekly = dated & (F.pmod(F.xxhash64(F.lit(seed), "id", F.lit("kind")), F.lit(5)) < 2)
    text = F.when(in_week | weekly, F.concat(week, F.lit("주차"))).when(dated, date).when(F.col("label") == "policy_text", F.concat(hour.cast("string"), F.lit("분"))).when(F.col("label") == "unknown", hour.cast("string")).otherwise(meeting)
    cue = F.lit(None).cast("string")
    for name, words in CUES.items():
        cue = F.when(F.col("label") == name, _draw(seed, "cue", words)).otherwise(cue)
    kind = F.when(in_week | weekly, "relative").when(dated, "absolute").when(F.col("label").isin("policy_text", "unknown"), "uncertain").otherwise("recurring")
    x = x.select(F.format_string("synthetic__%s__%d", "label", "id").alias("doc_id"), text.alias("text"), F.lit(None).cast("string").alias("section"), cue.alias("row_label"), F.lit(None).cast("string").alias("col_label"), F.lit("").alias("before"), F.lit("").alias("after"), kind.alias("date_kind"), "label")
    x = x.withColumn("include_in_class_schedule", F.col("label") == "class_schedule").withColumn("source", F.lit("synthetic"))
    return x.withColumn("input_text", compose_input(*map(F.col, ("text", "section", "row_label", "col_label", "before", "after"))))


def integrity(rows: DataFrame) -> DataFrame:
    """One row: how many rows have no valid label, no cue of it, or are office hours flagged as a class."""
    cue = F.lit(False)
    for label, words in CUES.items():
        cue = cue | ((F.col("label") == label) & candidates.has_any(F.lower(F.coalesce("input_text", F.lit(""))), [w.lower() for w in words]))
    office = F.col("label").isin("instructor_office_hours", "ta_office_hours") & F.col("include_in_class_schedule")
    valid = F.coalesce(F.col("label").isin(candidates.LABELS), F.lit(False))
    return rows.agg(F.count("*").alias("n"), F.count_if(~valid).alias("bad_label"), F.count_if(valid & ~cue).alias("no_cue"), F.count_if(office).alias("office_as_class"))


def prompt_lines(cands: DataFrame) -> DataFrame:
    """cands (doc_id, seq, text, ...) with line: the number in the document, the text and its context, in one line."""
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq"))
    flat = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    context = F.concat_ws(" / ", *[F.nullif(flat(F.col(c)), F.lit("")) for c in ("section", "row_label", "col_label")])
    return cands.withColumn("n", n).withColumn("line", F.concat(F.lit("["), F.col("n").cast("string"), F.lit("] "), flat(F.col("text")), F.lit(" | "), context, F.lit(" | "), flat(F.col("before")), F.lit(" _ "), flat(F.col("after"))))


def prompt_batches(cands: DataFrame, size: int = 40, labels: list[str] = candidates.LABELS) -> DataFrame:
    """doc_id, batch, n, prompt: the lines of a document's candidates, at most `size` a prompt, below the task."""
    x = prompt_lines(cands).withColumn("batch", F.floor((F.col("n") - 1) / size).cast("int"))
    per = x.groupBy("doc_id", "batch").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("x"))
    task = "Give each numbered expression one label of: " + ", ".join(labels) + ". Answer with JSON: number, label, evidence from the line.\n"
    return per.select("doc_id", "batch", F.size("x").alias("n"), F.concat(F.lit(task), F.array_join(F.transform("x", lambda e: e["line"]), "\n")).alias("prompt"))


def merge_drafts(cands: DataFrame, drafts: DataFrame) -> DataFrame:
    """cands with a draft (doc_id, n, label, evidence) where its label is valid and its evidence is in the line, else none."""
    x = prompt_lines(cands).join(drafts.select("doc_id", "n", F.col("label").alias("draft"), "evidence"), ["doc_id", "n"], "left")
    sound = F.col("draft").isin(candidates.LABELS) & F.contains("line", F.trim("evidence"))
    return x.withColumn("draft", F.when(sound, F.col("draft"))).drop("line", "evidence")


def course_titles(text: Column) -> Column:
    """The different titles of courses that stand on a line of their own before the word for a syllabus; two are two courses."""
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(HEADING), F.lit(1)), lambda t: F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", " "), r"^[ \-–—:·()（）]+|[ \-–—:·()（）]+$", ""))
    good = F.filter(found, lambda t: (F.length(t) >= 4) & ~t.rlike(NO_COURSE) & t.rlike(r"[가-힣].*[가-힣]|[A-Za-z]+[^A-Za-z]+[A-Za-z]"))
    key = lambda t: F.lower(F.regexp_replace(t, r"(?U)[^\w]", ""))
    none = F.array().cast("array<string>")
    return F.aggregate(good, none, lambda acc, t: F.when(F.exists(acc, lambda a: key(a) == key(t)), acc).otherwise(F.concat(acc, F.array(t))))


def prefix_school(doc_id: Column, schools: dict[str, str]) -> Column:
    """The school of the longest slug that an id begins with."""
    out = F.lit(None).cast("string")
    for slug in sorted(schools, key=len):
        out = F.when(doc_id.startswith(slug), schools[slug]).otherwise(out)
    return out


def file_key(doc_id: Column) -> Column:
    """`school|title|instructor` of ids of the form `archive__number_school__title__instructor__hash`; else null."""
    p = r"^.+?__\d+_(.+?)__(.+?)__([^_]+?)__[0-9a-f]+$"
    part = lambda i: F.lower(F.regexp_extract(doc_id, p, i))
    title = F.regexp_replace(F.regexp_replace(part(2), "[^가-힣a-z0-9]", ""), "(i{1,3}|[12])$", "")
    return F.when(doc_id.rlike(p) & (F.length(title) >= 2), F.concat_ws("|", part(1), title, F.regexp_replace(part(3), r"\s", "")))

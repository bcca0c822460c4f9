"""Date and time candidates: extraction with offsets, classification and validation."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.text import context_blob
from termloom.operators.lineage import computed

# The shapes of date and time expressions.
PATTERNS = [
    r"(?<![가-힣])(?:[월화수목금토일]요일|[월화수목금토일](?![가-힣]))",
    r"(?i)\b(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\b",
    r"\d{1,2}:\d{2}\s*[~\-–—]\s*\d{1,2}:\d{2}",
    r"\d{1,2}:\d{2}",
    r"(?:오전|오후)?\s*\d{1,2}\s*시(?:\s*\d{1,2}\s*분)?(?:\s*[~\-–—]\s*(?:오전|오후)?\s*\d{1,2}\s*시(?:\s*\d{1,2}\s*분)?)?",
    r"(?i)\d{1,2}(?::\d{2})?\s*(?:AM|PM)",
    r"\d+(?:\s*,\s*\d+)*\s*교시",
    r"(?i)(?:\d+\s*주차)|(?:week\s*\d+)",
    r"\d+\s*(?:일차|강|회차)",
    r"\d{4}[.\-/]\s*\d{1,2}[.\-/]\s*\d{1,2}",
    r"(?:\d{4}\s*년\s*)?\d{1,2}\s*월\s*\d{1,2}\s*일",
    r"(?i)\d{1,2}(?:st|nd|rd|th)?\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)",
    r"\d{1,2}\s*월(?!\s*\d)",
    r"\d+\s*분(?:간)?",
    r"추후\s*공지|미정|추후\s*안내",
]
RECURRING = r"(?i)매주|매월|매일|격주|홀수\s*주|짝수\s*주|weekly|biweekly"
UNCERTAIN = r"(?U)추후\s*공지|미정|추후\s*안내|또는|말\b|초순|중순|하순|경\b"
RELATIVE = r"(?i)\d+\s*주차|week\s*\d+|\d+\s*(?:일차|강|회차)|^\s*\d{1,2}\s*월\s*$"
# Cues of the classifier, then of the validator.
OFFICE = ["면담", "상담", "office hour", "office location", "오피스아워", "office-hour", "appointment", "연구실", "webex 상담"]
TA = ["조교", "t/a", "ta ", " ta", "t.a", "teaching assistant"]
EXAM = ["시험", "고사", "exam", "midterm", "final", "퀴즈", "quiz"]
ASSIGNMENT = ["과제", "제출", "마감", "deadline", "assignment", "homework", "숙제", "레포트", "리포트"]
WEEK_PLAN = ["주차", "week", "강의계획", "진도", "차시", "주별"]
POLICY = ["정책", "규정", "policy", "유의사항", "안내사항", "성적", "출결"]
CLASS = ["수업", "강의", "class", "lecture", "정규"]
SAFE_OFFICE = ["면담", "상담", "office hour", "office location", "오피스아워", "appointment", "webex", "연구실 및 면담", "consultation"]
SAFE_EXAM = ["시험", "고사", "exam", "midterm", "퀴즈", "quiz"]
CLASS_SHAPE = r"(?:\d{1,2}:\d{2}|\d{1,2}\s*시)\s*[~\-–—]\s*(?:\d{1,2}:\d{2}|\d{1,2}\s*시)|\d*\s*교시"
CLASS_FIELD = r"(?i)강의\s*시간|수업\s*시간|강의\s*요일|수업\s*요일|class\s*time|class\s*hour|meeting\s*time|lecture\s*time"
LABELS = ["class_schedule", "instructor_office_hours", "ta_office_hours", "assignment_deadline", "exam_time", "weekly_plan", "policy_text", "unknown"]

_COMPILED = [re.compile(p) for p in PATTERNS]
_ASCII = [p for p, s in zip(_COMPILED, PATTERNS) if "week" in s or not re.search("[가-힣]", s)]  # the others need a Hangul letter


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType())]))


@F.pandas_udf(SPANS)
def spans(texts: pd.Series) -> pd.Series:
    """All matches of all patterns but those contained in another; Spark's functions give no offsets."""

    def one(t: str) -> list[dict]:
        t = t or ""
        found = sorted({m.span() for p in (_ASCII if t.isascii() else _COMPILED) for m in p.finditer(t) if m.end() > m.start()}, key=lambda s: (s[0], -s[1]))
        kept, reach = [], -1
        for a, b in found:  # by start, longest first: contained exactly if an earlier one reaches as far
            if b > reach:
                kept.append({"start": a, "end": b, "text": t[a:b]})
                reach = b
        return kept

    seen: dict = {}  # cells repeat
    return texts.map(lambda t: seen[t] if t in seen else seen.setdefault(t, one(t)))


def date_kind(text: Column) -> Column:
    return F.when(text.rlike(RECURRING), "recurring").when(text.rlike(UNCERTAIN), "uncertain").when(text.rlike(RELATIVE), "relative").otherwise("absolute")


def extract(docs: DataFrame, text_col: str = "text", window: int = 40) -> DataFrame:
    """docs' other columns with text, char_start, char_end, before, after and date_kind of each candidate."""
    t = F.col(text_col)
    x = docs.withColumn("__s", F.explode(spans(t)))
    a, b = F.col("__s.start"), F.col("__s.end")
    low = F.greatest(F.lit(0), a - window)
    text = F.trim(F.col("__s.text"))
    return x.select(*[c for c in docs.columns if c != text_col], text.alias("text"), a.alias("char_start"), b.alias("char_end"), F.substring(t, low + 1, a - low).alias("before"), F.substring(t, b + 1, F.lit(window)).alias("after"), date_kind(text).alias("date_kind"))


def last_table_hit_first(cands: DataFrame) -> DataFrame:
    """One candidate of each (doc, page, text): the last from a table, else the first from the page. Needs is_table, seq."""
    order = Window.partitionBy("doc_id", "page", "text").orderBy(F.desc("is_table"), F.when(F.col("is_table"), -F.col("seq")).otherwise(F.col("seq")))
    return cands.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def has_any(low: Column, cues: list[str]) -> Column:
    """Whether a text in lower case holds one of the cues; those beyond ASCII are sought in texts beyond ASCII only."""
    plain, more = F.lit(False), F.lit(False)
    for c in cues:
        hit = F.contains(low, F.lit(c))
        plain, more = (plain | hit, more) if c.isascii() else (plain, more | hit)
    return plain | ((F.length(low) < F.octet_length(low)) & more)


def _blob() -> Column:
    return F.concat_ws(" ", context_blob(*map(F.col, ("section", "row_label", "col_label", "before", "after"))), F.col("text"))


def _in_field() -> Column:
    return F.concat_ws(" ", "row_label", "col_label", "section").rlike(CLASS_FIELD)


def classify(cands: DataFrame) -> DataFrame:
    """label and confidence by cues, those of the candidate's own line before those of its whole context."""
    text, whole, line = F.col("text"), F.col("__whole"), F.col("__line")
    own = F.concat_ws(" ", "section", "row_label", "col_label", F.substring_index("before", "\n", -1), F.substring_index("after", "\n", 1), "text")
    scoped = cands.withColumns({"__whole": F.lower(_blob()), "__line": F.lower(own)})  # built once, looked through by all cues
    shape = text.rlike(CLASS_SHAPE)
    out = F.when(text.rlike(r"\d+\s*분(?:간)?") & ~F.contains(text, F.lit(":")) & ~F.contains(text, F.lit("시")), F.struct(F.lit("policy_text").alias("label"), F.lit(0.6).alias("confidence")))
    pick = lambda label, conf: F.struct(F.lit(label).alias("label"), F.lit(conf).alias("confidence"))
    for scope in (line, whole):
        office = has_any(scope, OFFICE)
        out = out.when(office & has_any(whole, TA), pick("ta_office_hours", 0.9)).when(office, pick("instructor_office_hours", 0.95))
        out = out.when(has_any(scope, ASSIGNMENT) | text.rlike(r"(?i)23:59|11:59\s*pm"), pick("assignment_deadline", 0.8)).when(has_any(scope, EXAM), pick("exam_time", 0.85))
    out = out.when(has_any(whole, WEEK_PLAN) & ~shape, pick("weekly_plan", 0.75)).when(has_any(whole, POLICY), pick("policy_text", 0.6))
    cue = has_any(whole, CLASS)
    out = out.when(cue & shape, pick("class_schedule", 0.9)).when(cue & _in_field() & text.rlike(r"\d{1,2}:\d{2}|\d{1,2}\s*시"), pick("class_schedule", 0.85)).otherwise(pick("unknown", 0.4))
    return computed(scoped, "__c", out).select(*cands.columns, "__c.label", "__c.confidence")


def validate(cands: DataFrame, block_events: bool = False) -> DataFrame:
    """Corrected label, in_class and reject_reason: what must never be a class meeting isn't one."""
    text, whole, field = F.col("text"), F.col("__whole"), F.col("__field")
    scoped = cands.withColumns({"__whole": F.lower(_blob()), "__field": _in_field()})
    ask = F.col("label") == "class_schedule"
    rule = lambda name, label: F.struct(F.lit(name).alias("reason"), F.lit(label).alias("label"))
    out = F.when(~ask, F.lit(None)).when(has_any(whole, SAFE_OFFICE) & has_any(whole, TA), rule("office_context", "ta_office_hours")).when(has_any(whole, SAFE_OFFICE), rule("office_context", "instructor_office_hours"))
    if block_events:
        out = out.when(~field & has_any(whole, SAFE_EXAM), rule("exam_context", "exam_time")).when(~field & has_any(whole, ASSIGNMENT), rule("assignment_context", "assignment_deadline"))
    out = out.when(text.rlike(r"^\s*\d+\s*분(?:간)?\s*$"), rule("duration", "policy_text"))
    out = out.when(text.rlike(r"(?i)\d+\s*주차|week\s*\d+") & ~text.rlike(r"\d{1,2}:\d{2}|\d{1,2}\s*시|교시"), rule("week_only", "weekly_plan"))
    out = out.when(~text.rlike(CLASS_SHAPE) & ~field, rule("point_time", "unknown"))
    d = computed(scoped, "__r", out)
    label = F.coalesce("__r.label", "label")
    return d.select(*[c for c in cands.columns if c != "label"], label.alias("label"), (label == "class_schedule").alias("in_class"), F.col("__r.reason").alias("reject_reason"))


def assemble(cands: DataFrame) -> DataFrame:
    """Per document: candidates, rejected and the class meetings with their status."""
    row = F.struct("char_start", "text", "label")
    out = cands.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("candidates"), F.array_sort(F.collect_list(F.when(F.col("reject_reason").isNotNull(), F.struct("char_start", "text", "reject_reason")))).alias("rejected"))
    meetings = F.filter("candidates", lambda c: c["label"] == "class_schedule")
    return out.withColumn("class_events", meetings).withColumn("status", F.when(F.size("class_events") > 0, "present").otherwise("not_specified"))

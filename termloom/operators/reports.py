"""Equality of field values, the gold trust gate, event alignment and the reports over records."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import norm_title
from termloom.operators.evaluate import ratio

# Names of terms by season, marks that confirm a cell, words for an empty cell.
SEASONS = {
    "spring": ["1", "1학기", "봄", "봄학기", "spring"], "summer": ["여름", "여름학기", "summer", "하계"],
    "fall": ["2", "2학기", "가을", "가을학기", "fall", "autumn"], "winter": ["겨울", "겨울학기", "winter", "동계"],
}
CONFIRMED = ["y", "yes", "o", "ok", "확정", "true", "1"]
NOTHING = ["null", "none", "없음", "해당없음", "n/a", "-"]


def norm(value: Column) -> Column:
    """Trimmed, lower case, single blanks, one kind of dash, numbers without an empty fraction; null is empty."""
    v = F.lower(F.trim(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"(?U)\s+", " ")))
    return F.regexp_replace(F.regexp_replace(v, "[–—]", "-"), r"^(\d+)\.0+$", "$1")


def segments(value: Column) -> Column:
    """The set of a value's segments between semicolons."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(norm(value), ";"), lambda s: F.trim(s)), lambda s: s != "")))


def class_segments(value: Column) -> Column:
    """Segments of class times, days in three letters, a list of days with one range taken apart."""
    day = r"(?:mon|tue|wed|thu|fri|sat|sun|[월화수목금토일])"
    one = F.transform(segments(value), lambda s: F.regexp_replace(F.regexp_replace(F.replace(s, F.lit("~"), F.lit("-")), r"\b(mon|tue|wed|thu|fri|sat|sun)[a-z]*", "$1"), "([월화수목금토일])요일", "$1"))
    clock = r"\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2}"
    many = rf"^{day}(?:[\s/,·]+{day})+[\s:]*{clock}$"
    split = F.transform(one, lambda s: F.when(s.rlike(many), F.transform(F.regexp_extract_all(s, F.lit(day), F.lit(0)), lambda d: F.concat(d, F.lit(" "), F.regexp_extract(s, clock, 0)))).otherwise(F.array(s)))
    return F.array_sort(F.array_distinct(F.flatten(split)))


def word_bags(value: Column) -> Column:
    """Segments as their sorted words, without punctuation and leading zeros."""
    bag = lambda s: F.array_join(F.array_sort(F.filter(F.split(F.regexp_replace(F.regexp_replace(s, r"(?U)[\W_]+", " "), r"\b0+(\d)", "$1"), " "), lambda w: w != "")), " ")
    return F.array_sort(F.array_distinct(F.filter(F.transform(segments(value), bag), lambda s: s != "")))


def values_match(kind: Column, a: Column, b: Column, aliases: dict[str, str] | None = None) -> Column:
    """Whether two values of a field say the same. kind: term, school, class_time, weekly_plan, set or another.

    Terms are equal by season, schools by the aliases' canonical name, class times and sets as sets of segments, weekly
    plans as sets of bags of words; a name without an alias stands for itself.
    """
    lookup = lambda table, v: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), v), v)
    season = {n: s for s, names in SEASONS.items() for n in names}
    same = lambda f: f(a) == f(b)
    out = F.when(kind == "term", same(lambda v: lookup(season, norm(v))))
    if aliases:
        out = out.when(kind == "school", same(lambda v: lookup({k.lower(): c.lower() for k, c in aliases.items()}, norm(v))))
    return out.when(kind == "class_time", same(class_segments)).when(kind == "weekly_plan", same(word_bags)).when(kind == "set", same(segments)).otherwise(same(norm))


def trust_cells(cells: DataFrame) -> DataFrame:
    """Confirmed cells (sid, field, kind, shown, hidden, blind, gold, mark) with gold, scored and agree.

    A word for nothing is an empty gold value. Assisted cells are held against what the reviewer saw, blind ones against
    the hidden draft; a cell that is empty on both sides is confirmed but not scored.
    """
    gold = F.trim(F.coalesce("gold", F.lit("")))
    x = cells.where(norm(F.col("mark")).isin(CONFIRMED)).withColumn("gold", F.when(~F.lower(gold).isin(NOTHING) & (gold != ""), gold))
    ref = F.when(F.col("blind"), F.col("hidden")).otherwise(F.col("shown"))
    has = norm(ref) != ""
    agree = F.col("gold").isNotNull() & has & values_match(F.col("kind"), ref, F.col("gold"))
    return x.withColumns({"scored": F.col("gold").isNotNull() | has, "agree": agree})


def trust_gate(cells: DataFrame) -> DataFrame:
    """One row: confirmed, empty, edit_rate of assisted cells, blind agreement, and the gap between both agreements."""
    x = trust_cells(cells)
    assisted, blind = F.col("scored") & ~F.col("blind"), F.col("scored") & F.col("blind")
    a, b = ratio(F.count_if(assisted & F.col("agree")), F.count_if(assisted)), ratio(F.count_if(blind & F.col("agree")), F.count_if(blind))
    return x.agg(F.count("*").alias("confirmed"), F.count_if(~F.col("scored")).alias("empty"), (1 - a).alias("edit_rate"), b.alias("blind_agreement"), (a - b).alias("gap"))


def edit_rates(cells: DataFrame) -> DataFrame:
    """field, n, edited of the assisted cells that are scored."""
    return trust_cells(cells).where("scored and not blind").groupBy("field").agg(F.count("*").alias("n"), F.count_if(~F.col("agree")).alias("edited"))


def _parts(value: str | None) -> list[tuple]:
    events = [[" ".join(p.lower().split()) for p in s.split("|")] for s in (value or "").split(";") if s.strip()]
    return [tuple((e + [""] * 4)[:4]) for e in events]


def align_events(gold: str | None, pred: str | None) -> dict:
    """Each gold event takes the unused prediction with most equal parts; ties go to the first."""
    want, left = _parts(gold), dict(enumerate(_parts(pred)))
    out = {"gold_events": len(want), "pred_events": len(left), "aligned": 0, "exact": 0, "title": 0, "type": 0, "date": 0, "date_kind": 0}
    for g in want:
        alike = {j: [x == y != "" for x, y in zip(g, p)] for j, p in left.items()}
        best = max(alike, key=lambda j: (sum(alike[j]), -j), default=None)
        if best is None or not any(alike[best]):
            continue
        out["aligned"] += 1
        out["exact"] += g == left.pop(best)
        for name, same in zip(("title", "type", "date", "date_kind"), alike[best]):
            out[name] += same
    return out


def event_alignment(cells: DataFrame) -> DataFrame:
    """method, counts of gold and predicted events, of aligned and of equal ones, and of each part. cells: method, gold, value."""
    names = ["gold_events", "pred_events", "aligned", "exact", "title", "type", "date", "date_kind"]

    @F.pandas_udf(", ".join(f"{n} int" for n in names))
    def stats(gold: pd.Series, pred: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([align_events(g, p) for g, p in zip(gold, pred)], columns=names)

    x = cells.select("method", stats("gold", "value").alias("s"))
    return x.groupBy("method").agg(*[F.sum(f"s.{n}").alias(n) for n in names])


def fill_rates(records: DataFrame, fields: list[str]) -> DataFrame:
    """field, n, filled, rate: how many records have something in the field."""
    one = records.agg(F.count("*").alias("n"), *[F.count_if(F.trim(F.col(f).cast("string")) != "").alias(f) for f in fields])
    return one.unpivot("n", fields, "field", "filled").select("field", "n", "filled", ratio(F.col("filled"), F.col("n")).alias("rate"))


def coverage_compare(values: DataFrame) -> DataFrame:
    """field, method, filled: counts of values (method, field, value) that are not blank."""
    return values.groupBy("field", "method").agg(F.count_if(F.trim("value") != "").alias("filled"))


def kb_coverage(events: DataFrame, current: int) -> DataFrame:
    """era, path, n of events (academic_year, resolved_by): current, past or unknown, and how the date was found."""
    era = F.when(F.col("academic_year").isNull(), "unknown").when(F.col("academic_year") >= current, "current").otherwise("past")
    return events.groupBy(era.alias("era"), F.coalesce("resolved_by", F.lit("unresolved")).alias("path")).agg(F.count("*").alias("n"))


def top_reasons(rows: DataFrame, k: int = 8, col: str = "reason") -> DataFrame:
    """The k most frequent reasons; ties by name."""
    return rows.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(k)


def risk_counters(compiled: DataFrame) -> DataFrame:
    """One row: confirmed events without evidence, class days on a holiday, office hours as classes.

    compiled: bucket, resolved_by, kind, on_holiday, label.
    """
    sure = F.col("bucket") == "confirmed"
    lesson = sure & (F.col("kind") == "class")
    return compiled.agg(F.count_if(sure & F.col("resolved_by").isNull()).alias("unfounded"), F.count_if(lesson & F.col("on_holiday")).alias("class_on_holiday"), F.count_if(lesson & F.col("label").contains("office")).alias("office_as_class"))


def false_positives(rows: DataFrame, target: str = "class_schedule") -> DataFrame:
    """truth, n: what the rows (truth, prediction) really are that were taken for the target."""
    return rows.where((F.col("prediction") == target) & (F.col("truth") != target)).groupBy("truth").agg(F.count("*").alias("n"))


def rejects(rows: DataFrame, examples: int = 6) -> DataFrame:
    """reject_reason, n, examples (the first texts by order) of rejected rows."""
    at = F.row_number().over(Window.partitionBy("reject_reason").orderBy("text"))
    texts = rows.where("reject_reason is not null").select("reject_reason", "text").distinct().withColumn("at", at).where(F.col("at") <= examples)
    some = texts.groupBy("reject_reason").agg(F.array_sort(F.collect_list("text")).alias("examples"))
    return rows.where("reject_reason is not null").groupBy("reject_reason").agg(F.count("*").alias("n")).join(some, "reject_reason")


def week_recall(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """One row: weeks of gold plans (doc_id, week, topic), those that the predicted plan has, and the mean share of words."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    x = gold.join(pred.select("doc_id", "week", F.col("topic").alias("said")).dropDuplicates(["doc_id", "week"]), ["doc_id", "week"], "left")
    share = ratio(F.size(F.array_intersect(words("topic"), words("said"))), F.size(words("topic")))
    return x.agg(F.count("*").alias("weeks"), F.count("said").alias("hits"), F.avg(F.when(F.col("said").isNotNull(), share)).alias("words"))


def agreement(rows: DataFrame) -> DataFrame:
    """One row: the share of rows whose prediction is that of the heuristic."""
    return rows.agg(F.count("*").alias("n"), F.avg((F.col("prediction") == F.col("heuristic")).cast("int")).alias("agreement"))


def metadata_key(school_: Column, title: Column, instructor: Column) -> Column:
    """school|title|instructor in a normal form; null without a title of two letters."""
    t = norm_title(title)
    who = F.lower(F.regexp_replace(F.coalesce(instructor, F.lit("")), r"(?U)\s+", ""))
    return F.when(F.length(t) >= 2, F.concat_ws("|", F.lower(F.coalesce(school_, F.lit(""))), t, who))


def cluster_reasons(members: DataFrame) -> DataFrame:
    """cluster, size, reason of clusters (cluster, doc_id, file_key, meta_key) of two or more.

    `same_course` if one file key, or one metadata key, covers all members, else `template_near_identical`.
    """
    one = lambda c: (F.count_distinct(c) == 1) & (F.count(c) == F.count("*"))
    x = members.groupBy("cluster").agg(F.count("*").alias("size"), (one("file_key") | one("meta_key")).alias("same")).where("size > 1")
    return x.select("cluster", "size", F.when(F.col("same"), "same_course").otherwise("template_near_identical").alias("reason"))

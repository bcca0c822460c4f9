"""Method harness: methods side by side with gold values, verdicts and win rates, event strings, review sheets, classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.operators import candidates, evaluate
from termloom.operators.reports import norm

# The mark of a missing gold value, and of one that is meant to be empty.
PENDING, EMPTY = "라벨대기", "<null>"


def display(c: Column, kind: T.DataType) -> Column:
    """A value as text: scalars as they are, others as JSON."""
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else c.cast("string")


def render(stamp: Column) -> Column:
    """A stamp of a sheet: the date at midnight, else the clock time."""
    return F.when(F.date_format(stamp, "HH:mm:ss") == "00:00:00", F.date_format(stamp, "yyyy-MM-dd")).otherwise(F.date_format(stamp, "HH:mm"))


def harness_rows(values: DataFrame, evals: dict[str, str], methods: list[str]) -> DataFrame:
    """doc_id, field, eval, one column a method, gold (pending): every field of every document of values (doc_id, field, method, value)."""
    grid = values.select("doc_id").distinct().select("doc_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(e).alias("eval")) for f, e in evals.items()])).alias("f")).select("doc_id", "f.*")
    wide = values.where(F.col("field").isin(*evals)).groupBy("doc_id", "field").pivot("method", methods).agg(F.min("value"))
    return grid.join(wide, ["doc_id", "field"], "left").withColumn("gold", F.lit(PENDING))


def is_correct(pred: Column, gold: Column, kind: Column) -> Column:
    """Null without a gold value; a missing value is right where none is meant; fuzzy values may hold one another."""
    squeeze = lambda c: F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))
    p, g = squeeze(pred), squeeze(gold)
    return F.when(gold.isNull() | gold.isin("", PENDING), None).when(pred.isNull() | (pred == ""), gold == EMPTY).when(kind == "fuzzy", F.contains(p, g) | F.contains(g, p)).otherwise(p == g)


def long_methods(rows: DataFrame, methods: list[str], keep: list[str]) -> DataFrame:
    """One row for each method's value."""
    return rows.select(*keep, F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).cast("string").alias("value")) for m in methods])).alias("v")).select(*keep, "v.*")


def win_rates(rows: DataFrame, methods: list[str]) -> DataFrame:
    """field, method, n, win_rate, winner (the method with the best rate, the first listed of a tie) of harness rows."""
    x = long_methods(rows, methods, ["field", "eval", "gold"]).withColumn("ok", is_correct(F.col("value"), F.col("gold"), F.col("eval")))
    t = x.where("ok is not null").groupBy("field", "method").agg(F.count("*").alias("n"), F.avg(F.col("ok").cast("double")).alias("win_rate"))
    order = F.array_position(F.array(*map(F.lit, methods)), F.col("method"))
    best = t.groupBy("field").agg(F.max_by("method", F.struct("win_rate", -order)).alias("winner"))  # a row a field and method
    return t.join(best, "field")


def exact_ok(pred: Column, gold: Column) -> Column:
    """Equality of sheet values; null where either is blank. Week numbers and separators may be written either way."""
    tidy = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(norm(c), r"\s*([;|~:])\s*", "$1"), r"\bweek\s*0(\d)\b", "week $1"), r"\b0(\d)\s*주차", "$1주차")
    return F.when((norm(pred) != "") & (norm(gold) != ""), tidy(pred) == tidy(gold))


def sheet_rates(cells: DataFrame) -> DataFrame:
    """field, method, coverage, n_scored, acc of cells (field, method, value, gold)."""
    ok = exact_ok(F.col("value"), F.col("gold"))
    return cells.groupBy("field", "method").agg(F.count_if(norm(F.col("value")) != "").alias("coverage"), F.count(ok).alias("n_scored"), F.avg(ok.cast("double")).alias("acc"))


def gold_sheet(wide: DataFrame, names: list[str], columns: dict[str, str], key: str) -> DataFrame:
    """key, field, one column for each of columns, of a wide sheet whose columns are prefix_field; missing ones are null."""
    cell = lambda prefix, f: F.nullif(F.trim(F.col(f"`{prefix}_{f}`").cast("string")), F.lit("")) if f"{prefix}_{f}" in wide.columns else F.lit(None).cast("string")
    one = lambda f: F.struct(F.lit(f).alias("field"), *[cell(p, f).alias(c) for c, p in columns.items()])
    return wide.select(key, F.explode(F.array(*map(one, names))).alias("x")).select(key, "x.*")


def stable_winners(gold: DataFrame, preds: DataFrame, caution: DataFrame, high_risk: list[str]) -> DataFrame:
    """field, winner, without, stable: winners over all documents and without those (sid) to be cautious of."""
    name = lambda g: evaluate.pick_winner(evaluate.method_metrics(g, preds), high_risk).select("field", F.col("method").alias("winner"))
    rest = name(gold.join(caution.select("sid"), "sid", "left_anti")).withColumnRenamed("winner", "without")
    return name(gold).join(rest, "field", "left").withColumn("stable", F.col("winner").eqNullSafe(F.col("without")))


def serialize_events(events: DataFrame) -> DataFrame:
    """doc_id, value: events (doc_id, seq, title, kind, raw_reference, date_kind) as `title | kind | date | kind of date ; ...`."""
    text = F.concat_ws(" | ", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("?")), *[F.coalesce(c, F.lit("")) for c in ("kind", "raw_reference", "date_kind")])
    per = events.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", text.alias("s")))).alias("x"))  # the events of one document
    return per.select("doc_id", F.array_join(F.transform("x", lambda e: e["s"]), " ; ").alias("value"))


def parse_events(value: Column) -> Column:
    """array<struct<title, kind, raw_reference, date_kind>> of an event string; missing parts are empty."""
    names = ("title", "kind", "raw_reference", "date_kind")
    parts = F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ";"), lambda s: F.trim(s)), lambda s: s != "")
    return F.transform(parts, lambda s: F.struct(*[F.trim(F.coalesce(F.get(F.split(s, r"\|"), F.lit(i)), F.lit(""))).alias(n) for i, n in enumerate(names)]))


def softmax(logits: Column) -> Column:
    """Probabilities of an array of scores; null and empty stay."""
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def from_scores(scores, threshold: float | None = None, labels: list[str] = candidates.LABELS, target: str = "class_schedule"):
    """A classifier from a function of candidates to an array column of a score a label (a model's batch function, say).

    Where the best label is the target with a probability below the threshold, the runner-up is taken.
    """

    def classify(cands: DataFrame) -> DataFrame:
        ranked = lambda p: F.reverse(F.array_sort(F.transform(p, lambda q, i: F.struct(q.alias("p"), (-i).alias("i")))))
        x = cands.withColumn("__r", ranked(softmax(scores(cands))))
        first, second = F.get("__r", F.lit(0)), F.get("__r", F.lit(1))
        weak = (F.get(F.array(*map(F.lit, labels)), -first["i"]) == target) & (first["p"] < F.lit(threshold))
        best = F.when(weak, second).otherwise(first)
        return x.select(*cands.columns, F.get(F.array(*map(F.lit, labels)), -best["i"]).alias("label"), best["p"].alias("confidence"))

    return classify


def load_classifier(config: dict, scores=None):
    """The classifier that a configuration names: `heuristic`, or `scores` with its threshold."""
    kinds = {"heuristic": lambda: candidates.classify, "scores": lambda: from_scores(scores, config.get("threshold"))}
    return kinds[config.get("classifier", "heuristic")]()


def review_fields(records: DataFrame, events: DataFrame, plans: DataFrame) -> DataFrame:
    """The fields of a review sheet of records: contacts joined, events and weekly plans as strings, the number of weeks.

    records: doc_id, title_ko, title_en, course_code, instructor, email, phone, credits, location, class_time, school,
    academic_year, term; events: see serialize_events; plans: doc_id, rows, total_weeks.
    """
    week = lambda r: F.concat(F.lit("Week "), r["week"].cast("string"), F.lit(": "), r["topic"])
    shown = F.array_join(F.transform(F.filter("rows", lambda r: r["week"].isNotNull() & (F.trim(r["topic"]) != "")), week), " ; ")
    p = plans.select("doc_id", F.col("total_weeks").alias("weeks"), F.nullif(shown, F.lit("")).alias("weekly_plan"))
    contact = F.nullif(F.concat_ws(" ; ", F.nullif("email", F.lit("")), F.nullif("phone", F.lit(""))), F.lit(""))
    r = records.select("doc_id", F.coalesce(F.nullif("title_ko", F.lit("")), "title_en").alias("title"), "course_code", "instructor", contact.alias("contact"), "credits", "location", "class_time", "school", "academic_year", "term")
    return reduce(lambda a, b: a.join(b, "doc_id", "left"), [r, serialize_events(events).withColumnRenamed("value", "events"), p])

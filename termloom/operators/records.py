"""Records of documents: picking values by source, cross checks, school names, dates of relative references, data sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.dates import parse_week_reference, week_range
from termloom.operators.candidates import LABELS
from termloom.operators.evaluate import hash_order

# What a department's name ends with, and the words for a university.
DEPARTMENT = r"(?i)(?:학과|학부|전공|department|school of [a-z ]+)$"
UNIVERSITY = r"([가-힣A-Za-z]{2,20}대학교)"


def get_path(record: DataFrame, path: str) -> Column:
    """A dotted path into structs; the first element of an array on the way; null where something is missing."""
    names = path.split(".")
    col, kind = F.col(names[0]), record.schema[names[0]].dataType
    for name in [*names[1:], None]:
        if isinstance(kind, T.ArrayType):
            col, kind = F.get(col, F.lit(0)), kind.elementType
        if name:
            col, kind = col[name], kind[name].dataType
    return col


def empty_record(schema: T.StructType) -> Column:
    """A struct of nulls, with empty arrays."""
    one = lambda f: (F.array().cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else empty_record(f.dataType) if isinstance(f.dataType, T.StructType) else F.lit(None).cast(f.dataType)).alias(f.name)
    return F.struct(*map(one, schema.fields))


def first_filled(*values: Column) -> Column:
    """The first value that is not blank."""
    return F.coalesce(*[F.when(F.trim(v.cast("string")) != "", v) for v in values])


def build_records(fields: DataFrame, sources: list[str], fixed: dict[str, str]) -> DataFrame:
    """doc_id, field, value, source: of the values (doc_id, field, source, value) the one of the field's fixed source, else
    the first filled one in the order of sources."""
    order = F.array_position(F.array(*map(F.lit, sources)), F.col("source"))
    own = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in fixed.items() for x in kv]).cast("map<string,string>"), F.col("field")), F.col("source"))
    ok = (F.trim("value") != "") & (order > 0) & (own == F.col("source"))
    best = F.min_by(F.struct("value", "source"), F.struct(order, "value"))
    return fields.where(ok).groupBy("doc_id", "field").agg(best.alias("b")).select("doc_id", "field", "b.value", "b.source")


def cross_validate(records: DataFrame, dates: Column) -> DataFrame:
    """records (school, department, academic_year, resolved_date, ...) with what contradicts itself taken back, and flags.

    A school that reads like a department is moved there, a department that equals the school goes, a year outside of
    2000 to 2035 goes, and so does a date that is not among the document's dates.
    """
    swap = F.col("school").rlike(DEPARTMENT)
    school = F.when(~swap, F.col("school"))
    dept = F.when(swap, F.coalesce("department", "school")).otherwise(F.col("department"))
    same = dept == school
    odd = ~F.col("academic_year").between(2000, 2035)
    lost = F.col("resolved_date").isNotNull() & ~F.coalesce(F.array_contains(dates, F.col("resolved_date")), F.lit(False))
    flag = lambda c, name: F.when(c, F.lit(name))
    flags = F.array_compact(F.array(flag(swap, "school_is_department"), flag(same, "department_is_school"), flag(odd, "year_out_of_range"), flag(lost, "date_without_evidence")))
    return records.withColumns({
        "flags": flags, "school": school, "department": F.when(same, None).otherwise(dept),
        "academic_year": F.when(odd, None).otherwise(F.col("academic_year")), "resolved_date": F.when(lost, None).otherwise(F.col("resolved_date")),
    })


def dictionary_school(text: Column, names: list[tuple[str, str]]) -> Column:
    """The canonical name whose aliases (canonical, alias) a text holds most often; of a tie the one that comes first.

    Acronyms of up to five capitals count as whole words in that case only, other aliases in any case.
    """
    low = F.lower(text)

    def hits(alias: str) -> tuple[Column, Column]:
        if alias.isascii() and alias.isupper() and len(alias) <= 5:
            word = rf"(?<![A-Za-z0-9]){alias}(?![A-Za-z0-9])"
            return F.regexp_count(text, F.lit(word)), F.length(F.substring_index(text, alias, 1))
        a = alias.lower()
        return (F.length(low) - F.length(F.replace(low, F.lit(a), F.lit("")))) / len(a), F.instr(low, a) - 1

    by: dict[str, list] = {}
    for canonical, alias in names:
        by.setdefault(canonical, []).append(hits(alias))
    score = lambda hs: F.struct(reduce(Column.__add__, [n for n, _ in hs]).cast("double").alias("n"), (-F.least(F.lit(1 << 30), *[F.when(n > 0, at) for n, at in hs])).alias("at"))
    best = F.array_max(F.array(*[F.struct(score(hs).alias("s"), F.lit(c).alias("name")) for c, hs in by.items()]))
    return F.when(best["s"]["n"] > 0, best["name"])


def domain_school(text: Column, domains: dict[str, str]) -> Column:
    """The school of the first e-mail address or link whose host is, or ends with a dot and, one of the domains."""
    hosts = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(?:@|https?://)([a-z0-9-]+(?:\.[a-z0-9-]+)+)"), F.lit(1)), lambda h: F.split(h, r"\."))
    known = F.create_map(*[F.lit(x) for kv in domains.items() for x in kv])
    tail = lambda h: F.transform(F.sequence(F.lit(1), F.size(h)), lambda i: F.try_element_at(known, F.array_join(F.slice(h, i, F.size(h)), ".")))
    return F.get(F.array_compact(F.flatten(F.transform(hosts, tail))), F.lit(0))


def surface_school(text: Column, head: int = 300) -> Column:
    """The first name of a university in the head of a text."""
    return F.nullif(F.regexp_extract(F.substring(text, 1, head), UNIVERSITY, 1), F.lit(""))


def school(text: Column, names: list[tuple[str, str]], domains: dict[str, str], head: int = 300) -> Column:
    """By the dictionary in the head, by a domain, by the name of a university in the head, by the dictionary anywhere."""
    return F.coalesce(dictionary_school(F.substring(text, 1, head), names), domain_school(text, domains), surface_school(text, head), dictionary_school(text, names))


def resolve_record_dates(entries: DataFrame, calendars: DataFrame) -> DataFrame:
    """entries (doc_id, seq, cal_key, raw_reference, date_kind, resolved_date) with relative references resolved.

    calendars: cal_key, term_start, confidence. A week with a weekday becomes a date, a week alone the range of its days,
    which stays for review. Nothing else is touched, and a calendar of low confidence resolves nothing.
    """
    ok = F.lower(F.coalesce("confidence", F.lit("high"))).isin("high", "높음") & F.col("term_start").isNotNull()
    cal = calendars.where(ok).select("cal_key", "term_start")
    ref = parse_week_reference(F.col("raw_reference"))
    x = entries.join(cal, "cal_key", "left").withColumn("ref", ref)
    days = F.array(*map(F.lit, ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]))
    nth = F.nullif(F.array_position(days, F.col("ref.weekday")), F.lit(0)).cast("int")
    open_ = F.col("resolved_date").isNull() & (F.col("date_kind") == "relative") & F.col("term_start").isNotNull() & F.col("ref.week").isNotNull()
    week = week_range(F.col("term_start"), F.col("ref.week"))
    x = x.withColumns({"week": F.when(open_ & nth.isNull(), week), "day": F.when(open_, F.date_add(week["start"], nth - 1))})
    by = F.when(F.col("day").isNotNull() | F.col("week").isNotNull(), "academic_calendar_kb")
    return x.select("doc_id", "seq", F.coalesce("resolved_date", "day").alias("resolved_date"), F.col("week.start").alias("week_start"), F.col("week.end").alias("week_end"), by.alias("resolved_by"))


def dataset_rows(labelled: DataFrame) -> DataFrame:
    """Rows with a valid label, corrected before predicted, whether it is a class, and who gave it."""
    label = F.coalesce(F.nullif(F.trim("corrected"), F.lit("")), F.nullif(F.trim("predicted"), F.lit("")))
    human = F.coalesce(F.trim("corrected") != "", F.lit(False))
    x = labelled.withColumn("label", label).where(F.col("label").isin(LABELS))
    return x.withColumns({"include_in_class_schedule": F.col("label") == "class_schedule", "source": F.when(human, "human").otherwise("llm_draft")})


def split_docs(docs: DataFrame, id_col: str = "doc_id", dev: float = 0.6, seed: int = 42) -> DataFrame:
    """id, part: dev or holdout, by hash, so that no list of ids is sorted in one task."""
    u = F.conv(F.substring(hash_order(id_col, seed), 1, 8), 16, 10).cast("double") / 2**32
    return docs.select(id_col).distinct().withColumn("part", F.when(u < dev, "dev").otherwise("holdout"))


def restrict(rows: DataFrame, ids: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """rows whose key is, or is not, among the ids."""
    return rows.join(ids.select(key), key, "left_semi" if keep else "left_anti")


def not_in_train(augmented: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Keys of augmented rows that the training part lacks: none, if the augmentation is sound."""
    return augmented.select(key).distinct().join(train.select(key), key, "left_anti")


def carry_forward(rows: DataFrame, part: str, order: str, value: str) -> DataFrame:
    """rows with blanks of a column filled by the last value before them in their part."""
    w = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(value, F.last(F.nullif(F.trim(value), F.lit("")), ignorenulls=True).over(w))


def whole_clusters(clusters: DataFrame, target: int, seed: int = 42) -> DataFrame:
    """Clusters (cluster, size) in the order of their hash, as long as those before hold less than the target.

    Only the first `target` clusters of that order can be taken, so the running sum is over no more rows.
    """
    first = clusters.withColumn("h", hash_order("cluster", seed)).orderBy("h", "cluster").limit(target)
    before = F.coalesce(F.sum("size").over(Window.orderBy("h", "cluster").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return first.withColumn("before", before).where(F.col("before") < target).select("cluster", "size")


def corpus_rows(docs: DataFrame, reviewed: DataFrame, stratum: str, key: str, n: int, prefix: str, seed: int = 42) -> DataFrame:
    """n documents that were not reviewed, by turns from the strata in the order of their hash, with new ids."""
    left = restrict(docs, reviewed, key, keep=False)
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy(hash_order(key, seed)))
    taken = left.withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", hash_order(key, seed)).limit(n)
    at = F.row_number().over(Window.orderBy("turn", hash_order(key, seed)))  # n rows
    return taken.withColumn("review_id", F.format_string(f"{prefix}-%03d", at)).select(*docs.columns, "review_id")


def augment(rows: DataFrame, key: str, text: str, n: int, synonyms: dict[str, str], share: float = 0.5, seed: int = 42) -> DataFrame:
    """rows and n variants of each, variant 0 being the row: words swapped for synonyms and clock times written out.

    Which words a variant swaps follows from a hash of seed, key, variant and word, so every run gives the same rows.
    """
    x = rows.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(n))))
    draw = lambda word: (F.pmod(F.xxhash64(F.lit(seed), key, "variant", F.lit(word)), F.lit(1000)) < int(1000 * share)) & (F.col("variant") > 0)
    out = F.col(text)
    for word, other in synonyms.items():
        out = F.when(draw(word), F.replace(out, F.lit(word), F.lit(other))).otherwise(out)
    out = F.when(draw(":"), F.regexp_replace(out, r"\b(\d{1,2}):(\d{2})\b", "$1시 $2분")).otherwise(out)
    return x.withColumn(text, out)

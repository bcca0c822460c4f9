"""Queries of records, guards and reports over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.operators import guards, records, reports
from termloom.operators.skew import dealt
from termloom.plans.base import query, table

def key() -> Column:
    return F.col("o_orderkey")


def orders(spark, sf_dir, by: str = "o_orderkey"):
    return dealt(table(spark, sf_dir, "orders"), by).withColumn("d", F.col("o_orderdate").cast("date"))


def turn(n: int, *values) -> Column:
    """The value of the order's key modulo n; null beyond those given."""
    out = F.when(key() % n == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(key() % n == i, v)
    return out


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ',' || strftime(o_orderdate, '%m-%d') as dates, o_orderkey % 3 = 0 as evidenced from orders")
def document_dates(spark, sf_dir):
    d = F.col("d")
    text = F.concat(F.lit("Exam on "), d.cast("string"), F.lit(", that is "), F.month(d).cast("string"), F.lit("월 "), F.day(d).cast("string"), F.lit("일."))
    x = orders(spark, sf_dir).withColumn("dates", guards.document_dates(text))
    return x.select("o_orderkey", F.array_join("dates", ",").alias("dates"), guards.is_evidenced(F.date_add(d, (key() % 3).cast("int")).cast("string"), F.col("dates")).alias("evidenced"))


@query("select o_orderkey as doc_id, case o_orderkey % 5 when 1 then 'Homework 1' else 'Midterm Exam' end as title, case o_orderkey % 5 when 1 then 'undated' else 'dated' end as outlet, case o_orderkey % 5 when 0 then 'absolute' else 'uncertain' end as date_kind, case o_orderkey % 5 when 0 then strftime(o_orderdate, '%Y-%m-%d') end as resolved_date, o_orderkey % 5 > 0 as needs_review from orders where o_orderkey % 5 in (0, 1, 3)")
def risk_gate(spark, sf_dir):
    o, day = orders(spark, sf_dir), F.col("d").cast("string")
    docs = o.select(key().alias("doc_id"), F.concat(F.lit("Midterm  exam: "), day, F.lit("\nHomework 1\nReport")).alias("text"))
    events = o.select(
        key().alias("doc_id"), F.lit(1).alias("seq"), turn(5, F.lit("Midterm Exam"), F.lit("Homework 1"), F.lit("Quiz 9"), F.lit("Midterm Exam"), F.lit("Report")).alias("title"),
        turn(5, F.lit("exam"), F.lit("assignment"), F.lit("exam"), F.lit("exam"), F.lit("assignment")).alias("type"), turn(5, day, F.lit(None), day, F.date_add("d", 1).cast("string")).alias("date_raw"),
    )
    return guards.risk_gate(events, docs).select("doc_id", "title", "outlet", "date_kind", "resolved_date", "needs_review")


@query("select o_custkey as doc_id, o_orderkey as seq from orders where o_orderkey % 2 = 1 or o_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')")
def no_session_exams(spark, sf_dir):
    o = orders(spark, sf_dir).withColumn("doc_id", F.col("o_custkey"))
    rows = o.select("doc_id", F.when(F.col("o_orderpriority") == "1-URGENT", "No class (mid-term)").otherwise("Midterm review").alias("topic"), F.lit(None).cast("array<string>").alias("extras"))
    events = o.select("doc_id", key().alias("seq"), turn(2, F.lit("exam"), F.lit("assignment")).alias("kind"), F.lit("Mid term").alias("title"), F.lit(None).cast("string").alias("raw_reference"))
    return guards.suppress_no_session_exams(events, rows).select("doc_id", "seq")


@query("select o_custkey as doc_id, min(o_orderkey) as seq, o_orderpriority as title from orders o where o_orderstatus = 'O' and not exists (select 1 from orders p where p.o_custkey = o.o_custkey and p.o_orderpriority = o.o_orderpriority and p.o_orderstatus <> 'O') group by 1, 3")
def scheduled_titles(spark, sf_dir):
    o = orders(spark, sf_dir).select(F.col("o_custkey").alias("doc_id"), key().alias("seq"), F.col("o_orderpriority").alias("title"), "o_orderstatus")
    plan = o.where("o_orderstatus = 'P'").select("doc_id", F.lit(None).cast("string").alias("topic"), F.array("title").alias("extras"))
    return guards.suppress_scheduled(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), plan)


@query("select o_orderkey as doc_id, 'title' as field, case o_orderkey % 2 when 0 then o_orderstatus else o_orderpriority end as value, case o_orderkey % 2 when 0 then 'table' else 'rule' end as source from orders union all select o_orderkey, 'term', o_orderstatus, 'table' from orders where o_orderkey % 3 > 0")
def built_records(spark, sf_dir):
    cell = lambda field, source, value: F.struct(F.lit(field).alias("field"), F.lit(source).alias("source"), value.alias("value"))
    cells = F.array(
        cell("title", "rule", turn(2, F.lit(" "), F.col("o_orderpriority"))), cell("title", "table", F.col("o_orderstatus")),
        cell("term", "rule", F.lit("1")), cell("term", "table", F.when(key() % 3 > 0, F.col("o_orderstatus"))),
    )
    return records.build_records(orders(spark, sf_dir).select(key().alias("doc_id"), F.inline(cells)), ["rule", "table"], {"term": "table"})


@query("with o as (select o_orderkey, year(o_orderdate) + o_orderkey % 2 * 10 as y from orders) select o_orderkey, case when o_orderkey % 3 > 0 then 'Alpha' end as school, case o_orderkey % 3 when 0 then '통계학과' when 1 then null else 'Statistics' end as department, case when y between 2000 and 2035 then y end::int as academic_year, o_orderkey % 4 > 0 as dated, concat_ws(',', case when o_orderkey % 3 = 0 then 'school_is_department' end, case when o_orderkey % 3 = 1 then 'department_is_school' end, case when y not between 2000 and 2035 then 'year_out_of_range' end, case when o_orderkey % 4 = 0 then 'date_without_evidence' end) as flags from o")
def cross_checks(spark, sf_dir):
    day = F.col("d").cast("string")
    r = orders(spark, sf_dir).select(
        "o_orderkey", turn(3, F.lit("통계학과"), F.lit("Alpha"), F.lit("Alpha")).alias("school"), turn(3, F.lit(None).cast("string"), F.lit("Alpha"), F.lit("Statistics")).alias("department"),
        (F.year("d") + key() % 2 * 10).cast("int").alias("academic_year"), day.alias("resolved_date"), F.when(key() % 4 > 0, F.array(day)).otherwise(F.array(F.lit("12-34"))).alias("dates"),
    )
    return records.cross_validate(r, F.col("dates")).select("o_orderkey", "school", "department", "academic_year", F.col("resolved_date").isNotNull().alias("dated"), F.array_join("flags", ",").alias("flags"))


@query("select o_orderkey, case o_orderkey % 4 when 0 then 'Alpha University' when 1 then 'Beta University' when 2 then '감마대학교' end as school from orders")
def school_names(spark, sf_dir):
    names = [("Alpha University", "Alpha University"), ("Alpha University", "AU"), ("Beta University", "beta univ")]
    text = turn(4, F.lit("AU courses; write to x@cs.beta.example"), F.lit("Write to x@cs.beta.example"), F.lit("감마대학교 강의"), F.lit("TAU and AUT, x@notbeta.example"))
    return orders(spark, sf_dir).select("o_orderkey", records.school(text, names, {"beta.example": "Beta University"}).alias("school"))


@query("with e as (select o_orderkey, o_custkey % 25 as k, (o_orderkey % 15)::int as w from orders), f as (select *, (date_trunc('week', date '1995-09-01' + k::int) + interval (7 * w) day)::date as monday from e) select o_orderkey as doc_id, case when k % 2 = 0 and o_orderkey % 2 = 0 then monday + 1 end as resolved_date, case when k % 2 = 0 and o_orderkey % 2 = 1 then monday end as week_start, case when k % 2 = 0 and o_orderkey % 2 = 1 then monday + 6 end as week_end, case when k % 2 = 0 then 'academic_calendar_kb' end as resolved_by from f")
def record_dates(spark, sf_dir):
    n = F.col("n_nationkey")
    cal = table(spark, sf_dir, "nation").select(n.cast("long").alias("cal_key"), F.date_add(F.lit("1995-09-01").cast("date"), n).alias("term_start"), F.when(n % 2 == 0, "high").otherwise("low").alias("confidence"))
    raw = F.concat(F.lit("Week "), (key() % 15 + 1).cast("string"), turn(2, F.lit(" Tue"), F.lit("")))
    e = orders(spark, sf_dir).select(key().alias("doc_id"), F.lit(1).alias("seq"), (F.col("o_custkey") % 25).alias("cal_key"), raw.alias("raw_reference"), F.lit("relative").alias("date_kind"), F.lit(None).cast("date").alias("resolved_date"))
    return records.resolve_record_dates(e, cal).drop("seq")


@query("with o as (select o_orderkey, case o_orderkey % 3 when 0 then 'exam_time' when 1 then ' ' end as c, case o_orderkey % 2 when 0 then 'class_schedule' else 'bogus' end as p from orders) select o_orderkey, coalesce(nullif(trim(c), ''), p) as label, o_orderkey % 3 > 0 as include_in_class_schedule, case when o_orderkey % 3 = 0 then 'human' else 'llm_draft' end as source from o where o_orderkey % 3 = 0 or o_orderkey % 2 = 0")
def dataset_rows(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey", turn(3, F.lit("exam_time"), F.lit(" ")).alias("corrected"), turn(2, F.lit("class_schedule"), F.lit("bogus")).alias("predicted"))
    return records.dataset_rows(o).drop("corrected", "predicted")


@query("select c_custkey, case when ('0x' || md5('42:' || c_custkey)[:8])::bigint / 4294967296.0 < 0.6 then 'dev' else 'holdout' end as part from customer")
def document_split(spark, sf_dir):
    return records.split_docs(table(spark, sf_dir, "customer"), "c_custkey")


@query("select o_orderkey, last_value(nullif(case when o_orderstatus = 'F' then o_orderpriority else '' end, '') ignore nulls) over (partition by o_custkey order by o_orderkey rows unbounded preceding) as section from orders")
def carried_sections(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("").alias("section"))
    return records.carry_forward(o, "o_custkey", "o_orderkey", "section").drop("o_custkey")


@query("with c as (select o_custkey as cluster, count(*) as size from orders group by 1) select cluster, size from (select *, coalesce(sum(size) over (order by md5('42:' || cluster) rows between unbounded preceding and 1 preceding), 0) as before from c) where before < 500")
def whole_clusters(spark, sf_dir):
    return records.whole_clusters(orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("cluster")).agg(F.count("*").alias("size")), 500)


@query("with c as (select c_custkey, md5('42:' || c_custkey) as h, row_number() over (partition by c_mktsegment order by md5('42:' || c_custkey)) as turn from customer where c_custkey not in (select s_suppkey from supplier)) select c_custkey, 'R-' || lpad(row_number() over (order by turn, h)::varchar, 3, '0') as review_id from c order by turn, h limit 25")
def review_sample(spark, sf_dir):
    seen = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return records.corpus_rows(table(spark, sf_dir, "customer"), seen, "c_mktsegment", "c_custkey", 25, "R").select("c_custkey", "review_id")


@query("select o_orderkey, v::int as variant, case when v = 0 then o_orderpriority || ' at 9:30' else replace(o_orderpriority, 'URGENT', 'RUSH') || ' at 9시 30분' end as title from orders, range(3) r(v)")
def augmented_titles(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey", F.concat("o_orderpriority", F.lit(" at 9:30")).alias("title"))
    return records.augment(o, "o_orderkey", "title", 2, {"URGENT": "RUSH"}, share=1.0).select("o_orderkey", "variant", "title")


@query("select o_orderkey, o_orderkey % 8 in (0, 2, 4, 6, 7) as same from orders")
def matched_values(spark, sf_dir):
    lit = lambda *vs: turn(8, *map(F.lit, vs))
    kind = lit("term", "term", "class_time", "class_time", "set", "set", "school", "weekly_plan")
    a = lit("1학기", "1학기", "Mon/Wed 10:00-11:15", "Mon 10:00-11:15", "x@a; Y@b", "x@a", "AU", "1: Intro, part 01")
    b = lit("Spring", "Fall", "wednesday 10:00-11:15; monday 10:00~11:15", "Tue 10:00-11:15", "y@b;X@A", "y@b", "Alpha University", "part 1 / intro 1")
    return orders(spark, sf_dir).select("o_orderkey", reports.values_match(kind, a, b, {"AU": "Alpha University"}).alias("same"))


CELLS = "with c as (select o_orderpriority as field, o_orderkey % 4 = 0 as blind, o_orderkey % 5 > 0 and o_orderkey % 3 > 0 as agree from orders where o_orderkey % 6 < 4)"


def cells(spark, sf_dir):
    blind = key() % 4 == 0
    ref = F.when(blind, F.col("o_orderpriority")).otherwise(F.col("o_orderstatus"))
    gold = F.when(key() % 5 == 0, "없음").when(key() % 3 == 0, "Z").otherwise(F.lower(ref))
    mark = F.when(key() % 6 < 4, "Y").otherwise("?")
    return orders(spark, sf_dir).select(key().alias("sid"), F.col("o_orderpriority").alias("field"), F.lit("text").alias("kind"), F.col("o_orderstatus").alias("shown"), F.col("o_orderpriority").alias("hidden"), blind.alias("blind"), gold.alias("gold"), mark.alias("mark"))


@query(CELLS + ", t as (select count(*) as confirmed, count(*) filter (agree and not blind) / count(*) filter (not blind) as a, count(*) filter (agree and blind) / count(*) filter (blind) as b from c) select confirmed, 0 as empty, 1 - a as edit_rate, b as blind_agreement, a - b as gap from t")
def trust_gate(spark, sf_dir):
    return reports.trust_gate(cells(spark, sf_dir))


@query(CELLS + " select field, count(*) as n, count(*) filter (not agree) as edited from c where not blind group by field")
def edit_rates(spark, sf_dir):
    return reports.edit_rates(cells(spark, sf_dir))


@query("select o_orderpriority as method, 2 * count(*) as gold_events, 2 * count(*) as pred_events, count(*) + count(*) filter (o_orderkey % 2 = 0) as aligned, count(*) filter (o_orderkey % 2 = 0) as exact, count(*) as title, 2 * count(*) filter (o_orderkey % 2 = 0) as type, count(*) filter (o_orderkey % 2 = 0) as date, count(*) filter (o_orderkey % 2 = 0) as date_kind from orders group by 1")
def event_alignment(spark, sf_dir):
    pred = turn(2, F.lit("Essay|quiz|2026-03-03|; MID|Exam| 2026-10-27 |absolute"), F.lit("Mid|talk||; Other|||"))
    x = orders(spark, sf_dir).select(F.col("o_orderpriority").alias("method"), F.lit("Mid | exam | 2026-10-27 | absolute; Poster | quiz").alias("gold"), pred.alias("value"))
    return reports.event_alignment(x)


@query("select count(*) as n, 'o_orderstatus' as field, count(*) as filled, 1.0 as rate from orders union all select count(*), 'title', count(*) filter (o_orderkey % 3 = 0), count(*) filter (o_orderkey % 3 = 0) / count(*) from orders")
def fill_rates(spark, sf_dir):
    return reports.fill_rates(orders(spark, sf_dir).withColumn("title", turn(3, F.lit("x"), F.lit("  "))), ["o_orderstatus", "title"])


@query("select o_orderpriority as field, o_orderstatus as method, count(*) filter (o_orderkey % 3 = 0) as filled from orders group by 1, 2")
def method_coverage(spark, sf_dir):
    return reports.coverage_compare(orders(spark, sf_dir).select(F.col("o_orderpriority").alias("field"), F.col("o_orderstatus").alias("method"), turn(3, F.lit("x"), F.lit("  ")).alias("value")))


@query("select case when o_orderkey % 4 = 0 then 'unknown' when year(o_orderdate) >= 1996 then 'current' else 'past' end as era, coalesce(case when o_orderstatus = 'F' then 'document' end, 'unresolved') as path, count(*) as n from orders group by 1, 2")
def kb_coverage(spark, sf_dir):
    return reports.kb_coverage(orders(spark, sf_dir).select(F.when(key() % 4 > 0, F.year("d")).alias("academic_year"), F.when(F.col("o_orderstatus") == "F", "document").alias("resolved_by")), 1996)


@query("select l_returnflag || l_linestatus as reason, count(*) as n from lineitem group by 1 order by n desc, reason limit 3")
def top_reasons(spark, sf_dir):
    return reports.top_reasons(table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("reason")), 3)


@query("select count(*) filter (o_orderkey % 2 = 0 and o_orderkey % 3 = 0) as unfounded, count(*) filter (o_orderkey % 2 = 0 and o_orderstatus = 'F' and o_orderkey % 5 = 0) as class_on_holiday, count(*) filter (o_orderkey % 2 = 0 and o_orderstatus = 'F' and o_orderkey % 7 = 0) as office_as_class from orders")
def risk_counters(spark, sf_dir):
    x = orders(spark, sf_dir).select(
        turn(2, F.lit("confirmed"), F.lit("review")).alias("bucket"), F.when(key() % 3 > 0, "document").alias("resolved_by"), F.when(F.col("o_orderstatus") == "F", "class").otherwise("exam").alias("kind"),
        (key() % 5 == 0).alias("on_holiday"), F.when(key() % 7 == 0, "ta_office_hours").otherwise("class_schedule").alias("label"),
    )
    return reports.risk_counters(x)


@query("select o_orderpriority as truth, count(*) as n from orders where o_orderstatus = 'F' group by 1")
def false_positives(spark, sf_dir):
    return reports.false_positives(orders(spark, sf_dir).select(F.col("o_orderpriority").alias("truth"), F.when(F.col("o_orderstatus") == "F", "class_schedule").otherwise("unknown").alias("prediction")))


@query("with r as (select l_returnflag as reason, l_shipdate::date::varchar as text from lineitem where l_linestatus = 'F'), t as (select reason, text, row_number() over (partition by reason order by text) as nr from (select distinct reason, text from r)) select reason as reject_reason, (select count(*) from r where r.reason = t.reason) as n, string_agg(text, ',' order by text) as examples from t where nr <= 6 group by 1")
def reject_reasons(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("reject_reason"), F.col("l_shipdate").cast("date").cast("string").alias("text"))
    return reports.rejects(x).withColumn("examples", F.array_join("examples", ","))


@query("select count(*) as weeks, count(*) filter (o_orderkey % 3 > 0) as hits, avg((o_orderkey % 2 = 0)::int) filter (o_orderkey % 3 > 0) as words from orders")
def week_recall(spark, sf_dir):
    o = orders(spark, sf_dir).select(key().alias("doc_id"), (key() % 10).alias("week"), F.col("o_orderpriority").alias("topic"), turn(2, F.col("o_orderpriority"), F.col("o_orderstatus")).alias("said"))
    return reports.week_recall(o.drop("said"), o.where("doc_id % 3 > 0").select("doc_id", "week", F.col("said").alias("topic")))


@query("select count(*) as n, avg((o_orderkey % 4 = 0)::int) as agreement from orders")
def label_agreement(spark, sf_dir):
    return reports.agreement(orders(spark, sf_dir).select(F.lit("exam_time").alias("prediction"), turn(4, F.lit("exam_time"), F.lit("unknown"), F.lit("policy_text"), F.lit("unknown")).alias("heuristic")))


KEYS = "with m as (select o_custkey as cluster, o_orderkey as doc_id, case when o_custkey % 2 = 0 then 'a.pdf' end as file_key, case when o_orderkey % 9 > 0 then 'alpha|' || regexp_replace(lower(o_orderpriority), '[^a-z0-9]', '', 'g') || '|kimlee' end as meta_key from orders)"


def keyed(spark, sf_dir):
    title = F.when(key() % 9 > 0, F.concat("o_orderpriority", F.lit(" II"))).otherwise("1")
    return orders(spark, sf_dir).select(F.col("o_custkey").alias("cluster"), key().alias("doc_id"), F.when(F.col("o_custkey") % 2 == 0, "a.pdf").alias("file_key"), reports.metadata_key(F.lit("Alpha"), title, F.lit("Kim Lee")).alias("meta_key"))


@query(KEYS + " select doc_id, meta_key from m")
def metadata_keys(spark, sf_dir):
    return keyed(spark, sf_dir).select("doc_id", "meta_key")


@query(KEYS + " select cluster, count(*) as size, case when max(file_key) is not null or (count(distinct meta_key) = 1 and count(meta_key) = count(*)) then 'same_course' else 'template_near_identical' end as reason from m group by 1 having count(*) > 1")
def cluster_reasons(spark, sf_dir):
    return reports.cluster_reasons(keyed(spark, sf_dir))

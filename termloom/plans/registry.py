"""Queries of the engine over the driver's tables, and their SQL. Names follow the operator inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.functions import class_time, dates, text
from termloom.operators import calendar, candidates, compiling, dedup, evaluate, fields, resolve
from termloom.operators.skew import dealt
from termloom.plans import records, walks  # noqa: F401  (add their queries)
from termloom.plans.base import QUERIES, SQL, query, table
from termloom.sources import files

def flagship(spark, sf_dir):
    return minhash_clusters(spark, sf_dir)


@query()
def minhash_clusters(spark, sf_dir):
    return dedup.clusters(table(spark, sf_dir, "documents"))


@query("select doc_id, coalesce(length(regexp_replace(t4, '[^\\pL\\pN]+', '', 'g')), 0)::int as chars, (length(regexp_replace(t4, '[^\\pL\\pN]+', '', 'g')) < 80) as low from (select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)https?://\\S+', '', 'g'), '(?i)\\bPage\\s+\\d+\\s+of\\s+\\d+\\b', '', 'g'), '\\b\\d{1,2}[/.\\-]\\d{1,2}[/.\\-]\\d{2,4}\\b', '', 'g'), '(?i)\\b\\d{1,2}:\\d{2}\\s*(?:[AP]M)?\\b', '', 'g') as t4 from documents)")
def quality_flags(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.length(text.substantive_text(t)).alias("chars"), text.is_low_content(t).alias("low"))


@query()
def doubled_glyphs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length(text.repair_doubled_runs(F.col("text"))).alias("chars"))


@query("select doc_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'), lambda x: lower(x)))) as email from documents")
def contact_emails(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(text.emails(F.col("text"))).alias("email"))


@query("select doc_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '(?:\\+82[-\\s]?\\d{1,2}|0\\d{1,2})[-.\\s)]?\\d{3,4}[-.\\s]?\\d{4}'), lambda x: trim(regexp_replace(x, '[.\\s)]', '-', 'g'), '-')))) as phone from documents")
def contact_phones(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(text.phones(F.col("text"))).alias("phone"))


@query("with l as (select doc_id, unnest(string_split(text, chr(10))) as s, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line from documents), p as (select *, line - row_number() over (partition by doc_id order by line) as island from l where contains(s, '|')) select doc_id as doc, dense_rank() over (partition by doc_id order by island)::int as table_no, row_number() over (partition by doc_id, island order by line)::int as row_no, len(string_split(trim(s, '| '), '|'))::int as n_cells from p")
def pipe_tables(spark, sf_dir):
    return text.pipe_tables(table(spark, sf_dir, "documents")).select("doc", "table_no", "row_no", F.size("cells").alias("n_cells"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%m-%d') as month_day from orders")
def date_normalize(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.normalize_date(F.date_format(d, "yyyy.M.d")).alias("iso"), dates.normalize_date(F.concat(F.month(d).cast("string"), F.lit("월 "), F.day(d).cast("string"), F.lit("일"))).alias("month_day"))


@query("select o_orderkey, dayname(o_orderdate) as day, lpad((o_orderkey % 24)::varchar, 2, '0') || ':' || lpad((o_orderkey % 60)::varchar, 2, '0') as time from orders")
def weekday_time(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    h = (k % 24).cast("int")
    korean = F.concat(F.when(h >= 12, "오후 ").otherwise("오전 "), F.when(h % 12 == 0, 12).otherwise(h % 12).cast("string"), F.lit("시 "), (k % 60).cast("string"), F.lit("분"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.normalize_weekday(F.date_format(d, "EEE")).alias("day"), dates.normalize_time(korean).alias("time"))


@query("select o_orderkey, (o_orderdate + ((((2 - (isodow(o_orderdate) - 1)) % 7 + 7) % 7))::int)::date as first_wednesday, (date_trunc('week', o_orderdate)::date + 7 * 2)::date as monday3 from (select o_orderkey, o_orderdate::date as o_orderdate from orders)")
def weekday_series(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.first_on_or_after(d, F.lit(2)).alias("first_wednesday"), dates.week_monday(d, F.lit(3)).alias("monday3"))


@query("with d as (select o_orderkey, o_orderdate::date as d from orders) select o_orderkey, 16 - 2 as n_classes, strftime(d + 21, '%Y-%m-%d') as first_exdate from d")
def class_occurrences(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    until = F.date_add(d, 105)
    ex = dates.class_exdates(d, until, F.array(F.date_add(d, 21), F.date_add(d, 22)), F.array(F.date_add(d, 49)))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(dates.class_occurrences(d, until, ex)).alias("n_classes"), F.get(ex, F.lit(0)).cast("string").alias("first_exdate"))


@query("with c as (select c_custkey, (date '2026-08-31' + 7 * (c_custkey % 16)::int + (c_custkey % 7)::int)::date as d, c_custkey % 3 = 0 as low from customer) select c_custkey as id, case when not low then d end as resolved_date, (not low and d in (date '2026-09-24', date '2026-10-09')) as is_holiday, (low or d = date '2026-10-09') as needs_review from c")
def week_references(spark, sf_dir):
    cal = spark.sql("select 'high' cal_key, date'2026-09-01' term_start, 'high' confidence, array(date'2026-09-24') holidays, array(date'2026-10-09') school_holidays, map(date'2026-09-24', date'2026-12-01') makeup union all select 'low', date'2026-09-01', 'low', array(), array(), map()")
    k = F.col("c_custkey")
    refs = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 3 == 0, "low").otherwise("high").alias("cal_key"), (k % 16 + 1).cast("int").alias("week"), F.get(F.array(*map(F.lit, dates.DAYS)), (k % 7).cast("int")).alias("weekday"))
    return resolve.resolve_weeks(refs, cal).select("id", "resolved_date", "is_holiday", "needs_review")


@query("with r as (select l_orderkey as id, list(distinct l_linenumber) as p from lineitem group by 1) select id, case when list_max(p) <= 6 then lpad((8 + list_min(p))::varchar, 2, '0') || ':00' end as start, case when list_max(p) <= 6 then lpad((8 + list_max(p))::varchar, 2, '0') || ':50' end as \"end\", list_max(p) > 6 as needs_review from r")
def period_references(spark, sf_dir):
    refs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_linenumber").alias("periods")).withColumn("tt_key", F.lit("u"))
    dim = spark.createDataFrame([("u", f"{i}.0", f"{8 + i}:00", f"{8 + i}:50") for i in range(1, 7)], "tt_key string, period string, start string, end string")
    return resolve.resolve_periods(refs, dim).select("id", "start", "end", "needs_review")


@query("with h as (select distinct regexp_extract(url, '^https?://([^/?#:]+)', 1) as host from pages) select host, case when host like '%.com' then 'com school' else 'net school' end as school from h where host like '%example.com' or host like '%example.net'")
def host_suffixes(spark, sf_dir):
    hosts = table(spark, sf_dir, "pages").select(F.regexp_extract("url", r"^https?://([^/?#:]+)", 1).alias("host"))
    dim = spark.createDataFrame([("example.com", "com school"), ("example.net", "net school")], "domain string, school string")
    return resolve.host_suffix_join(hosts, dim)


def _predictions(spark, sf_dir):
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    labels = F.array(*map(F.lit, candidates.LABELS))
    return table(spark, sf_dir, "lineitem").select(F.get(labels, (k % 8).cast("int")).alias("truth"), F.when(k % 5 == 0, F.get(labels, (k % 3).cast("int"))).otherwise(F.get(labels, (k % 8).cast("int"))).alias("prediction"))


_LABEL_SQL = "['class_schedule','instructor_office_hours','ta_office_hours','assignment_deadline','exam_time','weekly_plan','policy_text','unknown']"
_PRED_SQL = f"p as (select {_LABEL_SQL}[(k % 8 + 1)::int] as truth, {_LABEL_SQL}[(case when k % 5 = 0 then k % 3 else k % 8 end + 1)::int] as prediction from (select l_orderkey * 7 + l_linenumber as k from lineitem))"


@query(f"with {_PRED_SQL}, l as (select unnest({_LABEL_SQL}) as x) select a.x as truth, b.x as prediction, count(p.truth) as n from l a cross join l b left join p on p.truth = a.x and p.prediction = b.x group by 1, 2")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(_predictions(spark, sf_dir))


@query(f"with {_PRED_SQL} select count(*) as n, round(avg((truth = prediction)::int), 9) as accuracy, round(sum((prediction = 'class_schedule' and truth <> 'class_schedule')::int) / sum((prediction = 'class_schedule')::int), 9) as false_positive_rate, round(sum((truth like '%office%' and prediction = 'class_schedule')::int) / sum((truth like '%office%')::int), 9) as risky_rate from p")
def evaluate_labels(spark, sf_dir):
    r = lambda c: F.round(c, 9).alias(c)
    return evaluate.evaluate(_predictions(spark, sf_dir)).select("n", r("accuracy"), r("false_positive_rate"), r("risky_rate"))


@query("with p as (select 't' as truth, l_quantity::double / 50 as prob, l_linenumber % 2 = 0 as is_class from lineitem), t as (select unnest([0.2, 0.5, 0.8]) as threshold) select threshold, round(sum((prob >= threshold and is_class)::int) / sum((prob >= threshold)::int), 9) as precision, round(sum((prob >= threshold and is_class)::int) / sum(is_class::int), 9) as recall from p cross join t group by 1")
def threshold_sweep(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") % 2 == 0, "class_schedule").otherwise("unknown").alias("truth"), (F.col("l_quantity").cast("double") / 50).alias("prob"), F.lit("unknown").alias("other"))
    return evaluate.sweep(rows, [0.2, 0.5, 0.8]).select("threshold", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


def _methods(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    gold = c.select(F.col("c_custkey").alias("sid"), F.col("c_mktsegment").alias("field"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise("g").alias("gold"))
    k = F.col("c_custkey")
    one = c.where(k % 3 != 0).select(F.lit("rule").alias("method"), k.alias("sid"), F.col("c_mktsegment").alias("field"), F.when(k % 5 == 0, "x").otherwise("G").alias("value"))
    two = c.where(k % 7 != 0).select(F.lit("llm").alias("method"), k.alias("sid"), F.col("c_mktsegment").alias("field"), F.when(k % 2 == 0, "x").otherwise("g").alias("value"))
    return evaluate.method_metrics(gold, one.unionByName(two))


@query("with x as (select c_mktsegment as field, m.method, c_custkey % 4 <> 0 as has, case when m.method = 'rule' then c_custkey % 3 <> 0 else c_custkey % 7 <> 0 end as o, case when m.method = 'rule' then c_custkey % 5 <> 0 else c_custkey % 2 <> 0 end as ok from customer cross join (select unnest(['rule', 'llm']) as method) m) select field, method, count(*) as n, sum(o::int)::bigint as n_output, sum((o and ok and has)::int)::bigint as n_correct, sum((o and not has)::int)::bigint as n_fabricated from x group by 1, 2")
def method_metrics(spark, sf_dir):
    return _methods(spark, sf_dir).select("field", "method", "n", "n_output", "n_correct", "n_fabricated")


@query()
def method_winners(spark, sf_dir):
    return evaluate.pick_winner(_methods(spark, sf_dir), ["BUILDING"])


@query("with u as (select distinct o_custkey, ('0x' || substr(md5('42:' || o_custkey), 1, 8))::bigint / 4294967296.0 as u from orders) select case when u < 0.8 then 'train' when u < 0.9 then 'val' else 'test' end as split, count(*) as n_groups from u group by 1")
def group_split(spark, sf_dir):
    s = evaluate.group_split(table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey").distinct()
    return s.groupBy("split").agg(F.count("*").alias("n_groups"))


@query("select o_custkey, count(*) as splits from orders where false group by 1")
def split_leakage(spark, sf_dir):
    return evaluate.leaking_groups(evaluate.group_split(table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey"), "o_custkey")


@query("with r as (select c_custkey, c_nationkey, row_number() over (partition by c_nationkey order by md5('42:' || c_custkey)) as r, md5('42:' || c_custkey) as h from customer), s as (select count(distinct c_nationkey) as k from customer) select c_custkey, c_nationkey from r, s where r <= ceil(60 / k) order by r, h limit 60")
def stratified_sample(spark, sf_dir):
    return evaluate.stratified_sample(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "c_custkey", 60)


@query("select lang, count(*) as n, round(count(*) / sum(count(*)) over (), 9) as share from documents group by 1")
def label_distribution(spark, sf_dir):
    return evaluate.distribution(table(spark, sf_dir, "documents"), "lang").withColumn("share", F.round("share", 9))


@query("select o_custkey, o_orderkey from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey desc) as r from orders) where r = 1")
def keep_last(spark, sf_dir):
    return dedup.keep_last(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("with p as (select l_orderkey as plan_id, count(*) as n, count(distinct l_linenumber) as d, min(l_linenumber) as lo, max(l_linenumber) as hi, count(distinct l_returnflag) as kinds from lineitem group by 1) select plan_id, n as n_rows, hi::int as total_weeks, array_to_string(list_filter([case when d < n then 'duplicate_weeks' end, case when not (d = n and hi - lo + 1 = n) then 'week_gap' end, case when n >= 5 and kinds = 1 then 'uniform_topic' end], lambda x: x is not null), ',') as issues from p")
def plan_alignment(spark, sf_dir):
    rows = dealt(table(spark, sf_dir, "lineitem"), "l_orderkey").select(F.col("l_orderkey").alias("plan_id"), F.col("l_linenumber").cast("int").alias("week"), F.col("l_returnflag").alias("topic"), F.col("l_linenumber").alias("seq"))
    return calendar.plan_issues(rows).select("plan_id", "n_rows", "total_weeks", F.array_join("issues", ",").alias("issues"))


@query("with e as (select o_custkey as doc_id, date_trunc('week', o_orderdate)::date as monday, o_orderpriority as topic from orders), f as (select *, min(monday) over (partition by doc_id) as first, count(*) over (partition by doc_id) as n from e) select doc_id, ((monday - first) / 7 + 1)::int as week, monday, string_agg(distinct topic, ' / ' order by topic) as topics from f where n >= 3 group by doc_id, monday, first")
def plan_rows_by_date(spark, sf_dir):
    e = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("topic"))
    return calendar.rows_from_dates(e)


@query("with e as (select l_orderkey as doc_id, l_linenumber as k, case when l_linenumber in (3, 4) then 'exam' else 'quiz' end as type from lineitem), f as (select *, coalesce((type <> lag(type) over w or k * 20 - lag(k * 20 + 10) over w > 30), true)::int as fresh from e window w as (partition by doc_id order by k)), g as (select *, sum(fresh) over (partition by doc_id order by k range unbounded preceding) as run from f) select doc_id, type, count(*) as merged from g group by doc_id, type, run")
def adjacent_events(spark, sf_dir):
    k = F.col("l_linenumber")
    e = dealt(table(spark, sf_dir, "lineitem"), "l_orderkey").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), F.when(k.isin(3, 4), "exam").otherwise("quiz").alias("type"), (k * 20).alias("char_start"), (k * 20 + 10).alias("char_end"), F.col("l_returnflag").alias("title"))
    return calendar.merge_adjacent(e).select("doc_id", "type", "merged")


@query()
def candidate_labels(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("수업 시간 월 "), F.lpad((F.col("o_orderkey") % 12 + 8).cast("string"), 2, "0"), F.lit(":00~18:00\n면담 Tue 14:00\nMidterm "), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("text"))
    c = candidates.extract(d).select("*", *[F.lit(None).cast("string").alias(x) for x in ("section", "row_label", "col_label")])
    return candidates.validate(candidates.classify(c)).groupBy("text", "label", "in_class", "date_kind").agg(F.count("*").alias("n"))


@query()
def calendar_files(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    e = o.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").cast("string").alias("uid"), F.col("o_orderpriority").alias("title"), F.col("o_orderdate").cast("date").alias("day"), F.lit("09:00").alias("start"), F.lit("10:15").alias("end"), F.date_add(F.col("o_orderdate").cast("date"), 105).alias("until"), F.array(F.date_add(F.col("o_orderdate").cast("date"), 7)).alias("exdates"))
    return calendar.ics_events(e)


@query("select doc_id as id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) as found, 'email' as kind from documents union all select doc_id, unnest(regexp_extract_all(text, '(?:\\+82[-\\s]?\\d{1,2}|0\\d{1,2})[-.\\s)]?\\d{3,4}[-.\\s]?\\d{4}')), 'phone' from documents")
def pii_guard(spark, sf_dir):
    return files.pii_findings(table(spark, sf_dir, "documents"), ["school.example"], "doc_id")


@query("select o_orderkey as doc_id, (year(d) + 10)::int as academic_year, case when month(d) <= 6 then '봄' else '가을' end as term, 'ABC' || lpad((o_orderkey % 10000)::varchar, 4, '0') as course_code, '통계학' as title_ko, 'Statistics' as title_en, case when o_orderkey % 20 <= 10 then (o_orderkey % 20)::double end as credits, case when o_orderkey % 3 > 0 then 2 end as n_shares from (select o_orderkey, o_orderdate::date as d from orders)")
def rule_fields(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    share = (k % 3 * 40).cast("string")
    t = F.concat((F.year(d) + 10).cast("string"), F.lit("학년도 "), F.when(F.month(d) <= 6, "1").otherwise("2"), F.lit("학기\n과목명: 통계학(Statistics)\n학수번호: ABC"), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("\n학점: "), (k % 20).cast("string"), F.lit("\n평가: 출석 "), share, F.lit("% 시험 "), (100 - k % 3 * 40).cast("string"), F.lit("%"))
    t = F.when(k % 3 > 0, t).otherwise(F.regexp_replace(t, "출석 0%", "출석"))
    docs = dealt(table(spark, sf_dir, "orders"), "o_orderkey").select(k.alias("doc_id"), t.alias("text"))
    return fields.rule_fields(docs).select("doc_id", "academic_year", "term", "course_code", "title_ko", "title_en", "credits", F.when(F.col("grading").isNotNull(), F.size("grading")).alias("n_shares"))


@query("select o_orderkey, dayname(o_orderdate) as day, lpad((8 + o_orderkey % 10)::varchar, 2, '0') || ':00' as start, lpad((9 + o_orderkey % 10)::varchar, 2, '0') || ':15' as end_time from orders")
def class_time_slots(spark, sf_dir):
    h = (F.col("o_orderkey") % 10).cast("int")
    t = F.concat(F.upper(F.date_format("o_orderdate", "EEE")), F.lit(" "), (8 + h).cast("string"), F.lit(":00-"), (9 + h).cast("string"), F.lit(":15 (West 12)"))
    x = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(class_time.class_slots(t)).alias("s"))
    return x.select("o_orderkey", F.col("s.day").alias("day"), F.col("s.start").alias("start"), F.col("s.end").alias("end_time"))


@query("select l_orderkey as plan_id, l_linenumber::int as week, l_linestatus as topic, case when l_linenumber = 4 then 'Homework' end as remarks from lineitem")
def plan_tables(spark, sf_dir):
    k = F.col("l_linenumber")
    row = F.array(k.cast("string"), F.lit(""), F.col("l_linestatus"), F.when(k == 4, "Homework").otherwise(""))
    t = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("plan_id")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    t = t.withColumn("header", F.array(*map(F.lit, ["Week", "Date", "Topic", "Remarks"])))
    return compiling.plan_rows(t).select("plan_id", "week", "topic", "remarks")


@query("select distinct l_orderkey as plan_id, l_linenumber::int as week, case when l_linenumber = 4 then 'exam' else 'assignment' end as kind, case when l_linenumber = 4 then 'midterm' end as type from lineitem where l_linenumber in (4, 6)")
def plan_events(spark, sf_dir):
    k = F.col("l_linenumber")
    r = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("plan_id"), k.alias("week"), k.alias("seq"), F.when(k == 4, "Midterm Exam").when(k == 5, "no class, quiz").otherwise("Topic").alias("topic"), F.when(k == 6, "Homework 1").alias("remarks"))
    return compiling.events_from_rows(r).select("plan_id", F.col("week").cast("int").alias("week"), "kind", "type")


@query("with e as (select *, row_number() over (partition by l_orderkey, l_linestatus order by l_linenumber) as r from lineitem) select l_orderkey as doc_id, l_linenumber as seq from e where l_returnflag = 'R' union all select l_orderkey, l_linenumber from (select *, row_number() over (partition by l_orderkey, l_linestatus order by l_linenumber) as q from lineitem where l_returnflag <> 'R') where q = 1")
def undated_events(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), F.lit("quiz").alias("type"), F.col("l_linestatus").alias("title"), F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("date")).alias("resolved_date"))
    return compiling.collapse_undated(e).select("doc_id", "seq")


@query("with o as (select o_orderkey, o_custkey, o_orderdate::date as d, case when o_custkey % 2 = 0 then 1995 end as a from orders), n as (select o_custkey, year(d) as y, count(*) as n, max(a) as a from o group by 1, 2), y as (select o_custkey, coalesce(max(a), arg_min(y, (-n, y)))::int as doc_year from n group by 1) select o_orderkey, doc_year, case when abs(year(case when year(d) = a - 1 then d + interval 1 year else d end) - doc_year) > 1 then 'review' else 'confirmed' end as bucket from o join y using (o_custkey)")
def compile_buckets(spark, sf_dir):
    e = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("doc_id"), F.lit("Quiz").alias("title"), F.col("o_orderdate").cast("date").alias("resolved_date"), F.lit(False).alias("needs_review"), F.when(F.col("o_custkey") % 2 == 0, 1995).alias("academic_year"))
    return compiling.compile_events(e).select("o_orderkey", "doc_year", "bucket")


@query("with r as (select c_custkey, c_mktsegment, ceil(row_number() over (partition by c_mktsegment order by c_custkey) / case when c_mktsegment = 'BUILDING' then 2.0 else 1.0 end)::int as turn from customer where c_mktsegment in ('BUILDING', 'MACHINERY')) select c_custkey, turn from r order by turn, c_mktsegment desc, c_custkey limit 20")
def round_robin_sample(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return compiling.round_robin(c, "c_mktsegment", "c_custkey", ["MACHINERY", "BUILDING"], 20, ["BUILDING"]).select("c_custkey", "turn")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)

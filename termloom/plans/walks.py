"""Queries of document walks, weekly plans, meetings and the method harness over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from termloom.operators import calendar, harness, meetings, synth, walk, weekly
from termloom.plans.base import query, table
from termloom.plans.records import key, orders, turn

PAD = "\n" + "lorem ipsum " * 6 + "\n"


def pages(spark, sf_dir):
    """A page with a class time, an exam on the order's date and a table of office hours and room."""
    d = F.col("d").cast("string")
    text = F.concat(F.lit("Lecture class time: Mon 10:00-11:15" + PAD), F.lit("Midterm Exam: "), d, F.lit(PAD + "Homework 2 "), F.date_add("d", 7).cast("string"), F.lit(PAD))
    tables = F.array(F.struct(F.array(F.lit("Item"), F.lit("Value")).alias("header"), F.array(F.array(F.lit("Office hours"), turn(2, F.lit("Wed 13:00"), F.lit("Mon 14:00"))), F.array(F.lit("Room"), turn(3, F.lit("Hall 7"), F.lit("Credits"), F.lit("")))).alias("rows")))
    page = F.struct(F.lit(1).alias("page_no"), text.alias("text"), tables.alias("tables"))
    return orders(spark, sf_dir).select(key().alias("doc_id"), F.array(page).alias("pages"))


@query("with l as (select o_orderkey, unnest(case when o_orderkey % 2 = 0 then ['Mon:class_schedule:page', 'Wed:instructor_office_hours:cell', '13:00:instructor_office_hours:cell'] else ['Mon:instructor_office_hours:cell', '14:00:instructor_office_hours:cell'] end || ['10:00-11:15:class_schedule:page', 'exam:exam_time:page', 'task:assignment_deadline:page']) as s from orders) select regexp_extract(s, ':([a-z_]+):[a-z]+$', 1) as label, s like '%:cell' as is_table, count(*) as n from l where s <> 'Mon:class_schedule:page' group by 1, 2 union all select 'unknown', false, count(*) from orders where o_orderkey % 2 = 0")
def document_walk(spark, sf_dir):
    return walk.run_pipeline(pages(spark, sf_dir)).groupBy("label", "is_table").agg(F.count("*").alias("n"))


@query("select o_orderkey as doc_id, 'exam' as kind, 'midterm' as type, 'Midterm Exam' as title, strftime(o_orderdate, '%Y-%m-%d') as resolved_date from orders union all select o_orderkey, 'assignment', null, 'Homework 2', strftime(o_orderdate + interval 7 day, '%Y-%m-%d') from orders")
def dated_entries(spark, sf_dir):
    return walk.dated_entries(walk.run_pipeline(pages(spark, sf_dir))).select("doc_id", "kind", "type", "title", "resolved_date")


@query("select o_orderkey as doc_id, 'location' as field, 'Hall 7' as value from orders where o_orderkey % 3 = 0")
def label_cells(spark, sf_dir):
    return walk.cell_values(pages(spark, sf_dir)).select("doc_id", "field", "value")


@query("select field, source, count(*) as n from (select 'class_time' as field, 'rule' as source from orders where false union all select 'class_time', 'subsystem' from orders union all select 'location', 'cell' from orders where o_orderkey % 3 = 0) group by 1, 2")
def routed_fields(spark, sf_dir):
    p = pages(spark, sf_dir)
    return walk.route(p, walk.run_pipeline(p)).groupBy("field", "source").agg(F.count("*").alias("n"))


@query("select o_orderkey, case o_orderkey % 5 when 0 then 'tba' when 1 then 'present' when 2 then 'present' when 3 then 'async' else 'not_specified' end as status, o_orderkey % 4 = 3 as several from orders")
def meeting_status(spark, sf_dir):
    raw = turn(5, F.lit("TBA by staff"), F.lit("Mon 3"), F.lit(None))
    text = turn(5, F.lit("a"), F.lit("e-learning"), F.lit("b"), F.lit("This is an e-learning course"), F.lit("c"))
    times = turn(4, F.lit(None), F.array(F.lit("A"), F.lit(" A"), F.lit("B")), F.array(F.lit("A")), F.array(*map(F.lit, "ABC")))
    return orders(spark, sf_dir).select("o_orderkey", walk.meeting_status(text, raw, key() % 5 == 2).alias("status"), walk.several_sections(F.lit(None).cast("array<string>"), times).alias("several"))


@query("select o_orderkey, case o_orderkey % 5 when 0 then 'Term Paper' when 1 then 'Quiz 3' when 2 then 'Poster Day' end as title, case o_orderkey % 2 when 0 then strftime(o_orderdate, '%-m/%-d') else 'week' || o_orderkey % 10 end as signature from orders")
def event_titles(spark, sf_dir):
    row = turn(5, F.lit("Term Paper:"), F.lit("week 3"), F.lit(None))
    before = turn(5, F.lit("x"), F.lit("a line\nnote; Quiz 3: "), F.lit("Poster Day, "), F.lit("until the 3"), F.lit("42 "))
    raw = F.when(key() % 2 == 0, F.concat_ws(" / ", F.month("d").cast("string"), F.dayofmonth("d").cast("string"))).otherwise(F.concat(F.lit("Week "), (key() % 10).cast("string")))
    return orders(spark, sf_dir).select("o_orderkey", walk.event_title(row, F.lit("Schedule"), before).alias("title"), walk.date_signature(F.lit("Talk"), raw).alias("signature"))


@query("with e as (select o_custkey as doc_id, o_orderstatus as type, strftime(o_orderdate, '%-m/%-d') as sig, o_orderkey as seq, regexp_replace(o_orderpriority, '^\\d-', '') as title, o_orderdate::date as d from orders) select doc_id, type, min(seq) as seq, arg_min(title, (length(title), seq)) as title, arg_min(d, seq) filter (seq % 3 > 0) as resolved_date, count(*) as merged from e group by doc_id, type, sig")
def signature_events(spark, sf_dir):
    raw = F.concat_ws("/", F.month("d").cast("string"), F.dayofmonth("d").cast("string"))
    title = F.regexp_replace("o_orderpriority", r"^\d-", "")
    e = orders(spark, sf_dir).select(F.col("o_custkey").alias("doc_id"), key().alias("seq"), F.col("o_orderstatus").alias("type"), title.alias("title"), raw.alias("raw_reference"), F.when(key() % 3 > 0, F.col("d")).alias("resolved_date"), F.col("o_orderpriority"))
    return walk.by_date_signature(e).drop("raw_reference")


SPLIT = "with o as (select o_orderkey as doc_id, (3 + o_orderkey % 5)::int as n, (o_orderkey % 3)::int as shape from orders)"


@query(SPLIT + " select doc_id, case shape when 0 then n + 3 when 1 then n + 4 else n end::int as total_weeks, case shape when 2 then n else n + 3 end::int as n_rows, shape = 1 as needs_review, case shape when 1 then 'week_gap' else '' end as issues from o")
def weekly_plans(spark, sf_dir):
    n, shape = (3 + key() % 5).cast("int"), (key() % 3).cast("int")
    row = lambda w: F.array(F.concat(F.lit("Week "), w.cast("string")), F.lit(""), F.concat(F.lit("Topic "), (w * 7).cast("string"), F.lit(" of the course")))
    first = F.when(shape == 0, n + 1).when(shape == 1, n + 2).otherwise(n)
    x = orders(spark, sf_dir).select(key().alias("doc_id"), F.array(F.struct(F.lit(1).alias("no"), F.transform(F.sequence(F.lit(1), n), row).alias("rows")), F.struct(F.lit(0).alias("no"), F.transform(F.sequence(first, first + 2), row).alias("rows"))).alias("t"))
    head = F.when(F.col("x.no") == 1, F.array(*map(F.lit, ["Week", "Topic", "Remarks"])))  # the topic stands a column off
    tables = x.select("doc_id", F.explode("t").alias("x")).select("doc_id", F.col("x.no").alias("table_no"), head.alias("header"), "x.rows")
    return weekly.weekly_plans(tables).select("doc_id", "total_weeks", F.size("rows").alias("n_rows"), "needs_review", F.array_join("issues", ",").alias("issues"))


@query("select o_orderkey as doc_id, case o_orderkey % 4 when 0 then 'exam' when 1 then 'assignment' else 'other' end as kind, case o_orderkey % 4 when 0 then 'final' end as type, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') end as resolved_date, o_orderkey % 2 > 0 as needs_review from orders where o_orderkey % 4 < 3")
def plan_row_events(spark, sf_dir):
    topic = turn(4, F.lit("Review, final exam"), F.lit("Quiz and homework"), F.lit("[Workshop] posters"), F.lit("Mid-term (no class), exam"))
    dates = F.concat(F.when(key() % 2 == 0, F.concat(F.col("d").cast("string"), F.lit(" ~ "))).otherwise("3/4 ~ "), F.lit("x"))
    row = F.struct(F.lit(3).alias("week"), dates.alias("dates"), topic.alias("topic"), F.lit(None).alias("book"), F.lit(None).alias("remarks"), F.array(F.lit("Chapter 3")).alias("extras")).cast(weekly.ROW)
    return weekly.plan_events(orders(spark, sf_dir).select(key().alias("doc_id"), F.array(row).alias("rows"))).select("doc_id", "kind", "type", "resolved_date", "needs_review")


@query("select o_orderkey, case o_orderkey % 4 when 0 then 'Demand, CH 1: Consumption theory' when 1 then 'Chapter 2' when 3 then 'Demand' end as topic from orders")
def chapter_topics(spark, sf_dir):
    topic = turn(4, F.lit("Demand"), F.lit(None), F.lit("Midterm week"), F.lit("Demand"))
    extras = turn(4, F.array(F.lit("CH 1: Consumption"), F.lit("theory"), F.lit("Problem set")), F.array(F.lit("Chapter 2")), F.array(F.lit("Quiz")), F.array(F.lit("Chapter 4 exam")))
    return orders(spark, sf_dir).select("o_orderkey", weekly.topic_with_chapters(topic, extras).alias("topic"))


DATED = "with o as (select o_custkey as doc_id, o_orderkey as k, o_orderpriority as topic, month(o_orderdate) as m, day(o_orderdate) as d, o_custkey % 2 as odd from orders), f as (select *, first_value(m) over (partition by doc_id order by k) as first, count(*) over (partition by doc_id) as n from o)"


def entries(spark, sf_dir):
    o = orders(spark, sf_dir, "o_custkey").select(F.col("o_custkey").alias("doc_id"), key().alias("k"), F.col("o_orderpriority").alias("topic"), "d")
    years = o.select("doc_id").distinct().withColumn("year", F.lit(2031))
    return o, years


@query(DATED + " select doc_id, try_cast(2031 + (m < first - 6)::int || '-' || m || '-' || d as date) as day, topic from f where n >= 2 and try_cast(2031 + (m < first - 6)::int || '-' || m || '-' || d as date) is not null")
def dated_tables(spark, sf_dir):
    o, years = entries(spark, sf_dir)
    cell = F.when(key_of(o) % 2 == 0, F.concat_ws("/", F.month("d").cast("string"), F.dayofmonth("d").cast("string"))).otherwise(F.date_format("d", "MMM d"))
    t = o.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("k", F.array(F.lit("-"), cell, F.col("topic")).alias("r")))).alias("x"))
    t = t.select("doc_id", F.lit(0).alias("table_no"), F.transform("x", lambda e: e["r"]).alias("rows"))
    return weekly.dated_rows(t, years).select("doc_id", "day", "topic")


def key_of(o):
    return o["k"]


@query(DATED + ", e as (select doc_id, try_cast(2031 + (m < first - 6)::int || '-' || m || '-' || d as date) as day, topic from f where n >= 3), g as (select *, date_trunc('week', day)::date as monday from e where day is not null), h as (select *, min(monday) over (partition by doc_id) as lo, count(*) over (partition by doc_id) as c from g) select doc_id, ((monday - lo) / 7 + 1)::int as week, monday, string_agg(distinct topic, ' / ' order by topic) as topics from h where c >= 3 group by doc_id, monday, lo")
def prose_schedules(spark, sf_dir):
    o, years = entries(spark, sf_dir)
    line = F.concat(F.date_format("d", "MMM d"), F.lit(" - "), F.col("topic"))
    docs = o.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("k", line.alias("s")))).alias("x"))
    text = F.concat(F.lit("Jan 3 - not in the plan\nSchedule of Classes\n\n"), F.array_join(F.transform("x", lambda e: e["s"]), "\n• detail\n"))
    return calendar.rows_from_dates(weekly.prose_rows(docs.select("doc_id", text.alias("text")), years))


@query("with o as (select o_orderkey as k, o_custkey % 25 as n, o_orderkey % 6 as s from orders), x as (select *, date '2031-03-03' + (n % 5)::int as start, date '2031-03-03' + (n % 5)::int + 69 as until from o), y as (select *, start + ((7 - (isodow(start) - 1)) % 7)::int as first from x) select k as doc_id, 'timetable' as bucket, null as reason, null::date as first, null::bigint as n_exdates from y where s < 2 union all select k, 'confirmed', null, first, (first + 7 <= until and (n % 2 = 0))::bigint from y where s < 2 and n % 3 > 0 union all select k, 'review', case s when 2 then 'several_sections' when 3 then 'time_not_read' when 4 then 'time_to_be_announced' when 5 then 'time_not_stated' else 'no_calendar' end, null, null from y where s > 1 or n % 3 = 0")
def class_meetings(spark, sf_dir):
    n = F.col("n_nationkey")
    start = F.date_add(F.lit("2031-03-03").cast("date"), (n % 5).cast("int"))
    monday = F.date_add(start, F.pmod(-F.weekday(start), F.lit(7)).cast("int"))
    none = F.array().cast("array<date>")
    cal = table(spark, sf_dir, "nation").select(
        n.cast("long").alias("cal_key"), start.alias("term_start"), F.lit(None).cast("date").alias("term_end"), F.lit(10).alias("weeks"),
        F.when(n % 2 == 0, F.array(F.date_add(monday, 7), F.date_add(monday, 8))).otherwise(none).alias("holidays"), none.alias("school_holidays"), F.when(n % 3 > 0, "high").otherwise("low").alias("confidence"),
    )
    raw = turn(6, F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d"), F.lit("TBA"), F.lit(None))
    notation = turn(6, F.lit("Mon 10:00-11:15"), F.lit("Mon 10:00-11:15 ;"), F.lit("Mon 10:00-11:15"), F.lit("Mon 10:00-11:15 ; soon"))
    status = turn(6, F.lit("present"), F.lit("present"), F.lit("present"), F.lit("present"), F.lit("tba"), F.lit("not_specified"))
    r = orders(spark, sf_dir).select(key().alias("doc_id"), status.alias("status"), raw.alias("raw_time"), meetings.parse_slots(notation).alias("slots"), (key() % 6 == 2).alias("several"), (F.col("o_custkey") % 25).alias("cal_key"))
    return meetings.compile_meetings(r, cal).select("doc_id", "bucket", "reason", "first", F.when(F.col("exdates").isNotNull(), F.size("exdates")).cast("long").alias("n_exdates"))


@query("select o_orderkey, case o_orderkey % 4 when 0 then 'Statistics (시험)' when 1 then 'Midterm 2' when 2 then 'Poster' else 'Statistics (과제)' end as summary, o_orderkey % 4 = 2 as document_date from orders")
def event_summaries(spark, sf_dir):
    kind = turn(4, F.lit("exam"), F.lit("exam"), F.lit("exam"), F.lit("assignment"))
    title = turn(4, F.lit("Week 5 (Tuesday"), F.lit("Estimation of means, Midterm 2"), F.lit("Poster"), F.lit(" "))
    s = meetings.event_summary(kind, title, F.lit("Statistics"))
    return orders(spark, sf_dir).select("o_orderkey", s.alias("summary"), meetings.is_document_date(F.when(key() % 4 == 2, "출력일 2031-01-01").otherwise(s)).alias("document_date"))


HARNESS = "with v as (select 'title' as field, o_orderstatus as rule, lower(o_orderpriority) || ' x' as llm, case when o_orderkey % 5 = 0 then null else o_orderpriority end as gold from orders), r as (select field, 'rule' as method, contains(lower(gold), lower(rule)) as ok from v where gold is not null union all select field, 'llm', contains(llm, lower(gold)) from v where gold is not null), t as (select field, method, count(*) as n, avg(ok::int) as win_rate from r group by 1, 2)"


@query(HARNESS + " select *, 'llm' as winner from t")
def harness_win_rates(spark, sf_dir):
    v = F.array(F.struct(F.lit("rule").alias("method"), F.col("o_orderstatus").alias("value")), F.struct(F.lit("llm").alias("method"), F.concat(F.lower("o_orderpriority"), F.lit("  x")).alias("value")))
    o = orders(spark, sf_dir)
    rows = harness.harness_rows(o.select(key().alias("doc_id"), F.lit("title").alias("field"), F.inline(v)), {"title": "fuzzy"}, ["rule", "llm"])
    gold = o.select(key().alias("doc_id"), F.when(key() % 5 > 0, F.col("o_orderpriority")).otherwise(harness.PENDING).alias("gold"))
    return harness.win_rates(rows.drop("gold").join(gold, "doc_id"), ["rule", "llm"])


@query("select o_orderstatus as field, 'rule' as method, count(*) filter (o_orderkey % 3 > 0) as coverage, count(*) filter (o_orderkey % 3 > 0 and o_orderkey % 4 > 0) as n_scored, avg((o_orderkey % 3 = 1)::int) filter (o_orderkey % 3 > 0 and o_orderkey % 4 > 0) as acc from orders group by 1")
def sheet_rates(spark, sf_dir):
    wide = orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", turn(3, F.lit(" "), F.lit("Week 01 : Intro"), F.lit("Week 2: Intro")).alias("rule_plan"), F.when(key() % 4 > 0, "week 1:intro").alias("gold_plan"))
    long = harness.gold_sheet(wide, ["plan"], {"value": "rule", "gold": "gold"}, "o_orderkey").drop("field").join(wide.select("o_orderkey", F.col("o_orderstatus").alias("field")), "o_orderkey")
    return harness.sheet_rates(long.withColumn("method", F.lit("rule")))


@query("select o_custkey as doc_id, string_agg(o_orderpriority || ' | exam | ' || strftime(o_orderdate, '%Y-%m-%d') || ' | absolute', ' ; ' order by o_orderkey) as value, count(*)::int as n from orders group by 1")
def event_strings(spark, sf_dir):
    e = orders(spark, sf_dir).select(F.col("o_custkey").alias("doc_id"), key().alias("seq"), F.col("o_orderpriority").alias("title"), F.lit("exam").alias("kind"), F.col("d").cast("string").alias("raw_reference"), F.lit("absolute").alias("date_kind"))
    return harness.serialize_events(e).withColumn("n", F.size(harness.parse_events(F.col("value"))))


@query("with o as (select c_custkey, c_custkey % 3 as top, c_custkey % 10 / 10.0 as gap from customer) select c_custkey, case when top = 0 and 1 / (exp(-gap) + 1 + exp(-2)) >= 0.5 then 'class_schedule' when top = 0 then 'exam_time' when top = 1 then 'exam_time' else 'unknown' end as label from o")
def threshold_labels(spark, sf_dir):
    k = F.col("c_custkey")
    gap = (k % 10 / 10.0).cast("double")
    score = F.when(k % 3 == 0, F.array(F.lit(2.0), 2.0 - gap - 1e-9, F.lit(0.0))).when(k % 3 == 1, F.array(F.lit(0.0), F.lit(1.0), F.lit(0.5))).otherwise(F.array(F.lit(0.0), F.lit(1.0), F.lit(3.0)))
    classify = harness.from_scores(lambda _: score, 0.5, ["class_schedule", "exam_time", "unknown"])
    return classify(table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", "label")


@query("select label, greatest(1, floor(500 * w / 22.0 + 0.5))::bigint as n from (values ('class_schedule', 8), ('exam_time', 3), ('assignment_deadline', 2), ('instructor_office_hours', 2), ('ta_office_hours', 2), ('policy_text', 2), ('weekly_plan', 1), ('unknown', 2)) v(label, w)")
def synthetic_rows(spark, sf_dir):
    return synth.generate(spark, 500).groupBy("label").agg(F.count("*").alias("n"))


@query("select o_custkey as doc_id, unnest(range(((count(*) + 3) // 4)::bigint))::int as batch, count(*) as total from orders group by 1")
def prompt_batches(spark, sf_dir):
    none = F.lit(None).cast("string")
    c = orders(spark, sf_dir).select(F.col("o_custkey").alias("doc_id"), key().alias("seq"), F.col("d").cast("string").alias("text"), none.alias("section"), F.col("o_orderpriority").alias("row_label"), none.alias("col_label"), none.alias("before"), none.alias("after"))
    b = synth.prompt_batches(c, 4)
    return b.join(b.groupBy("doc_id").agg(F.sum("n").alias("total")), "doc_id").select("doc_id", "batch", "total")


@query("select o_orderkey, case o_orderkey % 3 when 0 then 'Linear Algebra,통계학 입문' when 1 then 'Linear Algebra' else '' end as titles, case o_orderkey % 2 when 0 then 'Alpha' end as school, case o_orderkey % 2 when 0 then 'alpha|linearalgebra|kimlee' end as file_key from orders")
def course_titles(spark, sf_dir):
    text = turn(3, F.lit("Linear Algebra Course Syllabus\nx\n통계학 입문 강의계획서 (2031)\nLINEAR  ALGEBRA Course Syllabus"), F.lit("Linear Algebra 강의계획서\nThis is the Course Syllabus of all courses of the school"), F.lit("차시별 계획 강의계획서\n3주 강의계획서"))
    doc = F.concat(turn(2, F.lit("arch__01_Alpha__Linear_Algebra II__Kim Lee__"), F.lit("other__")), F.hex(key()))
    return orders(spark, sf_dir).select("o_orderkey", F.array_join(synth.course_titles(text), ",").alias("titles"), synth.prefix_school(doc, {"arch": "A", "arch__01": "Alpha"}).alias("school"), synth.file_key(F.lower(doc)).alias("file_key"))


@query("select o_orderkey, case o_orderkey % 3 when 0 then 'Tue/Thu 10:00-11:15' when 1 then '월,수 09:00~10:15' end as class_time, case o_orderkey % 3 when 0 then 'Applied Statistics' when 1 then '통계학 입문' else 'Game Theory' end as title from orders")
def fallback_fields(spark, sf_dir):
    text = turn(3, F.lit("Syllabus\nApplied Statistics\nOffice hours Mon 09:00-10:00" + PAD + "Tue/Thu 10:00-11:15 in Hall 7"), F.lit("과목명: 통계학 입문\n월,수 09:00~10:15"), F.lit("https://x.example\nIn 2031 we meet\nGame Theory\n상담 화 13:00-14:00"))
    t = orders(spark, sf_dir).select("o_orderkey", text.alias("t"))
    return t.select("o_orderkey", walk.fallback_class_time(F.col("t")).alias("class_time"), walk.title_cascade(F.col("t")).alias("title"))

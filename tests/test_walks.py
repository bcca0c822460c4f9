"""Document walks, weekly plans, meetings and the harness on small rows: nulls, blanks, ties and empty tables."""

from datetime import date

from pyspark.sql import functions as F

from termloom.operators import dedup, harness, meetings, synth, walk, weekly
from termloom.sources.files import DOCUMENT

TABLES = "doc_id int, table_no int, header array<string>, rows array<array<string>>"


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOCUMENT)


def test_walk_prefers_the_last_cell(spark):
    table = (["", "Office hours"], [["Mon", "Tue 9:00"], ["Tue 9:00", None]])
    d = docs(spark, ("a", [(1, "Tue 9:00 and Fri", [table])], "text", "ok", None), ("b", [(1, None, [([], None)])], None, None, None), ("c", None, None, None, None))
    got = {(r.doc_id, r.text): (r.is_table, r.row_label) for r in walk.walk(d).collect()}
    assert got[("a", "Tue")] == (True, "Tue 9:00") and got[("a", "Fri")] == (False, None) and {k[0] for k in got} == {"a"}
    assert walk.run_pipeline(d.limit(0)).count() == 0
    assert {r.field for r in walk.route(d, walk.run_pipeline(d)).collect()} <= {"class_time", "title_en"}


def test_label_cells_skip_labels(spark):
    table = ([], [["Room:", "Hall 7", "Credits", "3"], ["Instructor", "Department", "Law"], ["Room", ""]])
    got = walk.cell_values(docs(spark, ("a", [(1, "", [table])], None, None, None))).collect()
    assert {(r.field, r.value) for r in got} == {("location", "Hall 7"), ("credits", "3"), ("department", "Law")}


def test_plan_in_pieces(spark):
    rows = [
        (1, 0, ["Week", "Date", "Topic"], [["1", "", "A"], ["2", None, "B"], ["x", "", ""]]), (1, 1, ["WEEK 3 (May)", "", "C"], []),
        (2, 0, None, [["1", "x"], ["2", "x"], ["3", "x"], ["4", "x"], ["5", "x"]]), (3, 0, ["Week", "Topic"], [["2", "A"], ["1", "B"]]),
        (4, 0, None, None), (5, 0, [None], [None, ["Week 4"]]), (6, 0, ["a"], [["no", "plan"]]),
    ]
    got = {r.doc_id: r for r in weekly.weekly_plans(spark.createDataFrame(rows, TABLES)).collect()}
    assert [(r.week, r.topic) for r in got[1].rows] == [(1, "A"), (2, "B"), (3, "C")] and got[1].total_weeks == 3 and not got[1].needs_review
    assert got[2].rows == [] and got[2].total_weeks == 5 and got[2].issues == ["uniform_topic"]
    assert got[3].rows == [] and got[3].total_weeks is None and got[3].issues == ["weeks_not_monotonic"]
    assert [r.week for r in got[5].rows] == [4] and set(got) == {1, 2, 3, 5}
    assert weekly.weekly_plans(spark.createDataFrame([], TABLES)).count() == 0


def test_dates_cross_the_year(spark):
    t = spark.createDataFrame([(1, 0, None, [["Sep 2", "A"], ["2/30", "gone"], ["1/7", "B"]]), (2, 0, None, [["Sep 2", "A"], ["9/9", "B"]])], TABLES)
    years = spark.createDataFrame([(1, 2031), (2, None)], "doc_id int, year int")
    assert [(r.day, r.topic) for r in weekly.dated_rows(t, years).orderBy("place").collect()] == [(date(2031, 9, 2), "A"), (date(2032, 1, 7), "B")]
    text = "Schedule\nSep 2 - A\nSep 9 - B\n" + "prose\n" * 13 + "Weekly plan\nSep 1: C\n\n• x\nSep 8 – D\n3월 1일 - E\n"
    got = weekly.prose_rows(spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id int, text string"), years)
    assert [(r.day, r.topic) for r in got.orderBy("place").collect()] == [(date(2031, 9, 1), "C"), (date(2031, 9, 8), "D"), (date(2031, 3, 1), "E")]


def test_meetings_and_slots(spark):
    s = spark.createDataFrame([("Mon 10:00-11:00 ; Wed 09:00-09:50",), ("Mon 10:00-11:00 ; later",), ("",), (None,)], "t string")
    assert [len(r[0]) for r in s.select(meetings.parse_slots(F.col("t"))).collect()] == [2, 0, 0, 0]
    r = spark.createDataFrame([(1, None, None, None, None, None, ["Mon"])], f"doc_id int, status string, raw_time string, slots {meetings.SLOTS}, several boolean, cal_key string, office array<string>")
    cal = spark.createDataFrame([], "cal_key string, term_start date, term_end date, weeks int, holidays array<date>, school_holidays array<date>, confidence string")
    assert meetings.compile_meetings(r, cal).count() == 0
    assert [(e.kind, e.reason) for e in meetings.compile_meetings(r, cal, office_hours=True).collect()] == [("office_hours", "Mon")]


def test_verdicts_strings_and_classifiers(spark):
    v = spark.createDataFrame([("a", None, "exact"), (None, "<null>", "exact"), ("Ab  c", "b C", "fuzzy"), ("ab", "b", "exact")], "p string, g string, k string")
    assert [r[0] for r in v.select(harness.is_correct(*map(F.col, "pgk"))).collect()] == [None, True, True, False]
    e = spark.createDataFrame([("A | exam ; B",), ("",), (None,)], "t string").select(harness.parse_events(F.col("t")).alias("e")).collect()
    assert [x.title for x in e[0].e] == ["A", "B"] and e[0].e[1].kind == "" and e[1].e == e[2].e == []
    assert harness.load_classifier({})(walk.walk(docs(spark))).count() == 0
    t = spark.sql("select timestamp'2031-03-03 00:00:00' a, timestamp'2031-03-03 09:05:00' b").select(harness.render(F.col("a")), harness.render(F.col("b")))
    assert t.first()[:] == ("2031-03-03", "09:05")


def test_synthetic_rows_are_sound_and_repeat(spark):
    rows = synth.generate(spark, 300)
    assert synth.integrity(rows).first()[:] == (rows.count(), 0, 0, 0)
    assert sorted(rows.collect()) == sorted(synth.generate(spark, 300).collect())
    assert synth.integrity(rows.limit(0)).first().n == 0
    c = spark.createDataFrame([(1, 1, "Mon 9:00", "Quiz")], "doc_id int, seq int, text string, row_label string").selectExpr("*", "cast(null as string) section", "cast(null as string) col_label", "cast(null as string) before", "cast(null as string) after")
    drafts = spark.createDataFrame([(1, 1, "exam_time", "Quiz")], "doc_id int, n int, label string, evidence string")
    assert synth.merge_drafts(c, drafts).first().draft == "exam_time"
    assert synth.merge_drafts(c, drafts.withColumn("evidence", F.lit("Final"))).first().draft is None


def test_clusters_by_keys(spark):
    words = [f"word{i} of the course" for i in range(60)]
    base, near = " ".join(words), " ".join([*words[:57], "another ending of it all"])
    rows = [(1, base, None, "m"), (2, near, None, "m"), (3, near + " x", None, None), (4, "short", "f", None), (5, "quite another text that is long enough", "f", None), (6, None, None, "m"), (7, None, "f", None)]
    d = spark.createDataFrame(rows, "doc_id int, text string, f string, m string")
    got = lambda **k: {r.doc_id: r.cluster for r in dedup.clusters(d, least=0.99, **k).collect()}
    alone, files, metas = got(), got(file_key="f"), got(meta_key="m")
    assert alone[4] == 4 and alone[5] == 5 and alone[1] == 1 and alone[2] == 2
    assert files[4] == files[5] == files[7] and files[1] == 1
    sim = d.where("doc_id < 3").select(dedup.signature(F.col("text")).alias("s")).collect()
    close = sum(a == b for a, b in zip(sim[0].s, sim[1].s)) / dedup.SLOTS >= 0.85
    assert (metas[2] == 1) == close and metas[4] == 4

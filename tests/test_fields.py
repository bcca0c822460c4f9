from datetime import date

from pyspark.sql import functions as F

from termloom.functions import class_time
from termloom.operators import calendar, compiling, fields


def one(spark, f, *texts):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in d.select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]


def test_years_terms_codes(spark):
    assert one(spark, fields.academic_year, "2031학년도 2학기", "Fall 2029", "no year at all", None, "") == [2031, 2029, None, None, None]
    assert one(spark, fields.term, "2031년 2학기", "Fall 2029", "a handspring and a free fallback", "", None) == ["가을", "가을", None, None, None]
    assert one(spark, fields.course_code, "학수번호: QZX4821", "no code", "", None) == ["QZX4821", None, None, None]


def test_labelled_fields(spark):
    assert one(spark, fields.clean_title, "해양생물의 이해 학점 2", "7", None) == ["해양생물의 이해", None, None]
    assert one(spark, fields.room, "금6,7(공학912)", "no room", None) == ["공학912", None, None]
    g = one(spark, fields.grading, "평가: 출석 25% 과제 35% 기말 40%", "평가: 출석 5% 기말 15%", "", None)
    assert [x and [y.weight for y in x] for x in g] == [[25, 35, 40], None, None, None]
    d = spark.createDataFrame([(1, "과목명: 해양학(Oceanography)\n담당교수: 김바다 교수 sea@w.example\n학점: 44\n강의시간: 9")], "doc_id int, text string")
    r = fields.rule_fields(d.withColumn("term", F.lit("x"))).first()
    assert (r.title_ko, r.title_en, r.instructor, r.credits, r.class_time) == ("해양학", "Oceanography", "김바다", None, None)


def test_class_times():
    kb = {"2": ("10:10", "11:00"), "3": ("11:10", "12:00")}
    short = lambda t, p=None: (lambda s: s and [(x["day"][:3], x["start"], x["end"]) for x in s])(class_time.parse(t, p))
    assert short("FRI SAT 8:05-9:20") == [("Fri", "08:05", "09:20"), ("Sat", "08:05", "09:20")]
    assert [x[0] for x in short("Tue-Fri 7:30am-8:20am")] == ["Tue", "Wed", "Thu", "Fri"]
    assert short("화 16:00(50)") == [("Tue", "16:00", "16:50")]
    assert short("목, 토 12:10~13:00") == [("Thu", "12:10", "13:00"), ("Sat", "12:10", "13:00")]
    assert short("금 2,3교시", kb) == [("Fri", "10:10", "12:00")]
    assert [short("금 2,3교시"), short("금 31,32", kb), short("later"), short(""), short(None)] == [None] * 5


def test_plan_tables(spark):
    rows = [["1", "", "소개", ""], ["2", "", "함수", ""], ["3", "2026-09-15", "중간고사", ""], ["4", "", "극한", "과제 1 제출"]]
    bare = [["1", "intro words"], ["2", "more words"], ["3", "again"], ["4", "Final Exam"]]
    t = spark.createDataFrame([("a", ["주차", "기간", "수업내용", "비고"], rows), ("b", None, bare), ("c", ["x", "y"], bare), ("d", None, [])], "plan_id string, header array<string>, rows array<array<string>>")
    p = compiling.plan_rows(t)
    got = {(r.plan_id, r.week): r.topic for r in p.collect()}
    assert len(got) == 8 and got["a", 2] == "함수" and got["b", 4] == "Final Exam"
    assert {r.plan_id: r.total_weeks for r in calendar.plan_issues(p).collect()} == {"a": 4, "b": 4}
    assert sorted((r.plan_id, r.week, r.kind) for r in compiling.events_from_rows(p).collect()) == [("a", 3, "exam"), ("a", 4, "assignment"), ("b", 4, "exam")]


def test_undated_and_compile(spark):
    e = [(1, i, "midterm", "중간고사") for i in range(4)] + [(1, 9 + i, "final", "기말고사") for i in range(2)] + [(2, 0, None, "Essay")]
    d = spark.createDataFrame(e, "doc_id int, seq int, type string, title string").withColumn("resolved_date", F.lit(None).cast("date"))
    assert sorted((r.doc_id, r.title) for r in compiling.collapse_undated(d).collect()) == [(1, "기말고사"), (1, "중간고사"), (2, "Essay")]
    x = [(1, date(2031, 9, 8), None), (1, date(2031, 11, 3), None), (1, date(2052, 9, 8), None), (2, date(2033, 5, 9), 2034), (4, None, None)]
    d = spark.createDataFrame(x, "doc_id int, resolved_date date, academic_year int").withColumns({"title": F.lit("Quiz"), "needs_review": F.lit(False)})
    got = [(r.doc_id, str(r.day), r.bucket) for r in compiling.compile_events(d).collect()]
    assert sorted(got) == [(1, "2031-09-08", "confirmed"), (1, "2031-11-03", "confirmed"), (1, "2052-09-08", "review"), (2, "2034-05-09", "confirmed"), (4, "None", "review")]


def test_round_robin(spark):
    d = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "label string, k int")
    assert [(r.label, r.k) for r in compiling.round_robin(d, "label", "k", ["b", "a"], 4, ["a"]).collect()] == [("b", 1), ("a", 0), ("a", 1), ("a", 2)]

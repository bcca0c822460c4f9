from datetime import date

import numpy as np
from pyspark.sql import functions as F

from termloom.operators import calendar, candidates, dedup, evaluate, resolve
from termloom.operators.components import components
from termloom.sources import files

CONTEXT = ["section", "row_label", "col_label"]


def labels(spark, *texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    c = candidates.extract(d).select("*", *[F.lit(None).cast("string").alias(x) for x in CONTEXT])
    return {(r.doc_id, r.text): r.label for r in candidates.validate(candidates.classify(c)).collect()}


def test_office_hours_are_never_class(spark):
    got = labels(spark, "면담 시간 14:00~15:00 수업", "수업 시간 월 14:00~15:00", "Midterm Exam: 2026-10-27", "50분간 진행", None, "")
    assert got[0, "14:00~15:00"] == "instructor_office_hours"
    assert got[1, "14:00~15:00"] == "class_schedule"
    assert got[2, "2026-10-27"] == "exam_time"
    assert got[3, "50분간"] == "policy_text"
    assert not [k for k in got if k[0] > 3]


def test_weeks(spark):
    cal = spark.sql("select 'k' cal_key, date'2026-09-01' term_start, 'high' confidence, array(date'2026-09-24') holidays, array() school_holidays, map() makeup")
    refs = spark.createDataFrame([(1, "k", 2, "Tuesday"), (2, "k", 4, "Thursday"), (3, "none", 1, "Monday"), (4, "k", 1, "Noday")], "id int, cal_key string, week int, weekday string")
    got = {r.id: r for r in resolve.resolve_weeks(refs, cal).collect()}
    assert got[1].resolved_date == date(2026, 9, 8) and not got[1].needs_review
    assert got[2].is_holiday and got[2].needs_review
    assert got[3].resolved_date is None and got[3].reason == "calendar_missing" and got[4].reason == "unknown_weekday"


def test_periods_all_or_nothing(spark):
    dim = spark.createDataFrame([("u", "1.0", "9:00", "9:50"), ("u", "2", "10:00", "10:50")], "tt_key string, period string, start string, end string")
    refs = spark.createDataFrame([(1, "u", [1, 2]), (2, "u", [1, 3])], "id int, tt_key string, periods array<int>")
    got = {r.id: (r.start, r.end, r.needs_review) for r in resolve.resolve_periods(refs, dim).collect()}
    assert got == {1: ("09:00", "10:50", False), 2: (None, None, True)}


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 4), *[(100 + i, 101 + i) for i in range(40)]], "u long, v long")
    got = {r.node: r.component for r in components(e).collect()}
    assert got[3] == 1 and got[9] == 8 and got[140] == 100 and 5 not in got and 4 not in got
    assert components(e.limit(0)).count() == 0


def test_clusters(spark):
    a = "the quick brown fox jumps over the lazy dog and runs into the forest to sleep until tomorrow"
    d = spark.createDataFrame([(1, a), (2, a), (3, a.upper() + " "), (4, "something else entirely that shares nothing at all"), (5, None), (6, "x")], "doc_id int, text string")
    got = {r.doc_id: r.cluster for r in dedup.clusters(d).collect()}
    assert got[1] == got[2] == got[3] == 1 and got[4] == 4 and got[6] == 6


def test_clusters_without_a_linked_lead(spark, monkeypatch):
    g = np.random.default_rng(8)
    x = g.integers(0, 2**62, (340, 48))
    for base, f in zip(g.integers(0, 2**62, (6, 48)), range(0, 300, 50)):  # families of copies with 95% of the slots kept
        x[f : f + 50] = np.where(g.random((50, 48)) < 0.95, base, x[f : f + 50])
    x[300:] = np.where(g.random((40, 48)) < 0.8, g.integers(0, 2**62, 48), x[300:])  # a template: most pairs below 0.9
    want = list(range(340))
    for i, j in zip(*np.nonzero(np.triu((x[:, None] == x[None]).sum(axis=2) >= 44, 1))):
        a, b = sorted((want[i], want[j]))
        want = [a if c == b else c for c in want]
    monkeypatch.setattr(dedup, "signature", lambda text: F.split(text, ",").cast("array<bigint>"))
    d = spark.createDataFrame([(i, ",".join(map(str, v.tolist()))) for i, v in enumerate(x)], "doc_id int, text string")
    got = {r.doc_id: r.cluster for r in dedup.clusters(d).collect()}
    assert [got[i] for i in range(340)] == want
    sigs = d.select(F.col("doc_id").cast("long").alias("h"), dedup.signature(F.col("text")).alias("sig"))
    alone = {r.h: r.c for r in dedup.linked(sigs, rounds=0).collect()}  # the last step has more to do
    assert [alone[i] for i in range(340)] == want


def test_evaluate(spark):
    rows = [("class_schedule", "class_schedule"), ("ta_office_hours", "class_schedule"), ("unknown", "unknown"), ("class_schedule", "unknown")]
    r = evaluate.evaluate(spark.createDataFrame(rows, "truth string, prediction string")).first()
    assert (r.n, r.accuracy, r.precision, r.recall, r.risky_rate) == (4, 0.5, 0.5, 0.5, 1.0)


def test_plans_and_events(spark):
    rows = [("a", 1, "x", 1), ("a", 2, "y", 2), ("b", 1, "x", 1), ("b", 3, "y", 2), ("c", 2, "x", 1), ("c", 2, "x", 2)]
    got = {r.plan_id: r.fate for r in calendar.plan_from_rows(calendar.plan_issues(spark.createDataFrame(rows, "plan_id string, week int, topic string, seq int"))).collect()}
    assert got == {"a": "kept", "b": "flagged", "c": "dropped"}
    ev = [(1, 1, "exam", 0, 10, "long title"), (1, 1, "exam", 20, 30, "short"), (1, 1, "quiz", 35, 40, "q"), (1, 1, "exam", 45, 50, "z")]
    got = calendar.merge_adjacent(spark.createDataFrame(ev, "doc_id int, page int, type string, char_start int, char_end int, title string")).orderBy("char_start").collect()
    assert [(r.type, r.title, r.merged) for r in got] == [("exam", "short", 2), ("quiz", "q", 1), ("exam", "z", 1)]


def test_ics(spark):
    e = spark.sql("select 'd' doc_id, 'u' uid, concat('A, b;', repeat('가', 30)) title, date'2026-09-07' day, '09:00' start, '10:15' end, date'2026-12-14' until, array(date'2026-09-21') exdates")
    ics = calendar.ics_events(e).first().ics
    assert "RRULE:FREQ=WEEKLY;UNTIL=20261214T145959Z" in ics and "EXDATE;TZID=Asia/Seoul:20260921T090000" in ics and "SUMMARY:A\\, b\\;" in ics
    assert all(len(x.encode()) <= 75 for x in ics.split("\r\n")) and ics.endswith("END:VCALENDAR\r\n")


def test_reingest_and_pii(spark):
    d = "doc_id string, text string, n_pages int"
    old, new = spark.createDataFrame([("a", "old", 1), ("b", "old", 1)], d), spark.createDataFrame([("a", "word " * 60, 1), ("b", "..", 1)], d)
    assert {r.doc_id: r.text[:3] for r in files.reingest(old, new).collect()} == {"a": "wor", "b": "old"}
    got = files.pii_findings(spark.createDataFrame([(1, "x@ok.org y@bad.org")], "id int, text string"), ["ok.org"]).collect()
    assert [r.found for r in got] == ["y@bad.org"]

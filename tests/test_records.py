"""Records, guards, reports, sources and streams on small rows: nulls, blanks, ties and empty tables."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions import dates
from termloom.operators import calendar, evaluate, guards, records, reports, resolve
from termloom.sources import files
from termloom.streaming import reingest


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_paths_and_empty_records(spark):
    d = spark.sql("select named_struct('b', array(named_struct('c', 5), named_struct('c', 6))) a, array('x', 'y') e, cast(null as struct<n:int>) z")
    assert d.select(records.get_path(d, "a.b.c"), records.get_path(d, "e"), records.get_path(d, "z.n")).first()[:] == (5, "x", None)
    schema = T.StructType.fromDDL("title string, events array<struct<day:date>>, who struct<name:string>")
    assert d.select(records.empty_record(schema).alias("r")).first().r.asDict(True) == {"title": None, "events": [], "who": {"name": None}}
    assert d.select(records.first_filled(F.lit(None).cast("string"), F.lit("  "), F.lit("v"), F.lit("w"))).first()[0] == "v"


def test_generic_titles_and_dates(spark):
    d = frame(spark, "t string", ("Weekly quiz and report",), ("Tide tables",), ("12",), ("",), (None,))
    assert [r[0] for r in d.select(guards.is_generic_title(F.col("t"))).collect()] == [True, False, False, False, False]
    t = frame(spark, "t string", ("Due 2031. 9. 8 or 3rd May 2031, also 4/31 and 11-5",), ("no date 2031",), (None,))
    got = [set(r[0]) for r in t.select(guards.document_dates(F.col("t"))).collect()]
    assert {"2031-09-08", "2031-05-03", "11-05"} <= got[0] and got[1:] == [set(), set()]


def test_guards_on_nulls_and_empty_tables(spark):
    e = frame(spark, "doc_id int, seq int, title string, type string, date_raw string", (1, 1, None, None, None), (1, 2, " ", "exam", "null"), (2, 1, "x", "exam", None))
    docs = frame(spark, "doc_id int, text string", (1, None))
    assert guards.risk_gate(e, docs).count() == 0 and guards.risk_gate(e.limit(0), docs).count() == 0
    rows = frame(spark, "doc_id int, topic string, extras array<string>", (1, None, None))
    ev = frame(spark, "doc_id int, kind string, title string, raw_reference string", (1, "exam", None, None), (2, "exam", "Final", None))
    assert guards.suppress_no_session_exams(ev, rows).count() == 2
    assert guards.suppress_scheduled(frame(spark, "doc_id int, seq int, title string", (1, 1, None), (1, 2, "A-b"), (1, 3, "a b")), ev.select("doc_id", "title"), rows).collect()[0][:] == (1, 2, "A-b")


def test_records_on_nulls(spark):
    f = frame(spark, "doc_id int, field string, source string, value string", (1, "a", "x", None), (1, "a", "y", "v"), (1, "a", "zz", "w"), (2, "a", "x", " "))
    assert [tuple(r) for r in records.build_records(f, ["x", "y"], {}).collect()] == [(1, "a", "v", "y")]
    s = frame(spark, "t string", (None,), ("",), ("BU bu and Gamma Hall",))
    names = [("Beta", "BU"), ("Gamma", "gamma hall")]
    assert [r[0] for r in s.select(records.school(F.col("t"), names, {"b.example": "Beta"})).collect()] == [None, None, "Beta"]
    lab = frame(spark, "corrected string, predicted string", (None, None), ("", "unknown"))
    assert [(r.label, r.source) for r in records.dataset_rows(lab).collect()] == [("unknown", "llm_draft")]
    train, aug = frame(spark, "k int", (1,), (2,)), frame(spark, "k int", (2,), (3,), (3,))
    assert [r.k for r in records.not_in_train(aug, train, "k").collect()] == [3]
    c = frame(spark, "p int, o int, v string", (1, 1, None), (1, 2, "a"), (1, 3, " "), (2, 1, " "))
    assert [r.v for r in records.carry_forward(c, "p", "o", "v").orderBy("p", "o").collect()] == [None, "a", "a", None]


def test_augment_is_repeatable(spark):
    d = frame(spark, "k int, t string", *[(i, "read the map at 9:15") for i in range(40)], (99, None))
    a = records.augment(d, "k", "t", 3, {"read": "study", "map": "chart"})
    rows = sorted(map(tuple, a.collect()), key=str)
    assert rows == sorted(map(tuple, a.repartition(3).collect()), key=str) and len(rows) == 41 * 4
    assert {r[1] for r in rows if r[2] == 0} == {"read the map at 9:15", None} and len({r[1] for r in rows}) > 4


def test_equal_values(spark):
    v = lambda f, x: frame(spark, "x string", (x,)).select(f(F.col("x"))).first()[0]
    assert v(reports.norm, "  A –  3.00") == "a - 3.00" and v(reports.norm, "3.00") == "3" and v(reports.norm, None) == ""
    assert v(reports.segments, " b;a ;;b ") == ["a", "b"] and v(reports.segments, None) == []
    assert v(reports.class_segments, "Tuesday, Friday 8:05~9:20") == ["fri 8:05-9:20", "tue 8:05-9:20"]


def test_reports_on_empty_tables(spark):
    cells = frame(spark, "sid int, field string, kind string, shown string, hidden string, blind boolean, gold string, mark string", (1, "f", "text", None, "x", False, "-", "ok"))
    assert reports.trust_gate(cells).first()[:] == (1, 1, 1.0, 0.0, 0.0) and reports.trust_gate(cells.limit(0)).first().confirmed == 0
    assert reports.align_events(None, "a|b") == {"gold_events": 0, "pred_events": 1, "aligned": 0, "exact": 0, "title": 0, "type": 0, "date": 0, "date_kind": 0}
    assert reports.align_events("a|x; a|y", "a|y; b")["exact"] == 0  # the first gold event takes the better of the two
    m = frame(spark, "cluster int, doc_id int, file_key string, meta_key string", (1, 1, "a", None), (1, 2, None, None), (2, 3, "a", "b"), (3, 4, None, "k"), (3, 5, None, "k"))
    assert sorted(map(tuple, reports.cluster_reasons(m).collect())) == [(1, 2, "template_near_identical"), (3, 2, "same_course")]


def test_methods_without_output(spark):
    gold = frame(spark, "sid int, field string, gold string", (1, "f", "A"), (2, "f", " "), (1, "g", "B"))
    preds = frame(spark, "method string, sid int, field string, value string", ("m", 1, "f", "a"), ("m", 2, "f", "z"), ("n", 1, "f", ""), ("n", 9, "f", "x"))
    got = {(r.field, r.method): (r.n, r.n_output, r.n_correct, r.n_fabricated) for r in evaluate.method_metrics(gold, preds).collect()}
    assert got == {("f", "m"): (2, 2, 1, 1), ("f", "n"): (2, 0, 0, 0), ("g", "m"): (1, 0, 0, 0), ("g", "n"): (1, 0, 0, 0)}


def test_thresholds_and_weights(spark):
    s = frame(spark, "threshold double, precision double", (0.3, 0.8), (0.5, 0.95), (0.7, 0.96))
    assert evaluate.recommend(s, 0.9).first().threshold == 0.5 and evaluate.recommend(s, 0.99).first().threshold is None
    w = {r.label: r.weight for r in evaluate.class_weights(frame(spark, "label string", ("unknown",), ("unknown",), ("exam_time",), ("exam_time",))).collect()}
    assert w == {"unknown": 0.25, "exam_time": 0.25}


def test_events_by_priority_and_dates(spark):
    e = "doc_id int, title string, week int, raw string"
    got = calendar.merge_by_priority(frame(spark, e, (1, "Exam", 3, "r")), frame(spark, e, (1, "Exam", 3, "q"), (1, "Essay", None, "s"))).collect()
    assert sorted((r.title, r.raw) for r in got) == [("Essay", "s"), ("Exam", "r")]
    x = frame(spark, "doc_id int, type string, resolved_date date", (1, "midterm", None), (1, "midterm", date(2031, 9, 8)), (2, "final", None), (1, "quiz", None))
    assert calendar.drop_undated_when_dated(x).count() == 3
    d = frame(spark, "s date, e date, n int", (date(2031, 9, 1), None, 3), (date(2031, 9, 1), date(2031, 9, 9), 30))
    nth = dates.nth_class_day(F.col("s"), F.col("e"), F.col("n"), F.array(F.lit(0), F.lit(2)), F.array(F.lit("2031-09-03").cast("date")))
    assert [r[0] for r in d.select(nth).collect()] == [date(2031, 9, 10), None]
    t = frame(spark, "start string, end string", ("9:00", "10:00"), ("10:00", "9:00"), (None, "9:00"))
    assert resolve.check_timetables(t).count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    for name in ("a b/x.pdf", "y.TXT", ".hidden.pdf", "z.png"):
        (tmp_path / name).write_text("x")
    assert sorted(r.doc_id for r in files.corpus_files(spark, str(tmp_path)).select("doc_id").collect()) == ["a_b__x.pdf", "y.TXT"] or pytest.fail("ids of files")
    (tmp_path / "d.json").write_text(json.dumps({"doc_id": "d", "pages": [{"page_no": 1, "text": "t", "tables": [{"header": ["h"], "rows": [["c"]]}]}]}, indent=1))
    d = files.read_documents(spark, str(tmp_path / "d.json")).first()
    assert (d.doc_id, d.pages[0].tables[0].rows, d.notes) == ("d", [["c"]], None)
    (tmp_path / "r.jsonl").write_text('{"k": 1}\n\n{"k": 2, "other": 0}\n')
    assert sorted(r.k for r in files.read_rows(spark, str(tmp_path / "r.jsonl"), "k int").collect()) == [1, 2]
    q = frame(spark, "t string, n int", ("(cid:7) " * 30, 1), ("short", 1), ("Tides rise and fall with the moon. " * 20, 1))
    assert [r[0] for r in q.select(files.quality_flag(F.col("t"), F.col("n"))).collect()] == ["needs_ocr", "scan", "ok"]
    docs = frame(spark, "doc_id string, text string, n_pages int, quality string", ("a", "x", 1, "failed"), ("b", "x", 1, "ok"), ("c", "Tides rise and fall. " * 20, 1, "ok"))
    got = files.ocr_manifest(docs, frame(spark, "doc_id string, source_path string", ("a", "p"))).collect()
    assert sorted((r.doc_id, r.reason, r.source_path) for r in got) == [("a", "failed", "p"), ("b", "chrome_only", None)]


def test_stream_takes_each_file_once(spark, tmp_path):
    d = frame(spark, "doc_id string, text string", ("a", "x"), ("b", None))
    for _ in range(2):
        d.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        reingest.run_available(reingest.arriving_documents(spark, str(tmp_path / "in"), "doc_id string, text string"), str(tmp_path / "out"), str(tmp_path / "ck"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 4 and out.where("low_content").count() == 4

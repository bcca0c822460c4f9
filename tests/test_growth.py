"""What keeps the cost of a row and the size of a task from growing: dealt rows, values computed once, shortened searches."""

import re

import pytest
from pyspark.sql import functions as F

from termloom.functions.dates import parse_week
from termloom.operators import candidates, dedup, fields, skew, walk, weekly
from termloom.sources.files import DOCUMENT


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def filters(df):
    return "\n".join(x for x in plan(df).splitlines() if "Filter " in x).lower()


def test_filters_find_labels_computed(spark):
    d = spark.createDataFrame([("a", [(1, "Midterm exam 2031-03-02", [])], "text", "ok", None)], DOCUMENT)
    cands = walk.run_pipeline(d)
    assert "contains(" not in filters(walk.dated_entries(cands)) and "contains(" not in filters(walk.route(d, cands))
    assert [(r.title, r.resolved_date) for r in walk.dated_entries(cands).collect()] == [("Midterm exam", "2031-03-02")]


def test_dates_of_tables_are_read_once(spark):
    t = spark.createDataFrame([("a", 0, [["Sep 2", "Intro"], ["2/11", "Means"], ["11월 3일", "Test"]])], "doc_id string, table_no int, rows array<array<string>>")
    got = weekly.dated_rows(t, spark.createDataFrame([("a", 2031)], "doc_id string, year int"))
    assert "regexp" not in filters(got)
    assert [str(r.day) for r in got.orderBy("place").collect()] == ["2031-09-02", "2032-02-11", "2031-11-03"]


def test_labels_are_sought_once(spark):
    d = spark.createDataFrame([("a", "과목명: 통계학(Statistics)\n학점: 3")], "doc_id string, text string")
    x = fields.rule_fields(d)
    assert plan(x).count("교과목명|과목명|강의명|course title|course name)") <= 2
    assert [(r.title_ko, r.title_en, r.credits) for r in x.collect()] == [("통계학", "Statistics", 3.0)]
    week = str(parse_week(F.col("c")))
    assert week.count("regexp_extract") == 1


def test_dealt_rows_follow_their_size(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(400_000).select("id", (F.col("id") % 5000).alias("k")).coalesce(1).write.parquet(path)
    t = spark.read.parquet(path)
    x = skew.dealt(t, "k")
    assert t.rdd.getNumPartitions() == 1 and x.rdd.getNumPartitions() == 12
    at = x.select("k", F.spark_partition_id().alias("p")).distinct()
    assert at.count() == 5000 and x.count() == 400_000
    assert skew.dealt(t.limit(0), "k").count() == 0


@pytest.mark.parametrize("name", ["plan_alignment", "adjacent_events"])
def test_runs_are_dealt_by_size(spark, name):
    from termloom.plans import registry

    df = registry.queries()[name](spark, "/root/testdata/sf0.1")
    assert "RepartitionByExpression" in plan(df)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_class_times_by_brute_force(spark):
    near, run = re.compile(walk.OFFICE_NEAR), "Mon 1:00-2:00"
    texts = ["", None, run, f"office {run}{run} x", f"{run}{run}{run}{run} office", f"{'y ' * 19}{run}{'z ' * 30}TA", f"office{' ' * 41}{run}", f"a\x01b {run} 상담", "월1:00-2:00" * 6 + " 면담", f"{run}\n{'w' * 39}TA\n{run}"]

    def brute(t):
        for m in re.finditer(rf"(?is)(.{{0,40}}?)({walk.CLASS_RUN})(?=(.{{0,40}}))", t or ""):
            if not near.search(m[1] + " " + m[3]):
                return m[2]

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", walk.fallback_class_time(F.col("t")).alias("x")).collect()
    assert {r.i: r.x for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_spans_of_plain_texts_by_all_patterns():
    texts = ["Mon 10:00-11:15, week 3, 3 pm, 2031-03-02, 2nd Mar 9:00 AM", "", "월요일 3교시 week 2", "nothing"]
    for t, got in zip(texts, candidates.spans.func(__import__("pandas").Series(texts))):
        found = sorted({m.span() for p in candidates._COMPILED for m in p.finditer(t)}, key=lambda s: (s[0], -s[1]))
        assert [(x["start"], x["end"]) for x in got] == [s for i, s in enumerate(found) if all(s[1] > e for _, e in found[:i])]


def test_minima_by_brute_force(monkeypatch):
    sizes = []
    unique = dedup.np.unique
    monkeypatch.setattr(dedup.np, "unique", lambda x: sizes.append(len(x)) or unique(x))
    texts = ["a b c d e f g h i", "ab" * 40, "".join(chr(0x41 + i * i % 977) for i in range(3000)), "x" * 5000]
    for t in texts:
        grams = {tuple(map(ord, t[i : i + 5])) for i in range(len(t) - 4)}
        want = []
        for g in grams:
            h = 0
            for c in g:
                h = (h ^ c) * 0x9E3779B97F4A7C15 % 2**64
                h ^= h >> 29
            want.append(h)
        assert dedup.minima(t) == ([min(h * int(m) % 2**64 >> 1 for h in want) for m in dedup._MULTIPLIERS] if len(want) >= 8 else None)
    assert max(sizes[:3]) <= 256  # texts of many grams aren't sorted

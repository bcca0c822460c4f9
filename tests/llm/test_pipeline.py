"""The pipeline as a whole and each of its stages: nulls, repeats, copies, secrets and empty tables."""

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
GOOD = "the tide of day {0} rises over the long grey shore and the boats of harbour {0} come home with the evening light while gulls number {0} cry"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    good = [(i, GOOD.format(i) + f" password = hunter{i}secret and station {i} closes at noon {i * 7} for bell {i * 3}", "en", "ab"[i % 2], 0) for i in range(60)]
    junk = [(100 + i, f"$$ ## {i} !! @@ %% {i * 3} ^^ && ** {i * 5} << >> ~~", "en", "a", 0) for i in range(60)]
    copies = [(200, good[0][1], "en", "b", 0), (201, good[0][1] + " indeed", "en", None, 0)]
    odd = [(None, None, None, None, None), (300, "", "en", "a", 0)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(good + junk + copies + odd, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in junk], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = corpus_pipeline.rank_quality(spark, docs, tables)
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(60)) <= ids and not ids & set(range(100, 160))
    once = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, tables).collect()}
    assert 0 in once and not once & {200, 201} and set(range(1, 60)) <= once
    masked = {r.doc_id: r for r in corpus_pipeline.mask_secrets(spark, docs, tables).collect()}
    assert len(masked) == docs.count() and masked[None].text is None
    assert all("hunter" not in masked[i].text and masked[i].n_chars == len(masked[i].text) and f"station {i} closes" in masked[i].text for i in range(60))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns


def test_run(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert ids and not ids & ({200, 201} | set(range(100, 160)))


def test_empty_table(spark, tables, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tables}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

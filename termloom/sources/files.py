"""Corpus files, normalised documents and row sets as sources; reviews and calendars as sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import EMAIL, PHONE, is_low_content

SUFFIXES = ("pdf", "hwp", "hwpx", "doc", "docx", "txt")
DOCUMENT = "doc_id string, pages array<struct<page_no:int,text:string,tables:array<struct<header:array<string>,rows:array<array<string>>>>>>, source_format string, extraction_quality string, notes array<string>"


def doc_id_of(path: Column, root: str) -> Column:
    """Path below the root, `/` as `__` and blanks as `_`."""
    return F.replace(F.replace(F.regexp_replace(path, "^.*?" + root.strip("/").replace(".", r"\.") + "/", ""), F.lit("/"), F.lit("__")), F.lit(" "), F.lit("_"))


def corpus_files(spark: SparkSession, root: str, suffixes: tuple = SUFFIXES) -> DataFrame:
    """doc_id, path, length of the files below root, hidden ones aside; contents are read only where asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*suffixes) & ~name.startswith(".")).select(doc_id_of(F.col("path"), root).alias("doc_id"), "path", "length", "content")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Normalised documents, one JSON object each; missing fields are null."""
    return spark.read.schema(DOCUMENT).option("multiLine", "true").json(path)


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, blank ones skipped."""
    return spark.read.schema(schema).json(path)


def quality_flag(text: Column, pages: Column) -> Column:
    """ok, low, scan or needs_ocr of extracted PDF text."""
    marks = F.length(text) - F.length(F.replace(text, F.lit("(cid:"), F.lit("")))
    per_page = F.length(text) / F.greatest(pages, F.lit(1))
    return F.when(marks / 5 * 8 > 0.3 * F.length(text), "needs_ocr").when(per_page < 30, "scan").when(is_low_content(text, pages), "needs_ocr").when(per_page >= 100, "ok").otherwise("low")


def ocr_manifest(docs: DataFrame, paths: DataFrame) -> DataFrame:
    """doc_id, reason, raw_chars, source_path of documents that need reading again. docs: doc_id, text, n_pages, quality."""
    q = F.col("quality")
    reason = F.when(q.isin("needs_ocr", "failed", "low"), q).when(is_low_content(F.col("text"), F.col("n_pages")), "chrome_only")
    return docs.select("doc_id", reason.alias("reason"), F.length("text").alias("raw_chars")).where("reason is not null").join(paths, "doc_id", "left")


def reingest(old: DataFrame, new: DataFrame) -> DataFrame:
    """New documents replace old ones of the same id, unless they are still of low content."""
    better = new.where(~is_low_content(F.col("text"), F.col("n_pages")))
    return old.join(better.select("doc_id"), "doc_id", "left_anti").unionByName(better)


def pii_findings(lines: DataFrame, allowed_domains: list[str], id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, kind, found: e-mail addresses outside the allowed domains, and telephone numbers."""
    t = F.col(text_col)
    mail = lines.select(F.col(id_col).alias("id"), F.lit("email").alias("kind"), F.explode(F.regexp_extract_all(t, F.lit(EMAIL), F.lit(0))).alias("found"))
    domain = F.lower(F.substring_index("found", "@", -1))
    ok = F.lit(False)
    for d in allowed_domains:
        ok = ok | (domain == d) | domain.endswith("." + d)
    phone = lines.select(F.col(id_col).alias("id"), F.lit("phone").alias("kind"), F.explode(F.regexp_extract_all(t, F.lit(PHONE), F.lit(0))).alias("found"))
    return mail.where(~ok).unionByName(phone)


def write_review(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Fixed columns as CSV; others are ignored and missing ones empty."""
    rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option("header", "true").csv(path)


def write_calendars(ics: DataFrame, path: str) -> None:
    """Calendars, one row and text each, in files of about equal size."""
    ics.select("ics").write.mode("overwrite").option("lineSep", "\r\n").text(path)

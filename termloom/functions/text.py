"""Text columns: glyph repair, text quality, contacts, pipe tables. All but nfc stay in the JVM."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as page furniture, in the order of removal.
CHROME = [r"(?i)https?://\S+", r"(?i)\bPage\s+\d+\s+of\s+\d+\b", r"\b\d{1,2}[/.\-]\d{1,2}[/.\-]\d{2,4}\b", r"(?i)\b\d{1,2}:\d{2}\s*(?:[AP]M)?\b", r"[\s\W_]+"]
# Written-out signs of addresses.
OBFUSCATED = [(r"(?i)\s*(?:\[at\]|\(at\)|＠|\s+at\s+)\s*", "@"), (r"(?i)\s*(?:\[dot\]|\(dot\))\s*", ".")]
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?:\+82[-\s]?\d{1,2}|0\d{1,2})[-.\s)]?\d{3,4}[-.\s]?\d{4}"


def once(value: Column, *fs) -> Column:
    """value with the functions applied in turn, each of what they get computed once however often they name it."""
    return F.get(reduce(F.transform, fs, F.array(value)), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.get(F.filter(F.array(F.trim(c)), lambda x: x != ""), F.lit(0))


def repair_doubled_runs(text: Column) -> Column:
    """Halve every pair of equal characters in lines of 8 or more whose pairs make up over 60 % of them."""

    def line(s: Column) -> Column:
        paired = F.length(s) - F.length(F.regexp_replace(s, r"(.)\1", ""))
        return F.when((F.length(s) >= 8) & (paired > 0.6 * F.length(s)), F.regexp_replace(s, r"(.)\1", "$1")).otherwise(s)

    return F.array_join(F.transform(F.split(text, "\n", -1), line), "\n")


def full_text(pages: Column) -> Column:
    """Repaired page texts joined by newlines. pages: array<struct<text,...>>."""
    return F.array_join(F.transform(pages, lambda p: repair_doubled_runs(p["text"])), "\n")


def substantive_text(text: Column) -> Column:
    return reduce(lambda t, p: F.regexp_replace(t, "(?U)" + p, ""), CHROME, F.coalesce(text, F.lit("")))


def is_low_content(text: Column, pages: Column | int = 1, min_total: int = 80, min_per_page: int = 25) -> Column:
    n = F.length(substantive_text(text))
    return (n < min_total) | (n / F.greatest(pages if isinstance(pages, Column) else F.lit(pages), F.lit(1)) < min_per_page)


def is_text_valid(quality: Column, text: Column, least: int = 120) -> Column:
    return ~quality.isin("needs_ocr", "failed") & (F.length(text) >= least)


def emails(text: Column) -> Column:
    """Addresses in lower case, distinct in order, written-out signs read as signs."""
    t = reduce(lambda t, p: F.regexp_replace(t, p[0], p[1]), OBFUSCATED, text)
    return F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(EMAIL), F.lit(0)), lambda x: F.regexp_replace(F.lower(x), r"\.+$", "")))


def phones(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PHONE), F.lit(0)), lambda x: F.trim(F.regexp_replace(x, r"[.\s)]", "-"), F.lit("-"))))


def context_blob(section: Column, row: Column, col: Column, before: Column, after: Column) -> Column:
    return F.array_join(F.filter(F.array(section, row, col, before, after), lambda x: x.isNotNull() & (x != "")), " ")


def compose_input(text: Column, section: Column, row: Column, col: Column, before: Column, after: Column) -> Column:
    """`text [SEP] section / row / col [SEP] before after`."""
    some = lambda *c: F.filter(F.array(*c), lambda x: x.isNotNull() & (x != ""))
    return F.concat_ws(" [SEP] ", text, F.array_join(some(section, row, col), " / "), F.array_join(some(before, after), " "))


def pipe_tables(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, table_no, row_no, cells: runs of consecutive lines with a pipe character, by gaps and islands."""
    lines = docs.select(F.col(id_col).alias("doc"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line", "s")).where(F.contains("s", F.lit("|")))
    w = Window.partitionBy("doc").orderBy("line")
    start = (F.col("line") - F.coalesce(F.lag("line").over(w), F.lit(-2)) > 1).cast("int")
    t = lines.withColumn("start", start).withColumn("table_no", F.sum("start").over(w))
    row = F.row_number().over(Window.partitionBy("doc", "table_no").orderBy("line"))
    cells = F.transform(F.split(F.trim(F.col("s"), F.lit("| ")), r"\|", -1), lambda c: F.trim(c))
    return t.select("doc", F.col("table_no").cast("int").alias("table_no"), row.alias("row_no"), cells.alias("cells"))


def table_cells(rows: DataFrame, header: Column | None = None) -> DataFrame:
    """Non-empty cells of (doc, table_no, row_no, cells) with the row's first cell and the column's header."""
    head = header if header is not None else F.lit(None).cast("array<string>")
    x = rows.select("doc", "table_no", "row_no", F.get("cells", F.lit(0)).alias("row_label"), head.alias("head"), F.posexplode("cells").alias("col_no", "text"))
    return x.where("trim(text) <> ''").select("doc", "table_no", "row_no", "col_no", "row_label", F.get("head", "col_no").alias("col_label"), "text")


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Composed form; Spark has no function for it."""
    return s.str.normalize("NFC")


def norm_title(title: Column) -> Column:
    """Letters and digits only, a trailing numeral dropped. The title should be composed (nfc)."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^가-힣a-z0-9]", ""), "(i{1,3}|[12])$", "")

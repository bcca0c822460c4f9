"""Secret scans with multipart credential linking.

Native: DataFrame functions only. Strong patterns (assignments, access identifiers, long hexadecimal runs) are reported
wherever they match. Weak candidates (identifiers, bare 40-character keys, endpoints) are reported only when a part of a
complementary role lies within their scope, found by an interval join over bins of the scope's width.

Positions are code points: the text is split by the pattern, and the lengths of gaps and matches are summed up.
Defined results: a null text is empty and has no spans; repeated rows each get a row; texts that are equal share one
interval join; matches that fail the length rule are dropped but still consume their characters; an empty table gives an
empty result; extra columns are ignored. Bins hold few spans however long a text is, because spans of a kind don't
overlap, so the interval join is linear.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.names import free_names
from termloom.operators.lineage import stage

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group that the length rule measures, least length, role. The order is the order of ties.
BASE = [("assign", ASSIGN, 2, 6, "secret"), ("access", r"AKIA[A-Z0-9]+", 0, 20, "identifier"), ("hex", r"[0-9a-f]+", 0, 24, "secret")]
WEAK = [
    ("ident", r"""((?i:user(?:name)?|login|account|client_?id|access_?key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", 2, 3, "identifier"),
    ("key40", r"[A-Za-z0-9/+]+", 0, 40, "secret"),
    ("endpoint", r"(?i:https?|wss?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[A-Za-z0-9._~:@/?%&=+-]+", 0, 8, "endpoint"),
]
#: A weak candidate of the first role is reported if a part of one of the others is in its scope.
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier",), "endpoint": ("secret", "identifier")}
#: Runs of one class: a long enough run is what `+` and the length rule leave, and most texts have none.
RUNS = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}", "key40": r"[A-Za-z0-9/+]{40,}"}
#: Texts without any of these, in lower case, hold no match; plain search is far cheaper than the pattern.
NEEDED = {"assign": ("password", "passwd", "secret", "token", "api_key", "apikey"), "access": ("akia",), "ident": ("user", "login", "account", "client", "access"), "endpoint": ("://",)}
SPAN = "array<struct<s:int,k:int,e:int>>"


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int, order: int) -> Column:
    """All kept matches as array<struct<s,k,e>> in code points, end exclusive."""
    p = F.lit(RUNS.get(kind, pattern))
    found, value, gaps = F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(group)), F.split(text, RUNS.get(kind, pattern), -1)
    pieces = F.arrays_zip(F.transform(found, F.length).alias("m"), F.transform(value, F.length).alias("v"), F.transform(F.slice(gaps, F.lit(1), F.size(found)), F.length).alias("g"))
    empty = F.array().cast(SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        here = F.array(F.struct(start.alias("s"), F.lit(order).alias("k"), (start + x["m"]).alias("e")))
        return F.struct((start + x["m"]).alias("at"), F.when(x["v"] >= least, F.concat(acc["out"], here)).otherwise(acc["out"]).alias("out"))

    out = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)["out"]
    maybe = text.rlike(RUNS.get(kind, pattern))
    if kind in NEEDED:
        maybe = reduce(or_, [F.contains(F.lower(text), F.lit(x)) for x in NEEDED[kind]]) & maybe
    return F.when(maybe, out).otherwise(empty)


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k[0]) for k in BASE + WEAK])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def parts(text: Column) -> tuple[Column, Column]:
    """Base spans, and weak candidates that overlap no base span."""
    base = F.concat(*[spans_of(text, *k[:4], i) for i, k in enumerate(BASE)])
    return base, F.concat(*[spans_of(text, *k[:4], i + len(BASE)) for i, k in enumerate(WEAK)])


def link(cand: DataFrame, scope: int) -> DataFrame:
    """The weak spans of each text with a complementary part in scope. cand: key, base, weak, of distinct texts."""
    roles = F.array(*[F.lit(k[4]) for k in BASE + WEAK])
    flat = lambda c: cand.select("key", F.explode(c).alias("x")).select("key", F.get(roles, F.col("x.k")).alias("role"), F.col("x.s").alias("s"), F.col("x.k").alias("k"), F.col("x.e").alias("e"))
    weak, every = flat("weak"), flat(F.concat("base", "weak"))
    needs = F.create_map(*[x for r, c in COMPLEMENTS.items() for x in (F.lit(r), F.array(*map(F.lit, c)))])
    w = weak.select("*", needs[F.col("role")].alias("needs"), F.explode(F.expr(f"sequence(greatest(0, s - {scope}) div {scope}, (e + {scope}) div {scope})")).alias("bin"))
    # A part is met in the bin of its own start, or in that of the scope's start for parts that begin before it.
    c = every.select("key", F.col("role").alias("crole"), F.col("s").alias("cs"), F.col("e").alias("ce"), F.explode(F.expr(f"sequence(s div {scope}, e div {scope})")).alias("bin"))
    near = (F.col("cs") <= F.col("e") + scope) & (F.col("ce") >= F.col("s") - scope) & F.array_contains("needs", F.col("crole"))
    hit = w.join(c, ["key", "bin"]).where(near).select("key", "s", "k", "e").distinct()
    return hit.groupBy("key").agg(F.collect_list(F.struct("s", "k", "e")).cast(SPAN).alias("linked"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 240) -> DataFrame:
    """doc_id, key (SHA-256 of texts with candidates, else null), base and linked: spans of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, weak = parts(text)
    d = docs.select(F.col(id_col).alias("doc_id"), base.alias("base"), weak.alias("weak"), F.sha2(text, 256).alias("key"))
    clear = F.filter("weak", lambda w: ~F.exists("base", lambda b: (b["s"] < w["e"]) & (w["s"] < b["e"])))
    d = d.withColumn("weak", F.when((F.size("weak") > 0) & (F.size("base") > 0), clear).otherwise(F.col("weak")))
    d = stage(d, "secrets")
    cand = d.where((F.size("weak") > 0) & (F.size("weak") + F.size("base") > 1)).groupBy("key").agg(F.first("base").alias("base"), F.first("weak").alias("weak"))
    linked = link(cand, scope)
    has = F.size("weak") > 0
    none = F.array().cast(SPAN)
    return (
        d.where(has).join(linked, "key", "left").select("doc_id", "key", "base", F.coalesce("linked", none).alias("linked"))
        .unionByName(d.where(~has).select("doc_id", "key", "base", none.alias("linked")))
    )


def report(found: DataFrame) -> DataFrame:
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "linked")).alias("spans"))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every maximal union of spans replaced by the mask."""
    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        part = F.substring(text, acc["at"] + 1, x["s"] - acc["at"])
        fresh = x["s"] >= acc["at"]
        return F.struct(F.when(fresh, F.concat(acc["out"], part, F.lit(mask))).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["e"]).alias("at"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(F.array_sort(spans), first, step, rest)).otherwise(text)


def redact_documents(docs: DataFrame, text_col: str = "text", scope: int = 240) -> DataFrame:
    """docs with every reported span of the text masked; the columns stay as they are.

    Only texts with weak candidates, which may need a link, are joined with the links of their content.
    """
    names = docs.columns
    b, w, k, x = free_names(names, "base", "weak", "key", "linked")
    base, weak = parts(F.coalesce(F.col(text_col), F.lit("")))
    d = stage(docs.withColumns({b: base, w: weak}), "spans")  # patterns run once
    d = d.withColumn(w, F.filter(w, lambda v: ~F.exists(b, lambda u: (u["s"] < v["e"]) & (v["s"] < u["e"]))))
    sure = d.where(F.size(w) == 0).withColumn(text_col, redact(F.col(text_col), F.col(b))).select(names)
    open_ = d.where(F.size(w) > 0).withColumn(k, F.sha2(F.col(text_col), 256))
    cand = open_.groupBy(F.col(k).alias("key")).agg(F.first(b).alias("base"), F.first(w).alias("weak"))
    linked = link(cand, scope).select(F.col("key").alias(k), F.col("linked").alias(x))
    tied = open_.join(linked, k, "left").withColumn(text_col, redact(F.col(text_col), F.concat(b, F.coalesce(x, F.array().cast(SPAN))))).select(names)
    return sure.unionByName(tied)


def op6_secret_links(spark, sf_dir: str) -> DataFrame:
    return report(scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))

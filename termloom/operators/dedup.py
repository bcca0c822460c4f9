"""Near-duplicate clusters of documents by MinHash signatures and banded buckets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.operators.components import components
from termloom.operators.lineage import stage

SLOTS, BANDS, ROWS = 48, 12, 4


def char_shingles(text: Column, k: int = 5) -> Column:
    """Distinct character k-grams of the lower-cased text with squashed white space."""
    s = squash(text)
    grams = F.transform(F.sequence(F.lit(1), F.length(s) - (k - 1)), lambda i: F.substring(s, i, F.lit(k)))
    return F.when(F.length(s) >= k, F.array_distinct(grams)).when(s != "", F.array(s)).otherwise(F.array().cast("array<string>"))


_MULTIPLIERS = np.random.default_rng(42).integers(1, 2**63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(text: str, k: int = 5) -> list[int] | None:
    """Smallest hashes of the text's distinct character k-grams under 48 multipliers; null below 8 of them."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(codes) - k + 1
    if n < 8:
        return None
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h = (h ^ codes[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    if len(np.unique(h[:256])) < 8 and len(np.unique(h)) < 8:
        return None
    low = np.full(SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, n, 512):  # products of a block stay in the cache; repeated grams don't change a minimum
        np.minimum(low, (h[i : i + 512] * _MULTIPLIERS[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(1)).astype(np.int64).tolist()


@F.pandas_udf(T.ArrayType(T.LongType()))
def _signatures(squashed: pd.Series) -> pd.Series:
    return squashed.map(lambda t: minima(t or ""))


def squash(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " ")))


def signature(text: Column) -> Column:
    """48 minima of seeded hashes over the shingles; null below 8 shingles. The hash is the engine's own."""
    return _signatures(squash(text))


def estimated_jaccard(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.coalesce(same / SLOTS, F.lit(0.0))


def _keys(least: float) -> tuple[int, list[tuple[int, int]]]:
    """Slots that must agree, and ranges of slots of which every linked pair agrees in one at least.

    A pair that differs in d slots or fewer agrees throughout one of any d + 1 ranges. Where that takes more ranges than
    there are bands, the bands are the ranges, and pairs are those that share a band.
    """
    need = next((n for n in range(SLOTS + 1) if n / SLOTS >= least), SLOTS + 1)
    parts = max(1, min(SLOTS - need + 1, BANDS))
    ends = [SLOTS * i // parts for i in range(parts + 1)]
    return need, list(zip(ends, ends[1:]))


def _merge(tagged: DataFrame, links: DataFrame) -> DataFrame:
    """tagged (h, c) after links (c, d) between components."""
    links = stage(links.distinct(), "links")
    if links.isEmpty():
        return tagged
    top = components(links, "c", "d").select(F.col("node").alias("c"), F.col("component").alias("top"))
    return stage(tagged.join(top, "c", "left").select("h", F.coalesce("top", "c").alias("c")), "tagged")


def _within(tagged: DataFrame, keys: DataFrame, sigs: DataFrame, need: int, rounds: int) -> DataFrame:
    """tagged (h, c) after linking members of a bucket, keys (h, b, key), that agree in `need` slots or more.

    Members of a bucket first try its smallest, then, where they are still in another component, salted ones, which
    only leaves less to the last step: it compares every pair of a bucket whose members are in different components.
    """
    shared = keys.groupBy("b", "key").agg(F.count("*").alias("n")).where("n > 1").select("b", "key")
    keys = stage(keys.join(shared, ["b", "key"]), "keys")
    agree = lambda x, y: F.expr(" + ".join(f"int({x}[{i}] = {y}[{i}])" for i in range(SLOTS))) >= need
    for i in range(rounds + 1):
        at = keys.join(tagged, "h")
        order = F.col("h") if i == 0 else F.xxhash64(F.lit(i), "b", "key", "h")
        pick = at.groupBy("b", "key").agg(F.min(F.struct(order.alias("o"), F.col("h").alias("g"), F.col("c").alias("d"))).alias("x"), F.min("c").alias("c0"), F.max("c").alias("c1"))
        tries = at.join(pick.where("c0 <> c1").select("b", "key", "x.g", "x.d"), ["b", "key"]).where("c <> d").select("h", "g", "c", "d").distinct()
        both = tries.join(sigs.withColumnRenamed("sig", "s1"), "h").join(sigs.select(F.col("h").alias("g"), F.col("sig").alias("s2")), "g")
        tagged = _merge(tagged, both.where(agree("s1", "s2")).select("c", "d"))
    at = keys.join(tagged, "h")
    mixed = at.groupBy("b", "key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("b", "key")
    left = stage(at.join(mixed, ["b", "key"]).join(sigs, "h").select("b", "key", "c", "sig"), "open")
    x, y = left.select("b", "key", "c", F.col("sig").alias("s1")), left.select("b", "key", F.col("c").alias("d"), F.col("sig").alias("s2"))
    return _merge(tagged, x.join(y, ["b", "key"]).where("c < d").where(agree("s1", "s2")).select("c", "d"))


def linked(sigs: DataFrame, least: float = 0.9, rounds: int = 2, metas: DataFrame | None = None, meta_least: float = 0.85) -> DataFrame:
    """h, c (smallest h of the component) of signatures (h, sig) under links of an estimated similarity of `least` or more.

    metas (h, meta_key): signatures that share a metadata key link from `meta_least` on.
    """
    need, ranges = _keys(least)
    of = lambda i, lo, hi: F.struct(F.lit(i).alias("b"), F.xxhash64(F.slice("sig", lo + 1, F.lit(hi - lo))).alias("key"))
    keys = stage(sigs.select("h", F.explode(F.array(*[of(i, lo, hi) for i, (lo, hi) in enumerate(ranges)])).alias("x")).select("h", "x.b", "x.key"), "keys")
    tagged = _within(stage(sigs.select("h", F.col("h").alias("c")), "tagged"), keys, sigs, need, rounds)
    if metas is not None:
        same = metas.where("meta_key is not null").distinct().select("h", F.lit(-1).alias("b"), F.col("meta_key").alias("key"))
        tagged = _within(tagged, stage(same, "keys"), sigs, _keys(meta_least)[0], rounds)
    return tagged


def clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9, file_key: str | None = None, meta_key: str | None = None) -> DataFrame:
    """doc_id, cluster (smallest id), size. Equal texts are one node, equal signatures link without being compared.

    Signatures are computed once per distinct text. Every pair of signatures that shares a band and has an estimated
    similarity of `least` or more is a link; pairs within a component need no comparison. Columns of keys may be named:
    documents of one file key are linked whatever their texts, those of one metadata key from a similarity of 0.85 on.
    """
    none = F.lit(None).cast("string")
    keyed = [(F.col(c).cast("string") if c else none).alias(n) for c, n in ((file_key, "file_key"), (meta_key, "meta_key"))]
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *keyed).withColumn("h", F.xxhash64("text"))
    ids = stage(d.select("doc_id", "h", "file_key", "meta_key"), "ids")
    once = d.groupBy("h").agg(F.min("text").alias("text"))
    texts = stage(once.select("h", signature(F.col("text")).alias("sig")).where("sig is not null"), "signatures")
    sigs = stage(texts.groupBy("sig").agg(F.min("h").alias("h")).select("h", "sig"), "signatures")
    same = texts.join(sigs.withColumnRenamed("h", "first"), "sig").select("h", "first")
    metas = ids.join(same, "h").select(F.col("first").alias("h"), "meta_key") if meta_key else None
    comp = same.join(linked(sigs, least, metas=metas).withColumnRenamed("h", "first"), "first").select("h", F.col("c").alias("component"))
    got = ids.join(comp, "h", "left").withColumn("c", F.coalesce("component", "h"))
    if file_key:
        got = stage(got, "ids")
        lead = got.where("file_key is not null").groupBy("file_key").agg(F.min("c").alias("d"), F.max("c").alias("top")).where("d <> top")
        edges = stage(got.join(lead, "file_key").where("c <> d").select("c", "d").distinct(), "links")
        if not edges.isEmpty():
            tops = components(edges, "c", "d").select(F.col("node").alias("c"), F.col("component").alias("to"))
            got = got.join(tops, "c", "left").withColumn("c", F.coalesce("to", "c"))
    names = got.groupBy("c").agg(F.min("doc_id").alias("cluster"), F.count("*").alias("size"))
    return got.join(names, "c").select("doc_id", "cluster", "size")


def keep_last(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key."""
    r = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))
    return rows.withColumn("__r", r).where("__r = 1").drop("__r")

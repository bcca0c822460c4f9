"""N-gram Jaccard join: grouped prefix join over word shingles, exact.

1. Distinct texts are cut into shingle sets; the shingles travel packed, one row per task and bucket of shingles.
2. Every bucket counts in how many distinct texts each of its shingles occurs and sends back those that occur in
   several. A text's set is ordered by that frequency, so its shingles that no other text has come first; texts whose
   prefix holds only such shingles have no partner and are done.
3. Of the rest, texts with the same prefix and size form a group. Groups meet on the shingles of their prefixes.
   Members are verified by the exact sizes of intersection and union.

Only connected components are asked for, so pairs within a component need no verification: first each text is verified
against the first text of its group and of each of its prefix shingles, then every pair of groups that share a prefix
shingle, pass the size and position filters and still hold members of different components is expanded and verified.
A group of many near copies so costs a number of verifications in proportion to its members, and no link between
components is lost. Texts are known by a 64-bit hash of their content; shingles by the high 48 bits of their hash, of whose
low bits the bucket tells some. So beyond some billions of distinct texts a few strangers share a hash.

Defined results: a null or blank text has no shingles, no links and is its own component; repeated rows and equal texts
link; a null id is never a component's name, unless it is the row's own; an empty table gives an empty result; extra
columns are ignored. Memory of a task grows with its longest text and with `bucket` shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.memory import give_back, tidy
from termloom.llm.names import free_names
from termloom.llm.shingles import shingle_sets
from termloom.operators.components import components
from termloom.operators.lineage import stage


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], dtype=np.int64)
    return b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, dtype=np.int64, count=len(types), offset=8)
    at, out = 8 * (len(types) + 1), []
    for t, n in zip(types, sizes.tolist()):
        out.append(np.frombuffer(blob, dtype=t, count=n // np.dtype(t).itemsize, offset=at))
        at += n
    return out


def _narrow(h: np.ndarray) -> np.ndarray:
    """The six high bytes of each hash, as bytes."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).reshape(-1)


def _widen(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), dtype=np.uint8)
    out[:, 2:] = b.reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _runs(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(keys, counts)


def cut_texts(batches: Iterator[pd.DataFrame], words: int, buckets: int, homes: int, flush: int = 500_000) -> Iterator[pd.DataFrame]:
    """Packed shingles by bucket, and packed set sizes by home, of texts not seen before in this task."""
    seen: set[int] = set()
    keys, sizes, sets, held = [], [], [], 0

    def out() -> pd.DataFrame:
        k, n, h = np.array(keys, dtype=np.int64), np.array(sizes, dtype=np.int64), np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(k)), n)
        rows = []
        where = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        there, first = np.unique(where[order], return_index=True)  # buckets with shingles only
        for b, mine in zip(there.tolist(), np.split(order, first[1:])):
            who, many = np.unique(owner[mine], return_counts=True)
            rows.append((b, _pack(k[who], many.astype(np.uint32), _narrow(h[mine]))))
        home = k % homes
        for b in np.unique(home):
            rows.append((-1 - int(b), _pack(k[home == b], n[home == b])))
        return pd.DataFrame({"bucket": pd.Series([r[0] for r in rows], dtype="int64"), "blob": pd.Series([r[1] for r in rows], dtype=object)})

    for batch in batches:
        fresh = ~batch["k"].isin(seen) & ~batch["k"].duplicated()
        k, texts = batch["k"][fresh].tolist(), batch["text"][fresh].tolist()
        seen.update(k)
        at = 0
        while at < len(k):  # texts of about 1 MB together
            to, size = at, 0
            while to < len(k) and (to == at or size + len(texts[to]) < 1_000_000):
                size += len(texts[to])
                to += 1
            h, ends = shingle_sets(texts[at:to], words)
            keys += k[at:to]
            sizes += np.diff(ends).tolist()
            sets.append(h)
            held += len(h)
            at = to
            if held >= flush:
                yield out()
                keys, sizes, sets, held = [], [], [], 0
    if keys:
        yield out()


def count_bucket(key: tuple, pdf: pd.DataFrame, homes: int) -> pd.DataFrame:
    """Shingles of a bucket that several texts have, packed by the texts' home: home, what, blob."""
    if key[0] < 0:
        return pd.DataFrame({"home": -1 - key[0], "what": 0, "blob": pdf["blob"]})
    parts = [_unpack(b, "<i8", "<u4", "u1") for b in pdf["blob"]]
    k = np.concatenate([_runs(p[0], p[1]) for p in parts])
    h = np.concatenate([_widen(p[2]) for p in parts])
    del parts
    give_back()
    order = np.lexsort((k, h))
    k, h = k[order], h[order]
    keep = np.ones(len(h), dtype=bool)  # a text may come from several tasks
    keep[1:] = (h[1:] != h[:-1]) | (k[1:] != k[:-1])
    k, h = k[keep], h[keep]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    many = np.diff(np.append(first, len(h)))
    df = np.repeat(many, many)
    k, h, df = k[df > 1], h[df > 1], df[df > 1]
    del order, keep, first, many
    give_back()
    home = k % homes
    order = np.lexsort((k, home))
    k, h, df, home = k[order], h[order], df[order], home[order]
    there, first = np.unique(home, return_index=True)
    rows = []
    for b, lo, hi in zip(there.tolist(), first.tolist(), [*first[1:].tolist(), len(home)]):
        s = slice(lo, hi)
        who, n = np.unique(k[s], return_counts=True)
        rows.append((b, _pack(who, n.astype(np.uint32), _narrow(h[s]), df[s].astype(np.uint32))))
    return pd.DataFrame({"home": pd.Series([r[0] for r in rows], dtype="int64"), "what": pd.Series([1] * len(rows), dtype="int64"), "blob": pd.Series([r[1] for r in rows], dtype=object)})


def gather_home(pdf: pd.DataFrame, pct: int) -> pd.DataFrame:
    """Each text's size; for texts that may have a partner their prefix, its positions and all shared shingles."""
    sizes = [_unpack(b, "<i8", "<i8") for b, w in zip(pdf["blob"], pdf["what"]) if w == 0]
    key, at = np.unique(np.concatenate([s[0] for s in sizes]) if sizes else np.zeros(0, dtype=np.int64), return_index=True)
    size = np.concatenate([s[1] for s in sizes])[at] if sizes else np.zeros(0, dtype=np.int64)
    parts = [_unpack(b, "<i8", "<u4", "u1", "<u4") for b, w in zip(pdf["blob"], pdf["what"]) if w == 1]
    prefix, shared, unique = [None] * len(key), [None] * len(key), np.zeros(len(key), dtype=np.int64)
    if parts:
        k = np.concatenate([_runs(p[0], p[1]) for p in parts])
        h, df = np.concatenate([_widen(p[2]) for p in parts]), np.concatenate([p[3] for p in parts])
        order = np.lexsort((h, df, k))
        k, h = k[order], h[order]
        del parts, df, order
        give_back()
        lo, hi = np.searchsorted(k, key), np.searchsorted(k, key, side="right")
        unique = size - (hi - lo)
        length = size - (pct * size + 99) // 100 + 1
        for i in np.flatnonzero((unique < length) & (hi > lo)):
            prefix[i] = h[lo[i] : min(hi[i], lo[i] + length[i] - unique[i])].astype(np.int64).tolist()
            shared[i] = np.sort(h[lo[i] : hi[i]]).tobytes()
    return pd.DataFrame({"k": key, "size": size, "unique": unique, "prefix": pd.Series(prefix, dtype=object), "shared": pd.Series(shared, dtype=object)})


def verify(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of pct percent or more."""

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = []
            for x, y, n, m in zip(p["sa"], p["sb"], p["na"], p["nb"]):
                both = np.intersect1d(np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8"), assume_unique=True).size
                ok.append(100 * both >= pct * (n + m - both))
            yield p.loc[np.array(ok, dtype=bool), ["a", "b"]]

    side = lambda x: sets.select(F.col("k").alias(x), F.col("shared").alias(f"s{x}"), F.col("size").alias(f"n{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb", "na", "nb").mapInPandas(tidy(go), "a long, b long")


def join_components(tagged: DataFrame, found: DataFrame) -> DataFrame:
    """tagged (k, component and more) after links (a, b) between its members; only linked components are searched."""
    found = stage(found, "links")
    if found.isEmpty():
        return tagged
    side = lambda x: tagged.select(F.col("k").alias(x), F.col("component").alias(f"c{x}"))
    top = components(found.join(side("a"), "a").join(side("b"), "b").select("ca", "cb"), "ca", "cb")
    top = top.select(F.col("node").alias("component"), F.col("component").alias("top"))
    out = tagged.join(top, "component", "left").withColumn("component", F.coalesce("top", "component"))
    return stage(out.select(*tagged.columns), "tagged")


def text_components(texts: DataFrame, words: int, pct: int, bucket: int = 1_500_000, rounds: int = 2) -> DataFrame:
    """k, size, component (a text's hash) of each distinct text. texts: k, text."""
    spark = texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = homes = int(max(12, total // (6 * bucket)))
    cut = texts.mapInPandas(tidy(lambda b: cut_texts(b, words, buckets, homes)), "bucket long, blob binary")
    # Tasks grow in number with the buckets, not in size.
    back = cut.repartition(2 * buckets, "bucket").groupBy("bucket").applyInPandas(lambda key, p: count_bucket(key, p, homes), "home long, what long, blob binary")
    sets = back.repartition(homes, "home").groupBy("home").applyInPandas(lambda p: gather_home(p, pct), "k long, size long, unique long, prefix array<long>, shared binary")
    sets = stage(sets, "sets")
    alive = stage(sets.where("prefix is not null").select("k", "size", "unique", "prefix", "shared", F.sha2(F.concat_ws(",", F.col("size").cast("string"), F.col("prefix").cast("array<string>")), 256).alias("g")), "alive")
    groups = alive.groupBy("g").agg(F.min("k").alias("lead"), F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("unique").alias("unique"))
    post = stage(groups.select("g", "lead", "size", "unique", F.posexplode("prefix").alias("i", "token")).select("token", "g", "lead", "size", "unique", (F.col("unique") + F.col("i")).alias("pos")), "postings")

    def stars(rows: DataFrame, by: list[str], member: str) -> DataFrame:
        low = rows.groupBy(*by).agg(F.min(F.struct("unique", member))[member].alias("b"))
        return rows.join(low, by).select(F.col(member).alias("a"), "b")

    one = stars(alive, ["g"], "k").unionByName(stars(post, ["token"], "lead")).unionByName(stars(post, ["token", "size"], "lead"))
    one = one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    comp = components(verify(one, alive, pct), "a", "b").withColumnRenamed("node", "k")
    tagged = stage(alive.select("k", "g", "size").join(comp, "k", "left").withColumn("component", F.coalesce("component", "k")), "tagged")

    # Whoever is still apart from a list's other components tries some members, others in each round: one without many
    # shingles of its own, and two that differ from shingle to shingle. This only leaves less to the exact step below.
    for i in range(rounds):
        lead = tagged.groupBy("g", "component").agg(F.min_by("k", F.xxhash64(F.lit(i), "k")).alias("a"))
        at = post.select("token", "g", "size", "unique").join(lead, "g")
        one_of = lambda *first: F.min(F.struct(*first, F.col("a").alias("b"), F.col("component").alias("c"), F.col("size").alias("n")))
        salted = [F.xxhash64(F.lit(3 * i + j), "token", "a") for j in range(3)]
        pick = [one_of(F.col("unique").alias("o"), salted[0].alias("h")), *(one_of(F.lit(0).cast("long").alias("o"), x.alias("h")) for x in salted[1:])]
        pick = at.groupBy("token").agg(F.array(*pick).alias("x"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        tries = at.join(pick.where("c0 <> c1").select("token", F.explode("x").alias("x")), "token").where(F.col("component") != F.col("x.c"))
        tries = tries.where(f"100 * least(size, x.n) >= {pct} * greatest(size, x.n)")
        tries = tries.select(F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b")).distinct()
        tagged = join_components(tagged, verify(tries, alive, pct))

    mixed = tagged.groupBy("g").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    open_ = post.join(mixed, "g")
    several = open_.groupBy("token").agg(F.min("c0").alias("t0"), F.max("c1").alias("t1")).where("t0 <> t1").select("token")
    left = stage(open_.join(several, "token").select("token", "g", "size", "pos", "c0", "c1"), "open")
    x, y = left.alias("x"), left.alias("y")
    need = F.expr(f"({pct} * (x.size + y.size) + {99 + pct}) div {100 + pct}")
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.g") < F.col("y.g")) & F.expr(f"100 * least(x.size, y.size) >= {pct} * greatest(x.size, y.size)")
    meet &= 1 + F.expr("least(x.size - x.pos, y.size - y.pos) - 1") >= need
    meet &= ~F.expr("x.c0 = x.c1 and y.c0 = y.c1 and x.c0 = y.c0")
    pairs = x.join(y, meet).select(F.col("x.g").alias("g"), F.col("y.g").alias("h")).distinct()
    m = tagged.select("g", F.col("k").alias("a"), F.col("component").alias("ca"))
    o = tagged.select(F.col("g").alias("h"), F.col("k").alias("b"), F.col("component").alias("cb"))
    across = pairs.join(m, "g").join(o, "h").where("ca <> cb").select("a", "b")
    split = tagged.join(mixed.where("c0 <> c1").select("g"), "g").select("g", "k", "component")
    within = split.select("g", F.col("k").alias("a"), F.col("component").alias("ca")).join(split.select("g", F.col("k").alias("b"), F.col("component").alias("cb")), "g").where("a < b and ca <> cb").select("a", "b")
    tagged = join_components(tagged, verify(across.unionByName(within), alive, pct))
    comp = tagged.select("k", "component")
    return sets.select("k", "size").join(comp, "k", "left").select("k", "size", F.coalesce("component", "k").alias("component"))


def near_texts(docs: DataFrame, words: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text", bucket: int = 1_500_000) -> DataFrame:
    """doc_id, k (hash of the text), n_shingles, component_id, component (its least text; null without shingles) of every row."""
    text: Column = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("k"))
    per = text_components(docs.select(F.xxhash64(text).alias("k"), text.alias("text")), words, pct, bucket)
    rows = stage(rows, "rows")
    named = stage(rows.groupBy("k").agg(F.min("doc_id").alias("least")).join(per, "k"), "texts")
    lead = named.where("size > 0").groupBy("component").agg(F.min("least").alias("component_id"))
    per = named.select("k", "size", F.when(F.col("size") > 0, F.col("component")).alias("component")).join(lead, "component", "left").select("k", "size", "component_id", "component")
    out = rows.join(per, "k")
    return out.select("doc_id", "k", F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "component")


def one_of_each(docs: DataFrame, words: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component, that of the smallest id; rows without shingles all stay.

    Components are told apart by their texts, so those that share a least id or have none keep a row each. Of rows that
    repeat the id and the text of the one that stays, one stays. Rows of a component without any id are ordered by their
    hash. Texts travel once, to be joined with the names of what stays.
    """
    found = near_texts(docs, words, pct, id_col, text_col).where("n_shingles > 0")
    i, k, n = free_names(docs.columns, "id", "k", "n")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "k"))
    stay = found.groupBy("component").agg(least.alias("x")).select(F.col("x.id").alias(i), F.col("x.k").alias(n))
    text = F.coalesce(F.col(text_col), F.lit(""))
    full = text.rlike(r"[^\x20\x09-\x0D]")
    d = docs.withColumn(k, F.xxhash64(text))
    kept = d.where(full).join(stay, d[id_col].eqNullSafe(stay[i]) & (d[k] == stay[n]), "left_semi").dropDuplicates([id_col, k])
    return kept.unionByName(d.where(~full)).drop(k)


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_texts(docs, words=4, pct=85).select("doc_id", "n_shingles", "component_id")


OP9_SQL = """
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else
      list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) end as s from w),
n as (select doc_id, len(s) as n from s),
x as (select doc_id, unnest(s) as t from s),
met as (select a.doc_id as a, b.doc_id as b, count(*) as k from x a join x b on a.t = b.t and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from met join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 85 * (na.n + nb.n - k)),
reach as (select doc_id as a, doc_id as b from n union select r.a, l.b from reach r join links l on r.b = l.a)
select doc_id, n::bigint as n_shingles, c.component_id from n join (select a, min(b) as component_id from reach group by a) c on c.a = n.doc_id
"""

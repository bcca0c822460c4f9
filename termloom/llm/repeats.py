"""Suffix-array removal of repeated byte strings, built blockwise with a difference cover.

A string of `length` bytes repeats if it starts in two places, of one text or of several. Suffixes need to be ordered by
that many bytes only, and a bucket at a time:

1. A suffix's bucket is its anchor, the 32-byte gram of least hash among its first `length` bytes. Neighbouring suffixes
   share an anchor, so one record, a run of suffixes, stands for some 85 of them; equal strings have equal anchors. A run
   whose anchor occurs once is done, and a run that occurs twice as a whole repeats as a whole, which needs no bytes.
2. Of the other anchors every distinct run is sent to its bucket once, with whether it occurs once or more often.
3. A bucket sorts its suffixes block after block: by their residue and first 32 bytes, ties by the precomputed rank of the cover
   sample that follows, and by the last bytes. Runs are laid so that anchors fall on the period of the cover; suffixes
   that can be equal then have the same residue, and the same shift leads both to a sample. Samples are ranked by 168
   bytes, so the three keys cover the string whatever the shift. Strings met twice are marked in the runs that occur once.
4. An anchor with more than `dense` distinct runs is no bucket. Its runs are cut into bands of `BAND` offsets from the
   anchor; the bytes that all strings of a band share are its bucket, and steps 1 to 3 hold for bands as for runs. A band
   that is dense again is cut into its strings, which are counted by 128 bits.
5. The marks go back to the texts, whose covered bytes are removed.

Texts and runs are known by 128 bits of their content. The rows of a run, a text or an anchor that holds more than one
ten-thousandth of all rows are dealt to several parts for a join, so no hot key makes a large task.
Defined results: a null text is empty; a text shorter than `length` keeps all; repeated rows are texts of their own, so
each loses what it shares with the other; ties don't arise, as what occurs twice is marked wherever it is; removed bytes
may cut a character, hence the result is bytes; an empty table gives an empty result; extra columns are ignored. A task
holds a block of runs of `block` bytes and its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.shingles import mix64
from termloom.operators.lineage import stage
from termloom.operators.skew import hot_keys, skew_join

GRAM = 32
#: Period of the cover and of the samples; samples are ranked by `length` less this.
PERIOD = 32
#: Offsets from the anchor that one band of a dense anchor holds.
BAND = 24
TEXT = ["k1", "k2"]


def _words(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a big-endian number; the last 7 positions are padded."""
    padded = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
    out = np.zeros(len(buf), dtype=np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(buf)]
    return out


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hashes of the 32-byte grams from each position; len(buf) - 31 of them."""
    n = len(buf) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    w = _words(buf)
    h = w[:n] * np.uint64(0x9E3779B97F4A7C15)
    for j, m in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0xD6E8FEB86659FD93)):
        h = mix64(h ^ (w[j : j + n] * np.uint64(m)))
    return h


def runs_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one anchor: text, first and last start in it, anchor position in it, anchor hash."""
    none = np.zeros(0, dtype=np.int64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    wide = length - GRAM + 1
    n = len(buf) - length + 1
    if n <= 0:
        return none, none, none, none, np.zeros(0, dtype=np.uint64)
    h = gram_hashes(buf)
    at = np.empty(n, dtype=np.int64)
    bits, low = np.uint64(24), np.uint64((1 << 24) - 1)
    for lo in range(0, n, 1 << 23):  # the same bits of a hash decide whatever the length; ties go to the leftmost
        g = h[lo : lo + (1 << 23) + wide - 1]
        key = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)
        blocks = np.concatenate([key, np.full(-len(key) % wide, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, wide)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        m = min(1 << 23, n - lo)
        at[lo : lo + m] = (np.minimum(behind[:m], ahead[wide - 1 : wide - 1 + m]) & low).astype(np.int64) + lo
    owner = np.repeat(np.arange(len(texts)), sizes)[:n]
    ok = np.arange(n) + length <= first[owner + 1]
    p, at, owner = np.flatnonzero(ok), at[ok], owner[ok]
    if not len(p):
        return none, none, none, none, np.zeros(0, dtype=np.uint64)
    new = np.ones(len(p), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(p)) - 1
    t = owner[lo]
    return t, p[lo] - first[t], p[hi] - first[t], at[lo] - first[t], h[at[lo]]


def _dense(x: np.ndarray) -> np.ndarray:
    """Dense ranks of whole numbers, in their order; one sort of plain numbers is much faster than one by columns."""
    order = np.argsort(x)
    s = x[order]
    rank = np.empty(len(x), dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]])) if len(x) else 0
    return rank


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks below 2**31, in the order of the pairs."""
    return _dense((a << 32) | b)


def repeated_starts(runs: list[bytes], lead: np.ndarray, count: np.ndarray, length: int) -> list[np.ndarray]:
    """For distinct runs, whose anchors begin at lead, which of their suffixes occur twice or more in all."""
    sizes = np.array([len(r) for r in runs], dtype=np.int64)
    # Lay the runs so that every anchor is at a multiple of the period.
    base, end = np.zeros(len(runs), dtype=np.int64), 0
    for i, (n, a) in enumerate(zip(sizes.tolist(), lead.tolist())):
        base[i] = end + (-(end + a)) % PERIOD
        end = base[i] + n
    buf = np.zeros(end + length + PERIOD, dtype=np.uint8)
    for b, r in zip(base.tolist(), runs):
        buf[b : b + len(r)] = np.frombuffer(r, dtype=np.uint8)
    w = _words(buf)
    many = sizes - length + 1
    owner = np.repeat(np.arange(len(runs)), many)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + base[owner]
    span = length - PERIOD
    # Ranks of the 8, 16 and 32 bytes from every position.
    r8 = _dense(w)
    r16 = _pairs(r8[:-8], r8[8:])
    v = _pairs(r16[:-16], r16[16:])
    shift = (-start) % PERIOD
    pieces = [*range(0, span - PERIOD + 1, PERIOD)] + ([span - PERIOD] if span % PERIOD else [])
    sample = np.unique(start + shift)
    cover = v[sample + pieces[0]]
    for q in pieces[1:]:
        cover = _pairs(cover, v[sample + q])
    same = _pairs(_pairs(shift, v[start]), _pairs(cover[np.searchsorted(sample, start + shift)], v[start + span]))
    total = np.bincount(same, count[owner])
    hit = total[same] >= 2
    return np.split(hit, np.cumsum(many)[:-1])


def _ranges(mask: np.ndarray) -> list[int]:
    """Starts and ends, exclusive, of the true runs, alternating."""
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()


def _batches(pdf: pd.DataFrame, limit: int = 1_000_000) -> Iterator[tuple[list[bytes], pd.DataFrame]]:
    size, at = 0, 0
    raw = [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
    for i, r in enumerate(raw):
        if size and size + len(r) > limit:
            yield raw[at:i], pdf.iloc[at:i]
            size, at = 0, i
        size += len(r)
    if at < len(raw):
        yield raw[at:], pdf.iloc[at:]


def text_key(text: Column) -> list[Column]:
    """Two hashes of 64 bits each."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def runs_table(texts: DataFrame, length: int) -> DataFrame:
    """Runs of the texts (k1, k2, text): k1, k2, lo, hi, at, h (anchor), c1, c2 (content), n (copies in its batch)."""

    def go(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_digest
        for pdf in it:
            times = pdf.groupby(TEXT)["k1"].transform("size")
            pdf = pdf.assign(n=times)[~pdf.duplicated(TEXT)]
            for raw, part in _batches(pdf):
                t, lo, hi, at, h = runs_of(raw, length)
                c = b"".join([digest(raw[i][a:b]) for i, a, b in zip(t.tolist(), lo.tolist(), (hi + length).tolist())])
                c = np.frombuffer(c, dtype="<i8").reshape(-1, 2)
                yield pd.DataFrame({"k1": part["k1"].to_numpy()[t], "k2": part["k2"].to_numpy()[t], "lo": lo, "hi": hi, "at": at, "h": h.view(np.int64), "c1": c[:, 0], "c2": c[:, 1], "n": part["n"].to_numpy()[t]})

    return texts.select(*TEXT, "text").mapInPandas(go, "k1 long, k2 long, lo int, hi int, at int, h long, c1 long, c2 long, n int")


def settle(rows: DataFrame) -> DataFrame:
    """rows (k1, k2, lo, hi, at, h, c1, c2, n) with whole (the content occurs twice), sends (one row of each content) and
    d, the distinct contents of the row's bucket h."""
    unit = F.xxhash64("k1", "k2", "lo")
    one = stage(rows.groupBy("h", "c1", "c2").agg(F.sum("n").alias("times"), F.min(unit).alias("unit"), F.count("*").alias("n")), "contents")
    per = one.groupBy("h").agg(F.count("*").alias("d"))
    one_d = skew_join(one.drop("n"), per, ["h"], hot_keys(per, ["h"], "d"), ["c1"])
    got = skew_join(rows.drop("n"), one_d, ["h", "c1", "c2"], hot_keys(one, ["h", "c1", "c2"]), [*TEXT, "lo"])
    return got.withColumn("whole", F.col("times") >= 2).withColumn("sends", unit == F.col("unit")).drop("times", "unit")


def mark(runs: DataFrame, length: int, block: int, parts: int) -> DataFrame:
    """k1, k2, marks: repeated starts (ranges, absolute) of the wanted runs (h, k1, k2, lo, at, whole, want, run)."""

    def go(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates([*TEXT, "lo"]).sort_values(["h", *TEXT, "lo"], ignore_index=True)
        found, marks = [], []
        size, h = pdf["run"].map(len).to_numpy(), pdf["h"].to_numpy()
        at = 0
        while at < len(pdf):  # whole buckets, about `block` bytes together
            to, held = at, 0
            while to < len(pdf) and (to == at or held < block or h[to] == h[to - 1]):
                held += size[to]
                to += 1
            part = pdf.iloc[at:to]
            lo = part["lo"].to_numpy(dtype=np.int64)
            hits = repeated_starts(part["run"].tolist(), part["at"].to_numpy(dtype=np.int64) - lo, np.where(part["whole"], 2, 1), length)
            for i, (hit, want) in enumerate(zip(hits, part["want"])):
                if want and hit.any():
                    found.append(at + i)
                    marks.append([int(lo[i]) + x for x in _ranges(hit)])
            at = to
        return pd.DataFrame({"k1": pdf["k1"].to_numpy()[found], "k2": pdf["k2"].to_numpy()[found], "marks": pd.Series(marks, dtype=object)})

    dealt = runs.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts))).repartition(parts, "part")
    return dealt.groupBy("part").applyInPandas(go, "k1 long, k2 long, marks array<int>")


def bands(runs: DataFrame, length: int, width: int) -> DataFrame:
    """The bands of runs (with their bytes) as rows like those of the runs: the bucket is the bytes that a band shares."""
    b = runs.withColumn("band", F.explode(F.expr(f"sequence((at - hi) div {width}, (at - lo) div {width})")))
    b = b.withColumn("core", (F.col("at") - width * F.col("band")).cast("int"))
    b = b.select(*TEXT, "at", "h", "want", "whole", "band", "core", F.col("lo").alias("from"), F.greatest(F.col("lo"), F.col("core") - (width - 1)).alias("lo"), F.least("hi", "core").alias("hi"), "run")
    b = b.withColumn("h", F.xxhash64("h", "band", F.expr(f"substring(run, core - from + 1, {length - width + 1})")))
    b = b.withColumn("run", F.expr(f"substring(run, lo - from + 1, hi - lo + {length})"))
    lead = F.col("at") - F.col("lo")
    return b.select(*TEXT, "lo", "hi", "at", "h", F.xxhash64(lead, "run").alias("c1"), F.xxhash64(F.lit(1), lead, "run").alias("c2"), F.when(F.col("whole"), 2).otherwise(1).alias("n"), "want", "run")


def covered(texts: DataFrame, length: int, hot: DataFrame | None, copied: DataFrame, dense: int = 20_000, block: int = 1_000_000) -> DataFrame:
    """k1, k2, spans: removed byte ranges (starts and ends alternating, sorted, apart) of texts with any.

    texts: k1, k2, text, row (a hash that copies differ in). copied: the keys of texts that occur several times; hot: the
    hot ones.
    """
    units = stage(runs_table(texts, length), "runs")
    per = units.groupBy("h").agg(F.sum("n").alias("n"), F.min("c1").alias("c0"), F.max("c1").alias("c9"), F.count("*").alias("rows"))
    per = stage(per.where("n > 1").select("h", "rows", (F.col("c0") != F.col("c9")).alias("mixed")), "anchors")
    shared = stage(skew_join(units, per.select("h", "mixed"), ["h"], hot_keys(per, ["h"], "rows"), [*TEXT, "lo"]), "shared")
    got = stage(settle(shared.where("mixed").drop("mixed")), "settled")
    all_of = lambda df: df.select(*TEXT, F.array("lo", F.col("hi") + 1).alias("marks")).distinct()
    marks = all_of(shared.where("not mixed").select(*TEXT, "lo", "hi")).unionByName(all_of(got.where("whole")))

    sending = got.where("sends").select(*TEXT, F.struct("lo", "hi", "at", "h", "whole", (~F.col("whole")).alias("want"), (F.col("d") > dense).alias("split")).alias("u")).distinct()
    size = F.sum(F.expr(f"u.hi - u.lo + {length}"))
    held = sending.agg(size.alias("all"), F.count_if("u.split").alias("split")).first()
    if held["all"]:
        parts = lambda n: int(max(24, (n or 0) // 4_000_000))
        per_text = sending.groupBy(*TEXT).agg(F.collect_list("u").alias("us"))
        raw = texts.select(*TEXT, "row", F.col("text").cast("binary").alias("raw"))
        # Texts that occur once go straight, of the others one copy.
        met = raw.join(per_text.join(copied, TEXT, "left_anti"), TEXT)
        met = met.drop("row").unionByName(skew_join(raw, per_text.join(copied, TEXT, "left_semi"), TEXT, hot, ["row"]).dropDuplicates(TEXT).drop("row"))
        cut = F.transform("us", lambda u: F.struct(*[u[x].alias(x) for x in ("lo", "hi", "at", "h", "whole", "want", "split")], F.substring(F.col("raw"), u["lo"] + 1, u["hi"] - u["lo"] + length).alias("run")))
        sent = met.select(*TEXT, F.explode(cut).alias("u")).select(*TEXT, "u.*")
        if held["split"]:
            sent = stage(sent, "sent")
        marks = marks.unionByName(mark(sent.where("not split"), length, block, parts(held["all"])))
        if held["split"]:
            band = stage(bands(sent.where("split"), length, BAND), "bands")
            got = stage(settle(band), "settled")
            marks = marks.unionByName(all_of(got.where("whole and want")))
            sending = got.where("sends").withColumn("want", ~F.col("whole") & F.col("want"))
            size = sending.where(F.col("d") <= dense).agg(F.sum(F.octet_length("run"))).first()[0]
            marks = marks.unionByName(mark(sending.where(F.col("d") <= dense), length, block, parts(size)))
            single = sending.where(F.col("d") > dense).withColumn("p", F.explode(F.sequence("lo", "hi")))
            string = F.expr(f"substring(run, p - lo + 1, {length})")
            single = stage(single.select(*TEXT, "p", F.xxhash64(string).alias("c1"), F.xxhash64(F.lit(1), string).alias("c2"), F.when(F.col("whole"), 2).otherwise(1).alias("w"), "want"), "strings")
            twice = single.groupBy("c1", "c2").agg(F.sum("w").alias("w"), F.count("*").alias("n")).where("w > 1")
            twice = stage(twice, "twice")
            hits = skew_join(single.where("want"), twice.select("c1", "c2"), ["c1", "c2"], hot_keys(twice, ["c1", "c2"]), [*TEXT, "p"])
            marks = marks.unionByName(all_of(hits.select(*TEXT, F.col("p").alias("lo"), F.col("p").alias("hi"))))

    def spans(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for m in pdf["marks"]:
                x = np.asarray(m, dtype=np.int64).reshape(-1, 2)
                x = x[np.argsort(x[:, 0], kind="stable")]
                # A start s covers up to s + length; the marks end after the last start.
                end = np.maximum.accumulate(x[:, 1] - 1 + length)
                new = np.flatnonzero(np.concatenate([[True], x[1:, 0] > end[:-1]]))
                out.append(np.stack([x[new, 0], end[np.append(new[1:], len(x)) - 1]], axis=1).reshape(-1).tolist())
            yield pdf[TEXT].assign(spans=pd.Series(out, dtype=object, index=pdf.index))

    per_text = marks.groupBy(*TEXT).agg(F.flatten(F.collect_list("marks")).alias("marks"))
    return per_text.mapInPandas(spans, "k1 long, k2 long, spans array<long>")


def remove_repeats(docs: DataFrame, length: int = 200, dense: int = 20_000, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, and kept (the remaining bytes) if wanted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *text_key(text), F.xxhash64(id_col).alias("row"))
    long = docs.where(F.octet_length("text") >= length).select(*TEXT, "text", "row")
    copied = stage(long.groupBy(*TEXT).agg(F.count("*").alias("n")).where("n > 1"), "copied")
    hot = hot_keys(copied, TEXT)
    spans = stage(covered(long, length, hot, copied.select(*TEXT), dense), "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for t, s in zip(pdf["text"], pdf["spans"]):
                raw = t.encode("utf-8", "surrogatepass")
                s = [] if s is None else [int(x) for x in s]
                edges = [0, *s, len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(raw), len(raw) - len(kept), len(s) // 2, hashlib.sha256(kept).hexdigest(), s, kept))
            out = pd.DataFrame({"doc_id": pdf["doc_id"].array})
            for j, name in enumerate(("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")):
                if name != "kept" or keep_bytes:
                    out[name] = pd.Series([r[j] for r in rows], dtype="int64" if j < 3 else object)
            yield out

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>{', kept binary' * keep_bytes}"
    return skew_join(docs, spans, TEXT, hot, ["row"], "left").select("doc_id", "text", "spans").mapInPandas(cut, schema)


def op5_suffix_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


#: Bytes are pairs of hexadecimal digits here; a start is known by the MD5 of its 200 bytes.
OP5_SQL = """
with d as (select doc_id, row_number() over () as r, hex(encode(coalesce(text, ''))) as h from documents),
block as (select r, p0, substr(h, 2 * p0 + 1, 4398) as h from (select r, h, unnest(range(0, length(h) // 2 - 199, 2000)) as p0 from d)),
s as (select r, p0 + q as p, md5(substr(h, 2 * q + 1, 400)) as m from (select r, p0, h, unnest(range(0, length(h) // 2 - 199)) as q from block)),
hit as (select r, p from s join (select m from s group by m having count(*) > 1) using (m)),
edge as (select r, p, p - coalesce(lag(p) over (partition by r order by p), -1000) > 200 as fresh from hit),
run as (select r, p, sum(fresh::int) over (partition by r order by p rows unbounded preceding) as i from edge),
span as (select r, i, min(p) as a, max(p) + 200 as b from run group by r, i),
per as (select r, count(*) as n_spans, sum(b - a) as n_removed, list(a order by a) as a, list(b order by a) as b from span group by r),
kept as (select doc_id, h, n_spans, n_removed, case when per.r is null then h else
         list_aggregate(list_transform(range(0, len(a) + 1), lambda j: substr(h, 2 * (case when j = 0 then 0 else b[j] end) + 1,
         2 * ((case when j = len(a) then length(h) // 2 else a[j + 1] end) - (case when j = 0 then 0 else b[j] end)))), 'string_agg', '') end as k
         from d left join per on per.r = d.r)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(k, ''))) as kept_sha256 from kept
"""

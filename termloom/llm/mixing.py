"""Mixing sources to target weights by a low-discrepancy schedule over equal-token blocks.

Every source lays its documents, in a seeded shuffled order, on a line of words and cuts the line into blocks of equal
word count. The schedule takes the 2**m points of the base-2 van der Corput sequence, maps each through the cumulative
slot weights of the sources, ranks the slots of each source, and slot r of a source takes its block r modulo its number
of blocks. A source above its own size is so repeated block by block; the last slot is cut to the word. A document is
taken at the slots of the block that holds its first word, and the mix is written in the order of slots.

Defined results: a null or blank text has size 0 and is never taken; a null source is a source of its own, last in
order; repeated rows are documents of their own; rows that tie in the shuffle are ordered by id and size, and rows equal
in all of these are interchangeable; a very long text spans many blocks, and its row is in one task only when it is
taken; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.names import free_names
from termloom.operators.lineage import stage

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def share_targets(sizes: list[int], weights: list[float], cap: float = 3.0) -> list[float]:
    """Targets in words: all sizes shared by weight; none above cap times its size, the excess shared again."""
    target, free, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = cap * float(sizes[i])
            left -= target[i]
        free = [i for i in free if i not in set(over)]
    return target


def place(docs: DataFrame, buckets: int = 4096) -> DataFrame:
    """Start of each row on its source's shuffled line of words: src, doc_id, size, key, start.

    docs: src, doc_id, size, key, n (equal rows). Prefix sums go by buckets of the shuffled order, so that no source is
    one task, and equal rows share one place in them.
    """
    d = docs.withColumn("bucket", F.shiftrightunsigned("key", 64 - (buckets - 1).bit_length()))
    d = d.withColumn("all", F.col("n") * F.col("size"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = d.groupBy("src", "bucket").agg(F.sum("all").alias("words")).select("src", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    at = d.withColumn("upto", F.sum("all").over(within)).join(base, ["src", "bucket"])
    return at.select("src", "doc_id", "size", "key", F.expr("base + upto - all").alias("first"), F.explode(F.expr("sequence(0L, n - 1)")).alias("i")).select("src", "doc_id", "size", "key", F.expr("first + i * size").alias("start"))


def schedule(spark, plan: list[dict], block: int) -> DataFrame:
    """The slots: src, slot, rank, block, epoch, words. plan: src, size and take (words) of each source."""
    first, rows = 0, []
    for p in plan:
        if p["take"] > 0:
            blocks, (epochs, rest) = -(-p["size"] // block), divmod(p["take"], p["size"])
            n = epochs * blocks + -(-rest // block)
            rows.append((p["src"], p["size"], p["take"], blocks, first, n))
            first += n
    bits = max(1, (first - 1).bit_length())
    sources = spark.createDataFrame(rows, "src string, src_size long, take long, blocks long, first long, n long")
    points = sources.select("*", F.explode(F.expr("sequence(first, first + n - 1)")).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    rank = F.row_number().over(Window.partitionBy("src").orderBy("slot")) - 1
    s = points.withColumn("slot", slot).withColumn("rank", rank.cast("long")).withColumns({"block": F.expr("rank % blocks"), "epoch": F.expr("rank div blocks")})
    full = F.least(F.lit(block), F.col("src_size") - F.col("block") * block)
    return s.select("src", "slot", "rank", "block", "epoch", full.alias("full"), F.least(full, F.col("take") - F.col("epoch") * F.col("src_size") - F.col("block") * block).alias("words"))


def document_key(id_: Column, text: Column, seed: int) -> Column:
    """The place of a document in the seeded shuffle."""
    return F.xxhash64(F.lit(seed), id_, text)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = (5, 2, 1), cap: float = 3.0, max_slots: int = 1 << 18, min_block: int = 64, max_block: int = 1_000_000, seed: int = 0, max_sources: int = 100_000) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies, slot, slots, key.

    weights repeat over the sources in code-point order, null last. slots are the places in the schedule of the block
    that holds the document's first word, in order: a mix of whole documents takes the document there, `copies` times,
    first at `slot`. The table of sources is collected, and more than max_sources of them raise an error. Blocks have
    min_block words or more; they grow with the corpus up to max_block, from where on the schedule grows beyond max_slots.
    """
    spark = docs.sparkSession
    src = F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    text = F.col(text_col)
    d = docs.select(src.alias("src"), F.col(id_col).alias("doc_id"), word_count(text).alias("size"), document_key(F.col(id_col), text, seed).alias("key"))
    d = stage(d.groupBy("src", "doc_id", "size", "key").agg(F.count("*").alias("n")), "mix")
    got = d.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("size"), F.count("*").alias("rows")).limit(max_sources + 1).collect()
    if len(got) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    names = sorted(((r.src, r["size"]) for r in got), key=lambda r: r[0].encode("utf-8", "surrogatepass"))
    targets = share_targets([s for _, s in names], [weights[i % len(weights)] for i in range(len(names))], cap)
    plan = [{"src": n, "size": s, "target": t, "take": min(round(t), int(cap * s))} for (n, s), t in zip(names, targets)]
    block = min(max(min_block, -(-sum(p["take"] for p in plan) // max_slots)), max_block)
    slots = schedule(spark, plan, block)
    cut = F.col("words") < F.col("full")
    takes = slots.groupBy("src", "block").agg(F.count_if(~cut).alias("whole"), F.coalesce(F.max(F.when(cut, F.col("words"))), F.lit(0)).alias("part"), F.array_sort(F.collect_list("slot")).alias("slots"))
    at = place(d.where("size > 0"), max(4096, 1 << (sum(r["rows"] for r in got) // 4096).bit_length()))
    pieces = at.select("*", F.posexplode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("nth", "block")).join(takes, ["src", "block"], "left")
    low, high = F.greatest("start", F.col("block") * block), F.least(F.expr("start + size"), (F.col("block") + 1) * block)
    words = F.coalesce(F.col("whole") * (high - low) + F.greatest(F.lit(0), F.least(high, F.col("block") * block + F.col("part")) - low), F.lit(0))
    none = F.array().cast("array<long>")
    taken = pieces.groupBy("src", "doc_id", "size", "key", "start").agg(F.sum(words).alias("taken"), F.first(F.when(F.col("nth") == 0, F.coalesce("slots", none)), ignorenulls=True).alias("slots"))
    blank = d.where("size = 0").select("src", "doc_id", "size", "key", F.lit(0).cast("long").alias("taken"), none.alias("slots"), F.explode(F.expr("sequence(1L, n)"))).drop("col")
    per = spark.createDataFrame([(p["src"], p["size"], float(p["target"])) for p in plan], "src string, source_size long, target double")
    out = taken.drop("start").unionByName(blank).join(F.broadcast(per), "src")
    return out.select("doc_id", F.when(F.col("src") != "1", F.expr("substring(src, 2)")).alias("source"), "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), F.size("slots").cast("long").alias("copies"), F.get("slots", F.lit(0)).alias("slot"), "slots", "key")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, window: int = 1_000_000, **options) -> DataFrame:
    """The mix itself: docs with each row at the slots that the schedule gives it, blank texts left out.

    Rows come in the order of the schedule: every window of about `window` words of it is in one partition, sorted by
    slot, so that each has the mix of the whole. Rows equal in id, text and source are one document, of which one row
    is taken as often as all of them are. The columns are those of docs, whatever their names.
    """
    key, src, slot, win, k, s = free_names(docs.columns, "key", "src", "slot", "window", "k", "s")
    got = mix(docs, id_col, text_col, source_col, seed=seed, **options).where("copies > 0")
    got = stage(got.select(F.col("key").alias(key), F.col("source").alias(src), "slots", "size"), "taken")
    held = got.agg(F.sum(F.col("size") * F.size("slots")).alias("words"), F.max(F.array_max("slots")).alias("last")).first()
    windows = max(1, (held["words"] or 0) // window)
    width = max(1, -(-((held["last"] or 0) + 1) // windows))
    several = stage(got.groupBy(key, src).agg(F.count("*").alias("n")).where("n > 1").select(key, src), "several")
    text = F.col(text_col)
    d = docs.where(text.rlike(WORD)).withColumns({key: document_key(F.col(id_col), text, seed), src: F.col(source_col).cast("string")})
    same = lambda t: (d[key] == t[key]) & d[src].eqNullSafe(t[src])
    one = d.join(several, same(several), "left_anti").unionByName(d.join(several, same(several), "left_semi").dropDuplicates([key, src]))
    at = got.select(F.col(key).alias(k), F.col(src).alias(s), F.explode("slots").alias(slot)).withColumn(win, F.expr(f"`{slot}` div {width}"))
    out = one.join(at, (one[key] == at[k]) & one[src].eqNullSafe(at[s]))
    parts = int(max(min(windows, 64), windows // 16))
    return out.repartition(parts, win).sortWithinPartitions(slot, key).select(*docs.columns)


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("slots", "key")

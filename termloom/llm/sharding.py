"""Sharding by global byte-size prefix sums, cut at equal targets into contiguous balanced shards.

Native: DataFrame functions only. The order is that of the MD5 of the text, then of the id, so shards are also a shuffle
and equal texts are neighbours. The leading digits of the text's hash are the partitions: sizes are totalled per
partition, the totals are summed up over partitions, and each text adds the running sum within its partition. The copies
of a text have one size, so a copy's place among them gives its bytes; places are counted by buckets of the id's hash,
so that a text with very many copies is no single task. A row goes to the shard in which its first byte lies.

Groups, the rows of equal text, are contiguous: a group is in one shard, or in neighbouring ones where a cut falls into
it. Defined results: a null text has no bytes and counts 1; an empty table gives an empty result; rows equal in text and
id tie and take consecutive places; a very long text is one row and may fill its shard alone; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, start: `bytes` law, sizes near equal."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    name = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("t"), name.alias("i"))
    rows = rows.withColumn("sub", F.substring("i", 1, 3))  # of a text's copies
    runs = rows.groupBy("t", "sub").agg(F.count("*").alias("n"), F.max("size").alias("size")).withColumn("part", F.substring("t", 1, 3))
    totals = runs.groupBy("part").agg(F.sum(F.col("n") * F.col("size")).alias("bytes"), F.sum("n").alias("rows"))
    # One row per partition of the order, 4,096 of them: the only window without a key.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sofar = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    base = totals.select("part", sofar("bytes", before).alias("byte0"), sofar("rows", before).alias("row0"), F.sum("bytes").over(everything).alias("total"))
    within = Window.partitionBy("part").orderBy("t", "sub").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"byte1": sofar(F.col("n") * F.col("size"), within), "row1": sofar("n", within)}).join(F.broadcast(base), "part")
    runs = runs.select("t", "sub", F.expr("byte0 + byte1").alias("b"), F.expr("row0 + row1").alias("r"), "total")
    nth = F.row_number().over(Window.partitionBy("t", "sub").orderBy("i", "doc_id")) - 1
    at = rows.withColumn("nth", nth).join(runs, ["t", "sub"]).select("doc_id", "size", "text_crc32", F.expr("b + nth * size").alias("start"), F.expr("r + nth").alias("place"), "total")
    # start * shards stays exact as a decimal at any corpus size.
    at = at.withColumn("shard", F.expr(f"cast(floor(cast(start as decimal(28,0)) * {shards} / total) as int)"))
    first = at.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    return at.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "start")


def op2_shard_bytes(spark, sf_dir: str) -> DataFrame:
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: CRC-32 by its polynomial: eight steps for each byte's table entry, one entry for each byte.
OP2_SQL = """
with steps as (select list(c order by b) as t from (select b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i:
       case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c from (select range as b from range(256)))),
raw as (select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size, md5(coalesce(text, '')) as t,
        md5(coalesce(doc_id::varchar, '')) as i, hex(encode(coalesce(text, ''))) as h from documents),
once as (select distinct t as key, h from raw),
crc as (select key, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2),
        lambda j: ('0x' || substr(h, 2 * j + 1, 2))::bigint)), lambda c, b: xor(c // 256, steps.t[xor(c % 256, b) + 1])), 4294967295) as crc
        from once, steps),
line as (select *, sum(size) over (order by t, i, doc_id rows unbounded preceding) - size as start, sum(size) over () as total from raw),
cut as (select *, (start::hugeint * 16 // total::hugeint)::int as shard from line)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'bytes' as law, shard,
       row_number() over (partition by shard order by start) - 1 as slot, null::int as grown_shard, start::bigint as start
from cut join crc on key = t
"""

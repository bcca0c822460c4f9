"""Rows dealt to partitions by the size of their table, and joins with a table that has a row per key, where a key may
hold a large share of the large table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this part of all rows is hot, so there are never more hot keys than MANY.
MANY = 10_000
#: Keys with fewer rows than this are never hot.
LEAST = 2_000
#: Estimated bytes of a dealt partition at most; at least, where there are fewer partitions than three a core.
PART, SMALL = 2 << 20, 128 << 10


def dealt(rows: DataFrame, *keys: str, like: DataFrame | None = None) -> DataFrame:
    """rows dealt by keys to as many partitions as the estimated size of `like` asks for, by default their own.

    A Parquet file has a task a row group, whatever the work a row takes, and a fixed number of shuffle partitions grow
    with the input. What is grouped or ordered within the keys later on needs no other shuffle.
    """
    size = int(str((like or rows)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = max(-(-size // PART), min(3 * rows.sparkSession.sparkContext.defaultParallelism, -(-size // SMALL)), 1)
    return rows.repartition(min(n, MANY), *keys)


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame | None:
    """keys and parts: the hot keys (at most MANY) and in how many parts to deal their rows, 2 * MANY parts at most in
    all; None without any. counts: a row per key, n; it is read three times."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    limit = max(LEAST, total // MANY)
    hot = counts.where(F.col(n) > limit).dropna(subset=keys).select(*keys, F.ceil(F.col(n) / limit).cast("int").alias("parts"))
    return None if hot.isEmpty() else hot


def skew_join(large: DataFrame, unique: DataFrame, keys: list[str], hot: DataFrame | None, by: list[str], how: str = "inner") -> DataFrame:
    """large joined (inner or left) with unique, which has a row per key.

    Rows of a hot key are dealt by a hash of the columns `by` to its parts, and unique has its row in each of them. The
    table of hot keys is broadcast; it has at most MANY rows. Columns of the name `salt` or `parts` must not exist.
    """
    if hot is None:
        return large.join(unique, keys, how)
    parts = F.coalesce("parts", F.lit(1))
    dealt = large.join(F.broadcast(hot), keys, "left").withColumn("salt", F.pmod(F.xxhash64(*by), parts).cast("int")).drop("parts")
    each = unique.join(F.broadcast(hot), keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(each, [*keys, "salt"], how).drop("salt")

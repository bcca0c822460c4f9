"""Exact top-k by inner product with pivot-table elimination.

Each vector's Euclidean distances to the pivots are computed once. For a query q and a candidate x, the largest
|d(q, p) - d(x, p)| over the pivots is a lower bound of d(q, x), so (|q|^2 + |x|^2 - bound^2) / 2 is an upper bound of
the inner product. Candidates are evaluated in the order of that bound until it falls below the k-th best score.

Queries and candidates meet in blocks of bounded size; every block pair yields k rows per query at most, which are ranked
again. Pivots are chosen farthest-first from the `sample` vectors with the smallest hashes; the choice changes the work,
never the result. Defined results: vectors that are null, empty or hold null or non-finite components take no part;
vectors of different lengths are not compared; a row is its query's own only by vec_id, so rows that repeat a query's id
are skipped as its own and a repeated query answers once; repeated candidates each take a rank, ties go to the smaller
id; a query without candidates has no rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.lineage import stage

EXACT = float(1 << 53)


def _table(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1))


def top_in_block(q: pd.DataFrame, c: pd.DataFrame, k: int, batch: int = 256) -> pd.DataFrame:
    """The k best candidates of a block for each query of a block: query_id, vec_id, score."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(q) and len(c):
        qv, cv, qd, cd = _table(q["vec"]), _table(c["vec"]), _table(q["dist"]), np.ascontiguousarray(_table(c["dist"]).T)
        ids = c["vec_id"].to_numpy()
        cn, qn = (cv * cv).sum(axis=1), (qv * qv).sum(axis=1)
        whole = cv.shape[1] * max(np.abs(cv).max(), 1) * max(np.abs(qv).max(), 1) < EXACT
        for i, qid in enumerate(q["vec_id"].to_numpy()):
            low = np.abs(cd - qd[i, :, None]).max(axis=0)
            high = (qn[i] + cn - low * low) / 2
            high += 1 + 1e-9 * (qn[i] + cn)  # rounding must never hide a candidate
            order = np.argsort(-high)
            order = order[ids[order] != qid]
            step = batch
            best_s, best_i, at = np.zeros(0, dtype=object if not whole else np.int64), np.zeros(0, dtype=ids.dtype), 0
            while at < len(order) and (len(best_s) < k or high[order[at]] >= best_s[-1]):
                some = order[at : at + step]
                if len(best_s) == k:  # later candidates of the batch may already fall below the bound
                    some = some[high[some] >= best_s[-1]]
                at, step = at + step, 2 * step
                score = (cv[some] @ qv[i]).astype(np.int64) if whole else np.array([sum(int(a) * int(b) for a, b in zip(cv[j], qv[i])) for j in some], dtype=object)
                if len(best_s) == k:
                    some, score = some[score >= best_s[-1]], score[score >= best_s[-1]]
                s, d = np.concatenate([best_s, score]), np.concatenate([best_i, ids[some]])
                keep = np.array(sorted(range(len(s)), key=lambda j: (-s[j], d[j])) if not whole else np.lexsort((d, -s)), dtype=np.int64)[:k]
                best_s, best_i = s[keep], d[keep]
            out.append((np.full(len(best_s), qid), best_i, best_s))
    if not out:
        return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    return pd.DataFrame({n: np.concatenate([o[j] for o in out]) for j, n in enumerate(("query_id", "vec_id", "score"))})


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first from the first row."""
    picked, far = [0], np.full(len(x), np.inf)
    while len(picked) < min(n, len(x)):
        far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(axis=1))
        picked.append(int(far.argmax()))
    return x[picked]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int = 24, block: int = 8192, sample: int = 4096, id_col: str = "vec_id", vec_col: str = "vec") -> DataFrame:
    """query_id, rank, vec_id, score. vectors and queries hold whole numbers as array<double>, null where unusable."""
    spark = vectors.sparkSession
    ready = lambda df: df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    c, q = ready(vectors), ready(queries).dropDuplicates(["vec_id", "vec"])
    some = c.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(sample).collect()
    table = {dim: choose_pivots(_table([r.vec for r in some if len(r.vec) == dim]), pivots) for dim in {len(r.vec) for r in some}}

    def far(batches):
        for b in batches:
            # A length without a pivot in the sample gets the origin as its only one.
            yield b.assign(dist=[list(_distances(np.asarray([v], dtype=np.float64), table.get(len(v), np.zeros((1, len(v)))))[0]) for v in b["vec"]])

    schema = "vec_id long, vec array<double>, dist array<double>"
    c, q = stage(c.mapInPandas(far, schema), "candidates"), stage(q.mapInPandas(far, schema), "queries")
    n_c, n_q = -(-c.count() // block) or 1, -(-q.count() // block) or 1
    # Candidates are dealt by their hash; copies of a row land in different blocks by a salt.
    c = c.select("*", F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec_id", F.rand(5)), F.lit(n_c)).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb")) if n_q > 1 else c.select("*", F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec_id", F.rand(5)), F.lit(n_c)).alias("cb"), F.lit(0).alias("qb"))
    q = q.select("*", F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(n_q)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))).alias("cb"))
    met = q.groupBy("dim", "qb", "cb").cogroup(c.groupBy("dim", "qb", "cb")).applyInPandas(lambda a, b: top_in_block(a, b, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_pivot_topk(spark, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.when(e.isNotNull() & finite, F.transform(e, lambda x: F.floor(x.cast("double") * 64).cast("double")))
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", scaled.alias("vec"))
    return top_k(v, v.where(F.col("vec_id") % 20 == 0))


OP7_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as vec from embeddings
           where embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id as vec_id, list_dot_product(q.vec, c.vec)::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""

"""Embedding near-duplicates by a forest of random-projection trees with spill.

Every tree splits the vectors recursively at the median of their projection on a random direction; vectors near a split
go to both sides. Vectors that share a leaf of any tree are compared exactly, in double precision. A pair is counted in
the first leaf that it shares, in the order of leaves, so that counts of links need no table of pairs; of the links of a
leaf only a spanning forest leaves the task. Equal vectors are one class with a count, so copies cost nothing. Rows on
their way to the leaves leave a task in chunks of some MB, and a leaf that the sample expects to hold more than WHOLE
rows is compared in blocks of about BLOCK, each pair of blocks a group of its own; so no task grows with the input.

Splits would cut a group of distinct vectors that is larger than a leaf at every level. So vectors of the sample that
link with many others represent such groups: what links with a representative is a member of its core and leaves the
forest. A partner of a member is within twice the angle of a link from the representative; members are compared exactly
with each other and with all vectors within that bound, in blocks, so no pair with a member is lost. That costs the
square of a dense group, as the number of its links is of that order.

The splits are fitted on the `sample` classes with the smallest hashes; every class is indexed. The depth follows from
the number of classes outside of cores, so leaves hold about `leaf` of them. Representatives are sought among `scout` of
the sample. Links found are exact; the recall over pairs is measured in the tests. Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing
and are their own component; vectors of different lengths don't link; repeated rows are links of each other; a null id
counts as a link but names no component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.operators.components import components
from termloom.operators.lineage import stage

#: A leaf of more than WHOLE rows, by the sample, is compared in blocks of about BLOCK.
WHOLE, BLOCK = 16_384, 8_192


def usable(vec: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


class Tree:
    """Thresholds and spill margins of a complete binary tree; directions follow from the seed and the node."""

    def __init__(self, seed: int, depth: int, dim: int):
        self.seed, self.depth, self.dim = seed, depth, dim
        self.cut = np.zeros(2**depth)
        self.spill = np.zeros(2**depth)

    def direction(self, node: int) -> np.ndarray:
        """Kept by the task, if those of the tree are 4 MB at most."""
        if 2**self.depth * self.dim > 1 << 19:
            return np.random.default_rng([self.seed, node]).standard_normal(self.dim)
        held = self.__dict__.setdefault("held", {})
        if node not in held:
            held[node] = np.random.default_rng([self.seed, node]).standard_normal(self.dim)
        return held[node]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "held"}

    def fit(self, x: np.ndarray, spill: float) -> Tree:
        inside = {1: np.arange(len(x))}
        for _ in range(self.depth):
            below = {}
            for node, rows in inside.items():
                p = x[rows] @ self.direction(node)
                if len(p):
                    self.cut[node] = np.median(p)
                    self.spill[node] = np.quantile(np.abs(p - self.cut[node]), spill)
                below[2 * node] = rows[p <= self.cut[node] + self.spill[node]]
                below[2 * node + 1] = rows[p > self.cut[node] - self.spill[node]]
            inside = below
        return self

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their leaves, 0 to 2**depth - 1; a row may have several."""
        inside = {1: np.arange(len(x))}
        for _ in range(self.depth):
            below = {}
            for node, rows in inside.items():
                if len(rows):
                    p = x[rows] @ self.direction(node)
                    below[2 * node] = rows[p <= self.cut[node] + self.spill[node]]
                    below[2 * node + 1] = rows[p > self.cut[node] - self.spill[node]]
            inside = below
        if not inside:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(list(inside.values())), np.concatenate([np.full(len(r), n - 2**self.depth) for n, r in inside.items()])


def unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64) if not isinstance(vectors, np.ndarray) else vectors.astype(np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top  # the squares of huge or tiny components would leave the range of doubles
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def unpacked(blobs, real: str) -> np.ndarray:
    """Vectors of one length, a row each, from the bytes of their components."""
    return np.frombuffer(b"".join(blobs), dtype=real).reshape(len(blobs), -1)


def to_leaves(part: pd.DataFrame, trees: list[tuple[Tree, int]], blocks: np.ndarray, real: str, chunk: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """The rows of part (k, n, vec; one length) in each of their leaves, for each pair of blocks that their block is in,
    with their leaves before that one; in chunks of about `chunk` bytes."""
    x = unit(part["vec"])
    at = [(r, g + base) for tree, base in trees for r, g in [tree.leaves(x)]]
    rows, leaf = np.concatenate([a[0] for a in at]), np.concatenate([a[1] for a in at])
    del at
    order = np.lexsort((leaf, rows))
    rows, leaf = rows[order], leaf[order]
    ends = np.searchsorted(rows, np.arange(len(x) + 1))
    lists = [leaf[ends[i] : ends[i + 1]].astype("<i4").tobytes() for i in range(len(x))]
    nth = np.arange(len(rows)) - ends[rows]
    key, n, vec = part["k"].tolist(), part["n"].to_numpy(), [np.asarray(v, dtype=real).tobytes() for v in part["vec"]]
    home = np.array([int(k[:15], 16) for k in key], dtype=np.int64)
    each = max(64, int(chunk // (len(vec[0]) + 2 * len(leaf) / len(x) + 64)))
    upto = np.concatenate([[0], np.cumsum(blocks[leaf])])  # a row in one of m blocks goes to m pairs of them
    for lo in range(0, int(upto[-1]), each):
        some = np.arange(lo, min(lo + each, int(upto[-1])))
        i = np.searchsorted(upto, some, side="right") - 1
        own, other = home[rows[i]] % blocks[leaf[i]], some - upto[i]
        r, j = rows[i].tolist(), nth[i].tolist()
        yield pd.DataFrame(
            {"leaf": leaf[i], "a": np.minimum(own, other), "b": np.maximum(own, other), "unit": own, "k": pd.Series([key[q] for q in r], dtype=object), "n": n[rows[i]]}
            | {"vec": pd.Series([vec[q] for q in r], dtype=object), "leaves": pd.Series([lists[q][: 4 * m] for q, m in zip(r, j)], dtype=object)}
        )


def _leaf_bits(lists: list[bytes], bases: list[int]) -> list[np.ndarray]:
    """For each tree in which any row has a leaf: the rows' leaves as bits, a row each."""
    flat, rows = np.frombuffer(b"".join(lists), dtype="<i4"), np.repeat(np.arange(len(lists)), [len(v) // 4 for v in lists])
    tree = np.searchsorted(np.array(sorted(bases)), flat, side="right") - 1
    tables = []
    for t in np.unique(tree):
        r, (names, f) = rows[tree == t], np.unique(flat[tree == t], return_inverse=True)
        width = -(-len(names) // 64)
        bits = np.empty((len(lists), width), dtype=np.uint64)
        for lo in range(0, len(lists), 2048):
            a, b = np.searchsorted(r, [lo, lo + 2048])
            some = np.zeros((min(2048, len(lists) - lo), width * 64), dtype=bool)
            some[r[a:b] - lo, f[a:b]] = True
            bits[lo : lo + 2048] = np.packbits(some, axis=1).view(np.uint64)
        tables.append(bits)
    return tables


def _fresh(a: np.ndarray, b: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Which pairs share no earlier leaf; most that do share one of the first tree and are done with then."""
    live = np.arange(len(a))
    for bits in tables:
        each = max(1024, (1 << 20) // bits.shape[1])
        parts = [live[at : at + each] for at in range(0, len(live), each)]
        live = np.concatenate([p[~(bits[a[p]] & bits[b[p]]).any(axis=1)] for p in parts] or [live])
    return live


def links_in_leaf(pdf: pd.DataFrame, least: float, bases: list[int], real: str, block: int = 512, wide: int = 4096) -> pd.DataFrame:
    """Counts of links first found in this leaf, and edges that span them.

    pdf: leaf, a, b (the blocks), unit (the row's own), k, n, vec and leaves (those before this one) as bytes.
    """
    pdf = pdf.sort_values(["unit", "k"], ignore_index=True)
    x, key, n = unit(unpacked(pdf["vec"].tolist(), real)), pdf["k"].tolist(), pdf["n"].to_numpy()
    same, half = bool(pdf["a"].iloc[0] == pdf["b"].iloc[0]), int((pdf["unit"] == pdf["a"]).sum())
    tables = None
    count, root, edges = np.zeros(len(x), dtype=np.int64), np.arange(len(x)), []
    for lo in range(0, half, block):
        hi = min(lo + block, half)
        for at in range(lo if same else half, len(x), wide):
            a, b = np.nonzero(x[lo:hi] @ x[at : at + wide].T >= least)
            a, b = a + lo, b + at
            if same:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            tables = _leaf_bits(pdf["leaves"].tolist(), bases) if tables is None else tables
            live = _fresh(a, b, tables)
            a, b = a[live], b[live]
            count += np.bincount(a, n[b], len(x)).astype(np.int64) + np.bincount(b, n[a], len(x)).astype(np.int64)
            while len(a):  # each round joins one pair of every two sets that touch
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
                ra, rb = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
                _, one = np.unique(rb, return_index=True)
                for i in one.tolist():
                    edges.append((key[a[i]], key[b[i]]))
                    root[rb[i]] = ra[i]
                while (root != root[root]).any():
                    root = root[root]
    hit = np.flatnonzero(count)
    return pd.DataFrame(
        {
            "k": pd.Series([*(key[i] for i in hit), *(e[0] for e in edges)], dtype=object),
            "n": pd.Series([*count[hit], *([0] * len(edges))], dtype="int64"),
            "other": pd.Series([None] * len(hit) + [e[1] for e in edges], dtype=object),
        }
    )


def representatives(x: np.ndarray, least: float, many: float) -> tuple[list[int], np.ndarray]:
    """Rows that link with `many` or more rows which no row before them links with, and whether each row is left over."""
    count = np.concatenate([(x[lo : lo + 512] @ x.T >= least).sum(axis=1) for lo in range(0, len(x), 512)])
    left, out = np.ones(len(x), dtype=bool), []
    for i in np.argsort(-count, kind="stable").tolist():
        if count[i] < many:
            break
        if left[i]:
            near = x @ x[i] >= least
            if (near & left).sum() >= many:
                out.append(i)
                left &= ~near
    return out, left


def links_in_core(pdf: pd.DataFrame, least: float, block: int = 1024, wide: int = 4096) -> pd.DataFrame:
    """Counts of links between a block of a core's members and another block, and edges to its representative.

    pdf: a, b (the blocks), unit (the row's own), member, k, n, vec, rep. Other blocks may hold vectors that are no members.
    """
    a, b = int(pdf["a"].iloc[0]), int(pdf["b"].iloc[0])
    pdf = pdf.sort_values("k", ignore_index=True)
    left, right = pdf[pdf["unit"] == a], pdf[pdf["unit"] == b]
    none = pd.DataFrame({"k": pd.Series([], dtype=object), "n": pd.Series([], dtype="int64"), "other": pd.Series([], dtype=object)})
    if left.empty or right.empty:
        return none
    x, y = unit(left["vec"]), unit(right["vec"])
    nx, ny = left["n"].to_numpy(dtype=np.float64), right["n"].to_numpy(dtype=np.float64)
    cx, cy = np.zeros(len(x)), np.zeros(len(y))
    for lo in range(0, len(x), block):
        for at in range(0, len(y), wide):
            hit = x[lo : lo + block] @ y[at : at + wide].T >= least
            if a == b:  # not with itself
                own = np.arange(max(lo, at), min(lo + block, at + wide, len(x)))
                hit[own - lo, own - at] = False
            hit = hit.astype(np.float64)
            cx[lo : lo + block] += hit @ ny[at : at + wide]
            if a != b:
                cy[at : at + wide] += nx[lo : lo + block] @ hit
    edge = lambda rows, on: [r if o else None for r, o in zip(rows["rep"], on)]
    out = [pd.DataFrame({"k": left["k"], "n": cx.astype(np.int64), "other": edge(left, np.full(len(left), a == b))})]
    if a != b:
        out.append(pd.DataFrame({"k": right["k"], "n": cy.astype(np.int64), "other": edge(right, ~right["member"].to_numpy(dtype=bool) & (cy > 0))}))
    got = pd.concat(out, ignore_index=True)
    return got[(got["n"] > 0) | got["other"].notna()]


def near_vectors(vectors: DataFrame, least: float = 0.95, trees: int = 8, leaf: int = 1024, spill: float = 0.2, sample: int = 65_536, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 11, scout: int = 16_384) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    v = F.col(vec_col)
    ok = usable(v)
    real, vec_type = ("<f4", "array<float>") if vectors.schema[vec_col].dataType.elementType == T.FloatType() else ("<f8", "array<double>")
    hexa = lambda c: F.lpad(F.hex(c), 16, "0")
    key = F.when(ok, F.concat(hexa(F.xxhash64(v)), hexa(F.xxhash64(F.lit(seed), F.reverse(v)))))
    rows = stage(vectors.select(F.col(id_col).alias("vec_id"), key.alias("k"), F.when(ok, v.cast(vec_type)).alias("vec")), "vectors")
    classes = stage(rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("vec").alias("vec")), "classes")
    sizes = classes.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).collect()  # one row per length
    models, blocks, first, cores, reps = {}, [np.zeros(0, dtype=np.int64)], 0, {}, []

    def packed(batches):
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "vec": [np.asarray(v, dtype=real).tobytes() for v in b["vec"]]})

    deep = lambda n: min(max(0, math.ceil(math.log2(max(1, n) / leaf))), int(math.log2(sample / 16)))
    for s in sorted(sizes):
        depth = deep(s.n)
        some = classes.where(F.size("vec") == s.dim)
        if s.n > 2 * sample:  # keys are hashes: this leaves the smallest ones and few more
            some = some.where(F.col("k") < f"{int(2**64 * (sample + 8 * sample**0.5) / s.n):016x}")
        got = some.orderBy("k").limit(sample if depth else 1).select("k", "vec").mapInPandas(packed, "k string, vec binary").collect()
        x = unit(unpacked([r.vec for r in got], real))
        if depth:
            some = x[:scout]
            chosen, left = representatives(some, least, max(8, leaf / 2 * len(some) / s.n))
            if chosen:
                cores[s.dim] = (len(reps), some[chosen])
                reps += [got[i].k for i in chosen]
                x = x[~np.concatenate([(x[lo : lo + 4096] @ some[chosen].T >= least).any(axis=1) for lo in range(0, len(x), 4096)])]
                depth = min(deep(s.n * left.mean()), int(math.log2(max(1.0, len(x) / 16))))
        models[s.dim] = [(Tree(seed * 1000 + t, depth, s.dim).fit(x, spill), first + t * 2**depth) for t in range(trees if depth else 1)]
        for tree, _ in models[s.dim]:
            expected = np.bincount(tree.leaves(x)[1], minlength=2**depth) * (s.n / len(got))
            blocks.append(np.where(expected > WHOLE, np.ceil(expected / BLOCK), 1).astype(np.int64))
        first += len(models[s.dim]) * 2**depth

    blocks, bases = np.concatenate(blocks), [base for m in models.values() for _, base in m]

    def index(batches):
        for b in batches:
            for dim, part in b.groupby(b["vec"].map(len)):
                yield from to_leaves(part, models[dim], blocks, real)

    # A vector is a member of the first core whose representative it links with; its pairs are found there, or in an
    # earlier core, whose members may link with it if it is within the bound.
    bound = 2 * least * least - 1 - 1e-9 if least > 0 else -2.0

    def gather(batches):
        for b in batches:
            for dim, part in b.groupby(b["vec"].map(len)):
                base, r = cores.get(dim, (0, np.zeros((0, dim))))
                sim = unit(part["vec"]) @ r.T
                inside = sim >= least
                home = np.where(inside.any(axis=1), inside.argmax(axis=1), len(r)) if len(r) else np.zeros(len(part), dtype=np.int64)
                near = (sim >= bound) & (np.arange(len(r)) < home[:, None])
                yield part.assign(home=np.where(home < len(r), home + base, -1), near=[(np.flatnonzero(m) + base).tolist() for m in near])

    rest, found_in = classes, None
    if cores:
        held = stage(classes.select("k", "n", "vec").mapInPandas(gather, f"k string, n long, vec {vec_type}, home long, near array<long>"), "cores")
        rest = held.where("home < 0")
        member = held.where("home >= 0").select("k", "n", "vec", F.col("home").alias("core"), F.lit(True).alias("member"))
        other = held.select("k", "n", "vec", F.explode("near").alias("core"), F.lit(False).alias("member"))
        parts = member.unionByName(other)
        many = parts.groupBy("core").agg(F.count_if("member").alias("m"), F.count_if(~F.col("member")).alias("o")).collect()  # one row per core
        size = lambda m: min(max(m // 8, 4096), 16_384)
        plan = [(r.core, reps[r.core], -(-r.m // size(r.m)), -(-r.o // size(r.m))) for r in many]
        plan = vectors.sparkSession.createDataFrame(plan, "core long, rep string, bm long, bo long")
        spread = F.when(F.col("member"), F.pmod(F.xxhash64("k"), F.col("bm"))).otherwise(F.col("bm") + F.pmod(F.xxhash64("k"), F.col("bo")))
        parts = parts.join(F.broadcast(plan), "core").withColumn("unit", spread)
        meets = F.sequence(F.lit(0).cast("long"), F.when(F.col("member"), F.col("bm") + F.col("bo")).otherwise(F.col("bm")) - 1)
        parts = parts.where("bm > 0").withColumn("with", F.explode(meets))
        parts = parts.select("core", F.least("unit", "with").alias("a"), F.greatest("unit", "with").alias("b"), "unit", "member", "k", "n", "vec", "rep")
        found_in = parts.groupBy("core", "a", "b").applyInPandas(lambda p: links_in_core(p, least), "k string, n long, other string")

    indexed = rest.select("k", "n", "vec").mapInPandas(index, "leaf long, a long, b long, unit long, k string, n long, vec binary, leaves binary")
    found = indexed.groupBy("leaf", "a", "b").applyInPandas(lambda p: links_in_leaf(p, least, bases, real), "k string, n long, other string")
    found = stage(found.unionByName(found_in) if found_in is not None else found, "links")
    count = found.where("n > 0").groupBy("k").agg(F.sum("n").alias("links"))
    comp = components(found.where("other is not null").select(F.col("k").alias("u"), F.col("other").alias("v")))
    named = classes.select("k", "n", "least").join(comp.withColumnRenamed("node", "k"), "k", "left").withColumn("component", F.coalesce("component", "k"))
    lead = named.groupBy("component").agg(F.min("least").alias("component_id"))
    per = named.join(lead, "component").join(count, "k", "left").select("k", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "k").join(per, "k", "left")
    comp_id = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"), F.coalesce(F.col("vec_id") == comp_id, F.lit(False)).alias("kept"))


def op4_vector_forest(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP4_SQL = """
with recursive ok as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
n as (select vec_id, v, sqrt(list_dot_product(v, v)) as norm from ok),
links as (select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
          where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.95),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on r.b = l.a)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links, r.component_id, e.vec_id = r.component_id as kept
from embeddings e join (select a, min(b) as component_id from reach group by a) r on r.a = e.vec_id
"""

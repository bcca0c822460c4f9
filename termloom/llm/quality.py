"""Quality classifier: Bradley-Terry pairwise ranking over text features, cut at a score quantile.

Each document gets a linear score of its features. The weights are learnt from preference pairs, a document of label 1
over one of label 0, by logistic loss on the difference of their features. The cut is the quantile of the labelled
scores at the share of label 0, and the score given out is the logistic function of the distance from it.

The fit takes all labelled documents: the bins of the features, the cut and the scale are order statistics of all of
them, found by counting digits of the values, and every labelled document is in pairs. Documents are dealt by a hash of
their features to cells of about `cell` of either label, and the pairs are all those of a cell; with at most `cell` of
either label these are all pairs there are. The label with fewer documents repeats its cells, so that each of its
documents is in several. Documents with equal features are one with a count. Newton's sums are added up by Spark over
the cells; the driver holds sums and counts only.

Features look at whole texts and at nothing else. Defined results: a null text is empty; an empty text has a score like
any other; repeated rows each get their row; labels that are null, or of ids without a document, don't count, and an id
labelled twice counts twice; with labels of one kind only or none, every score is 0.5 plus or minus a fixed step, or 0.5;
an empty table gives an empty result; extra columns are ignored. Ids may be of any type that the labels share. Equal
texts have equal scores, and scores equal to the cut are on the accepted side. Features and linear scores are held to
single precision, weights to six places, so that reruns agree. Memory grows with the longest text and with a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.memory import tidy
from termloom.operators.lineage import stage

#: Character classes whose shares are features.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" ", "line": b"\n", "bang": b"!?", "stop": b".", "comma": b",;:", "pipe": b"|", "mark": b"#$%&*@^~+=<>{}[]()_/\\", "quote": b"\"'"}
_CODE = np.full(256, len(CLASSES), dtype=np.int64)
for _i, _chars in enumerate(CLASSES.values()):
    _CODE[list(_chars)] = _i
FEATURES = [*CLASSES, "words", "word_length", "distinct", "again", "top", "doubled", "lines_again", "line_length", "distinct_local", "capital"]


def features(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    share = np.bincount(_CODE[np.frombuffer(raw, dtype=np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)] / n
    words = raw.split()
    k = max(1, len(words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    doubled = sum(map(bytes.__eq__, words, words[1:])) / k
    halves = len(words) // 2
    again = sum(map(bytes.__eq__, words[:halves], words[halves:])) / max(1, halves)
    lines = [x for x in raw.split(b"\n") if x]
    local = np.mean([len(set(words[i : i + 64])) / len(words[i : i + 64]) for i in range(0, len(words), 64)]) if words else 0.0
    capital = sum(1 for w in words if w[:1].isupper()) / k
    return [*share, np.log1p(len(words)), len(raw) / k, len(counts) / k, again, max(counts.values(), default=0) / k, doubled, 1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))), local, capital]


def feature_frame(texts: Iterable[str | None]) -> np.ndarray:
    return np.array([features(t or "") for t in texts], dtype=np.float32).reshape(-1, len(FEATURES))


def unpacked(blobs: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<f4").reshape(-1, len(FEATURES))


class Ranker:
    """Bradley-Terry model over quantile bins of the features; small, so it travels in closures."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, cut: float, scale: float):
        self.edges, self.weights, self.cut, self.scale = edges, weights, cut, scale

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Piecewise linear: how far each feature has come through each of its quantile bins."""
        low, high = self.edges[:-1].T[None], self.edges[1:].T[None]
        with np.errstate(divide="ignore", invalid="ignore"):
            part = np.where(high > low, (x[:, :, None] - low) / (high - low), x[:, :, None] > low)
        return np.clip(part, 0, 1).reshape(len(x), -1)

    def linear(self, x: np.ndarray) -> np.ndarray:
        s = np.concatenate([np.zeros(0), *(self.expand(x[at : at + 512]) @ self.weights for at in range(0, len(x), 512))])
        return s.astype(np.float32).astype(np.float64)

    def score(self, x: np.ndarray) -> np.ndarray:
        s = self.linear(x)
        return 1 / (1 + np.exp(-np.clip((s - self.cut) / self.scale, -40, 40)))

    def sums(self, good: np.ndarray, bad: np.ndarray, n_good: np.ndarray, n_bad: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        """Of the logistic loss over all pairs of good and bad rows, which count n times: gradient, Hessian, loss, pairs."""
        g, b = self.expand(good), self.expand(bad)
        p = 1 / (1 + np.exp(-np.clip((g @ self.weights)[:, None] - b @ self.weights, -40, 40)))
        n = n_good[:, None] * n_bad
        loss, r = -(n * np.log(p)).sum(), n * (1 - p)
        q = r * p
        cross = g.T @ (q @ b)
        h = (g.T * q.sum(axis=1)) @ g + (b.T * q.sum(axis=0)) @ b - cross - cross.T
        return b.T @ r.sum(axis=0) - g.T @ r.sum(axis=1), h, float(loss), float(n.sum())


#: Bits of a value that are known after each pass.
PASSES = (16, 24, 32)


def order_statistics(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray], asks: list[tuple[int, float, float, float]]) -> list[float]:
    """For each ask (column, weight of label 0, of label 1, t) the least value up to which the weights add up to more
    than t, or the greatest value; exact, in single precision. rows: y, f, n; values: a matrix from that of features.

    Values are counted by their first 16 bits, then by 8 more within the asked ones, so what is collected is bounded.
    """
    prefix, below = [0] * len(asks), [0.0] * len(asks)
    for known, bits in zip((0, *PASSES), PASSES):
        held = {c: np.array(sorted({prefix[i] for i, a in enumerate(asks) if a[0] == c}), dtype=np.int64) for c in {a[0] for a in asks}}

        def go(batches: Iterator[pd.DataFrame], held=held, known=known, bits=bits) -> Iterator[pd.DataFrame]:
            for b in batches:
                v = np.ascontiguousarray(values(unpacked(b["f"])).astype(np.float32) + np.float32(0)).view(np.uint32)
                v = np.where(v >> 31, ~v, v | np.uint32(1 << 31)).astype(np.int64)  # unsigned order is that of the values
                y, n, out = b["y"].to_numpy().astype(np.int64), b["n"].to_numpy(), []
                for c, there in held.items():
                    mine = np.isin(v[:, c] >> (32 - known), there)
                    key, at = np.unique((v[mine, c] >> (32 - bits) << 1) | y[mine], return_inverse=True)
                    out.append(pd.DataFrame({"c": c, "key": key, "n": np.bincount(at, n[mine], len(key)).astype(np.int64)}))
                yield pd.concat(out)

        got = rows.mapInPandas(tidy(go), "c int, key long, n long").groupBy("c", "key").agg(F.sum("n").alias("n")).collect()
        got = np.array([tuple(r) for r in got], dtype=np.int64).reshape(-1, 3)
        got = got[np.lexsort((got[:, 1], got[:, 0]))]
        for i, (c, w0, w1, t) in enumerate(asks):
            key, n = got[got[:, 0] == c, 1], got[got[:, 0] == c, 2]
            mine = (key >> 1 >> (bits - known)) == prefix[i]
            digit, first = np.unique(key[mine] >> 1, return_index=True)
            mass = np.add.reduceat(n[mine] * np.where(key[mine] & 1, w1, w0), first)
            digit, mass = digit[mass > 0], mass[mass > 0]
            upto = below[i] + np.cumsum(mass)
            at = min(int(np.searchsorted(upto, t, side="right")), len(digit) - 1)
            prefix[i], below[i] = int(digit[at]), float(upto[at] - mass[at])
    u = np.array(prefix, dtype=np.uint32)
    return np.where(u >> 31, u ^ np.uint32(1 << 31), ~u).astype(np.uint32).view(np.float32).astype(np.float64).tolist()


def fit(rows: DataFrame, bins: int = 12, cell: int = 1024, l2: float = 3e-4, rounds: int = 25) -> Ranker:
    """rows: y, f, n, each pair of label and features once; read several times."""
    have = {r.y: r for r in rows.groupBy("y").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    if len(have) < 2:
        return Ranker(np.zeros((2, len(FEATURES))), np.zeros(len(FEATURES)), -1.0 if 1 in have else 1.0 if 0 in have else 0.0, 1.0)
    bad, good = have[0].n, have[1].n
    steps = np.linspace(0, 1, bins + 1)
    edges = order_statistics(rows, lambda x: x, [(c, 0.5 / bad, 0.5 / good, t) for c in range(len(FEATURES)) for t in steps])
    m = Ranker(np.array(edges).reshape(len(FEATURES), -1).T, np.zeros(len(FEATURES) * bins), 0.0, 1.0)

    few, many = sorted(have, key=lambda y: have[y].rows)
    least = -(-have[few].rows // cell)
    cells = least * -(-have[many].rows // (cell * least))
    first = F.when(F.col("y") == few, F.pmod(F.xxhash64("f"), F.lit(least))).otherwise(F.pmod(F.xxhash64("f"), F.lit(cells)))
    dealt = rows.withColumn("cell", F.explode(F.sequence(first, F.when(F.col("y") == few, F.lit(cells - 1)).otherwise(first), F.lit(least))))

    def pack(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("f")
        side = [p[p["y"] == y] for y in (1, 0)]
        return pd.DataFrame([[key[0], *(b"".join(x["f"]) for x in side), *(x["n"].to_numpy(dtype="<f8").tobytes() for x in side)]], columns=["cell", "good", "bad", "ng", "nb"])

    parts = min(cells, 64)
    packed = stage(dealt.repartition(parts, "cell").groupBy("cell").applyInPandas(pack, "cell long, good binary, bad binary, ng binary, nb binary"), "cells")

    def newton(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        at = Ranker(m.edges, w, 0.0, 1.0)

        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for b in batches:
                for r in b.itertuples():
                    got = at.sums(unpacked([r.good]), unpacked([r.bad]), np.frombuffer(r.ng), np.frombuffer(r.nb))
                    total = got if total is None else tuple(x + y for x, y in zip(total, got))
            if total is not None:
                yield pd.DataFrame([[total[0].tobytes(), total[1].tobytes(), total[2], total[3]]], columns=["grad", "h", "loss", "pairs"])

        got = packed.mapInPandas(tidy(go), "grad binary, h binary, loss double, pairs double").collect()  # one row per task
        pairs = sum(r.pairs for r in got)
        grad, h = sum(np.frombuffer(r.grad) for r in got) / pairs, sum(np.frombuffer(r.h) for r in got).reshape(len(w), -1) / pairs
        return grad + l2 * w, h + l2 * np.eye(len(w)), sum(r.loss for r in got) / pairs + l2 / 2 * float(w @ w), pairs

    w, step, last = m.weights, None, np.inf
    for _ in range(rounds):
        grad, h, loss, _ = newton(w)
        if loss > last + 1e-12:  # too far
            step = step / 2
            w = w - step
            continue
        last, step = loss, -np.linalg.solve(h, grad)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    m.weights = np.round(w, 6)
    linear = lambda x: m.linear(x)[:, None]
    # Between the last score below the quantile and the first above it.
    low, high, mid_good, mid_bad = order_statistics(rows, linear, [(0, 1, 1, bad - 1), (0, 1, 1, bad), (0, 0, 1, good / 2), (0, 1, 0, bad / 2)])
    m.cut = (low + high) / 2
    m.scale = max(1e-6, (mid_good - mid_bad) / 8)
    return m


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs' columns other than the text, and f: the features as bytes. An old column f is replaced."""
    keep = [c for c in docs.columns if c not in (text_col, "f")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(keep).schema) + "f binary"

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = feature_frame(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([r.tobytes() for r in x], pa.binary())], [*keep, "f"])

    return docs.select(*keep, text_col).mapInArrow(tidy(go), schema)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", cell: int = 1024) -> Ranker:
    """Fit on all labelled documents; labels must hold training rows only."""
    return train_features(with_features(docs.where(F.col(id_col).isNotNull()).select(id_col, text_col), text_col), labels, label_col, id_col, cell)


def train_features(feats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", cell: int = 1024) -> Ranker:
    """train() on the id and features of the documents."""
    lab = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("y")).agg(F.count("*").alias("m"))
    each = feats.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id"), "f").agg(F.count("*").alias("n"))
    rows = each.join(lab, "__id").groupBy("y", "f").agg(F.sum(F.col("n") * F.col("m")).alias("n"))
    return fit(stage(rows, "labelled"), cell=cell)


def score(docs: DataFrame, model: Ranker, text_col: str = "text") -> DataFrame:
    """docs' columns other than the text, and score. Clashing names: an old score column is replaced."""
    keep = [c for c in docs.columns if c not in (text_col, "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema)

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[keep].assign(score=model.score(feature_frame(b[text_col])))

    return docs.select(*keep, text_col).mapInPandas(tidy(go), f"{schema}{', ' if keep else ''}score double")


def score_features(feats: DataFrame, model: Ranker) -> DataFrame:
    """score() from with_features()."""
    keep = [c for c in feats.columns if c not in ("f", "score")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in feats.select(keep).schema) + "score double"

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = unpacked(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(model.score(x))], [*keep, "score"])

    return feats.select(*keep, "f").mapInArrow(tidy(go), schema)


def accepted(docs: DataFrame, model: Ranker, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs that score `least` or more, with all their columns."""

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[model.score(feature_frame(b[text_col])) >= least]

    return docs.mapInPandas(tidy(go), docs.schema)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op3_quality_rank(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    feats = stage(with_features(docs.select("doc_id", "text")), "features")
    model = train_features(feats, labels.where(~held_out()))
    out = score_features(feats, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

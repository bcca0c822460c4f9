"""Risk-aware evaluation, method comparison and splits, as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.candidates import LABELS


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(rows: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """Dense counts of (truth, prediction); other labels are left out."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(t, p) for t in labels for p in labels], "truth string, prediction string")
    got = rows.groupBy("truth", "prediction").agg(F.count("*").alias("n"))
    return every.join(got, ["truth", "prediction"], "left").select("truth", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def per_class(rows: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """precision, recall, f1 and support of every label, those without support too."""
    spark = rows.sparkSession
    t, p = F.col("truth"), F.col("prediction")
    both = rows.select(F.explode(F.array(F.struct(t.alias("label"), F.lit(1).alias("s"), (t == p).cast("int").alias("tp"), F.lit(0).alias("o")), F.struct(p.alias("label"), F.lit(0).alias("s"), F.lit(0).alias("tp"), F.lit(1).alias("o")))).alias("x")).select("x.*")
    got = both.groupBy("label").agg(F.sum("s").alias("support"), F.sum("tp").alias("tp"), F.sum("o").alias("predicted"))
    x = spark.createDataFrame([(l,) for l in labels], "label string").join(got, "label", "left").na.fill(0)
    pr, rc = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    return x.select("label", "support", pr.alias("precision"), rc.alias("recall")).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def evaluate(rows: DataFrame, target: str = "class_schedule", risky: tuple = ("instructor_office_hours", "ta_office_hours")) -> DataFrame:
    """One row: n, accuracy, the target's precision, recall and false-positive share, risky-to-target rate, macro F1."""
    t, p = F.col("truth"), F.col("prediction")
    n = rows.agg(F.count("*").alias("n"), ratio(F.count_if(t == p), F.count("*")).alias("accuracy"), ratio(F.count_if((p == target) & (t != target)), F.count_if(p == target)).alias("false_positive_rate"), ratio(F.count_if(t.isin(*risky) & (p == target)), F.count_if(t.isin(*risky))).alias("risky_rate"))
    c = per_class(rows).agg(F.avg("f1").alias("macro_f1"), F.max(F.when(F.col("label") == target, F.col("precision"))).alias("precision"), F.max(F.when(F.col("label") == target, F.col("recall"))).alias("recall"))
    return n.crossJoin(c)  # one row each


def sweep(rows: DataFrame, thresholds: list[float], target: str = "class_schedule") -> DataFrame:
    """Precision and recall of the target when its probability must reach each threshold. rows: truth, prob, other."""
    x = rows.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    p = F.when(F.col("prob") >= F.col("threshold"), F.lit(target)).otherwise(F.col("other"))
    hit, said, is_ = (p == target) & (F.col("truth") == target), p == target, F.col("truth") == target
    return x.groupBy("threshold").agg(ratio(F.count_if(hit), F.count_if(said)).alias("precision"), ratio(F.count_if(hit), F.count_if(is_)).alias("recall"))


def recommend(swept: DataFrame, least: float) -> DataFrame:
    """The lowest threshold of at least that precision."""
    return swept.where(F.col("precision") >= least).agg(F.min("threshold").alias("threshold"))


def class_weights(rows: DataFrame, label_col: str = "label") -> DataFrame:
    """total / (labels * count); 1 for a label without rows is the caller's default."""
    c = rows.groupBy(label_col).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return c.select(label_col, (total / (len(LABELS) * F.col("n"))).alias("weight"))


def method_metrics(gold: DataFrame, preds: DataFrame) -> DataFrame:
    """Per field and method: n, n_output, n_correct, n_fabricated and their ratios.

    gold: sid, field, gold; preds: method, sid, field, value, one row per method, sid and field.
    """
    clean = lambda c: F.nullif(F.trim(c), F.lit(""))
    methods = preds.agg(F.collect_set("method").alias("methods"))  # one row, as wide as there are methods
    per = gold.groupBy("field").agg(F.count("*").alias("n")).crossJoin(methods).select("field", F.explode("methods").alias("method"), "n")
    said = preds.withColumn("value", clean("value")).where("value is not null")
    x = said.join(gold.withColumn("gold", clean("gold")), ["sid", "field"]).groupBy("field", "method").agg(F.count("*").alias("n_output"), F.count_if(F.lower("value") == F.lower("gold")).alias("n_correct"), F.count_if(F.col("gold").isNull()).alias("n_fabricated"))
    m = per.join(x, ["field", "method"], "left").fillna(0, ["n_output", "n_correct", "n_fabricated"])
    return m.select("*", ratio(F.col("n_output"), F.col("n")).alias("coverage"), ratio(F.col("n_correct"), F.col("n_output")).alias("precision"), ratio(F.col("n_fabricated"), F.col("n_output")).alias("fabrication"))


def pick_winner(metrics: DataFrame, high_risk: list[str]) -> DataFrame:
    """Per field the method that fabricates and errs least (high risk), or of the best harmonic mean; ties by name."""
    high = F.col("field").isin(*high_risk) if high_risk else F.lit(False)
    hm = ratio(2 * F.col("precision") * F.col("coverage"), F.col("precision") + F.col("coverage"))
    order = [F.when(high, F.col("fabrication")).otherwise(-hm), F.when(high, 1 - F.col("precision")).otherwise(-F.col("precision")), F.when(high, -F.col("coverage")), F.col("method")]
    r = F.row_number().over(Window.partitionBy("field").orderBy(*order))
    return metrics.where("n_output > 0").withColumn("__r", r).where("__r = 1").select("field", "method")


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def group_split(rows: DataFrame, group: str, ratios: tuple = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """rows with split, whole groups in one split; groups are dealt by hash, so no group list is sorted in one task."""
    if abs(sum(ratios) - 1) > 1e-9:
        raise ValueError("ratios must sum to 1")
    u = F.conv(F.substring(hash_order(group, seed), 1, 8), 16, 10).cast("double") / 2**32
    return rows.withColumn("split", F.when(u < ratios[0], "train").when(u < ratios[0] + ratios[1], "val").otherwise("test"))


def leaking_groups(rows: DataFrame, group: str) -> DataFrame:
    """Groups in more than one split: none, if the split is sound."""
    return rows.groupBy(group).agg(F.count_distinct("split").alias("splits")).where("splits > 1")


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """ceil(n / strata) of each stratum by hash, cut to n."""
    strata = rows.select(stratum).distinct().count() or 1
    r = F.row_number().over(Window.partitionBy(stratum).orderBy(hash_order(key, seed)))
    return rows.withColumn("__r", r).where(F.col("__r") <= -(-n // strata)).orderBy("__r", hash_order(key, seed)).limit(n).drop("__r")


def distribution(rows: DataFrame, key: str) -> DataFrame:
    c = rows.groupBy(key).agg(F.count("*").alias("n"))
    return c.select(key, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))

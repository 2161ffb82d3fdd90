"""Curves and scores of binary predictions; running sums go over distinct scores, range by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import running


def _steps(scored: DataFrame, keys: list[str]) -> DataFrame:
    """For each distinct score, from the highest: cumulated positives tp and negatives fp, and totals p and n."""
    by = scored.groupBy(*keys, "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    pos, neg = F.col("pos"), F.col("neg")
    return running(by, keys, "score", {"tp": pos, "fp": neg}, descending=True, totals={"p": pos, "n": neg})


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / F.when(b == 0, 1).otherwise(b))


def pr_curve(scored: DataFrame, keys: list[str]) -> DataFrame:
    s = _steps(scored, keys)
    return s.select(*keys, F.col("score").alias("threshold"), _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), _ratio(F.col("tp"), F.col("p")).alias("recall"))


def roc_curve(scored: DataFrame, keys: list[str]) -> DataFrame:
    s = _steps(scored, keys)
    return s.select(*keys, F.col("score").alias("threshold"), _ratio(F.col("fp"), F.col("n")).alias("fpr"), _ratio(F.col("tp"), F.col("p")).alias("tpr"))


def roc_auc(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Exact, ties counting half; null if one label is missing."""
    s = _steps(scored, keys)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return s.groupBy(*keys).agg(F.when((F.max("p") > 0) & (F.max("n") > 0), area / F.greatest(F.max("p") * F.max("n"), F.lit(1))).alias("auc"))


def best_f1(scored: DataFrame, keys: list[str]) -> DataFrame:
    """keys, threshold, f1: of equal F1 the lowest threshold."""
    c = pr_curve(scored, keys).withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-9))
    return c.groupBy(*keys).agg(F.min(F.struct((-F.col("f1")).alias("m"), "threshold")).alias("best")).select(*keys, F.col("best.threshold").alias("threshold"), (-F.col("best.m")).alias("f1"))


def nearest_threshold(curve: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The curve's row nearest to each key's wanted threshold (column wanted); of ties the higher one."""
    gap = F.abs(F.col("threshold") - F.col("wanted"))
    met = curve.join(wanted, keys).groupBy(*keys).agg(F.min(F.struct(gap.alias("gap"), (-F.col("threshold")).alias("t"), "fpr", "tpr")).alias("x"))
    return met.select(*keys, (-F.col("x.t")).alias("threshold"), F.col("x.fpr").alias("fpr"), F.col("x.tpr").alias("tpr"))


def confusion(scored: DataFrame, threshold: Column, keys: list[str]) -> DataFrame:
    pred, y = F.col("score") >= threshold, F.col("label") == 1
    cells = {"tn": ~pred & ~y, "fp": pred & ~y, "fn": ~pred & y, "tp": pred & y}
    return scored.groupBy(*keys).agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in cells.items()])


def with_rates(confused: DataFrame) -> DataFrame:
    """precision, recall, f1 beside the confusion counts; a zero denominator gives 0."""
    c = confused.withColumns({"precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": _ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return c.withColumn("f1", _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def poisson_deviance(scored: DataFrame, keys: list[str]) -> DataFrame:
    y, p = F.col("label").cast("double"), F.greatest(F.col("score"), F.lit(1e-6))
    term = 2 * (F.when(y > 0, y * F.ln(F.when(y > 0, y).otherwise(1.0) / p)).otherwise(0.0) - y + p)
    return scored.groupBy(*keys).agg(F.avg(term).alias("deviance"))


def report(scored: DataFrame, keys: list[str], thresholds: DataFrame | None = None) -> DataFrame:
    """keys, threshold, confusion counts, precision, recall, f1 and auc, all from the distinct scores' running sums.

    thresholds: keys, threshold; without them it is that of the best F1 over these rows, of equal ones the lowest.
    """
    s = _steps(scored, keys)
    tp, fp = F.col("tp"), F.col("fp")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, F.col("p"))
    s = s.withColumn("__f1", 2 * precision * recall / (precision + recall + 1e-9))
    at = F.struct((-F.col("__f1")).alias("m"), F.col("score").alias("threshold"), "tp", "fp")
    if thresholds is None:
        best = F.min(at)
        limit, hit, false = best["threshold"], best["tp"], best["fp"]
    else:
        s = s.join(thresholds.select(*keys, F.col("threshold").alias("__t")), keys)
        over = F.col("score") >= F.col("__t")
        limit, hit, false = F.max("__t"), F.coalesce(F.max(F.when(over, tp)), F.lit(0)), F.coalesce(F.max(F.when(over, fp)), F.lit(0))
    area = F.sum(F.col("neg") * (tp - F.col("pos") / 2))
    auc = F.when((F.max("p") > 0) & (F.max("n") > 0), area / F.greatest(F.max("p") * F.max("n"), F.lit(1)))
    found = s.groupBy(*keys).agg(limit.alias("threshold"), hit.alias("tp"), false.alias("fp"), F.max("p").alias("p"), F.max("n").alias("n"), auc.alias("auc"))
    counts = found.select(*keys, "threshold", (F.col("n") - fp).alias("tn"), "fp", (F.col("p") - tp).alias("fn"), "tp", "auc")
    return with_rates(counts).select(*keys, "threshold", "tn", "fp", "fn", "tp", "precision", "recall", "f1", "auc")


def normalized(scored: DataFrame, keys: list[str]) -> DataFrame:
    """intensity: score over the key's largest score that is a number; null keys are a key. The maxima are joined, not
    windowed."""
    top = scored.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(F.nanvl("score", F.lit(None).cast("double"))).alias("__top"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return scored.join(top, on).withColumn("intensity", F.col("score") / F.col("__top")).drop("__top", *[f"__{k}" for k in keys])

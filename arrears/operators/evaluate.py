"""Classifier evaluation as DataFrame aggregates (M7-M10, O5 helpers).

Every metric is a ratio of integer counts computed in one global aggregate
(partial per task, one tiny merge), so results are exact and independent of
the number of partitions. Zero denominators give 0, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# Fixed values of the reference: class names in the per-class report.
CLASS_NAMES = {0: "No Default", 1: "Default"}


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "is_default", pred: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def binary_metrics(df: DataFrame, label: str = "is_default", pred: str = "prediction") -> DataFrame:
    """M7: accuracy, precision, recall, F1 for the positive class 1."""
    c = confusion_counts(df, label, pred)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select(
        _safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str = "is_default", pred: str = "prediction") -> DataFrame:
    """M9: rows = actual class, columns = predicted class; empty cells are 0."""
    c = confusion_counts(df, label, pred)
    return c.select(F.explode(F.array(
        F.struct(F.lit(0).alias("actual"), F.col("tn").cast("bigint").alias("pred_0"),
                 F.col("fp").cast("bigint").alias("pred_1")),
        F.struct(F.lit(1).alias("actual"), F.col("fn").cast("bigint").alias("pred_0"),
                 F.col("tp").cast("bigint").alias("pred_1")),
    )).alias("r")).select("r.*")


def class_report(df: DataFrame, label: str = "is_default", pred: str = "prediction") -> DataFrame:
    """precision/recall/F1/support per class, the accuracy line (F1 column,
    total support), then macro and weighted averages."""
    c = confusion_counts(df, label, pred)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    # class 1 is positive as counted; class 0 swaps the roles (tn is its tp).
    per = {
        1: (_safe_div(tp, tp + fp), _safe_div(tp, tp + fn), _safe_div(tp * 2, tp * 2 + fp + fn),
            tp + fn),
        0: (_safe_div(tn, tn + fn), _safe_div(tn, tn + fp), _safe_div(tn * 2, tn * 2 + fn + fp),
            tn + fp),
    }
    cols = []
    for k in (0, 1):
        pr, rc, f1, sup = per[k]
        cols += [pr.alias(f"p{k}"), rc.alias(f"r{k}"), f1.alias(f"f{k}"),
                 sup.cast("bigint").alias(f"s{k}")]
    cols.append(_safe_div(tp + tn, tp + fp + tn + fn).alias("acc"))
    w = c.select(*cols)

    def row(name, pr, rc, f1, sup):
        return F.struct(F.lit(name).alias("class_label"), pr.alias("precision"),
                        rc.alias("recall"), f1.alias("f1_score"), sup.alias("support"))

    s0, s1 = F.col("s0"), F.col("s1")
    tot = s0 + s1

    def weighted(a: str) -> Column:
        num = F.col(f"{a}0") * s0.cast("double") + F.col(f"{a}1") * s1.cast("double")
        return F.when(tot != 0, num / tot.cast("double")).otherwise(F.lit(0.0))

    rows = [row(CLASS_NAMES[k], F.col(f"p{k}"), F.col(f"r{k}"), F.col(f"f{k}"), F.col(f"s{k}"))
            for k in (0, 1)]
    none = F.lit(None).cast("double")
    rows.append(row("accuracy", none, none, F.col("acc"), tot))
    rows.append(row("macro avg", (F.col("p0") + F.col("p1")) / 2.0, (F.col("r0") + F.col("r1")) / 2.0,
                    (F.col("f0") + F.col("f1")) / 2.0, tot))
    rows.append(row("weighted avg", weighted("p"), weighted("r"), weighted("f"), tot))
    return w.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def roc_auc(df: DataFrame, label: str = "is_default", score: str = "score") -> DataFrame:
    """M8: exact ROC AUC with ties counted half (Mann-Whitney form).

    AUC = sum over distinct scores s of pos(s) * (neg_below(s) + neg(s)/2) / (P*N).
    Rows are first reduced to distinct scores (partial aggregation), dealt out in
    ranges of about equally many scores, wherever the scores lie, and written
    once with the number of their range. neg_below is then the negatives of the
    ranges before (a window over one row per range) plus those before in the
    range (a window inside each range). Products are exact decimals, so billions
    of rows in either class do not overflow. A NULL or NaN score is an error.
    """
    s = F.col(score).cast("double")
    per_score = df.groupBy(s.alias("_s")).agg(
        F.sum(F.col(label).cast("bigint")).alias("_pos"),
        (F.count(F.lit(1)) - F.sum(F.col(label).cast("bigint"))).alias("_neg"))
    per_score = materialise(per_score.repartitionByRange("_s").withColumn("_b", F.spark_partition_id()), "auc-scores")
    totals = per_score.groupBy("_b").agg(F.sum("_neg").alias("_bneg"))
    prior = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_b", F.coalesce(F.sum("_bneg").over(prior), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (per_score.withColumn("_in", F.coalesce(F.sum("_neg").over(inside), F.lit(0)))
              .join(F.broadcast(offsets), "_b"))     # one row per range
    return _auc(ranked)


def _auc(ranked: DataFrame) -> DataFrame:
    """The AUC from distinct scores with their counts and the negatives below (_off + _in)."""
    exact = "decimal(19,0)"
    below2 = ((F.col("_off") + F.col("_in")) * 2 + F.col("_neg")).cast(exact)
    agg = ranked.agg(
        F.sum(F.col("_pos").cast(exact) * below2).alias("_num"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"),
        F.count_if(F.col("_s").isNull() | F.isnan("_s")).alias("_bad"))
    den = F.col("_p").cast(exact) * F.col("_n").cast(exact) * 2
    return agg.select(
        F.when(F.col("_bad") > 0, F.raise_error(F.lit("a score is NULL or NaN")).cast("double"))
        .when(den != 0, F.col("_num").cast("double") / den.cast("double")).alias("auc"))

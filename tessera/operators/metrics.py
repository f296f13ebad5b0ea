"""Classification metrics (MET1-MET4, AGG19, AB3).

ROC AUC is exact (ties count one half): scores are counted per distinct value and group,
negatives below each score come from a distributed running sum, and the Mann-Whitney sum is
a grouped aggregate. ``BinaryClassificationEvaluator`` bins scores (approximate by default)
and treats -0.0 and 0.0 as different values, so it is not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.misc import pct
from .prefix import running_sums

SINGLE_CLASS_ERROR = ("Only one class present in y_true. ROC AUC score is not defined in that case.")


def accuracy(scored: DataFrame, label: str = "label", pred: str = "prediction",
             by: Sequence[str] = ()) -> DataFrame:
    """MET1: share of rows with ``label == prediction``."""
    return scored.groupBy(*by).agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                                   F.count(F.lit(1)).alias("rows"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score",
            by: Sequence[str] = ()) -> DataFrame:
    """MET2 / MET4 / AB3: exact ROC AUC per group, with positives, negatives and an error
    text (instead of a value) when a group has a single class. Rows with a NULL score are
    not scored."""
    by = list(by)
    s = (F.col(score).cast("double") + F.lit(0.0)).alias("_s")
    d = (scored.filter(F.col(score).isNotNull()).select(*by, s, F.col(label).cast("int").alias("_y"))
         .groupBy(*by, "_s").agg(F.count_if(F.col("_y") == 1).alias("pos"),
                                 F.count_if(F.col("_y") != 1).alias("neg")))
    rs = running_sums(d, ["_s"], ["neg", "pos"], by, totals=True)
    contrib = F.col("pos").cast("double") * (F.col("neg_cum") - F.col("neg").cast("double") / 2.0)
    g = rs.groupBy(*by).agg(F.first("pos_total").alias("positives"),
                            F.first("neg_total").alias("negatives"), F.sum(contrib).alias("_u"))
    one_class = (F.col("positives") == 0) | (F.col("negatives") == 0)
    return g.select(*by, F.col("positives").cast("bigint").alias("positives"),
                    F.col("negatives").cast("bigint").alias("negatives"),
                    F.when(~one_class, F.col("_u") / (F.col("positives").cast("double")
                                                      * F.col("negatives").cast("double"))).alias("roc_auc"),
                    F.when(one_class, F.lit(SINGLE_CLASS_ERROR)).alias("error"))


def confusion(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Confusion counts (label, prediction, rows): at most classes^2 rows."""
    return scored.groupBy(F.col(label).cast("int").alias("label"),
                          F.col(pred).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("rows"))


def classification_report(scored: DataFrame, label: str = "label", pred: str = "prediction",
                          class_names: dict[int, str] | None = None) -> DataFrame:
    """MET3: precision, recall, F1 and support per class, then accuracy, macro and weighted
    averages; a division by zero gives 0 (a class never predicted has precision 0)."""
    cm = confusion(scored, label, pred)
    classes = cm.select(F.col("label").alias("cls")).union(cm.select("prediction")).distinct()
    tp = cm.filter(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("rows").alias("tp"))
    sup = cm.groupBy(F.col("label").alias("cls")).agg(F.sum("rows").alias("support"))
    prd = cm.groupBy(F.col("prediction").alias("cls")).agg(F.sum("rows").alias("predicted"))
    z = F.lit(0.0)
    per = (classes.join(tp, "cls", "left").join(sup, "cls", "left").join(prd, "cls", "left")
           .select("cls", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted")))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), z)
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), z)
    per = per.select("cls", "tp", "support", prec.alias("precision"), rec.alias("recall"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), z)
    per = per.withColumn("f1_score", f1)
    if class_names:
        name = F.create_map(*[x for k, v in class_names.items() for x in (F.lit(k), F.lit(v))])[F.col("cls")]
        name = F.coalesce(name, F.col("cls").cast("string"))
    else:
        name = F.col("cls").cast("string")
    rows = per.select(name.alias("class"), "precision", "recall", "f1_score",
                      F.col("support").cast("bigint").alias("support"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    acc = F.try_divide(F.col("tp").cast("double"), F.col("n").cast("double"))
    n = F.col("n").cast("double")
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"),
                 F.col("n").cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1_score"), F.col("n").cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.try_divide(F.col("wp"), n).alias("precision"),
                 F.try_divide(F.col("wr"), n).alias("recall"), F.try_divide(F.col("wf"), n).alias("f1_score"),
                 F.col("n").cast("bigint").alias("support")))).alias("r")).select("r.*")
    return rows.unionByName(summary)


def flip_rate(df: DataFrame, a: str, b: str, threshold_pct: float | None = None) -> DataFrame:
    """AGG19 / RB3: rows whose two predictions differ, their percent, and (optionally)
    ``passed = percent < threshold`` (strict)."""
    out = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias("changed"))
    out = out.withColumn("change_pct", F.coalesce(pct(F.col("changed"), F.col("rows")), F.lit(0.0)))
    if threshold_pct is not None:
        out = out.withColumn("passed", F.col("change_pct") < F.lit(float(threshold_pct)))
    return out


def linear_score(rate_pct: Column, dti: Column, row_id: Column) -> Column:
    """The fixed scoring formula of the metric queries (no fitted model):
    ``0.02 * rate_percent + 0.01 * dti + 0.000001 * id`` (all doubles, this operand order)."""
    return (F.lit(0.02) * rate_pct.cast("double") + F.lit(0.01) * dti.cast("double")
            + F.lit(0.000001) * row_id.cast("double"))

"""Exact metrics of binary probabilities, for one group or many. Rows are first summed by (group, probability); running sums
over distinct probabilities go by ranges, so no task sees all of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.operators.ranges import running


def _by_score(rows: DataFrame, keys: list[str], p: str, y: str) -> DataFrame:
    return rows.groupBy(*keys, F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos"))


def ranking_metrics(rows: DataFrame, keys: list[str], p: str = "p", y: str = "y") -> DataFrame:
    """Average precision (equal probabilities share a threshold) and ROC AUC (Mann-Whitney, ties half)."""
    step = running(_by_score(rows, keys, p, y), keys, [F.desc("p")], {"tp": "pos", "seen": "n"}).withColumnsRenamed({"all_tp": "all_pos", "all_seen": "all_n"})
    precision = F.col("pos") / F.col("all_pos") * (F.col("tp") / F.col("seen"))
    negatives = F.col("all_n") - F.col("all_pos")
    below = negatives - (F.col("seen") - F.col("tp"))  # negatives with a smaller probability
    wins = F.col("pos") * (below + (F.col("n") - F.col("pos")) / 2.0)
    step = step.withColumns({"_ap": precision, "_wins": wins, "_pairs": F.col("all_pos") * negatives})
    return step.groupBy(*keys).agg(F.sum("_ap").alias("pr_auc"), F.when(F.max("_pairs") > 0, F.sum("_wins") / F.max("_pairs")).alias("roc_auc"))


def point_metrics(rows: DataFrame, keys: list[str], p: str = "p", y: str = "y", threshold: float = 0.5) -> DataFrame:
    """Rows, positives, log loss, Brier score, precision and recall (0 where they divide by nothing)."""
    q, t = F.least(F.greatest(F.col(p), F.lit(1e-15)), F.lit(1 - 1e-15)), F.col(y).cast("int")
    said, true = F.col(p) >= threshold, t == 1
    ratio = lambda a, b: F.when(F.count_if(b) > 0, F.count_if(a) / F.count_if(b)).otherwise(0.0)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(true).alias("positives"),
        F.avg(-F.when(true, F.ln(q)).otherwise(F.ln(1 - q))).alias("log_loss"),
        F.avg((F.col(p) - t) * (F.col(p) - t)).alias("brier"),
        ratio(said & true, said).alias("precision"),
        ratio(said & true, true).alias("recall"),
    )


def report(rows: DataFrame, keys: list[str], p: str = "p", y: str = "y", threshold: float = 0.5) -> DataFrame:
    """All metrics of each group."""
    if not keys:
        return report(rows.withColumn("_all", F.lit(0)), ["_all"], p, y, threshold).drop("_all")
    return point_metrics(rows, keys, p, y, threshold).join(ranking_metrics(rows, keys, p, y), keys)


def group_report(rows: DataFrame, key: str, least: int = 100, p: str = "p", y: str = "y") -> DataFrame:
    """Metrics of the groups with ``least`` rows or more and both classes."""
    return report(rows, [key], p, y).where((F.col("n") >= least) & (F.col("positives") > 0) & (F.col("positives") < F.col("n")))


def faulty(rows: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """Input faults: probabilities that are no numbers in [0, 1], and a missing class."""
    bad = F.col(p).isNull() | F.isnan(p) | ~F.col(p).between(0, 1)
    return rows.agg(F.count_if(bad).alias("bad_probabilities"), (F.countDistinct(y) < 2).alias("class_missing"))


def calibration_curve(rows: DataFrame, bins: int = 10, p: str = "p", y: str = "y") -> DataFrame:
    """bin, n, mean_p, observed over quantile bins with exact (interpolated) edges; a value on an inner edge belongs to
    the bin it begins, edges that fall together leave bins out."""
    seen = running(rows.where(F.col(p).isNotNull()).groupBy(F.col(p).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n")), [], [F.col("v")], {"seen": "n"})
    at = lambda i, whole: F.min(F.when(F.col("seen") > whole((F.col("all_seen") - 1) * F.lit(i) / bins), F.col("v")))
    share = lambda i: F.max((F.col("all_seen") - 1) * F.lit(i) / bins % 1)
    edge = lambda i: at(i, F.floor) + (at(i, F.ceil) - at(i, F.floor)) * share(i)
    edges = seen.agg(F.array(*(edge(i) for i in range(1, bins)))).scalar()
    placed = rows.select(F.col(p).alias("p"), F.col(y).cast("double").alias("y"), edges.alias("edges")).withColumn("bin", F.size(F.filter("edges", lambda e: e <= F.col("p"))))
    return placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_p"), F.avg("y").alias("observed"))


def largest_errors(rows: DataFrame, ids: list[str], k: int = 20, p: str = "p", y: str = "y", threshold: float = 0.5) -> DataFrame:
    """The ``k`` false positives of the highest and ``k`` false negatives of the lowest probability."""
    over = rows.where((F.col(p) >= threshold) & (F.col(y).cast("int") == 0)).orderBy(F.desc(p), *ids).limit(k).withColumn("error", F.lit("false_positive"))
    under = rows.where((F.col(p) < threshold) & (F.col(y).cast("int") == 1)).orderBy(F.asc(p), *ids).limit(k).withColumn("error", F.lit("false_negative"))
    return over.unionByName(under)


def cohort_means(rows: DataFrame, cohorts: dict, p: str = "p") -> DataFrame:
    """Mean probability in each cohort against that of all rows."""
    all_ = F.avg(p)
    one = rows.agg(F.array(*(F.struct(F.lit(n).alias("cohort"), F.count_if(c).alias("n"), F.avg(F.when(c, F.col(p))).alias("mean_p"), all_.alias("overall_p")) for n, c in cohorts.items())).alias("x"))
    return one.select(F.inline("x")).withColumn("direction_observed", F.col("mean_p") > F.col("overall_p"))


def class_weights(rows: DataFrame, y: str) -> DataFrame:
    """Balanced weight of each class (n / (2 * n_class)) and the share of negatives to positives."""
    counts = rows.groupBy(F.col(y).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    both = Window.partitionBy(F.lit(0))  # two rows
    total = counts.withColumns({"total": F.sum("n").over(both), "pos": F.sum(F.when(F.col("label") == 1, F.col("n"))).over(both)})
    return total.select("label", "n", (F.col("total") / (2 * F.col("n"))).alias("weight"), ((F.col("total") - F.col("pos")) / F.col("pos")).alias("scale_pos_weight"))


def matrix_stats(rows: DataFrame, features: list[str], y: str) -> DataFrame:
    """Rows, entries that are not zero, density and positive rate."""
    nonzero = sum((F.when(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) != 0, 1).otherwise(0) for c in features), F.lit(0))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(nonzero).alias("nonzero"), (F.sum(nonzero) / (F.count(F.lit(1)) * len(features))).alias("density"), F.avg(F.col(y).cast("double")).alias("positive_rate"))

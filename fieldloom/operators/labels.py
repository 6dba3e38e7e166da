"""Forward-looking labels and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.operators.states import SHOOTOUT

AHEAD = 10
REASON = "penalty_shootout"


def goal_flags(type_name: Column, result_name: Column) -> tuple[Column, Column]:
    """Goal and own goal of a shot-like action."""
    shot = type_name.contains("shot")
    return shot & (result_name == "success"), shot & (result_name == "owngoal")


def labels(actions: DataFrame, home: Column, goal: Column, own_goal: Column, ahead: int = AHEAD) -> DataFrame:
    """scores, concedes, eligible, reason. A label looks at the action and the ``ahead`` - 1 after it in its match;
    actions of the shoot-out are taken out first, and are not eligible."""
    live = F.col("period") != SHOOTOUT
    for_home, for_away = (goal & home) | (own_goal & ~home), (goal & ~home) | (own_goal & home)
    # the shoot-out is kept as a part of the partition of its own, so one pass serves both
    order = Window.partitionBy("match_id", live).orderBy("action_id").rowsBetween(0, ahead - 1)
    soon = lambda c: F.max(c.cast("int")).over(order) == 1
    rows = actions.withColumns({"_home": soon(for_home), "_away": soon(for_away)})
    return rows.withColumns(
        {
            "scores": F.when(live, F.when(home, F.col("_home")).otherwise(F.col("_away"))),
            "concedes": F.when(live, F.when(home, F.col("_away")).otherwise(F.col("_home"))),
            "eligible": live,
            "reason": F.when(~live, F.lit(REASON)),
        }
    ).drop("_home", "_away")


def audit(labelled: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, eligible rows, positives and rates of each group of ``keys``; [] for the whole. Rates have 12 places."""
    share = lambda c: F.round(F.avg(F.col(c).cast("double")), 12)
    return labelled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("actions"),
        F.count_if("eligible").alias("eligible"),
        F.count_if("scores").alias("scores"),
        F.count_if("concedes").alias("concedes"),
        share("scores").alias("scores_rate"),
        share("concedes").alias("concedes_rate"),
    )


def merged_audit(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Audits of disjoint parts as one: counts are added, rates made anew."""
    rate = lambda c: F.round(F.sum(c) / F.nullif(F.sum("eligible"), F.lit(0)), 12).alias(f"{c}_rate")
    return parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("actions", "eligible", "scores", "concedes")), rate("scores"), rate("concedes"))


def cohorts(labelled: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """The audit of each cohort in one pass: a row joins every cohort whose flag it has."""
    named = F.filter(F.array(*(F.when(flag, F.lit(name)) for name, flag in flags.items())), lambda x: x.isNotNull())
    return audit(labelled.withColumn("cohort", F.explode(named)), ["cohort"])

"""Order-sensitive state of a match. All windows share one partitioning and order, so one shuffle serves them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHOOTOUT = 5


def in_match() -> Window:
    return Window.partitionBy("match_id").orderBy("action_id")


def running_score(actions: DataFrame, home: Column, goal: Column, own_goal: Column) -> DataFrame:
    """home_score, away_score after each action, and score_for, score_against, score_diff from the acting team's side.
    Goals of the shoot-out don't count; an own goal counts for the other team."""
    counts = F.col("period") != SHOOTOUT
    by_home = (goal & home) | (own_goal & ~home)
    by_away = (goal & ~home) | (own_goal & home)
    so_far = in_match().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = lambda c: F.sum(F.when(c & counts, 1).otherwise(0)).over(so_far)
    rows = actions.withColumns({"home_score": total(by_home), "away_score": total(by_away)})
    own, other = F.when(home, F.col("home_score")).otherwise(F.col("away_score")), F.when(home, F.col("away_score")).otherwise(F.col("home_score"))
    return rows.withColumns({"score_for": own, "score_against": other, "score_diff": own - other})


def possession_changed(actions: DataFrame, keys: list[str]) -> DataFrame:
    """Whether ``keys`` differ from those of the previous action; false for the first of a match."""
    now = F.struct(*keys)
    before = F.lag(now).over(in_match())
    return actions.withColumn("possession_changed", F.coalesce(~before.eqNullSafe(now) & before.isNotNull(), F.lit(False)))


def contiguous(actions: DataFrame) -> DataFrame:
    """The matches whose action ids are not 0, 1, 2, ...; an empty result means that all are."""
    ids = actions.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("action_id").alias("d"), F.min("action_id").alias("low"), F.max("action_id").alias("high"))
    return ids.where("n <> d or low <> 0 or high <> n - 1")


def increasing(actions: DataFrame, order: str) -> DataFrame:
    """Rows whose action id doesn't exceed the one before in ``order``."""
    before = F.lag("action_id").over(Window.partitionBy("match_id").orderBy(order))
    return actions.withColumn("_before", before).where("_before >= action_id").drop("_before")


def game_states(actions: DataFrame, columns: list[str], depth: int = 3) -> DataFrame:
    """<column>_a0 .. _a<depth-1>: values of the action and of those before it in its period. Where there is none, the
    first action of the period stands in."""
    order = Window.partitionBy("match_id", "period").orderBy("action_id")
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.struct(*columns)  # one lag for all columns
    rows = actions
    for k in range(1, depth):
        rows = rows.withColumn(f"_a{k}", F.coalesce(F.lag(row, k).over(order), F.first(row).over(first)))
    states = [F.col(c).alias(f"{c}_a0") for c in columns] + [F.col(f"_a{k}.{c}").alias(f"{c}_a{k}") for k in range(1, depth) for c in columns]
    return rows.select(*actions.columns, *states)


def first_and_last(actions: DataFrame) -> DataFrame:
    """is_first, is_last of each match."""
    back = Window.partitionBy("match_id").orderBy(F.desc("action_id"))
    return actions.withColumns({"is_first": F.row_number().over(in_match()) == 1, "is_last": F.row_number().over(back) == 1})


def period_boundary(actions: DataFrame) -> DataFrame:
    """Whether the next action of the match is of another period."""
    return actions.withColumn("period_boundary", F.coalesce(F.lead("period").over(in_match()) != F.col("period"), F.lit(False)))


def filled_provenance(actions: DataFrame, column: str, into: str) -> DataFrame:
    """``column``, or where it is null the next value of the match, or else the last one before."""
    ahead = in_match().rowsBetween(Window.currentRow, Window.unboundedFollowing)
    behind = in_match().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return actions.withColumn(into, F.coalesce(F.first(column, ignorenulls=True).over(ahead), F.last(column, ignorenulls=True).over(behind)))


def numbered(rows: DataFrame, keys: list[str], order: list[Column], into: str) -> DataFrame:
    """Zero-based place of a row among those of its keys."""
    return rows.withColumn(into, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))

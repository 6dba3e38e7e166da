"""Minutes on the pitch and player aggregates at two levels and two groupings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MINIMUM_MINUTES = 450.0
SUMS = ("offensive", "defensive", "vaep")


def match_seconds(events: DataFrame) -> DataFrame:
    """Duration of each match: the latest minute and second of periods 1 to 4; a match without any is an error."""
    second = F.max(F.when(F.col("period").between(1, 4), F.col("minute") * 60 + F.col("second")))
    return events.groupBy("match_id").agg(second.alias("duration")).withColumn("duration", F.when(F.col("duration") > 0, F.col("duration")).otherwise(F.raise_error(F.lit("a match has no duration")).cast("int")))


def union_seconds(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Length of the union of a key's intervals [start, end): gaps and islands."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    islands = rows.groupBy(*keys, "_island").agg((F.max("end") - F.min("start")).alias("length"))
    return islands.groupBy(*keys).agg(F.sum("length").alias("seconds"), F.count(F.lit(1)).alias("islands"))


def primary_position(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """The position held longest; of equals, the alphabetically first. Unknown times and unknown positions come last."""
    held = intervals.groupBy(*keys, "position").agg(F.sum(F.col("end") - F.col("start")).alias("held"))
    order = F.struct(F.isnull("held"), -F.col("held"), F.isnull("position"), "position")
    return held.groupBy(*keys).agg(F.min_by("position", order).alias("position"))


def player_minutes(lineups: DataFrame, durations: DataFrame) -> DataFrame:
    """match_id, player_id, team_id, minutes, position. An open interval ends with the match; intervals are cut to
    the match; reversed and empty ones are left out."""
    keys = ["match_id", "player_id", "team_id"]
    rows = lineups.join(durations, "match_id").select(
        *keys,
        "position",
        F.greatest(F.col("from_seconds"), F.lit(0)).alias("start"),
        F.least(F.coalesce("to_seconds", "duration"), F.col("duration")).alias("end"),
    )
    rows = rows.where(F.col("end") > F.col("start"))
    return union_seconds(rows, keys).join(primary_position(rows, keys), keys).select(*keys, (F.col("seconds") / 60.0).alias("minutes"), "position")


def grouped(values: DataFrame, keys: list[str], kind: str = "type_name") -> DataFrame:
    """Counts and sums of a key's actions, for each type and for all types together, in one pass."""
    sums = [F.count(F.lit(1)).alias("actions"), *(F.sum(c).alias(c) for c in SUMS)]
    rows = values.groupingSets([keys, [*keys, kind]], *keys, kind).agg(*sums, F.grouping(kind).alias("_all"))
    return rows.withColumn("action_type", F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col(kind))).drop("_all", kind)


def per_90(amount: Column, minutes: Column) -> Column:
    return F.when(minutes > 0, amount / minutes * 90)


def rated(rows: DataFrame, minimum: float = MINIMUM_MINUTES) -> DataFrame:
    return rows.withColumns({f"{c}_per_90": per_90(F.col(c), F.col("minutes")) for c in SUMS}).withColumn("eligible", F.col("minutes") >= minimum)


def match_level(values: DataFrame, minutes: DataFrame) -> DataFrame:
    """A row for each match, player, team and action type; actions without a player are left out. A player without
    minutes has 0 and position Unknown."""
    rows = grouped(values.where("player_id is not null"), ["match_id", "competition_id", "season_id", "player_id", "team_id"])
    rows = rows.join(minutes.select("match_id", "player_id", "team_id", "minutes", "position"), ["match_id", "player_id", "team_id"], "left")
    return rows.withColumns({"minutes": F.coalesce("minutes", F.lit(0.0)), "position": F.coalesce("position", F.lit("Unknown")), "matches": F.lit(1).cast("long")})


def season_level(match_rows: DataFrame, by_position: bool = True) -> DataFrame:
    """Match rows rolled up; a season row belongs to one position unless ``by_position`` is false."""
    keys = ["competition_id", "season_id", "player_id", "team_id", *(["position"] if by_position else []), "action_type"]
    rows = match_rows.groupBy(*keys).agg(F.sum("minutes").alias("minutes"), F.sum("matches").alias("matches"), F.sum("actions").alias("actions"), *(F.sum(c).alias(c) for c in SUMS))
    return rows if by_position else rows.withColumn("position", F.lit("all"))


def aggregates(values: DataFrame, minutes: DataFrame, minimum: float = MINIMUM_MINUTES) -> DataFrame:
    """Season rows and match rows in one table."""
    by_match = match_level(values, minutes)
    by_season = season_level(by_match).withColumn("match_id", F.lit(None).cast("long")).withColumn("level", F.lit("competition_season"))
    both = by_match.withColumn("level", F.lit("match")).unionByName(by_season)
    return rated(both, minimum).select("level", "match_id", "competition_id", "season_id", "player_id", "team_id", "position", "action_type", "minutes", "matches", "actions", *SUMS, *(f"{c}_per_90" for c in SUMS), "eligible")


def reconciliation(values: DataFrame, minutes: DataFrame) -> DataFrame:
    """Known, unknown and known-without-minutes actions, with their summed value."""
    timed = minutes.select("match_id", "player_id", "team_id", F.lit(True).alias("timed")).distinct()
    rows = values.join(timed, ["match_id", "player_id", "team_id"], "left")
    known = F.col("player_id").isNotNull()
    return rows.agg(F.count(F.lit(1)).alias("actions"), F.count_if(known).alias("known"), F.count_if(~known).alias("unknown"), F.count_if(known & F.col("timed").isNull()).alias("without_minutes"), F.sum("vaep").alias("vaep"), F.sum(F.when(known, F.col("vaep"))).alias("known_vaep"))


def ranking(rows: DataFrame, top: int | None = None) -> DataFrame:
    """Eligible rows by value per 90 minutes, the best first."""
    out = rows.where("eligible").orderBy(F.desc("vaep_per_90"), "player_id", "team_id")
    return out.limit(top) if top else out


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once; null equals null."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")

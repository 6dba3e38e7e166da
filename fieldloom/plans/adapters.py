"""Ordered actions from a plain event stream, so that the order-sensitive operators run on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GOAL, OWN_GOAL, TOP = 440.0, 12.0, 500.0
GAP = 43_200.0


def actions_from_events(events: DataFrame) -> DataFrame:
    """A user is a match; acting team, period (a fifth of a month; the last is the shoot-out), goals and two
    probabilities come from the event's fields."""
    order = Window.partitionBy("match_id").orderBy(F.asc_nulls_last("ts"), F.asc_nulls_last("event_id"))  # as in ACTIONS_SQL
    value = F.col("value")
    return events.withColumnRenamed("user_id", "match_id").select(  # renamed first, so later windows reuse this partitioning
        "match_id",
        (F.row_number().over(order) - 1).cast("long").alias("action_id"),
        "event_id",
        (F.get_json_object("props", "$.k").cast("int") % 2).alias("team_id"),
        F.least(F.floor((F.dayofmonth("ts") - 1) / 6) + 1, F.lit(5)).cast("int").alias("period"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("time_seconds"),
        F.col("event_type").alias("type_name"),
        ((F.col("event_type") == "purchase") & (value >= GOAL)).alias("goal"),
        ((F.col("event_type") == "error") & (value < OWN_GOAL)).alias("own_goal"),
        value.alias("value"),
        (value / TOP).alias("p_score"),
        (1 - value / TOP).alias("p_concede"),
    )


ACTIONS_SQL = f"""actions AS (
  SELECT user_id AS match_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS action_id, event_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 AS team_id, CAST(least((day(ts) - 1) // 6 + 1, 5) AS INTEGER) AS period,
         epoch(ts) AS time_seconds, event_type AS type_name, (event_type = 'purchase' AND value >= {GOAL}) AS goal,
         (event_type = 'error' AND value < {OWN_GOAL}) AS own_goal, value, value / {TOP} AS p_score, 1 - value / {TOP} AS p_concede
  FROM events)"""

"""Look-back features of each action from the states of three actions: 568 columns in one wide select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions import geometry
from fieldloom.functions.text import finite
from fieldloom.operators.actions import ACTION_TYPES, BODY_PARTS, RESULTS
from fieldloom.operators.states import game_states

DEPTH = 3
STATE = ["type_name", "result_name", "bodypart_name", "period", "time_seconds", "start_x", "start_y", "end_x", "end_y", "team_id"]
GOAL_X, GOAL_Y = geometry.LENGTH, geometry.WIDTH / 2
FORBIDDEN = ("scores", "concedes", "match_id", "action_id", "player_id", "team_id", "possession_id", "source_event_id", "split")


def _polar(x: Column, y: Column) -> tuple[Column, Column]:
    dx, dy = F.abs(GOAL_X - x), F.abs(GOAL_Y - y)
    return F.hypot(dx, dy), F.when(dx != 0, F.atan(dy / F.when(dx != 0, dx))).when(dy > 0, F.lit(1.5707963267948966)).otherwise(F.lit(0.0))


def feature_columns() -> dict[str, Column]:
    """Name and expression of every feature, over columns <field>_a0 .. _a2 and the running score."""
    c = F.col
    out: dict[str, Column] = {}
    for k in range(DEPTH):
        kind, result = c(f"type_name_a{k}"), c(f"result_name_a{k}")
        out |= {f"actiontype_{t}_a{k}": kind == t for t in ACTION_TYPES}
        out |= {f"result_{r}_a{k}": result == r for r in RESULTS}
        out |= {f"actiontype_{t}_result_{r}_a{k}": (kind == t) & (result == r) for t in ACTION_TYPES for r in RESULTS}
        out |= {f"bodypart_{b}_a{k}": c(f"bodypart_name_a{k}") == b for b in BODY_PARTS}
        period, second = c(f"period_a{k}"), c(f"time_seconds_a{k}")
        out |= {f"period_id_a{k}": period, f"time_seconds_a{k}": second, f"time_seconds_overall_a{k}": (period - 1) * 45 * 60 + second}
        sx, sy, ex, ey = (c(f"{n}_a{k}") for n in ("start_x", "start_y", "end_x", "end_y"))
        out |= {f"start_x_a{k}": sx, f"start_y_a{k}": sy, f"end_x_a{k}": ex, f"end_y_a{k}": ey}
        for side, x, y in (("start", sx, sy), ("end", ex, ey)):
            distance, angle = _polar(x, y)
            out |= {f"{side}_dist_to_goal_a{k}": distance, f"{side}_angle_to_goal_a{k}": angle}
        out |= {f"dx_a{k}": ex - sx, f"dy_a{k}": ey - sy, f"movement_a{k}": F.hypot(ex - sx, ey - sy)}
    for k in range(1, DEPTH):
        out[f"team_{k}"] = c(f"team_id_a{k}") == c("team_id_a0")
        out[f"time_delta_{k}"] = c("time_seconds_a0") - c(f"time_seconds_a{k}")
        dx, dy = c("start_x_a0") - c(f"end_x_a{k}"), c("start_y_a0") - c(f"end_y_a{k}")
        out |= {f"dx_a0{k}": dx, f"dy_a0{k}": dy, f"mov_a0{k}": F.hypot(dx, dy)}
    return out | {"goalscore_team": c("score_for"), "goalscore_opponent": c("score_against"), "goalscore_diff": c("score_diff")}


FEATURE_COUNT = 568


def names() -> list[str]:
    return list(feature_columns())


def features(states: DataFrame, keys: tuple[str, ...] = ("match_id", "action_id")) -> DataFrame:
    """Keys and all features as doubles; what is no finite number is null. ``states`` carries the running score."""
    rows = game_states(states, STATE, DEPTH)
    columns = [finite(expr.cast("double")).alias(name) for name, expr in feature_columns().items()]
    return rows.select(*keys, *columns)


def allowlist_faults(columns: list[str], keys: tuple[str, ...] = ("match_id", "action_id")) -> list[str]:
    """Differences from the feature list, in order; forbidden names; states beyond the third action."""
    own, want = [c for c in columns if c not in keys], names()
    faults = [f"missing: {c}" for c in want if c not in set(own)] + [f"unknown: {c}" for c in own if c not in set(want)]
    if not faults and own != want:
        faults.append("order")
    return faults + [f"forbidden: {c}" for c in own if c in FORBIDDEN or c.endswith(f"_a{DEPTH}")]


def with_frames(actions: DataFrame, frames: DataFrame, matches: DataFrame) -> DataFrame:
    """Actions with the eight columns of their event's frame; synthetic and frame-less actions have none."""
    rows = actions.join(matches.select("match_id", "home_team_id"), "match_id").join(frames.select("source_event_id", "freeze_frame", "visible_area"), "source_event_id", "left")
    away = F.col("team_id") != F.col("home_team_id")

    def player(p: Column) -> Column:
        x, y = geometry.to_pitch(p["x"], p["y"], away)
        return F.struct(p["teammate"].alias("teammate"), p["actor"].alias("actor"), p["keeper"].alias("keeper"), x.alias("x"), y.alias("y"))

    def corner(v: Column, i: Column) -> Column:
        along = F.when(away, geometry.LENGTH - v / 120 * geometry.LENGTH).otherwise(v / 120 * geometry.LENGTH)
        across = F.when(away, v / 80 * geometry.WIDTH).otherwise((80 - v) / 80 * geometry.WIDTH)
        return F.when(i % 2 == 0, along).otherwise(across)

    rows = rows.withColumns({"_frame": F.transform("freeze_frame", player), "_area": F.transform("visible_area", corner)})
    made = geometry.frame_features(F.col("_frame"), F.col("_area"), F.col("start_x"), F.col("start_y"), F.col("end_x"), F.col("end_y"))
    return rows.withColumns(made).drop("_frame", "_area", "freeze_frame", "visible_area", "home_team_id")

"""Geometry over arrays of points, as higher-order functions.

A frame is an array of structs (teammate, actor, keeper, x, y); a visible area is a flat array x0, y0, x1, y1, ...
Lengths are in metres on a 105 by 68 pitch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LENGTH, WIDTH = 105.0, 68.0
GOAL_HALF = 3.66
PRESSURE, LANE = 5.0, 2.0
EDGE = 1e-9


def to_pitch(x: Column, y: Column, away: Column) -> tuple[Column, Column]:
    """A point on the 120 by 80 grid in metres, turned round for away teams."""
    px, py = x / 120.0 * LENGTH, (80.0 - y) / 80.0 * WIDTH
    return F.when(away, LENGTH - px).otherwise(px), F.when(away, WIDTH - py).otherwise(py)


def others(frame: Column, teammates: bool) -> Column:
    """Players of one side without the actor; players without a location are left out."""
    mate = lambda p: F.coalesce(p["teammate"], F.lit(False))
    seen = lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.coalesce(p["actor"], F.lit(False))
    return F.filter(frame, lambda p: seen(p) & (mate(p) if teammates else ~mate(p)))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.hypot(ax - bx, ay - by)


def nearest(points: Column, x: Column, y: Column) -> Column:
    """Least distance; null without points."""
    return F.array_min(F.transform(points, lambda p: distance(p["x"], p["y"], x, y)))


def within(points: Column, x: Column, y: Column, radius: float = PRESSURE) -> Column:
    return F.size(F.filter(points, lambda p: distance(p["x"], p["y"], x, y) <= radius))


def near_segment(points: Column, ax: Column, ay: Column, bx: Column, by: Column, radius: float = LANE) -> Column:
    """Points within ``radius`` of the segment; a segment without length is a point."""
    length = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)

    def near(p: Column) -> Column:
        t = F.when(length > 0, ((p["x"] - ax) * (bx - ax) + (p["y"] - ay) * (by - ay)) / F.when(length > 0, length)).otherwise(F.lit(0.0))
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        return distance(p["x"], p["y"], ax + t * (bx - ax), ay + t * (by - ay)) <= radius

    return F.size(F.filter(points, near))


def corners(flat: Column) -> Column:
    """Points of a flat array."""
    pair = lambda i: F.struct(F.get(flat, i).alias("x"), F.get(flat, i + 1).alias("y"))
    return F.when(F.size(flat) >= 2, F.transform(F.sequence(F.lit(0), F.size(flat) - 2, F.lit(2)), pair)).otherwise(F.array().cast("array<struct<x:double,y:double>>"))


def inside(polygon: Column, x: Column, y: Column) -> Column:
    """Even-odd test; the boundary counts as inside, fewer than three corners hold nothing."""
    n = F.size(polygon)

    def step(acc: Column, i: Column) -> Column:
        a, b = F.get(polygon, i), F.get(polygon, (i + n - 1) % n)
        cross = (x - a["x"]) * (b["y"] - a["y"]) - (y - a["y"]) * (b["x"] - a["x"])
        on = (
            (F.abs(cross) <= EDGE)
            & (x >= F.least(a["x"], b["x"]) - EDGE)
            & (x <= F.greatest(a["x"], b["x"]) + EDGE)
            & (y >= F.least(a["y"], b["y"]) - EDGE)
            & (y <= F.greatest(a["y"], b["y"]) + EDGE)
        )
        crosses = (a["y"] > y) != (b["y"] > y)
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] != a["y"], b["y"] - a["y"]) + a["x"]
        flips = F.coalesce(crosses & (x < at), F.lit(False))
        return F.struct((acc["odd"] != flips).alias("odd"), (acc["on"] | on).alias("on"))

    start = F.struct(F.lit(False).alias("odd"), F.lit(False).alias("on"))
    walked = F.aggregate(F.sequence(F.lit(0), n - 1), start, step)
    return F.when(n >= 3, walked["odd"] | walked["on"]).otherwise(F.lit(False))


def goal_angle(x: Column, y: Column) -> Column:
    """Angle between the posts as seen from a point."""
    low = F.atan2(F.lit(WIDTH / 2 - GOAL_HALF) - y, F.lit(LENGTH) - x)
    high = F.atan2(F.lit(WIDTH / 2 + GOAL_HALF) - y, F.lit(LENGTH) - x)
    return F.abs(high - low)


def frame_features(frame: Column, area: Column, x: Column, y: Column, end_x: Column, end_y: Column) -> dict[str, Column]:
    """The eight columns of a frame; without a frame ``has_360`` is false and the others are null."""
    has = frame.isNotNull()
    mates, opponents = others(frame, True), others(frame, False)
    visible = inside(corners(area), F.lit(LENGTH), F.lit(WIDTH / 2))
    only = lambda c: F.when(has, c)
    return {
        "has_360": has,
        "visible_teammates": only(F.size(mates)),
        "visible_opponents": only(F.size(opponents)),
        "nearest_defender_distance": only(nearest(opponents, x, y)),
        "pressure_around_ball": only(within(opponents, x, y)),
        "passing_lane_obstruction": only(near_segment(opponents, x, y, end_x, end_y)),
        "goal_visible": only(visible),
        "visible_goal_angle": F.when(has & visible, goal_angle(x, y)),
    }

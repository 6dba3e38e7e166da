"""Actions from typed events: kinds, results, body parts, coordinates, splits of one event into two actions, dribbles
between them, and numbering. The rules are tables of expressions, first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.geometry import LENGTH, WIDTH
from fieldloom.operators.states import filled_provenance, numbered
from fieldloom.operators.vocabulary import ACTIONABLE

#: Our own action vocabulary, in the order of one-hot columns.
ACTION_TYPES = (
    "pass", "cross", "throw_in", "freekick_crossed", "freekick_short", "corner_crossed", "corner_short", "take_on", "foul", "tackle", "interception", "shot",
    "shot_penalty", "shot_freekick", "keeper_save", "keeper_claim", "keeper_punch", "keeper_pick_up", "clearance", "bad_touch", "non_action", "dribble", "goalkick",
)
RESULTS = ("fail", "success", "offside", "owngoal", "yellow_card", "red_card")
BODY_PARTS = ("foot", "head", "other", "head/other")
DRIBBLE_LEAST, DRIBBLE_MOST, DRIBBLE_GAP = 3.0, 60.0, 10.0
CELL = 0.05


def pitch_x(x: Column) -> Column:
    """Metres along the pitch of a place on the 120-yard grid, whose places are middles of cells."""
    return F.least(F.greatest((x - CELL) / 120 * LENGTH, F.lit(0.0)), F.lit(LENGTH))


def pitch_y(y: Column) -> Column:
    return F.least(F.greatest(WIDTH - (y - CELL) / 80 * WIDTH, F.lit(0.0)), F.lit(WIDTH))


def _detail(path: str) -> Column:
    return F.try_variant_get(F.parse_json("raw_details"), path, "string")


def action_type() -> Column:
    kind, sub = F.col("event_type"), F.col("event_subtype")
    crossed = F.coalesce(_detail("$.pass.cross") == "true", F.lit(False))
    set_piece = lambda name, high, low: F.when((kind == "pass") & (sub == name) & crossed, high).when((kind == "pass") & (sub == name), low)
    keeper = {"shot_saved": "keeper_save", "shot_saved_to_post": "keeper_save", "save": "keeper_save", "smother": "keeper_claim", "collected": "keeper_claim", "punch": "keeper_punch", "keeper_sweeper": "keeper_pick_up", "penalty_saved": "keeper_save"}
    by_keeper = F.try_element_at(F.create_map(*[F.lit(x) for kv in keeper.items() for x in kv]), sub)
    return F.coalesce(
        set_piece("free_kick", "freekick_crossed", "freekick_short"),
        set_piece("corner", "corner_crossed", "corner_short"),
        F.when((kind == "pass") & (sub == "goal_kick"), "goalkick"),
        F.when((kind == "pass") & (sub == "throw_in"), "throw_in"),
        F.when((kind == "pass") & crossed, "cross"),
        F.when(kind == "pass", "pass"),
        F.when(kind == "dribble", "take_on"),
        F.when(kind == "carry", "dribble"),
        F.when(kind == "foul_committed", "foul"),
        F.when((kind == "duel") & (sub == "tackle"), "tackle"),
        F.when(kind == "interception", "interception"),
        F.when((kind == "shot") & (sub == "free_kick"), "shot_freekick"),
        F.when((kind == "shot") & (sub == "penalty"), "shot_penalty"),
        F.when(kind == "shot", "shot"),
        F.when(kind == "goalkeeper", by_keeper),
        F.when(kind == "clearance", "clearance"),
        F.when(kind == "miscontrol", "bad_touch"),
        F.when(kind == "own_goal_against", "bad_touch"),
    )


def action_result() -> Column:
    kind, said = F.col("event_type"), F.col("outcome")
    card = _detail("$.foul_committed.card.name")
    return (
        F.when(kind == "own_goal_against", "owngoal")
        .when((kind == "pass") & (said == "pass_offside"), "offside")
        .when(kind == "pass", F.when(said == "complete", "success").otherwise("fail"))
        .when(kind == "dribble", F.when(said == "complete", "success").otherwise("fail"))
        .when((kind == "foul_committed") & card.contains("Red"), "red_card")
        .when((kind == "foul_committed") & card.isin("Second Yellow"), "red_card")
        .when((kind == "foul_committed") & card.contains("Yellow"), "yellow_card")
        .when(kind == "foul_committed", "fail")
        .when(kind == "shot", F.when(said == "goal", "success").otherwise("fail"))
        .when(kind.isin("duel", "interception"), F.when(F.coalesce(said.rlike("^lost"), F.lit(False)), "fail").otherwise("success"))
        .when(kind == "goalkeeper", F.when(F.coalesce(said.isin("in_play_danger", "touched_in", "fail"), F.lit(False)), "fail").otherwise("success"))
        .when(kind == "miscontrol", "fail")
        .otherwise("success")
    )


def body_part() -> Column:
    part, kind = F.col("body_part"), F.col("event_type")
    return F.when(part.contains("foot") | (part == "drop_kick"), "foot").when(part == "head", "head").when((kind == "goalkeeper") | part.isNotNull(), "other").otherwise("foot")


def _spot(path: str, i: int) -> Column:
    return F.get(F.try_variant_get(F.parse_json("raw_details"), path, "array<double>"), F.lit(i))


def exclusions(events: DataFrame) -> DataFrame:
    """Events that become no action, counted by reason."""
    return events.withColumn("action", action_type()).where("action is null").groupBy(F.concat(F.lit("non_action:"), "event_type").alias("reason")).agg(F.count(F.lit(1)).alias("events"))


def base_actions(events: DataFrame, matches: DataFrame) -> DataFrame:
    """An action for each event that is one; a pass of kind interception is an interception, then a pass. Away teams
    are turned round, so all play from left to right."""
    end_path = F.col("event_type")
    ends = lambda i: F.coalesce(*(F.when(end_path == k, _spot(f"$.{k}.end_location", i)) for k in ("pass", "carry", "shot")))
    rows = events.where(F.col("event_type").isin(*ACTIONABLE)).withColumns(
        {
            "type_name": action_type(),
            "result_name": action_result(),
            "bodypart_name": body_part(),
            "_sx": _spot("$.location", 0),
            "_sy": _spot("$.location", 1),
            "_ex": F.coalesce(ends(0), _spot("$.location", 0)),
            "_ey": F.coalesce(ends(1), _spot("$.location", 1)),
        }
    )
    rows = rows.where("type_name is not null").join(matches.select("match_id", "home_team_id"), "match_id")
    away = F.col("team_id") != F.col("home_team_id")
    turned = lambda v, size: F.when(away, F.lit(size) - v).otherwise(v)
    rows = rows.withColumns(
        {
            "start_x": turned(pitch_x(F.col("_sx")), LENGTH),
            "start_y": turned(pitch_y(F.col("_sy")), WIDTH),
            "end_x": turned(pitch_x(F.col("_ex")), LENGTH),
            "end_y": turned(pitch_y(F.col("_ey")), WIDTH),
            "time_seconds": F.col("clock_ms") / 1000.0,
        }
    )
    steals = (F.col("event_type") == "pass") & (F.col("event_subtype") == "interception")
    first = F.struct(F.lit(0).alias("nth"), F.lit("interception").alias("type"), F.lit("success").alias("result"), F.col("start_x").alias("ex"), F.col("start_y").alias("ey"))
    own = F.struct(F.when(steals, 1).otherwise(0).alias("nth"), F.col("type_name").alias("type"), F.col("result_name").alias("result"), F.col("end_x").alias("ex"), F.col("end_y").alias("ey"))
    rows = rows.withColumn("_part", F.explode(F.when(steals, F.array(first, own)).otherwise(F.array(own))))
    return rows.select(
        "match_id", "period", "time_seconds", "team_id", "player_id", "possession_id", "possession_team_id", "source_event_id", "source_event_index", "bodypart_name", "start_x", "start_y",
        F.col("_part.type").alias("type_name"), F.col("_part.result").alias("result_name"), F.col("_part.ex").alias("end_x"), F.col("_part.ey").alias("end_y"), F.col("_part.nth").alias("source_action_index"),
    )


def with_dribbles(actions: DataFrame) -> DataFrame:
    """Adds the run between two actions of a team where the second starts away from the first's end."""
    order = Window.partitionBy("match_id", "period").orderBy("time_seconds", "source_event_index", "source_action_index")
    after = lambda c: F.lead(c).over(order)
    rows = actions.withColumns({"_x": after("start_x"), "_y": after("start_y"), "_t": after("time_seconds"), "_team": after("team_id"), "_player": after("player_id"), "_type": after("type_name")})
    gap = F.hypot(F.col("_x") - F.col("end_x"), F.col("_y") - F.col("end_y"))
    runs = rows.where((F.col("_team") == F.col("team_id")) & gap.between(DRIBBLE_LEAST, DRIBBLE_MOST) & (F.col("_t") - F.col("time_seconds") < DRIBBLE_GAP) & (F.col("_type") != "dribble") & (F.col("type_name") != "dribble"))
    runs = runs.select(
        "match_id", "period", ((F.col("time_seconds") + F.col("_t")) / 2).alias("time_seconds"), "team_id", F.col("_player").alias("player_id"), "possession_id", "possession_team_id",
        F.lit(None).cast("string").alias("source_event_id"), (F.col("source_event_index") + 0.5).alias("source_event_index"), F.lit("foot").alias("bodypart_name"), F.col("end_x").alias("start_x"), F.col("end_y").alias("start_y"),
        F.lit("dribble").alias("type_name"), F.lit("success").alias("result_name"), F.col("_x").alias("end_x"), F.col("_y").alias("end_y"), F.lit(0).alias("source_action_index"),
    )
    return actions.withColumn("source_event_index", F.col("source_event_index").cast("double")).unionByName(runs)


def convert(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Numbered actions with their provenance: a synthetic action has no source id and inherits the next real one."""
    rows = numbered(with_dribbles(base_actions(events, matches)), ["match_id"], [F.col(c) for c in ("period", "time_seconds", "source_event_index", "source_action_index")], "action_id")
    rows = filled_provenance(rows.withColumn("is_synthetic", F.col("source_event_id").isNull()), "source_event_id", "anchor_event_id")
    rows = rows.withColumn("_i", F.row_number().over(Window.partitionBy("match_id", "anchor_event_id").orderBy("action_id")) - 1)
    return rows.withColumn("source_action_index", F.col("_i")).drop("_i", "source_event_index")


def broken(actions: DataFrame) -> DataFrame:
    """Actions without a player or with a coordinate that is no finite number."""
    bad = F.col("player_id").isNull()
    for c in ("start_x", "start_y", "end_x", "end_y"):
        bad |= F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return actions.where(bad)


def conversion_report(events: DataFrame, actions: DataFrame) -> DataFrame:
    """Mapped source events, excluded events and synthetic actions of each match."""
    made = actions.groupBy("match_id").agg(F.count(F.lit(1)).alias("actions"), F.countDistinct("source_event_id").alias("mapped"), F.count_if("is_synthetic").alias("synthetic"))
    seen = events.groupBy("match_id").agg(F.count(F.lit(1)).alias("events"))
    return seen.join(made, "match_id", "left").select("match_id", "events", "actions", "mapped", (F.col("events") - F.coalesce("mapped", F.lit(0))).alias("excluded"), "synthetic")

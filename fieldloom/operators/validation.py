"""Validation of typed events, intervals, frames and action tables. Row rules give arrays of issues; rules across rows
give tables of (match_id, key, code)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions.text import is_nil_uuid, is_snake, uuid_text
from fieldloom.operators.rules import Rule, issues
from fieldloom.operators.vocabulary import (
    ACTIONABLE,
    ENDPOINT_REQUIRED,
    ENDPOINT_TYPES,
    EVENT_TYPES,
    LOCATION_OPTIONAL,
    OUTCOME_OPTIONAL,
    OUTCOME_TYPES,
    PERIOD_START,
    PLAYER_OPTIONAL,
)

c = F.col
KNOWN = tuple(EVENT_TYPES.values())


def _not_positive(name: str) -> Column:
    return c(name).isNull() | (c(name) <= 0)


def _out_of(x: Column, low: float, high: float) -> Column:
    return x.isNotNull() & (F.isnan(x) | ~x.between(low, high))


def event_rules(in_context: bool = False) -> list[Rule]:
    """All rules of a row. With ``in_context`` the row carries ``match_teams`` and ``match_players`` (see ``with_context``)."""
    kind = c("event_type")
    known = F.coalesce(kind.isin(*KNOWN), F.lit(False))
    rules: list[Rule] = [
        ("source_required", c("source").isNull() | (F.trim("source") == "")),
        ("source_event_id_invalid", c("source_event_id").isNull() | uuid_text(c("source_event_id")).isNull()),
        *((f"{n}_invalid", _not_positive(n)) for n in ("match_id", "team_id", "source_event_index", "possession_id", "possession_team_id")),
        ("source_record_index_invalid", c("source_record_index").isNull() | (c("source_record_index") < 0)),
        ("player_id_invalid", c("player_id") <= 0),
        ("event_type_unknown", ~known),
    ]
    if in_context:
        teams, players, there = c("match_teams"), F.coalesce("match_players", F.array().cast("array<bigint>")), c("match_teams").isNotNull()
        rules += [
            ("match_not_found", ~there),
            ("team_not_in_match", there & ~F.array_contains(teams, c("team_id"))),
            ("possession_team_not_in_match", there & ~F.array_contains(teams, c("possession_team_id"))),
            ("player_not_in_match_lineup", there & c("player_id").isNotNull() & ~F.array_contains(players, c("player_id"))),
            ("recipient_not_in_match_lineup", there & c("recipient_id").isNotNull() & ~F.array_contains(players, c("recipient_id"))),
        ]
    start = F.try_element_at(F.create_map(*[F.lit(x) for kv in PERIOD_START.items() for x in kv]), c("period"))
    second = start * 60 + F.floor(c("clock_ms") / 1000)
    whole = start.isNotNull() & c("clock_ms").isNotNull() & (c("minute") >= 0) & c("second").between(0, 59)
    has_start, has_end = c("x").isNotNull() & c("y").isNotNull(), c("end_x").isNotNull() & c("end_y").isNotNull()
    rules += [
        ("period_invalid", start.isNull()),
        ("timestamp_invalid", c("clock_ms").isNull()),
        ("minute_invalid", c("minute").isNull() | (c("minute") < 0)),
        ("second_invalid", c("second").isNull() | ~c("second").between(0, 59)),
        ("time_fields_inconsistent", whole & ((c("minute") != F.floor(second / 60)) | (c("second") != second % 60))),
    ]
    for side, x, y, has in (("start", "x", "y", has_start), ("end", "end_x", "end_y", has_end)):
        rules += [
            (f"{side}_coordinate_pair_incomplete", c(x).isNull() != c(y).isNull()),
            (f"{side}_x_out_of_range", has & _out_of(c(x), 0, 100)),
            (f"{side}_y_out_of_range", has & _out_of(c(y), 0, 100)),
        ]
    must, may = kind.isin(*(t for t in OUTCOME_TYPES if t not in OUTCOME_OPTIONAL)), kind.isin(*OUTCOME_TYPES)
    rules += [
        ("start_location_required", known & ~has_start & ~kind.isin(*LOCATION_OPTIONAL)),
        ("endpoint_required", kind.isin(*ENDPOINT_REQUIRED) & ~has_end),
        ("endpoint_not_allowed", known & ~kind.isin(*ENDPOINT_TYPES) & has_end),
        ("player_required", known & c("player_id").isNull() & ~kind.isin(*PLAYER_OPTIONAL)),
        ("outcome_invalid", ~is_snake(c("outcome"))),
        ("outcome_required", must & c("outcome").isNull()),
        ("outcome_not_allowed", known & ~may & c("outcome").isNotNull()),
        ("xg_required", (kind == "shot") & c("xg").isNull()),
        ("xg_not_allowed", ~F.coalesce(kind == "shot", F.lit(False)) & c("xg").isNotNull()),
        ("xg_out_of_range", (kind == "shot") & _out_of(c("xg"), 0, 1)),
        ("duration_invalid", _out_of(c("duration"), 0, 1e300)),
        *((f"{n}_invalid", ~is_snake(c(n))) for n in ("event_subtype", "body_part", "play_pattern")),
        ("play_pattern_required", c("play_pattern").isNull() | (c("play_pattern") == "")),
        *((f"{n}_invalid", c(n).isNull()) for n in ("under_pressure", "counterpress")),
        ("recipient_id_invalid", c("recipient_id") <= 0),
        ("related_event_ids_invalid", c("related_event_ids").isNull() | F.exists("related_event_ids", lambda e: uuid_text(e).isNull())),
        ("raw_details_invalid", ~F.coalesce(F.schema_of_variant(F.try_parse_json("raw_details")).startswith("OBJECT"), F.lit(False))),
    ]
    return rules


def with_context(events: DataFrame, matches: DataFrame, intervals: DataFrame) -> DataFrame:
    """match_teams and match_players of each row's match; both null where the match isn't known."""
    squads = intervals.groupBy("match_id").agg(F.collect_set("player_id").alias("match_players"))  # the players of one match
    known = matches.select("match_id", F.array("home_team_id", "away_team_id").alias("match_teams")).join(squads, "match_id", "left")
    return events.join(known, "match_id", "left")


def validated_events(events: DataFrame, matches: DataFrame | None = None, intervals: DataFrame | None = None) -> DataFrame:
    """``events`` with their issues."""
    if matches is None:
        return events.withColumn("issues", issues(event_rules()))
    return with_context(events, matches, intervals).withColumn("issues", issues(event_rules(True))).drop("match_teams", "match_players")


def interval_rules() -> list[Rule]:
    return [("lineup_from_period_invalid", c("from_period").isNull() | ~c("from_period").between(1, 5)), ("lineup_to_period_invalid", ~c("to_period").between(1, 5))]


def frame_rules() -> list[Rule]:
    """Rules of a frame row that carries ``event_found``."""
    size, players = F.size("visible_area"), c("freeze_frame")
    return [
        ("three_sixty_event_not_found", ~c("event_found")),
        ("visible_area_invalid", c("visible_area").isNull() | (size < 6) | (size % 2 != 0)),
        ("freeze_frame_flag_invalid", F.exists(players, lambda p: p["teammate"].isNull() | p["actor"].isNull() | p["keeper"].isNull())),
        ("freeze_frame_location_invalid", F.exists(players, lambda p: p["x"].isNull() | p["y"].isNull())),
        ("freeze_frame_multiple_actors", F.size(F.filter(players, lambda p: F.coalesce(p["actor"], F.lit(False)))) > 1),
        ("three_sixty_coordinate_invalid", F.exists("visible_area", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) | F.exists(players, lambda p: F.isnan(p["x"]) | F.isnan(p["y"]))),
    ]


def validated_frames(frames: DataFrame, events: DataFrame) -> DataFrame:
    found = events.select("source", "source_event_id").distinct().withColumn("event_found", F.lit(True))
    rows = frames.join(found, ["source", "source_event_id"], "left").withColumn("event_found", F.coalesce("event_found", F.lit(False)))
    return rows.withColumn("issues", issues(frame_rules())).drop("event_found")


def match_rules(competition: Column | None = None, season: Column | None = None) -> list[Rule]:
    """Rules of a match row (see ``sources.json_arrays.match_metadata``)."""
    rules: list[Rule] = [
        *(("positive_integer_required", _not_positive(n)) for n in ("match_id", "competition_id", "season_id", "home_team_id", "away_team_id")),
        *(("nonnegative_integer_required", c(n).isNull() | (c(n) < 0)) for n in ("home_score", "away_score")),
        ("date_invalid", c("match_date").isNull()),
        ("match_teams_not_distinct", c("home_team_id") == c("away_team_id")),
    ]
    if competition is not None:
        rules.append(("competition_mismatch", c("competition_id") != competition))
    if season is not None:
        rules.append(("season_mismatch", c("season_id") != season))
    return rules


def _issue(rows: DataFrame, code: str, key: Column) -> DataFrame:
    return rows.select("match_id", key.cast("string").alias("key"), F.lit(code).alias("code"))


def across_events(events: DataFrame, matches: DataFrame, intervals: DataFrame) -> DataFrame:
    """(match_id, key, code) of the rules that span the events of a selection."""
    order = Window.partitionBy("match_id").orderBy("source_record_index")
    event = c("source_event_id")
    twice = lambda keys: events.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_n > 1")
    sequence = events.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source_event_index").alias("d"), F.min("source_event_index").alias("low"), F.max("source_event_index").alias("high"))
    related = events.select("match_id", event.alias("_from"), F.explode("related_event_ids").alias("_to"))
    known = events.select("match_id", event.alias("_to")).distinct()
    squads = intervals.select("match_id", "player_id", c("team_id").alias("_team")).distinct()
    player = events.where("player_id is not null").join(squads, ["match_id", "player_id"])
    recipient = events.where("recipient_id is not null").join(squads.withColumnRenamed("player_id", "recipient_id"), ["match_id", "recipient_id"])
    pairs = Window.partitionBy("match_id", "possession_id")
    mixed = events.withColumn("_low", F.min("possession_team_id").over(pairs)).withColumn("_high", F.max("possession_team_id").over(pairs)).where("_low <> _high")
    parts = [
        _issue(twice(["source", "source_event_id"]), "duplicate_event_id", event),
        _issue(twice(["match_id", "source_event_index"]), "duplicate_event_index", event),
        _issue(events.withColumn("_b", F.lag("source_event_index").over(order)).where("_b >= source_event_index"), "event_indexes_not_ordered", event),
        _issue(sequence.where("n <> d or low <> 1 or high <> n"), "event_index_sequence_invalid", c("match_id")),
        _issue(mixed, "possession_team_inconsistent", event),
        _issue(player.where("_team <> team_id"), "player_team_mismatch", event),
        _issue(recipient.where("_team <> team_id"), "recipient_team_mismatch", event),
        _issue(events.where((c("event_type") != "pass") & (c("event_type") != "goalkeeper") & c("recipient_id").isNotNull()), "recipient_not_allowed", event),
        _issue(events.where(F.size(F.array_distinct("related_event_ids")) < F.size("related_event_ids")), "duplicate_related_event", event),
        _issue(events.where(F.array_contains("related_event_ids", event)), "related_event_self_reference", event),
        _issue(related.join(known, ["match_id", "_to"], "left_anti").withColumnRenamed("_from", "source_event_id"), "related_event_not_found", event),
        _issue(events.where(is_nil_uuid(event)), "uuid_nil", event),
        _issue(events.join(matches, "match_id", "left_anti"), "match_context_missing", event),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def across_lineups(intervals: DataFrame, matches: DataFrame) -> DataFrame:
    """(match_id, key, code) of the rules that span lineups."""
    teams = matches.select("match_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    listed = intervals.select("match_id", "team_id").distinct()
    records = intervals.select("match_id", "team_id", "source_record_index").distinct().groupBy("match_id", "team_id").agg(F.count(F.lit(1)).alias("n"))
    sides = intervals.groupBy("match_id", "player_id").agg(F.countDistinct("team_id").alias("n"))
    return (
        _issue(listed.join(teams, ["match_id", "team_id"], "left_anti"), "lineup_team_not_in_match", c("team_id"))
        .unionByName(_issue(records.where("n > 1"), "duplicate_team_lineup", c("team_id")))
        .unionByName(_issue(sides.where("n > 1"), "duplicate_lineup_player", c("player_id")))
        .unionByName(_issue(teams.join(listed, ["match_id", "team_id"], "left_anti"), "match_lineup_missing", c("team_id")))
    )


def across_frames(frames: DataFrame) -> DataFrame:
    twice = frames.groupBy("match_id", "source_event_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _issue(twice, "duplicate_three_sixty_event", c("source_event_id"))


def conversion_contract(events: DataFrame, intervals: DataFrame, frames: DataFrame) -> DataFrame:
    """(match_id, key, code, level) of what the conversion to actions asks of its input."""
    event = c("source_event_id")
    own = events.where(c("event_type").isin(*ACTIONABLE))
    order = Window.partitionBy("match_id").orderBy("period", "clock_ms", "source_event_index")
    teams = events.groupBy("match_id", "possession_id").agg(F.countDistinct("possession_team_id").alias("n")).where("n > 1")
    squads = intervals.select("match_id", "player_id").distinct()
    places = events.select("source_event_id", c("match_id").alias("_of")).distinct()
    framed = frames.select("match_id", "source_event_id").join(places, "source_event_id", "left")
    errors = [
        _issue(teams, "possession_team_inconsistent", c("possession_id")),
        _issue(own.withColumn("_b", F.lag("possession_id").over(order)).where("_b > possession_id"), "possession_order_invalid", event),
        _issue(events.select("match_id").distinct().join(intervals, "match_id", "left_anti"), "lineup_match_not_found", c("match_id")),
        _issue(own.where("player_id is not null").join(squads, ["match_id", "player_id"], "left_anti"), "event_player_missing_lineup_interval", event),
        _issue(own.where("recipient_id is not null").join(squads.withColumnRenamed("player_id", "recipient_id"), ["match_id", "recipient_id"], "left_anti"), "event_recipient_missing_lineup_interval", event),
        _issue(framed.where("_of is null"), "three_sixty_event_not_found", event),
        _issue(framed.where("_of <> match_id"), "three_sixty_match_mismatch", event),
    ]
    warnings = _issue(intervals.where("to_seconds < from_seconds or to_period < from_period"), "lineup_interval_reversed", c("player_id"))
    out = warnings.withColumn("level", F.lit("warning"))
    for part in errors:
        out = out.unionByName(part.withColumn("level", F.lit("error")))
    return out


def keys_reconciled(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with the side; empty when both agree."""
    both = a.select(*keys).withColumn("_a", F.lit(1)).join(b.select(*keys).withColumn("_b", F.lit(1)), keys, "full_outer")
    return both.where("_a is null or _b is null").select(*keys, F.when(c("_a").isNull(), "right").otherwise("left").alias("side"))


def single_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that should have one value, with how many they have, where it isn't one."""
    counts = rows.agg(*(F.countDistinct(x).alias(x) for x in columns))
    return counts.unpivot([], columns, "column", "values").where("values <> 1")


def adequacy(rows: DataFrame, targets: list[str], matches: int = 1500, competitions: int = 4, seasons: int = 6, split_matches: int = 75, positives: int = 250) -> DataFrame:
    """One row of gates and ``adequate``, which holds if all do."""
    per = rows.groupBy("split").agg(F.countDistinct("match_id").alias("m"), *(F.count_if(t).alias(t) for t in targets))
    total = rows.agg(F.countDistinct("match_id").alias("matches"), F.countDistinct("competition_id").alias("competitions"), F.countDistinct("competition_id", "season_id").alias("competition_seasons"))
    least = per.agg(F.count(F.lit(1)).alias("splits"), F.min("m").alias("least_split_matches"), *(F.min(t).alias(f"least_{t}") for t in targets))
    out = total.withColumn("_one", F.lit(1)).join(least.withColumn("_one", F.lit(1)), "_one").drop("_one")
    gates = [c("matches") >= matches, c("competitions") >= competitions, c("competition_seasons") >= seasons, c("splits") == 3, c("least_split_matches") >= split_matches, *(c(f"least_{t}") >= positives for t in targets)]
    adequate = gates[0]
    for gate in gates[1:]:
        adequate &= gate
    return out.withColumn("adequate", adequate)


def two_classes(rows: DataFrame, group: str, target: str) -> DataFrame:
    """Groups that lack a class."""
    return rows.groupBy(group).agg(F.countDistinct(target).alias("classes")).where("classes < 2")

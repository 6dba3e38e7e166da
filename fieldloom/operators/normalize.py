"""Typed events, lineup intervals and frames from raw JSON. The first failure of a record is its error code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import canonical, clock_ms, clock_seconds, uuid_text
from fieldloom.operators.rules import Rule, first_issue
from fieldloom.operators.vocabulary import CHANCE_FIELD, DETAIL_KEYS, ENDPOINT_TYPES, EVENT_TYPES, OUTCOME_IMPLICIT, OUTCOME_TYPES


class Json:
    """A variant at some place of a record, with strict tests of its JSON type (a boolean is no number)."""

    def __init__(self, v: Column) -> None:
        self.v = v
        self.kind = F.schema_of_variant(v)

    def at(self, path: str) -> Json:
        return Json(F.try_variant_get(self.v, path, "variant"))

    @property
    def absent(self) -> Column:
        return self.v.isNull() | (self.kind == "VOID")

    def _is(self, test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    @property
    def is_int(self) -> Column:
        return self._is(self.kind == "BIGINT")

    @property
    def is_number(self) -> Column:
        return self._is(self.kind.isin("BIGINT", "DOUBLE", "FLOAT") | self.kind.startswith("DECIMAL"))

    @property
    def is_text(self) -> Column:
        return self._is(self.kind == "STRING")

    @property
    def is_bool(self) -> Column:
        return self._is(self.kind == "BOOLEAN")

    @property
    def is_object(self) -> Column:
        return self._is(self.kind.startswith("OBJECT"))

    @property
    def is_array(self) -> Column:
        return self._is(self.kind.startswith("ARRAY"))

    def get(self, kind: str) -> Column:
        return F.try_variant_get(self.v, "$", kind)

    @property
    def items(self) -> Column:
        return F.when(self.is_array, self.get("array<variant>"))


def _points(value: Json) -> tuple[list[Rule], Column, Column]:
    """Rules and the first two numbers of a location; further numbers are let be."""
    size = F.size(value.items)
    x, y = Json(F.get(value.items, F.lit(0))), Json(F.get(value.items, F.lit(1)))
    rules = [
        ("malformed_coordinates", ~value.absent & (~value.is_array | (size < 2))),
        ("malformed_number", ~value.absent & (~x.is_number | ~y.is_number)),
    ]
    return rules, x.get("double") / 120 * 100, y.get("double") / 80 * 100


def _of_type(event_type: Column, types: tuple[str, ...], detail: dict[str, Json]) -> Json:
    """The detail object of an event's type."""
    return Json(reduce(lambda out, t: out.when(event_type == t, detail[t].v), types[1:], F.when(event_type == types[0], detail[types[0]].v)))


def events(raw: DataFrame) -> DataFrame:
    """Columns of ``schemas.EVENTS`` and error_code, null for good records."""
    v = Json(F.parse_json("payload"))
    rows = raw.withColumn("_v", v.v)
    v = Json(F.col("_v"))
    name = v.at("$.type.name")
    event_type = F.try_element_at(F.create_map(*[F.lit(x) for kv in EVENT_TYPES.items() for x in kv]), name.get("string"))
    rows = rows.withColumn("event_type", F.when(name.is_text, event_type))
    event_type = F.col("event_type")
    detail = _of_type(event_type, tuple(DETAIL_KEYS), {t: v.at(f"$['{k}']") for t, k in DETAIL_KEYS.items()})
    rows = rows.withColumn("_detail", detail.v)
    detail = Json(F.col("_detail"))
    has_detail = ~detail.absent

    team, player, possession_team = v.at("$.team"), v.at("$.player"), v.at("$.possession_team")
    subtype, body, recipient, outcome = (detail.at(f"$.{k}") for k in ("type", "body_part", "recipient", "outcome"))
    xg, duration, pattern, related = detail.at(f"$.{CHANCE_FIELD}"), v.at("$.duration"), v.at("$.play_pattern"), v.at("$.related_events")
    clock = v.at("$.timestamp")
    start_rules, x, y = _points(v.at("$.location"))
    end_rules, end_x, end_y = _points(detail.at("$.end_location"))
    ends = event_type.isin(*ENDPOINT_TYPES)
    integer = lambda key: [("malformed_integer", ~v.at(f"$.{key}").is_int)]

    def nested_name(value: Json) -> list[Rule]:
        text = value.at("$.name")
        return [("malformed_field", ~value.absent & (~value.is_object | ~text.is_text | canonical(text.get("string")).isNull()))]

    rules: list[Rule] = [
        ("unexpected_record_kind", F.col("kind") != "event"),
        ("malformed_uuid", ~v.at("$.id").is_text | uuid_text(v.at("$.id").get("string")).isNull()),
        *integer("index"),
        ("missing_required_field", ~team.is_object),
        ("malformed_integer", ~team.at("$.id").is_int),
        ("malformed_field", ~player.absent & ~player.is_object),
        ("malformed_integer", ~player.absent & ~player.at("$.id").absent & ~player.at("$.id").is_int),
        *integer("possession"),
        ("missing_required_field", ~possession_team.is_object),
        ("malformed_integer", ~possession_team.at("$.id").is_int),
        ("missing_required_field", ~v.at("$.type").is_object | ~name.is_text | (name.get("string") == "")),
        ("unknown_event_type", event_type.isNull()),
        ("malformed_event_detail", has_detail & ~detail.is_object),
        *nested_name(subtype),
        *nested_name(body),
        ("malformed_field", ~recipient.absent & ~recipient.is_object),
        ("malformed_integer", ~recipient.absent & ~recipient.at("$.id").is_int),
        *integer("period"),
        ("malformed_timestamp", ~clock.is_text | clock_ms(clock.get("string")).isNull()),
        *integer("minute"),
        *integer("second"),
        ("malformed_number", ~duration.absent & ~duration.is_number),
        *start_rules,
        *((code, ends & broken) for code, broken in end_rules),
        ("malformed_outcome", event_type.isin(*OUTCOME_TYPES) & ~outcome.absent & (~outcome.is_object | ~outcome.at("$.name").is_text | canonical(outcome.at("$.name").get("string")).isNull())),
        ("malformed_number", (event_type == "shot") & ~xg.absent & ~xg.is_number),
        ("missing_required_field", ~pattern.is_object | ~pattern.at("$.name").is_text | (pattern.at("$.name").get("string") == "")),
        ("malformed_field", canonical(pattern.at("$.name").get("string")).isNull()),
        *(("malformed_boolean", ~v.at(f"$.{k}").absent & ~v.at(f"$.{k}").is_bool) for k in ("under_pressure", "counterpress")),
        ("malformed_related_events", ~related.absent & ~related.is_array),
        ("malformed_uuid", F.exists(related.items, lambda e: ~Json(e).is_text | uuid_text(Json(e).get("string")).isNull())),
    ]
    text_of = lambda value: canonical(value.at("$.name").get("string"))
    said = F.when(event_type.isin(*OUTCOME_TYPES), F.coalesce(text_of(outcome), F.when(event_type.isin(*OUTCOME_IMPLICIT), "complete")))
    flag = lambda key: F.coalesce(v.at(f"$.{key}").get("boolean"), F.lit(False))
    ids = F.coalesce(F.transform(related.items, lambda e: uuid_text(Json(e).get("string"))), F.array().cast("array<string>"))
    return rows.select(
        "source",
        uuid_text(v.at("$.id").get("string")).alias("source_event_id"),
        "source_record_index",
        v.at("$.index").get("int").alias("source_event_index"),
        "match_id",
        team.at("$.id").get("bigint").alias("team_id"),
        player.at("$.id").get("bigint").alias("player_id"),
        v.at("$.possession").get("bigint").alias("possession_id"),
        possession_team.at("$.id").get("bigint").alias("possession_team_id"),
        "event_type",
        text_of(subtype).alias("event_subtype"),
        v.at("$.period").get("int").alias("period"),
        clock_ms(clock.get("string")).alias("clock_ms"),
        v.at("$.minute").get("int").alias("minute"),
        v.at("$.second").get("int").alias("second"),
        duration.get("double").alias("duration"),
        x.alias("x"),
        y.alias("y"),
        F.when(ends, end_x).alias("end_x"),
        F.when(ends, end_y).alias("end_y"),
        said.alias("outcome"),
        text_of(body).alias("body_part"),
        recipient.at("$.id").get("bigint").alias("recipient_id"),
        F.when(event_type == "shot", xg.get("double")).alias("xg"),
        text_of(pattern).alias("play_pattern"),
        flag("under_pressure").alias("under_pressure"),
        flag("counterpress").alias("counterpress"),
        ids.alias("related_event_ids"),
        F.col("payload").alias("raw_details"),
        first_issue(rules).alias("error_code"),
    )


def intervals(raw: DataFrame) -> DataFrame:
    """Columns of ``schemas.INTERVALS`` and error_code from lineup records: a row for each position of each player. One bad
    position rejects its whole record, which then gives one row with the code."""
    v = Json(F.parse_json("payload"))
    rows = raw.withColumn("_v", v.v)
    v = Json(F.col("_v"))
    lineup = v.at("$.lineup")
    player = lambda p: Json(p)
    positions = lambda p: player(p).at("$.positions")
    bad_clock = lambda c: ~Json(c).absent & (~Json(c).is_text | clock_seconds(Json(c).get("string")).isNull())

    def bad_position(q: Column) -> Column:
        q_ = Json(q)
        return ~q_.is_object | ~q_.at("$.position_id").is_int | ~q_.at("$.position").is_text | ~q_.at("$.from_period").is_int | (~q_.at("$.to_period").absent & ~q_.at("$.to_period").is_int)

    any_position = lambda test: F.exists(lineup.items, lambda p: F.coalesce(F.exists(positions(p).items, test), F.lit(False)))
    rules: list[Rule] = [
        ("unexpected_record_kind", F.col("kind") != "lineup"),
        ("malformed_integer", ~v.at("$.team_id").is_int),
        ("malformed_lineup", ~lineup.is_array),
        ("malformed_lineup_player", F.exists(lineup.items, lambda p: ~player(p).is_object | ~player(p).at("$.player_id").is_int | ~player(p).at("$.player_name").is_text)),
        ("malformed_positions", F.exists(lineup.items, lambda p: ~positions(p).absent & ~positions(p).is_array)),
        ("malformed_position", any_position(bad_position)),
        ("malformed_lineup_time", any_position(lambda q: Json(q).at("$.from").absent | bad_clock(Json(q).at("$.from").v) | bad_clock(Json(q).at("$.to").v))),
    ]
    rows = rows.withColumn("error_code", first_issue(rules))
    good = (
        rows.where("error_code is null")
        .select("source", "match_id", "source_record_index", v.at("$.team_id").get("bigint").alias("team_id"), F.explode(lineup.items).alias("_p"))
        .select("*", F.explode(Json(F.col("_p")).at("$.positions").items).alias("_q"))
    )
    p, q = Json(F.col("_p")), Json(F.col("_q"))
    good = good.select(
        "source",
        "match_id",
        "team_id",
        p.at("$.player_id").get("bigint").alias("player_id"),
        p.at("$.player_name").get("string").alias("player_name"),
        q.at("$.position_id").get("int").alias("position_id"),
        q.at("$.position").get("string").alias("position"),
        clock_seconds(q.at("$.from").get("string")).alias("from_seconds"),
        clock_seconds(q.at("$.to").get("string")).alias("to_seconds"),
        q.at("$.from_period").get("int").alias("from_period"),
        q.at("$.to_period").get("int").alias("to_period"),
        q.at("$.start_reason").get("string").alias("start_reason"),
        q.at("$.end_reason").get("string").alias("end_reason"),
        "source_record_index",
        F.lit(None).cast("string").alias("error_code"),
    )
    bad = rows.where("error_code is not null").select("source", "match_id", "source_record_index", "error_code")
    return good.unionByName(bad, allowMissingColumns=True)


def frames(raw: DataFrame) -> DataFrame:
    """source, match_id, source_event_id, visible_area, freeze_frame, source_record_index, error_code of frame records."""
    v = Json(F.parse_json("payload"))
    rows = raw.withColumn("_v", v.v)
    v = Json(F.col("_v"))
    area, frame = v.at("$.visible_area"), v.at("$.freeze_frame")
    flags = ("teammate", "actor", "keeper")
    rules: list[Rule] = [
        ("unexpected_record_kind", F.col("kind") != "three_sixty"),
        ("malformed_uuid", ~v.at("$.event_uuid").is_text | uuid_text(v.at("$.event_uuid").get("string")).isNull()),
        ("malformed_visible_area", ~area.is_array | F.exists(area.items, lambda e: ~Json(e).is_number)),
        ("malformed_freeze_frame", ~frame.is_array),
        ("malformed_freeze_frame_player", F.exists(frame.items, lambda e: ~Json(e).is_object)),
    ]

    def player(e: Column) -> Column:
        location = Json(e).at("$.location")
        number = lambda i: F.when(F.size(location.items) >= 2, Json(F.get(location.items, F.lit(i))).get("double"))
        return F.struct(*(Json(e).at(f"$.{k}").get("boolean").alias(k) for k in flags), number(0).alias("x"), number(1).alias("y"))

    return rows.select(
        "source",
        "match_id",
        uuid_text(v.at("$.event_uuid").get("string")).alias("source_event_id"),
        F.transform(area.items, lambda e: Json(e).get("double")).alias("visible_area"),
        F.transform(frame.items, player).alias("freeze_frame"),
        "source_record_index",
        first_issue(rules).alias("error_code"),
    )

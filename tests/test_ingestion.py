"""Raw JSON to typed, validated tables, and incremental loads."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import hashing, text
from fieldloom.operators import actions, features, normalize, rules, snapshots, validation
from fieldloom.operators.vocabulary import CHANCE_FIELD
from fieldloom.sources import json_arrays, tables

ID = "13b63722-8099-4cdf-818a-d2df3036a63{}"


def event(i: int, **more) -> dict:
    base = {
        "id": ID.format(i), "index": i, "period": 1, "timestamp": "00:00:10.000", "minute": 0, "second": 10, "type": {"id": 30, "name": "Pass"}, "possession": 1,
        "possession_team": {"id": 10, "name": "Home"}, "play_pattern": {"id": 1, "name": "Regular Play"}, "team": {"id": 10, "name": "Home"}, "player": {"id": 100, "name": "P"},
        "location": [60.0, 20.0], "pass": {"recipient": {"id": 101, "name": "R"}, "end_location": [83.9, 45.0], "body_part": {"id": 40, "name": "Right Foot"}},
    }
    return {k: v for k, v in (base | more).items() if v is not ...}


def raw(spark, payloads, kind="event"):
    return spark.createDataFrame([(kind, "raw", 1001, "f", i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], "kind string, source string, match_id long, source_file string, source_record_index int, payload string")


def codes(spark, *payloads):
    return [r.error_code for r in normalize.events(raw(spark, payloads)).orderBy("source_record_index").collect()]


def test_good_event(spark):
    r = normalize.events(raw(spark, [event(1)])).head()
    assert r.error_code is None and r.event_type == "pass" and r.outcome == "complete" and r.body_part == "right_foot"
    assert (r.x, r.y) == pytest.approx((50.0, 25.0)) and (r.end_x, r.end_y) == pytest.approx((69.9167, 56.25), abs=1e-4)
    assert (r.recipient_id, r.clock_ms, r.under_pressure, list(r.related_event_ids)) == (101, 10_000, False, [])


def test_first_failure_wins(spark):
    assert codes(
        spark,
        event(1, id=7),
        event(2, index=True),
        event(3, team=...),
        event(4, type={"name": "Juggling"}),
        event(5, location=[1.0]),
        event(6, location=["a", 2.0]),
        event(7, timestamp="25:00:00"),
        event(8, under_pressure=1),
        event(9, related_events=["x"]),
        event(0, **{"pass": 3}),
        event(1, **{"pass": {"outcome": {"name": 5}}}),
        event(2, minute=1.5),
        event(3, play_pattern={"name": "***"}),
    ) == ["malformed_uuid", "malformed_integer", "missing_required_field", "unknown_event_type", "malformed_coordinates", "malformed_number", "malformed_timestamp", "malformed_boolean", "malformed_uuid", "malformed_event_detail", "malformed_outcome", "malformed_integer", "malformed_field"]


def test_shot_of_the_worked_example(spark):
    shot = {"end_location": [120.0, 43.3, 1.4], "outcome": {"name": "Goal"}, CHANCE_FIELD: 0.024477394}
    r = normalize.events(raw(spark, [event(1, type={"name": "Shot"}, shot=shot, **{"pass": ...})])).head()
    assert r.outcome == "goal"
    assert (r.end_x, r.end_y, r.xg) == pytest.approx((100.0, 54.125, 0.024477394))


def test_canonical_text_clock_and_uuid(spark):
    df = spark.createDataFrame([("Ball Receipt*", "64:10", "{13B63722-8099-4cdf-818A-d2df3036a633}"), ("***", "1:60", "x")], "a string, b string, c string")
    got = df.select(text.canonical(F.col("a")).alias("a"), text.clock_seconds(F.col("b")).alias("b"), text.uuid_text(F.col("c")).alias("c")).collect()
    assert tuple(got[0]) == ("ball_receipt", 3850, "13b63722-8099-4cdf-818a-d2df3036a633") and tuple(got[1]) == (None, None, None)


MATCHES = "match_id long, home_team_id long, away_team_id long"
INTERVALS = "source string, match_id long, team_id long, player_id long, from_period int, to_period int, from_seconds int, to_seconds int, source_record_index int"


def issues_of(spark, *payloads):
    typed = normalize.events(raw(spark, payloads)).drop("error_code")
    matches = spark.createDataFrame([(1001, 10, 20)], MATCHES)
    lineups = spark.createDataFrame([("raw", 1001, 10, p, 1, None, 0, None, 0) for p in (100, 101)], INTERVALS)
    return [r.issues for r in validation.validated_events(typed, matches, lineups).orderBy("source_record_index").collect()]


def test_event_rules(spark):
    got = issues_of(
        spark,
        event(1),
        event(2, team={"id": 30}),
        event(3, player={"id": 999}),
        event(4, minute=3),
        event(5, location=[130.0, 20.0]),
        event(6, **{"pass": {}}),
        event(7, type={"name": "Pressure"}, player=..., **{"pass": ...}),
        event(8, type={"name": "Shot"}, **{"pass": ...}, shot={"outcome": {"name": "Saved"}, "end_location": [1, 2]}),
        event(9, period=7),
    )
    assert got == [[], ["team_not_in_match"], ["player_not_in_match_lineup"], ["time_fields_inconsistent"], ["start_x_out_of_range"], ["endpoint_required"], ["player_required"], ["xg_required"], ["period_invalid"]]


def test_rules_across_events(spark):
    other = event(2, related_events=[ID.format(2), ID.format(9), ID.format(9)], possession_team={"id": 20})
    typed = normalize.events(raw(spark, [event(1), other, event(4, index=1)])).drop("error_code")
    matches = spark.createDataFrame([(1001, 10, 20)], MATCHES)
    lineups = spark.createDataFrame([("raw", 1001, 20, 100, 1, None, 0, None, 0)], INTERVALS)
    found = {r.code for r in validation.across_events(typed, matches, lineups).collect()}
    assert {"duplicate_event_index", "event_index_sequence_invalid", "possession_team_inconsistent", "duplicate_related_event", "related_event_self_reference", "related_event_not_found", "player_team_mismatch", "event_indexes_not_ordered"} <= found


def test_severity_and_report(spark):
    found = spark.createDataFrame([(1, "period_invalid"), (2, "related_event_not_found")], "match_id long, code string")
    totals, rows = rules.report(found, most=1)
    assert tuple(totals.head()) == (2, 1, True) and rows.count() == 1
    assert [r.match_id for r in rules.blocked(found, ["match_id"]).collect()] == [1]


def test_lineups_and_frames(spark):
    position = {"position_id": 21, "position": "Left Wing", "from": "64:10", "to": None, "from_period": 2, "to_period": None}
    good = {"team_id": 10, "lineup": [{"player_id": 1, "player_name": "A", "positions": [position]}]}
    bad = {"team_id": 20, "lineup": [{"player_id": 2, "player_name": "B", "positions": [position | {"from": "1:75"}]}]}
    rows = normalize.intervals(raw(spark, [good, bad], "lineup")).orderBy("source_record_index").collect()
    assert [(r.from_seconds, r.to_seconds, r.error_code) for r in rows] == [(3850, None, None), (None, None, "malformed_lineup_time")]
    frame = {"event_uuid": ID.format(1), "visible_area": [0, 0, 120, 0, 120, 80, 0, 80], "freeze_frame": [{"teammate": False, "actor": True, "keeper": False, "location": [108, 40]}, {"teammate": True, "actor": False, "keeper": False, "location": [100, 40]}, {"teammate": False, "actor": False, "keeper": False, "location": [109, 40]}]}
    frames = normalize.frames(raw(spark, [frame], "three_sixty"))
    assert frames.head().error_code is None
    acts = spark.createDataFrame([(1001, 0, 10, ID.format(1), 94.5, 34.0, 105.0, 34.0), (1001, 1, 10, None, 1.0, 1.0, 2.0, 2.0)], "match_id long, action_id long, team_id long, source_event_id string, start_x double, start_y double, end_x double, end_y double")
    got = features.with_frames(acts, frames, spark.createDataFrame([(1001, 10, 20)], MATCHES)).orderBy("action_id").collect()
    assert (got[0].has_360, got[0].visible_teammates, got[0].visible_opponents, got[0].pressure_around_ball, got[0].goal_visible) == (True, 1, 1, 1, True)
    assert got[0].visible_goal_angle > 0 and got[1].has_360 is False and got[1].goal_visible is None


def test_json_array_reader(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([event(1), 3]))
    (tmp_path / "2.json").write_text("{}")
    (tmp_path / "3.json").write_text("[nope")
    rows = json_arrays.raw_records(spark, str(tmp_path), "event", "raw").orderBy("match_id", "source_record_index").collect()
    assert [(r.match_id, r.source_record_index, r.read_error) for r in rows] == [(1, 0, None), (1, 1, "object_required"), (2, None, "array_required"), (3, None, "json_invalid")]


def test_conversion_splits_interceptions(spark):
    pressure = event(2, index=2, type={"name": "Pressure"}, timestamp="00:00:11.000", second=11, **{"pass": ...})
    steal = event(3, index=3, timestamp="00:00:12.000", second=12, **{"pass": {"type": {"name": "Interception"}, "end_location": [62.0, 20.0]}})
    typed = normalize.events(raw(spark, [event(1, **{"pass": {"end_location": [60.0, 20.0]}}), pressure, steal])).drop("error_code")
    got = actions.convert(typed, spark.createDataFrame([(1001, 10, 20)], MATCHES)).orderBy("action_id").collect()
    assert [(r.type_name, r.action_id, r.source_action_index) for r in got] == [("pass", 0, 0), ("interception", 1, 0), ("pass", 2, 1)]
    assert (got[0].start_x, got[0].start_y) == pytest.approx(((60 - 0.05) / 120 * 105, 68 - (20 - 0.05) / 80 * 68))
    assert [r.reason for r in actions.exclusions(typed).collect()] == ["non_action:pressure"]
    assert actions.broken(actions.convert(typed, spark.createDataFrame([(1001, 10, 20)], MATCHES))).count() == 0



def test_features_count_and_guard(spark):
    assert len(features.names()) == features.FEATURE_COUNT
    assert features.allowlist_faults(["match_id", "action_id", *features.names()]) == []
    assert features.allowlist_faults([*features.names(), "scores", "dx_a3"])


def test_snapshot_diff_and_merge(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "match_id long, content_hash string")
    new = spark.createDataFrame([(2, "b"), (3, "x"), (4, "d")], "match_id long, content_hash string")
    got = {r.match_id: r.status for r in snapshots.snapshot_diff(new, old, ["match_id"]).collect()}
    assert got == {1: "removed", 2: "unchanged", 3: "changed", 4: "new"}


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "match_id long, k long, v string")
    count = lambda d: {r.change: r.n for r in d.collect()}
    assert count(tables.upsert(spark, path, rows, ["match_id", "k"], "match_id")) == {"inserted": 3}
    assert count(tables.upsert(spark, path, rows.where("match_id = 1"), ["match_id", "k"], "match_id")) == {"updated": 2}
    assert spark.read.parquet(path).count() == 3


def test_soft_delete(spark):
    rows = spark.createDataFrame([(1, True, None, None), (2, True, None, None)], "match_id long, is_active boolean, removed_at timestamp, removed_ingestion_run_id long")
    got = {r.match_id: r for r in snapshots.softly_deleted(rows, rows.where("match_id = 2"), ["match_id"], F.lit(7).cast("long"), F.current_timestamp()).collect()}
    assert got[1].is_active and not got[2].is_active and got[2].removed_ingestion_run_id == 7


def test_one_to_one_refuses_doubles(spark):
    a = spark.createDataFrame([(1, 1), (1, 2)], "k long, v long")
    with pytest.raises(Exception, match="twice"):
        snapshots.one_to_one(a, a.limit(1), ["k"]).collect()


def test_json_digest(spark):
    rows = spark.createDataFrame([('{"a": 1, "b": [1, 2]}',), ('{"b":[1,2],"a":1}',), ('{"b":[2,1],"a":1}',), (None,)], "t string")
    got = [r.d for r in rows.select(hashing.json_digest("t").alias("d")).collect()]
    assert got[0] == got[1] != got[2] and got[3] is None

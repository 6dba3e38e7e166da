"""Hand-calculated numbers of the order-sensitive core."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import labels, players, splits, states, valuation
from fieldloom.plans.adapters import actions_from_events

def home():
    return F.col("team_id") == 10


def four_events(spark):
    rows = [(1, 0, 1, 10, 1.0, 1, 10, False, False), (1, 1, 1, 10, 2.0, 1, 10, True, False), (1, 2, 1, 20, 3.0, 2, 20, False, False), (1, 3, 1, 20, 20.0, 2, 20, False, True), (2, 0, 5, 10, 1.0, 1, 10, True, False)]
    return spark.createDataFrame(rows, "match_id long, action_id long, period int, team_id long, time_seconds double, possession_id long, possession_team_id long, goal boolean, own boolean")


def test_running_score_and_possession(spark):
    rows = states.running_score(four_events(spark), home(), F.col("goal"), F.col("own"))
    rows = states.possession_changed(rows, ["possession_id", "possession_team_id"]).orderBy("match_id", "action_id").collect()
    assert [(r.home_score, r.away_score) for r in rows] == [(0, 0), (1, 0), (1, 0), (2, 0), (0, 0)]
    assert [r.score_diff for r in rows] == [0, 1, -1, -2, 0]
    assert [r.possession_changed for r in rows] == [False, False, True, False, False]


def test_game_states_stay_in_match_and_period(spark):
    rows = states.game_states(four_events(spark), ["time_seconds", "team_id"]).orderBy("match_id", "action_id").collect()
    assert [r.time_seconds_a1 for r in rows] == [1.0, 1.0, 2.0, 3.0, 1.0]
    assert [r.time_seconds_a2 for r in rows] == [1.0, 1.0, 1.0, 2.0, 1.0]


def test_the_future_cannot_change_a_row(spark):
    whole = four_events(spark).where("match_id = 1")
    cut = whole.where("action_id < 3")
    view = lambda d: states.game_states(states.running_score(d, home(), F.col("goal"), F.col("own")), ["team_id", "time_seconds"]).where("action_id < 3").orderBy("action_id").collect()
    assert view(whole) == view(cut)


def test_contiguity_and_order(spark):
    rows = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (2, 1, 1), (3, 0, 1), (3, 0, 2)], "match_id long, action_id long, o int")
    assert {r.match_id for r in states.contiguous(rows).collect()} == {2, 3}
    assert [r.match_id for r in states.increasing(rows, "o").collect()] == [3]


def test_provenance_takes_the_next_then_the_last(spark):
    rows = spark.createDataFrame([(1, 0, None), (1, 1, "a"), (1, 2, None), (1, 3, "b"), (1, 4, None)], "match_id long, action_id long, s string")
    assert [r.f for r in states.filled_provenance(rows, "s", "f").orderBy("action_id").collect()] == ["a", "a", "b", "b", "b"]


def goals(spark, rows):
    return spark.createDataFrame(rows, "match_id long, action_id long, period int, team_id long, type_name string, result_name string")


def labelled(df):
    goal, own = labels.goal_flags(F.col("type_name"), F.col("result_name"))
    return labels.labels(df, F.col("team_id") == 1, goal, own)


def test_label_window_and_match_end(spark):
    rows = [(1, i, 1, 1, "pass", "success") for i in range(10)] + [(1, 10, 1, 1, "shot", "success"), (2, 0, 1, 1, "pass", "success")]
    got = {(r.match_id, r.action_id): r.scores for r in labelled(goals(spark, rows)).collect()}
    assert not got[1, 0] and got[1, 1] and got[1, 10] and not got[2, 0]


def test_own_goal_and_shootout(spark):
    got = labelled(goals(spark, [(1, 0, 1, 1, "pass", "success"), (1, 1, 1, 1, "shot", "owngoal"), (1, 2, 5, 2, "shot_penalty", "success")])).orderBy("action_id").collect()
    assert [(r.scores, r.concedes) for r in got] == [(False, True), (False, True), (None, None)]
    assert (got[2].eligible, got[2].reason) == (False, "penalty_shootout")


def test_labels_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(m, i, rng.randint(1, 5), rng.randint(1, 2), rng.choice(["pass", "shot"]), rng.choice(["success", "owngoal", "fail", "fail"])) for m in range(6) for i in range(40)]
    got = {(r.match_id, r.action_id): (r.scores, r.concedes) for r in labelled(goals(spark, rows)).collect()}
    for m in range(6):
        live = [r for r in rows if r[0] == m and r[2] != 5]
        for k, r in enumerate(live):
            credit = [3 - x[3] if x[5] == "owngoal" else x[3] for x in live[k : k + 10] if x[4] == "shot" and x[5] in ("success", "owngoal")]
            assert got[m, r[1]] == (r[3] in credit, 3 - r[3] in credit)


def test_audit_merges(spark):
    rows = labelled(goals(spark, [(m, i, 1, 1 + i % 2, "shot" if i % 7 == 0 else "pass", "success") for m in range(4) for i in range(30)]))
    whole, parts = labels.audit(rows, []).head(), labels.merged_audit(labels.audit(rows, ["match_id"]), []).head()
    assert whole.asDict() == parts.asDict()


VALUES = [(0, 10, 0, "pass", 0.10, 0.20), (1, 10, 5, "pass", 0.20, 0.10), (2, 20, 6, "pass", 0.30, 0.40), (3, 20, 20, "pass", 0.25, 0.15), (4, 20, 21, "shot", 0.99, 0.01), (5, 10, 22, "pass", 0.05, 0.05), (6, 10, 23, "shot_penalty", 0.80, 0.02), (7, 10, 24, "corner_short", 0.10, 0.03)]


def test_action_values(spark):
    rows = spark.createDataFrame([(1, i, t, float(s), k, "success", p, c) for i, t, s, k, p, c in VALUES], "match_id long, action_id long, team_id long, time_seconds double, type_name string, result_name string, p_score double, p_concede double")
    got = valuation.football_values(rows).orderBy("action_id").collect()
    assert [r.score_before for r in got] == pytest.approx([0.10, 0.10, 0.10, 0, 0.25, 0, 0.792453, 0.0465])
    assert [r.concede_before for r in got] == pytest.approx([0.20, 0.20, 0.20, 0, 0.15, 0, 0.05, 0])
    assert (got[2].offensive, got[2].defensive) == pytest.approx((0.20, -0.20))
    assert valuation.faults(valuation.football_values(rows)).count() == 0


def test_own_goal_does_not_reset(spark):
    rows = spark.createDataFrame([(1, 0, 10, 0.0, "pass", "owngoal", 0.1, 0.2), (1, 1, 20, 1.0, "pass", "success", 0.3, 0.4)], "match_id long, action_id long, team_id long, time_seconds double, type_name string, result_name string, p_score double, p_concede double")
    got = valuation.football_values(rows).orderBy("action_id").collect()[1]
    assert (got.score_before, got.concede_before) == pytest.approx((0.2, 0.1))


def test_what_stands_before_is_what_is_subtracted(spark):
    rows = spark.createDataFrame([(1, 0, 10, 0.0, "pass", "success", 1.25, -0.25), (1, 1, 10, 1.0, "pass", "success", 0.5, 0.5), (2, 0, 10, 0.0, "pass", "success", 1.25, -0.25), (2, 1, 20, 1.0, "pass", "success", 0.5, 0.5), (3, 0, 10, 0.0, "pass", "success", None, None)], "match_id long, action_id long, team_id long, time_seconds double, type_name string, result_name string, p_score double, p_concede double")
    valued = valuation.football_values(rows)
    got = {(r.match_id, r.action_id): (r.score_before, r.concede_before, r.offensive, r.defensive) for r in valued.collect()}
    assert got[1, 1] == (1.25, -0.25, -0.75, -0.75)
    assert got[2, 1] == (-0.25, 1.25, 0.75, 0.75)
    assert got[3, 0] == (None, None, None, None)
    assert valuation.faults(valued).count() == 5


def test_what_the_predecessor_lacks_is_the_actions_own(spark):
    rows = [(0, None, 0.0, 0.25, 0.5, False), (1, 10, 1.0, None, None, None), (2, 20, 2.0, 0.125, 0.75, True), (3, 20, None, 0.5, 0.25, False)]
    rows = spark.createDataFrame([(1, *r) for r in rows], "match_id long, action_id long, team_id long, time_seconds double, p_score double, p_concede double, goal boolean")
    got = valuation.values(rows, F.col("goal"), F.lit(False), F.lit(False)).orderBy("action_id").collect()
    assert [(r.score_before, r.concede_before) for r in got] == [(0.5, 0.25), (0.25, 0.5), (0.0, 0.0), (0.0, 0.0)]


def test_actions_without_a_time_come_last(spark):
    rows = spark.sql("select * from values (1L, null, 7L, 'view', 1.0d, '{}'), (2L, timestamp_ntz'2024-01-01 00:00:00', 7L, 'view', 1.0d, '{}') as e(event_id, ts, user_id, event_type, value, props)")
    assert [r.event_id for r in actions_from_events(rows).orderBy("action_id").collect()] == [2, 1]


def test_six_matches_split_four_one_one(spark):
    rows = spark.createDataFrame([(i, 1, 1, f"2022-01-{7 - i:02d}", "12:00:00") for i in range(1, 7)], "match_id long, competition_id long, season_id long, d string, kick_off string").withColumn("match_date", F.to_date("d"))
    got = splits.chronological(rows).orderBy("split_order").collect()
    assert [r.match_id for r in got] == [6, 5, 4, 3, 2, 1]
    assert [r.split for r in got] == ["train"] * 4 + ["validation", "test"]
    with pytest.raises(Exception, match="three matches"):
        splits.chronological(rows.limit(2)).collect()


def test_split_sizes_of_the_published_dataset(spark):
    got = spark.range(1831).select(splits.split_of(F.col("id"), F.lit(1831)).alias("s")).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"train": 1281, "validation": 275, "test": 275}


LINEUPS = "match_id long, player_id long, team_id long, position string, from_seconds int, to_seconds int"


def test_minutes(spark):
    rows = spark.createDataFrame([(1, 1, 10, "Wing", 0, 3600), (1, 2, 10, "Wing", 3600, None), (1, 3, 10, "CB", 0, 2700), (1, 3, 10, "RB", 2700, None), (1, 4, 10, "CB", 500, 100), (1, 4, 10, "CB", 0, 60)], LINEUPS)
    got = {r.player_id: (r.minutes, r.position) for r in players.player_minutes(rows, spark.createDataFrame([(1, 95 * 60)], "match_id long, duration int")).collect()}
    assert got == {1: (60.0, "Wing"), 2: (35.0, "Wing"), 3: (95.0, "RB"), 4: (1.0, "CB")}


def test_match_duration(spark):
    rows = spark.createDataFrame([(1, 2, 94, 30), (1, 5, 121, 10)], "match_id long, period int, minute int, second int")
    assert players.match_seconds(rows).head().duration == 5670
    with pytest.raises(Exception, match="duration"):
        players.match_seconds(rows.where("period = 5")).collect()


def test_interval_union_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, a, a + rng.randint(1, 30)) for k in range(20) for a in (rng.randint(0, 200) for _ in range(12))]
    got = {r.k: r.seconds for r in players.union_seconds(spark.createDataFrame(rows, "k int, start int, end int"), ["k"]).collect()}
    assert got == {k: len({s for x, a, b in rows if x == k for s in range(a, b)}) for k in range(20)}


def test_unknown_times_and_positions_come_last(spark):
    rows = spark.createDataFrame([(1, "A", None, None), (1, "B", 0, 5), (2, None, 0, 5), (2, "C", 5, 10), (3, "D", None, None), (4, None, 0, 9), (4, "E", 0, 5)], "k int, position string, start int, end int")
    assert {r.k: r.position for r in players.primary_position(rows, ["k"]).collect()} == {1: "B", 2: "C", 3: "D", 4: None}


def test_player_aggregates(spark):
    values = spark.createDataFrame([(1, 1, 1, p, 10, "pass", 0.1, 0.1, 0.2) for p in (1, 1, 2, None)], "match_id long, competition_id long, season_id long, player_id long, team_id long, type_name string, offensive double, defensive double, vaep double")
    minutes = spark.createDataFrame([(1, 1, 10, 90.0, "CB")], "match_id long, player_id long, team_id long, minutes double, position string")
    rows = players.aggregates(values, minutes, 60.0).where("action_type = 'all' and level = 'match'").collect()
    got = {r.player_id: r for r in rows}
    assert (got[1].actions, got[1].vaep, got[1].vaep_per_90, got[1].eligible) == (2, pytest.approx(0.4), pytest.approx(0.4), True)
    assert (got[2].position, got[2].vaep_per_90, got[2].eligible) == ("Unknown", None, False)
    total = players.reconciliation(values, minutes).head()
    assert (total.unknown, total.without_minutes) == (1, 1)
    assert players.duplicate_keys(players.aggregates(values, minutes), ["level", "match_id", "season_id", "player_id", "team_id", "position", "action_type"]).count() == 0

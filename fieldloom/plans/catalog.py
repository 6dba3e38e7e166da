"""The driver's queries over the engine's operators, each with DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom.functions import geometry, hashing, text
from fieldloom.operators import labels, metrics, normalize, players, rules, snapshots, splits, states, validation, valuation
from fieldloom.plans.adapters import ACTIONS_SQL, GAP, actions_from_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions_from_events(table(spark, sf_dir, "events"))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


W = "PARTITION BY match_id ORDER BY action_id"
SO_FAR = f"OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(
    "running_score",
    f"""WITH {ACTIONS_SQL}, s AS (SELECT *,
      sum(CASE WHEN period <> 5 AND ((goal AND team_id = 0) OR (own_goal AND team_id <> 0)) THEN 1 ELSE 0 END) {SO_FAR} AS h,
      sum(CASE WHEN period <> 5 AND ((goal AND team_id <> 0) OR (own_goal AND team_id = 0)) THEN 1 ELSE 0 END) {SO_FAR} AS a FROM actions)
    SELECT match_id, action_id, CAST(h AS BIGINT) AS home_score, CAST(a AS BIGINT) AS away_score,
      CAST(CASE WHEN team_id = 0 THEN h ELSE a END AS BIGINT) AS score_for, CAST(CASE WHEN team_id = 0 THEN a ELSE h END AS BIGINT) AS score_against,
      CAST(CASE WHEN team_id = 0 THEN h - a ELSE a - h END AS BIGINT) AS score_diff FROM s""",
)
def running_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = states.running_score(actions(spark, sf_dir), F.col("team_id") == 0, F.col("goal"), F.col("own_goal"))
    return rows.select("match_id", "action_id", "home_score", "away_score", "score_for", "score_against", "score_diff")


@query(
    "possession_change",
    f"""WITH {ACTIONS_SQL} SELECT match_id, action_id,
      coalesce(row(team_id, type_name) <> lag(row(team_id, type_name)) OVER ({W}), false) AS possession_changed FROM actions""",
)
def possession_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.possession_changed(actions(spark, sf_dir), ["team_id", "type_name"]).select("match_id", "action_id", "possession_changed")


_P = "PARTITION BY match_id, period ORDER BY action_id"


@query(
    "gamestate_lag3",
    f"""WITH {ACTIONS_SQL} SELECT match_id, action_id, type_name AS type_name_a0, value AS value_a0,
      coalesce(lag(type_name, 1) OVER ({_P}), first_value(type_name) OVER ({_P})) AS type_name_a1,
      coalesce(lag(value, 1) OVER ({_P}), first_value(value) OVER ({_P})) AS value_a1,
      coalesce(lag(type_name, 2) OVER ({_P}), first_value(type_name) OVER ({_P})) AS type_name_a2,
      coalesce(lag(value, 2) OVER ({_P}), first_value(value) OVER ({_P})) AS value_a2 FROM actions""",
)
def gamestate_lag3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = states.game_states(actions(spark, sf_dir), ["type_name", "value"])
    return rows.select("match_id", "action_id", *(f"{c}_a{k}" for c in ("type_name", "value") for k in range(3)))


_LABELS = """lab AS (SELECT *,
      max(CASE WHEN (goal AND team_id = 0) OR (own_goal AND team_id <> 0) THEN 1 ELSE 0 END) OVER w AS h,
      max(CASE WHEN (goal AND team_id <> 0) OR (own_goal AND team_id = 0) THEN 1 ELSE 0 END) OVER w AS a
    FROM actions WHERE period <> 5 WINDOW w AS (PARTITION BY match_id ORDER BY action_id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
  labelled AS (SELECT a.match_id, a.action_id, a.period, a.team_id, a.type_name, a.goal, a.own_goal, a.p_score,
      CASE WHEN a.team_id = 0 THEN l.h ELSE l.a END = 1 AS scores, CASE WHEN a.team_id = 0 THEN l.a ELSE l.h END = 1 AS concedes,
      a.period <> 5 AS eligible, CASE WHEN a.period = 5 THEN 'penalty_shootout' END AS reason
    FROM actions a LEFT JOIN lab l USING (match_id, action_id))"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.labels(actions(spark, sf_dir), F.col("team_id") == 0, F.col("goal"), F.col("own_goal"))


@query("label_scores_concedes", f"WITH {ACTIONS_SQL}, {_LABELS} SELECT match_id, action_id, scores, concedes, eligible, reason FROM labelled")
def label_scores_concedes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("match_id", "action_id", "scores", "concedes", "eligible", "reason")


_AUDIT = """count(*) AS actions, count(CASE WHEN eligible THEN 1 END) AS eligible, count(CASE WHEN scores THEN 1 END) AS scores, count(CASE WHEN concedes THEN 1 END) AS concedes,
      round(avg(CAST(CAST(scores AS INTEGER) AS DOUBLE)), 12) AS scores_rate, round(avg(CAST(CAST(concedes AS INTEGER) AS DOUBLE)), 12) AS concedes_rate"""


@query(
    "target_audit",
    f"""WITH {ACTIONS_SQL}, {_LABELS} SELECT CAST(match_id AS VARCHAR) AS match_id, {_AUDIT} FROM labelled GROUP BY match_id
      UNION ALL SELECT 'all', {_AUDIT} FROM labelled""",
)
def target_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(spark, sf_dir)
    return labels.audit(rows, ["match_id"]).withColumn("match_id", F.col("match_id").cast("string")).unionByName(labels.audit(rows, []).withColumn("match_id", F.lit("all")))


@query(
    "target_audit_merged",
    f"""WITH {ACTIONS_SQL}, {_LABELS} SELECT period, CAST(count(*) AS BIGINT) AS actions, count(CASE WHEN eligible THEN 1 END) AS eligible,
      count(CASE WHEN scores THEN 1 END) AS scores, count(CASE WHEN concedes THEN 1 END) AS concedes,
      round(count_if(scores) / nullif(count_if(eligible), 0), 12) AS scores_rate, round(count_if(concedes) / nullif(count_if(eligible), 0), 12) AS concedes_rate
      FROM labelled GROUP BY period""",
)
def target_audit_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.merged_audit(labels.audit(labelled(spark, sf_dir), ["match_id", "period"]), ["period"])


@query(
    "target_cohorts",
    f"""WITH {ACTIONS_SQL}, {_LABELS}, c AS (SELECT *, row_number() OVER ({W}) = 1 AS f, row_number() OVER (PARTITION BY match_id ORDER BY action_id DESC) = 1 AS l,
        coalesce(lead(period) OVER ({W}) <> period, false) AS b FROM labelled),
      x AS (SELECT 'first' AS cohort, * FROM c WHERE f UNION ALL SELECT 'last', * FROM c WHERE l UNION ALL SELECT 'goal', * FROM c WHERE goal
        UNION ALL SELECT 'own_goal', * FROM c WHERE own_goal UNION ALL SELECT 'period_boundary', * FROM c WHERE b)
      SELECT cohort, {_AUDIT} FROM x GROUP BY cohort""",
)
def target_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = states.period_boundary(states.first_and_last(labelled(spark, sf_dir)))
    return labels.cohorts(rows, {"first": F.col("is_first"), "last": F.col("is_last"), "goal": F.col("goal"), "own_goal": F.col("own_goal"), "period_boundary": F.col("period_boundary")})


_VALUES = f"""prev AS (SELECT *, coalesce(lag(team_id) OVER ({W}), team_id) AS bt, coalesce(lag(time_seconds) OVER ({W}), time_seconds) AS bs,
      coalesce(lag(p_score) OVER ({W}), p_score) AS bps, coalesce(lag(p_concede) OVER ({W}), p_concede) AS bpc,
      coalesce(lag(goal) OVER ({W}), goal) AS bg FROM actions),
  vals AS (SELECT *, CASE WHEN abs(time_seconds - bs) > {GAP} OR bg THEN 0.0 WHEN team_id = bt THEN bps ELSE bpc END AS score_before,
      CASE WHEN abs(time_seconds - bs) > {GAP} OR bg THEN 0.0 WHEN team_id = bt THEN bpc ELSE bps END AS concede_before FROM prev)"""


def valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.lit(False)
    return valuation.values(actions(spark, sf_dir), F.col("goal"), no, no, GAP)


@query(
    "vaep_action_values",
    f"""WITH {ACTIONS_SQL}, {_VALUES} SELECT match_id, action_id, round(score_before, 9) AS score_before, round(concede_before, 9) AS concede_before,
      round(p_score - score_before, 9) AS offensive, round(concede_before - p_concede, 9) AS defensive,
      round((p_score - score_before) + (concede_before - p_concede), 9) AS vaep FROM vals""",
)
def vaep_action_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valued(spark, sf_dir).select("match_id", "action_id", *(F.round(c, 9).alias(c) for c in ("score_before", "concede_before", "offensive", "defensive", "vaep")))


@query(
    "entity_value_rate",
    f"""WITH {ACTIONS_SQL}, {_VALUES}, g AS (SELECT match_id, team_id, type_name, count(*) AS n, sum((p_score - score_before) + (concede_before - p_concede)) AS v
        FROM vals GROUP BY GROUPING SETS ((match_id, team_id), (match_id, team_id, type_name))),
      t AS (SELECT match_id, (max(time_seconds) - min(time_seconds)) / 60 AS minutes FROM actions GROUP BY match_id)
      SELECT match_id, team_id, coalesce(type_name, 'all') AS action_type, n AS actions, round(v, 6) AS vaep, round(CASE WHEN minutes > 0 THEN v / minutes * 90 END, 6) AS vaep_per_90
      FROM g JOIN t USING (match_id)""",
)
def entity_value_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valued(spark, sf_dir)
    sums = players.grouped(rows, ["match_id", "team_id"])
    minutes = rows.groupBy("match_id").agg(((F.max("time_seconds") - F.min("time_seconds")) / 60).alias("minutes"))
    rate = players.per_90(F.col("vaep"), F.col("minutes"))
    return sums.join(minutes, "match_id").select("match_id", "team_id", "action_type", "actions", F.round("vaep", 6).alias("vaep"), F.round(rate, 6).alias("vaep_per_90"))


@query(
    "first_last_action",
    f"""WITH {ACTIONS_SQL} SELECT match_id, action_id, event_id, row_number() OVER ({W}) = 1 AS is_first,
      row_number() OVER (PARTITION BY match_id ORDER BY action_id DESC) = 1 AS is_last FROM actions QUALIFY is_first OR is_last""",
)
def first_last_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.first_and_last(actions(spark, sf_dir)).where("is_first or is_last").select("match_id", "action_id", "event_id", "is_first", "is_last")


@query("period_boundaries", f"WITH {ACTIONS_SQL} SELECT match_id, action_id, coalesce(lead(period) OVER ({W}) <> period, false) AS period_boundary FROM actions")
def period_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.period_boundary(actions(spark, sf_dir)).select("match_id", "action_id", "period_boundary")


@query(
    "provenance_fill",
    f"""WITH {ACTIONS_SQL}, n AS (SELECT *, CASE WHEN event_id % 3 <> 0 THEN event_id END AS source_id FROM actions)
      SELECT match_id, action_id, coalesce(first_value(source_id IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        last_value(source_id IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS anchor FROM n""",
)
def provenance_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = actions(spark, sf_dir).withColumn("source_id", F.when(F.col("event_id") % 3 != 0, F.col("event_id")))
    return states.filled_provenance(rows, "source_id", "anchor").select("match_id", "action_id", "anchor")


@query(
    "contiguity_faults",
    f"""WITH {ACTIONS_SQL}, k AS (SELECT match_id, CASE WHEN event_id % 97 = 0 THEN action_id + 1 ELSE action_id END AS action_id FROM actions)
      SELECT match_id, count(*) AS n, count(DISTINCT action_id) AS d, min(action_id) AS low, max(action_id) AS high FROM k GROUP BY match_id
      HAVING count(*) <> count(DISTINCT action_id) OR min(action_id) <> 0 OR max(action_id) <> count(*) - 1""",
)
def contiguity_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("event_id") % 97 == 0, F.col("action_id") + 1).otherwise(F.col("action_id"))
    return states.contiguous(actions(spark, sf_dir).withColumn("action_id", moved))


_LINE_ORDER = "l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_LINE_COLUMNS = _LINE_ORDER.split(", ")


@query("row_index_per_key", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS place FROM lineitem")
def row_index_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = states.numbered(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.col(c) for c in _LINE_COLUMNS], "place")
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "place")


def order_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("match_id"), F.col("o_orderdate").alias("match_date"), F.col("o_custkey").alias("customer"))


_SPLIT = """ord AS (SELECT o_orderkey AS match_id, o_orderdate, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders),
  cuts AS (SELECT *, greatest(1, least(n - 2, n * 70 // 100)) AS te, greatest(greatest(1, least(n - 2, n * 70 // 100)) + 1, least(n - 1, n * 85 // 100)) AS ve FROM ord),
  split AS (SELECT match_id, o_orderdate, o_custkey, r AS split_order, n AS total, CASE WHEN r < te THEN 'train' WHEN r < ve THEN 'validation' ELSE 'test' END AS split FROM cuts)"""


def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.chronological(order_matches(spark, sf_dir), ["match_date", "match_id"])


@query("chrono_split", f"WITH {_SPLIT} SELECT match_id, split_order, split FROM split")
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_orders(spark, sf_dir).select("match_id", "split_order", "split")


@query(
    "validation_phases",
    f"""WITH {_SPLIT}, v AS (SELECT match_id, split_order, row_number() OVER (ORDER BY split_order) - 1 AS r, count(*) OVER () AS n FROM split WHERE split = 'validation')
      SELECT match_id, CASE WHEN r < greatest(1, floor(n * 0.5)) THEN 'tune' WHEN r < least(greatest(greatest(1, floor(n * 0.5)) + 1, floor(n * 0.75)), n - 1) THEN 'calibrate' ELSE 'calibration_evaluation' END AS phase FROM v""",
)
def validation_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.validation_phases(split_orders(spark, sf_dir)).select("match_id", "phase")


@query(
    "split_summary",
    f"""WITH {_SPLIT}, l AS (SELECT l_orderkey, count(*) AS a, count_if(l_returnflag <> 'A') AS e, count_if(l_returnflag = 'R') AS s, count_if(l_linestatus = 'F') AS c FROM lineitem GROUP BY 1)
      SELECT split, count(*) AS matches, CAST(coalesce(sum(a), 0) AS BIGINT) AS actions, CAST(coalesce(sum(e), 0) AS BIGINT) AS eligible, CAST(coalesce(sum(s), 0) AS BIGINT) AS scores,
        CAST(coalesce(sum(c), 0) AS BIGINT) AS concedes, strftime(min(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS first_start, strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS last_start
      FROM split LEFT JOIN l ON l_orderkey = match_id GROUP BY split""",
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("match_id"), (F.col("l_returnflag") != "A").alias("eligible"), (F.col("l_returnflag") == "R").alias("scores"), (F.col("l_linestatus") == "F").alias("concedes"))
    return splits.summary(split_orders(spark, sf_dir), lines, F.col("match_date"))


_DAYS = "CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END * 30"


def order_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.when(F.col("o_orderpriority") == "1-URGENT", 1)
    for i, name in ((2, "2-HIGH"), (3, "3-MEDIUM"), (4, "4-NOT SPECIFIED")):
        days = days.when(F.col("o_orderpriority") == name, i)
    start = F.unix_micros(F.col("o_orderdate").cast("timestamp")) / F.lit(1_000_000)
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.floor(start).cast("long").alias("start"), F.col("o_orderpriority").alias("position"), (days.otherwise(5) * 30).alias("days"))
    return rows.select("o_custkey", "position", "start", (F.col("start") + F.col("days") * 86400).alias("end"))


_INTERVALS = f"iv AS (SELECT o_custkey, o_orderpriority AS position, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS s, CAST(floor(epoch(o_orderdate)) AS BIGINT) + ({_DAYS}) * 86400 AS e FROM orders)"


@query(
    "interval_union_minutes",
    f"""WITH {_INTERVALS}, f AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS nw FROM iv),
      g AS (SELECT *, sum(nw) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM f),
      i AS (SELECT o_custkey, isl, max(e) - min(s) AS len FROM g GROUP BY 1, 2),
      h AS (SELECT o_custkey, position, sum(e - s) AS held FROM iv GROUP BY 1, 2),
      p AS (SELECT o_custkey, position FROM h QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY held DESC, position) = 1)
      SELECT o_custkey, CAST(sum(len) AS BIGINT) AS seconds, count(*) AS islands, position FROM i JOIN p USING (o_custkey) GROUP BY o_custkey, position""",
)
def interval_union_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_intervals(spark, sf_dir)
    return players.union_seconds(rows, ["o_custkey"]).join(players.primary_position(rows, ["o_custkey"]), "o_custkey")


def line_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as valued actions: customer as player, order status as team, supplier's nation as competition."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("competition_id"))
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(supplier, lines.l_suppkey == supplier.s_suppkey)
    return rows.select(
        F.col("l_suppkey").alias("match_id"),
        "competition_id",
        F.year("o_orderdate").cast("long").alias("season_id"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey") % 50).alias("player_id"),
        (F.ascii("o_orderstatus") % 2).cast("long").alias("team_id"),
        F.col("l_returnflag").alias("type_name"),
        F.col("l_quantity").alias("offensive"),
        (F.col("l_discount") * 100).alias("defensive"),
        (F.col("l_quantity") + F.col("l_discount") * 100).alias("vaep"),
    )


_LINE_VALUES = """lv AS (SELECT l_suppkey AS match_id, CAST(s_nationkey AS BIGINT) AS competition_id, CAST(year(o_orderdate) AS BIGINT) AS season_id,
      CASE WHEN o_custkey % 10 <> 0 THEN o_custkey % 50 END AS player_id, CAST(ascii(o_orderstatus) % 2 AS BIGINT) AS team_id, l_returnflag AS type_name,
      l_quantity AS offensive, l_discount * 100 AS defensive, l_quantity + l_discount * 100 AS vaep
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
  mins AS (SELECT match_id, player_id, team_id, CAST(count(DISTINCT season_id) * 15 AS DOUBLE) AS minutes, min(type_name) AS position FROM lv WHERE player_id % 7 <> 0 GROUP BY ALL)"""


def line_minutes(rows: DataFrame) -> DataFrame:
    return rows.where("player_id % 7 <> 0").groupBy("match_id", "player_id", "team_id").agg((F.countDistinct("season_id") * 15).cast("double").alias("minutes"), F.min("type_name").alias("position"))


@query(
    "player_grouping_sets",
    f"""WITH {_LINE_VALUES} SELECT competition_id, player_id, team_id, coalesce(type_name, 'all') AS action_type, count(*) AS actions, round(sum(offensive), 4) AS offensive,
      round(sum(defensive), 4) AS defensive, round(sum(vaep), 4) AS vaep FROM lv WHERE player_id IS NOT NULL
      GROUP BY GROUPING SETS ((competition_id, player_id, team_id), (competition_id, player_id, team_id, type_name))""",
)
def player_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = players.grouped(line_values(spark, sf_dir).where("player_id is not null"), ["competition_id", "player_id", "team_id"])
    return rows.select("competition_id", "player_id", "team_id", "action_type", "actions", *(F.round(c, 4).alias(c) for c in players.SUMS))


_AGGREGATES = f"""{_LINE_VALUES},
  ml AS (SELECT g.*, coalesce(minutes, 0.0) AS minutes, coalesce(position, 'Unknown') AS position FROM (
      SELECT match_id, competition_id, season_id, player_id, team_id, coalesce(type_name, 'all') AS action_type, count(*) AS actions, sum(offensive) AS o, sum(defensive) AS d, sum(vaep) AS v
      FROM lv WHERE player_id IS NOT NULL GROUP BY GROUPING SETS ((match_id, competition_id, season_id, player_id, team_id), (match_id, competition_id, season_id, player_id, team_id, type_name))) g
    LEFT JOIN mins USING (match_id, player_id, team_id)),
  ag AS (SELECT 'match' AS level, match_id, competition_id, season_id, player_id, team_id, position, action_type, minutes, 1 AS matches, actions, o, d, v FROM ml
    UNION ALL SELECT 'competition_season', NULL, competition_id, season_id, player_id, team_id, position, action_type, sum(minutes), count(*), sum(actions), sum(o), sum(d), sum(v) FROM ml
      GROUP BY competition_id, season_id, player_id, team_id, position, action_type)"""
_PER90 = "round(CASE WHEN minutes > 0 THEN v / minutes * 90 END, 4)"


@query(
    "season_rollup_union",
    f"""WITH {_AGGREGATES} SELECT level, match_id, competition_id, season_id, player_id, team_id, position, action_type, minutes, CAST(matches AS BIGINT) AS matches, CAST(actions AS BIGINT) AS actions,
      round(o, 4) AS offensive, round(d, 4) AS defensive, round(v, 4) AS vaep, {_PER90} AS vaep_per_90, round(CASE WHEN minutes > 0 THEN o / minutes * 90 END, 4) AS offensive_per_90,
      round(CASE WHEN minutes > 0 THEN d / minutes * 90 END, 4) AS defensive_per_90, minutes >= 60 AS eligible FROM ag""",
)
def season_rollup_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_values(spark, sf_dir)
    out = players.aggregates(rows, line_minutes(rows), 60.0)
    return out.withColumns({c: F.round(c, 4) for c in (*players.SUMS, *(f"{x}_per_90" for x in players.SUMS))})


@query(
    "ranking_per90",
    f"""WITH {_AGGREGATES} SELECT competition_id, season_id, player_id, team_id, position, {_PER90} AS vaep_per_90 FROM ag
      WHERE level = 'competition_season' AND action_type = 'all' AND minutes >= 60 ORDER BY {_PER90} DESC, player_id, team_id, competition_id, season_id, position LIMIT 50""",
)
def ranking_per90(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_values(spark, sf_dir)
    out = players.aggregates(rows, line_minutes(rows), 60.0).where("level = 'competition_season' and action_type = 'all' and eligible")
    out = out.select("competition_id", "season_id", "player_id", "team_id", "position", F.round("vaep_per_90", 4).alias("vaep_per_90"))
    return out.orderBy(F.desc("vaep_per_90"), "player_id", "team_id", "competition_id", "season_id", "position").limit(50)


@query(
    "known_unknown_reconcile",
    f"""WITH {_LINE_VALUES} SELECT count(*) AS actions, count(player_id) AS known, count(*) - count(player_id) AS unknown, count_if(player_id IS NOT NULL AND minutes IS NULL) AS without_minutes,
      round(sum(vaep), 3) AS vaep, round(sum(CASE WHEN player_id IS NOT NULL THEN vaep END), 3) AS known_vaep FROM lv LEFT JOIN mins USING (match_id, player_id, team_id)""",
)
def known_unknown_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_values(spark, sf_dir)
    return players.reconciliation(rows, line_minutes(rows)).withColumns({c: F.round(c, 3) for c in ("vaep", "known_vaep")})


@query(
    "dedup_first_wins",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1",
)
def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots.first_wins(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(
    "dedup_last_wins",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1",
)
def dedup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots.last_wins(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def order_hashes(rows: DataFrame) -> DataFrame:
    return rows.select("o_orderkey", F.sha2(F.concat_ws("|", "o_custkey", "o_orderstatus", "o_orderpriority"), 256).alias("content_hash"))


@query(
    "snapshot_diff",
    """WITH n AS (SELECT o_orderkey, sha256(concat_ws('|', o_custkey, o_orderstatus, o_orderpriority)) AS h FROM orders),
      o AS (SELECT CASE WHEN o_custkey % 13 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, sha256(concat_ws('|', o_custkey, CASE WHEN o_totalprice > 250000 THEN 'X' ELSE o_orderstatus END, o_orderpriority)) AS h FROM orders)
      SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, o.h AS old_hash, n.h AS new_hash,
        CASE WHEN o.h IS NULL THEN 'new' WHEN n.h IS NULL THEN 'removed' WHEN n.h = o.h THEN 'unchanged' ELSE 'changed' END AS status FROM n FULL OUTER JOIN o ON n.o_orderkey = o.o_orderkey""",
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before, some orders had another status and some another key."""
    orders = table(spark, sf_dir, "orders")
    before = orders.withColumn("o_orderstatus", F.when(F.col("o_totalprice") > 250000, "X").otherwise(F.col("o_orderstatus"))).withColumn("o_orderkey", F.when(F.col("o_custkey") % 13 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")))
    return snapshots.snapshot_diff(order_hashes(orders), order_hashes(before), ["o_orderkey"])


@query(
    "merge_upsert",
    """WITH o AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer),
      n AS (SELECT s_suppkey * 31 AS c_custkey, upper(s_name) AS c_name, CASE WHEN s_nationkey % 2 = 0 THEN 'CHANGED' END AS c_mktsegment, s_acctbal AS c_acctbal FROM supplier)
      SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_name ELSE o.c_name END AS c_name, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment,
        CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal,
        CASE WHEN n.c_custkey IS NULL THEN 'kept' WHEN o.c_custkey IS NULL THEN 'inserted' ELSE 'updated' END AS change FROM n FULL OUTER JOIN o ON n.c_custkey = o.c_custkey""",
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, under spread keys, come into the customers."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    segment = F.when(F.col("s_nationkey") % 2 == 0, "CHANGED")
    new = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 31).alias("c_custkey"), F.upper("s_name").alias("c_name"), segment.alias("c_mktsegment"), F.col("s_acctbal").alias("c_acctbal"))
    return snapshots.merged(customer, new, ["c_custkey"], keep=["c_mktsegment"], mark=True)


_RULES = """list_filter([CASE WHEN o_totalprice > 400000 THEN 'price_out_of_range' END, CASE WHEN o_orderstatus = 'P' THEN 'status_pending' END,
      CASE WHEN o_orderpriority NOT LIKE '_-%' THEN 'priority_invalid' END, CASE WHEN o_custkey % 17 = 0 THEN 'player_not_in_match_lineup' END], lambda x: x IS NOT NULL)"""


@query(
    "quarantine_rules",
    f"""WITH r AS (SELECT o_orderkey, o_orderstatus, {_RULES} AS issues FROM orders)
      SELECT o_orderkey, CASE WHEN len(issues) = 1 THEN issues[1] ELSE 'multiple_validation_errors' END AS reason_code, array_to_string(issues, '; ') AS reason,
        issues[1] AS first_code, CASE WHEN issues[1] = 'player_not_in_match_lineup' THEN 'deferred' ELSE 'blocking' END AS severity FROM r WHERE len(issues) > 0""",
)
def quarantine_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.issues(
        [
            ("price_out_of_range", F.col("o_totalprice") > 400000),
            ("status_pending", F.col("o_orderstatus") == "P"),
            ("priority_invalid", ~F.col("o_orderpriority").rlike("^.-")),
            ("player_not_in_match_lineup", F.col("o_custkey") % 17 == 0),
        ]
    )
    rows = table(spark, sf_dir, "orders").withColumn("issues", found).where(F.size("issues") > 0)
    first = F.get("issues", F.lit(0))
    return rows.select("o_orderkey", snapshots.reason_code(F.col("issues")).alias("reason_code"), F.concat_ws("; ", "issues").alias("reason"), first.alias("first_code"), rules.severity(first).alias("severity"))


@query(
    "ingestion_reconcile",
    f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
      SELECT l_returnflag, count(*) AS raw, count_if(rn = 1 AND l_quantity <= 45) AS accepted, count_if(rn = 1 AND l_quantity > 45) AS rejected, count_if(rn > 1) AS deduplicated, true AS balanced FROM d GROUP BY 1""",
)
def ingestion_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").withColumn("rn", place)
    return snapshots.counts(rows, (F.col("rn") == 1) & (F.col("l_quantity") <= 45), (F.col("rn") == 1) & (F.col("l_quantity") > 45), ["l_returnflag"])


@query(
    "anti_semi_existing",
    """SELECT c_custkey, 'existing' AS found FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 200000)
      UNION ALL SELECT c_custkey, 'missing' FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 200000)""",
)
def anti_semi_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    known = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    yes, no = snapshots.existing(customer, known, ["c_custkey"]), snapshots.missing(customer, known, ["c_custkey"])
    return yes.withColumn("found", F.lit("existing")).unionByName(no.withColumn("found", F.lit("missing")))


@query(
    "except_intersect",
    """SELECT k, 'except' AS op FROM (SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
      UNION ALL SELECT k, 'intersect' FROM (SELECT n_nationkey AS k FROM nation INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""",
)
def except_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    known = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    return nations.subtract(known).withColumn("op", F.lit("except")).unionByName(nations.intersect(known).withColumn("op", F.lit("intersect")))


@query(
    "canonical_text",
    """SELECT p_partkey, nullif(regexp_replace(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS name,
      nullif(regexp_replace(regexp_replace(lower('  ' || p_brand || '*'), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS brand FROM part""",
)
def canonical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.canonical(F.concat("p_name", F.lit(" / "), "p_type")).alias("name"), text.canonical(F.concat(F.lit("  "), "p_brand", F.lit("*"))).alias("brand"))


@query(
    "json_extract_props",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AS is_integer, json_extract_string(props, '$.absent') IS NULL AS absent FROM events",
)
def json_extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = normalize.Json(F.parse_json("props"))
    k, absent = props.at("$.k"), props.at("$.absent")
    return table(spark, sf_dir, "events").select("event_id", k.get("bigint").alias("k"), k.is_int.alias("is_integer"), absent.absent.alias("absent"))


@query(
    "content_hash",
    """WITH b AS (SELECT conv_id, floor(turn / 1024) AS b, sha256(string_agg(sha256(coalesce(role, '') || ':' || coalesce(text, '')), chr(10) ORDER BY turn)) AS d FROM conversations GROUP BY ALL)
      SELECT conv_id, sha256(string_agg(d, chr(10) ORDER BY b)) AS digest FROM b GROUP BY conv_id""",
)
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.coalesce("role", F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return hashing.ordered_digest(table(spark, sf_dir, "conversations"), "conv_id", "turn", body)


@query("canonical_json_hash", "SELECT event_id, sha256('{\"k\":' || json_extract_string(props, '$.k') || '}') AS digest FROM events")
def canonical_json_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", hashing.json_digest("props").alias("digest"))


_SCORED = """sc AS (SELECT l.doc_id, d.lang, l.quality AS y, round(1 / (1 + exp(-(ln(d.n_chars + 1) - 7.2) / 2)), 3) AS p FROM labels l JOIN documents d USING (doc_id))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a probability made from their length."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    p = F.round(1 / (1 + F.exp(-(F.ln(F.col("n_chars") + 1) - 7.2) / 2)), 3)
    return rows.select("doc_id", "lang", F.col("quality").alias("y"), p.alias("p"))


def _metrics_sql(key: str) -> str:
    part, keys = (f"PARTITION BY {key} ", f"{key}, ") if key else ("", "")
    using, group = (f"USING ({key})", f"GROUP BY {key}") if key else ("ON true", "")
    return f"""WITH {_SCORED}, b AS (SELECT {keys}p, count(*) AS n, sum(y) AS pos FROM sc GROUP BY {keys}p),
      s AS (SELECT *, sum(pos) OVER ({part}ORDER BY p DESC) AS tp, sum(n) OVER ({part}ORDER BY p DESC) AS seen, sum(pos) OVER ({part.strip()}) AS ap, sum(n) OVER ({part.strip()}) AS an FROM b),
      r AS (SELECT {keys}sum(pos / ap * (tp / seen)) AS pr_auc, CASE WHEN max(ap * (an - ap)) > 0 THEN sum(pos * ((an - ap) - (seen - tp) + (n - pos) / 2)) / max(ap * (an - ap)) END AS roc_auc FROM s {group}),
      m AS (SELECT {keys}count(*) AS n, count_if(y = 1) AS positives, avg(-CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss, avg((p - y) * (p - y)) AS brier,
        CASE WHEN count_if(p >= 0.5) > 0 THEN count_if(p >= 0.5 AND y = 1) / count_if(p >= 0.5) ELSE 0.0 END AS "precision",
        CASE WHEN count_if(y = 1) > 0 THEN count_if(p >= 0.5 AND y = 1) / count_if(y = 1) ELSE 0.0 END AS recall FROM sc {group})
      SELECT {keys}n, positives, round(log_loss, 8) AS log_loss, round(brier, 8) AS brier, round("precision", 8) AS "precision", round(recall, 8) AS recall, round(pr_auc, 8) AS pr_auc, round(roc_auc, 8) AS roc_auc FROM m JOIN r {using}"""


_METRICS = ("log_loss", "brier", "precision", "recall", "pr_auc", "roc_auc")


@query("metrics_binary", _metrics_sql(""))
def metrics_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.report(scored(spark, sf_dir), []).withColumns({c: F.round(c, 8) for c in _METRICS})


@query("group_metrics", _metrics_sql("lang") + " WHERE n >= 20 AND positives > 0 AND positives < n")
def group_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.group_report(scored(spark, sf_dir), "lang", 20).withColumns({c: F.round(c, 8) for c in _METRICS})


@query(
    "calibration_curve",
    f"""WITH {_SCORED}, e AS (SELECT quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM sc),
      b AS (SELECT CAST(len(list_filter(edges, lambda x: x <= p)) AS INTEGER) AS bin, p, y FROM sc, e)
      SELECT bin, count(*) AS n, round(avg(p), 8) AS mean_p, round(avg(y), 8) AS observed FROM b GROUP BY bin""",
)
def calibration_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.calibration_curve(scored(spark, sf_dir)).withColumns({c: F.round(c, 8) for c in ("mean_p", "observed")})


@query(
    "topk_errors",
    f"""WITH {_SCORED} (SELECT doc_id, lang, y, p, 'false_positive' AS error FROM sc WHERE p >= 0.5 AND y = 0 ORDER BY p DESC, doc_id LIMIT 20)
      UNION ALL (SELECT doc_id, lang, y, p, 'false_negative' FROM sc WHERE p < 0.5 AND y = 1 ORDER BY p, doc_id LIMIT 20)""",
)
def topk_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.largest_errors(scored(spark, sf_dir), ["doc_id"])


@query(
    "cohort_means",
    f"""WITH {_SCORED} SELECT unnest(['en', 'good', 'long']) AS cohort, unnest([count_if(lang = 'en'), count_if(y = 1), count_if(p >= 0.6)]) AS n,
      round(unnest([avg(CASE WHEN lang = 'en' THEN p END), avg(CASE WHEN y = 1 THEN p END), avg(CASE WHEN p >= 0.6 THEN p END)]), 8) AS mean_p, round(avg(p), 8) AS overall_p,
      unnest([avg(CASE WHEN lang = 'en' THEN p END) > avg(p), avg(CASE WHEN y = 1 THEN p END) > avg(p), avg(CASE WHEN p >= 0.6 THEN p END) > avg(p)]) AS direction_observed FROM sc""",
)
def cohort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohorts = {"en": F.col("lang") == "en", "good": F.col("y") == 1, "long": F.col("p") >= 0.6}
    return metrics.cohort_means(scored(spark, sf_dir), cohorts).withColumns({c: F.round(c, 8) for c in ("mean_p", "overall_p")})


@query(
    "balanced_class_weights",
    """WITH c AS (SELECT CAST(quality AS INTEGER) AS label, count(*) AS n FROM labels GROUP BY 1), t AS (SELECT sum(n) AS total, sum(CASE WHEN label = 1 THEN n END) AS pos FROM c)
      SELECT label, n, round(total / (2 * n), 9) AS weight, round((total - pos) / pos, 9) AS scale_pos_weight FROM c, t""",
)
def balanced_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_weights(table(spark, sf_dir, "labels"), "quality").withColumns({c: F.round(c, 9) for c in ("weight", "scale_pos_weight")})


@query(
    "matrix_statistics",
    """SELECT count(*) AS rows, CAST(sum(CASE WHEN quality <> 0 THEN 1 ELSE 0 END + CASE WHEN toxic <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonzero,
      round(sum(CASE WHEN quality <> 0 THEN 1 ELSE 0 END + CASE WHEN toxic <> 0 THEN 1 ELSE 0 END) / (count(*) * 2), 9) AS density, round(avg(quality), 9) AS positive_rate FROM labels""",
)
def matrix_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.matrix_stats(table(spark, sf_dir, "labels"), ["quality", "toxic"], "quality").withColumns({c: F.round(c, 9) for c in ("density", "positive_rate")})


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive pairs of a vector as players around its first point."""
    e = F.col("embedding")
    player = lambda i: F.struct((i % 4 == 0).alias("teammate"), (i == 2).alias("actor"), F.lit(False).alias("keeper"), (F.get(e, i).cast("double") * 100).alias("x"), (F.get(e, i + 1).cast("double") * 100).alias("y"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform(F.sequence(F.lit(2), F.lit(40), F.lit(2)), player).alias("frame"),
        *((F.get(e, i).cast("double") * 100).alias(n) for i, n in ((0, "x"), (1, "y"), (42, "ex"), (43, "ey"))),
        F.transform(F.slice("embedding", 45, 12), lambda v: v.cast("double") * 100).alias("area"),
    )


_POINT = "struct_pack(t := i % 4 = 0, a := i = 2, x := CAST(embedding[i + 1] AS DOUBLE) * 100, y := CAST(embedding[i + 2] AS DOUBLE) * 100)"
_HYP = "sqrt((p.x - x) * (p.x - x) + (p.y - y) * (p.y - y))"
_T = "CASE WHEN l2 > 0 THEN greatest(0.0, least(1.0, ((p.x - x) * (ex - x) + (p.y - y) * (ey - y)) / l2)) ELSE 0.0 END"


@query(
    "vector_geometry",
    f"""WITH f AS (SELECT vec_id, list_transform(range(2, 41, 2), lambda i: {_POINT}) AS fr, CAST(embedding[1] AS DOUBLE) * 100 AS x, CAST(embedding[2] AS DOUBLE) * 100 AS y,
        CAST(embedding[43] AS DOUBLE) * 100 AS ex, CAST(embedding[44] AS DOUBLE) * 100 AS ey FROM embeddings),
      g AS (SELECT *, (ex - x) * (ex - x) + (ey - y) * (ey - y) AS l2, list_filter(fr, lambda p: NOT p.a AND NOT p.t) AS op FROM f)
      SELECT vec_id, CAST(len(list_filter(fr, lambda p: NOT p.a AND p.t)) AS INTEGER) AS visible_teammates, CAST(len(op) AS INTEGER) AS visible_opponents,
        round(list_min(list_transform(op, lambda p: {_HYP})), 6) AS nearest_defender_distance, CAST(len(list_filter(op, lambda p: {_HYP} <= 5.0)) AS INTEGER) AS pressure_around_ball,
        CAST(len(list_filter(op, lambda p: sqrt((p.x - (x + {_T} * (ex - x))) * (p.x - (x + {_T} * (ex - x))) + (p.y - (y + {_T} * (ey - y))) * (p.y - (y + {_T} * (ey - y)))) <= 2.0)) AS INTEGER) AS passing_lane_obstruction FROM g""",
)
def vector_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = geometry.frame_features(F.col("frame"), F.col("area"), F.col("x"), F.col("y"), F.col("ex"), F.col("ey"))
    keep = ("visible_teammates", "visible_opponents", "nearest_defender_distance", "pressure_around_ball", "passing_lane_obstruction")
    return frames(spark, sf_dir).select("vec_id", *(made[c].alias(c) for c in keep)).withColumn("nearest_defender_distance", F.round("nearest_defender_distance", 6))


_TYPES = ("signup", "error", "click", "view", "purchase")


@query("one_hot_features", f"WITH {ACTIONS_SQL} SELECT match_id, action_id, " + ", ".join(f"type_name = '{t}' AS actiontype_{t}" for t in _TYPES) + ", CASE WHEN type_name IN ('signup', 'error', 'click') THEN type_name ELSE 'unknown' END AS named FROM actions")
def one_hot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = actions(spark, sf_dir).select("match_id", "action_id", *((F.col("type_name") == t).alias(f"actiontype_{t}") for t in _TYPES))
    return rows.withColumn("named", text.one_hot_name({t: F.col(f"actiontype_{t}") for t in _TYPES[:3]}))


@query(
    "split_fingerprint",
    f"""WITH {_SPLIT}, r AS (SELECT match_id % 256 AS g, split_order // {splits.BLOCK} AS b, split_order, sha256(concat_ws('|', match_id, split, split_order)) AS d FROM split),
      p AS (SELECT b, sha256(string_agg(d, chr(10) ORDER BY split_order)) AS d FROM r GROUP BY b) SELECT sha256(string_agg(d, chr(10) ORDER BY b)) AS fingerprint FROM p""",
)
def split_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.fingerprint(split_orders(spark, sf_dir))


@query(
    "match_duration",
    "SELECT user_id AS match_id, max(CASE WHEN (day(ts) - 1) // 6 + 1 BETWEEN 1 AND 4 THEN hour(ts) * 60 + minute(ts) END) * 60 + 0 AS duration FROM events GROUP BY user_id",
)
def match_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("match_id"), (F.floor((F.dayofmonth("ts") - 1) / 6) + 1).alias("period"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"), F.lit(0).alias("second"))
    return players.match_seconds(rows).withColumn("duration", F.col("duration").cast("long"))


@query(
    "soft_delete",
    "SELECT c_custkey, c_custkey % 4 <> 0 AND c_custkey % 3 <> 0 AS is_active, CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 3 = 0 THEN 7 END AS removed_ingestion_run_id FROM customer",
)
def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 4 != 0).alias("is_active"), F.lit(None).cast("timestamp").alias("removed_at"), F.lit(None).cast("int").alias("removed_ingestion_run_id"))
    return snapshots.softly_deleted(rows, rows.where("c_custkey % 3 = 0"), ["c_custkey"], F.lit(7), F.current_timestamp()).drop("removed_at")


@query("union_of_batches", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def union_of_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches that together are the whole table."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return snapshots.disjoint_union([rows.where(F.col("o_orderkey") % 3 == i) for i in range(3)], ["o_orderkey"])


@query(
    "keys_reconciled",
    "SELECT coalesce(c_custkey, k) AS k, CASE WHEN c_custkey IS NULL THEN 'right' ELSE 'left' END AS side FROM customer FULL OUTER JOIN (SELECT DISTINCT o_custkey + 100 AS k FROM orders) ON c_custkey = k WHERE c_custkey IS NULL OR k IS NULL",
)
def keys_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return validation.keys_reconciled(left, table(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).alias("k")).distinct(), ["k"])


@query(
    "adequacy_gate",
    f"""WITH {_SPLIT}, r AS (SELECT match_id, split, o_custkey % 7 AS competition_id, o_custkey % 11 AS season_id, o_custkey % 3 = 0 AS scores FROM split),
      p AS (SELECT split, count(DISTINCT match_id) AS m, count(CASE WHEN scores THEN 1 END) AS s FROM r GROUP BY split)
      SELECT count(DISTINCT match_id) AS matches, count(DISTINCT competition_id) AS competitions, count(DISTINCT (competition_id, season_id)) AS competition_seasons,
        (SELECT count(*) FROM p) AS splits, (SELECT min(m) FROM p) AS least_split_matches, (SELECT min(s) FROM p) AS least_scores,
        count(DISTINCT match_id) >= 1500 AND count(DISTINCT competition_id) >= 4 AND count(DISTINCT (competition_id, season_id)) >= 6 AND (SELECT count(*) FROM p) = 3
          AND (SELECT min(m) FROM p) >= 75 AND (SELECT min(s) FROM p) >= 250 AS adequate FROM r""",
)
def adequacy_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_orders(spark, sf_dir).select("match_id", "split", (F.col("customer") % 7).alias("competition_id"), (F.col("customer") % 11).alias("season_id"), (F.col("customer") % 3 == 0).alias("scores"))
    return validation.adequacy(rows, ["scores"])


@query(
    "scalar_functions",
    """SELECT event_id, CASE WHEN regexp_full_match(c, '[0-9]+:[0-5][0-9]') THEN CAST(string_split(c, ':')[1] AS INTEGER) * 60 + CAST(string_split(c, ':')[2] AS INTEGER) END AS seconds,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') AS started, round(ln(greatest(least(value / 500, 1 - 1e-7), 1e-7) / (1 - greatest(least(value / 500, 1 - 1e-7), 1e-7))), 8) AS logit,
        abs(value - (value + 1e-9)) <= greatest(1e-10 * greatest(abs(value), abs(value + 1e-9)), 1e-8) AS close, event_id * 70 // 100 AS seventy
      FROM (SELECT *, CAST(event_id % 130 AS VARCHAR) || ':' || lpad(CAST(event_id % 75 AS VARCHAR), 2, '0') AS c FROM events)""",
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = F.concat_ws(":", (F.col("event_id") % 130).cast("string"), F.lpad((F.col("event_id") % 75).cast("string"), 2, "0"))
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.clock_seconds(clock).alias("seconds"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("started"),
        F.round(text.logit(value / 500), 8).alias("logit"),
        text.close(value, value + 1e-9, 1e-10, 1e-8).alias("close"),
        F.expr("event_id * 70 div 100").alias("seventy"),
    )


@query(
    "distinct_and_active_counts",
    "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(*) AS orders, coalesce(sum(CASE WHEN o_totalprice > 250000 THEN 1 END), 0)::BIGINT AS large, coalesce(max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END), -1) AS last_urgent FROM orders GROUP BY o_orderstatus",
)
def distinct_and_active_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    last = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey"))
    return snapshots.inventory(rows, ["o_orderstatus"], {"customers": "o_custkey"}, "orders", {"large": F.col("o_totalprice") > 250000}, {"last_urgent": last})

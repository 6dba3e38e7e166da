"""Queries that run the ingestion, validation, conversion and feature operators on records made from whole tables, each with
DuckDB SQL that says independently what must come out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom.functions import geometry, hashing, text
from fieldloom.operators import actions as conversion
from fieldloom.operators import dataset, features, labels, metrics, normalize, snapshots, states, validation, valuation
from fieldloom.operators.actions import ACTION_TYPES, BODY_PARTS, RESULTS
from fieldloom.operators.vocabulary import (
    ACTIONABLE,
    CHANCE_FIELD,
    DETAIL_KEYS,
    ENDPOINT_REQUIRED,
    ENDPOINT_TYPES,
    EVENT_TYPES,
    LOCATION_OPTIONAL,
    OUTCOME_IMPLICIT,
    OUTCOME_OPTIONAL,
    OUTCOME_TYPES,
    PERIOD_START,
    PLAYER_OPTIONAL,
)
from fieldloom.plans.adapters import ACTIONS_SQL
from fieldloom.plans.catalog import ORACLE_SQL, QUERIES, actions, query, split_orders, table
from fieldloom.session import shared_dir
from fieldloom.sources import json_arrays

__all__ = ["ORACLE_SQL", "QUERIES"]

KINDS = tuple(EVENT_TYPES.values())


def listed(values) -> str:
    return "(" + ", ".join(f"'{x}'" for x in values) + ")"


def array(values) -> str:
    return "[" + ", ".join(f"'{x}'" for x in values) + "]"


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """e and m: event and user of every row of the event stream."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("e"), F.col("user_id").alias("m"))


# Raw events ---------------------------------------------------------------------------------------------------

_UUID = "concat('00000000-0000-4000-8000-', lpad(lower(hex(e)), 12, '0'))"
_UUID_SQL = "'00000000-0000-4000-8000-' || lpad(lower(hex(e)), 12, '0')"


def _pick(values) -> str:
    return f"element_at(array({', '.join(repr(x) for x in values)}), cast(e % {len(values)} + 1 as int))"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON record for each event; each kind of fault stands in the records whose number one prime divides."""
    keys = [DETAIL_KEYS.get(k) or "" for k in KINDS]
    detail = f"""concat_ws(',', CASE WHEN e % 2 = 0 THEN '"type":{{"name":"Open Play"}}' END, CASE WHEN e % 3 = 0 THEN '"body_part":{{"name":" Right Foot"}}' END,
      CASE WHEN e % 4 = 0 THEN concat('"recipient":{{"id":', e % 11 + 1, '}}') END, CASE WHEN e % 7 <> 0 THEN '"outcome":{{"name":"Won / Lost"}}' END, '"end_location":[60,40]', '"{CHANCE_FIELD}":0.25')"""
    parts = [
        f"""CASE WHEN e % 31 = 0 THEN '"id":"not-a-uuid"' ELSE concat('"id":"', CASE WHEN e % 2 = 0 THEN upper({_UUID}) ELSE {_UUID} END, '"') END""",
        """concat('"index":', CASE WHEN e % 37 = 0 THEN 'true' ELSE cast(e + 1 as string) END)""",
        """CASE WHEN e % 41 = 0 THEN '"team":5' ELSE concat('"team":{"id":', e % 2 + 1, '}') END""",
        """CASE WHEN e % 43 = 0 THEN '"player":true' WHEN e % 5 <> 0 THEN concat('"player":{"id":', e % 23 + 1, '}') END""",
        """concat('"possession":', e div 10 + 1, ',"possession_team":{"id":', e % 2 + 1, '},"period":', e % 5 + 1, ',"minute":', e % 90, ',"second":', e % 60)""",
        f"""concat('"type":{{"name":"', CASE WHEN e % 47 = 0 THEN 'Unheard Of' ELSE {_pick(EVENT_TYPES)} END, '"}}')""",
        """concat('"timestamp":"', CASE WHEN e % 59 = 0 THEN '25:00:00' ELSE concat(lpad(e % 3, 2, '0'), ':', lpad(e % 60, 2, '0'), ':', lpad(e % 58, 2, '0'), '.', lpad(e % 1000, 3, '0')) END, '"')""",
        """CASE WHEN e % 61 = 0 THEN '"duration":true' WHEN e % 4 <> 0 THEN concat('"duration":', e % 7, '.25') END""",
        """CASE WHEN e % 67 = 0 THEN '"location":[1]' WHEN e % 6 <> 0 THEN concat('"location":[', e % 120, '.5,', e % 80, ',1]') END""",
        """CASE WHEN e % 71 <> 0 THEN '"play_pattern":{"name":"Regular Play!"}' END""",
        """CASE WHEN e % 73 = 0 THEN '"under_pressure":"yes"' WHEN e % 3 = 0 THEN '"under_pressure":true' END""",
        f"""CASE WHEN e % 79 = 0 THEN '"related_events":5' WHEN e % 2 = 0 THEN concat('"related_events":["', {_UUID}, '"]') END""",
        f"""CASE WHEN {_pick(keys)} <> '' THEN concat('"', {_pick(keys)}, '":', CASE WHEN e % 53 = 0 THEN '3' ELSE concat('{{', {detail}, '}}') END) END""",
    ]
    payload = "concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')"
    return numbers(spark, sf_dir).select(F.lit("event").alias("kind"), F.lit("src").alias("source"), F.col("m").alias("match_id"), F.col("e").cast("int").alias("source_record_index"), F.expr(payload).alias("payload"))


_TYPED = {
    "source_event_id": _UUID_SQL,
    "source_event_index": "CAST(e + 1 AS INTEGER)",
    "match_id": "m",
    "team_id": "e % 2 + 1",
    "player_id": "CASE WHEN e % 5 <> 0 THEN e % 23 + 1 END",
    "possession_id": "e // 10 + 1",
    "possession_team_id": "e % 2 + 1",
    "event_type": "t",
    "event_subtype": "CASE WHEN d AND e % 2 = 0 THEN 'open_play' END",
    "period": "CAST(e % 5 + 1 AS INTEGER)",
    "clock_ms": "((e % 3 * 60 + e % 60) * 60 + e % 58) * 1000 + e % 1000",
    "minute": "CAST(e % 90 AS INTEGER)",
    "second": "CAST(e % 60 AS INTEGER)",
    "duration": "CASE WHEN e % 4 <> 0 THEN e % 7 + CAST(0.25 AS DOUBLE) END",
    "x": "round(CASE WHEN e % 6 <> 0 THEN (e % 120 + CAST(0.5 AS DOUBLE)) / 120 * 100 END, 9)",
    "y": "round(CASE WHEN e % 6 <> 0 THEN CAST(e % 80 AS DOUBLE) / 80 * 100 END, 9)",
    "end_x": f"CASE WHEN t IN {listed(ENDPOINT_TYPES)} THEN CAST(50 AS DOUBLE) END",
    "end_y": f"CASE WHEN t IN {listed(ENDPOINT_TYPES)} THEN CAST(50 AS DOUBLE) END",
    "outcome": f"CASE WHEN t IN {listed(OUTCOME_TYPES)} AND e % 7 <> 0 THEN 'won_lost' WHEN t IN {listed(OUTCOME_IMPLICIT)} THEN 'complete' END",
    "body_part": "CASE WHEN d AND e % 3 = 0 THEN 'right_foot' END",
    "recipient_id": "CASE WHEN d AND e % 4 = 0 THEN e % 11 + 1 END",
    "xg": "CASE WHEN t = 'shot' THEN CAST(0.25 AS DOUBLE) END",
    "play_pattern": "'regular_play'",
    "under_pressure": "e % 3 = 0",
    "counterpress": "false",
    "related": f"CASE WHEN e % 2 = 0 THEN {_UUID_SQL} ELSE '' END",
}


@query(
    "normalized_events",
    f"""WITH r AS (SELECT event_id AS e, user_id AS m, CASE WHEN event_id % 47 <> 0 THEN {array(KINDS)}[event_id % {len(KINDS)} + 1] END AS t FROM events),
      k AS (SELECT *, t IN {listed(DETAIL_KEYS)} AS d FROM r),
      c AS (SELECT *, CASE WHEN e % 31 = 0 THEN 'malformed_uuid' WHEN e % 37 = 0 THEN 'malformed_integer' WHEN e % 41 = 0 THEN 'missing_required_field' WHEN e % 43 = 0 THEN 'malformed_field'
        WHEN t IS NULL THEN 'unknown_event_type' WHEN d AND e % 53 = 0 THEN 'malformed_event_detail' WHEN e % 59 = 0 THEN 'malformed_timestamp' WHEN e % 61 = 0 THEN 'malformed_number'
        WHEN e % 67 = 0 THEN 'malformed_coordinates' WHEN e % 71 = 0 THEN 'missing_required_field' WHEN e % 73 = 0 THEN 'malformed_boolean' WHEN e % 79 = 0 THEN 'malformed_related_events' END AS error_code FROM k)
      SELECT CAST(e AS INTEGER) AS source_record_index, error_code, {', '.join(f'CASE WHEN error_code IS NULL THEN {v} END AS {k}' for k, v in _TYPED.items())} FROM c""",
)
def normalized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1-7, FN4, FN6, FN7, FN9, FN19, FN22."""
    rows = normalize.events(raw_events(spark, sf_dir)).withColumns({"x": F.round("x", 9), "y": F.round("y", 9), "related": F.concat_ws(",", "related_event_ids")})
    return rows.select("source_record_index", "error_code", *(F.when(F.col("error_code").isNull(), F.col(c)).alias(c) for c in _TYPED))


@query(
    "raw_files",
    "SELECT conv_id AS match_id, CAST(turn AS INTEGER) AS source_record_index, CASE WHEN turn % 5 = 0 THEN 'object_required' END AS read_error, CASE WHEN turn % 5 <> 0 THEN role END AS role FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS turn FROM conversations) "
    "UNION ALL SELECT n_nationkey, NULL, CASE WHEN n_nationkey % 2 = 0 THEN 'array_required' ELSE 'json_invalid' END, NULL FROM nation",
)
def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1-3, SRC12, SNK2: each conversation is written as a file of one array, each nation as a broken file; all are read back."""
    turns, row = table(spark, sf_dir, "conversations"), Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    record = F.to_json(F.struct(F.col("conv_id").alias("match_id"), "role", "text"))
    turns = turns.withColumn("nth", F.row_number().over(row) - 1).select("conv_id", F.struct("nth", F.when(F.col("nth") % 5 == 0, F.col("conv_id").cast("string")).otherwise(record).alias("r")).alias("e"))
    arrays = turns.groupBy("conv_id").agg(F.concat(F.lit("[\n"), F.concat_ws(",\n", F.transform(F.sort_array(F.collect_list("e")), lambda e: e["r"])), F.lit("\n]")).alias("value")).select(F.col("conv_id").alias("k"), "value")
    broken = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit('{"match_id":'), F.col("n_nationkey").cast("string"), F.lit("}"))).otherwise(F.concat(F.lit("["), F.col("n_nationkey").cast("string"), F.lit(","))).alias("value"))
    parts = []
    for rows in (arrays, broken):
        folder = f"{shared_dir(spark).rstrip('/')}/raw-{uuid.uuid4().hex}"
        rows.select("value").write.option("maxRecordsPerFile", 1).text(folder)
        parts.append(json_arrays.raw_records(spark, folder, "conversation", "src", match_from_name=False))
    good, bad = parts
    text = spark.read.text([r.source_file for r in bad.select("source_file").distinct().collect()], wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file"))
    bad = bad.join(text, "source_file").withColumn("match_id", F.regexp_extract("value", "([0-9]+)", 1).cast("bigint"))
    own = good.groupBy("source_file").agg(F.max("match_id").alias("named"), F.max(F.when(F.col("read_error").isNotNull(), F.col("payload").cast("bigint"))).alias("bare"))
    good = good.drop("match_id").join(own, "source_file").withColumn("match_id", F.coalesce("named", "bare"))
    columns = ["match_id", F.col("source_record_index"), "read_error", F.get_json_object("payload", "$.role").alias("role")]
    return good.select(*columns).unionByName(bad.select(*columns))


# Rules of typed events ----------------------------------------------------------------------------------------

_START = "CASE p WHEN " + " WHEN ".join(f"{k} THEN {v}" for k, v in PERIOD_START.items()) + " END"
#: Typed rows with faults, as expressions that both engines read alike; e is the event's number.
_FAULTY = {
    "source": "CASE WHEN e % 83 = 0 THEN ' ' ELSE 'src' END",
    "source_event_id": "CASE WHEN e % 31 = 0 THEN 'bad' ELSE u END",
    "match_id": "m",
    "team_id": "CASE WHEN e % 37 = 0 THEN -1 WHEN e % 29 = 0 THEN 3 ELSE e % 2 + 1 END",
    "source_event_index": "e + 1",
    "possession_id": "CASE WHEN e % 41 = 0 THEN 0 ELSE e % 1000 + 1 END",
    "possession_team_id": "CASE WHEN e % 89 = 0 THEN 9 ELSE e % 2 + 1 END",
    "source_record_index": "CASE WHEN e % 43 = 0 THEN -1 ELSE e END",
    "player_id": "CASE WHEN e % 47 = 0 THEN 0 WHEN e % 5 <> 0 THEN e % 30 + 1 END",
    "event_type": "CASE WHEN e % 53 = 0 THEN 'unheard_of' ELSE t END",
    "period": "p",
    "clock_ms": "CASE WHEN e % 59 <> 0 THEN e % 45 * 60000 + e % 60 * 1000 + e % 1000 END",
    "minute": "CASE WHEN e % 7 = 0 THEN -1 ELSE s + e % 45 END",
    "second": "CASE WHEN e % 61 = 0 THEN 60 WHEN e % 11 = 0 THEN 0 ELSE e % 60 END",
    "x": "CASE WHEN e % 6 <> 0 THEN CAST(e % 130 AS DOUBLE) END",
    "y": "CASE WHEN e % 6 <> 0 AND e % 67 <> 0 THEN CAST(e % 80 AS DOUBLE) END",
    "end_x": "CASE WHEN e % 4 = 0 THEN CAST(e % 103 AS DOUBLE) END",
    "end_y": "CASE WHEN e % 4 = 0 AND e % 13 <> 0 THEN CAST(50 AS DOUBLE) END",
    "outcome": "CASE WHEN e % 71 = 0 THEN 'Bad!' WHEN e % 3 <> 0 THEN 'won_it' END",
    "xg": "CASE WHEN e % 9 = 0 THEN CAST(2 AS DOUBLE) WHEN e % 8 = 0 THEN CAST(0.5 AS DOUBLE) END",
    "duration": "CASE WHEN e % 73 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END",
    "event_subtype": "CASE WHEN e % 79 = 0 THEN 'Bad Type' ELSE 'open_play' END",
    "body_part": "CASE WHEN e % 101 = 0 THEN '_foot' END",
    "play_pattern": "CASE WHEN e % 17 = 0 THEN '' ELSE 'regular' END",
    "under_pressure": "CASE WHEN e % 97 <> 0 THEN true END",
    "counterpress": "CASE WHEN e % 19 <> 0 THEN false END",
    "recipient_id": "CASE WHEN e % 23 = 0 THEN 0 WHEN e % 4 = 1 THEN e % 40 + 1 END",
    "related": "CASE WHEN e % 107 = 0 THEN 'bad' ELSE u END",
    "raw_details": "CASE WHEN e % 109 = 0 THEN '[1]' WHEN e % 113 = 0 THEN '{' ELSE '{}' END",
}


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbers(spark, sf_dir).withColumns({"u": F.expr(_UUID), "t": F.expr(_pick(KINDS)), "p": F.expr("cast(e % 6 as int)")}).withColumn("s", F.expr(_START))
    kinds = {"period": "int", "minute": "int", "second": "int"}
    rows = rows.select("e", *(F.expr(v).cast(kinds.get(k, "string" if k in ("source", "source_event_id", "related", "raw_details", "event_type", "outcome", "event_subtype", "body_part", "play_pattern") else "boolean" if k in ("under_pressure", "counterpress") else "double" if k in ("x", "y", "end_x", "end_y", "xg", "duration") else "bigint")).alias(k) for k, v in _FAULTY.items()))
    return rows.withColumn("related_event_ids", F.array("related"))


def squads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as matches, their orders as lineup intervals."""
    matches = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("match_id"), F.lit(1).cast("bigint").alias("home_team_id"), F.lit(2).cast("bigint").alias("away_team_id"))
    intervals = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("bigint").alias("match_id"), (F.col("o_orderkey") % 40 + 1).cast("bigint").alias("player_id"), (F.col("o_orderkey") % 2 + 1).cast("bigint").alias("team_id"))
    return matches, intervals


_SQUADS_SQL = """matches AS (SELECT c_custkey AS match_id, 1 AS home_team_id, 2 AS away_team_id FROM customer),
      intervals AS (SELECT o_custkey AS match_id, o_orderkey % 40 + 1 AS player_id, o_orderkey % 2 + 1 AS team_id FROM orders),
      squads AS (SELECT match_id, list(DISTINCT player_id) AS players FROM intervals GROUP BY match_id),
      context AS (SELECT match_id, true AS known, coalesce(players, []) AS players FROM matches LEFT JOIN squads USING (match_id))"""
_FAULTY_SQL = f"""n AS (SELECT event_id AS e, user_id AS m, '00000000-0000-4000-8000-' || lpad(lower(hex(event_id)), 12, '0') AS u, {array(KINDS)}[event_id % {len(KINDS)} + 1] AS t, event_id % 6 AS p FROM events),
      s AS (SELECT *, {_START} AS s FROM n), f AS (SELECT e, {', '.join(f'{v} AS {k}' for k, v in _FAULTY.items())} FROM s)"""

_IN = "event_type IN"
_KNOWN = f"{_IN} {listed(KINDS)}"
_BEGIN = "CASE period WHEN " + " WHEN ".join(f"{k} THEN {v}" for k, v in PERIOD_START.items()) + " END"
_AT = f"({_BEGIN} * 60 + clock_ms // 1000)"
_SNAKE = "regexp_full_match({}, '[a-z0-9]+(_[a-z0-9]+)*')"
_RULES = [
    ("source_required", "trim(source) = ''"),
    ("source_event_id_invalid", "source_event_id = 'bad'"),
    ("match_id_invalid", "match_id <= 0"),
    ("team_id_invalid", "team_id <= 0"),
    ("possession_id_invalid", "possession_id <= 0"),
    ("source_record_index_invalid", "source_record_index < 0"),
    ("player_id_invalid", "player_id <= 0"),
    ("event_type_unknown", f"NOT {_KNOWN}"),
    ("match_not_found", "known IS NULL"),
    ("team_not_in_match", "known AND team_id NOT IN (1, 2)"),
    ("possession_team_not_in_match", "known AND possession_team_id NOT IN (1, 2)"),
    ("player_not_in_match_lineup", "known AND NOT list_contains(players, player_id)"),
    ("recipient_not_in_match_lineup", "known AND NOT list_contains(players, recipient_id)"),
    ("period_invalid", "period NOT BETWEEN 1 AND 5"),
    ("timestamp_invalid", "clock_ms IS NULL"),
    ("minute_invalid", "minute IS NULL OR minute < 0"),
    ("second_invalid", "second NOT BETWEEN 0 AND 59"),
    ("time_fields_inconsistent", f"period BETWEEN 1 AND 5 AND clock_ms IS NOT NULL AND minute >= 0 AND second BETWEEN 0 AND 59 AND (minute <> {_AT} // 60 OR second <> {_AT} % 60)"),
    ("start_coordinate_pair_incomplete", "(x IS NULL) <> (y IS NULL)"),
    ("start_x_out_of_range", "y IS NOT NULL AND x NOT BETWEEN 0 AND 100"),
    ("start_y_out_of_range", "x IS NOT NULL AND y NOT BETWEEN 0 AND 100"),
    ("end_coordinate_pair_incomplete", "(end_x IS NULL) <> (end_y IS NULL)"),
    ("end_x_out_of_range", "end_y IS NOT NULL AND end_x NOT BETWEEN 0 AND 100"),
    ("start_location_required", f"{_KNOWN} AND (x IS NULL OR y IS NULL) AND event_type NOT IN {listed(LOCATION_OPTIONAL)}"),
    ("endpoint_required", f"{_IN} {listed(ENDPOINT_REQUIRED)} AND (end_x IS NULL OR end_y IS NULL)"),
    ("endpoint_not_allowed", f"{_KNOWN} AND event_type NOT IN {listed(ENDPOINT_TYPES)} AND end_x IS NOT NULL AND end_y IS NOT NULL"),
    ("player_required", f"{_KNOWN} AND player_id IS NULL AND event_type NOT IN {listed(PLAYER_OPTIONAL)}"),
    ("outcome_invalid", f"NOT {_SNAKE.format('outcome')}"),
    ("outcome_required", f"{_IN} {listed(t for t in OUTCOME_TYPES if t not in OUTCOME_OPTIONAL)} AND outcome IS NULL"),
    ("outcome_not_allowed", f"{_KNOWN} AND event_type NOT IN {listed(OUTCOME_TYPES)} AND outcome IS NOT NULL"),
    ("xg_required", "event_type = 'shot' AND xg IS NULL"),
    ("xg_not_allowed", "event_type <> 'shot' AND xg IS NOT NULL"),
    ("xg_out_of_range", "event_type = 'shot' AND xg NOT BETWEEN 0 AND 1"),
    ("duration_invalid", "duration < 0"),
    ("event_subtype_invalid", f"NOT {_SNAKE.format('event_subtype')}"),
    ("body_part_invalid", f"NOT {_SNAKE.format('body_part')}"),
    ("play_pattern_invalid", f"NOT {_SNAKE.format('play_pattern')}"),
    ("play_pattern_required", "play_pattern = ''"),
    ("under_pressure_invalid", "under_pressure IS NULL"),
    ("counterpress_invalid", "counterpress IS NULL"),
    ("recipient_id_invalid", "recipient_id <= 0"),
    ("related_event_ids_invalid", "related = 'bad'"),
    ("raw_details_invalid", "raw_details <> '{}'"),
]


@query(
    "event_issues",
    f"""WITH {_SQUADS_SQL}, {_FAULTY_SQL} SELECT e, array_to_string(list_filter([{', '.join(f"CASE WHEN {c} THEN '{code}' END" for code, c in _RULES)}], lambda z: z IS NOT NULL), ';') AS issues
      FROM f LEFT JOIN context USING (match_id)""",
)
def event_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL1-6, FN2, FN23."""
    rows = validation.validated_events(faulty_events(spark, sf_dir), *squads(spark, sf_dir))
    return rows.select("e", F.concat_ws(";", "issues").alias("issues"))


# Rules across rows --------------------------------------------------------------------------------------------

_LINKED = {
    "match_id": "m",
    "source": "'src'",
    "source_record_index": "e",
    "source_event_id": "concat('u', CASE WHEN e % 17 = 0 THEN e - e % 34 ELSE e END)",
    "source_event_index": "nth + CASE WHEN e % 97 = 0 THEN 1 ELSE 0 END",
    "possession_id": "q",
    "possession_team_id": "CASE WHEN e % 50 = 0 THEN 2 ELSE q % 2 + 1 END",
    "team_id": "e % 2 + 1",
    "player_id": "CASE WHEN e % 5 <> 0 THEN e % 45 + 1 END",
    "recipient_id": "CASE WHEN e % 3 = 0 THEN e % 45 + 1 END",
    "event_type": "t",
    "period": "1",
    "clock_ms": "e",
    "related_1": "concat('u', e)",
    "related_2": "CASE WHEN e % 13 = 0 THEN concat('u', e) ELSE 'none' END",
}


def linked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbers(spark, sf_dir).withColumns({"t": F.expr(_pick(KINDS)), "nth": F.expr("cast(row_number() over (partition by m order by e) as bigint)")})
    rows = rows.withColumn("q", F.expr("CASE WHEN e % 71 = 0 THEN 0 ELSE (nth - nth % 10) / 10 END").cast("bigint"))
    rows = rows.select(*(F.expr(v).alias(k) for k, v in _LINKED.items())).withColumns({k: F.col(k).cast("bigint") for k in ("source_event_index", "possession_team_id", "team_id", "player_id", "recipient_id")})
    return rows.withColumn("related_event_ids", F.when(F.col("source_record_index") % 2 == 0, F.array("related_1", "related_2")).otherwise(F.array().cast("array<string>")))


_LINKED_SQL = f"""n AS (SELECT event_id AS e, user_id AS m, {array(KINDS)}[event_id % {len(KINDS)} + 1] AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events),
      k AS (SELECT *, CASE WHEN e % 71 = 0 THEN 0 ELSE nth // 10 END AS q FROM n), ev AS (SELECT {', '.join(f'{v} AS {k}' for k, v in _LINKED.items())}, e % 2 = 0 AS has FROM k),
      rel AS (SELECT DISTINCT match_id, source_event_id, source_record_index, unnest([related_1, related_2]) AS target FROM ev WHERE has),
      sides AS (SELECT DISTINCT match_id, player_id, team_id FROM intervals)"""


@query(
    "across_event_issues",
    f"""WITH {_SQUADS_SQL}, {_LINKED_SQL}, out AS (
      SELECT match_id, source_event_id AS key, 'duplicate_event_id' AS code FROM (SELECT *, count(*) OVER (PARTITION BY source_event_id) AS c FROM ev) WHERE c > 1
      UNION ALL SELECT match_id, source_event_id, 'duplicate_event_index' FROM (SELECT *, count(*) OVER (PARTITION BY match_id, source_event_index) AS c FROM ev) WHERE c > 1
      UNION ALL SELECT match_id, source_event_id, 'event_indexes_not_ordered' FROM (SELECT *, lag(source_event_index) OVER (PARTITION BY match_id ORDER BY source_record_index) AS b FROM ev) WHERE b >= source_event_index
      UNION ALL SELECT match_id, CAST(match_id AS VARCHAR), 'event_index_sequence_invalid' FROM ev GROUP BY match_id HAVING list(source_event_index ORDER BY source_event_index) <> range(1, count(*) + 1)
      UNION ALL SELECT match_id, source_event_id, 'possession_team_inconsistent' FROM ev WHERE (match_id, possession_id) IN (SELECT (match_id, possession_id) FROM ev GROUP BY match_id, possession_id HAVING count(DISTINCT possession_team_id) > 1)
      UNION ALL SELECT ev.match_id, source_event_id, 'player_team_mismatch' FROM ev JOIN sides ON ev.match_id = sides.match_id AND ev.player_id = sides.player_id WHERE sides.team_id <> ev.team_id
      UNION ALL SELECT ev.match_id, source_event_id, 'recipient_team_mismatch' FROM ev JOIN sides ON ev.match_id = sides.match_id AND ev.recipient_id = sides.player_id WHERE sides.team_id <> ev.team_id
      UNION ALL SELECT match_id, source_event_id, 'recipient_not_allowed' FROM ev WHERE event_type NOT IN ('pass', 'goalkeeper') AND recipient_id IS NOT NULL
      UNION ALL SELECT match_id, source_event_id, 'duplicate_related_event' FROM ev WHERE has AND related_1 = related_2
      UNION ALL SELECT match_id, source_event_id, 'related_event_self_reference' FROM ev WHERE has AND (related_1 = source_event_id OR related_2 = source_event_id)
      UNION ALL SELECT match_id, r, 'related_event_not_found' FROM (SELECT match_id, source_event_id AS r, unnest([related_1, related_2]) AS target FROM ev WHERE has) x WHERE NOT EXISTS (SELECT 1 FROM ev y WHERE y.match_id = x.match_id AND y.source_event_id = x.target)
      UNION ALL SELECT match_id, source_event_id, 'match_context_missing' FROM ev WHERE match_id NOT IN (SELECT match_id FROM matches))
      SELECT match_id, key, code, count(*) AS n FROM out GROUP BY match_id, key, code""",
)
def across_event_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL8, VAL11, VAL12, SO8, FN18, JN10."""
    found = validation.across_events(linked_events(spark, sf_dir), *squads(spark, sf_dir))
    return found.groupBy("match_id", "key", "code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "conversion_faults",
    f"""WITH {_SQUADS_SQL}, {_LINKED_SQL}, own AS (SELECT * FROM ev WHERE event_type IN {listed(ACTIONABLE)}),
      fr AS (SELECT CASE WHEN m % 7 = 0 THEN m + 1 ELSE m END AS match_id, concat('u', e) AS source_event_id FROM n),
      out AS (
      SELECT match_id, CAST(possession_id AS VARCHAR) AS key, 'possession_team_inconsistent' AS code, 'error' AS level FROM ev GROUP BY match_id, possession_id HAVING count(DISTINCT possession_team_id) > 1
      UNION ALL SELECT match_id, source_event_id, 'possession_order_invalid', 'error' FROM (SELECT *, lag(possession_id) OVER (PARTITION BY match_id ORDER BY period, clock_ms, source_event_index) AS b FROM own) WHERE b > possession_id
      UNION ALL SELECT DISTINCT match_id, CAST(match_id AS VARCHAR), 'lineup_match_not_found', 'error' FROM ev WHERE match_id NOT IN (SELECT match_id FROM intervals)
      UNION ALL SELECT match_id, source_event_id, 'event_player_missing_lineup_interval', 'error' FROM own o WHERE player_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM intervals i WHERE i.match_id = o.match_id AND i.player_id = o.player_id)
      UNION ALL SELECT match_id, source_event_id, 'event_recipient_missing_lineup_interval', 'error' FROM own o WHERE recipient_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM intervals i WHERE i.match_id = o.match_id AND i.player_id = o.recipient_id)
      UNION ALL SELECT match_id, source_event_id, 'three_sixty_event_not_found', 'error' FROM fr WHERE source_event_id NOT IN (SELECT source_event_id FROM ev)
      UNION ALL SELECT fr.match_id, fr.source_event_id, 'three_sixty_match_mismatch', 'error' FROM fr JOIN (SELECT DISTINCT match_id, source_event_id FROM ev) p ON p.source_event_id = fr.source_event_id AND p.match_id <> fr.match_id
      UNION ALL SELECT match_id, CAST(player_id AS VARCHAR), 'lineup_interval_reversed', 'warning' FROM intervals WHERE player_id % 9 = 0)
      SELECT match_id, key, code, level, count(*) AS n FROM out GROUP BY ALL""",
)
def conversion_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL14, WN15, FLT4, JN10."""
    _, intervals = squads(spark, sf_dir)
    turned = F.when(F.col("player_id") % 9 == 0, -1).otherwise(1)
    intervals = intervals.select("*", F.lit(0).alias("from_seconds"), turned.alias("to_seconds"), F.lit(1).alias("from_period"), F.lit(1).alias("to_period"))
    frames = numbers(spark, sf_dir).select(F.when(F.col("m") % 7 == 0, F.col("m") + 1).otherwise(F.col("m")).alias("match_id"), F.concat(F.lit("u"), F.col("e").cast("string")).alias("source_event_id"))
    found = validation.conversion_contract(linked_events(spark, sf_dir), intervals, frames)
    return found.groupBy("match_id", "key", "code", "level").agg(F.count(F.lit(1)).alias("n"))


# Lineups and frames -------------------------------------------------------------------------------------------


@query(
    "normalized_intervals",
    """WITH o AS (SELECT o_orderkey AS k, o_custkey AS m, CASE WHEN o_orderkey % 31 = 0 THEN 'malformed_integer' WHEN o_orderkey % 37 = 0 THEN 'malformed_lineup' WHEN o_orderkey % 41 = 0 THEN 'malformed_lineup_player'
        WHEN o_orderkey % 43 = 0 THEN 'malformed_positions' WHEN o_orderkey % 47 = 0 THEN 'malformed_position' WHEN o_orderkey % 53 = 0 THEN 'malformed_lineup_time' END AS error_code FROM orders),
      p AS (SELECT *, unnest([0, 1]) AS i FROM o WHERE error_code IS NULL)
      SELECT m AS match_id, CAST(k AS INTEGER) AS source_record_index, k % 2 + 1 AS team_id, k % 40 + 1 + i AS player_id, 'P' || CAST(i AS VARCHAR) AS player_name, CAST(k % 25 AS INTEGER) AS position_id, 'Left Back' AS position,
        CAST((k % 130) * 60 + k % 60 AS INTEGER) AS from_seconds, CASE WHEN k % 3 <> 0 THEN CAST((k % 130 + 5) * 60 AS INTEGER) END AS to_seconds, 1 AS from_period, CASE WHEN k % 3 <> 0 THEN 2 END AS to_period, NULL AS error_code FROM p
      UNION ALL SELECT m, CAST(k AS INTEGER), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, error_code FROM o WHERE error_code IS NOT NULL""",
)
def normalized_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ8, FN3, PRJ1e."""
    at = """concat('{"position_id":', CASE WHEN k % 47 = 0 THEN '"x"' ELSE cast(k % 25 as string) END, ',"position":"Left Back","from":"', CASE WHEN k % 53 = 0 THEN '1:75' ELSE concat(k % 130, ':', lpad(k % 60, 2, '0')) END,
      '","from_period":1', CASE WHEN k % 3 <> 0 THEN concat(',"to":"', k % 130 + 5, ':00","to_period":2') ELSE ',"to":null,"to_period":null' END, '}')"""
    player = lambda i: f"""concat('{{"player_id":', CASE WHEN k % 41 = 0 THEN 'null' ELSE cast(k % 40 + 1 + {i} as string) END, ',"player_name":"P{i}","positions":', CASE WHEN k % 43 = 0 THEN '7' ELSE concat('[', {at}, ']') END, '}}')"""
    payload = f"""concat('{{"team_id":', CASE WHEN k % 31 = 0 THEN 'true' ELSE cast(k % 2 + 1 as string) END, ',"lineup":', CASE WHEN k % 37 = 0 THEN '{{}}' ELSE concat('[', {player(0)}, ',', {player(1)}, ']') END, '}}')"""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("bigint").alias("match_id"))
    raw = rows.select(F.lit("lineup").alias("kind"), F.lit("src").alias("source"), "match_id", F.col("k").cast("int").alias("source_record_index"), F.expr(payload).alias("payload"))
    return normalize.intervals(raw).drop("source", "start_reason", "end_reason")


@query(
    "lineup_issues",
    """WITH i AS (SELECT c_custkey AS match_id, o_orderkey % 40 + 1 AS player_id, o_orderkey % 3 + 1 AS team_id, o_orderkey % 5 AS source_record_index FROM customer JOIN orders ON o_custkey = c_custkey),
      t AS (SELECT c_custkey AS match_id, unnest([1, 2]) AS team_id FROM customer)
      SELECT DISTINCT match_id, CAST(team_id AS VARCHAR) AS key, 'lineup_team_not_in_match' AS code FROM i WHERE team_id NOT IN (1, 2)
      UNION ALL SELECT match_id, CAST(team_id AS VARCHAR), 'duplicate_team_lineup' FROM i GROUP BY match_id, team_id HAVING count(DISTINCT source_record_index) > 1
      UNION ALL SELECT match_id, CAST(player_id AS VARCHAR), 'duplicate_lineup_player' FROM i GROUP BY match_id, player_id HAVING count(DISTINCT team_id) > 1
      UNION ALL SELECT match_id, CAST(team_id AS VARCHAR), 'match_lineup_missing' FROM t WHERE (match_id, team_id) NOT IN (SELECT (match_id, team_id) FROM i)""",
)
def lineup_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL10, JN10."""
    matches, _ = squads(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("bigint").alias("match_id"), (F.col("o_orderkey") % 40 + 1).alias("player_id"), (F.col("o_orderkey") % 3 + 1).cast("bigint").alias("team_id"), (F.col("o_orderkey") % 5).alias("source_record_index"))
    return validation.across_lineups(snapshots.existing(orders, matches, ["match_id"]), matches)


_FRAME_JSON = f"""concat('{{"event_uuid":"', CASE WHEN e % 31 = 0 THEN 'bad' ELSE {_UUID} END, '","visible_area":', CASE WHEN e % 37 = 0 THEN '[true]' WHEN e % 5 = 0 THEN '[0,0,1,1]' ELSE '[0,0,120,0,60.5,80]' END,
      ',"freeze_frame":', CASE WHEN e % 41 = 0 THEN '{{}}' WHEN e % 43 = 0 THEN '[1]' ELSE concat('[{{"teammate":true,"actor":true,"keeper":false,"location":[', e % 120, ',', e % 80, ']}},{{"teammate":false,"actor":', CASE WHEN e % 11 = 0 THEN 'true' ELSE 'false' END,
      ',"keeper":', CASE WHEN e % 13 = 0 THEN 'null' ELSE 'false' END, ',"location":', CASE WHEN e % 17 = 0 THEN '[1]' ELSE '[10,20.5]' END, '}}]') END, '}}')"""


@query(
    "frame_issues",
    f"""WITH n AS (SELECT event_id AS e, user_id AS m, {_UUID_SQL.replace('hex(e)', 'hex(event_id)')} AS u, value FROM events),
      c AS (SELECT *, CASE WHEN e % 31 = 0 THEN 'malformed_uuid' WHEN e % 37 = 0 THEN 'malformed_visible_area' WHEN e % 41 = 0 THEN 'malformed_freeze_frame' WHEN e % 43 = 0 THEN 'malformed_freeze_frame_player' END AS error_code FROM n)
      SELECT CAST(e AS INTEGER) AS source_record_index, error_code, CASE WHEN error_code IS NULL THEN u END AS source_event_id,
        CASE WHEN error_code IS NULL THEN CAST(CASE WHEN e % 5 = 0 THEN 2 ELSE 260.5 END AS DOUBLE) END AS area_sum, CASE WHEN error_code IS NULL THEN CAST(e % 120 + CASE WHEN e % 17 = 0 THEN 0 ELSE 10 END AS DOUBLE) END AS x_sum,
        CASE WHEN error_code IS NULL THEN array_to_string(list_filter([CASE WHEN value <= 100 THEN 'three_sixty_event_not_found' END, CASE WHEN e % 5 = 0 THEN 'visible_area_invalid' END, CASE WHEN e % 13 = 0 THEN 'freeze_frame_flag_invalid' END,
          CASE WHEN e % 17 = 0 THEN 'freeze_frame_location_invalid' END, CASE WHEN e % 11 = 0 THEN 'freeze_frame_multiple_actors' END], lambda z: z IS NOT NULL), ';') END AS issues FROM c""",
)
def frame_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ9, VAL12, JN7, FN16, FN17."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("e"), F.col("user_id").alias("match_id"), "value")
    raw = rows.select(F.lit("three_sixty").alias("kind"), F.lit("src").alias("source"), "match_id", F.col("e").cast("int").alias("source_record_index"), F.expr(_FRAME_JSON).alias("payload"))
    known = rows.where("value > 100").select(F.lit("src").alias("source"), F.expr(_UUID).alias("source_event_id"))
    found = validation.validated_frames(normalize.frames(raw), known)
    total = lambda c, f: F.aggregate(c, F.lit(0.0), lambda s, v: s + F.coalesce(f(v), F.lit(0.0)))
    good = lambda c: F.when(F.col("error_code").isNull(), c)
    return found.select("source_record_index", "error_code", good(F.col("source_event_id")).alias("source_event_id"), good(total("visible_area", lambda v: v)).alias("area_sum"), good(total("freeze_frame", lambda p: p["x"])).alias("x_sum"), good(F.concat_ws(";", "issues")).alias("issues"))


_N = "0.5 - x0 / 100"


@query(
    "frame_geometry",
    f"""WITH f AS (SELECT vec_id AS k, CAST(embedding[1] AS DOUBLE) * 60 + 52 AS x, CAST(embedding[2] AS DOUBLE) * 40 + 34 AS y, CAST(embedding[3] AS DOUBLE) * 10 AS a, vec_id % 3 <> 0 AS has FROM embeddings),
      g AS (SELECT *, 105 - 20 - a <= 105 AND a > -20 AND vec_id_ok AS wide FROM (SELECT *, true AS vec_id_ok FROM f)),
      v AS (SELECT *, CASE k % 4 WHEN 0 THEN abs(34 - (34 + a)) <= 10 WHEN 1 THEN true WHEN 2 THEN false ELSE false END AS sees FROM g)
      SELECT k, has AS has_360, CASE WHEN has THEN sees END AS goal_visible,
        round(CASE WHEN has AND sees THEN abs(atan2(34 + 3.66 - y, 105 - x) - atan2(34 - 3.66 - y, 105 - x)) END, 9) AS visible_goal_angle,
        CASE WHEN has THEN 1 END AS visible_teammates, CASE WHEN has THEN 1 END AS visible_opponents, round(CASE WHEN has THEN sqrt(x * x + y * y) END, 6) AS nearest_defender_distance FROM v""",
)
def frame_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GE1-7, FN10: a square around the goal's height, one with the goal on its edge, one that ends before it, two corners only."""
    e = F.col("embedding")
    at = lambda i: F.get(e, i).cast("double")
    x, y, a, k = at(0) * 60 + 52, at(1) * 40 + 34, at(2) * 10, F.col("vec_id")
    area = F.when(k % 4 == 0, F.array(F.lit(90.0), 24 + a, F.lit(120.0), 24 + a, F.lit(120.0), 44 + a, F.lit(90.0), 44 + a))
    area = area.when(k % 4 == 1, F.array(*(F.lit(v) for v in (0.0, 0.0, 105.0, 0.0, 105.0, 68.0, 0.0, 68.0)))).when(k % 4 == 2, F.array(*(F.lit(v) for v in (0.0, 0.0, 104.0, 0.0, 104.0, 68.0, 0.0, 68.0))))
    area = area.otherwise(F.array(*(F.lit(v) for v in (0.0, 0.0, 200.0, 200.0))))
    who = lambda mate, actor, px, py: F.struct(F.lit(mate).alias("teammate"), F.lit(actor).alias("actor"), F.lit(False).alias("keeper"), F.lit(px).alias("x"), F.lit(py).alias("y"))
    frame = F.when(k % 3 != 0, F.array(who(True, True, 1.0, 1.0), who(True, False, 2.0, 2.0), who(False, False, 0.0, 0.0), who(False, False, None, None)))
    made = geometry.frame_features(frame, area, x, y, x, y)
    keep = ("has_360", "goal_visible", "visible_goal_angle", "visible_teammates", "visible_opponents", "nearest_defender_distance")
    return table(spark, sf_dir, "embeddings").select(k.alias("k"), *(made[c].alias(c) for c in keep)).withColumns({"visible_goal_angle": F.round("visible_goal_angle", 9), "nearest_defender_distance": F.round("nearest_defender_distance", 6)})


# Features, labels and the model dataset -----------------------------------------------------------------------

_STATES = {
    "type_name": f"{array(ACTION_TYPES)}[event_id % {len(ACTION_TYPES)} + 1]",
    "result_name": f"{array(RESULTS)}[event_id % {len(RESULTS)} + 1]",
    "bodypart_name": f"{array(BODY_PARTS)}[event_id % {len(BODY_PARTS)} + 1]",
    "start_x": "value / 5",
    "start_y": "value / 7",
    "end_x": "105 - value / 6",
    "end_y": "68 - value / 9",
}


def action_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions of the event stream in the action vocabulary, with a running score."""
    pick = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), (F.col("event_id") % len(values) + 1).cast("int"))
    v = F.col("value")
    rows = states.running_score(actions(spark, sf_dir), F.col("team_id") == 0, F.col("goal"), F.col("own_goal"))
    return rows.withColumns({"type_name": pick(ACTION_TYPES), "result_name": pick(RESULTS), "bodypart_name": pick(BODY_PARTS), "start_x": v / 5, "start_y": v / 7, "end_x": 105 - v / 6, "end_y": 68 - v / 9})


def _features_sql() -> tuple[str, dict[str, str]]:
    fields = ("type_name", "result_name", "bodypart_name", "period", "time_seconds", "start_x", "start_y", "end_x", "end_y", "team_id")
    lags = ", ".join(f"{f} AS {f}_a0" for f in fields) + ", " + ", ".join(f"coalesce(lag({f}, {k}) OVER g, first_value({f}) OVER g) AS {f}_a{k}" for k in (1, 2) for f in fields)
    out: dict[str, str] = {}
    one = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"
    for k in range(3):
        out |= {f"actiontype_{t}_a{k}": one(f"type_name_a{k} = '{t}'") for t in ACTION_TYPES}
        out |= {f"result_{r}_a{k}": one(f"result_name_a{k} = '{r}'") for r in RESULTS}
        out |= {f"actiontype_{t}_result_{r}_a{k}": one(f"type_name_a{k} = '{t}' AND result_name_a{k} = '{r}'") for t in ACTION_TYPES for r in RESULTS}
        out |= {f"bodypart_{b}_a{k}": one(f"bodypart_name_a{k} = '{b}'") for b in BODY_PARTS}
        out |= {f"period_id_a{k}": f"period_a{k}", f"time_seconds_a{k}": f"time_seconds_a{k}", f"time_seconds_overall_a{k}": f"(period_a{k} - 1) * 2700 + time_seconds_a{k}"}
        out |= {f"{n}_a{k}": f"{n}_a{k}" for n in ("start_x", "start_y", "end_x", "end_y")}
        for side in ("start", "end"):
            dx, dy = f"abs(105 - {side}_x_a{k})", f"abs(34 - {side}_y_a{k})"
            out |= {f"{side}_dist_to_goal_a{k}": f"sqrt({dx} * {dx} + {dy} * {dy})", f"{side}_angle_to_goal_a{k}": f"atan2({dy}, {dx})"}
        dx, dy = f"(end_x_a{k} - start_x_a{k})", f"(end_y_a{k} - start_y_a{k})"
        out |= {f"dx_a{k}": dx, f"dy_a{k}": dy, f"movement_a{k}": f"sqrt({dx} * {dx} + {dy} * {dy})"}
    for k in (1, 2):
        dx, dy = f"(start_x_a0 - end_x_a{k})", f"(start_y_a0 - end_y_a{k})"
        out |= {f"team_{k}": one(f"team_id_a{k} = team_id_a0"), f"time_delta_{k}": f"time_seconds_a0 - time_seconds_a{k}", f"dx_a0{k}": dx, f"dy_a0{k}": dy, f"mov_a0{k}": f"sqrt({dx} * {dx} + {dy} * {dy})"}
    out |= {"goalscore_team": "CASE WHEN team_id = 0 THEN h ELSE a END", "goalscore_opponent": "CASE WHEN team_id = 0 THEN a ELSE h END", "goalscore_diff": "CASE WHEN team_id = 0 THEN h - a ELSE a - h END"}
    with_ = f"""WITH {ACTIONS_SQL}, st AS (SELECT * REPLACE ({_STATES['type_name']} AS type_name), {', '.join(f'{v} AS {k}' for k, v in _STATES.items() if k != 'type_name')} FROM actions),
      sc AS (SELECT *, sum(CASE WHEN period <> 5 AND ((goal AND team_id = 0) OR (own_goal AND team_id <> 0)) THEN 1 ELSE 0 END) OVER w AS h, sum(CASE WHEN period <> 5 AND ((goal AND team_id <> 0) OR (own_goal AND team_id = 0)) THEN 1 ELSE 0 END) OVER w AS a
        FROM st WINDOW w AS (PARTITION BY match_id ORDER BY action_id ROWS UNBOUNDED PRECEDING)),
      gs AS (SELECT match_id, action_id, period, team_id, h, a, {lags} FROM sc WINDOW g AS (PARTITION BY match_id, period ORDER BY action_id))"""
    return with_, out


_WITH_FEATURES, _FEATURES = _features_sql()


_WHOLE = ("actiontype_", "result_", "bodypart_", "period_id_", "team_", "goalscore_")  # features that are whole numbers


def _extreme(name: str, sql: str) -> str:
    if name.startswith(_WHOLE):
        return f'CAST(sum({sql}) AS DOUBLE) AS "{name}"'
    return f'CAST(max({sql}) AS DOUBLE) AS "{name}"' if name.startswith("time_") else f'round(CAST(max({sql}) AS DOUBLE), 6) AS "{name}"'


@query("feature_summary", f"{_WITH_FEATURES} SELECT match_id, period, " + ", ".join(_extreme(k, v) for k, v in _FEATURES.items()) + " FROM gs GROUP BY match_id, period")
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE1, FE2: all 568 features, summed (whole numbers) or by their largest value, over every match and period."""
    made = features.features(action_states(spark, sf_dir), ("match_id", "action_id", "period"))
    whole = lambda c: F.sum(c) if c.startswith(_WHOLE) else F.max(c) if c.startswith("time_") else F.round(F.max(c), 6)
    return made.groupBy("match_id", "period").agg(*(whole(c).alias(c) for c in features.names()))


_LAB = """lab AS (SELECT *, max(CASE WHEN (goal AND team_id = 0) OR (own_goal AND team_id <> 0) THEN 1 ELSE 0 END) OVER w AS h, max(CASE WHEN (goal AND team_id <> 0) OR (own_goal AND team_id = 0) THEN 1 ELSE 0 END) OVER w AS a
      FROM actions WHERE period <> 5 WINDOW w AS (PARTITION BY match_id ORDER BY action_id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING))"""


@query(
    "model_dataset",
    f"""WITH {ACTIONS_SQL}, {_LAB}, us AS (SELECT DISTINCT user_id FROM events), sp AS (SELECT user_id AS match_id, CASE WHEN user_id % 10 < 7 THEN 'train' WHEN user_id % 10 < 9 THEN 'validation' ELSE 'test' END AS split FROM us)
      SELECT match_id, action_id, CAST(value AS FLOAT) AS value, CASE WHEN team_id = 0 THEN h ELSE a END = 1 AS scores, CASE WHEN team_id = 0 THEN a ELSE h END = 1 AS concedes, split,
        'features-v1' AS features_version, 'labels-v1' AS labels_version, 'splits-v1' AS splits_version FROM lab JOIN sp USING (match_id)""",
)
def model_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1, JN3, JN4, JN5, FLT1, FLT3, SRC9 (without its file): the three splits, each asked for by name."""
    rows = actions(spark, sf_dir)
    made = labels.labels(rows, F.col("team_id") == 0, F.col("goal"), F.col("own_goal"))
    m = F.col("match_id") % 10
    split = rows.select("match_id").distinct().withColumn("split", F.when(m < 7, "train").when(m < 9, "validation").otherwise("test"))
    out = dataset.model_dataset(rows.select("match_id", "action_id", "value"), made, split, ["value"])
    return dataset.of_split(out, "train").unionByName(dataset.of_split(out, "validation")).unionByName(dataset.of_split(out, "test", allow_test=True))


@query(
    "scored_actions",
    f"WITH {ACTIONS_SQL} SELECT match_id, action_id, type_name, p_score, CASE WHEN match_id % 3 = 0 THEN 'in_sample' WHEN match_id % 3 = 1 THEN 'model_selection' ELSE 'untouched_test' END AS origin FROM actions WHERE period <> 5",
)
def scored_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN2, JN6, ML14."""
    rows = actions(spark, sf_dir)
    split = F.when(F.col("match_id") % 3 == 0, "train").when(F.col("match_id") % 3 == 1, "validation").otherwise("test")
    predictions = rows.where("period <> 5").select("match_id", "action_id", "p_score", valuation.origin(split).alias("origin"))
    return valuation.scored(predictions, rows.select("match_id", "action_id", "type_name")).select("match_id", "action_id", "type_name", "p_score", "origin")


_CONVERTED = """n AS (SELECT event_id AS e, user_id AS m, event_id % 11 AS j, value FROM events),
      ev AS (SELECT e, m AS match_id, e % 2 + 1 AS team_id, ['pass', 'dribble', 'carry', 'foul_committed', 'duel', 'interception', 'shot', 'own_goal_against', 'goalkeeper', 'clearance', 'miscontrol'][j + 1] AS k,
        CASE WHEN j = 0 THEN ['open', 'free_kick', 'corner', 'goal_kick', 'throw_in', 'interception'][e % 6 + 1] WHEN j = 4 THEN CASE WHEN e % 2 = 0 THEN 'tackle' ELSE 'aerial' END
          WHEN j = 6 THEN ['open', 'free_kick', 'penalty'][e % 3 + 1] WHEN j = 8 THEN ['save', 'punch', 'collected', 'goal_conceded'][e % 4 + 1] END AS sub,
        CASE WHEN j IN (0, 1) THEN CASE WHEN e % 5 = 0 THEN 'incomplete' ELSE 'complete' END WHEN j = 6 THEN CASE WHEN e % 5 = 0 THEN 'goal' ELSE 'saved' END WHEN j IN (4, 5) THEN CASE WHEN e % 5 = 0 THEN 'lost_in_play' ELSE 'won' END END AS said,
        e % 4 = 0 AS crossed, value / 500 * 120 AS lx, value / 500 * 80 AS ly, 60.0 AS ex, CAST(e % 80 AS DOUBLE) AS ey FROM n),
      b AS (SELECT *, CASE WHEN k = 'pass' AND sub = 'free_kick' THEN CASE WHEN crossed THEN 'freekick_crossed' ELSE 'freekick_short' END WHEN k = 'pass' AND sub = 'corner' THEN CASE WHEN crossed THEN 'corner_crossed' ELSE 'corner_short' END
          WHEN k = 'pass' AND sub = 'goal_kick' THEN 'goalkick' WHEN k = 'pass' AND sub = 'throw_in' THEN 'throw_in' WHEN k = 'pass' AND crossed THEN 'cross' WHEN k = 'pass' THEN 'pass' WHEN k = 'dribble' THEN 'take_on' WHEN k = 'carry' THEN 'dribble'
          WHEN k = 'foul_committed' THEN 'foul' WHEN k = 'duel' AND sub = 'tackle' THEN 'tackle' WHEN k = 'interception' THEN 'interception' WHEN k = 'shot' AND sub = 'free_kick' THEN 'shot_freekick' WHEN k = 'shot' AND sub = 'penalty' THEN 'shot_penalty'
          WHEN k = 'shot' THEN 'shot' WHEN sub = 'save' THEN 'keeper_save' WHEN sub = 'punch' THEN 'keeper_punch' WHEN sub = 'collected' THEN 'keeper_claim' WHEN k = 'clearance' THEN 'clearance' WHEN k IN ('miscontrol', 'own_goal_against') THEN 'bad_touch' END AS type_name,
        CASE WHEN k = 'own_goal_against' THEN 'owngoal' WHEN k IN ('pass', 'dribble') THEN CASE WHEN said = 'complete' THEN 'success' ELSE 'fail' END WHEN k IN ('foul_committed', 'miscontrol') THEN 'fail' WHEN k = 'shot' THEN CASE WHEN said = 'goal' THEN 'success' ELSE 'fail' END
          WHEN k IN ('duel', 'interception') THEN CASE WHEN said LIKE 'lost%' THEN 'fail' ELSE 'success' END ELSE 'success' END AS result_name,
        greatest(0.0, least(105.0, (lx - 0.05) / 120 * 105)) AS sx, greatest(0.0, least(68.0, 68 - (ly - 0.05) / 80 * 68)) AS sy,
        CASE WHEN k IN ('pass', 'carry', 'shot') THEN greatest(0.0, least(105.0, (ex - 0.05) / 120 * 105)) ELSE greatest(0.0, least(105.0, (lx - 0.05) / 120 * 105)) END AS fx,
        CASE WHEN k IN ('pass', 'carry', 'shot') THEN greatest(0.0, least(68.0, 68 - (ey - 0.05) / 80 * 68)) ELSE greatest(0.0, least(68.0, 68 - (ly - 0.05) / 80 * 68)) END AS fy FROM ev),
      t AS (SELECT e, match_id, team_id, type_name, result_name, k, sub, CASE WHEN team_id = 2 THEN 105 - sx ELSE sx END AS start_x, CASE WHEN team_id = 2 THEN 68 - sy ELSE sy END AS start_y,
        CASE WHEN team_id = 2 THEN 105 - fx ELSE fx END AS end_x, CASE WHEN team_id = 2 THEN 68 - fy ELSE fy END AS end_y FROM b WHERE type_name IS NOT NULL),
      p AS (SELECT e, match_id, team_id, CAST(e AS DOUBLE) AS o, CASE WHEN k = 'pass' AND sub = 'interception' THEN 1 ELSE 0 END AS part, type_name, result_name, start_x, start_y, end_x, end_y FROM t
        UNION ALL SELECT e, match_id, team_id, CAST(e AS DOUBLE), 0, 'interception', 'success', start_x, start_y, start_x, start_y FROM t WHERE k = 'pass' AND sub = 'interception'),
      x AS (SELECT *, lead(start_x) OVER w AS nx, lead(start_y) OVER w AS ny, lead(team_id) OVER w AS nt, lead(type_name) OVER w AS nk, lead(e) OVER w AS ne FROM p WINDOW w AS (PARTITION BY match_id ORDER BY o, part)),
      y AS (SELECT match_id, e AS source, team_id, type_name, result_name, start_x, start_y, end_x, end_y, CAST(e AS DOUBLE) AS ts, o, part FROM p
        UNION ALL SELECT match_id, NULL, team_id, 'dribble', 'success', end_x, end_y, nx, ny, (e + ne) / 2.0, o + 0.5, 0 FROM x
          WHERE nt = team_id AND sqrt((nx - end_x) * (nx - end_x) + (ny - end_y) * (ny - end_y)) BETWEEN 3 AND 60 AND ne - e < 10 AND nk <> 'dribble' AND type_name <> 'dribble')"""


@query(
    "converted_actions",
    f"""WITH {_CONVERTED} SELECT match_id, row_number() OVER (PARTITION BY match_id ORDER BY ts, o, part) - 1 AS action_id, team_id, type_name, result_name, round(start_x, 6) AS start_x, round(start_y, 6) AS start_y,
      round(end_x, 6) AS end_x, round(end_y, 6) AS end_y, round(ts, 3) AS time_seconds, source IS NULL AS is_synthetic FROM y""",
)
def converted_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SP1, PRJ11, ST1, WN9, WN10, JN8, FLT4."""
    out = conversion.convert(*convertible(spark, sf_dir))
    return out.select("match_id", F.col("action_id").cast("bigint").alias("action_id"), "team_id", "type_name", "result_name", *(F.round(c, 6).alias(c) for c in ("start_x", "start_y", "end_x", "end_y")), F.round("time_seconds", 3).alias("time_seconds"), "is_synthetic")


def convertible(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Typed events of the eleven kinds that become actions, a second apart."""
    j = "e % 11"
    of = lambda values, n: f"element_at(array({', '.join(repr(v) for v in values)}), cast(e % {n} + 1 as int))"
    sub = f"""CASE WHEN {j} = 0 THEN {of(('open', 'free_kick', 'corner', 'goal_kick', 'throw_in', 'interception'), 6)} WHEN {j} = 4 THEN CASE WHEN e % 2 = 0 THEN 'tackle' ELSE 'aerial' END
      WHEN {j} = 6 THEN {of(('open', 'free_kick', 'penalty'), 3)} WHEN {j} = 8 THEN {of(('save', 'punch', 'collected', 'goal_conceded'), 4)} END"""
    said = f"""CASE WHEN {j} IN (0, 1) THEN CASE WHEN e % 5 = 0 THEN 'incomplete' ELSE 'complete' END WHEN {j} = 6 THEN CASE WHEN e % 5 = 0 THEN 'goal' ELSE 'saved' END WHEN {j} IN (4, 5) THEN CASE WHEN e % 5 = 0 THEN 'lost_in_play' ELSE 'won' END END"""
    ends = "concat('{\"end_location\":[60,', e % 80, ']', CASE WHEN e % 4 = 0 THEN ',\"cross\":true' ELSE '' END, '}')"
    raw = f"""concat('{{"location":[', cast(value / 500 * 120 as string), ',', cast(value / 500 * 80 as string), '],"pass":', {ends}, ',"carry":', {ends}, ',"shot":', {ends}, '}}')"""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("e"), F.col("user_id").alias("match_id"), "value")
    kinds = ("pass", "dribble", "carry", "foul_committed", "duel", "interception", "shot", "own_goal_against", "goalkeeper", "clearance", "miscontrol")
    rows = rows.select(
        "match_id", F.expr(_UUID).alias("source_event_id"), F.col("e").alias("source_event_index"), F.lit(1).alias("period"), (F.col("e") * 1000).alias("clock_ms"), (F.col("e") % 2 + 1).alias("team_id"), F.lit(7).cast("bigint").alias("player_id"),
        F.lit(1).cast("bigint").alias("possession_id"), F.lit(1).cast("bigint").alias("possession_team_id"), F.expr(of(kinds, 11)).alias("event_type"), F.expr(sub).alias("event_subtype"), F.expr(said).alias("outcome"), F.lit(None).cast("string").alias("body_part"), F.expr(raw).alias("raw_details"),
    )
    return rows, rows.select("match_id").distinct().select("match_id", F.lit(1).cast("bigint").alias("home_team_id"))


@query(
    "conversion_counts",
    f"""WITH {_CONVERTED}, s AS (SELECT match_id, count(*) AS events FROM ev GROUP BY match_id), a AS (SELECT match_id, count(*) AS actions, count(DISTINCT source) AS mapped, count_if(source IS NULL) AS synthetic FROM y GROUP BY match_id)
      SELECT match_id, events, actions, mapped, events - mapped AS excluded, synthetic FROM s JOIN a USING (match_id)""",
)
def conversion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG8."""
    events, matches = convertible(spark, sf_dir)
    return conversion.conversion_report(events, conversion.convert(events, matches))


# Single operators ---------------------------------------------------------------------------------------------


@query(
    "text_functions",
    """SELECT event_id, strftime(CAST(ts AS DATE) + CASE WHEN event_id % 3 = 0 THEN INTERVAL 0 SECOND ELSE to_seconds(event_id % 86400) END, '%Y-%m-%d %H:%M:%S') AS kick_off, (event_id % 24 * 60 + event_id % 60) * 60000 + CASE WHEN event_id % 2 = 0 THEN 59120 ELSE 0 END AS clock_ms,
      '00000000-0000-4000-8000-' || lpad(lower(hex(event_id)), 12, '0') AS uuid, event_id = 0 AS nil, CASE WHEN event_id % 5 <> 0 THEN value END AS finite, event_id % 7 <> 0 AS commit_ok, event_id % 2 = 0 AS digest_ok FROM events""",
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN6-9, FN13, FN22, FN25."""
    e = F.col("event_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    clock = F.concat(two(e % 24), F.lit(":"), two(e % 60), F.when(e % 2 == 0, ":59.120").otherwise(""))
    seconds = e % 86400
    time = F.when(e % 3 != 0, F.concat_ws(":", two(F.floor(seconds / 3600)), two(F.floor(seconds / 60) % 60), two(seconds % 60)))
    bare = F.concat(F.lit("{"), F.upper(F.concat(F.lit("00000000000040008000"), F.lpad(F.hex(e), 12, "0"))), F.lit("}"))
    nil = F.when(e == 0, F.lit("00000000-0000-0000-0000-000000000000")).otherwise(F.lit("1"))
    number = F.when(e % 5 != 0, F.col("value")).when(e % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(text.kick_off(F.to_date("ts"), time), "yyyy-MM-dd HH:mm:ss").alias("kick_off"),
        text.clock_ms(clock).alias("clock_ms"),
        text.uuid_text(bare).alias("uuid"),
        text.is_nil_uuid(nil).alias("nil"),
        text.finite(number).alias("finite"),
        text.is_commit(F.when(e % 7 != 0, F.sha1(e.cast("string"))).otherwise("beef")).alias("commit_ok"),
        text.is_sha256(F.when(e % 2 == 0, F.sha2(e.cast("string"), 256)).otherwise(F.upper(F.sha2(F.lit("A"), 256)))).alias("digest_ok"),
    )


@query("increasing_ids", "SELECT match_id, action_id, event_id FROM (SELECT user_id AS match_id, event_id, (event_id * 7919) % 1009 AS action_id, lag((event_id * 7919) % 1009) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) WHERE b >= action_id")
def increasing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN16, VAL17."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("match_id"), "event_id", (F.col("event_id") * 7919 % 1009).alias("action_id"))
    return states.increasing(rows, "event_id").select("match_id", "action_id", "event_id")


@query("mixed_lineage", "SELECT 'lang' AS \"column\", count(DISTINCT lang) AS \"values\" FROM documents UNION ALL SELECT 'source', count(DISTINCT source) FROM documents")
def mixed_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL16, AG13."""
    rows = table(spark, sf_dir, "documents").withColumn("version", F.lit("v1"))
    return validation.single_values(rows, ["lang", "source", "version"])


@query(
    "probability_faults",
    f"WITH {ACTIONS_SQL}, r AS (SELECT *, CASE WHEN event_id % 13 = 0 THEN p_score + 1 ELSE p_score END AS q FROM actions) SELECT match_id, action_id FROM r WHERE q > 1 OR event_id % 17 = 0",
)
def probability_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL19."""
    e = F.col("event_id")
    rows = actions(spark, sf_dir).withColumn("p_score", F.when(e % 13 == 0, F.col("p_score") + 1).otherwise(F.col("p_score")))
    off = F.when(e % 17 == 0, 1e-6).otherwise(0.0)
    rows = rows.withColumns({"score_before": F.lit(0.1), "concede_before": F.lit(0.2), "offensive": F.lit(0.25), "defensive": F.lit(0.5), "vaep": F.lit(0.75) + off})
    return valuation.faults(rows).select("match_id", "action_id")


@query("input_faults", "SELECT count_if(n_chars % 9 = 0 OR n_chars > 5000) AS bad_probabilities, count(DISTINCT quality) < 2 AS class_missing FROM labels JOIN documents USING (doc_id)")
def input_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML10 input checks, VAL19."""
    n = F.col("n_chars")
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(F.when(n % 9 == 0, F.lit(float("nan"))).otherwise(n / 5000).alias("p"), F.col("quality").alias("y"))
    return metrics.faulty(rows)


@query("groups_of_one_class", "SELECT o_custkey AS g, count(DISTINCT o_totalprice > 150000) AS classes FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_totalprice > 150000) < 2")
def groups_of_one_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL22."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), (F.col("o_totalprice") > 150000).alias("y"))
    return validation.two_classes(rows, "g", "y")


@query("one_to_one_join", "SELECT o_orderkey, o_totalprice, price FROM orders JOIN (SELECT l_orderkey AS o_orderkey, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY l_orderkey) USING (o_orderkey)")
def one_to_one_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return snapshots.one_to_one(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), lines, ["o_orderkey"])


@query("bundle_hash", "SELECT p_partkey, sha256(concat_ws(chr(10), sha256(p_name), CASE WHEN p_size > 25 THEN sha256(p_type) ELSE 'missing' END, sha256(p_brand))) AS digest FROM part")
def bundle_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH1 (the digest of the components' digests), FN5."""
    return table(spark, sf_dir, "part").select("p_partkey", hashing.bundle_digest([F.sha2("p_name", 256), F.when(F.col("p_size") > 25, F.sha2("p_type", 256)), F.sha2("p_brand", 256)]).alias("digest"))


@query("split_counts", "SELECT CASE WHEN r < greatest(1, least(n - 2, n * 70 // 100)) THEN 'train' WHEN r < greatest(greatest(1, least(n - 2, n * 70 // 100)) + 1, least(n - 1, n * 85 // 100)) THEN 'validation' ELSE 'test' END AS split, count(*) AS matches FROM (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders) GROUP BY 1")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT3, WN11."""
    return split_orders(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("matches"))


@query("latest_runs", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    return snapshots.latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey", "o_totalprice")

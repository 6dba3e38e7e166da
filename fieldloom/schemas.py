"""Fixed schemas and the contract versions that every written table carries."""

from __future__ import annotations

from pyspark.sql import types as T

#: Contract versions, written beside every table.
VERSIONS = {
    "events": "events-v1",
    "actions": "actions-v1",
    "states": "states-v1",
    "features": "features-v1",
    "geometry": "geometry-v1",
    "labels": "labels-v1",
    "splits": "splits-v1",
    "dataset": "dataset-v1",
    "calibration": "calibration-v1",
    "values": "values-v1",
    "players": "players-v1",
    "minutes": "minutes-v1",
    "fingerprint": "fingerprint-v1",
}

L, I, D, S, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _struct(spec: str) -> T.StructType:
    kinds = {"long": L, "int": I, "double": D, "string": S, "boolean": B, "date": T.DateType(), "strings": T.ArrayType(S), "longs": T.ArrayType(L), "doubles": T.ArrayType(D)}
    return T.StructType([T.StructField(n.rstrip("!"), kinds[k], not n.endswith("!")) for n, k in (x.split(":") for x in spec.split())])


#: Typed events (29 fields; ! marks what can't be null).
EVENTS = _struct(
    "source!:string source_event_id!:string source_record_index!:int source_event_index!:int match_id!:long team_id!:long player_id:long possession_id!:long "
    "possession_team_id!:long event_type!:string event_subtype:string period!:int clock_ms!:long minute!:int second!:int duration:double x:double y:double "
    "end_x:double end_y:double outcome:string body_part:string recipient_id:long xg:double play_pattern:string under_pressure!:boolean counterpress!:boolean "
    "related_event_ids!:strings raw_details:string"
)
INTERVALS = _struct(
    "source!:string match_id!:long team_id!:long player_id!:long player_name!:string position_id!:int position!:string from_seconds!:int to_seconds:int "
    "from_period!:int to_period:int start_reason:string end_reason:string source_record_index!:int"
)
#: Per-action rows that labels, features and values work on.
ACTIONS = _struct(
    "match_id!:long action_id!:long period!:int time_seconds!:double team_id!:long player_id:long type_name!:string result_name!:string bodypart_name!:string "
    "start_x!:double start_y!:double end_x!:double end_y!:double source_event_id:string source_action_index!:int possession_id:long possession_team_id:long"
)
PLAYER_VALUES = _struct(
    "level!:string match_id:long competition_id!:long season_id!:long player_id!:long team_id!:long position!:string action_type!:string minutes!:double matches!:long "
    "actions!:long offensive!:double defensive!:double vaep!:double vaep_per_90:double offensive_per_90:double defensive_per_90:double eligible!:boolean"
)


def problems(schema: T.StructType, want: T.StructType) -> list[tuple[str, str]]:
    """(code, column) of every column of ``want`` that ``schema`` lacks or has in another type."""
    have = {f.name: f.dataType for f in schema.fields}
    out = [("schema_column_missing", f.name) for f in want.fields if f.name not in have]
    return out + [("schema_column_type_invalid", f.name) for f in want.fields if f.name in have and have[f.name].simpleString() != f.dataType.simpleString()]

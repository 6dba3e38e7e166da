"""Raw matches, events, lineups and frames: one JSON array a file, the match id in the file's name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.hashing import bundle_digest, json_digest


def raw_records(spark: SparkSession, path: str, kind: str, source: str, match_from_name: bool = True, chosen: DataFrame | None = None) -> DataFrame:
    """kind, source, match_id, source_file, source_record_index, payload, read_error of each element of the arrays in
    ``path`` (a file, folder or pattern). A file that is no JSON array gives one row with a read_error and no payload;
    an element that is no object keeps its payload beside its read_error. With ``chosen`` (match_id), only files named by
    these matches are parsed."""
    files = whole_files(spark, path)
    if chosen is not None:
        files = files.join(chosen.select("match_id").distinct(), "match_id", "left_semi")
    files = files.select("value", "source_file")
    parsed = F.try_parse_json("value")
    shape = F.schema_of_variant(parsed)
    items = F.when(shape.startswith("ARRAY"), F.try_variant_get(parsed, "$", "array<variant>"))
    broken = F.when(parsed.isNull(), "json_invalid").when(~shape.startswith("ARRAY"), "array_required")
    rows = files.withColumns({"_broken": broken, "_items": items}).select("source_file", "_broken", F.posexplode_outer("_items").alias("source_record_index", "_item"))
    rows = rows.where("_broken is not null or source_record_index is not null")
    match_id = named_match() if match_from_name else F.try_variant_get("_item", "$.match_id", "bigint")
    no_object = F.col("_item").isNotNull() & ~F.schema_of_variant("_item").startswith("OBJECT")
    return rows.select(
        F.lit(kind).alias("kind"),
        F.lit(source).alias("source"),
        match_id.alias("match_id"),
        "source_file",
        "source_record_index",
        F.when(F.col("_item").isNotNull(), F.to_json("_item")).alias("payload"),
        F.coalesce("_broken", F.when(no_object, "object_required")).alias("read_error"),
    )


def named_match() -> Column:
    """The match that a file is named by; null for other names."""
    return F.regexp_extract("source_file", r"([^/]+)\.json$", 1).try_cast("long")


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """match_id, source_file, value of each file."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file"))
    return files.select(named_match().alias("match_id"), "source_file", "value")


def inventory(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """match_id and content_hash of each match that has files: the digest of its families' digests. Spaces and the order of
    keys don't count, the order of arrays does; broken files count by their bytes."""
    parts = None
    for family, path in folders.items():
        digest = F.coalesce(json_digest("value"), F.sha2(F.coalesce("value", F.lit("")), 256))
        own = whole_files(spark, path).where("match_id is not null").select("match_id", F.lit(family).alias("family"), digest.alias("digest"))
        parts = own if parts is None else parts.unionByName(own)
    one = parts.groupBy("match_id").pivot("family", sorted(folders)).agg(F.max("digest"))
    return one.select("match_id", bundle_digest([F.col(f) for f in sorted(folders)]).alias("content_hash"))


def good(rows: DataFrame) -> DataFrame:
    return rows.where("read_error is null").drop("read_error")


def of_matches(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Records of the chosen matches (column match_id)."""
    return rows.join(matches.select("match_id").distinct(), "match_id", "left_semi")


def bundles(matches: DataFrame, events: DataFrame, lineups: DataFrame, frames: DataFrame) -> DataFrame:
    """Records a match has in each family; frames are optional."""
    count = lambda rows, name: rows.groupBy("match_id").agg(F.count(F.lit(1)).alias(name))
    out = matches.select("match_id")
    for rows, name in ((lineups, "lineups"), (events, "events"), (frames, "frames")):
        out = out.join(count(rows, name), "match_id", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out


def match_metadata(raw: DataFrame) -> DataFrame:
    """Match table from raw matches; a missing kick-off is midnight, a match id that stands twice an error."""
    v = F.parse_json("payload")
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    rows = raw.select(
        get("$.match_id", "bigint").alias("match_id"),
        get("$.competition.competition_id", "bigint").alias("competition_id"),
        get("$.season.season_id", "bigint").alias("season_id"),
        get("$.home_team.home_team_id", "bigint").alias("home_team_id"),
        get("$.away_team.away_team_id", "bigint").alias("away_team_id"),
        get("$.home_score", "int").alias("home_score"),
        get("$.away_score", "int").alias("away_score"),
        F.try_to_date(get("$.match_date", "string")).alias("match_date"),
        F.coalesce(get("$.kick_off", "string"), F.lit("00:00:00")).alias("kick_off"),
    )
    return _unique(rows, "match_id")


def _unique(rows: DataFrame, key: str) -> DataFrame:
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    checked = counted.withColumn("_ok", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{key} stands twice: "), F.col(key).cast("string"))).cast("boolean")).otherwise(F.lit(True)))
    return rows.join(checked.where("_ok").select(key), key)


def dimension(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row of each key, the last in ``order``."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order)).alias("_r")).select(key, "_r.*")

"""The staged job: raw JSON to typed tables, actions, features, labels, splits, model dataset, models, values and player
aggregates. Every stage reads and writes tables, is skipped if its output is complete, and can be run alone."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.operators import actions, dataset, features, labels, lineage, models, normalize, players, rules, snapshots, splits, states, validation, valuation
from fieldloom.schemas import VERSIONS
from fieldloom.session import cut
from fieldloom.sources import json_arrays, tables


@dataclass(frozen=True)
class Job:
    spark: SparkSession
    raw: str
    out: str
    source: str = "raw"
    minimum_minutes: float = players.MINIMUM_MINUTES
    include_frames: bool = False

    def at(self, name: str) -> str:
        return f"{self.out}/{name}"

    def table(self, name: str) -> DataFrame:
        """Active rows of a table."""
        rows = self.spark.read.parquet(self.at(name))
        if "is_active" not in rows.columns:
            return rows
        return tables.active(rows).drop("is_active", "removed_at", "removed_ingestion_run_id").withColumn("match_id", F.col("match_id").cast("long"))  # folders hold it as text

    @property
    def run_id(self) -> str:
        return lineage.run_key({"raw": self.raw, "out": self.out})[:16]

    def save(self, rows: DataFrame, name: str, version: str, by: tuple[str, ...] = ()) -> None:
        tables.write(rows, self.at(name), list(by), {version: VERSIONS[version]}, "overwrite")


FOLDERS = {"lineup": "lineups", "event": "events", "three_sixty": "three-sixty"}


def _marked(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"is_active": F.lit(True), "removed_at": F.lit(None).cast("timestamp"), "removed_ingestion_run_id": F.lit(None).cast("string")})


def _rejects(rows: DataFrame, issues: Column, payload: str = "payload") -> DataFrame:
    """match_id, family, payload, source_file, reason_code, reason of rejected rows."""
    return rows.withColumn("issues", issues).select("match_id", "family", F.col(payload).alias("payload"), "source_file", snapshots.reason_code(F.col("issues")).alias("reason_code"), F.concat_ws("; ", "issues").alias("reason"))


def ingest(job: Job) -> None:
    """Typed, validated, deduplicated events, intervals and frames of the matches whose files are new or changed since the last
    load; matches whose files are gone become inactive, those that come again active. Nothing is written if no file changed.
    Whatever is not accepted goes to quarantine with its file and reason, unless it repeats an accepted record; raw records are
    accepted, rejected or deduplicated, and a load whose counts don't add up fails."""
    spark = job.spark
    families = {k: v for k, v in FOLDERS.items() if k != "three_sixty" or job.include_frames}
    found = cut(json_arrays.inventory(spark, {k: f"{job.raw}/{v}/*.json" for k, v in families.items()}))
    known = tables.read_or_empty(spark, job.at("checkpoints"), "match_id long, content_hash string")
    plan = cut(snapshots.snapshot_diff(found, known, ["match_id"]))
    chosen, gone = plan.where("status in ('new', 'changed')"), plan.where("status = 'removed'")
    raw_matches = json_arrays.raw_records(spark, f"{job.raw}/matches/*/*.json", "match", job.source, False)
    if unreadable := raw_matches.where("read_error is not null").head():
        raise ValueError(f"raw_data_unreadable: {unreadable.source_file}: {unreadable.read_error}")
    matches = cut(json_arrays.match_metadata(json_arrays.good(raw_matches)))
    if faulty := matches.withColumn("issues", rules.issues(validation.match_rules())).where(F.size("issues") > 0).select("match_id", "issues").head():
        raise ValueError(f"match {faulty.match_id}: {'; '.join(faulty.issues)}")
    stored = tables.read_or_empty(spark, job.at("matches"), matches.schema)
    if not snapshots.contents_equal(matches, stored.select(*matches.columns)):
        job.save(matches, "matches", "events")
    if not plan.where("status <> 'unchanged'").head(1):
        return
    raw = {k: cut(json_arrays.raw_records(spark, f"{job.raw}/{v}/*.json", k, job.source, chosen=chosen).withColumn("family", F.lit(k))) for k, v in families.items()}
    rejected = [_rejects(rows.where("read_error is not null"), F.array("read_error")) for rows in raw.values()]
    beside = {k: rows.where("read_error is null").select("match_id", "source_record_index", "family", "payload", "source_file") for k, rows in raw.items()}
    place = ["match_id", "source_record_index"]

    lineups = cut(normalize.intervals(json_arrays.good(raw["lineup"])).withColumn("issues", F.when(F.col("error_code").isNotNull(), F.array("error_code")).otherwise(rules.issues(validation.interval_rules()))))
    broken = lineups.where(F.size("issues") > 0).groupBy(*place).agg(F.first("issues").alias("issues"))  # a record with a bad position is rejected whole
    rejected.append(_rejects(broken.join(beside["lineup"], place), F.col("issues")))
    good = lineups.join(broken, place, "left_anti").drop("issues", "error_code")
    intervals = cut(snapshots.last_wins(good, ["source", "match_id", "player_id", "position_id", "from_seconds"], ["source_record_index"]))

    typed = normalize.events(json_arrays.good(raw["event"]))
    named = F.coalesce("source_event_id", F.concat_ws("#", *place))  # records without an id stand for themselves
    first = cut(snapshots.first_wins(typed.withColumn("record", named), ["source", "record"], place).drop("record"))
    others = tables.read_or_empty(spark, job.at("events"), "source string, source_event_id string, match_id long").join(chosen, "match_id", "left_anti")
    first = snapshots.missing(first, others.select("source", "source_event_id"), ["source", "source_event_id"])
    checked = validation.validated_events(first, matches, intervals)
    checked = cut(checked.withColumn("issues", F.when(F.col("error_code").isNotNull(), F.array("error_code")).otherwise(F.col("issues"))).drop("error_code"))
    events = checked.where(F.size("issues") == 0).drop("issues")
    rejected.append(_rejects(checked.where(F.size("issues") > 0).select(*place, "issues").join(beside["event"], place), F.col("issues")))

    contract = validation.across_events(events, matches, intervals).unionByName(validation.across_lineups(intervals, matches.join(chosen, "match_id", "left_semi")))
    written = {"intervals": intervals, "events": events}
    if job.include_frames:
        seen = normalize.frames(json_arrays.good(raw["three_sixty"]))
        framed = snapshots.first_wins(seen.withColumn("record", named), ["source", "record"], place).drop("record")
        framed = validation.validated_frames(framed, events)
        framed = cut(framed.withColumn("issues", F.when(F.col("error_code").isNotNull(), F.array("error_code")).otherwise(F.col("issues"))).drop("error_code"))
        rejected.append(_rejects(framed.where(F.size("issues") > 0).select(*place, "issues").join(beside["three_sixty"], place), F.col("issues")))
        written["frames"] = framed.where(F.size("issues") == 0).drop("issues")
        contract = contract.unionByName(validation.across_frames(written["frames"]))
    stopping = rules.blocked(contract, ["match_id", "code"])
    if fault := stopping.head():
        raise ValueError(f"match {fault.match_id}: {fault.code}")

    bad = rejected[0]
    for part in rejected[1:]:
        bad = bad.unionByName(part)
    bad = cut(bad)
    counts = raw["event"].groupBy().agg(F.count(F.lit(1)).alias("raw")).head().raw
    accepted, refused = events.count(), bad.where("family = 'event'").count()
    lineage.Shared(spark, f"{job.out}/reports").write("ingest.json", lineage.dump({"raw": counts, "accepted": accepted, "rejected": refused, "deduplicated": counts - accepted - refused}))
    if accepted + refused > counts:
        raise ValueError("counts don't add up")

    for name, rows in written.items():
        was = tables.read_or_empty(spark, job.at(name), _marked(rows).schema).join(gone, "match_id", "left_semi")
        removed = snapshots.softly_deleted(was, gone, ["match_id"], F.lit(job.run_id), F.current_timestamp())
        tables.replace_partitions(cut(_marked(rows).unionByName(removed.select(*_marked(rows).columns))), job.at(name), "match_id", {"events": VERSIONS["events"]})
    bad.write.mode("append").option("compression", "zstd").parquet(job.at("quarantine"))
    cut(found).write.mode("overwrite").parquet(job.at("checkpoints"))


def build_actions(job: Job) -> None:
    """Actions of events that meet the conversion's contract; a breach stops the stage, warnings are reported."""
    frames = job.table("frames") if job.include_frames else job.table("events").select("match_id", "source_event_id").limit(0)
    found = cut(validation.conversion_contract(job.table("events"), job.table("intervals"), frames))
    if fault := found.where("level = 'error'").head():
        raise ValueError(f"match {fault.match_id}: {fault.code}")
    lineage.Shared(job.spark, f"{job.out}/reports").write("conversion.json", lineage.dump({r.code: r.n for r in found.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}))
    job.save(actions.convert(job.table("events"), job.table("matches")), "actions", "actions")


def _stateful(job: Job) -> DataFrame:
    rows = job.table("actions").join(job.table("matches").select("match_id", "home_team_id", "competition_id", "season_id"), "match_id")
    shot = F.col("type_name").isin(*valuation.SHOTS)
    goal, own = shot & (F.col("result_name") == "success"), F.col("result_name") == "owngoal"
    return states.possession_changed(states.running_score(rows, F.col("team_id") == F.col("home_team_id"), goal, own), ["possession_id", "possession_team_id"])


def build_features(job: Job) -> None:
    job.save(features.features(_stateful(job)), "features", "features")
    if job.include_frames:
        job.save(features.with_frames(job.table("actions"), job.table("frames"), job.table("matches")), "frame_features", "geometry")


def build_labels(job: Job) -> None:
    rows = _stateful(job)
    goal, own = labels.goal_flags(F.col("type_name"), F.col("result_name"))
    out = labels.labels(rows, F.col("team_id") == F.col("home_team_id"), goal, own)
    job.save(out.select("match_id", "action_id", "period", "competition_id", "season_id", "scores", "concedes", "eligible", "reason"), "labels", "labels")


def build_splits(job: Job) -> None:
    job.save(splits.chronological(job.table("matches")), "splits", "splits")


def build_dataset(job: Job) -> None:
    dataset.written_by_split(dataset.model_dataset(job.table("features"), job.table("labels"), job.table("splits"), features.names()), job.at("model_dataset"))


def train(job: Job, targets: tuple[str, ...] = ("scores", "concedes")) -> None:
    """Baseline, boosted candidates and calibration for each target; reports and predictions of all eligible rows."""
    rows, names = job.table("model_dataset"), features.names()
    phases = splits.validation_phases(job.table("splits")).select("match_id", "phase")
    fit, held = dataset.of_split(rows, "train"), dataset.of_split(rows, "validation").join(phases, "match_id")
    tune, fix, judge = (held.where(F.col("phase") == p) for p in splits.PHASES)
    out, reports = rows.select("match_id", "action_id", "split"), {}
    for target in targets:
        baseline = models.logistic(fit, names, target)
        candidate, model, tried = models.chosen(fit, tune, names, target)
        sigmoid = models.calibrated(models.predictions(model, fix, names), "p", target)
        score = lambda part, model=model, sigmoid=sigmoid: models.predictions(model, part, names).withColumn("p", sigmoid(F.col("p")))
        report = lambda part, target=target: models.metrics.report(part, [], "p", target).head().asDict()
        own, base = report(score(judge)), report(models.predictions(baseline, judge, names))
        reports[target] = {"candidate": candidate.name, "tried": tried, "calibrated": own, "baseline": base, "beats_baseline": models.beats(own, base)}
        model.write().overwrite().save(job.at(f"models/{target}"))
        scored = score(rows).select("match_id", "action_id", F.col("p").alias("p_score" if target == "scores" else "p_concede"))
        out = out.join(scored, ["match_id", "action_id"])
    job.save(out.withColumn("origin", valuation.origin(F.col("split"))), "predictions", "calibration")
    lineage.Shared(job.spark, f"{job.out}/reports").write("validation.json", lineage.dump(reports))


def evaluate(job: Job) -> None:
    """The frozen test: once; a second call finds the report and leaves it."""
    reports = lineage.Shared(job.spark, f"{job.out}/reports")
    if reports.read("test.json") is not None:
        return
    rows = job.table("predictions").join(job.table("labels"), ["match_id", "action_id"]).where("split = 'test'")
    reports.write("test.json", lineage.dump({t: models.metrics.report(rows, [], p, t).head().asDict() for t, p in (("scores", "p_score"), ("concedes", "p_concede"))}))


def value(job: Job) -> None:
    rows = valuation.scored(job.table("predictions").drop("split", "origin"), job.table("actions"))
    job.save(valuation.football_values(rows), "action_values", "values")


def aggregate(job: Job) -> None:
    matches = job.table("matches").select("match_id", "competition_id", "season_id")
    rows = job.table("action_values").join(matches, "match_id")
    minutes = players.player_minutes(job.table("intervals"), players.match_seconds(job.table("events")))
    job.save(players.aggregates(rows, minutes, job.minimum_minutes), "player_values", "players")


STAGES: dict[str, Callable[[Job], None]] = {
    "ingest": ingest,
    "actions": build_actions,
    "features": build_features,
    "labels": build_labels,
    "splits": build_splits,
    "dataset": build_dataset,
    "train": train,
    "evaluate": evaluate,
    "value": value,
    "aggregate": aggregate,
}


def run(job: Job, stages: list[str] | None = None) -> None:
    """Runs the stages in order. A stage is claimed by the contents of the raw files, and a stage that is done isn't run again."""
    files = json_arrays.whole_files(job.spark, f"{job.raw}/*/*.json").unionByName(json_arrays.whole_files(job.spark, f"{job.raw}/matches/*/*.json"))
    name = F.substring_index("source_file", job.raw.rstrip("/").rsplit("/", 1)[-1], -1)
    content = lineage.table_digest(files.select(name.alias("name"), F.sha2(F.coalesce("value", F.lit("")), 256).alias("digest")))
    runs = lineage.Runs(lineage.Shared(job.spark, f"{job.out}/runs"))
    for name in stages or list(STAGES):
        key, go = runs.claim({"stage": name, "raw": content, "versions": VERSIONS, "minimum_minutes": job.minimum_minutes, "frames": job.include_frames})
        if not go:
            continue
        try:
            STAGES[name](job)
        except Exception as error:
            runs.fail(key, str(error))
            raise
        runs.complete(key, {})


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("raw")
    args.add_argument("out")
    args.add_argument("--stage", action="append", choices=list(STAGES))
    args.add_argument("--minimum-minutes", type=float, default=players.MINIMUM_MINUTES)
    args.add_argument("--include-360", action="store_true")
    got = args.parse_args()
    spark = session.build("fieldloom-job")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", f"{got.out}/checkpoints"))
    run(Job(spark, got.raw, got.out, minimum_minutes=got.minimum_minutes, include_frames=got.include_360), got.stage)


if __name__ == "__main__":
    main()

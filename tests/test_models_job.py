"""Models, metrics against brute force, lineage, and the staged job from raw files to player values."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import dataset, lineage, metrics, models, splits, validation
from fieldloom.operators.vocabulary import CHANCE_FIELD
from fieldloom.plans import job
from fieldloom.schemas import ACTIONS, problems
from fieldloom.sources import tables
from fieldloom.streaming import incremental


def scored(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = [(i, f"g{i % 2}", round(rng.random(), 2)) for i in range(n)]
    return [(i, g, p, int(rng.random() < p)) for i, g, p in rows]


def test_metrics_match_brute_force(spark):
    rows = scored(spark)
    got = metrics.report(spark.createDataFrame(rows, "id int, g string, p double, y int"), []).head()
    pos, neg = [r[2] for r in rows if r[3]], [r[2] for r in rows if not r[3]]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted({r[2] for r in rows}, reverse=True):
        taken = [r for r in rows if r[2] >= t]
        recall = sum(r[3] for r in taken) / len(pos)
        ap += (recall - last) * sum(r[3] for r in taken) / len(taken)
        last = recall
    assert (got.roc_auc, got.pr_auc) == pytest.approx((wins, ap))
    assert got.brier == pytest.approx(sum((p - y) ** 2 for _, _, p, y in rows) / len(rows))


def test_group_report_needs_both_classes(spark):
    rows = [(i, "a", 0.5, 1) for i in range(200)] + [(i, "b", i / 200, i % 2) for i in range(200)]
    assert [r.g for r in metrics.group_report(spark.createDataFrame(rows, "id int, g string, p double, y int"), "g").collect()] == ["b"]


def test_models_learn_and_calibrate(spark):
    rng = random.Random(0)
    rows = [(i, float(a), rng.random(), None if i % 9 == 0 else 1.0, bool(rng.random() < (0.8 if a else 0.1))) for i in range(400) for a in [i % 2]]
    df = spark.createDataFrame(rows, "id int, f0 double, f1 double, f2 double, y boolean")
    train, tune = df.where("id < 300"), df.where("id >= 300")
    names = ["f0", "f1", "f2"]
    base = models.predictions(models.logistic(train, names, "y"), tune, names)
    own = models.predictions(models.boosted(train, tune, names, "y", models.Candidate(2, 0.3, 5, name="x")), tune, names)
    for p in (base, own):
        assert metrics.report(p, [], "p", "y").head().roc_auc > 0.7
    sigmoid = models.calibrated(own, "p", "y")
    got = own.select(F.min(sigmoid(F.col("p"))).alias("a"), F.max(sigmoid(F.col("p"))).alias("b"), F.avg(sigmoid(F.col("p"))).alias("m"), F.avg(F.col("y").cast("int")).alias("y")).head()
    assert 0 < got.a < got.b < 1 and got.m == pytest.approx(got.y, abs=0.02)
    with pytest.raises(ValueError, match="both classes"):
        models.logistic(train.where("y"), names, "y")


def test_ranking_of_candidates():
    r = lambda a, b, c: {"pr_auc": a, "log_loss": b, "brier": c}
    assert models.best([("a", r(0.2, 0.5, 0.1)), ("b", r(0.2, 0.4, 0.2)), ("c", r(0.1, 0.1, 0.1))]) == "b"
    assert models.beats(r(0.3, 0.5, 0.1), r(0.2, 0.4, 0.1)) and not models.beats(r(0.2, 0.1, 0.1), r(0.2, 0.4, 0.1))
    assert models.quality_gate({"pr_auc": 0.2, "brier": 0.05, "log_loss": 0.1, "n": 10, "positives": 1}, r(0.1, 0.2, 0.1))["passed"]


def test_test_split_is_closed(spark):
    with pytest.raises(ValueError, match="frozen"):
        dataset.of_split(spark.range(1).withColumn("split", F.lit("test")), "test")


def test_adequacy(spark):
    rows = spark.createDataFrame([(m, m % 4, m % 6, s, True) for m, s in enumerate(["train", "validation", "test"] * 4)], "match_id long, competition_id long, season_id long, split string, scores boolean")
    assert validation.adequacy(rows, ["scores"], 12, 4, 6, 4, 4).head().adequate
    assert not validation.adequacy(rows, ["scores"]).head().adequate


def test_runs_are_claimed_once(tmp_path):
    runs = lineage.Runs(tmp_path)
    key, go = runs.claim({"a": 1})
    assert go and key == lineage.run_key({"a": 1})
    with pytest.raises(RuntimeError):
        runs.claim({"a": 1})
    runs.fail(key, "x" * 5000)
    assert len(lineage.read_json(tmp_path / f"{key}.json")["message"]) == 4000
    assert runs.claim({"a": 1})[1]
    with pytest.raises(ValueError):
        runs.complete(key, {"raw": 2, "accepted": 1, "rejected": 0, "deduplicated": 0})
    runs.complete(key, {"raw": 1, "accepted": 1, "rejected": 0, "deduplicated": 0})
    assert runs.claim({"a": 1}) == (key, False)


def test_compare_runs_and_tampering(tmp_path):
    for name, doc in (("a", {"v": 1, "created_at": 1}), ("b", {"created_at": 2, "v": 1})):
        lineage.write_json(tmp_path / name / "m.json", doc)
        (tmp_path / name / "t.bin").write_bytes(b"x")
    assert lineage.compare_runs(tmp_path / "a", tmp_path / "b") == []
    (tmp_path / "b" / "t.bin").write_bytes(b"y")
    assert lineage.compare_runs(tmp_path / "a", tmp_path / "b") == [("t.bin", "different")]
    with pytest.raises(ValueError):
        lineage.verified(tmp_path / "b" / "t.bin", "0" * 64)


def test_table_digest_ignores_order_only(spark):
    a = spark.range(100).withColumn("v", F.col("id") * 2)
    assert lineage.table_digest(a) == lineage.table_digest(a.orderBy(F.desc("id")).repartition(3)) != lineage.table_digest(a.where("id > 0"))



def raw_match(folder, match_id: int, day: int) -> None:
    rng = random.Random(match_id)
    events = []
    for i in range(1, 61):
        team = 10 if (i // 6) % 2 == 0 else 20
        e = {"id": f"{match_id:08d}-0000-4000-8000-{i:012d}", "index": i, "period": 1, "timestamp": f"00:{i // 10:02d}:{i % 10 * 5:02d}.000", "minute": i // 10, "second": i % 10 * 5, "possession": i // 6 + 1, "possession_team": {"id": team, "name": "t"}, "play_pattern": {"id": 1, "name": "Regular Play"}, "team": {"id": team, "name": "t"}, "player": {"id": team * 10 + i % 3, "name": "p"}, "location": [rng.uniform(1, 119), rng.uniform(1, 79)]}
        if i % 10 == 7:
            e |= {"type": {"name": "Shot"}, "shot": {"outcome": {"name": "Goal" if i % 20 == 7 else "Saved"}, CHANCE_FIELD: 0.1, "end_location": [120, 40]}}
        else:
            e |= {"type": {"name": "Pass"}, "pass": {"end_location": [rng.uniform(1, 119), rng.uniform(1, 79)], "body_part": {"name": "Head"}}}
        events.append(e)
    events.append(events[0])
    position = {"position_id": 1, "position": "Wing", "from": "00:00", "to": None, "from_period": 1, "to_period": None}
    lineups = [{"team_id": t, "team_name": "t", "lineup": [{"player_id": t * 10 + k, "player_name": "p", "positions": [position]} for k in range(3)]} for t in (10, 20)]
    for kind, rows in (("events", events), ("lineups", lineups)):
        (folder / kind).mkdir(parents=True, exist_ok=True)
        (folder / kind / f"{match_id}.json").write_text(json.dumps(rows))


def test_job_from_raw_files(spark, tmp_path):
    folder = tmp_path / "raw"
    for m in range(1, 6):
        raw_match(folder, m, m)
    (folder / "matches" / "1").mkdir(parents=True)
    matches = [{"match_id": m, "competition": {"competition_id": 1}, "season": {"season_id": 1}, "home_team": {"home_team_id": 10}, "away_team": {"away_team_id": 20}, "home_score": 0, "away_score": 0, "match_date": f"2022-01-0{m}", "kick_off": None} for m in range(1, 6)]
    (folder / "matches" / "1" / "1.json").write_text(json.dumps(matches))
    made = job.Job(spark, str(folder), str(tmp_path / "out"), minimum_minutes=1.0)
    stages = ["ingest", "actions", "features", "labels", "splits", "dataset"]
    job.run(made, stages)
    assert made.table("events").count() == 5 * 60 and made.table("quarantine").count() == 0
    acts = made.table("actions")
    assert acts.where("not is_synthetic").count() == 300 and acts.where("is_synthetic").count() > 0
    assert made.table("splits").groupBy("split").count().count() == 3
    rows = made.table("model_dataset")
    assert rows.count() == acts.count() and len(rows.columns) == 568 + 8
    assert tables.versions_of(made.table("labels")) == {"labels": "labels-v1"}
    keys = acts.select("match_id", "action_id")
    made.save(keys.withColumns({"p_score": F.lit(0.1), "p_concede": F.lit(0.05), "split": F.lit("train"), "origin": F.lit("in_sample")}), "predictions", "calibration")
    job.run(made, [*stages, "value", "aggregate"])
    out = made.table("player_values")
    assert out.where("level = 'match' and action_type = 'all'").agg(F.sum("actions")).head()[0] == acts.count()
    assert out.where("level = 'competition_season' and action_type = 'all'").count() == 6
    assert [c for c, _ in problems(made.table("actions").schema, ACTIONS)] == []


def test_second_loads_touch_changed_matches_only(spark, tmp_path):
    folder, out = tmp_path / "raw", tmp_path / "out"
    for m in range(1, 4):
        raw_match(folder, m, m)
    (folder / "matches" / "1").mkdir(parents=True)
    row = lambda m: {"match_id": m, "competition": {"competition_id": 1}, "season": {"season_id": 1}, "home_team": {"home_team_id": 10}, "away_team": {"away_team_id": 20}, "home_score": 0, "away_score": 0, "match_date": f"2022-01-0{m}", "kick_off": None}
    (folder / "matches" / "1" / "1.json").write_text(json.dumps([row(m) for m in range(1, 6)]))
    made = job.Job(spark, str(folder), str(out))
    files = lambda: {str(p): p.stat().st_mtime_ns for p in out.rglob("*.parquet") if "/runs/" not in str(p)}
    job.run(made, ["ingest"])
    before = files()
    job.run(made, ["ingest"])  # the same contents: not even claimed
    job.ingest(made)  # nor does the stage itself write anything
    assert files() == before and made.table("events").count() == 180

    changed = json.loads((folder / "events" / "2.json").read_text())[:-2]
    changed[3]["type"]["name"], changed[4]["id"] = "Unheard Of", "no-uuid"
    (folder / "events" / "2.json").write_text(json.dumps([*changed, 7], indent=1))
    (folder / "events" / "1.json").write_text(json.dumps(json.loads((folder / "events" / "1.json").read_text()), indent=3, sort_keys=True))  # only spaces and the order of keys
    for kind in ("events", "lineups"):
        (folder / kind / "3.json").unlink()
    raw_match(folder, 4, 4)
    (folder / "events" / "4.json").write_text("[{]")
    job.run(made, ["ingest"])
    after = files()
    touched = {p.split("match_id=")[1].split("/")[0] for p, _ in set(after.items()) ^ set(before.items()) if "/events/" in p}
    assert touched == {"2", "3"}
    assert {r.match_id: r["count"] for r in made.table("events").groupBy("match_id").count().collect()} == {1: 60, 2: 57}
    assert spark.read.parquet(str(out / "events")).where("match_id = 3 and not is_active and removed_at is not null").count() == 60
    assert sorted((r.match_id, r.family, r.reason_code) for r in spark.read.parquet(str(out / "quarantine")).collect()) == [(2, "event", "malformed_uuid"), (2, "event", "object_required"), (2, "event", "unknown_event_type"), (4, "event", "json_invalid")]
    raw_match(folder, 3, 3)
    job.run(made, ["ingest"])  # it came again
    assert made.table("events").where("match_id = 3").count() == 60
    (folder / "matches" / "1" / "1.json").write_text("nothing")
    with pytest.raises(ValueError, match="raw_data_unreadable"):
        job.run(made, ["ingest"])


def test_runs_of_dead_owners_can_be_claimed(spark, tmp_path):
    for store in (str(tmp_path / "a"), lineage.Shared(spark, f"file://{tmp_path}/b")):
        runs = lineage.Runs(store, lease=-1)
        key, go = runs.claim({"x": 1})
        assert go and lineage.Runs(store).claim({"x": 1}) == (key, True)
        with pytest.raises(RuntimeError):
            lineage.Runs(store).claim({"x": 1})
        runs.complete(key, {})
        assert runs.claim({"x": 1}) == (key, False)


def test_running_sums_and_ranks_of_any_order(spark):
    from fieldloom.operators.ranges import running

    rows = [(k, v, _task) for k in ("a", "b", None) for v in range(50) for _task in (v % 7,)] + [("a", 1000, 5)]
    got = running(spark.createDataFrame(rows, "k string, v int, _task int").repartition(4), ["k"], [F.col("v")], {"sum": "v", "rows": "_task"}).collect()
    for k in ("a", "b", None):
        own = sorted((r for r in got if r.k == k), key=lambda r: r.v)
        total = 0
        for r in own:
            total += r.v
            assert r["sum"] == total and r.all_sum == sum(x.v for x in own)
    with pytest.raises(Exception, match="match_date is null"):
        splits.ranked(spark.createDataFrame([(1, None), (2, "x")], "match_id int, match_date string"), ["match_date", "match_id"]).collect()


def test_stream_of_files_is_merged_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = str(tmp_path / "t")

    def load(batch, number):
        rows = batch.select(F.regexp_extract("source_file", r"(\d+)\.json", 1).cast("long").alias("match_id"), F.lit(1).cast("long").alias("k"), F.sha2("value", 256).alias("v"))
        tables.upsert(spark, out, rows, ["match_id", "k"], "match_id")

    for n in (1, 2):
        (tmp_path / "in" / f"{n}.json").write_text(f"[{n}]")
        incremental.ingest(incremental.files(spark, str(tmp_path / "in")), str(tmp_path / "c"), load).awaitTermination()
    assert spark.read.parquet(out).count() == 2

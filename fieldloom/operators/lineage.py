"""Manifests, run keys and comparison of runs. Small documents on the driver; tables are hashed where they lie."""

from __future__ import annotations

import hashlib
import json
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields that two runs of the same inputs may differ in, and the order of a manifest's statuses.
VOLATILE = ("created_at", "completed_at", "started_at", "duration_seconds", "path", "host")
STATUSES = ("ready_for_training", "experimental", "baselines_evaluated", "validation_complete", "test_evaluation_complete", "valuation_complete", "aggregation_complete", "persistence_complete")
MESSAGE = 4000


def run_key(parts: dict) -> str:
    """SHA-256 of what a run is made from; the same inputs make the same key."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def table_digest(rows: DataFrame, groups: int = 256) -> str:
    """One digest of a table's rows in any order: rows are hashed, counted and summed into ``groups`` hashed parts."""
    row = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    value = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    parts = rows.select(row.alias("r"), value.alias("v")).groupBy(F.pmod(F.xxhash64("r"), F.lit(groups)).alias("g")).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    lines = [f"{r.g}|{r.n}|{r.s}" for r in parts.orderBy("g").collect()]  # at most ``groups`` rows
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, length and SHA-256 of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


class Local:
    """Small documents in a folder of this machine."""

    def __init__(self, folder: str | Path) -> None:
        self.folder = Path(folder)

    def read(self, name: str) -> str | None:
        path = self.folder / name
        return path.read_text(encoding="utf-8") if path.exists() else None

    def write(self, name: str, text: str) -> None:
        """Put in place as a whole."""
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        beside = path.with_name(path.name + ".part")
        beside.write_text(text, encoding="utf-8")
        beside.replace(path)

    def create(self, name: str, text: str) -> bool:
        """False where the document stands already."""
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        try:
            with path.open("x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True


class Shared:
    """The same in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm, self.folder = spark.sparkContext._jvm, folder.rstrip("/")
        self.files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self.files.exists(path):
            return None
        stream = self.files.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, path, text: str, overwrite: bool) -> None:
        out = self.files.create(path, overwrite)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def write(self, name: str, text: str) -> None:
        beside = self._path(name + ".part")
        self._put(beside, text, True)
        self.files.delete(self._path(name), False)
        self.files.rename(beside, self._path(name))

    def create(self, name: str, text: str) -> bool:
        if self.files.exists(self._path(name)):
            return False
        try:
            self._put(self._path(name), text, False)
        except Exception as error:
            if "AlreadyExists" not in str(error):
                raise
            return False
        return True


def dump(document: dict) -> str:
    return json.dumps(document, sort_keys=True, indent=2, ensure_ascii=False) + "\n"


def write_json(path: str | Path, document: dict) -> None:
    """A document put in place as a whole."""
    path = Path(path)
    Local(path.parent).write(path.name, dump(document))


def read_json(path: str | Path) -> dict:
    document = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(document, dict):
        raise ValueError(f"{path}: an object is needed")
    return document


def advance(manifest: dict, status: str, **more) -> dict:
    """The manifest with a later status; a status can't be left out or gone back to."""
    now, then = STATUSES.index(manifest.get("status", STATUSES[0])), STATUSES.index(status)
    start = max(now, 1)
    if then != now and then != start + 1:
        raise ValueError(f"{manifest.get('status')} can't be followed by {status}")
    return manifest | more | {"status": status}


class Runs:
    """A run table as one document a run key: claimed once, retried after a failure, refused while running or done. A run that
    says nothing for ``lease`` seconds counts as failed, so a killed driver doesn't hold its key for good."""

    def __init__(self, store: str | Path | Local | Shared, lease: float = 6 * 3600.0, owner: str = "") -> None:
        self.store = Local(store) if isinstance(store, (str, Path)) else store
        self.lease, self.owner = lease, owner

    def _running(self, key: str, parts: dict) -> str:
        return dump({"key": key, "parts": parts, "status": "running", "owner": self.owner, "until": time.time() + self.lease})

    def claim(self, parts: dict) -> tuple[str, bool]:
        """(key, whether the caller should run). A finished run isn't done again."""
        key = run_key(parts)
        if self.store.create(f"{key}.json", self._running(key, parts)):
            return key, True
        known = json.loads(self.store.read(f"{key}.json"))
        if known["status"] == "running" and known.get("until", 0) > time.time():
            raise RuntimeError(f"run {key} is already running")
        if known["status"] in ("failed", "running"):
            self.store.write(f"{key}.json", self._running(key, parts))
            return key, True
        return key, False

    def _set(self, key: str, **more) -> None:
        self.store.write(f"{key}.json", dump(json.loads(self.store.read(f"{key}.json")) | more))

    def complete(self, key: str, counts: dict) -> None:
        if all(k in counts for k in ("raw", "accepted", "rejected", "deduplicated")) and counts["raw"] != counts["accepted"] + counts["rejected"] + counts["deduplicated"]:
            raise ValueError("counts don't add up")
        self._set(key, status="succeeded", counts=counts)

    def fail(self, key: str, message: str) -> None:
        self._set(key, status="failed", message=message[:MESSAGE])


def canonical(document):
    """A document without its volatile fields."""
    if isinstance(document, dict):
        return {k: canonical(v) for k, v in sorted(document.items()) if k not in VOLATILE}
    return [canonical(x) for x in document] if isinstance(document, list) else document


def compare_runs(a: str | Path, b: str | Path) -> list[tuple[str, str]]:
    """(file, difference) between two folders: JSON by canonical form, all else byte by byte."""
    names = lambda top: {str(p.relative_to(top)): p for p in sorted(Path(top).rglob("*")) if p.is_file()}
    left, right = names(a), names(b)
    out = [(n, "missing") for n in left if n not in right] + [(n, "unexpected") for n in right if n not in left]
    for name in left.keys() & right.keys():
        if name.endswith(".json"):
            same = canonical(json.loads(left[name].read_text())) == canonical(json.loads(right[name].read_text()))
        else:
            same = left[name].read_bytes() == right[name].read_bytes()
        if not same:
            out.append((name, "different"))
    return sorted(out)


def verified(path: str | Path, sha256: str) -> Path:
    """A file whose digest is the recorded one."""
    found = hashlib.sha256(Path(path).read_bytes()).hexdigest()
    if found != sha256:
        raise ValueError(f"{path} isn't the recorded file")
    return Path(path)

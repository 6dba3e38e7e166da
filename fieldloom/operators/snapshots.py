"""Incremental loads: first and last wins, snapshot differences, merges, soft deletes, quarantine, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.operators.ranges import free


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key, the first in ``order``. Decided before any validation, so a rejected first copy hides the
    others."""
    return _first(rows, keys, [F.col(c) for c in order])


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key, the last in ``order``; meant for valid rows only."""
    return _first(rows, keys, [F.desc(c) for c in order])


def _first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    place = free(rows, "_place")
    return rows.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(place) == 1).drop(place)


def snapshot_diff(source: DataFrame, checkpoints: DataFrame, keys: list[str], digest: str = "content_hash") -> DataFrame:
    """keys, old and new digest and status: new, changed, unchanged or removed."""
    new, old = source.select(*keys, F.col(digest).alias("new_hash")), checkpoints.select(*keys, F.col(digest).alias("old_hash"))
    joined = new.withColumn("_n", F.lit(True)).join(old.withColumn("_o", F.lit(True)), keys, "full_outer")  # keys and two digests only
    status = F.when(F.col("_o").isNull(), "new").when(F.col("_n").isNull(), "removed").when(F.col("new_hash") == F.col("old_hash"), "unchanged").otherwise("changed")
    return joined.select(*keys, "old_hash", "new_hash", status.alias("status"))


def merged(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = (), mark: bool = False) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same keys. In columns ``keep`` a null of ``new`` leaves the
    old value. ``mark`` adds ``change``: inserted, updated or kept."""
    came, was = free(new, "_new"), free(old, "_old")
    joined = new.withColumn(came, F.lit(True)).alias("n").join(old.withColumn(was, F.lit(True)).alias("o"), keys, "full_outer")
    taken = F.col(f"n.{came}").isNotNull()
    columns = [F.col(c) if c in keys else (F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")) if c in keep else F.when(taken, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))).alias(c) for c in old.columns]
    change = F.when(~taken, "kept").when(F.col("o._old").isNull(), "inserted").otherwise("updated")
    return joined.select(*columns, *([change.alias("change")] if mark else []))


def softly_deleted(rows: DataFrame, gone: DataFrame, keys: list[str], run_id: Column, at: Column) -> DataFrame:
    """``rows`` where those whose keys are in ``gone`` are inactive, with the run and time that removed them."""
    mark = free(rows, "_gone")
    marked = rows.join(gone.select(*keys).distinct().withColumn(mark, F.lit(True)), keys, "left")
    dead = F.col(mark).isNotNull() & F.col("is_active")
    return marked.select(
        *[c for c in rows.columns if c not in ("is_active", "removed_at", "removed_ingestion_run_id")],
        (F.col("is_active") & ~dead).alias("is_active"),
        F.when(dead, at).otherwise(F.col("removed_at")).alias("removed_at"),
        F.when(dead, run_id).otherwise(F.col("removed_ingestion_run_id")).alias("removed_ingestion_run_id"),
    )


def revived(rows: DataFrame) -> DataFrame:
    """Rows that came again: active, without marks of removal."""
    return rows.withColumns({"is_active": F.lit(True), "removed_at": F.lit(None).cast("timestamp"), "removed_ingestion_run_id": F.lit(None).cast("long")})


def reason_code(issues: Column) -> Column:
    """The one issue of a rejected row, or that there are several."""
    return F.when(F.size(issues) == 1, F.get(issues, F.lit(0))).when(F.size(issues) > 1, F.lit("multiple_validation_errors"))


def quarantine(rows: DataFrame, issues: str, payload: Column, path: Column, root: str) -> DataFrame:
    """Rejected rows with their payload, reason and path relative to ``root``."""
    relative = F.when(path.startswith(root), F.substring(path, F.lit(len(root) + 1), F.length(path))).otherwise(path)
    return rows.where(F.size(issues) > 0).select(payload.alias("payload"), relative.alias("source_file"), reason_code(F.col(issues)).alias("reason_code"), F.concat_ws("; ", issues).alias("reason"))


def counts(rows: DataFrame, accepted: Column, rejected: Column, keys: list[str] = ()) -> DataFrame:
    """raw = accepted + rejected + deduplicated, per key."""
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("raw"), F.count_if(accepted).alias("accepted"), F.count_if(rejected).alias("rejected"), F.count_if(~accepted & ~rejected).alias("deduplicated"))
    return out.withColumn("balanced", F.col("raw") == F.col("accepted") + F.col("rejected") + F.col("deduplicated"))


def inventory(rows: DataFrame, keys: list[str], distinct: dict[str, str], total: str, parts: dict[str, Column], latest: dict[str, Column]) -> DataFrame:
    """What a table holds, per key: distinct values, rows, rows of each part (active ones, say), and largest values, -1
    where there is none."""
    found = [F.countDistinct(c).alias(name) for name, c in distinct.items()] + [F.count(F.lit(1)).alias(total)]
    found += [F.count_if(c).alias(name) for name, c in parts.items()] + [F.coalesce(F.max(c), F.lit(-1)).alias(name) for name, c in latest.items()]
    return rows.groupBy(*keys).agg(*found)


def latest(rows: DataFrame, keys: list[str], order: list[str], done: Column) -> DataFrame:
    """The newest finished row of each key (a run, an artifact): the largest in ``order``; keys without one give none."""
    own = F.struct(*(c for c in rows.columns if c not in keys))
    return rows.where(done).groupBy(*keys).agg(F.max_by(own, F.struct(*order)).alias("_latest_row")).select(*keys, "_latest_row.*")


def missing(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(known, keys, "left_anti")


def existing(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(known, keys, "left_semi")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which a key that stands twice on either side is an error."""
    def single(rows: DataFrame, name: str) -> DataFrame:
        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        first = keys[0]
        return rows.withColumn(first, F.when(n == 1, F.col(first)).otherwise(F.raise_error(F.lit(f"a key stands twice on the {name}")).cast(dict(rows.dtypes)[first])))

    return single(left, "left").join(single(right, "right"), keys, how)


def disjoint_union(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """All parts under one another; a key that stands in two parts is an error."""
    out = None
    name = free(parts[0], "_part")
    for i, part in enumerate(parts):
        part = part.withColumn(name, F.lit(i))
        out = part if out is None else out.unionByName(part)
    window, columns = Window.partitionBy(*keys), [c for c in out.columns if c != name]
    mixed = F.min(name).over(window) != F.max(name).over(window)
    checked = F.when(mixed, F.raise_error(F.lit("parts overlap")).cast("boolean")).otherwise(F.lit(True))
    return out.withColumn(name, checked).where(F.col(name)).select(*columns)


def contents_equal(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return not a.exceptAll(b).head(1) and not b.exceptAll(a).head(1)

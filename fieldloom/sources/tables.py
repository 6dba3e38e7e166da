"""Parquet tables: checked reads, atomic writes with a manifest, merges by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.snapshots import merged, quarantine
from fieldloom.schemas import problems
from fieldloom.session import cut


def read(spark: SparkSession, path: str, schema: T.StructType | None = None, columns: list[str] | None = None) -> DataFrame:
    """A table; with ``schema``, a missing or mistyped column is an error. Columns and filters reach the scan."""
    rows = spark.read.parquet(path)
    if schema is not None and (found := problems(rows.schema, schema)):
        raise ValueError("; ".join(f"{code}: {column}" for code, column in found))
    return rows.select(*columns) if columns else rows


def active(rows: DataFrame) -> DataFrame:
    return rows.where("is_active")


def of_matches(rows: DataFrame, match_ids: list[int]) -> DataFrame:
    """Rows of the listed matches; an empty list is an error."""
    if not match_ids:
        raise ValueError("match_selection_empty")
    return rows.where(F.col("match_id").isin(match_ids))


def in_match_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of a match together and in order, so that readers can go through matches one by one."""
    return rows.repartition("match_id").sortWithinPartitions("match_id", *order)


def write(rows: DataFrame, path: str, by: list[str] = (), versions: dict[str, str] | None = None, mode: str = "errorifexists") -> None:
    """Parquet with zstd. Contract versions go into the columns' metadata."""
    writer = (stamped(rows, versions) if versions else rows).write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def stamped(rows: DataFrame, versions: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(c).alias(c, metadata={"versions": versions}) if i == 0 else F.col(c) for i, c in enumerate(rows.columns)))


def versions_of(rows: DataFrame) -> dict[str, str]:
    return next((f.metadata["versions"] for f in rows.schema.fields if "versions" in f.metadata), {})


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition: str, keep: list[str] = ()) -> DataFrame:
    """Merges ``new`` into the table at ``path``, which is partitioned by ``partition`` (one of the keys): only its
    partitions are written again, each as a whole. Returns counts of inserted and updated rows."""
    touched = [r[0] for r in new.select(partition).distinct().collect()]  # the partitions of one load
    try:
        old = spark.read.parquet(path).where(F.col(partition).isin(touched))  # prunes folders
    except Exception as error:  # the first load finds no table
        if "PATH_NOT_FOUND" not in str(error):
            raise
        old = spark.createDataFrame([], new.schema)
    both = cut(merged(old, new, keys, keep, mark=True))
    both.drop("change").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(partition).parquet(path)
    return both.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def append_quarantine(rows: DataFrame, path: str, root: str = "") -> None:
    """Rejected rows of a normalised and validated table (raw_details, source_file, issues)."""
    quarantine(rows, "issues", F.col("raw_details"), F.col("source_file"), root).write.mode("append").parquet(path)


def replace_partitions(rows: DataFrame, path: str, partition: str, versions: dict[str, str]) -> None:
    """Writes the partitions that ``rows`` has, each as a whole; the others stay."""
    stamped(rows, versions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(partition).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)

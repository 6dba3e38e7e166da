"""The model dataset: features, labels and splits, one row for each eligible action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.snapshots import one_to_one
from fieldloom.schemas import VERSIONS

KEYS = ["match_id", "action_id"]


def model_dataset(features: DataFrame, labels: DataFrame, splits: DataFrame, feature_names: list[str]) -> DataFrame:
    """Eligible actions with features as floats, both targets, split and contract versions. A match without a split is an
    error. The split table has a row a match; Spark broadcasts it if it is small."""
    rows = one_to_one(features, labels.select(*KEYS, "scores", "concedes", "eligible"), KEYS).where("eligible")
    rows = rows.join(splits.select("match_id", "split"), "match_id", "left")
    checked = F.coalesce("split", F.raise_error(F.lit("a match has no split")))
    versions = [F.lit(VERSIONS[v]).alias(f"{v}_version") for v in ("features", "labels", "splits")]
    return rows.select(*KEYS, *(F.col(f"`{n}`").cast("float").alias(n) for n in feature_names), "scores", "concedes", checked.alias("split"), *versions)


def of_split(rows: DataFrame, split: str, allow_test: bool = False) -> DataFrame:
    """Rows of one split; training code can't ask for the test split."""
    if split == "test" and not allow_test:
        raise ValueError("the test split is for the frozen evaluation only")
    return rows.where(F.col("split") == split)


def written_by_split(rows: DataFrame, path: str) -> None:
    """Parquet with zstd, a folder a split, so that a split filter prunes files."""
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("split").parquet(path)

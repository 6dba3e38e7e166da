"""Chronological splits without leakage. They order the match table (a row a match), never the actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.ranges import free, running

SPLITS = ("train", "validation", "test")
PHASES = ("tune", "calibrate", "calibration_evaluation")
BLOCK = 4096  # matches in one digest of a fingerprint
ORDER = ["match_date", "kick_off", "competition_id", "season_id", "match_id"]


def ranked(matches: DataFrame, order: list[str]) -> DataFrame:
    """split_order (zero-based) and total, by ranges of the whole order, whatever its values are. Null in the first order
    column is an error."""
    first, one = order[0], free(matches, "_one")
    known = F.when(F.col(first).isNotNull(), F.lit(1).cast("long")).otherwise(F.raise_error(F.lit(f"{first} is null")).cast("long"))
    rows = running(matches.withColumn(one, known), [], [F.col(c) for c in order], {"rows": one})
    return rows.select(*matches.columns, (F.col("rows") - 1).alias("split_order"), F.col("all_rows").alias("total"))


def split_of(order: Column, n: Column) -> Column:
    """70, 15 and 15 hundredths by whole numbers, at least one match each."""
    train_end = F.greatest(F.lit(1), F.least(n - 2, F.floor(n * 70 / 100)))
    validation_end = F.greatest(train_end + 1, F.least(n - 1, F.floor(n * 85 / 100)))
    return F.when(order < train_end, "train").when(order < validation_end, "validation").otherwise("test")


def chronological(matches: DataFrame, order: list[str] = ORDER) -> DataFrame:
    """split_order, total and split of each match; fewer than three matches are an error."""
    rows = ranked(matches, order)
    enough = F.when(F.col("total") >= 3, F.lit(True)).otherwise(F.raise_error(F.lit("a split needs three matches")).cast("boolean"))
    return rows.withColumn("split", F.when(enough, split_of(F.col("split_order"), F.col("total"))))


def phase_of(order: Column, n: Column) -> Column:
    """Half of the validation matches tune, a quarter calibrates, a quarter evaluates the calibration."""
    tune = F.greatest(F.lit(1), F.floor(n * 0.5))
    calibrate = F.least(F.greatest(tune + 1, F.floor(n * 0.75)), n - 1)
    return F.when(order < tune, PHASES[0]).when(order < calibrate, PHASES[1]).otherwise(PHASES[2])


def validation_phases(splits: DataFrame) -> DataFrame:
    """phase of each validation match, in split order."""
    rows = ranked(splits.where("split = 'validation'").drop("total").withColumnRenamed("split_order", "order"), ["order"])
    return rows.withColumn("phase", phase_of(F.col("split_order"), F.col("total"))).drop("split_order", "total").withColumnRenamed("order", "split_order")


def summary(splits: DataFrame, labelled: DataFrame, start: Column) -> DataFrame:
    """Matches, actions, eligible rows, positives, first and last start of each split."""
    counts = labelled.groupBy("match_id").agg(F.count(F.lit(1)).alias("actions"), F.count_if("eligible").alias("eligible"), F.count_if("scores").alias("scores"), F.count_if("concedes").alias("concedes"))
    return (
        splits.join(counts, "match_id", "left")
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("actions", "eligible", "scores", "concedes")),
            F.date_format(F.min(start), "yyyy-MM-dd'T'HH:mm:ss").alias("first_start"),
            F.date_format(F.max(start), "yyyy-MM-dd'T'HH:mm:ss").alias("last_start"),
        )
    )


def fingerprint(splits: DataFrame) -> DataFrame:
    """One digest of the whole assignment: of the digests of ``BLOCK`` matches each, in split order."""
    row = F.struct("split_order", F.sha2(F.concat_ws("|", "match_id", "split", "split_order"), 256).alias("d"))
    chained = lambda c: F.sha2(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(c)), lambda e: e["d"])), 256)
    blocks = splits.groupBy(F.floor(F.col("split_order") / BLOCK).alias("b")).agg(chained(row).alias("d"))
    return blocks.agg(chained(F.struct("b", "d")).alias("fingerprint"))

"""Validation rules as data: ordered (code, condition) pairs that become an array of issues or the first one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]

#: Issues that reject single rows later; every other issue stops its whole selection.
DEFERRED = (
    "duplicate_event_id",
    "event_index_sequence_invalid",
    "player_not_in_match_lineup",
    "recipient_not_in_match_lineup",
    "related_event_not_found",
    "three_sixty_event_not_found",
    "visible_area_invalid",
    "freeze_frame_location_invalid",
)
MOST_ISSUES = 1000


def issues(rules: list[Rule]) -> Column:
    """Codes of all rules that a row breaks, in order; a condition that is null isn't broken."""
    return F.filter(F.array(*(F.when(broken, F.lit(code)) for code, broken in rules)), lambda c: c.isNotNull())


def first_issue(rules: list[Rule]) -> Column:
    """Code of the first rule that a row breaks; null if none."""
    return F.coalesce(*(F.when(broken, F.lit(code)) for code, broken in rules)) if rules else F.lit(None).cast("string")


def severity(code: Column, deferred: tuple[str, ...] = DEFERRED) -> Column:
    return F.when(code.isin(*deferred), "deferred").otherwise("blocking")


def report(found: DataFrame, code: str = "code", most: int = MOST_ISSUES) -> tuple[DataFrame, DataFrame]:
    """Summary (total, blocking, truncated) and the first ``most`` issues, and as many blocking ones, in a fixed order."""
    rows = found.withColumn("severity", severity(F.col(code)))
    totals = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("severity") == "blocking").alias("blocking")).withColumn("truncated", F.col("total") > most)
    order = [code, *(c for c in found.columns if c != code)]
    return totals, rows.orderBy(*order).limit(most).unionByName(rows.where("severity = 'blocking'").orderBy(*order).limit(most)).distinct()


def blocked(found: DataFrame, keys: list[str], code: str = "code") -> DataFrame:
    """Keys with an issue that isn't deferred."""
    return found.where(severity(F.col(code)) == "blocking").select(*keys).distinct()

"""Running numbers and sums over ordered rows of any number, without a task that sees all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.session import cut


def free(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` doesn't have."""
    while name in rows.columns:
        name += "_"
    return name


def running(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``rows`` with, for each name of ``sums``, the sum of its column from the first row of the key up to this one (in
    ``order``, which must be total), and ``all_<name>`` for the whole key. Rows are dealt out by ranges of keys and order and
    summed in each task; what a key's earlier tasks hold is added, a row for each task that the key spans. Nulls count 0."""
    task = free(rows, "_task")
    dealt = rows.repartitionByRange(*keys, *order).withColumn(task, F.spark_partition_id())
    dealt = cut(dealt)  # the numbers of tasks stay
    parts = dealt.groupBy(*keys, task).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(f"part_{name}") for name, c in sums.items()))
    before, whole = Window.partitionBy(*keys).orderBy(task).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    parts = parts.select(
        *(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col(task).alias("at"),
        *(F.coalesce(F.sum(f"part_{n}").over(before), F.lit(0)).alias(f"before_{n}") for n in sums), *(F.sum(f"part_{n}").over(whole).alias(f"all_{n}") for n in sums),
    )
    inside = Window.partitionBy(*keys, task).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"inside_{name}") for name, c in sums.items()))
    same = F.col(task) == F.col("at")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"k{i}"))
    return dealt.join(parts, same).select(*rows.columns, *((F.col(f"before_{n}") + F.col(f"inside_{n}")).alias(n) for n in sums), *(f"all_{n}" for n in sums))

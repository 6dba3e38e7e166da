"""What the operators of this subpackage share: inputs, the shared folder, folds and batches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from itertools import chain
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.session import cut, shared_dir

__all__ = ["cut", "shared_dir"]

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def uri(path: str) -> str:
    """A path in the form that file systems outside Spark know, too."""
    return re.sub(r"^(file:)?/(?!/)", "file:///", path)


class Tables:
    """Written tables in the shared folder: each cuts lineage, survives lost executors and can be deleted once what was
    made from it is written, too."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.paths = spark, scratch(spark, "tables"), {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` computed once; a name that stands already gets its new table beside the old one, which goes."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            if name in self.paths:
                path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids fall in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def unit_hash(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` alone."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)


def slices(batch: pa.RecordBatch, text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` whose ``text`` column holds about ``most_bytes`` bytes at most (one row at least)."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


_HELD: dict[str, object] = {}


def held(key: str, make: Callable[[], T]) -> T:
    """What a worker keeps from task to task: the last one made, so that a stage's model leaves when another stage makes its own."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


class WordTable:
    """A number for each white-space-separated word, made once by ``make(word)`` and kept in two generations of
    ``limit`` words at most; what is asked for again moves to the younger one."""

    def __init__(self, make: Callable[[str], int], limit: int = 100_000) -> None:
        self.make, self.limit, self.known, self.older = make, limit, {}, {}

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """Numbers of all words in a row, words of each text, and the words."""
        split = [x.split() for x in texts]
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        new = set().union(*split).difference(self.known)
        older, make = self.older, self.make
        self.known |= {x: older[x] if x in older else make(x) for x in new}
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum())), lengths, split


def labelled_sample(labels: DataFrame, label_col: str, allowed: Column, most: int, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and label (0 or 1) of at most ``most`` labelled rows: all of them, or those a hash of the id picks."""
    known = labels.where(allowed & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(id_col, F.col(label_col).cast("int").alias("label"))
    n = known.count()
    if n > most:
        known = known.where(unit_hash(F.col(id_col), 6) < 0.97 * most / n)
    return known.limit(most)

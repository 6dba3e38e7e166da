"""Fingerprints. A fingerprint of many rows is a hash of ordered hashes, so parts are hashed where they lie."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_json(text: str | None) -> str | None:
    """JSON with sorted keys and no spaces; the order of arrays stays. Null or broken JSON: null."""
    try:
        return None if text is None else json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def json_digest(text: pd.Series) -> pd.Series:
    """SHA-256 of the canonical form: spaces and key order don't count, array order does."""
    forms = text.map(canonical_json)
    return forms.map(lambda x: None if x is None else hashlib.sha256(x.encode()).hexdigest())


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 of fields joined by pipes; nulls are written as such."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns)), 256)


def ordered_digest(rows: DataFrame, key: str, order: str, text: Column, block: int = 1024) -> DataFrame:
    """``key``, digest: SHA-256 of the digests of a key's blocks, which are those of its rows in ``order``; a block spans
    ``block`` values of ``order``, so a key of very many rows is hashed by many tasks."""
    chained = lambda c: F.sha2(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(c)), lambda e: e["d"])), 256)
    row = F.struct(F.col(order).alias("o"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("d"))
    blocks = rows.select(key, F.floor(F.col(order) / block).alias("b"), row.alias("e")).groupBy(key, "b").agg(chained("e").alias("d"))
    return blocks.groupBy(key).agg(chained(F.struct("b", "d")).alias("digest"))


def bundle_digest(parts: list[Column]) -> Column:
    """One digest of the digests of a record's components; a missing component counts as such."""
    return F.sha2(F.concat_ws("\n", *(F.coalesce(p, F.lit("missing")) for p in parts)), 256)

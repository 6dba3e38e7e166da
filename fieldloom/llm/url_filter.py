"""URL rules in a sorted digest array.

Every rule (host and path prefix as one string) is kept as its 64-bit xxhash in one sorted array, which
executors memory-map; the strings lie beside it. A url asks for each of its host's suffixes that has the length of some
rule's host, joined with each prefix of its path that has the length of some rule's path. All questions of a batch are answered by one
vectorised binary search; where a digest is found, the stored string must be equal, so colliding digests
(several equal keys in a row are all looked at) never decide anything.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule. Host case
is folded for A-Z only. An empty path starts no rule path (rule paths begin with ``/``). Rows are returned
one for one, repeated ones too; other columns of the input, whatever their names, are not looked at.
Where no rule fits, ``verdict`` is ``allow``: the digest array lists nothing against the url.
"""

from __future__ import annotations

import io
import os
import string
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm.common import scratch, uri

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of ``url``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:end].translate(FOLD), rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return host, tail[:stop]


class DigestArray:
    """Sorted 64-bit digests with the strings they stand for; built once, then memory-mapped."""

    FILES = ("keys.npy", "offsets.npy", "allow.npy", "lengths.npy", "hosts.npy", "strings.bin")

    def __init__(self, folder: str, prefix: str = "") -> None:
        name = [os.path.join(folder, prefix + x) for x in self.FILES]
        self.keys, self.offsets, self.allow, self.lengths, self.hosts = (np.load(x, mmap_mode="r") for x in name[:5])
        self.strings = np.memmap(name[5], dtype=np.uint8, mode="r") if os.path.getsize(name[5]) else np.empty(0, np.uint8)

    @classmethod
    def files(cls, rules: Iterable[tuple[str, str]], digest=xxhash.xxh64_intdigest) -> dict[str, bytes]:
        """The index of ``rules``: (``allow`` or ``block``, host with path). A rule that stands twice keeps its first action."""
        first: dict[str, str] = {}
        for action, rule in rules:
            if action not in ("allow", "block") or rule.find("/") < 1:
                raise ValueError(f"not a rule: {action} {rule}")
            host, slash, path = rule.partition("/")
            first.setdefault(host.translate(FOLD) + slash + path, action)
        rows = sorted((digest(rule.encode()), rule.encode(), action) for rule, action in first.items())
        blob = [x[1] for x in rows]
        arrays = (
            np.array([x[0] for x in rows], np.uint64),
            np.cumsum([0, *map(len, blob)]).astype(np.int64),
            np.array([x[2] == "allow" for x in rows], bool),
            np.unique(np.array([len(x[1].decode().partition("/")[2]) + 1 for x in rows], np.int64)),
            np.unique(np.array([len(x[1].decode().partition("/")[0]) for x in rows], np.int64)),
        )
        out = {}
        for name, array in zip(cls.FILES, arrays, strict=False):
            np.save(held := io.BytesIO(), array)
            out[name] = held.getvalue()
        return out | {cls.FILES[5]: b"".join(blob)}

    def find(self, asked: list[str], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """Position of each string, -1 where it isn't stored."""
        raw = [x.encode() for x in asked]
        want = np.fromiter((digest(x) for x in raw), np.uint64, len(raw))
        at = np.searchsorted(self.keys, want)
        out = np.full(len(raw), -1, np.int64)
        inside = np.flatnonzero(at < len(self.keys))
        for i in inside[self.keys[at[inside]] == want[inside]]:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == want[i]:
                if self.strings[self.offsets[k] : self.offsets[k + 1]].tobytes() == raw[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def judge(self, pairs: list[tuple[str, str]], digest=xxhash.xxh64_intdigest) -> list[tuple[str | None, bool]]:
        """For each (host, path): the longest rule that fits, if any, and whether it allows."""
        asked: list[str] = []
        owner: list[int] = []
        lengths, hosts = self.lengths.tolist(), self.hosts.tolist()
        for i, (host, path) in enumerate(pairs):
            if not host or not path:
                continue
            prefixes = [path[:n] for n in lengths if n <= len(path)]
            for n in hosts:
                if n == len(host) or (n < len(host) and host[-n - 1] == "."):
                    asked += [host[-n:] + p for p in prefixes]
                    owner += [i] * len(prefixes)
        best: list[tuple[str | None, bool]] = [(None, True)] * len(pairs)
        found = self.find(asked, digest)
        for j in np.flatnonzero(found >= 0):
            old = best[owner[j]][0]
            if old is None or len(asked[j]) > len(old):
                best[owner[j]] = (asked[j], bool(self.allow[found[j]]))
        return best


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, host, path, rule, verdict for every row of ``pages``; see the module's text for special cases."""
    spark: SparkSession = pages.sparkSession
    prefix, folder = f"rules-{uuid.uuid4().hex}-", uri(scratch(spark, "rules"))
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    for name, data in DigestArray.files(rules).items():  # Spark hands each executor its own copy, which it maps
        with store.open_output_stream(f"{root}/{prefix}{name}") as out:
            out.write(data)
        spark.sparkContext.addFile(f"{folder}/{prefix}{name}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestArray(os.path.dirname(SparkFiles.get(prefix + DigestArray.FILES[0])), prefix)
        for batch in batches:
            pairs = [split_url(x) for x in batch.column(1).to_pylist()]
            found = index.judge(pairs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x[0] for x in pairs], pa.string()),
                    pa.array([x[1] for x in pairs], pa.string()),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array(["allow" if x[1] else "block" for x in found], pa.string()),
                ],
                names=[id_col, "host", "path", "rule", "verdict"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, url_col).mapInArrow(run, f"{id_col} {kind}, host string, path string, rule string, verdict string")

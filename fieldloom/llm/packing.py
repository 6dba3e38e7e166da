"""Bound-certified best-fit packing of tokenised documents into sequences of ``capacity`` tokens.

1. Each text becomes ids (by ``tokenizers``, plus an end id), cut into pieces of ``capacity`` only if longer.
2. Pieces are dealt evenly into partitions of about ``GROUP`` and packed best-fit decreasing in each.
3. Dual-feasible functions give a lower bound on each partition's bins. A partition whose count equals the
   bound is certified: no packing of its pieces is smaller.
4. While the total is above the bound of all pieces together, the partitions exchange: pieces of bins that are
   not full (and, from the second round on, of a share of the full bins) are dealt anew, across partitions,
   packed again and certified again; a round counts only if it needs fewer bins. It ends at the bound, or
   after two rounds with full bins that gain nothing.

Ids of a text are the ids of its white-space-separated words one after another (the vocabulary's splitting never
spans white space), so each distinct word is encoded once a worker and kept in a table of bounded size. Texts
with special-token strings or with characters that only some call white space are encoded whole.

Defined results: null or empty text: the end id alone. Rows are packed one for one, repeated ones too; null ids are
kept; other columns, whatever their names, are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import cut, held, slices

CAPACITY = 4096
GROUP = 20_000
WORDS = 100_000
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\u180e", "\u200b", "\ufeff", "<|")
# Fixed values of the vocabulary's file: how it splits text.
UNIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# The vocabulary shows each byte as one character: printable ones as they are, the others from 256 on, in order.
SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
LATIN = re.compile("[!-\u012f\u0131-\u017e]+").fullmatch


def units_of(word: str) -> list[str] | None:
    """Units of a word of Latin letters, whose composed form is the word itself; null for other words."""
    if not word.isascii() and not LATIN(word):
        return None
    low = word.lower()
    if low.isalpha():
        return [low]
    if low[-1] in ".," and low[:-1].isalpha():
        return [low[:-1], low[-1]]
    return UNIT.findall(low)


class Encoder:
    """Ids of texts as bytes of unsigned 32-bit numbers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.units = Tokenizer.from_file(path), {}
        self.words, self.older = {}, {}  # two generations; what is asked for again moves on

    @classmethod
    def of(cls, path: str) -> Encoder:
        return held(f"encoder {path}", lambda: cls(path))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Enters ``words``. A word is units (letters, a digit, signs), and new units go to the tokenizer's model. Words
        with letters beyond Latin are encoded by themselves."""
        split = [units_of(x) for x in words]
        units, known, tokenize = self.units, self.words, self.tokenizer.model.tokenize
        for unit in set().union(*(x for x in split if x)).difference(units):
            shown = unit if unit.isascii() and unit.isprintable() else unit.encode().decode("latin-1").translate(SHOWN)
            units[unit] = array("I", [t.id for t in tokenize(shown)]).tobytes()
        for word, own in zip(words, split, strict=True):
            known[word] = self._whole(word) if own is None else units[own[0]] if len(own) == 1 else b"".join(map(units.__getitem__, own))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > WORDS:
            self.older, self.words = self.words, {}
        if len(self.units) > WORDS:
            self.units = {}
        split = [None if any(map(x.__contains__, ODD)) else x.split() for x in texts]
        new = set().union(*(x for x in split if x)).difference(self.words)
        if self.older and (again := new.intersection(self.older)):
            self.words |= {x: self.older[x] for x in again}
            new -= again
        if new:
            self._learn(list(new))
        get = self.words.__getitem__
        return [self._whole(text) if words is None else b"".join(map(get, words)) for text, words in zip(texts, split, strict=True)]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """``id_col``, piece, start, length, ids_crc32 of every piece of every row."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encoder.encode([x or "" for x in part.column(1).to_pylist()])):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=[id_col, "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, best-fit decreasing; bins are numbered from 0."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, opened = 0, 0  # bit r of some: a bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = some >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some &= ~(1 << r)
        else:
            b, r, opened = opened, capacity, opened + 1
        bins[i], offsets[i] = b, capacity - r
        if r > n:
            room[r - n].append(b)
            some |= 1 << (r - n)
    return bins, offsets


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual-feasible functions; counts[n] pieces have length n."""
    n = np.arange(capacity + 1)
    counts = np.asarray(counts, np.int64)
    total = -(-int((counts * n).sum()) // capacity)
    # U_e: lengths over capacity - e count as whole bins, lengths below e as nothing
    above = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    volume = np.concatenate([[0], np.cumsum(counts * n)])
    e = np.arange(capacity // 2 + 1)
    whole = above[capacity - e + 1]
    middle = volume[capacity - e + 1] - volume[e]
    best = max(total, int((whole + -(-middle // capacity)).max()))
    # u_k: lengths are rounded to multiples of capacity / k, exact multiples of capacity / (k + 1) stay
    for k in range(1, 33):
        exact = (n * (k + 1)) % capacity == 0
        value = np.where(exact, n * k, (n * (k + 1)) // capacity * capacity)  # times k
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best


def _packed(rows: DataFrame, first: int, capacity: int) -> DataFrame:
    """``rows`` dealt evenly and packed; sequence ids from ``first`` * 2**48 on. ``rows`` must be cut."""
    n = rows.count()
    groups = max(1, -(-n // GROUP))
    names = rows.columns

    def run(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        lengths = found.column("length").to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        load = np.bincount(bins, weights=lengths).astype(np.int64)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        found = found.select(names)
        for name, column in (("sequence_id", (first << 48) + (key[0].as_py() << 24) + bins), ("offset", offsets), ("load", load[bins]), ("excess", np.full(len(bins), len(load) - bound))):
            found = found.append_column(name, pa.array(column, pa.int64()))
        return found

    dealt = rows.withColumn("_group", F.monotonically_increasing_id() % groups)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return dealt.groupBy("_group").applyInArrow(run, f"{schema}, sequence_id long, offset long, load long, excess long")


def _bins(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def pack(found: DataFrame, capacity: int = CAPACITY, rounds: int = 12) -> DataFrame:
    """``found`` (see ``pieces``) with sequence_id, offset, load (of the sequence) and excess (bins over the certified
    bound of the partition that packed it last)."""
    found = cut(found)
    names = found.columns
    histogram = np.zeros(capacity + 1, np.int64)
    for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``capacity`` rows
        histogram[r.length] = r.n
    bound = lower_bound(histogram, capacity)
    packed = cut(_packed(found, 0, capacity))
    total, stalled = _bins(packed), 0
    for round_ in range(1, rounds + 1):
        if total <= bound:
            break
        release = F.col("load") < capacity
        if round_ > 1:
            release |= F.pmod(F.xxhash64(F.lit(round_), "sequence_id"), F.lit(3)) == 0
        pool = cut(packed.where(release).select(names + ["sequence_id", "offset", "load", "excess"]))
        before = _bins(pool)
        again = cut(_packed(pool.select(names), round_, capacity))
        gained = before - _bins(again)
        if gained > 0:
            packed = cut(packed.where(~release).unionByName(again))
            total, stalled = total - gained, 0
        elif round_ > 1:
            stalled += 1
        if stalled == 2:
            break
    return packed

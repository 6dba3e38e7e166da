"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are folded: lower case, every run of other characters than letters and digits as one space.
An item of n characters may occur with up to k = ``rate`` * n edits. It is split into k + 1 pieces; k edits leave
at least one piece untouched, so every occurrence holds an exact piece at its place. One Aho-Corasick automaton
over all pieces reads each whole text once. Each piece hit proposes a place for its item; places that lie within k of
each other are one window; Myers' bit-parallel search finds the least edit distance in it, and a second search,
backwards from its end, where the match begins.

Items are taken in blocks of at most ``BLOCK`` characters of pieces, and each block's automaton, whose size that bounds,
is what executors get; every block reads all texts.

Defined results: one row for each text row and item that occurs in it, with the least distance and the first place that
has it (start and end in the folded text). Null or empty texts and items give no row; items of fewer than ``least``
folded characters occur only exactly, as whole words (next to ideographs, anywhere); items without letters and digits give no row; repeated rows and items are reported each; null
ids are kept; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import slices

BLOCK = 4_000_000
SLICE = 4 << 20
RATE = 0.08  # edits a character of an item
LEAST = 24  # folded characters of an item that may occur with edits
OTHER = re.compile(r"[\W_]+")


def folded(text: str) -> str:
    return OTHER.sub(" ", text.lower()).strip()


def budget(n: int, rate: float, least: int = 0) -> int:
    """Edits that an item of ``n`` characters may have."""
    return int(n * rate) if n >= least else 0


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word of spaced scripts goes on over ``start`` or ``end``."""
    return not any(0 < i < len(text) and " " not in text[i - 1 : i + 1] and max(text[i - 1 : i + 1]) < "\u2e80" for i in (start, end))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``item`` in k + 1 pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """An item prepared for Myers' search."""

    def __init__(self, item: str) -> None:
        self.n = len(item)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def search(self, text: str, anchored: bool = False) -> tuple[int, int]:
        """Least distance of the item to a part of ``text`` that ends at the returned place (the first such);
        ``anchored``: the part begins where ``text`` does."""
        n, get = self.n, self.masks.get
        full, high = (1 << n) - 1, 1 << (n - 1)
        plus, minus, now = full, 0, n
        best, end = n, 0
        first = int(anchored)
        for i, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            ph = minus | (~(xh | plus) & full)
            mh = plus & xh
            if ph & high:
                now += 1
            elif mh & high:
                now -= 1
            ph = ((ph << 1) | first) & full
            plus = ((mh << 1) & full) | (~(xv | ph) & full)
            minus = ph & xv
            if now < best:
                best, end = now, i
        return best, end


class Matcher:
    """Items of one block, ready to be searched for."""

    def __init__(self, items: list[str], rate: float, least: int = 0) -> None:
        self.items, self.budgets, self.least = items, [budget(len(x), rate, least) for x in items], least
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(items):
            for at, piece in pieces(item, self.budgets[i]):
                places.setdefault(piece, []).append((i, at + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of each item that occurs in the folded ``text``."""
        found: dict[int, set[int]] = {}
        if len(self.automaton):
            for last, where in self.automaton.iter(text):
                for i, end in where:
                    found.setdefault(i, set()).add(last + 1 - end)
        out = []
        for i, begins in sorted(found.items()):
            k, n = self.budgets[i], len(self.items[i])
            best = None
            begins = sorted(begins)
            if n < self.least:
                at = next((x for x in begins if whole_words(text, x, x + n)), None)
                if at is not None:
                    out.append((i, 0, at, at + n))
                continue
            at = 0
            while at < len(begins):
                low = high = begins[at]
                while at < len(begins) and begins[at] <= high + k:
                    high = begins[at]
                    at += 1
                low = max(0, low - k)
                part = text[low : high + n + k]
                if i not in self.patterns:
                    self.patterns[i] = Pattern(self.items[i]), Pattern(self.items[i][::-1])
                distance, end = self.patterns[i][0].search(part)
                if distance <= k and (best is None or distance < best[0]):
                    _, length = self.patterns[i][1].search(part[:end][::-1], anchored=True)
                    best = distance, low + end - length, low + end
                    if not distance:
                        break
            if best:
                out.append((i, *best))
        return out


def _blocks(benchmark: DataFrame, item_col: str, item_text: str) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and folded texts of the items, in blocks of bounded size."""
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.length("text"))).head()[0] or 0
    blocks = -(-2 * size // BLOCK) or 1
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).toArrow().sort_by([("text", "ascending"), ("item", "ascending")])
        ids, texts = own.column("item").combine_chunks(), [folded(x) for x in own.column("text").to_pylist()]
        some = [i for i, x in enumerate(texts) if x]
        yield ids.take(pa.array(some, pa.int64())), [texts[i] for i in some]


def contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id_col``, ``item_col``, distance, start, end for every occurrence of an item of ``benchmark`` in ``docs``."""
    if not 0 <= rate < 0.5:
        raise ValueError("rate")
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"{id_col} {id_kind}, {item_col} {item_kind}, distance int, start long, end long"
    out = None
    for block in _blocks(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, texts = shared.value
            matcher = Matcher(texts, rate, least)
            for batch in batches:
                for part in slices(batch, text_col, SLICE):
                    rows = [(i, *m) for i, x in enumerate(part.column(1).to_pylist()) if x for m in matcher.matches(folded(x))]
                    row, item, distance, start, end = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [], [], [])
                    columns = [part.column(0).take(pa.array(row, pa.int64())), ids.take(pa.array(item, pa.int64())), pa.array(distance, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=[id_col, item_col, "distance", "start", "end"])

        found = docs.select(id_col, text_col).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, least: int = LEAST, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, in which no item occurs."""
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block[1])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate, least)
            for batch in batches:
                for part in slices(batch, text_col, SLICE):
                    yield part.filter(pa.array([not (x and matcher.matches(folded(x))) for x in part.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

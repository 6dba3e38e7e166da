"""Near-duplicates by DartMinHash and banded joining.

A text is a weighted set: its shingles of ``size`` words with weight 1 (``presence``; similarity is Jaccard's) or
their counts (``tf``; weighted Jaccard). Signatures throw hashed darts: the plane of element weight by rank is cut
into cells of weight 1 and rank levels of doubling width; each cell of an element holds a Poisson number of darts,
placed by hashes of (element, cell) alone. A dart counts for a text if it lies under the element's weight; of the
darts of each of ``BANDS * ROWS`` coordinates the one of least rank is the signature's value. Two texts agree on a
coordinate with a probability equal to their weighted Jaccard similarity, and a text needs about
k ln k darts in all, however large it is: heavier texts read fewer levels.

Joining. Equal texts are one node (by md5). Nodes meet where a band of ``ROWS`` coordinates agrees, and nothing
grows with the square of a bucket.
 1. Band rows are dealt out by ranges of (band, node), so a bucket that many nodes share spreads over several tasks.
    Fame of a node is how many nodes it meets over all bands. Dealt anew by (band, fame), every node of a bucket is
    paired with the most famous node of its task, and these with the most famous node of the whole bucket. Of a text
    and its many near copies the text itself meets the most, so copies that are less alike among themselves than to
    it are all paired with it, in every band.
 2. Pairs are verified by their whole shingle sets and linked.
 3. The nodes of buckets of three or more that still hold several components are joined by their rare shingles, exactly
    (prefix filter): with shingles ordered from rare to common, the first one that two texts share stands where the
    larger text still has ``least`` of its weight ahead, and the smaller one 2 * least / (1 + least). Texts of different
    components that share such a shingle are verified, unless the weight ahead of it is too little. Shingles that many
    texts give are dealt out by a salt; no pair is left out. A bucket of two is decided by step 2.

Components are found by contracting minimum-neighbour links, all in joins; only the ``COMMON`` most common shingles
of step 3 are collected, for their order. A label is (least id, node), so the label a component ends with names its class.

At similarity 0.8 a pair meets in a band of 20 by 4 with probability 0.99997.

Defined results: a row for each row of the input: its class is the least id among all rows whose texts are linked,
directly or over others. Null texts are alone (class: the row's own id); empty texts equal each other. Texts of
fewer than ``size`` words are one shingle. Null ids: a class with null ids only has a null class id. Repeated rows
are copies. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Tables, WordTable, slices

BANDS, ROWS = 20, 4
COMMON = 1 << 20  # shingles of several components that are ordered by frequency; rarer ones come first, ordered by their hashes
SALT = 2048  # rows of a shingle in one part
SLICE = 1 << 20
FIRST_LEVEL = 1 / 256  # rank width of the first level; the expected darts of a cell of weight 1 in it
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)).astype(np.float64) * 2.0**-53


def word_hash(word: str) -> int:
    """63 bits of a word in lower case, without signs around it."""
    low = word.lower()
    core = low.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‚‘’…–—¡¿") or low
    raw = core.encode("utf-8", "surrogatepass")
    return (zlib.crc32(raw) << 31) ^ zlib.crc32(raw, 0x5BD1E995)


def shingles(numbers: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of the distinct shingles of texts whose words' ``numbers`` stand in a row; ordered."""
    words = mix(numbers.astype(U) + U(0x9E3779B97F4A7C15))
    n = np.where(lengths > 0, np.maximum(lengths - size + 1, 1), 0)
    owner = np.repeat(np.arange(len(lengths)), n)
    first = np.repeat(np.cumsum(lengths) - lengths, n) + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    last = np.repeat(np.cumsum(lengths), n)
    value = np.zeros(len(owner), U)
    for k in range(size):
        at = first + k
        inside = at < last
        value[inside] = mix(value[inside] + words[at[inside]] + U(k + 1))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    start = np.flatnonzero(new)
    return owner[start], value[start], np.diff(np.append(start, len(owner)))


_CDF: dict[int, np.ndarray] = {}


def poisson(level: int, u: np.ndarray) -> np.ndarray:
    """Poisson numbers of the mean of ``level`` for uniform ``u``."""
    if level not in _CDF:
        mean = FIRST_LEVEL * 2.0**level
        n = np.arange(int(mean + 12 * mean**0.5 + 24))
        logs = n * np.log(mean) - mean - np.concatenate([[0], np.cumsum(np.log(n[1:]))])
        _CDF[level] = np.cumsum(np.exp(logs))
    return np.searchsorted(_CDF[level], u, side="right")


def dart_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, k: int) -> np.ndarray:
    """[texts, k] signature values; texts without weight get zeros. ``owner`` ascends."""
    out = np.zeros((texts, k), U)
    total = np.bincount(owner, weights=weight, minlength=texts)
    open_ = total > 0
    cells = np.ceil(weight).astype(np.int64)
    cell_of = np.repeat(np.arange(len(owner)), cells)
    floor = np.arange(len(cell_of)) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = mix(element[cell_of] + mix(floor.astype(U) * U(0xD1342543DE82EF95)))
    whole = bool((weight == cells).all())
    cell_text = owner[cell_of]
    enough = k * (np.log(k) + 2.0) / np.maximum(total, 1e-12)  # rank by which most coordinates are hit
    goal = np.ceil(np.log2(enough / FIRST_LEVEL + 1)).astype(np.int64)  # levels to read
    best = np.full(texts * k, np.inf)
    value = np.zeros(texts * k, U)
    level, low = 0, 0.0
    while open_.any():
        width = FIRST_LEVEL * 2.0**level
        mine = np.flatnonzero(open_[cell_text])
        stream = mix(seed[mine] + U((level + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        n = poisson(level, unit(stream))
        some = np.flatnonzero(n)
        at, base, n = mine[some], stream[some], n[some]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        dart = mix(np.repeat(base, n) + (nth + 1).astype(U) * U(0xE7037ED1A0B428DB))
        cell = np.repeat(at, n)
        rank = low + width * unit(mix(dart + U(0x8EBC6AF09C88C6E3)))
        if not whole:
            under = floor[cell] + unit(mix(dart + U(0x589965CC75374CC3))) < weight[cell_of[cell]]
            dart, cell, rank = dart[under], cell[under], rank[under]
        slot = cell_text[cell] * k + (dart % U(k)).astype(np.int64)
        order = np.lexsort((dart, rank, slot))
        slot, rank, dart = slot[order], rank[order], dart[order]
        lead = np.ones(len(slot), bool)
        lead[1:] = slot[1:] != slot[:-1]
        slot, rank, dart = slot[lead], rank[lead], dart[lead]
        better = rank < best[slot]
        best[slot[better]], value[slot[better]] = rank[better], dart[better]
        level, low = level + 1, low + width
        done = open_ & (level >= goal)
        if done.any():
            full = np.isfinite(best.reshape(texts, k)).all(1)
            open_ &= ~(done & full)
    out[:] = value.reshape(texts, k)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """[texts, BANDS] hashes of bands."""
    out = np.zeros((len(signatures), BANDS), U)
    for b in range(BANDS):
        key = np.full(len(signatures), b + 1, U)
        for r in range(ROWS):
            key = mix(key + signatures[:, b * ROWS + r])
        out[:, b] = key
    return out.view(np.int64)


class Shingler:
    def __init__(self, size: int, weighting: str) -> None:
        if weighting not in ("presence", "tf"):
            raise ValueError(weighting)
        self.size, self.weighting, self.table = size, weighting, WordTable(word_hash)

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        numbers, lengths, _ = self.table.numbers(texts)
        owner, value, count = shingles(numbers, lengths, self.size)
        return owner, value, count.astype(np.float64) if self.weighting == "tf" else np.ones(len(owner))


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two ordered sets."""
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, wa, b, wb = b, wb, a, wa
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[at] == a
    common = np.minimum(wa[both], wb[at[both]]).sum()
    return float(common / (wa.sum() + wb.sum() - common))


def _signed(docs: DataFrame, id_col: str, text_col: str, size: int, weighting: str) -> DataFrame:
    """id, node (md5 of the text), bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size, weighting)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                owner, value, weight = shingler.sets([x or "" for x in part.column(2).to_pylist()])
                keys = band_keys(dart_signatures(owner, value, weight, part.num_rows, BANDS * ROWS))
                has = np.bincount(owner, minlength=part.num_rows) > 0
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * BANDS)]), pa.int32()), pa.array(keys[has].reshape(-1), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), bands], names=["id", "node", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _named(docs, id_col, text_col).mapInArrow(run, f"id {kind}, node binary, bands array<long>")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("node"), F.col(text_col).alias("text"))


def _shingle_sets(texts: DataFrame, size: int, weighting: str) -> DataFrame:
    """node, keys, weights (bytes; no weights for presence) from node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size, weighting)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                owner, value, weight = shingler.sets([x or "" for x in part.column(1).to_pylist()])
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
                keys = [value[cuts[i] : cuts[i + 1]].tobytes() for i in range(part.num_rows)]
                weights = [weight[cuts[i] : cuts[i + 1]].astype(np.float32).tobytes() if weighting == "tf" else b"" for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), pa.array(weights, pa.binary())], names=["node", "keys", "weights"])

    return texts.mapInArrow(run, "node binary, keys binary, weights binary")


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, bool, bool]]:
    """Ordered rows in parts that hold all of a task's rows of their keys (column 0); whether it is the first, the last part."""
    held: list[pa.RecordBatch] = []
    first, key = True, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        at = int(np.searchsorted(keys, keys[-1]))
        if at or key != keys[0]:
            if at:
                held.append(batch.slice(0, at))
            if held:
                yield pa.Table.from_batches(held), first, False
                first = False
            held, key = [], keys[-1]
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held), first, True


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, node, n (nodes of the key in this task) where others share the key; a task's first and last key may go on in others."""
    for part, first, last in _whole_keys(batches):
        keys = part.column(0).to_numpy()
        start = _starts(keys)
        count = np.diff(np.append(start, len(keys)))
        some = count > 1
        some[0] |= first
        some[-1] |= last
        rows = pa.array(np.flatnonzero(np.repeat(some, count)))
        found = part.take(rows).combine_chunks()
        yield from found.append_column("n", pa.array(np.repeat(count, count)[rows], pa.int32())).to_batches()


def _centered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of each node with the first one of its key in this task; with a null b: that one, its fame and the
    key, where the key may go on in other tasks."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("key", pa.int64()), ("fame", pa.int64())])
    for part, first, last in _whole_keys(batches):
        part = part.combine_chunks()
        keys, node = part.column(0).to_numpy(), part.column(2)
        start = _starts(keys)
        lead = np.repeat(start, np.diff(np.append(start, len(keys))))
        others = np.flatnonzero(lead != np.arange(len(keys)))
        edge = pa.array(np.unique(np.concatenate([start[: int(first)], start[len(start) - int(last) :]])), pa.int64())
        none = pa.nulls(len(others), pa.int64())
        pairs = [node.take(pa.array(lead[others])), node.take(pa.array(others)), none, none]
        heads = [node.take(edge), pa.nulls(len(edge), pa.binary()), part.column(0).take(edge), part.column(1).take(edge)]
        for columns in (pairs, heads):
            yield from pa.Table.from_arrays(columns, schema=schema).to_batches()


def _paired(nodes: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """key, fame, node of the buckets that several ``nodes`` share, and pairs (a, b) of their centers and nodes."""
    rows = nodes.select(F.explode("bands").alias("key"), "node").repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    met = rows.mapInArrow(_meeting, "key long, node binary, n int")
    met = tables.keep(met.groupBy("node").agg(F.sum("n").alias("fame"), F.collect_list("key").alias("keys")), "met")  # BANDS keys at most
    shared = met.select(F.explode("keys").alias("key"), "fame", "node")
    dealt = shared.repartitionByRange(F.col("key"), F.desc("fame"), F.col("node")).sortWithinPartitions(F.col("key"), F.desc("fame"), F.col("node"))
    found = tables.keep(dealt.mapInArrow(_centered, "a binary, b binary, key long, fame long"), "found")
    heads = found.where("b is null").select("key", "fame", "a")
    best = heads.groupBy("key").agg(F.max(F.struct("fame", "a")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.col("top.a").alias("t"))
    pairs = found.where("b is not null").select("a", "b").unionByName(heads.join(best, "key").where("a <> t").select(F.col("t").alias("a"), F.col("a").alias("b")))
    return shared, tables.keep(pairs.distinct(), "pairs")


def _verified(sets: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose similarity is ``least`` or more. ``sets``: node, keys, weights. What many pairs
    have in common is their a; it is looked up first, while rows are short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = [batch.column(i) for i in range(2, 6)]
            for i in range(batch.num_rows):
                ka, wa, kb, wb = (c[i].as_py() for c in columns)
                a, b = np.frombuffer(ka, U), np.frombuffer(kb, U)
                one = (lambda w, k: np.frombuffer(w, np.float32).astype(np.float64) if w else np.ones(len(k)))
                keep.append(similarity(a, one(wa, a), b, one(wb, b)) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("keys").alias("ka"), F.col("weights").alias("wa"))
    right = sets.select(F.col("node").alias("b"), F.col("keys").alias("kb"), F.col("weights").alias("wb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ka", "wa", "kb", "wb").mapInArrow(run, "a binary, b binary")


def first_shingles(keys: np.ndarray, weights: np.ndarray, rank: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, weight from it on, small) of those that can be the first one, in the order of ``rank``, in common with a text
    of similarity ``least``: with any text, or (``small``) also with one that is no smaller."""
    order = np.lexsort((keys, rank))
    ahead = np.cumsum(weights[order][::-1])[::-1]
    n = int(np.searchsorted(-ahead, -(least * ahead[0] - 1e-6), side="right"))
    return keys[order[:n]], ahead[:n], ahead[:n] >= 2 * least / (1 + least) * ahead[0] - 1e-6


def _alike_by_rare_shingles(sets: DataFrame, least: float, tables: Tables) -> DataFrame:
    """Pairs (a < b) of nodes of different marks: all of similarity ``least`` or more, and some others. ``sets``: node,
    keys, weights, mark (of the component)."""

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            mark = np.repeat(batch.column(1).to_numpy(), [len(x) // 8 for x in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(keys), np.int64)), pa.array(mark)], names=["key", "mark"])

    # what only one component has can't be in common with another
    counts = sets.select("keys", F.xxhash64("mark").alias("mark")).mapInArrow(every, "key long, mark long").groupBy("key")
    counts = counts.agg(F.count(F.lit(1)).alias("n"), F.min("mark").alias("low"), F.max("mark").alias("high")).where("low <> high")
    common = counts.orderBy(F.desc("n"), "key").limit(COMMON).select("key").toArrow().column(0).to_numpy()[::-1].view(U)
    place = np.argsort(common)
    order = sets.sparkSession.sparkContext.broadcast((common[place], place + 1, len(common) < COMMON))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place, whole = order.value
        for batch in batches:
            for i in range(batch.num_rows):
                node, keys, weights, mark = (c[i].as_py() for c in batch.columns)
                keys = np.frombuffer(keys, U)
                if not len(keys):
                    continue
                weights = np.frombuffer(weights, np.float32).astype(np.float64) if weights else np.ones(len(keys))
                rank = np.zeros(len(keys), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    rank = np.where(known[at] == keys, place[at], 0)
                first, ahead, small = first_shingles(keys, weights, rank, least)
                if whole:  # others than the known ones have one component
                    some = known[np.minimum(np.searchsorted(known, first), len(known) - 1)] == first if len(known) else np.zeros(len(first), bool)
                    first, ahead, small = first[some], ahead[some], small[some]
                n = len(first)
                columns = [pa.array(first.view(np.int64)), pa.array(small), pa.array(ahead), pa.array(np.full(n, weights.sum())), pa.array([node] * n, pa.binary()), pa.array([mark] * n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "small", "ahead", "size", "node", "mark"])

    rows = tables.keep(sets.select("node", "keys", "weights", "mark").mapInArrow(run, "key long, small boolean, ahead double, size double, node binary, mark binary"), "first")
    held = rows.groupBy("key", "mark").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("marks"), F.max(F.struct("n", "mark"))["mark"].alias("main"))
    held = tables.keep(held.where("marks > 1").select("key", "main", F.ceil(F.col("n") / SALT).cast("int").alias("parts")), "held")
    met = tables.keep(rows.join(held, "key"), "first")
    x = met.where("mark <> main").select("key", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("salt"), *(F.col(c).alias(f"{c}_x") for c in ("small", "size", "ahead", "node", "mark")))
    y = met.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "small", "size", "ahead", "node", "mark")
    sides = F.expr("(small_x and size_x <= size) or (small and size <= size_x)")
    enough = F.least("ahead_x", "ahead") >= least / (1 + least) * (F.col("size_x") + F.col("size")) - 1e-6
    near = F.least("size_x", "size") >= least * F.greatest("size_x", "size") - 1e-6
    met = x.join(y, ["key", "salt"]).where((F.col("mark_x") != F.col("mark")) & sides & enough & near)
    return met.select(F.least("node_x", "node").alias("a"), F.greatest("node_x", "node").alias("b")).distinct()


def components(labels: DataFrame, edges: DataFrame, tables: Tables) -> DataFrame:
    """``labels`` (node, label) with labels merged along ``edges`` (a, b between labels); the least of each component
    stays. Each round every label moves to its least neighbour's, and edges are contracted, until none is left."""
    edges = tables.keep(edges.where("a <> b").distinct(), "edges")
    turn = 0
    while edges.head(1):
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = tables.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("to")), "step")
        jump = step.select(F.col("x").alias("y"), F.col("to").alias("far"))
        parent = tables.keep(step.join(jump, F.col("to") == F.col("y"), "left").select("x", F.coalesce("far", "to").alias("to")), f"parent-{turn}")
        labels = labels.join(parent, F.col("label") == F.col("x"), "left").select("node", F.coalesce("to", "label").alias("label"))
        moved = edges.join(parent, F.col("a") == F.col("x")).select(F.col("to").alias("a"), "b")
        moved = moved.join(parent, F.col("b") == F.col("x")).select("a", F.col("to").alias("b"))
        edges = tables.keep(moved.where("a <> b").distinct(), "edges")
    labels = tables.keep(labels, "labels")
    tables.drop("edges", "step", *(f"parent-{i + 1}" for i in range(turn)))
    return labels


def _merged(labels: DataFrame, linked: DataFrame, tables: Tables) -> DataFrame:
    """``labels`` (node, label) merged along ``linked`` pairs (a, b) of nodes."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return components(labels, linked.join(la, "a").join(lb, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")), tables)


def _classes(docs: DataFrame, least: float, size: int, weighting: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """id and node of every row; node and label of every node. The label of a class is its least (none, id, node), where
    ``none`` says that the id is null."""
    tables = Tables(docs.sparkSession)
    signed = tables.keep(_signed(docs, id_col, text_col, size, weighting), "signed")
    own = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    nodes = tables.keep(signed.where("node is not null").groupBy("node", "bands").agg(F.min("id").alias("id")), "nodes")
    shared, pairs = _paired(nodes, tables)
    labels = tables.keep(nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", own.alias("label")), "labels")

    # of the copies of a text the one of the least id is read again
    asked = labels.select(F.col("label.node").alias("w"), F.col("label.id").alias("least_id"))
    texts = _named(docs, id_col, text_col).join(asked.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("least_id")) & (F.col("node") == F.col("w")), "left_semi").select("node", "text")
    sets = tables.keep(_shingle_sets(texts, size, weighting).dropDuplicates(["node"]), "sets")

    labels = _merged(labels, _verified(sets, pairs, least), tables)
    in_bucket = shared.select("key", "node").join(labels, "node")
    mixed = in_bucket.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).where("n > 2 and low <> high").select("key")
    mixed = tables.keep(mixed, "mixed")
    open_ = tables.keep(in_bucket.join(mixed, "key", "left_semi").select("node", F.col("label.node").alias("mark")).distinct(), "open")
    if open_.head(1):
        across = tables.keep(_alike_by_rare_shingles(sets.join(open_, "node"), least, tables), "across")
        labels = _merged(labels, _verified(sets, across, least), tables)
    labels = tables.keep(nodes.select("node", own.alias("own")).join(labels, "node", "left").select("node", F.coalesce("label", "own").alias("label")), "classes")
    rows = tables.keep(signed.select("id", "node"), "signed")
    tables.drop("nodes", "met", "found", "pairs", "sets", "labels", "mixed", "open", "first", "held", "across")
    return rows, labels


def near_duplicates(docs: DataFrame, least: float = 0.8, size: int = 5, weighting: str = "presence", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and class_id of every row of ``docs``."""
    rows, labels = _classes(docs, least, size, weighting, id_col, text_col)
    found = rows.join(labels, "node", "left")
    return found.select(F.col("id").alias(id_col), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("label.id")).alias("class_id"))


def one_of_each(docs: DataFrame, least: float = 0.8, size: int = 5, weighting: str = "presence", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole: of each class the one with the least id (null ids last; of rows with equal id and text,
    one). Null texts stay, all of them. Columns of any name may stand in ``docs``."""
    rows, labels = _classes(docs, least, size, weighting, id_col, text_col)
    first = (F.col("node") == F.col("label.node")) & F.col("id").eqNullSafe(F.col("label.id"))
    counted = rows.where("node is not null").groupBy("id", "node").agg(F.count(F.lit(1)).alias("n")).join(labels, "node")
    marked = Tables(docs.sparkSession).keep(counted.where(~first | (F.col("n") > 1)).select(F.col("id").alias("i"), F.col("node").alias("w"), first.alias("first")), "marked")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("node"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("node") == F.col("w"))
    kept = whole.join(marked.hint("shuffle_hash"), same, "left_anti")
    again = marked.where("first")
    if again.head(1):  # rows that stand several times
        kept = kept.unionByName(whole.join(again.hint("shuffle_hash"), same, "left_semi").groupBy("id", "node").agg(F.first("row").alias("row")).select("row", "id", "node"))
    return kept.select("row.*")

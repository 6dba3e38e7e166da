"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer numpy network.

1. Random indexing over all documents. Every word has a sparse random index vector (made from its hash); a
   word's context vector sums the index vectors of its neighbours. Words share ``WORDS`` hashed rows. Each
   word also has a shape (case, digits, punctuation at its end, signs only, repeats the word before), and shapes get
   vectors in the same way. Tasks sum their own tables first; ``WORDS`` + ``SHAPES`` rows meet.
2. A document is the mean of its words' vectors, the mean of its shapes' vectors, the lengths of these means and
   the logarithm of its size.
3. A network (one hidden layer) learns from at most ``most`` labelled documents; a temperature, chosen on a part
   of them that the weights never saw, calibrates its probabilities.

Bounds: what is broadcast has (WORDS + SHAPES) * DIM floats; training rows at most ``most``.

Defined results: null, empty or white-space text: no words, all features 0, scored like any other. No labelled
document: score 0.5 for all; labels of one class: their smoothed share. Rows are returned one for one, repeated
ones too; null ids are kept; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import WordTable, slices

WORDS = 1 << 14
SHAPES = 64
DIM = 32
SLICE = 2 << 20
MOST = 20_000  # labelled documents to learn from


def word_number(word: str) -> int:
    """Hashed row * SHAPES + shape (without the repeat bit)."""
    end = len(word)
    while end and not word[end - 1].isalnum():
        end -= 1
    core, mark = word[:end], word[end:]
    shape = 2 * (len(core) > 1 and core.isupper()) + 4 * any(map(str.isdigit, core)) + 8 * (not core)
    if mark:
        shape += 16 if mark in (".", ",", ";", ":", "?", "!") else 32
    return (zlib.crc32((core or mark).lower().encode("utf-8", "surrogatepass")) % WORDS) * SHAPES + shape


def index_vectors(n: int, seed: int) -> np.ndarray:
    """Two +1 and two -1 positions of each of ``n`` sparse index vectors."""
    return np.random.default_rng(seed).permuted(np.tile(np.arange(DIM), (n, 1)), axis=1)[:, :4].astype(np.int64)


def tokens(table: WordTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows, shapes and words a text of ``texts``."""
    numbers, lengths, _ = table.numbers(texts)
    words, shapes = numbers // SHAPES, numbers % SHAPES
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    again[starts] = False
    return words, shapes + again, lengths


def contexts(rows: np.ndarray, lengths: np.ndarray, index: np.ndarray, window: int) -> np.ndarray:
    """Sums of the index vectors of each row's neighbours, flat."""
    size = len(index) * DIM
    out = np.zeros(size)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    for k in range(1, window + 1):
        same = owner[k:] == owner[:-k]
        left, right = rows[:-k][same], rows[k:][same]
        for a, b in ((left, right), (right, left)):
            for j in range(4):
                out += (1 if j < 2 else -1) * np.bincount(a * DIM + index[b, j], minlength=size)
    return out


class Vectors:
    """Word and shape vectors of unit length."""

    def __init__(self, words: np.ndarray, shapes: np.ndarray) -> None:
        self.words, self.shapes = words, shapes

    @staticmethod
    def index() -> tuple[np.ndarray, np.ndarray]:
        return index_vectors(WORDS, 1), index_vectors(SHAPES, 2)

    @classmethod
    def of(cls, sums: np.ndarray) -> Vectors:
        """From context sums of words, then shapes: own index vector plus the direction of the context."""
        out = sums - sums.mean(0)
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
        for at, index in ((0, cls.index()[0]), (WORDS, cls.index()[1])):
            for j in range(4):
                out[at + np.arange(len(index)), index[:, j]] += 0.5 if j < 2 else -0.5
        return cls(out[:WORDS].astype(np.float32), out[WORDS:].astype(np.float32))

    def pooled(self, table: WordTable, texts: list[str]) -> np.ndarray:
        words, shapes, lengths = tokens(table, texts)
        out = np.zeros((len(texts), 2 * DIM + 3), np.float32)
        some = np.flatnonzero(lengths)
        if len(some):
            n = lengths[some][:, None]
            starts = (np.cumsum(lengths) - lengths)[some]
            out[some, :DIM] = np.add.reduceat(self.words[words], starts, axis=0) / n
            owner = np.repeat(np.arange(len(texts)), lengths)
            seen = np.bincount(owner * SHAPES + shapes, minlength=len(texts) * SHAPES).reshape(-1, SHAPES)[some]
            out[some, DIM : 2 * DIM] = (seen @ self.shapes) / n
            out[some, -3] = np.linalg.norm(out[some, :DIM], axis=1)
            out[some, -2] = np.linalg.norm(out[some, DIM : 2 * DIM], axis=1)
            out[some, -1] = np.log1p(lengths[some])
        return out


def word_vectors(docs: DataFrame, text_col: str = "text", window: int = 2) -> Vectors:
    """Random indexing over every text of ``docs``."""
    names = [f"d{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, (word_index, shape_index) = WordTable(word_number), Vectors.index()
        sums = np.zeros((WORDS + SHAPES) * DIM)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                words, shapes, lengths = tokens(table, [x or "" for x in part.column(0).to_pylist()])
                sums[: WORDS * DIM] += contexts(words, lengths, word_index, window)
                sums[WORDS * DIM :] += contexts(shapes, lengths, shape_index, 1)
        sums = sums.reshape(-1, DIM)
        some = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(sums[some, i].astype(np.int64), pa.int64()) for i in range(DIM))], names=["row", *names])

    parts = docs.select(text_col).mapInArrow(run, "row int, " + ", ".join(f"{x} long" for x in names))
    found = parts.groupBy("row").agg(*(F.sum(x).alias(x) for x in names)).toArrow()
    sums = np.zeros((WORDS + SHAPES, DIM))
    sums[found.column("row").to_numpy()] = np.column_stack([found.column(x).to_numpy() for x in names]) if found.num_rows else 0
    return Vectors.of(sums)


class Network:
    """Two layers of weights on standardised features, with a temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature) -> None:
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature = mean, scale, w1, b1, w2, b2, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) * self.scale, -8, 8)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, decay: float = 1e-4, seed: int = 0) -> Network:
        """Adam on the log loss; the fifth of the rows that only the temperature sees is chosen at random."""
        rng = np.random.default_rng(seed)
        x, y, d = x.astype(np.float64), y.astype(np.float64), x.shape[1]
        if len(y) < 10 or y.min() == y.max():
            share = (y.sum() + 0.5) / (len(y) + 1)
            return cls(np.zeros(d), np.zeros(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)
        order = rng.permutation(len(y))
        held, own = order[: len(y) // 5], order[len(y) // 5 :]
        mean, scale = x[own].mean(0), 1 / np.maximum(x[own].std(0), 1e-6)
        net = cls(mean, scale, rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0, 1.0)
        z = np.clip((x - mean) * scale, -8, 8)
        values = [net.w1, net.b1, net.w2, np.zeros(1)]
        first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        size = max(32, min(256, len(own) // 20))
        for epoch in range(max(epochs, min(400, 2000 * size // len(own)))):
            mixed = rng.permutation(own)
            for at in range(0, len(mixed), size):
                rows = mixed[at : at + size]
                h = np.maximum(z[rows] @ values[0] + values[1], 0)
                p = 1 / (1 + np.exp(-np.clip(h @ values[2] + values[3], -30, 30)))
                e = (p - y[rows]) / len(rows)
                back = np.outer(e, values[2]) * (h > 0)
                grads = [z[rows].T @ back + decay * values[0], back.sum(0), h.T @ e + decay * values[2], np.array([e.sum()])]
                step += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    values[i] -= 3e-3 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
        out, t = net.logits(x[held]), y[held]
        grid = np.geomspace(0.25, 8, 41)
        loss = [np.logaddexp(0, np.where(t > 0, -out, out) / k).mean() for k in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
        return net


def train(docs: DataFrame, sample: DataFrame, vectors: Vectors, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> Network:
    """``sample``: bounded ``id_col`` and label."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(word_number)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                x = shared.value.pooled(table, [t or "" for t in part.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), part.column(1)], names=["x", "label"])

    rows = docs.select(id_col, text_col).join(F.broadcast(sample), id_col).select(text_col, "label").mapInArrow(run, "x binary, label int").limit(2 * most).toArrow()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(-1, 2 * DIM + 3)
    y = rows.column("label").to_numpy()
    order = np.lexsort((*x.T[:4], y))  # rows come in any order
    return Network.fit(x[order], y[order])


def score(docs: DataFrame, vectors: Vectors, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and score of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (vectors, network), table = model.value, WordTable(word_number)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                got = network.predict(vectors.pooled(table, [x or "" for x in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, score double")


def good(docs: DataFrame, vectors: Vectors, network: Network, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, whole, whose score is ``least`` or more."""
    model, at = docs.sparkSession.sparkContext.broadcast((vectors, network)), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (vectors, network), table = model.value, WordTable(word_number)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                got = network.predict(vectors.pooled(table, [x or "" for x in part.column(at).to_pylist()]))
                yield part.filter(pa.array(got >= least, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

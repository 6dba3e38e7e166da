"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

1. A character language model (4-grams over letters folded to a-z, other letters and the word boundary) is counted
   over all documents. Tasks sum their own counts first; at most ``SIGNS``**4 rows meet.
2. A word that may be disguised (signs or digits among its letters, a letter three times in a row, or single
   characters standing apart) becomes a lattice: each sign may be a letter that looks like it, a mere separator, or
   itself; a run of one letter may be that letter once, twice or as written; between letters standing apart there
   may be a word boundary. Viterbi decoding finds the reading of least cost under the model and the channel.
   All other words are read as they stand, without punctuation around them.
3. A logistic model on the words of the restored text and their beginnings (those of at most ``most`` labelled
   documents, copies once, that tell the classes apart best) gives the score. Each counts once a document.

A table of words is kept a worker, so each distinct word is decoded once; its size is bounded.

Defined results: null, empty or white-space text: the score of a text without any telling word. No labelled document:
score 0.5 for all. Rows are returned one for one, repeated ones too; null ids are kept; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import WordTable, slices

SIGNS = 28  # 0: boundary, 1-26: a-z, 27: any other letter
ROWS = 1 << 22  # hashed rows of the words
SLICE = 2 << 20
MOST = 6_000  # labelled documents to learn from
# Letters that a sign is used for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l"}
SEPARATORS = frozenset(".-_*~'`^,:;/\\ \u200b\xad")
# Costs of the channel in nats.
LOOK, DROP, RUN, BOUNDARY, KEPT = 1.0, 0.7, 0.7, 1.5, 9.0
# A letter, signs, a letter; a sign beside a letter; a letter three times: no alternative reads a place more than twice.
DISGUISED = re.compile(r"[^\W\d_][\W\d_]+[^\W\d_]|[\d@$!|+(<€£][^\W\d_]|[^\W\d_][\d@$|+(]|(?P<c>[^\W\d_])(?P=c)(?P=c)").search
LEADING, TRAILING = frozenset("$@!|+(<€£_"), frozenset("$@|+(_")  # signs that may begin or end a word
STEMS = (3, 4, 5, 6, 7)  # lengths of the beginnings of words that count too
ALONE = 1 << 40


def _signs() -> np.ndarray:
    """Sign of each code point; marks that fold away are 0, like all that is no letter."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and (c := chr(point)).isalpha():
            base = normalize("NFD", c.lower())[0]
            table[point] = ord(base) - 96 if "a" <= base <= "z" else 27
    return table


_TABLE: list[np.ndarray] = []


def signs(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_signs())
    return _TABLE[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def grams(texts: list[str]) -> np.ndarray:
    """Counts of 4-grams of signs; runs of boundaries are one, texts don't touch."""
    s = signs(" " + "   ".join(texts) + " ")
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
    s = s[keep].astype(np.int64)
    if len(s) < 4:
        return np.zeros(SIGNS**4, np.int64)
    return np.bincount(((s[:-3] * SIGNS + s[1:-2]) * SIGNS + s[2:-1]) * SIGNS + s[3:], minlength=SIGNS**4)


class Model:
    """Interpolated 4-gram costs: cost[a, b, c, d] of d after a, b, c."""

    def __init__(self, counts: np.ndarray) -> None:
        c = counts.reshape(SIGNS, SIGNS, SIGNS, SIGNS).astype(np.float64)
        p = np.full(SIGNS, 1 / SIGNS)
        for axes in ((0, 1, 2), (0, 1), (0,), ()):
            n = c.sum(axes)
            total = n.sum(-1, keepdims=True)
            p = (n + 8 * p) / (total + 8)
        self.cost = (-np.log(p)).astype(np.float32)
        self._rows = self.cost.reshape(SIGNS**3, SIGNS)

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The reading of least cost: one choice (letters, cost) of each place, in order."""
        beams: dict[int, float] = {0: 0.0}
        back: list[dict[int, tuple[int, str]]] = []  # of each place: state -> the state before and what was read
        cube, rows = SIGNS**3, self._rows
        for choices in lattice:
            after: dict[int, float] = {}
            came: dict[int, tuple[int, str]] = {}
            for letters, extra in choices:
                codes = [LETTER(x) for x in letters]
                for begin, cost in beams.items():
                    state = begin
                    cost += extra
                    for d in codes:
                        cost += float(rows[state, d])
                        state = (state * SIGNS + d) % cube
                    if state not in after or cost < after[state]:
                        after[state], came[state] = cost, (begin, letters)
            beams = after
            back.append(came)
        state = min(beams, key=lambda x: (beams[x] + float(rows[x, 0]), x))
        read = []
        for came in reversed(back):
            state, letters = came[state]
            read.append(letters)
        return "".join(reversed(read))


_LETTERS: dict[str, int] = {}


def LETTER(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if c not in _LETTERS:
        _LETTERS[c] = int(signs(c)[0])
    return _LETTERS[c]


def ends(word: str) -> str:
    """``word`` without the signs around it, but for those that may stand for letters; a last sign that stands three
    times or more goes, too."""
    first, last = 0, len(word)
    while first < last and not word[first].isalnum() and word[first] not in LEADING:
        first += 1
    while last > first and not word[last - 1].isalnum() and word[last - 1] not in TRAILING:
        last -= 1
    if last == len(word) > first and not word[-1].isalnum():
        run = len(word) - len(word[first:].rstrip(word[-1])) - first
        last -= run if run >= 3 else 0
    return word[first:last]


def lattice(word: str, apart: bool = False) -> list[list[tuple[str, float]]]:
    """Choices at each place of ``word`` (lower case); ``apart``: its characters stood alone."""
    places, i = [], 0
    while i < len(word):
        c, j = word[i], i + 1
        while j < len(word) and word[j] == c:
            j += 1
        n, i = j - i, j
        if c.isalpha():
            if n >= 3:
                places.append([(c, RUN), (c * 2, RUN), (c * n, 0.0)])
            else:
                places.append([(c * n, 0.0)] if n == 1 else [(c * 2, 0.0), (c, RUN)])
        else:
            choices = [(x, LOOK) for x in LOOKS.get(c, "")] + [(x * 2, 2 * LOOK) for x in LOOKS.get(c, "") if n > 1]
            if c in SEPARATORS or not choices or not c.isalnum():
                choices.append(("", DROP))
            if c.isalnum():
                choices.append((c * n, KEPT * n))
            places.append(choices)
        if apart and i < len(word):
            places.append([("", 0.0), (" ", BOUNDARY)])
    return places


def restore(model: Model, word: str) -> str:
    """``word`` as it is read: lower case, without punctuation around it, decoded if it may be disguised."""
    low = word.lower()
    core = ends(low)
    if not core:
        return ""
    return model.decode(lattice(core)).strip() if DISGUISED(core) else core


def row_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % ROWS


def features(word: str) -> list[int]:
    """Hashed rows of a restored word and of its beginnings, as words of one stem share them."""
    return [row_of(word)] + [row_of("^" + word[:k]) for k in STEMS if len(word) > k]


class Reader:
    """Restored words of texts."""

    def __init__(self, model: Model, limit: int = 400_000) -> None:
        self.model, self.limit, self.cache = model, limit, {}

    def restored(self, word: str) -> str:
        return restore(self.model, word)

    def apart(self, letters: list[str]) -> list[str]:
        """The words that characters standing alone, three or more in a row, may be read as."""
        return self.model.decode(lattice("".join(letters).lower(), apart=True)).split()

    def distinct(self, text: str) -> np.ndarray:
        """Hashed rows of a text, each once."""
        words = text.split()
        if len(self.cache) > self.limit:
            self.cache = {}
        cache, out = self.cache, set()
        for word in set(words):
            if word not in cache:
                cache[word] = features(x) if (x := self.restored(word)) else []
            out.update(cache[word])
        run: list[str] = []
        for word in [*words, ""]:
            if len(word) == 1:
                run.append(word)
                continue
            if len(run) >= 3:
                out.update(r for x in self.apart(run) for r in features(x))
            run = []
        return np.array(sorted(out), np.int32)


class Scorer(Reader):
    """Scores of texts under a ``Judge``. A word's number is that of the group of telling features it has (0: none)."""

    def __init__(self, model: Model, judge: Judge) -> None:
        super().__init__(model)
        self.judge = judge
        self.place = {int(r): i for i, r in enumerate(judge.rows)}
        self.groups: list[tuple[int, ...]] = [()]
        self.group_of = {(): 0}
        self.table = WordTable(self._number)

    def _telling(self, word: str) -> tuple[int, ...]:
        return tuple(self.place[r] for r in features(word) if r in self.place) if word else ()

    def _number(self, word: str) -> int:
        """ALONE marks a character that stands by itself."""
        group = self._telling(self.restored(word))
        if group not in self.group_of:
            self.group_of[group] = len(self.groups)
            self.groups.append(group)
        return self.group_of[group] | (ALONE if len(word) == 1 else 0)

    def scores(self, texts: list[str]) -> np.ndarray:
        numbers, lengths, split = self.table.numbers(texts)
        owner = np.repeat(np.arange(len(texts)), lengths)
        hit = np.flatnonzero(numbers & (ALONE - 1))
        found = {(int(i), place) for i, g in set(zip(owner[hit].tolist(), (numbers[hit] & (ALONE - 1)).tolist(), strict=True)) for place in self.groups[g]}
        alone = numbers >= ALONE
        edge = np.flatnonzero(np.diff(np.concatenate([[False], alone, [False]]).astype(np.int8)))
        first = np.cumsum(lengths) - lengths
        for a, b in edge.reshape(-1, 2).tolist():
            while b - a >= 3:  # a run may cross texts
                i = int(owner[a])
                stop = min(b, int(first[i] + lengths[i]))
                if stop - a >= 3:
                    found |= {(i, place) for x in self.apart(split[i][a - first[i] : stop - first[i]]) for place in self._telling(x)}
                a = stop
        out = np.full(len(texts), self.judge.bias)
        if found:
            pair = np.array(sorted(found), np.int64)
            out += np.bincount(pair[:, 0], weights=self.judge.weights[pair[:, 1]], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def character_model(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts over every text of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIGNS**4, np.int64)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                counts += grams([x or "" for x in part.column(0).to_pylist()])
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())], names=["gram", "n"])

    found = docs.select(text_col).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SIGNS**4, np.int64)
    counts[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return Model(counts)


class Judge:
    """Logistic model on the presence of words: a weight for each hashed row."""

    def __init__(self, bias: float, rows: np.ndarray, weights: np.ndarray) -> None:
        self.bias, self.rows, self.weights = bias, rows, weights

    @classmethod
    def fit(cls, texts: list[np.ndarray], y: np.ndarray, words: int = 512, decay: float = 0.3) -> Judge:
        """``texts``: distinct rows of each text. The ``words`` rows of the highest chi-square (seen in 6 texts at least) get
        weights by Newton's method under a Gaussian prior."""
        y = np.asarray(y, np.float64)
        n = len(y)
        if not n:
            return cls(0.0, np.zeros(0, np.int64), np.zeros(0))
        seen, bad = np.zeros(ROWS, np.int32), np.zeros(ROWS, np.int32)
        for rows, label in zip(texts, y, strict=True):  # rows of a text are distinct
            seen[rows] += 1
            if label:
                bad[rows] += 1
        share = y.mean()
        some = np.flatnonzero(seen >= 6)
        chi = (bad[some] - seen[some] * share) ** 2 / (seen[some] * max(share * (1 - share), 1e-9))
        chosen = some[np.argsort(-chi, kind="stable")[:words]]
        chosen = chosen[np.sort(-chi, kind="stable")[:words] < -30]
        place = np.full(ROWS, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        x = np.zeros((n, len(chosen) + 1))
        for i, rows in enumerate(texts):
            at = place[rows]
            x[i, at[at >= 0]] = 1
        x[:, -1] = 1
        w = np.zeros(x.shape[1])
        prior = np.full(len(w), decay)
        prior[-1] = 1e-3
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + prior * w
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(prior), grad)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return cls(float(w[-1]), chosen, w[:-1])


def train(docs: DataFrame, sample: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> Judge:
    """``sample``: bounded ``id_col`` and label. Equal texts count once, as toxic if any copy is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                rows = [reader.distinct(t or "").tobytes() for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), part.column(1)], names=["x", "label"])

    found = docs.select(id_col, text_col).join(F.broadcast(sample), id_col).select(text_col, "label").mapInArrow(run, "x binary, label int").limit(2 * most).toArrow()
    once: dict[bytes, int] = {}
    for x, label in zip(found.column("x"), found.column("label").to_pylist(), strict=True):
        key = x.as_py()
        once[key] = max(label, once.get(key, 0))
    del found
    keys = sorted(once)
    return Judge.fit([np.frombuffer(k, np.int32) for k in keys], np.array([once[k] for k in keys]))


def score(docs: DataFrame, model: Model, judge: Judge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((model, judge))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                got = scorer.scores([x or "" for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, score double")

"""Language ID by cross-parsing entropy.

For each language the suffix automaton of a bounded sample of its labelled text is built. A text is parsed
against each automaton: from the root the longest match is read, it ends a phrase, and the next phrase begins
with the letter that failed. A text close to a language's sample needs few phrases. Phrases are normalised by
the cost of naming one (log2 of the sample's length) and by the text's length; the least wins, ties go to the
alphabetically first language.

Letters are folded to lower case; every run of other characters is one space. Each language has the alphabet of its own
sample, however large; a letter that its sample lacks is a phrase of its own. Texts are parsed in blocks of
``BLOCK`` letters, each from the root, so that many blocks advance in step as one vector operation, and the
whole text counts, however long it is. An automaton is a dense table (entry [state, letter] holds the next
state and whether a new phrase begins, so a step is one lookup) while a worker's tables fit ``DENSE`` bytes, and a
sorted array of its edges beyond, with the same phrases.

Bounds: at most ``letters`` letters of sample a language, from at most ``documents`` documents of which each gives
a quarter of that at most; what is broadcast are these letters. Workers build the automata from them once, of at most
2 * letters states and 3 * letters edges a language.

Defined results: null text or text without a letter: ``und`` with score 0. No labelled language: ``und`` for all.
Rows are returned one for one, repeated ones too; null ids are kept and are in no fold; other columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import held, slices, unit_hash

BLOCK = 2048
SLICE = 2 << 20
DENSE = 256 << 20  # bytes of dense tables in a worker


def letter_table(texts: Iterable[str]) -> np.ndarray:
    """Class of each code point: 1 for all but letters, 2 for letters in none of ``texts``, 3 and more for theirs."""
    seen = sorted({c for text in texts for c in set(text.lower()) if c.isalpha()})
    own = {c: i + 3 for i, c in enumerate(seen)}
    table = np.ones(0x110000, np.uint16 if len(seen) < 60_000 else np.uint32)
    for point in range(0x110000):
        if 0xD800 <= point < 0xE000:
            continue
        c = chr(point)
        if c.isalpha():
            table[point] = own.get(c.lower(), 2)
    return table


def classes(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter classes of all texts in a row, runs of spaces as one, and each text's number of them."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = table[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 1) | (codes[:-1] != 1)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    keep[starts[:-1][lengths > 0]] = True
    return codes[keep], lengths - np.diff(np.searchsorted(np.flatnonzero(~keep), starts))


def suffix_edges(codes: np.ndarray) -> list[dict[int, int]]:
    """Edges of each state of the suffix automaton of ``codes``; state 0 is the root."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = cur
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return following


class Automaton:
    """Steps of many parses at once. What a step returns is next state * width * 2 + (a phrase begins)."""

    def __init__(self, codes: np.ndarray, width: int, room: int) -> None:
        """``codes``: classes of the sample, below ``width``; class 0 stands nowhere in it. Dense within ``room`` bytes."""
        following = suffix_edges(codes)
        n = np.fromiter(map(len, following), np.int64, len(following))
        at = np.repeat(np.arange(len(following)), n) * width + np.fromiter((c for x in following for c in x), np.int64, int(n.sum()))
        to = np.fromiter((t for x in following for t in x.values()), np.int64, int(n.sum())) * (width * 2)
        to[: n[0]] |= 1  # what is read at the root begins a phrase
        missing = np.ones(width, np.int64)
        missing[at[: n[0]]] = to[: n[0]]
        self.bytes, self.table = 0, None
        if len(following) * width * 4 <= room:
            self.table = np.tile(missing.astype(np.int32), len(following))
            self.table[at] = to
            self.bytes = self.table.nbytes
        else:
            order = np.argsort(at)
            self.at, self.to, self.missing = at[order], to[order], missing

    def step(self, state: np.ndarray, here: np.ndarray) -> np.ndarray:
        want = (state >> 1) + here
        if self.table is not None:
            return self.table[want]
        place = np.minimum(np.searchsorted(self.at, want), len(self.at) - 1)
        return np.where(self.at[place] == want, self.to[place], self.missing[here])


class Parser:
    """Letters of samples of several languages; their automata are made where they are first needed."""

    def __init__(self, names: list[str], letters: np.ndarray, alphabets: list[np.ndarray], samples: list[np.ndarray]) -> None:
        self.names, self.letters, self.alphabets, self.samples = names, letters, alphabets, samples
        self.key, self.costs = uuid.uuid4().hex, [float(np.log2(len(x) + 2)) for x in samples]

    @classmethod
    def fit(cls, samples: dict[str, list[str]]) -> Parser:
        names = sorted(k for k, v in samples.items() if any(v))
        letters = letter_table(x for k in names for x in samples[k])
        size, alphabets, coded = int(letters.max()) + 1, [], []
        for name in names:
            codes, _ = classes([" ".join(samples[name])], letters)
            own = np.unique(codes)
            alphabet = np.zeros(size, np.int32)  # class in this language of each letter; 0: none
            alphabet[own] = np.arange(len(own)) + 1
            alphabets.append(alphabet)
            coded.append(alphabet[codes])
        return cls(names, letters, alphabets, coded)

    def _build(self) -> list[Automaton]:
        room, made = DENSE, []
        for alphabet, codes in zip(self.alphabets, self.samples, strict=True):
            made.append(Automaton(codes, int(alphabet.max()) + 1, room))
            room -= made[-1].bytes
        return made

    def automata(self) -> list[Automaton]:
        return held(f"automata {self.key}", self._build)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language, and each text's letters (spaces not counted)."""
        codes, lengths = classes(texts, self.letters)
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * BLOCK
        size = np.minimum(np.repeat(lengths, blocks) - nth * BLOCK, BLOCK)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        active = np.searchsorted(-size, -np.arange(BLOCK), side="left")  # blocks longer than t
        automata = self.automata()
        counts = np.zeros((len(automata), len(size)), np.int32)
        state = [np.zeros(len(size), np.int32 if x.table is not None else np.int64) for x in automata]
        for t in range(int(size[0]) if len(size) else 0):
            n = active[t]
            here = codes[begin[:n] + t]
            for k, (automaton, alphabet) in enumerate(zip(automata, self.alphabets, strict=True)):
                got = automaton.step(state[k][:n], alphabet[here])
                counts[k, :n] += (got & 1).astype(np.int32)
                state[k][:n] = got
        out = np.zeros((len(texts), len(automata)), np.int64)
        for k in range(len(automata)):
            out[:, k] = np.bincount(owner, weights=counts[k], minlength=len(texts))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return out, lengths - np.diff(np.searchsorted(np.flatnonzero(codes <= 1), ends))

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and phrase bits a letter of each text."""
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        count, letters = self.phrases([x or "" for x in texts])
        bits = np.maximum(count, 1) * np.array(self.costs) / np.maximum(letters, 1)[:, None]
        best = bits.argmin(1)
        # a share of belief that grows with the evidence: each extra phrase costs its bits
        excess = (bits - bits.min(1, keepdims=True)) * np.minimum(letters, 50)[:, None]
        score = 1 / np.exp2(-excess / 4).sum(1)
        empty = letters == 0
        names = ["und" if empty[i] else self.names[k] for i, k in enumerate(best)]
        return names, np.where(empty, 0.0, score), np.where(empty, 0.0, bits.min(1))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, labelled: Column, documents: int, letters: int) -> dict[str, list[str]]:
    """Labelled documents of each language, at most ``letters`` characters of them: a hash of the id picks about
    ``documents``, and of these, in hash order, each gives a quarter of that at most until the sample is full."""
    known = docs.where(labelled & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = known.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a language
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for r in counts for x in (r.lang, min(1.0, documents / r.n))])
    luck = unit_hash(F.col(id_col), 8)
    rows = known.where(luck < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), luck.alias("luck"), F.substring(text_col, 1, max(1, letters // 4)).alias("text"))
    rows = rows.limit(4 * documents * len(counts)).collect()
    out: dict[str, list[str]] = {r.lang: [] for r in counts}
    size: Counter = Counter()
    for r in sorted(rows, key=lambda r: (r.luck, r.text)):
        if size[r.lang] < letters:
            out[r.lang].append(r.text[: letters - size[r.lang]])
            size[r.lang] += len(out[r.lang][-1])
    return out


def fit(docs: DataFrame, labelled: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", documents: int = 120, letters: int = 60_000) -> Parser:
    """A parser of the languages of ``docs``. ``labelled`` says which rows may be learned from; ``documents`` and
    ``letters`` bound the sample of each language."""
    return Parser.fit(sample(docs, id_col, text_col, lang_col, labelled, documents, letters))


def identify(docs: DataFrame, parser: Parser, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score and bits (phrase bits a letter) of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(parser)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = model.value
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                names, score, bits = parser.judge(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())], names=[id_col, "lang_pred", "score", "bits"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double, bits double")


def known_language(docs: DataFrame, parser: Parser, text_col: str = "text", most_bits: float = 10.0) -> DataFrame:
    """The rows of ``docs``, whole, whose text is in a learned language: not ``und``, and not so far from all samples
    that its phrases cost more than ``most_bits`` bits a letter."""
    model, at = docs.sparkSession.sparkContext.broadcast(parser), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                names, _, bits = model.value.judge(part.column(at).to_pylist())
                yield part.filter(pa.array([n != "und" and b <= most_bits for n, b in zip(names, bits, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

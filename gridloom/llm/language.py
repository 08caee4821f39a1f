"""Language identification by unigram pieces, summed over all segmentations.

The vocabulary is that of a public tokenizer.  Each language has a probability per piece, learned by expectation maximisation: the expected
number of times a piece is used, over all ways to cut the training words into pieces.  A word's probability is the sum over all its
segmentations (a forward pass over its bytes), a text's that of its words; pieces do not cross words, so this is the sum over all
segmentations of the text.  Single bytes are pieces as well, so every word has a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, slices

#: About so many labelled documents per language are learned from: rows whose hash is below that share of the language's rows.
SAMPLE = 1500
#: Rounds of expectation maximisation and what is added to every expected count.
ROUNDS, PRIOR = 4, 0.05
#: Bytes up to which words are scored together (their probabilities, scaled by SCALE per byte, stay within range); words a task remembers.
SHORT, SCALE, REMEMBER = 40, 16.0, 1 << 18
UNKNOWN = "und"
_MARK = "▁"
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    """Lower-cased runs that begin with a letter and go on with letters and marks."""
    return _WORDS.findall(text.lower())


class Vocabulary:
    """Pieces as bytes, with the word mark in front of a word's first; single bytes have the numbers 0 to 255."""

    def __init__(self, pieces: list[bytes]):
        self.number = {p: 256 + i for i, p in enumerate(pieces)}
        self.size = 256 + len(pieces)
        self.longest = max(map(len, pieces), default=1)
        self.heads = {p[:k] for p in pieces for k in range(1, len(p) + 1)}

    @classmethod
    def of_model(cls, model: bytes) -> "Vocabulary":
        """The ordinary pieces of a sentencepiece model, lower-cased, those with a mark inside left out."""
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)))
        return cls([p.encode() for p in sorted({p.lower() for p in plain}) if p and _MARK not in p[1:]])

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The lattices of words: ``word, from, to, piece`` per edge, in order of (to, word), and the words' lengths in bytes."""
        word, start, end, piece, lengths = [], [], [], [], []
        number, heads, longest = self.number, self.heads, self.longest
        for w, s in enumerate(words):
            data = (_MARK + s).encode()
            n = len(data)
            lengths.append(n)
            for i in range(n):
                b = data[i]
                word.append(w), start.append(i), end.append(i + 1), piece.append(b)
                if b & 0xC0 == 0x80:
                    continue
                for j in range(i + 1, min(n, i + longest) + 1):
                    part = data[i:j]
                    if part not in heads:
                        break
                    p = number.get(part)
                    if p is not None:
                        word.append(w), start.append(i), end.append(j), piece.append(p)
        cols = [np.array(x, np.int32) for x in (word, start, end, piece)]
        order = np.lexsort((cols[0], cols[2]))
        return *(c[order] for c in cols), np.array(lengths, np.int64)


@dataclass
class Model:
    """Languages in order, and the log probability of each piece (rows) in each of them (columns)."""

    languages: list[str]
    log_p: np.ndarray


def _groups(key: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(key, np.arange(n + 1))


def forward(edges: tuple, p: np.ndarray) -> np.ndarray:
    """Scaled forward sums ``[word, place, language]``: probability times SCALE per byte; for words of at most SHORT bytes (and the mark's)."""
    word, start, end, piece, lengths = edges
    longest = int(lengths.max(initial=0))
    alpha = np.zeros((len(lengths), longest + 1, p.shape[1]))
    alpha[:, 0] = 1
    at = _groups(end, longest + 1)
    scale = SCALE ** np.arange(longest + 1)
    for t in range(1, longest + 1):
        lo, hi = at[t], at[t + 1]
        w = word[lo:hi]
        part = alpha[w, start[lo:hi]] * p[piece[lo:hi]] * scale[t - start[lo:hi]][:, None]
        head = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        alpha[w[head], t] = np.add.reduceat(part, head, axis=0)
    return alpha


def log_probability(vocabulary: Vocabulary, words: list[str], model: Model) -> np.ndarray:
    """Log probability of each word in each language."""
    out = np.zeros((len(words), len(model.languages)))
    p = np.exp(model.log_p)
    size = np.array([len(w.encode()) for w in words])
    for lo in range(0, SHORT + 1, 8):
        for some in np.array_split(np.flatnonzero((size >= lo) & (size < lo + 8) & (size <= SHORT)), max(1, len(words) // 20_000)):
            if len(some):
                edges = vocabulary.edges([words[i] for i in some])
                alpha, n = forward(edges, p), edges[4]
                out[some] = np.log(alpha[np.arange(len(some)), n]) - n[:, None] * np.log(SCALE)
    for i in np.flatnonzero(size > SHORT):
        out[i] = _long_word(vocabulary, words[i], model)
    return out


def _long_word(vocabulary: Vocabulary, word: str, model: Model) -> np.ndarray:
    """The same sum in logarithms, place by place."""
    _, start, end, piece, lengths = vocabulary.edges([word])
    n = int(lengths[0])
    alpha = np.full((n + 1, len(model.languages)), -np.inf)
    alpha[0] = 0
    at = _groups(end, n + 1)
    for t in range(1, n + 1):
        part = alpha[start[at[t]:at[t + 1]]] + model.log_p[piece[at[t]:at[t + 1]]]
        most = part.max(axis=0)
        alpha[t] = most + np.log(np.exp(part - most).sum(axis=0))
    return alpha[n]


def expected_counts(vocabulary: Vocabulary, edges: tuple, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
    """How often each piece is used over all segmentations of the words, each word `weight` times (forward and backward sums)."""
    word, start, end, piece, lengths = edges
    alpha = forward(edges, p[:, None])[:, :, 0]
    longest = alpha.shape[1] - 1
    beta = np.zeros_like(alpha)
    beta[np.arange(len(lengths)), lengths] = 1
    scale = SCALE ** np.arange(longest + 1)
    order = np.lexsort((word, start))
    at = _groups(start[order], longest + 1)
    for s in range(longest - 1, -1, -1):
        e = order[at[s]:at[s + 1]]
        if len(e):
            w = word[e]
            part = beta[w, end[e]] * p[piece[e]] * scale[end[e] - s]
            head = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            beta[w[head], s] += np.add.reduceat(part, head)
    whole = alpha[np.arange(len(lengths)), lengths]
    use = alpha[word, start] * p[piece] * scale[end - start] * beta[word, end] * (weight / whole)[word]
    return np.bincount(piece, use, minlength=vocabulary.size)


def fit(vocabulary: Vocabulary, counts: dict[str, Counter]) -> Model:
    """Piece probabilities per language from its words' counts; words of over SHORT bytes are not learned from."""
    columns = []
    for language in sorted(counts):
        words = [w for w in sorted(counts[language]) if len(w.encode()) <= SHORT]
        weight = np.array([counts[language][w] for w in words], float)
        p = np.full(vocabulary.size, 1 / vocabulary.size)
        if words:
            edges = vocabulary.edges(words)
            for _ in range(ROUNDS):
                used = expected_counts(vocabulary, edges, weight, p) + PRIOR
                p = used / used.sum()
        columns.append(np.log(p))
    return Model(sorted(counts), np.array(columns).T.reshape(vocabulary.size, len(columns)))


def learn(docs: DataFrame, vocabulary: Vocabulary, id: str = "doc_id", text: str = "text", lang: str = "lang", where: Column | None = None, sample: int = SAMPLE) -> Model:
    """Fit on about `sample` documents per language, those with the smallest hash of their id among the labelled rows that `where` allows.

    Rows with a null language or text are not learned from.  The bound on rows is the parameter's; texts are read whole.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows if where is None else rows.filter(where)
    size = {r[0]: r[1] for r in rows.groupBy(lang).agg(F.count(F.lit(1))).collect()}
    share = F.lit(0.0)
    for name, n in size.items():
        share = F.when(F.col(lang) == name, min(1.0, sample / n)).otherwise(share)
    unit = F.pmod(F.xxhash64(F.col(id), F.col(text)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for name, t in zip(*(c.to_pylist() for c in batch.columns)):
                seen.setdefault(name, Counter()).update(words_of(t))
        flat = [(name, w, n) for name, c in seen.items() for w, n in c.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*flat) if flat else ([], [], []), (pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    chosen = rows.filter(unit < share).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    table = chosen.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, Counter] = {name: Counter() for name in size}
    for batch in table.to_batches():
        for name, w, n in zip(*(c.to_pylist() for c in batch.columns)):
            counts[name][w] = n
    return fit(vocabulary, counts)


def predict(docs: DataFrame, vocabulary: Vocabulary, model: Model, id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(id, *keep, lang_pred, score)`` per row: the language under which the whole text is most probable, and its posterior under equal priors.

    `und` with score 0 if the text is null or has no letter, or if no language was learned; of equally probable languages the first by name.
    Repeated rows and null ids stay; an empty table gives an empty result.
    """
    keep = keep or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        table = np.empty((0, len(model.languages)))
        for batch in slices(batches, "text"):
            split = [words_of(t) if t else [] for t in batch.column(0).to_pylist()]
            if len(number) > REMEMBER:
                number, table = {}, table[:0]
            fresh = sorted({w for ws in split for w in ws}.difference(number))
            if fresh:
                number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
                table = np.concatenate([table, log_probability(vocabulary, fresh, model)])
            names, scores = [], []
            for ws in split:
                if not ws or not model.languages:
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                total = table[np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
                best = int(total.argmax())
                names.append(model.languages[best]), scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(names), pa.array(scores)], [id, *keep, "lang_pred", "score"])

    rows = docs.select(F.col(text).alias("text"), id, *keep)
    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double")
    return for_python(rows).mapInArrow(run, schema)

"""BPE encoding by a pair occurrence index, and decoding.

All distinct words of a stretch of a partition lie in one array of symbols.  The index maps every pair that has a merge to all its
positions.  The smallest active rank is taken from a heap, its merge is applied at all positions that still hold the pair, and the lists
of the pairs that arise left and right of them are updated; a rank that gets positions becomes active.  Work follows the distinct words
of the stretch, not the text: documents are put together from the words' ids afterwards.

The rules are read from a tokenizer file of word-end BPE with byte symbols: special tokens first, then NFC and lower case, then a pattern.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, slices

#: Bytes of text whose distinct words are indexed together.
STRETCH_BYTES = 4 << 20
#: Distinct chunks a partition remembers between stretches, and tokens that are decoded together.
REMEMBER = 1 << 18
DECODE_TOKENS = 1 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 is itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    extra = {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [extra.get(b) or chr(b) for b in range(256)]


class WordBpe:
    """The tokenizer file's rules.  `document` is the file's content, so tasks need no path."""

    def __init__(self, document: str):
        spec = json.loads(document)
        model, kinds = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or spec["post_processor"]:
            raise ValueError("not a word-end BPE file that lower-cases")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(split["pattern"]["Regex"], regex.V1).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [""] * size
        for s, i in (vocab | self.special).items():
            self.token[i] = s
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = self.left << 32 | self.right
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, -1 without one."""
        key = a << 32 | b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.order[i], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and where each word's begin (one more for the end)."""
        data = [w.encode() for w in words]
        size = np.array([len(d) for d in data], np.int64)
        ends = np.cumsum(size)
        raw = np.frombuffer(b"".join(data), np.uint8)
        sym = self.inner[raw]
        sym[ends - 1] = self.last[raw[ends - 1]]
        n = len(sym)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - size] = -1
        self.apply(sym, before, after)
        alive = sym >= 0
        count = np.concatenate([[0], np.cumsum(alive)])
        return sym[alive], count[np.concatenate([[0], ends])]

    def apply(self, sym: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self.ranks(sym[at], sym[after[at]])
            known = rank >= 0
            at, rank = at[known], rank[known]
            if not at.size:
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            starts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
            for r, part in zip(rank[starts].tolist(), np.split(at, starts[1:])):
                held = index.get(r)
                if held is None:
                    index[r] = [part]
                    heapq.heappush(heap, r)
                else:
                    held.append(part)

        add(np.flatnonzero(after >= 0))
        while heap:
            r = heapq.heappop(heap)
            held = index.pop(r)
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            a, b = self.left[r], self.right[r]
            follow = after[at]
            # A position may have lost its pair meanwhile: merged away, or with another neighbour.
            good = (sym[at] == a) & (follow >= 0) & (sym[follow] == b)
            at = at[good]
            if a == b and at.size > 1:
                # In a run of one symbol the pairs overlap; from the left, every second one counts.
                at = np.sort(at)
                fresh = np.concatenate([[True], after[at[:-1]] != at[1:]])
                run = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
                at = at[run % 2 == 0]
            if not at.size:
                continue
            gone = after[at]
            nxt = after[gone]
            sym[at], sym[gone] = self.result[r], -1
            after[at] = nxt
            has = nxt >= 0
            before[nxt[has]] = at[has]
            prev = before[at]
            touched = np.concatenate([prev[prev >= 0], at[has]])
            if touched.size:
                add(np.unique(touched))


class Stretch:
    """Chunks (runs between ASCII blanks) met in a partition so far and their ids."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.pool, self.start = np.empty(0, np.int64), np.zeros(1, np.int64)

    def learn(self, chunks: set[str]) -> None:
        bpe, parts = self.bpe, []
        place: dict[str, int] = {}
        number, find = place.setdefault, bpe.words
        for chunk in chunks:
            if chunk.isascii() and "<|" not in chunk:
                parts.append([number(w, len(place)) for w in find(chunk.lower())])
                continue
            found: list[int] = []
            for piece in bpe.cut.split(chunk) if "<|" in chunk else (chunk,):
                if piece in bpe.special:
                    found.append(-1 - bpe.special[piece])
                    continue
                # Letter by letter: the capital sigma has one lower case wherever it stands.
                plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                found += [number(w, len(place)) for w in find(plain)]
            parts.append(found)
        words = list(place)
        ids, start = bpe.encode_words(words) if words else (np.empty(0, np.int64), np.zeros(1, np.int64))
        flat = np.array([w for p in parts for w in p], np.int64)
        special = flat < 0
        w = np.where(special, 0, flat)
        if not words:
            start = np.zeros(2, np.int64)
        size = np.where(special, 1, start[w + 1] - start[w])
        values = spread(ids, start[w], np.where(special, 0, size)) if len(ids) else ids
        out = np.empty(int(size.sum()), np.int64)
        mark = np.repeat(special, size)
        out[mark], out[~mark] = -1 - flat[special], values
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([len(p) for p in parts])] if parts else np.empty(0, np.int64)
        base = len(self.number)
        self.number.update(zip(chunks, range(base, base + len(parts))))
        self.start = np.concatenate([self.start, self.start[-1] + ends])
        self.pool = np.concatenate([self.pool, out])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin (one more for the end)."""
        def chunks(t: str | None) -> list[str]:
            if not t:
                return []
            for blank in "\n\t\r\v\f":
                t = t.replace(blank, " ")
            return t.split(" ")

        if len(self.number) > REMEMBER:
            self.forget()
        fresh: set[str] = set()
        for t in texts:
            fresh.update(chunks(t))
        fresh.difference_update(self.number)
        if fresh:
            self.learn(fresh)
        parts = [np.empty(0, np.int64)]
        for t in texts:
            split = chunks(t)
            parts.append(np.fromiter(map(self.number.__getitem__, split), np.int64, len(split)))
        count, which = np.array([len(p) for p in parts[1:]], np.int64), np.concatenate(parts)
        size = self.start[which + 1] - self.start[which]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        return spread(self.pool, self.start[which], size), ends


def spread(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `pool` that begin at `start`, one after another."""
    ends = np.cumsum(size)
    return pool[np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def encode(docs: DataFrame, document: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, ids)`` per row: the token ids of the whole text as an array of ints, without added special tokens.

    `document` is the content of the tokenizer file.  Special tokens written out in a text are those tokens.  A null or empty text has no
    ids; repeated rows and null ids stay as they are; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = Stretch(WordBpe(document))
        for batch in slices(batches, "text", STRETCH_BYTES):
            ids, ends = stretch.encode(batch.column(1).to_pylist())
            whole = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), whole], ["id", "ids"])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return for_python(rows).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id)


def decode(rows: DataFrame, document: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(id, ids, decoded)``: the tokens' strings joined by blanks, which is what a file without a decoder asks for; null ids give null."""
    token = WordBpe(document).token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(token, pa.string())
        for whole in batches:
            size = np.array([0 if n is None else n for n in pc.list_value_length(whole.column(1)).to_pylist()], np.int64)
            part = np.cumsum(size) // DECODE_TOKENS
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                batch = whole.slice(lo, hi - lo)
                ends = pa.array(np.concatenate([[0], np.cumsum(size[lo:hi])]).astype(np.int32))
                words = pa.ListArray.from_arrays(ends, names.take(batch.column(1).flatten()))
                joined = pc.binary_join(words, " ")
                texts = pc.if_else(batch.column(1).is_valid(), joined, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["id", "ids", "decoded"])

    kind = rows.schema[id].dataType.simpleString()
    out = rows.select(F.col(id).alias("id"), F.col(ids).alias("ids")).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id).withColumnRenamed("ids", ids)

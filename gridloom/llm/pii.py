"""Personal data: e-mail addresses, IP addresses, card and phone numbers, by fixed patterns and by a character-level tagger trained on them.

The patterns label a bounded sample of the corpus.  From the labelled spans, and from the same spans in spellings that the patterns do not
know (`spellings`), a bidirectional LSTM over characters with a CRF on top is trained in numpy.  Whole texts are read in overlapping
windows; windows are decoded by Viterbi, and neighbours are joined where both see no span, nearest to the middle of their overlap.  A span
that the tagger adds must hold a valid value of its kind, be no longer than a window, and not touch a span of the patterns.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, slices
from gridloom.session import materialise, row_count

KINDS = ("email", "ip", "card", "phone")
#: Documents that are labelled for training (expected number, chosen by a hash of the text), and windows that are kept of them.
SAMPLE, SAMPLE_WINDOWS = 20_000, 6_000
#: Characters of a window in training, of one that is decoded, and that neighbouring windows share.
TRAIN, WINDOW, OVERLAP = 96, 768, 96
#: Size of a character's vector, of a hidden state in each direction, windows decoded side by side.
EMBED, HIDDEN, BATCH = 6, 8, 2048
#: Steps of training and windows in each.
STEPS, STEP_WINDOWS = 300, 192
TAGS = 1 + len(KINDS)
NEVER = -1e4

_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: Runs of digits are taken whole, since a match can only begin and end with one.
_PATTERNS = {
    "ip": re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(rb"[0-9](?:[ -]?[0-9])++"),
    "phone": re.compile(rb"\+[0-9][ ().0-9-]+[0-9]"),
}
#: What a span that the tagger adds must look like, its spelled marks written plainly.
_VALUES = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+){3}"),
    "card": re.compile(r"[0-9]([ ./_-]{0,2}[0-9])+"),
    "phone": re.compile(r"\(?[0-9]++((\)[ ./-]{0,2}|[ ./-]{1,2})\(?[0-9]++){2,}"),
}
_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+at\s+", re.I)
_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+|\s+\.\s+", re.I)

#: Classes of bytes: letters in lower case, digits alike, whatever is not ASCII alike.
_CLASS = np.array([48 if 48 <= b < 58 else b + 32 if 65 <= b < 91 else min(b, 128) for b in range(256)], np.uint8)
CLASSES = 129


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _fits(kind: str, found: str) -> bool:
    """Whether what a pattern has matched is a value of its kind."""
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        parts = [p.lstrip("0") or "0" for p in found.split(".")]
        return all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    """An @ with the whole run of address characters before it, as far as no earlier match has them, and a domain after it."""
    low, at = 0, text.find(b"@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        low = found.end() if found else at + 1
        at = text.find(b"@", low)


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in bytes, by start, then kind: leftmost matches per kind that fit it; others are dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    for kind, pattern in _PATTERNS.items():
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _fits(kind, m[0].decode())]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _chars(text: bytes, places: list[int]) -> list[int]:
    """Code points before the given bytes."""
    before = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return [int(before[p - 1]) if p else 0 for p in places]


def spellings(kind: str, value: str, rnd: random.Random) -> str:
    """The same value, written in a way that the patterns do not know."""
    if kind == "email":
        at, dot = rnd.choice([" at ", " [at] ", "(at)", " (at) ", "[at]", " AT "]), rnd.choice([" dot ", " [dot] ", "(dot)", "[dot]", ".", " (dot) "])
        local, _, domain = value.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return value.replace(".", rnd.choice(["[.]", " . ", "(.)", " dot ", "[dot]", "(dot)"]))
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        return rnd.choice([".", "/", "--", "  ", "_"]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    land, area, mid, last = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
    form = rnd.choice(["{0} ({1}) {2}-{3}", "({1}) {2}-{3}", "{1}-{2}-{3}", "{1}.{2}.{3}", "00{0} {1} {2} {3}", "{0}-{1}-{2}-{3}", "{1} {2} {3}"])
    return form.format(land, area, mid, last).strip("- ")


def _value(kind: str, found: str) -> bool:
    """Whether a span that the tagger found holds a value of its kind."""
    plain = found
    if kind in ("email", "ip"):
        plain = _DOT.sub(".", plain)
    if kind == "email":
        plain = _AT.sub("@", plain)
    if not _VALUES[kind].fullmatch(plain):
        return False
    return _fits(kind, plain) and (kind != "email" or plain.rpartition(".")[2].isalpha())


def squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place of tanh, which would take most of the time; gates are half of it and a half."""
    return x / (1 + abs(x))


class Tagger:
    """Bidirectional LSTM over character classes with a CRF: a kind can follow itself or no kind, never another kind at once."""

    def __init__(self, seed: int = 1):
        rnd = np.random.default_rng(seed)
        wide = EMBED + HIDDEN + 1
        self.embed = rnd.normal(0, 0.5, (EMBED, CLASSES))
        self.ways = [rnd.normal(0, wide ** -0.5, (4 * HIDDEN, wide)) for _ in range(2)]
        for w in self.ways:
            w[:, -1] = 0
            w[HIDDEN:2 * HIDDEN, -1] = 1
        self.out = [rnd.normal(0, 0.3, (TAGS, HIDDEN)) for _ in range(2)]
        self.bias = np.zeros((TAGS, 1))
        self.move = np.zeros((TAGS, TAGS))
        self.barred = np.zeros((TAGS, TAGS), bool)
        self.barred[1:, 1:] = ~np.eye(TAGS - 1, dtype=bool)

    def params(self) -> list[np.ndarray]:
        return [self.embed, *self.ways, *self.out, self.bias, self.move]

    def moves(self) -> np.ndarray:
        return np.where(self.barred, NEVER, self.move)

    def learn(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of `tags` and its gradients; both arrays are (characters, windows)."""
        steps, n = codes.shape
        emit = np.repeat(np.repeat(self.bias[None], steps, 0), n, 2)
        kept = []
        for way, (w, out) in enumerate(zip(self.ways, self.out)):
            h, c = np.zeros((HIDDEN, n)), np.zeros((HIDDEN, n))
            seen = []
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                x = np.concatenate([self.embed[:, codes[t]], h, np.ones((1, n))])
                z = w @ x
                z = squash(z)
                gate, g = 0.5 + 0.5 * z[:3 * HIDDEN], z[3 * HIDDEN:]
                before = c
                c = gate[HIDDEN:2 * HIDDEN] * c + gate[:HIDDEN] * g
                bent = squash(c)
                h = gate[2 * HIDDEN:] * bent
                emit[t] += out @ h
                seen.append((t, x, gate, g, before, bent, h))
            kept.append(seen)
        loss, d_emit, d_move = self._crf(emit, tags)
        grads = [np.zeros_like(p) for p in self.params()]
        d_embed, d_ways, d_out, d_bias = grads[0], grads[1:3], grads[3:5], grads[5]
        grads[6][:] = np.where(self.barred, 0, d_move)
        d_bias[:, 0] = d_emit.sum(axis=(0, 2))
        for seen, w, out, dw, do in zip(kept, self.ways, self.out, d_ways, d_out):
            dh, dc = np.zeros((HIDDEN, n)), np.zeros((HIDDEN, n))
            d_chars = np.empty((EMBED, steps, n))
            for t, x, gate, g, before, bent, h in reversed(seen):
                do += d_emit[t] @ h.T
                dh = dh + out.T @ d_emit[t]
                i, f, o = gate[:HIDDEN], gate[HIDDEN:2 * HIDDEN], gate[2 * HIDDEN:]
                dc = dc + dh * o * (1 - abs(bent)) ** 2
                dz = np.concatenate([dc * g, dc * before, dh * bent, dc * i])
                dz[:3 * HIDDEN] *= 0.5 * (1 - abs(2 * gate - 1)) ** 2
                dz[3 * HIDDEN:] *= (1 - abs(g)) ** 2
                dw += dz @ x.T
                dx = w.T @ dz
                d_chars[:, t] = dx[:EMBED]
                dh, dc = dx[EMBED:EMBED + HIDDEN], dc * f
            d_embed += [np.bincount(codes.ravel(), d.ravel(), CLASSES) for d in d_chars]
        return loss / n, [g / n for g in grads]

    def _crf(self, emit: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        steps, _, n = emit.shape
        move = self.moves()[:, :, None]
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[0] = emit[0]
        for t in range(1, steps):
            x = alpha[t - 1][:, None] + move
            top = x.max(axis=0)
            alpha[t] = emit[t] + top + np.log(np.exp(x - top).sum(axis=0))
        for t in range(steps - 2, -1, -1):
            x = move + (emit[t + 1] + beta[t + 1])[None]
            top = x.max(axis=1)
            beta[t] = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
        top = alpha[-1].max(axis=0)
        total = top + np.log(np.exp(alpha[-1] - top).sum(axis=0))
        at, which = np.arange(steps)[:, None], np.arange(n)[None]
        gold = emit[at, tags, which].sum(axis=0) + move[tags[:-1], tags[1:], 0].sum(axis=0)
        d_emit = np.exp(alpha + beta - total)
        d_emit[at, tags, which] -= 1
        pairs = np.zeros((TAGS, TAGS))
        for t in range(1, steps):
            pairs += np.exp(alpha[t - 1][:, None] + move + (emit[t] + beta[t] - total)[None]).sum(axis=2)
        np.subtract.at(pairs, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        return float((total - gold).sum()), d_emit, pairs

    def fit(self, windows: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, seed: int = 2) -> Tagger:
        """Adam over random windows ``(classes, tags)`` of `TRAIN` characters."""
        rnd = np.random.default_rng(seed)
        codes, tags = np.stack([w[0] for w in windows], 1), np.stack([w[1] for w in windows], 1)
        first, second = [np.zeros_like(p) for p in self.params()], [np.zeros_like(p) for p in self.params()]
        for step in range(1, steps + 1):
            some = rnd.integers(0, codes.shape[1], STEP_WINDOWS)
            _, grads = self.learn(codes[:, some], tags[:, some])
            size = np.sqrt(sum((g ** 2).sum() for g in grads))
            rate = 0.03 * min(1, step / 20) * (1 - 0.95 * step / steps)
            for p, g, m, v in zip(self.params(), grads, first, second):
                g = g * min(1, 5 / max(size, 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self

    def small(self) -> dict[str, np.ndarray]:
        """The weights as they are used for reading, in single precision."""
        cast = lambda x: np.ascontiguousarray(x, np.float32)
        return {"embed": cast(self.embed), "ways": [cast(w) for w in self.ways], "out": [cast(o) for o in self.out], "bias": cast(self.bias), "move": cast(self.moves())}


def _emissions(model: dict, flat: np.ndarray, starts: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Scores (character, tag, window) of windows by falling length; `active` windows reach each character."""
    n, last = len(starts), EMBED + HIDDEN
    emit = np.empty((len(active), TAGS, n), np.float32)
    emit[:] = model["bias"]
    for way, (w, out) in enumerate(zip(model["ways"], model["out"])):
        rows, cell = np.zeros((last + 1, n), np.float32), np.zeros((HIDDEN, n), np.float32)
        zs, room = np.empty((4 * HIDDEN, n), np.float32), np.empty((4 * HIDDEN, n), np.float32)
        rows[last] = 1
        for t in range(len(active)) if way == 0 else range(len(active) - 1, -1, -1):
            k = active[t]
            x, z, c, y = rows[:, :k], zs[:, :k], cell[:, :k], room[:, :k]
            np.take(model["embed"], flat[starts[:k] + t], axis=1, out=x[:EMBED], mode="clip")
            np.matmul(w, x, out=z)
            np.abs(z, out=y)
            y += 1
            z /= y
            gate, g, h = z[:3 * HIDDEN], z[3 * HIDDEN:], x[EMBED:last]
            gate *= 0.5
            gate += 0.5
            c *= gate[HIDDEN:2 * HIDDEN]
            g *= gate[:HIDDEN]
            c += g
            np.abs(c, out=h)
            h += 1
            np.divide(c, h, out=h)
            h *= gate[2 * HIDDEN:]
            emit[t, :, :k] += out @ h
    return emit


def _viterbi(move: np.ndarray, emit: np.ndarray, active: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best tags (character, window); `emit` is used up."""
    steps, _, n = emit.shape
    back = np.empty((steps, TAGS, n), np.uint8)
    kinds = np.arange(1, TAGS, dtype=np.uint8)[:, None]
    stay, enter, leave = np.diag(move)[1:, None], move[0, 1:, None], move[:, 0, None]
    score = emit[0].copy()
    for t in range(1, steps):
        k = active[t]
        s = score[:, :k]
        new, held = s[:1] + enter, s[1:] + stay
        ends = s + leave
        best = ends.max(axis=0)
        back[t, 0, :k] = ((ends[1:] == best) * kinds).max(axis=0)
        back[t, 1:, :k] = (held >= new) * kinds
        s[0] = best
        np.maximum(new, held, out=s[1:])
        s += emit[t, :, :k]
    tags = np.zeros((steps, n), np.uint8)
    at = score.argmax(axis=0)
    which = np.arange(n)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        tags[t, :k] = at[:k]
        if t:
            at[:k] = back[t, at[:k], which[:k]]
    return tags


def read_windows(model: dict, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(window, tags)`` of the windows of `flat` that hold a span."""
    order = np.argsort(-lengths, kind="stable")
    for lo in range(0, len(order), BATCH):
        some = order[lo:lo + BATCH]
        size = lengths[some]
        active = np.searchsorted(-size, -np.arange(size[0]), "left")
        tags = _viterbi(model["move"], _emissions(model, flat, starts[some], active), active, size)
        for i in np.flatnonzero(tags.any(axis=0)):
            yield int(some[i]), tags[:size[i], i].copy()


def windows_of(n: int) -> list[tuple[int, int]]:
    """Start and length of the windows of a text of `n` characters."""
    if n <= WINDOW:
        return [(0, n)] if n else []
    starts = range(0, n - OVERLAP, WINDOW - OVERLAP)
    return [(s, min(WINDOW, n - s)) for s in starts]


def reconcile(n: int, tags: dict[int, np.ndarray]) -> list[tuple[int, int, int]]:
    """Spans ``(tag, start, end)`` of a text from the tags of its windows; windows that are not given hold no span.

    Two neighbours part where both have no tag, nearest to the middle of their overlap, or there if there is no such place.
    """
    places = windows_of(n)
    out: list[tuple[int, int, int]] = []
    for first in sorted(tags):
        if first - 1 in tags:
            continue
        last = first
        while last + 1 in tags:
            last += 1
        # A stretch of windows, with an empty one to either side.
        lo, hi = max(first - 1, 0), min(last + 1, len(places) - 1)
        base = places[lo][0]
        line = np.zeros(sum(places[hi]) - base, np.uint8)
        cut = base
        for w in range(lo, hi + 1):
            start, size = places[w]
            own = tags.get(w, np.zeros(size, np.uint8))
            if w > lo:
                shared = places[w - 1][0] + places[w - 1][1] - start
                other = tags.get(w - 1, np.zeros(places[w - 1][1], np.uint8))[-shared:]
                free = np.flatnonzero((other == 0) & (own[:shared] == 0))
                middle = shared // 2
                cut = start + (int(free[np.argmin(abs(free - middle))]) if len(free) else middle)
            line[cut - base:start + size - base] = own[cut - start:]
        edges = np.flatnonzero(np.diff(np.r_[0, line, 0]))
        starts = np.flatnonzero((line > 0) & (np.r_[0, line[:-1]] != line))
        ends = edges[np.searchsorted(edges, starts, "right")] if len(starts) else edges
        out += [(int(line[a]), base + int(a), base + int(b)) for a, b in zip(starts, ends)]
    return out


_GROW = {"email": (re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"[A-Za-z0-9-]"))}
_DIGIT = re.compile("[0-9]")


def _settled(kind: str, text: str, start: int, end: int) -> tuple[str, int, int] | None:
    """A tagged span moved to the edges of the words it touches, if it holds a value there: of the tagged kind or else of another."""
    before, after = _GROW.get(kind, (_DIGIT, _DIGIT))
    while start < end and text[start] in " \t\n.,;:!?)]}":
        start += 1
    while end > start and text[end - 1] in " \t\n.,;:!?([{":
        end -= 1
    low, high = max(0, start - WINDOW), min(len(text), end + WINDOW)
    while start > low and before.match(text[start - 1]):
        start -= 1
    while end < high and after.match(text[end]):
        end += 1
    if kind == "phone" and start and text[start - 1] == "(":
        start -= 1
    alone = (not start or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
    found = [k for k in (kind, *KINDS) if 0 < end - start <= WINDOW and alone and _value(k, text[start:end])]
    return (found[0], start, end) if found else None


def _labelled(docs: DataFrame) -> DataFrame:
    """``(window, start, end, kind)``: stretches of the sample around spans of the patterns, and some without one (kind is null)."""
    half = TRAIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for t in batch.column(0):
                raw = t.as_py()
                found = base_spans(raw)
                text = raw.decode()
                at = _chars(raw, [p for s in found for p in s[1:]]) if found else []
                spans = [(k, at[2 * i], at[2 * i + 1]) for i, (k, _, _) in enumerate(found)]
                rnd = random.Random(len(text))
                for k, a, b in spans[:8]:
                    if b - a < TRAIN // 2 and sum(1 for _, c, d in spans if c < b + half and d > a - half) == 1:
                        lo = max(0, a - half)
                        rows.append((text[lo:b + half], a - lo, b - lo, k))
                # Digits and signs that are no span, and any stretch.
                odd = [m.start() for m in re.finditer(r"[0-9@+][0-9a-f]{3}|@|\bat\b|\bdot\b", text)][:200]
                for p in rnd.sample(odd, min(2, len(odd))) + [rnd.randrange(len(text))] * bool(text):
                    lo = max(0, p - half)
                    if not any(a < p + half and b > lo for _, a, b in spans):
                        rows.append((text[lo:p + half], 0, 0, None))
            yield pa.RecordBatch.from_pylist([dict(zip(("window", "start", "end", "kind"), r)) for r in rows], pa.schema(
                [("window", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    return for_python(docs).mapInArrow(run, "window string, start int, end int, kind string")


def _encode(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return _CLASS[raw[(raw & 0xC0) != 0x80]]


def training_windows(rows: list, seed: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """`TRAIN` characters and their tags of each labelled stretch, and of others in which its span is spelled anew."""
    rnd, out = random.Random(seed), []
    for text, start, end, kind in rows:
        forms = [text[start:end]] + [spellings(kind, text[start:end], rnd) for _ in range(3)] if kind else [""]
        for form in forms:
            whole = text[:start] + form + text[end:]
            stop = start + len(form)
            first, last = max(0, stop - TRAIN), max(0, min(start, len(whole) - TRAIN))
            lo = rnd.randint(min(first, last), max(first, last))
            tags = np.zeros(TRAIN, np.uint8)
            if kind:
                tags[max(start - lo, 0):max(stop - lo, 0)] = 1 + KINDS.index(kind)
            out.append((_encode(whole[lo:lo + TRAIN].ljust(TRAIN)), tags))
    return out


def learn(docs: DataFrame, text: str = "text") -> dict | None:
    """The tagger's weights, learned from a sample of about `SAMPLE` texts; None if the sample holds no span."""
    rows = docs.select(F.col(text).cast("binary").alias("text")).filter("text IS NOT NULL")
    n = rows.count()
    share = 1_000_000 * SAMPLE // max(n, SAMPLE)
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share)
    # Copies give a stretch once; the kinds are far apart in number, so each has its own share of the windows.
    found = materialise(_labelled(sample).distinct())
    rows_ = []
    for kind in (*KINDS, None):
        own = found.filter(F.col("kind").eqNullSafe(F.lit(kind))).orderBy(F.xxhash64("window"), "window", "start").limit(SAMPLE_WINDOWS // 5)
        rows_ += [tuple(r) for r in own.collect()]
    if not any(r[3] for r in rows_):
        return None
    return Tagger().fit(training_windows(rows_)).small()


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def find(docs: DataFrame, model: dict | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, spans)`` per row of `docs`: the spans of personal data in the whole text by start, then kind as in `KINDS`.

    `start` and `end` count code points; `base` tells the spans of the patterns, which are all there, from those the tagger (`learn`)
    adds; without a model there are only the former.  Null and empty texts have none; repeated rows stay; an empty table gives an empty
    result; other columns are not read.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for batch in slices(batches, "text"):
            texts = [t.as_py() or b"" for t in batch.column(1)]
            out, classes, window, at = [], [], [], 0
            for i, raw in enumerate(texts):
                found = base_spans(raw)
                places = _chars(raw, [p for s in found for p in s[1:]]) if found else []
                out.append([(k, places[2 * j], places[2 * j + 1], True) for j, (k, _, _) in enumerate(found)])
                if model is not None:
                    own = np.frombuffer(raw, np.uint8)
                    own = _CLASS[own[(own & 0xC0) != 0x80]]
                    window += [(i, w, at + s, size) for w, (s, size) in enumerate(windows_of(len(own)))]
                    classes.append(own)
                    at += len(own)
            if window:
                table = np.array(window, np.int64)
                tags: dict[int, dict[int, np.ndarray]] = {}
                for j, got in read_windows(model, np.concatenate(classes), table[:, 2], table[:, 3]):
                    tags.setdefault(window[j][0], {})[window[j][1]] = got
                for i, got in tags.items():
                    _add(out[i], texts[i].decode(), reconcile(len(classes[i]), got))
            rows = [[dict(zip(("kind", "start", "end", "base"), s)) for s in found] for found in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], ["id", "spans"])

    kind = docs.schema[id].dataType.simpleString()
    rows = for_python(docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text")))
    return rows.mapInArrow(run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id)


def _add(spans: list[tuple[str, int, int, bool]], text: str, found: list[tuple[int, int, int]]) -> None:
    """Adds what the tagger found to the spans of a text, in order; what touches a span is left out."""
    taken = sorted((a, b) for _, a, b, _ in spans)
    edge, k, more = 0, 0, []
    for tag, a, b in found:
        settled = _settled(KINDS[tag - 1], text, a, b)
        if settled is None or settled[1] < edge:
            continue
        kind, a, b = settled
        while k < len(taken) and taken[k][1] <= a - WINDOW:
            k += 1
        near = k
        clear = True
        while near < len(taken) and taken[near][0] < b:
            clear = clear and taken[near][1] <= a
            near += 1
        if clear:
            more.append((kind, a, b, False))
            edge = b
    spans += more
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))


def listed(spans: Column) -> Column:
    """Spans as `kind:start:end`, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

"""Toxicity with noisy-channel deobfuscation.

Text that may be disguised (digits or signs for letters, letters spaced out, letters repeated)
is decoded first: each suspicious span becomes a lattice of what its characters may stand
for, themselves included, and the Viterbi path through it under a character language model, counted over all
documents, replaces the span. A span is suspicious if a sign stands next to a letter, if a letter is repeated
(once in two places, or twice), or if three characters or more stand alone with one to MOST_BETWEEN characters
between them. Words cut in two by one space are not put together. Characters outside such spans have one reading only, so that the
path through the rest of the text is the text itself. The restored text is then scored by
its words' beginnings with a logistic model learned from labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy, worker_cache

#: Bound of the labelled rows that the classifier is learned from (smallest hash of their id).
MAX_LABELLED = 12_000
MAX_FEATURES = 3_000
LEAST_SUPPORT = 3
LEAST_LOG_ODDS = 2.0
THRESHOLD = 0.3

#: Alphabet of the language model: 0 is a border, then letters, then one code for other letters.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêëçñíóáúàâîïôûùœæ"
OTHER = len(LETTERS) + 1
BITS = 6
#: What disguising signs may stand for.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
SIGN_CODE = 62
#: Costs, in nats, of a reading: a sign as a letter, a sign inside a word dropped (more than a letter costs under the
#: language model, or dropping would always pay), a border in a spaced-out span, a letter that is repeated beyond any spelling dropped, a doubled
#: one dropped from a span that is disguised otherwise (from others never: many words have doubled letters).
AS_LETTER, DROPPED, BORDER, REPEAT_DROPPED, DOUBLE_DROPPED = 1.0, 16.0, 2.0, 1.5, 12.0
#: Costs of leaving a sign at a word's end as it is (many words end in some), and before a word (as in numbers; less so if signs stand inside too).
KEPT_AT_END = {"!": 0.2, "+": 2.5, "|": 2.5, "$": 16.0, "@": 16.0}
KEPT_DIGIT_AT_END, KEPT_BEFORE, KEPT_BEFORE_SIGNS = 2.0, 1.0, 12.0
#: Separators between characters that stand alone, at most.
MOST_BETWEEN = 3
#: After so many characters, what all readings left of a span agree on is settled, so that memory does not grow with the span.
SETTLE = 256
#: Spans up to this length are kept with their readings.
MEMO_CHARS = 512
SPAN_MEMO = 100_000
#: Texts are worked on in pieces of about so many characters together.
CHUNK_CHARS = 1 << 20
#: Odd multipliers of the places in a word that is hashed as a whole.
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)], np.uint64)
#: Lengths of the word beginnings that are features.
PREFIXES = (4, 5, 6)


def _code_table() -> np.ndarray:
    table = np.zeros(1 << 14, np.uint8)
    for c in range(len(table)):
        if chr(c).isalpha():
            table[c] = OTHER
    for k, c in enumerate(LETTERS, 1):
        table[ord(c)] = k
    for c in SIGNS:
        table[ord(c)] = SIGN_CODE
    return table


_CODES = _code_table()
_NUMBER = {c: k for k, c in enumerate(LETTERS, 1)}
_THREE = re.compile(r"(.)\1\1")
_BETWEEN_SET = frozenset(chr(c) for c in range(128) if not chr(c).isalpha() and chr(c) not in SIGNS)


def codes(text: str) -> np.ndarray:
    """A code for every character of a lower-case text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CODES[np.minimum(points, len(_CODES) - 1)]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield first, k
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def character_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n): counts of three successive codes, packed into one number, over all texts.

    Each task adds up its own counts first; there are at most 2**18 different grams.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 3 * BITS, np.int64)
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            for a, b in _chunks(texts):
                c = codes("  ".join(["", *texts[a:b], ""]).lower()).astype(np.int32)
                c[c == SIGN_CODE] = 0
                total += np.bincount(c[:-2] << 2 * BITS | c[1:-1] << BITS | c[2:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["gram", "n"])

    parts = docs.select(docs[text_col].alias("text")).mapInArrow(tidy("toxicity", run), "gram int, n bigint")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Costs in nats, -log p(c | a, b), by codes a, b, c: interpolated with shorter contexts."""
    rows = character_counts(docs, text_col).collect()  # at most 2**18
    n = np.zeros(1 << 3 * BITS)
    for r in rows:
        n[r.gram] = r.n
    side = 1 << BITS
    tri = n.reshape(side, side, side)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + side)
    p2 = (bi + 20 * p1) / (bi.sum(1, keepdims=True) + 20)
    p3 = (tri + 20 * p2) / (tri.sum(2, keepdims=True) + 20)
    return -np.log(p3).astype(np.float32)


class Around(NamedTuple):
    """Of a span: for each character whether only signs, or nothing, are between it and the span's beginning or a separator, and the same
    towards the end; whether a sign stands inside; whether a digit at the edge of one or two letters is its only sign; whether it
    has signs or separators at all; places of letters in chains of doubled ones."""

    begin: list[bool]
    end: list[bool]
    inner: bool
    lone: bool
    disguised: bool
    chained: set[int]


class Restorer:
    """Finds suspicious spans and replaces them by their best reading; works on lower-case texts."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost.tolist()
        self.memo: dict[str, str] = {}

    @staticmethod
    def suspicious(c: np.ndarray) -> np.ndarray:
        """Positions where a span may lie; c: codes, with two borders or more at both ends."""
        letter = (c > 0) & (c <= OTHER)
        sign = c == SIGN_CODE
        either = letter | sign
        hit = np.zeros(len(c), bool)
        hit[:-1] |= sign[:-1] & letter[1:]
        hit[1:] |= sign[1:] & letter[:-1]
        again = np.zeros(len(c), bool)
        again[1:] = letter[1:] & (c[1:] == c[:-1])
        twice = np.flatnonzero(again)
        if len(twice) > 1:  # two in one word
            breaks = np.cumsum(~either)
            hit[twice[1:][breaks[twice[1:]] == breaks[twice[:-1]]]] = True
        alone = either.copy()
        alone[1:] &= ~either[:-1]
        alone[:-1] &= ~either[1:]
        at = np.flatnonzero(alone)
        if len(at) > 2:
            count = np.cumsum(either)
            near = (at[1:] - at[:-1] <= MOST_BETWEEN + 1) & (count[at[1:]] - count[at[:-1]] == 1)
            hit[at[2:][near[1:] & near[:-1]]] = True
        return np.flatnonzero(hit)

    def restore(self, text: str, hits: np.ndarray | None = None) -> str:
        c = codes(f"  {text}  ")
        at = self.suspicious(c) - 2 if hits is None else hits
        if not len(at):
            return text
        kinds = c[2:-2].tolist()
        n, out, done = len(text), [], 0
        for p in at.tolist():
            if p < done:
                continue
            a = b = p
            while a > done and kinds[a - 1]:
                a -= 1
            while b < n and kinds[b]:
                b += 1
            if b - a == 1:  # characters that stand alone go on in one span
                while (k := self._alone_near(kinds, a, -1)) >= done:
                    a = k
                while (k := self._alone_near(kinds, b - 1, 1)) >= 0:
                    b = k + 1
            out += [text[done:a], self.read(text[a:b])]
            done = b
        return "".join([*out, text[done:]])

    @staticmethod
    def _alone_near(kinds: list[int], k: int, step: int) -> int:
        """The next character that stands alone, with few characters between; -1 if there is none."""
        for d in range(2, MOST_BETWEEN + 2):
            j = k + step * d
            if not 0 <= j < len(kinds):
                return -1
            if kinds[j]:
                return -1 if 0 <= j + step < len(kinds) and kinds[j + step] else j
        return -1

    def read(self, span: str) -> str:
        known = self.memo.get(span)
        if known is None:
            if len(self.memo) >= SPAN_MEMO:
                self.memo.clear()
            known = self.viterbi(span)[0]
            if len(span) <= MEMO_CHARS:
                self.memo[span] = known
        return known

    @staticmethod
    def around(span: str) -> Around:
        """What options() has to know of a whole span."""

        def bare(chars: str) -> list[bool]:
            out, only, before = [], True, ""
            for x in chars:
                out.append(only or before in _BETWEEN_SET)
                only, before = only and x in SIGNS, x
            return out

        begin, end = bare(span), bare(span[::-1])[::-1]
        signs = [k for k, x in enumerate(span) if x in SIGNS]
        doubled = [k for k in range(1, len(span)) if span[k] == span[k - 1] and span[k].isalpha()]
        twice = set(doubled)
        chained = set()
        for k in doubled:  # three doubled letters in a row
            if k + 2 in twice and k + 4 in twice:
                chained |= {k, k + 2, k + 4}
        lone = len(signs) == 1 and span[signs[0]].isdigit() and sum(x.isalpha() for x in span) < 3
        return Around(begin, end, any(not begin[k] and not end[k] for k in signs), lone, bool(signs) or bool(_THREE.search(span)) or any(x in _BETWEEN_SET for x in span), chained)

    def options(self, span: str, k: int, around: Around | None = None) -> list[tuple[str, int, float]]:
        """What the k-th character may stand for: what is written, its code (-1: none), and the cost."""
        x = span[k]
        near = around or self.around(span)
        if x in SIGNS:
            if near.lone:
                return [(x, 0, 0.0)]
            found = [(y, _NUMBER.get(y, OTHER), AS_LETTER) for y in SIGNS[x]]
            if near.end[k]:
                return [*found, (x, 0, KEPT_AT_END.get(x, KEPT_DIGIT_AT_END))]
            if near.begin[k]:
                return [*found, (x, 0, KEPT_BEFORE_SIGNS if near.inner else KEPT_BEFORE)]
            return [*found, ("", -1, DROPPED), (" ", 0, DROPPED)]
        if not x.isalpha():
            return [("", -1, 0.0), (" ", 0, BORDER)]
        z = _NUMBER.get(x, OTHER)
        if k and span[k - 1] == x:
            if span[k - 2 : k - 1] == x or span[k + 1 : k + 2] == x or k in near.chained:  # three in a row, or three doubled letters, are no spelling
                return [(x, z, 0.0), ("", -1, REPEAT_DROPPED)]
            if near.disguised:
                return [(x, z, 0.0), ("", -1, DOUBLE_DROPPED)]
        return [(x, z, 0.0)]

    def step(self, state: tuple[int, int], code: int) -> tuple[tuple[int, int], float]:
        """The state (last two codes) after one more code, and what the language model says it costs; borders do not follow each other."""
        a, b = state
        if code < 0 or (not code and not b):
            return state, 0.0
        return (b, code), self.cost[a][b][code]

    def viterbi(self, span: str) -> tuple[str, float]:
        """The cheapest reading of a span, and its cost."""
        if not any(x.isalpha() for x in span):
            return span, 0.0
        best: dict[tuple[int, int], tuple[float, int]] = {(0, 0): (0.0, -1)}
        trail: list[tuple[int, str]] = []  # (trail before, what was written)
        settled: list[str] = []
        near = self.around(span)
        for k in range(len(span)):
            then: dict[tuple[int, int], tuple[float, int]] = {}
            for y, code, extra in self.options(span, k, near):
                for state, (had, back) in best.items():
                    after, more = self.step(state, code)
                    now = had + extra + more
                    if after not in then or now < then[after][0]:
                        if y:
                            trail.append((back, y))
                        then[after] = (now, len(trail) - 1 if y else back)
            best = then
            if k % SETTLE == SETTLE - 1:
                best, trail = self.settle(best, trail, settled)
        _, _, back = min((had + (self.cost[a][b][0] if b else 0.0), place, back) for place, ((a, b), (had, back)) in enumerate(best.items()))
        total = min(had + (self.cost[a][b][0] if b else 0.0) for (a, b), (had, _) in best.items())
        return "".join([*settled, *written(trail, back)]), total

    @staticmethod
    def settle(best: dict[tuple[int, int], tuple[float, int]], trail: list[tuple[int, str]], settled: list[str]) -> tuple[dict[tuple[int, int], tuple[float, int]], list[tuple[int, str]]]:
        """Moves what all readings left begin with to settled, and leaves a trail of the rest. No choice that is still open is made."""
        rests = {state: written(trail, back) for state, (_, back) in best.items()}
        same, first = 0, next(iter(rests.values()))
        least = min(map(len, rests.values()))
        while same < least and all(r[same] == first[same] for r in rests.values()):
            same += 1
        settled += first[:same]
        fresh: list[tuple[int, str]] = []
        then = {}
        for state, (had, _) in best.items():
            back = -1
            for y in rests[state][same:]:
                fresh.append((back, y))
                back = len(fresh) - 1
            then[state] = (had, back)
        return then, fresh


def written(trail: list[tuple[int, str]], back: int) -> list[str]:
    out = []
    while back >= 0:
        back, y = trail[back]
        out.append(y)
    return out[::-1]


def restore_all(texts: list[str], restorer: Restorer) -> list[str]:
    """Restored lower-case texts; suspicious places are searched for in many texts at once."""
    low = [t.lower() for t in texts]
    for a, b in _chunks(low):
        joined = "    ".join(["", *low[a:b], ""])
        hits = restorer.suspicious(codes(joined))
        if len(hits):
            starts = np.cumsum([4, *(len(t) + 4 for t in low[a:b])])
            own = np.searchsorted(starts, hits, "right") - 1
            for k in np.unique(own):
                low[a + k] = restorer.restore(low[a + k])
    return low


def beginnings(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all word beginnings and whole words, each once per text.

    A beginning is 4 to 6 codes in one number; so is a whole word of up to three. Of words of more than six, a hash of all codes is another.
    """
    parts = []
    for a, b in _chunks(texts):
        c = codes("      ".join(["", *texts[a:b], "", ""])).astype(np.int64)
        c[c == SIGN_CODE] = 0
        at = np.flatnonzero((c[1:] > 0) & (c[:-1] == 0)) + 1
        starts = np.cumsum([6, *(len(t) + 6 for t in texts[a:b])])
        own = np.searchsorted(starts, at, "right") - 1 + a
        key, alive = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for n in range(1, max(PREFIXES) + 1):
            x = c[at + n - 1]
            alive &= x > 0
            key = key << BITS | x
            if n in PREFIXES:
                parts.append(np.unique(np.stack([own[alive], key[alive] | n << 40]), axis=1) if alive.any() else np.zeros((2, 0), np.int64))
        borders = np.flatnonzero(c == 0)
        size = borders[np.searchsorted(borders, at)] - at if len(at) else np.zeros(0, np.int64)
        short = np.zeros(len(at), np.int64)
        for n in range(3):
            short = np.where(size > n, short << BITS | c[np.minimum(at + n, len(c) - 1)], short)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        every = c[np.repeat(at, size) + place].astype(np.uint64) * _POWERS[place % len(_POWERS)]
        whole = np.add.reduceat(every, np.cumsum(size) - size) if len(at) else np.zeros(0, np.uint64)
        long = (whole >> np.uint64(24)).astype(np.int64)
        for chosen, key, kind in ((size <= 3, short, 32), (size > max(PREFIXES), long, 48)):
            if chosen.any():
                parts.append(np.unique(np.stack([own[chosen], key[chosen] | (size[chosen] + kind if kind == 32 else kind) << 40]), axis=1))
    both = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
    return both[0], both[1]


@dataclass
class Model:
    """The language model's costs, the features in order, their weights, and the intercept."""

    cost: np.ndarray
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = -6.0

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, feature's place) for restored texts."""
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        own, key = beginnings(texts)
        at = np.minimum(np.searchsorted(self.features, key), len(self.features) - 1)
        on = self.features[at] == key
        return own[on], at[on]

    def scores(self, texts: list[str]) -> np.ndarray:
        own, at = self.hits(texts)
        z = self.intercept + np.bincount(own, self.weights[at] if len(at) else None, minlength=len(texts)).astype(float)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _restorer(cost: np.ndarray) -> Restorer:
    """One per Python worker and model."""
    kept, key = worker_cache("toxicity"), hash(cost.tobytes())
    if key not in kept:
        kept.clear()
        kept[key] = Restorer(cost)
    return kept[key]


def _over_texts(at: int, make: Callable[[list[str]], list[pa.Array]], names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                made = make([t or "" for t in part.column(at).to_pylist()])
                kept = [c for k, c in enumerate(part.columns) if k != at]
                yield pa.RecordBatch.from_arrays([*kept, *made], names)

    return tidy("toxicity", run)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MAX_LABELLED) -> Model:
    """The language model from all of docs, the classifier from at most `most` rows of labels.

    The rows with the smallest hash of their id are taken, and of several texts with one id the least. Null labels and ids are passed over. With one class only
    there are no features and every score is the same, near 0.
    """
    spark = docs.sparkSession
    cost = language_model(docs, text_col)
    sample = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)  # bounded: broadcast
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")  # at most `most`, also where ids repeat
    sent = spark.sparkContext.broadcast(cost)
    restored = materialize(
        rows.mapInArrow(_over_texts(1, lambda texts: [pa.array(restore_all(texts, _restorer(sent.value)))], ["label", "text"]), "label int, text string"), "labelled"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.array(batch.column(0).to_pylist(), np.int64)
            own, key = beginnings(batch.column(1).to_pylist())
            seen, n = np.unique(np.stack([key, label[own]]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen[0]), pa.array(seen[1]), pa.array(n)], ["feature", "label", "n"])

    sizes = {r.label: r["count"] for r in restored.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    model = Model(cost)
    if not n1 or not n0:
        return model
    toxic, clean = (F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)) for k in (1, 0))
    seen = restored.mapInArrow(count, "feature bigint, label bigint, n bigint").groupBy("feature").agg(toxic.alias("t"), clean.alias("c"))
    odds = F.log((F.col("t") + 0.5) / (n1 + 1)) - F.log((F.col("c") + 0.5) / (n0 + 1))
    top = seen.filter(F.col("t") >= LEAST_SUPPORT).withColumn("odds", odds).filter(F.col("odds") >= LEAST_LOG_ODDS)
    best = top.orderBy((F.col("odds") * F.col("t")).desc(), "feature").limit(MAX_FEATURES).select("feature").collect()
    if not best:
        return model
    model.features = np.sort(np.array([r.feature for r in best], np.int64))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, at = model.hits(batch.column(1).to_pylist())
            cut = np.searchsorted(own := own[(order := np.lexsort((at, own)))], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(at[order], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["label", "at"])

    found = restored.mapInArrow(hits, "label int, at array<bigint>").collect()  # at most `most` rows
    found.sort(key=lambda r: (r.label, r["at"]))
    y = np.array([r.label for r in found], float)
    own = np.repeat(np.arange(len(found)), [len(r["at"]) for r in found])
    at = np.array([k for r in found for k in r["at"]], np.int64)
    model.weights, model.intercept = _fit(y, own, at, len(model.features))
    return model


def _fit(y: np.ndarray, own: np.ndarray, at: np.ndarray, n: int, steps: int = 400, ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge and weights of at least 0, by projected gradient steps with momentum."""
    w, b = np.zeros(n), float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
    vw, vb = np.zeros(n), 0.0
    scale = 4.0 / (np.bincount(at, minlength=n) + 1)
    for _ in range(steps):
        z = b + np.bincount(own, w[at], minlength=len(y))
        e = y - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        vw = 0.8 * vw + 0.1 * scale * (np.bincount(at, e[own], minlength=n) - ridge * w)
        vb = 0.8 * vb + 0.4 * e.mean() * 4
        w, b = np.maximum(w + vw, 0), b + vb
    return w, float(b)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score (0 to 1).

    Whole texts are restored and scored; only the text is looked at. Null and empty texts get the score of a text
    without any feature. Repeated rows get the same score each. Other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: list[str]) -> list[pa.Array]:
        return [pa.array(sent.value.scores(restore_all(texts, _restorer(sent.value.cost))))]

    return source.mapInArrow(_over_texts(1, make, ["doc_id", "score"]), f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def deobfuscate_texts(docs: DataFrame, cost: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, restored (lower-case text with suspicious spans read); null texts give empty ones."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(cost)
    make = lambda texts: [pa.array(restore_all(texts, _restorer(sent.value)))]
    return source.mapInArrow(_over_texts(1, make, ["doc_id", "restored"]), f"doc_id {source.schema['doc_id'].dataType.simpleString()}, restored string")


def held_out(id_col: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))

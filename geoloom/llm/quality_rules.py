"""Quality rules as a learned decision list.

Statistics of each text are thresholded by an ordered list of rules, each a conjunction of
at most MAX_CONDITIONS thresholds. The list is learned by sequential covering: a rule is
grown on two thirds of the labelled rows by FOIL's gain, pruned from its end on the other
third, and kept if it is right often enough there; the rows that it covers go, and the next
rule is grown, until no rule helps. The result is an ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, tidy

#: Bound of the labelled rows that rules are learned from (those with the smallest hash of their id).
MAX_LABELLED = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
#: Least precision of a rule, on rows that it was not grown from and after smoothing.
LEAST_PRECISION = 0.9
#: Least rejected rows that a rule covers, both of those that it was grown from and of those that it was not.
LEAST_COVER = 3
THRESHOLDS = 48

#: Base rules (fixed values): too few words, or too large a share of words in repeated windows.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
#: Characters counted as symbols, and the six characters between words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

#: Counts of a text, all long.
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaims", "n_digits", "n_distinct_words")
#: What rules may test: ratios of the counts, which do not depend on a text's length.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "exclaims_per_word": ("n_exclaims", "n_words"),
    "digit_share": ("n_digits", "word_chars"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "mean_word_chars": ("word_chars", "n_words"),
}


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows (of so many words) that occur twice or more; ids: the words as integers."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    for j in range(window):
        mixed = mixed * factor + ids[j : j + n].astype(np.uint64)
    order = np.sort(mixed)
    if not (order[1:] == order[:-1]).any():  # equal windows have equal hashes
        return 0
    names = ids  # exact names of ever longer windows, two halves at a time
    have = 1
    while have < window:
        step = min(have, window - have)
        left, right = names[: len(names) - step], names[step:]
        names = np.unique(left * (int(names.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)
        have += step
    found = np.bincount(names)[names] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(found)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of STATISTICS; a null text counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at exactly the six characters of SPACES
    ids: dict[bytes, int] = {}
    named = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dups += 1
            seen.add(line)
    codes = np.frombuffer(raw, np.uint8)
    by_byte = np.bincount(codes, minlength=256)
    count = lambda chars: int(sum(by_byte[ord(c)] for c in chars))
    upper = int(by_byte[65:91].sum()) if len(raw) == len(text) else sum(map(str.isupper, text))
    return (
        len(words), len(text) - count(SPACES), count(SYMBOLS), dups, repeated_words(named), lines, upper, count("!"), count("0123456789"), len(ids)
    )


def with_statistics(docs: DataFrame, text_col: str = "text", into: str = "stats") -> DataFrame:
    """docs with one more column, a struct of STATISTICS; every other column passes through untouched."""
    kind = T.StructType([T.StructField(s, T.LongType()) for s in STATISTICS])
    out = T.StructType([*docs.schema.fields, T.StructField(into, kind)])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, max(batch.num_rows, 1), 1024):
                part = batch.slice(first, 1024)
                rows = [statistics(t) for t in part.column(at).to_pylist()]
                columns = list(zip(*rows, strict=True)) or [()] * len(STATISTICS)
                made = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(STATISTICS))
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, into])

    return docs.mapInArrow(tidy("quality", run), out)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        x = data[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self, stats: str) -> Column:
        x = feature_column(self.feature, stats)
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def feature_column(feature: str, stats: str) -> Column:
    part, whole = FEATURES[feature]
    return F.col(f"{stats}.{part}").cast("double") / F.greatest(F.col(f"{stats}.{whole}"), F.lit(1)).cast("double")


def _covered(rule: Rule, data: dict[str, np.ndarray], n: int) -> np.ndarray:
    on = np.ones(n, bool)
    for c in rule:
        on &= c.holds(data)
    return on


def _grow(data: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: list[Condition] = []
    on = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (on & ~bad).any():
        p0, n0 = (on & bad).sum(), (on & ~bad).sum()
        before = np.log2(p0 / (p0 + n0))
        best, gain = None, 1e-9
        for name in FEATURES:
            x = data[name][on]
            cuts = np.unique(np.quantile(data[name][on & bad], np.linspace(0, 1, THRESHOLDS)))
            for t in cuts:
                # a threshold lies between two values seen, so that rows near it do not flip
                for above in (True, False):
                    edge = float((x[x < t].max() + t) / 2) if above and (x < t).any() else float((x[x > t].min() + t) / 2) if not above and (x > t).any() else None
                    if edge is None:
                        continue
                    hold = x > edge if above else x <= edge
                    p, n = (hold & bad[on]).sum(), (hold & ~bad[on]).sum()
                    if p >= LEAST_COVER and (g := p * (np.log2(p / (p + n)) - before)) > gain:
                        best, gain = Condition(name, above, edge), g
        if best is None:
            break
        rule.append(best)
        on &= best.holds(data)
    return tuple(rule)


def learn(data: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Rules that say which rows are bad; data: the features by name. No rules where either class is missing."""
    rules: list[Rule] = []
    n = len(bad)
    held = np.arange(n) % 3 == 2
    left = np.ones(n, bool)
    while len(rules) < MAX_RULES:
        at = np.flatnonzero(left & ~held)
        if bad[at].sum() < LEAST_COVER or bad[at].all():
            break
        rule = _grow({k: v[at] for k, v in data.items()}, bad[at])
        if not rule:
            break
        check = left & held
        worth = lambda r: ((c := _covered(r, data, n) & check) & bad).sum() - 2 * (c & ~bad).sum()
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), len(r)))  # pruned from its end
        on = _covered(rule, data, n) & left
        p, good = (on & held & bad).sum(), (on & held & ~bad).sum()
        if worth(rule) <= 0 or p < LEAST_COVER or (p + 0.5) / (p + good + 1) < LEAST_PRECISION:
            break
        rules.append(rule)
        left &= ~on
    return rules


def decision(rules: list[Rule], stats: str = "stats") -> Column:
    """The number of the first rule that holds, from 1; 0 if none does. Ordered conditions, evaluated in the JVM."""
    out = None
    for k, rule in enumerate(rules, 1):
        on = rule[0].column(stats)
        for c in rule[1:]:
            on = on & c.column(stats)
        out = F.when(on, F.lit(k)) if out is None else out.when(on, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed(stats: str = "stats") -> Column:
    words, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < LEAST_WORDS) | (repeated * 100 > words * MOST_REPEATED_PERCENT)


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MAX_LABELLED) -> list[Rule]:
    """Learns from at most `most` labelled rows, those with the smallest hash of their id; label 0 is bad.

    Of several texts with one id, that with the least statistics counts.
    Rows that fail a base rule anyway are left out, so that rules say something new.
    """
    sample = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)  # bounded: broadcast
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    told = with_statistics(rows).filter(~base_failed()).groupBy("doc_id", "label").agg(F.min("stats").alias("stats"))  # at most `most`, also where ids repeat
    told = told.select("doc_id", "label", "stats.*")
    pdf = told.toPandas().sort_values(["doc_id", "label", *STATISTICS])
    pdf = pdf.iloc[np.random.default_rng(0).permutation(len(pdf))]
    data = {k: pdf[a].to_numpy(np.float64) / np.maximum(pdf[b].to_numpy(np.float64), 1) for k, (a, b) in FEATURES.items()}
    return learn(data, pdf["label"].to_numpy() == 0)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", stats: str = "stats") -> DataFrame:
    """docs with the struct `stats`, base_failed, rule (0: none) and kept; other columns pass through.

    Null and empty texts have no words and fail. Repeated rows are judged each alike. Columns of docs that are named
    like one of these are replaced.
    """
    rows = with_statistics(docs.drop(*{stats, "base_failed", "rule", "kept"} - {text_col}), text_col, stats)
    rows = rows.withColumn("base_failed", base_failed(stats)).withColumn("rule", decision(rules, stats))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are kept, all columns as they were."""
    rules = learn_rules(docs, labels, id_col, text_col)
    free = free_name(docs, "quality_statistics")
    rows = with_statistics(docs, text_col, free)
    return rows.filter(~base_failed(free) & (decision(rules, free) == 0)).drop(free)

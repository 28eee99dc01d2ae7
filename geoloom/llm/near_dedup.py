"""Near-duplicate classes by improved consistent weighted sampling.

Texts are weighted sets of shingles of five words. A shingle weighs its occurrences in the
text times its inverse document frequency; the latter is the sum of its words', counted over
all documents (a shingle's own frequency would make what large families of copies have in
common weigh less than what sets them apart). Consistent samples of the weighted sets are equal
with the probability of their weighted Jaccard similarity; BANDS bands of ROWS samples make
candidates.

Rows with equal shingle multisets are one node. Candidates are settled in two steps, each of which verifies
every pair that it finds by the weighted Jaccard similarity of the whole texts; classes are the
connected components of the verified links.

1. Each node of a bucket is set against the bucket's smallest node; then, in buckets that are not one class by that, the nodes outside
   the largest class against its lightest node (which of a family with additions is the nearest to all).
2. As two nodes may be alike and neither like the smallest, the nodes of all buckets that are not one
   class by then are joined exactly, however many there are and whatever buckets they are in:
   shingles are put in a global order, rarest first, and two nodes of different classes can only be alike if they
   share a shingle early in both orders (the prefix filter of similarity joins). What only nodes of one class have
   cannot link two classes, and what many have in common, such as a template, comes late in the order, so that
   nodes are not paired for it. So no cap on buckets or partners is needed: of two nodes with a common band, either the
   pair was verified, or ruled out by bounds on its similarity, or both are in one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, row_key, tidy
from .components import components
from .hashing import BASE, chunks, mix, ngrams, words

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: A pair at the least similarity shares a band with probability 1 - (1 - 0.8**5)**16 = 0.998.
BANDS, ROWS = 16, 5
#: Slack of bounds on sums of weights, as they are added up in different orders.
SLACK = 1e-6
#: Texts are signed in pieces of about so many bytes together, as sampling needs some dozen numbers for each word.
SIGNED_BYTES = 1 << 18
#: Words that fewer than one document in RARE has all weigh the same. Bounds what is broadcast: of a corpus whose
#: documents have m different words on average, at most RARE * m words are more frequent (12 bytes each).
RARE = 1024
#: Different words that a task holds before it hands their counts on.
HELD_WORDS = 1 << 19


def _raw(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in small pieces, so that few texts are held as Python objects at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


@dataclass
class Idf:
    """Inverse document frequencies ln(1 + N / df) by word hash, ascending; of words not listed: ln(1 + RARE)."""

    word: np.ndarray
    weight: np.ndarray

    def of(self, word: np.ndarray) -> np.ndarray:
        rare = np.float32(np.log1p(RARE))
        if not len(self.word):
            return np.full(len(word), rare)
        at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
        return np.where(self.word[at] == word, self.weight[at], rare)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> Idf:
    """Counted over all rows of docs. What is collected is bounded by RARE and the mean number of words of a document, not by the corpus."""

    def counts(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in _slices(batches):
            raw = _raw(batch.column(0).to_pylist())
            for a, b in chunks(raw):
                w = words(raw[a:b])
                order = np.lexsort((w.hash, w.own))
                new = np.r_[True, (w.hash[order][1:] != w.hash[order][:-1]) | (w.own[order][1:] != w.own[order][:-1])][: len(order)]
                held.append(w.hash[order][new])
                n += len(held[-1])
            if n >= HELD_WORDS * 4:
                yield told(*counts(held))
                held, n = [], 0
        yield told(*counts(held))

    def told(word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])

    texts = docs.select(docs[text_col].alias("text"))
    rows = texts.count()
    seen = texts.mapInArrow(tidy("near", run), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    frequent = seen.filter(F.col("n") * RARE > rows).toArrow()
    word, n = (frequent.column(k).combine_chunks().to_numpy() for k in ("word", "n"))
    order = np.argsort(word.view(np.uint64))
    return Idf(word.view(np.uint64)[order], np.log1p(rows / n[order]).astype(np.float32))


def weighted_shingles(raw: list[bytes], idf: Idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, weight), each shingle once per text, ascending by both."""
    w = words(raw)
    at, shingle = ngrams(w, SHINGLE_WORDS)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.float32)
    each = np.concatenate([idf.of(w.hash), np.zeros(SHINGLE_WORDS - 1, np.float32)])
    own = np.concatenate([w.own, np.full(SHINGLE_WORDS - 1, -1)])
    heavy = np.zeros(len(at), np.float32)
    for j in range(SHINGLE_WORDS):
        heavy += np.where(own[at + j] == w.own[at], each[at + j], np.float32(0))
    text = w.own[at]
    order = np.lexsort((shingle, text))
    text, shingle, heavy = text[order], shingle[order], heavy[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(text))).astype(np.float32)
    return text[first], shingle[first], heavy[first] * times


def samples(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n consistent samples (columns) for each text that has shingles (rows), as 64-bit numbers.

    For shingle s and sample k, r and c are Gamma(2, 1) and b uniform, all drawn from a hash of (s, k).
    With t = floor(ln w / r + b), the sample is the (s, t) with the least ln c - r (t - b) - r.
    """
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    lens = np.diff(np.append(first, len(text)))
    own = np.repeat(np.arange(len(first)), lens)
    log_w = np.log(weight)
    out = np.empty((len(first), n), np.uint64)
    low = np.uint64(0xFFFFF)
    scale = np.float32(2.0**-20)

    def uniform(x: np.ndarray, shift: int) -> np.ndarray:
        return (((x >> np.uint64(shift)) & low).astype(np.float32) + np.float32(0.5)) * scale

    for k in range(n):
        x = mix(shingle ^ np.uint64((k + 1) * BASE % (1 << 64)))
        y = x * np.uint64(0xA0761D6478BD642F)
        y ^= y >> np.uint64(32)
        r = -np.log(uniform(x, 0) * uniform(x, 22))
        c = -np.log(uniform(x, 44) * uniform(y, 0))
        b = uniform(y, 24)
        t = np.floor(log_w / r + b)
        value = np.log(c) - r * (t - b) - r
        least = np.minimum.reduceat(value, first)
        at = np.flatnonzero(value == least[own])  # of equal values the smallest shingle counts
        at = at[np.r_[True, own[at][1:] != own[at][:-1]]]
        out[:, k] = mix(shingle[at] + t[at].astype(np.int64).astype(np.uint64) * np.uint64(BASE))
    return out


def signatures(docs: DataFrame, rid: Column, idf: Idf, id_col: str, text_col: str) -> DataFrame:
    """rid, doc_id, n (shingles, repeats counted), f1, f2 (fingerprint of the shingle multiset), weight (of all shingles), bands."""
    sent = docs.sparkSession.sparkContext.broadcast(idf)
    source = docs.select(rid.alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("rid", "doc_id")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            raw = _raw(batch.column(2).to_pylist())
            for a, b in chunks(raw, SIGNED_BYTES):
                text, shingle, weight = weighted_shingles(raw[a:b], sent.value)
                n = b - a
                out = np.zeros((n, BANDS), np.uint64)
                sums = np.zeros((n, 2), np.uint64)
                count = np.zeros(n, np.int64)
                heavy = np.zeros(n)
                if len(text):
                    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                    has = text[first]
                    drawn = samples(text, shingle, weight, BANDS * ROWS)
                    for k in range(BANDS):
                        band = np.full(len(has), k, np.uint64)
                        for j in range(ROWS):
                            band = mix(band * np.uint64(BASE) + drawn[:, k * ROWS + j])
                        out[has, k] = band
                    bits = weight.view(np.uint32).astype(np.uint64)
                    for j, salt in enumerate((1, 2)):
                        sums[has, j] = np.add.reduceat(mix(mix(shingle + np.uint64(salt)) ^ bits), first)
                    count[has] = np.diff(np.append(first, len(text)))
                    heavy[has] = np.add.reduceat(weight.astype(np.float64), first)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(out.reshape(-1).view(np.int64)), BANDS).cast(pa.list_(pa.int64()))
                head = batch.slice(a, n)
                yield pa.RecordBatch.from_arrays(
                    [head.column(0), head.column(1), pa.array(count), *(pa.array(sums[:, j].view(np.int64)) for j in (0, 1)), pa.array(heavy), lists],
                    ["rid", "doc_id", "n", "f1", "f2", "weight", "bands"],
                )

    return source.mapInArrow(tidy("near", run), f"rid {kinds[0]}, doc_id {kinds[1]}, n bigint, f1 bigint, f2 bigint, weight double, bands array<bigint>")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(key, node, weight) for nodes (node, weight, bands): the buckets that several nodes share."""
    keys = materialize(nodes.select("node", "weight", F.explode("bands").alias("key")), "near-keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head")).filter("n > 1").select("key", "head")
    return materialize(keys.join(shared, "key"), "near-members")


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b), a < b: each node of a bucket with the smallest one."""
    return members.filter("head < node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, weight, label) of the buckets whose nodes are not in one class."""
    told = members.join(labels, "node", "left").select("key", "node", "weight", F.coalesce("label", "node").alias("label"))
    split = told.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most").select("key")
    return told.join(split, "key", "left_semi")


def lightest_pairs(opened: DataFrame) -> DataFrame:
    """(a, b), a < b: the nodes of each bucket outside its largest class with the lightest node of that class."""
    classes = opened.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("weight", "node")).alias("first"))
    largest = classes.groupBy("key").agg(F.max_by(F.struct(F.col("label").alias("of"), F.col("first.node").alias("x")), F.struct("n", "label")).alias("largest"))
    met = opened.join(materialize(largest.select("key", "largest.*"), "near-largest"), "key").filter(F.col("label") != F.col("of"))
    return met.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()


def _may_be_alike(x: Column, y: Column) -> Column:
    """Two sets of these weights have at most the lesser in common and at least the greater together."""
    return F.least(x, y) >= F.greatest(x, y) * (SIMILARITY - SLACK)


def shingle_rows(texts: DataFrame, idf: Idf) -> DataFrame:
    """(node, label, weight, shingle, w) for each shingle of texts (node, label, weight, text)."""
    sent = texts.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            raw = _raw(batch.column(3).to_pylist())
            for a, b in chunks(raw, SIGNED_BYTES):
                text, shingle, w = weighted_shingles(raw[a:b], sent.value)
                given = batch.slice(a, b - a).select([0, 1, 2]).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([*given.columns, pa.array(shingle.view(np.int64)), pa.array(w)], ["node", "label", "weight", "shingle", "w"])

    return texts.select("node", "label", "weight", "text").mapInArrow(tidy("near", run), "node bigint, label bigint, weight double, shingle bigint, w float")


def prefix_pairs(texts: DataFrame, idf: Idf) -> DataFrame:
    """(a, b), a < b: every pair of texts (node, label, weight, text) with different labels that may be alike.

    In common are only shingles that several labels have. In the order of their frequency, let `before` be the weight of what a
    node has before its first shingle in common with another; then they have at most weight - before in common,
    on either side. Similarity of at least t needs t / (1 + t) of both weights together, so that the lighter node has its first
    common shingle within the first 1 - 2t / (1 + t) of its weight, and the heavier one within the first 1 - t.
    """
    t = SIMILARITY - SLACK
    rows = materialize(shingle_rows(texts, idf), "near-shingles")
    seen = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("label").alias("least"), F.max("label").alias("most"))
    shared = rows.join(seen.filter("least < most").select("shingle", "df").hint("merge"), "shingle")  # both sides grow with the input
    mine = Window.partitionBy("node")
    first = mine.orderBy("df", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    w = F.col("w").cast("double")
    before = F.col("weight") - F.sum(w).over(mine) + F.coalesce(F.sum(w).over(first), F.lit(0.0))
    early = shared.withColumn("before", before).filter(F.col("before") <= F.col("weight") * (1 - t + SLACK))
    early = materialize(early.select("shingle", "node", "label", "weight", "before"), "near-prefixes")
    light = early.filter(F.col("before") <= F.col("weight") * (1 - 2 * t / (1 + t) + SLACK))
    side = lambda df, x: df.select("shingle", *(F.col(c).alias(f"{x}_{c}") for c in ("node", "label", "weight", "before")))
    met = side(light, "a").join(side(early, "b"), "shingle").filter(
        (F.col("a_label") != F.col("b_label"))
        & ((F.col("a_weight") < F.col("b_weight")) | ((F.col("a_weight") == F.col("b_weight")) & (F.col("a_node") < F.col("b_node"))))
        & _may_be_alike(F.col("a_weight"), F.col("b_weight"))
        & (F.least(F.col("a_weight") - F.col("a_before"), F.col("b_weight") - F.col("b_before")) >= (F.col("a_weight") + F.col("b_weight")) * (t / (1 + t) - SLACK))
    )
    return met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def links_of(nodes: DataFrame, docs: DataFrame, rid: Column, idf: Idf, text_col: str) -> DataFrame:
    """(node, label) of the components of all verified links among nodes (node, rid, weight, bands)."""
    members = bucket_members(nodes.select("node", "weight", "bands"))
    names = nodes.select("node", "rid", "weight").join(members.select("node").distinct(), "node", "left_semi")
    # names grow with the input and are found by key: always merged, never held by every executor
    texts = docs.select(rid.alias("rid"), F.col(text_col).alias("text")).join(names.hint("merge"), "rid").select("node", "weight", "text")
    texts = materialize(texts, "near-texts")
    weigh = lambda x: nodes.select(F.col("node").alias(x), F.col("weight").alias(f"{x}_weight"))

    def tried(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(pairs that may be alike, links among them)"""
        met = pairs.join(weigh("a"), "a").join(weigh("b"), "b").filter(_may_be_alike(F.col("a_weight"), F.col("b_weight")))
        met = materialize(met.select("a", "b"), "near-pairs")
        return met, materialize(verified(met, texts, idf), "near-links").select("a", "b")

    done, links = tried(star_pairs(members))
    labels = components(links)
    opened = materialize(open_members(members, labels), "near-open")
    met, more = tried(lightest_pairs(opened).join(done, ["a", "b"], "left_anti"))
    done = done.unionByName(met)
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)
        opened = open_members(members, labels)
    rest = materialize(opened.select("node", "label").distinct(), "near-rest")
    if rest.isEmpty():
        return labels
    _, more = tried(prefix_pairs(texts.join(rest, "node"), idf).join(done, ["a", "b"], "left_anti"))
    return labels if more.isEmpty() else components(links.unionByName(more))


def verified(pairs: DataFrame, texts: DataFrame, idf: Idf) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, text) are similar enough, with the similarity."""
    text = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"{x}_text"))
    two = pairs.select("a", "b").join(text("b"), "b").join(text("a"), "a").select("a", "b", "a_text", "b_text")
    sent = texts.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 128):
            left, right = _raw(batch.column(2).to_pylist()), _raw(batch.column(3).to_pylist())
            for a, b in chunks([x + y for x, y in zip(left, right, strict=True)]):
                n = b - a
                t, s, w = map(np.concatenate, zip(*(weighted_shingles(side[a:b], sent.value) for side in (left, right)), strict=True))
                order = np.lexsort((s, t))
                t, s, w = t[order], s[order], w[order].astype(np.float64)
                total = np.bincount(t, w, minlength=n)
                twin = (t[1:] == t[:-1]) & (s[1:] == s[:-1])
                common = np.bincount(t[1:][twin], np.minimum(w[1:], w[:-1])[twin], minlength=n)
                likeness = common / np.maximum(total - common, 1e-30)
                keep = np.flatnonzero(likeness >= SIMILARITY - 1e-9)
                head = batch.slice(a, n).take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([head.column(0), head.column(1), pa.array(likeness[keep])], ["a", "b", "similarity"])

    return two.mapInArrow(tidy("near", run), "a bigint, b bigint, similarity double")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, class_id, class_size, kept, rid.

    class_id is the smallest id of the class; of the class's rows exactly one is kept, that with
    class_id (of several, that with the least rid). Texts of fewer than five words are one shingle;
    texts without a word (null, empty, white space) are like no other and are classes of their own.
    Null ids come last, so that a class_id is null only where all its rows' are. Rows with
    equal texts are always in one class. rid tells rows apart: row_col, which must be the same in every
    job, or a key drawn here. Empty input: empty result. Other columns are not read.
    """
    docs, rid = (docs, F.col(row_col)) if row_col else row_key(docs)
    idf = document_frequencies(docs, text_col)
    signed = materialize(signatures(docs, rid, idf, id_col, text_col), "near-signatures")
    full = signed.filter("n > 0")
    nodes = full.groupBy("f1", "f2", "n").agg(F.min("rid").alias("rid"), F.first("weight").alias("weight"), F.first("bands").alias("bands"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    labels = links_of(nodes, docs, rid, idf, text_col)
    node_of = full.select("rid", "doc_id", "f1", "f2", "n").join(nodes.select("f1", "f2", "n", "node"), ["f1", "f2", "n"])
    classed = materialize(node_of.join(labels, "node", "left").select("rid", "doc_id", F.coalesce("label", "node").alias("label")), "near-classes")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("rid").alias("rid")))
    heads = materialize(classed.groupBy("label").agg(best.alias("head"), F.count(F.lit(1)).alias("class_size")), "near-heads")
    told = classed.join(heads, "label").select("doc_id", F.col("head.doc_id").alias("class_id"), "class_size", (F.col("rid") == F.col("head.rid")).alias("kept"), "rid")
    alone = signed.filter("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"), "rid")
    return told.unionByName(alone)

"""Stupid-backoff language model scores, relationally.

The model is the table of counts of all runs of 1 to ORDER words, partitioned by hash. Documents
meet it as in a join: groups of documents send each of their distinct runs once, with its
count, to the run's hash bucket; there the counts of all groups are added up, which is the
table; and every group gets the counts of its own runs back, in the order in which it sent them.
Runs and counts travel packed, sorted and compressed, one block per group and bucket, so that a
frequent run costs one entry per group however often it occurs.

A document is scored by what the other documents say: its own counts are taken off first.
A word's score is the relative frequency of the longest run ending in it that others have; each
shortening multiplies it by BACKOFF.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, plan_bytes, word_count
from .hashing import chunks, ngrams, words

ORDER = 3
BACKOFF = 0.4
#: Bits of a run's hash that identify it.
RUN_BITS = 56


class Runs:
    """All runs of 1 to order words of some texts."""

    def __init__(self, raw: list[bytes], order: int):
        self.n_texts, self.order = len(raw), order
        own, offset = [np.zeros(0, np.int64)], 0
        by_order: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(order)]
        ats: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(order)]
        for a, b in chunks(raw):
            w = words(raw[a:b])
            for n in range(1, order + 1):
                at, value = ngrams(w, n, short=False)
                by_order[n - 1].append((value >> np.uint64(64 - RUN_BITS)).astype(np.int64))
                ats[n - 1].append(at + offset)
            own.append(w.own + a)
            offset += len(w.own)
        self.own = np.concatenate(own)
        #: by order: the place of the run's first word, and the run
        self.at = [np.concatenate(x) for x in ats]
        self.run = [np.concatenate(x) for x in by_order]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate(self.run), return_counts=True)


def _pack(x: np.ndarray, width: int) -> bytes:
    planes = np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(x).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, width: int) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(blob[4:], n * width, codec="zstd"), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.int64)


RUN_WIDTH, COUNT_WIDTH = RUN_BITS // 8, 5


def _raw(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table.column("data").to_pylist()]


def log_scores(runs: Runs, totals: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By text: words, summed log scores, and words whose longest run others have too.

    totals: the counts of runs.distinct() over all documents; n_words: all their words.
    """
    known = runs.distinct()[0]
    size = np.bincount(runs.own, minlength=runs.n_texts)
    others: list[np.ndarray] = []  # by order: the run's count in other documents, at its first word
    for n in range(runs.order):
        place = np.searchsorted(known, runs.run[n])
        key = place * runs.n_texts + runs.own[runs.at[n]]
        _, back, mine = np.unique(key, return_inverse=True, return_counts=True)
        out = np.zeros(len(runs.own), np.int64)
        out[runs.at[n]] = totals[place] - mine[back]
        others.append(out)
    at = np.arange(len(runs.own))
    first = np.cumsum(size) - size
    depth = np.minimum(at - first[runs.own] + 1, runs.order)  # the longest run that can end here
    left = (n_words - size)[runs.own]
    score = np.full(len(at), -1.0)
    full = np.zeros(len(at), bool)
    for n in range(runs.order, 0, -1):
        on = np.flatnonzero((depth >= n) & (score < 0))
        count = others[n - 1][on - n + 1]
        on, count = on[count > 0], count[count > 0]
        below = others[n - 2][on - n + 1] if n > 1 else left[on]
        score[on] = count / below * BACKOFF ** (depth[on] - n)
        full[on] |= depth[on] == n
    unseen = score < 0
    score[unseen] = BACKOFF ** depth[unseen] / np.maximum(left[unseen], 1)
    return size, np.bincount(runs.own, np.log(score), minlength=runs.n_texts).astype(float), np.bincount(runs.own, full, minlength=runs.n_texts).astype(np.int64)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """One row per row of docs: doc_id, n_words, log_score (sum of natural logs), n_full (words whose longest run is known).

    Every row is a document of its own, also where ids or texts repeat. Null texts, and texts
    without a word, have n_words and log_score 0. A word that no other document has scores
    BACKOFF to the power of the orders tried over the number of the others' words. Empty input: empty result. Other columns
    are not read.
    """
    buckets = buckets_for(docs, 4 << 20, 64, 1 << RUN_BITS // 2)
    shift = RUN_BITS - buckets.bit_length() + 1
    groups = max(31, min(plan_bytes(docs), 1 << 50) // (5 << 20))
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), data.alias("data"), F.pmod(F.xxhash64(F.col(id_col), data), F.lit(groups)).cast("int").alias("key"))

    def send(table: pa.Table) -> pa.Table:
        known, count = Runs(_raw(table), order).distinct()
        bucket = known >> shift
        ids, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(known))[: len(ids)]
        blobs = [_pack(np.diff(known[a:b], prepend=0), RUN_WIDTH) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
        counts = [_pack(count[a:b], COUNT_WIDTH) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
        key = table.column("key")[0].as_py()
        return pa.table({"bucket": pa.array(ids, pa.int64()), "key": pa.array([key] * len(ids), pa.int32()), "runs": pa.array(blobs, pa.binary()), "counts": pa.array(counts, pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        parts = [np.cumsum(_unpack(b, RUN_WIDTH)) for b in table.column("runs").to_pylist()]
        run, count = np.concatenate(parts), np.concatenate([_unpack(b, COUNT_WIDTH) for b in table.column("counts").to_pylist()])
        _, back = np.unique(run, return_inverse=True)
        totals = np.bincount(back, count)[back].astype(np.int64)
        ends = np.cumsum([len(p) for p in parts])[:-1]
        blobs = [_pack(x, COUNT_WIDTH) for x in np.split(totals, ends)]
        return pa.table({"key": table.column("key"), "bucket": table.column("bucket"), "totals": pa.array(blobs, pa.binary())})

    sent = rows.groupBy("key").applyInArrow(send, "bucket bigint, key int, runs binary, counts binary")
    replies = sent.groupBy("bucket").applyInArrow(add, "key int, bucket bigint, totals binary")
    n_words = docs.agg(F.sum(word_count(F.col(text_col)))).first()[0] or 0

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        runs = Runs(_raw(left), order)
        order_ = np.argsort(right.column("bucket").to_numpy(), kind="stable") if right.num_rows else []
        blobs = right.column("totals").to_pylist() if right.num_rows else []
        totals = np.concatenate([np.zeros(0, np.int64), *(_unpack(blobs[k], COUNT_WIDTH) for k in order_)])
        size, total, full = log_scores(runs, totals, n_words)
        return pa.table({"doc_id": left.column("doc_id"), "n_words": pa.array(size, pa.int64()), "log_score": pa.array(total), "n_full": pa.array(full)})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("key").cogroup(replies.groupBy("key")).applyInArrow(score, f"doc_id {kind}, n_words bigint, log_score double, n_full bigint")

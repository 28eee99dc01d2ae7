"""Removal of long byte strings that an earlier document has too.

A byte goes if a window of WINDOW bytes covers it that also starts in a document with a
smaller id. Windows are found without pairing documents:

1. Every window is represented by the least hash of the SEED-byte strings in it. Equal windows
   have equal representatives, and neighbouring windows mostly have the same one, so that a
   document is a sequence of stretches: runs of windows with one representative. Stretches, not
   windows, are what is shuffled (about one for 18 bytes of text), packed into blocks for hash
   buckets. Within a block of input, only the smallest document's copies of a
   stretch are sent on; larger ones are known to be repeats already.
2. In a bucket, stretches equal to one of a smaller document are repeats as a whole. Where
   one representative has several different stretches, as at the ends of a shared passage,
   the bytes of their first occurrences are fetched. A window goes at least SIDE bytes beyond its
   representative on one side, so only stretches that agree there with another document's can
   share one; short hashes of these bytes leave out the rest.
3. There, the suffixes from the representative rightwards, and from it leftwards, are sorted by
   hash-compared merge sort, with the common extensions of neighbours verified by their bytes.
   Two windows are equal exactly if they lie alike around the representative and their right
   and left parts are in the same runs of the two sorted orders. A representative with very many
   stretches (a passage that a large share of all documents have) would fill one task: its
   windows are dealt one by one by their own hash, after each group of documents has kept
   those of its smallest document only, each different window once, with its places.
4. Repeats meet their documents again, by groups of documents, and are cut out there.

Stretches and dealt windows, whose bytes do not meet, are compared by a 128-bit hash without algebraic
structure, of which 96 bits and 32 bits of the representative's hash are kept; what suffix sorting
finds is compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, materialize, plan_bytes, tidy, worker_cache
from .hashing import blocks8, chunks, mix, spans128
from .suffix_sort import Suffixes

WINDOW = 50
SEED = 16
#: Records of so many bytes of text are packed together.
BLOCK_BYTES = 32 << 20
#: A representative with more different stretches than this in a bucket, or so many times as many windows in
#: them (as periodic text has), is hot: its windows are dealt one by one.
HOT_STRETCHES, HOT_WINDOWS = 1_000, 20
#: Half of what a window has besides its representative.
SIDE = (WINDOW - SEED) // 2
#: In place of a side's hash: the stretch does not go so far; its windows have different representatives.
NO_SIDE, ANY_SIDE = 0, 0xFFFF
#: Null ids count as larger than all others.
NO_ID = (1 << 63) - 1

#: Records are kept as columns; each is written byte plane by byte plane, which compresses well.
RECORD = (("seed", np.uint32), ("hash", np.uint64), ("more", np.uint32), ("id", np.int64), ("at", np.uint32), ("n", np.uint32), ("left", np.uint16), ("right", np.uint16))
REPEAT = (("hash", np.uint64), ("id", np.int64), ("at", np.uint32), ("n", np.uint32))
REQUEST = (("bucket", np.uint32), ("seed", np.uint32), ("hot", np.uint32), *REPEAT)
Columns = dict[str, np.ndarray]


def pack(columns: Columns, kinds: tuple, order: np.ndarray) -> bytes:
    planes = []
    for name, kind in kinds:
        x = columns[name][order].astype(kind)
        if name == "id":
            x = np.diff(x, prepend=np.int64(0))
        planes.append(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes())
    raw = b"".join(planes)
    return len(order).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blobs: list[bytes], kinds: tuple) -> Columns:
    found: dict[str, list[np.ndarray]] = {name: [np.zeros(0, kind)] for name, kind in kinds}
    width = sum(np.dtype(kind).itemsize for _, kind in kinds)
    for blob in blobs:
        n = int.from_bytes(blob[:4], "little")
        raw = np.frombuffer(pa.decompress(blob[4:], n * width, codec="zstd"), np.uint8)
        done = 0
        for name, kind in kinds:
            size = np.dtype(kind).itemsize
            x = np.ascontiguousarray(raw[done * n : (done + size) * n].reshape(size, n).T).reshape(-1).view(kind)
            done += size
            found[name].append(np.cumsum(x) if name == "id" else x)
    return {name: np.concatenate(parts) for name, parts in found.items()}


def packed_by(columns: Columns, kinds: tuple, key: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(key, blob) for each key; records keep their order within a blob."""
    order = np.argsort(key, kind="stable")
    keys, first = np.unique(key[order], return_index=True)
    for k, part in zip(keys.tolist(), np.split(order, first[1:]), strict=False):
        yield k, pack(columns, kinds, part)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (ids ^ (ids >> 17) ^ (ids >> 31)) % groups


def group_column(groups: int):
    x = F.col("id")
    return F.pmod(x.bitwiseXOR(F.shiftright(x, 17)).bitwiseXOR(F.shiftright(x, 31)), F.lit(groups).cast("long")).cast("int")


def seed_hashes(data: bytes) -> np.ndarray:
    """A hash of the SEED bytes from every place: two blocks of eight."""
    block = blocks8(data)
    return mix(mix(block[: max(len(data) - SEED + 1, 0)]) ^ block[8:]) if len(data) >= SEED else np.zeros(0, np.uint64)


def leftmost_least(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least of the WINDOW - SEED + 1 hashes from every place, how far the leftmost of that value is)."""
    span, have, x, at = WINDOW - SEED + 1, 1, seeds, np.zeros(len(seeds), np.int16)
    while have < span:
        step = min(have, span - have)
        left, right = x[:-step], x[step:]
        at = np.where(right < left, at[step:] + np.int16(step), at[:-step])
        x = np.minimum(left, right)
        have += step
    return x, at


def side_hashes(data: bytes, place: np.ndarray, there: np.ndarray) -> np.ndarray:
    """A 16-bit hash of the SIDE bytes from each place; NO_SIDE where they are not there."""
    block, out = blocks8(data), np.full(len(place), NO_SIDE, np.uint64)
    at, value = place[there], np.zeros(int(there.sum()), np.uint64)
    for step in sorted({*range(0, SIDE - 7, 8), SIDE - 8}):
        value = mix(value ^ block[at + step])
    out[there] = np.uint64(1) + value % np.uint64(ANY_SIDE - 1)
    return out


def stretches(texts: list[bytes], ids: np.ndarray) -> Columns:
    """All stretches of some documents' windows: seed (the least hash, mixed), hash and more (of the bytes), id, at, n (windows), left and right (sides)."""
    parts: list[Columns] = []
    for a, b in chunks(texts):
        data = b"".join(texts[a:b])
        ends = np.cumsum([len(t) for t in texts[a:b]])
        starts = ends - [len(t) for t in texts[a:b]]
        if len(data) < WINDOW:
            continue
        least, ahead = leftmost_least(seed_hashes(data))
        edge = np.zeros(len(data) + 2, np.int32)
        whole = ends - starts >= WINDOW
        np.add.at(edge, starts[whole], 1)
        np.add.at(edge, ends[whole] - WINDOW + 1, -1)
        valid = np.cumsum(edge)[: len(least)] > 0
        differs = np.r_[True, least[1:] != least[:-1]]
        first = np.flatnonzero(valid & (differs | ~np.r_[False, valid[:-1]]))
        last = np.flatnonzero(valid & np.r_[differs[1:] | ~valid[1:], True])
        # a document's first window may have the same representative as the last of the one before only
        # where WINDOW - 1 places that are not valid lie between them
        n = last - first + 1
        own = np.searchsorted(ends, first, "right")
        value, more = spans128(data, first, first + n + WINDOW - 1)
        place = first + ahead[first]
        left = side_hashes(data, place - SIDE, place - SIDE >= first)
        right = side_hashes(data, place + SEED, place + SEED + SIDE <= last + WINDOW)
        left[place != last + ahead[last]] = ANY_SIDE
        sides = {"left": left, "right": right}
        parts.append({"seed": mix(least[first]), "hash": value, "more": more >> np.uint64(32), "id": ids[a:b][own], "at": first - starts[own], "n": n, **sides})
    names = ("seed", "hash", "more", "id", "at", "n", "left", "right")
    kinds = (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return {k: np.concatenate([np.zeros(0, t), *(p[k] for p in parts)]) for k, t in zip(names, kinds, strict=True)}


def split_repeats(s: Columns) -> tuple[np.ndarray, np.ndarray]:
    """Places of (first occurrences: all in the smallest document that has the stretch; repeats)."""
    order = np.lexsort((s["id"], s["more"], s["hash"]))
    new = np.ones(len(order), bool)
    if len(order):
        x = [s[k][order] for k in ("seed", "hash", "more", "n")]
        new[1:] = np.logical_or.reduce([y[1:] != y[:-1] for y in x])
    kind = np.cumsum(new) - 1
    smallest = s["id"][order][np.flatnonzero(new)][kind] if len(order) else s["id"]
    again = s["id"][order] > smallest
    return np.sort(order[~again]), np.sort(order[again])


def may_share(s: Columns) -> np.ndarray:
    """Whether each stretch may share a window with one of another document: both have a side in common with one representative."""

    def several_ids(*key: np.ndarray) -> np.ndarray:
        order = np.lexsort(key)
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in key])
        start, ids = np.flatnonzero(new), s["id"][order]
        out = np.empty(len(order), bool)
        out[order] = (np.maximum.reduceat(ids, start) != np.minimum.reduceat(ids, start))[np.cumsum(new) - 1]
        return out

    if not len(s["id"]):
        return np.zeros(0, bool)
    out = np.isin(s["seed"], s["seed"][s["left"] == ANY_SIDE]) & several_ids(s["seed"])
    for side in ("left", "right"):
        out |= several_ids(s[side], s["seed"]) & (s[side] != NO_SIDE)
    return out


def resolve(texts: list[bytes], ids: np.ndarray, ats: np.ndarray, groups: np.ndarray) -> Columns:
    """Repeated windows among stretches, given by their bytes, ids and places; groups: equal for equal representatives.

    Returns the repeats: hash, id, at, n, and the row of each among the texts.
    """
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size) - size
    seeds = seed_hashes(joined)
    # windows of all stretches
    per = size - WINDOW + 1
    stretch = np.repeat(np.arange(len(texts)), per)
    offset = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    # the leftmost place of the representative in each window
    begin = start[stretch] + offset
    anchor = leftmost_least(seeds)[1][begin]
    place = begin + anchor
    items, item = np.unique(place, return_inverse=True)  # representatives, by place in data
    first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else item
    of = stretch[first]
    # representatives of one group and one hash are set against each other
    by = np.lexsort((seeds[items], groups[of]))
    same = np.r_[False, (seeds[items][by][1:] == seeds[items][by][:-1]) & (groups[of][by][1:] == groups[of][by][:-1])]
    group = np.cumsum(~same) - 1
    items_sorted, of_sorted = items[by], of[by]
    right_size = np.minimum(start[of_sorted] + size[of_sorted] - items_sorted, WINDOW)
    left_size = np.minimum(items_sorted - start[of_sorted], WINDOW - SEED)
    right_order, right_lcp = Suffixes(data, items_sorted, right_size).sort(group)
    left_order, left_lcp = Suffixes(data[::-1].copy(), len(data) - items_sorted, left_size).sort(group)
    # for each window: its run in the right order at length WINDOW - anchor, and in the left order at length anchor
    back = np.empty(len(by), np.int64)
    back[by] = np.arange(len(by))
    mine = back[item]
    right_place, left_place = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
    right_place[right_order], left_place[left_order] = np.arange(len(by)), np.arange(len(by))
    right_run, left_run = np.zeros(len(offset), np.int64), np.zeros(len(offset), np.int64)
    by_anchor = np.argsort(anchor, kind="stable")
    edges = np.searchsorted(anchor[by_anchor], np.arange(WINDOW - SEED + 2))
    for j, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            on = by_anchor[a:b]
            right_run[on] = np.cumsum(right_lcp < WINDOW - j)[right_place[mine[on]]]
            left_run[on] = np.cumsum(left_lcp < j)[left_place[mine[on]]]
    order = np.lexsort((ids[stretch], left_run, right_run, anchor))
    keys = np.stack([anchor[order], right_run[order], left_run[order]])
    new = np.ones(len(order), bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
    smallest = ids[stretch][order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else ids
    repeated = np.zeros(len(order), bool)
    repeated[order] = ids[stretch][order] > smallest
    begin = np.flatnonzero(repeated & ~np.r_[False, repeated[:-1] & (stretch[1:] == stretch[:-1])])
    end = np.flatnonzero(repeated & ~np.r_[repeated[1:] & (stretch[1:] == stretch[:-1]), False])
    n = end - begin + 1
    at = start[stretch[begin]] + offset[begin]
    return {
        "hash": spans128(joined, at, at + n + WINDOW - 1)[0],
        "id": ids[stretch[begin]],
        "at": ats[stretch[begin]] + offset[begin],
        "n": n,
        "row": stretch[begin],
    }


def _batch(kinds: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.table({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), columns, strict=True)})


_PACKED = {"kind": pa.int32(), "key": pa.int32(), "blob": pa.binary()}
_PACKED_SQL = "kind int, key int, blob binary"
STRETCH, CUT, ASK = 0, 1, 2


def _stretch_blocks(rows: DataFrame, buckets: int, groups: int) -> DataFrame:
    """Packed stretches by bucket, and repeats known from one block of input by document group."""

    def flush(texts: list[bytes], ids: list[int]) -> pa.Table:
        s = stretches(texts, np.array(ids, np.int64))
        first, again = split_repeats(s)
        bucket = (s["seed"] >> np.uint64(32)).astype(np.int64) % buckets
        s["seed"] &= np.uint64(0xFFFFFFFF)
        kept, cut = ({k: x[at] for k, x in s.items()} for at in (first, again))
        out = [(STRETCH, k, b) for k, b in packed_by(kept, RECORD, bucket[first])]
        out += [(CUT, k, b) for k, b in packed_by(cut, REPEAT, group_of(cut["id"], groups))]
        return _batch(_PACKED, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        ids: list[int] = []
        held = 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.append(t or b"")
                ids.append(i)
                held += len(texts[-1])
                if held >= BLOCK_BYTES:
                    yield from flush(texts, ids).to_batches()
                    texts, ids, held = [], [], 0
        if texts:
            yield from flush(texts, ids).to_batches()

    return rows.select("id", "data").mapInArrow(tidy("repeats", run), _PACKED_SQL)


def _compare(blocks: DataFrame, groups: int, hot_stretches: int) -> DataFrame:
    """Repeats, those found before included, and requests for bytes where stretches with one representative differ, by document group."""

    def run(table: pa.Table) -> pa.Table:
        worker_cache("repeats")
        if table.column("kind")[0].as_py() == CUT:  # known already
            return table.select(list(_PACKED))
        s = unpack(table.column("blob").to_pylist(), RECORD)
        bucket = table.column("key")[0].as_py()
        first, again = split_repeats(s)
        cut = {k: s[k][again] for k, _ in REPEAT}
        out = [(CUT, k, b) for k, b in packed_by(cut, REPEAT, group_of(cut["id"], groups))]
        # representatives with different first occurrences in different documents
        asked = first[may_share({k: x[first] for k, x in s.items()})]
        asked = asked[np.argsort(s["seed"][asked], kind="stable")]
        if len(asked):
            run_ = np.unique(s["seed"][asked], return_inverse=True)[1]
            hot = ((np.bincount(run_) > hot_stretches) | (np.bincount(run_, s["n"][asked]) > hot_stretches * HOT_WINDOWS))[run_]
            wanted = {k: s[k][asked] for k, _ in RECORD} | {"bucket": np.full(len(asked), bucket, np.uint32), "hot": hot}
            out += [(ASK, k, b) for k, b in packed_by(wanted, REQUEST, group_of(wanted["id"], groups))]
        return _batch(_PACKED, out)

    return blocks.groupBy("kind", "key").applyInArrow(run, _PACKED_SQL)


class _Group:
    """Some documents' bytes together, sorted by id."""

    def __init__(self, table: pa.Table):
        ids = table.column("id").to_numpy()
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        raw = table.column("data").to_pylist()
        self.texts = [raw[k] or b"" for k in self.order.tolist()]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.joined = b"".join(self.texts)
        self.data = np.frombuffer(self.joined, np.uint8)

    def places(self, s: Columns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(record, document, place in data). Where several rows have a record's id, those with the bytes that its hash says."""
        low, high = np.searchsorted(self.ids, s["id"], "left"), np.searchsorted(self.ids, s["id"], "right")
        record = np.repeat(np.arange(len(low)), high - low)
        doc = np.arange(len(record)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[record]
        at, n = s["at"].astype(np.int64)[record], s["n"].astype(np.int64)[record]
        inside = at + n + WINDOW - 1 <= self.size[doc]
        record, doc, at, n = record[inside], doc[inside], at[inside], n[inside]
        at += self.start[doc]
        right = np.ones(len(record), bool)
        several = np.flatnonzero((high - low)[record] > 1)
        right[several] = spans128(self.joined, at[several], (at + n + WINDOW - 1)[several])[0] == s["hash"][record[several]]
        return record[right], doc[right], at[right]


_FETCHED = {"bucket": pa.int64(), "seed": pa.int64(), "id": pa.int64(), "at": pa.int64(), "bytes": pa.binary(), "places": pa.binary()}
_FETCHED_SQL = "bucket bigint, seed bigint, id bigint, at bigint, bytes binary, places binary"
#: In place of `at`: the row's bytes are packed repeats of the document group in `seed`.
PACKED = -1


def _fetch(docs: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """The bytes of requested stretches, by bucket; of hot ones the bytes of windows, by a bucket of their own hash."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        worker_cache("repeats")
        if not right.num_rows or not left.num_rows:
            return _batch(_FETCHED, [])
        g, s = _Group(left), unpack(right.column("blob").to_pylist(), REQUEST)
        record, _, at = g.places(s)
        bucket, seed, ids = (s[k][record].astype(np.int64) for k in ("bucket", "seed", "id"))
        own_at, n, hot = s["at"][record].astype(np.int64), s["n"][record].astype(np.int64), s["hot"][record] > 0
        # windows of hot stretches
        each = np.repeat(np.flatnonzero(hot), n[hot])
        offset = np.arange(len(each)) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
        start = at[each] + offset
        value, more = spans128(g.joined, start, start + WINDOW)
        order = np.lexsort((ids[each], more, value))
        new = np.ones(len(order), bool)
        new[1:] = (value[order][1:] != value[order][:-1]) | (more[order][1:] != more[order][:-1])
        again = np.zeros(len(order), bool)
        if len(order):
            again[order] = ids[each][order] > ids[each][order][np.flatnonzero(new)][np.cumsum(new) - 1]
        cut = {"hash": value[again], "id": ids[each][again], "at": (own_at[each] + offset)[again], "n": np.ones(int(again.sum()), np.int64)}
        key = right.column("key")[0].as_py()
        rows = [(key % buckets, key, 0, PACKED, pack(cut, REPEAT, np.arange(len(cut["id"]))), None)] if again.any() else []
        told = _batch(_FETCHED, rows)
        # of equal windows, which are one document's now, one goes on, with the places of the others (periodic text has very many)
        order, new = order[~again[order]], new[~again[order]]
        place = (own_at[each] + offset)[order]
        heads = np.flatnonzero(new)
        others = [x[1:].tobytes() for x in np.split(place, heads[1:])] if len(heads) else []
        only = order[heads]
        each, offset, start, value = each[only], offset[only], start[only], value[only]
        cold = np.flatnonzero(~hot)
        first, last = np.concatenate([at[cold], start]), np.concatenate([at[cold] + n[cold] + WINDOW - 1, start + WINDOW])
        data = g.data
        found = [data[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        columns = (
            np.concatenate([bucket[cold], (value % np.uint64(buckets)).astype(np.int64)]),
            np.concatenate([seed[cold], seed[each]]),
            np.concatenate([ids[cold], ids[each]]),
            np.concatenate([own_at[cold], own_at[each] + offset]),
            found,
            [None] * len(cold) + others,
        )
        return pa.concat_tables([told, pa.table({k: pa.array(c, t) for (k, t), c in zip(_FETCHED.items(), columns, strict=True)})])

    return docs.groupBy("key").cogroup(asked.groupBy("key")).applyInArrow(run, _FETCHED_SQL)


def _resolved(fetched: DataFrame, groups: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        worker_cache("repeats")
        packed = table.column("at").to_numpy() == PACKED
        ready, table = table.filter(pa.array(packed)), table.filter(pa.array(~packed))
        out = [(CUT, k, b) for k, b in zip(ready.column("seed").to_pylist(), ready.column("bytes").to_pylist(), strict=True)]
        if table.num_rows:
            found = resolve(table.column("bytes").to_pylist(), table.column("id").to_numpy(), table.column("at").to_numpy(), table.column("seed").to_numpy())
            row = found.pop("row")
            others = [np.frombuffer(x or b"", np.int64) for x in table.column("places").take(pa.array(row)).to_pylist()]
            again = np.repeat(np.arange(len(row)), [len(x) for x in others])
            more = {k: x[again] for k, x in found.items()} | {"at": np.concatenate([np.zeros(0, np.int64), *others])}
            found = {k: np.concatenate([x, more[k]]) for k, x in found.items()}
            out += [(CUT, k, b) for k, b in packed_by(found, REPEAT, group_of(found["id"], groups))]
        return _batch(_PACKED, out)

    return fetched.groupBy("bucket").applyInArrow(run, _PACKED_SQL)


def _cut(docs: DataFrame, repeats: DataFrame, with_kept: bool) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        worker_cache("repeats")
        g = _Group(left)
        removed = np.zeros(len(g.data), bool)
        if right.num_rows:
            s = unpack(right.column("blob").to_pylist(), REPEAT)
            record, _, at = g.places(s)
            edge = np.zeros(len(g.data) + 1, np.int32)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + s["n"].astype(np.int64)[record] + WINDOW - 1, -1)
            removed = np.cumsum(edge[:-1]) > 0
        rows = []
        for k, (a, n) in enumerate(zip(g.start.tolist(), g.size.tolist(), strict=True)):
            gone = removed[a : a + n]
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
            count = int(gone.sum())
            kept = g.data[a : a + n][~gone].tobytes() if count else g.texts[k]
            rows.append((n, count, spans, hashlib.sha256(kept).hexdigest(), *([kept] if with_kept else [])))
        kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()} | ({"kept": pa.binary()} if with_kept else {})
        return pa.table({"doc_id": left.column("doc_id").take(pa.array(g.order)), **{c: t.combine_chunks() for c, t in zip(kinds, _batch(kinds, rows).columns, strict=True)}})

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_kept else "")
    return docs.groupBy("key").cogroup(repeats.groupBy("key")).applyInArrow(run, out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False, hot_stretches: int = HOT_STRETCHES) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (binary) if asked for.

    Ids are whole numbers. Null texts are empty. Null ids count as larger than all others.
    Rows with equal ids do not remove bytes from each other. Texts shorter than WINDOW bytes
    lose nothing. Empty input: empty result. Other columns are not read.
    """
    size = plan_bytes(docs)
    buckets = buckets_for(docs, 1 << 20, 64)
    groups = max(61, min(size, 1 << 50) // (2 << 20)) | 1
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), data.alias("data"))
    keyed = rows.withColumn("key", group_column(groups))
    compared = materialize(_compare(_stretch_blocks(rows, buckets, groups), groups, hot_stretches), "compared")
    fetched = _fetch(keyed, compared.filter(F.col("kind") == ASK), buckets)
    cuts = [x.filter(F.col("kind") == CUT).select("key", "blob") for x in (compared, _resolved(fetched, groups))]
    return _cut(keyed, cuts[0].unionByName(cuts[1]), with_kept)

"""Alignment of two tokenizers' tokens: groups of tokens that cover the same bytes, and links between tokens that overlap.

Each text is aligned once, where it is read, and leaves its groups and how many links it has of each pair of ids in the shared
folder. Spark adds the links up by pair and compares a B id's pairs. The most frequent pairs, of which there are a
bounded number, are then known to every worker, which scores rows where they are read; where there are more
pairs, the links of the others are joined by pair and added up by row. No text travels, and no pair, text or token is hot.

A worker aligns stretches of texts, many in one step. A stretch begins at a space that follows a letter, number,
sign or punctuation mark; neither tokenizer ever makes a token across such a place (the pattern of A splits there,
and B has no piece with its space mark inside, which is checked), so that a text's tokens are those of its
stretches. What a worker found for a stretch it keeps for the next text, for a bounded number of stretches.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import Decoder
from .common import materialize, row_key, tidy, worker_cache

#: Fixed value: how B's pieces write a space.
SPACE_MARK = "▁"
#: Bits of an id in a pair.
ID_BITS = 18
#: Bytes of text that are worked on at a time, unless it is one text; a block's new stretches come on top of those that are kept.
BLOCK_BYTES = 1 << 19
#: The most frequent pairs, so many at most, are known to every worker.
HOT_PAIRS = 1 << 19
#: Stretches that a worker keeps, and their characters; with more it keeps the frequent ones.
HOT_STRETCHES = 1 << 17
HOT_CHARS = 1 << 23
#: Stretches whose sizes have more binary digits are not kept.
SMALL_DIGITS = 14
#: Stretches encoded as one text.
JOINT = 2048

SUMS = ("n_a", "n_b", "n_groups", "n_links")


class _Safe(dict):
    """Whether a stretch may end with this character; kept by character."""

    def __missing__(self, sign: str) -> bool:
        self[sign] = found = bool(sign) and unicodedata.category(sign)[0] in "LNPS"
        return found


_SAFE = _Safe()


def cut(text: str) -> list[str]:
    """The stretches of a text, with the space that goes before it."""
    words = text.split(" ")
    if all(map(_SAFE.__getitem__, {w[-1:] for w in words[:-1]})):
        return [f" {w}" for w in words]
    out, held = [], []
    for w in words:
        if held and _SAFE[held[-1][-1:]]:
            out.append(" " + " ".join(held))
            held = []
        held.append(w)
    return [*out, " " + " ".join(held)]


class Tokenizers:
    """Both tokenizers, one of each in a Python worker."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError("a piece of B holds a space after other characters; texts can't be cut at spaces")
        told = {c: b for b, c in byte_signs().items()}
        self.a_bytes = Decoder({i: bytes(map(told.__getitem__, s)) for s, i in self.a.get_vocab().items()})
        self.b_bytes = Decoder({i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)})
        if any(len(d.size) > 1 << ID_BITS for d in (self.a_bytes, self.b_bytes)):
            raise ValueError("a vocabulary is too large for packed pairs")
        self.lead = len(self.b.encode("a"))
        #: Ids as groups tell them: A's within and at the end of a group, then B's.
        self.signs = [f"{i}{sep}" for d, seps in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for sep in seps for i in range(len(d.size))]

    def encode(self, stretches: list[str]) -> list[tuple[list[str], list | None]]:
        """All stretches, in another order: some of them, and for either tokenizer their ids and how many each has; None for one whose tokens do not stand for its bytes.

        Stretches after which a text may go on in any case are encoded as one text.
        """
        alone = [s for s in stretches if SPACE_MARK in s or not _SAFE[s[-1:]]]
        joint = [s for s in stretches if SPACE_MARK not in s and _SAFE[s[-1:]]]
        return [x for first in range(0, len(joint), JOINT) for x in self._encode(joint[first : first + JOINT])] + [x for s in alone for x in self._encode([s])]

    def _encode(self, some: list[str]) -> list[tuple[list[str], list | None]]:
        text = "".join(some)
        data, ends = text.encode(), np.cumsum([len(s.encode()) for s in some])
        # B drops a leading space of its own where nothing else is left; after a letter it never does.
        found = (self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(f"a{text}", num_threads=1)[self.lead :])
        sides = []
        for decoder, told in zip((self.a_bytes, self.b_bytes), found, strict=True):
            ids = np.array(told, np.int64)
            upto = np.cumsum(decoder.size[ids])
            at = np.searchsorted(upto, ends)
            if decoder.decode(ids, np.array([0, len(ids)]))[0] != data or (upto[at] != ends).any():
                half = len(some) // 2
                return self._encode(some[:half]) + self._encode(some[half:]) if half else [(some, None)]
            sides.append((ids, np.diff(at + 1, prepend=0)))
        return [(some, sides)]


def byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies write for each byte: its own if it is visible in Latin-1, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class Alignments:
    """What a Python worker knows of stretches, by their places: groups, sums, links and whether their tokens stand for their bytes."""

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        self.clear()

    @staticmethod
    def of(a_path: str, b_path: str) -> Alignments:
        """This Python worker's."""
        kept = worker_cache("alignment")
        if (a_path, b_path) not in kept:
            kept[a_path, b_path] = Alignments(Tokenizers(a_path, b_path))
        return kept[a_path, b_path]

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.chars = 0
        self.fits = np.zeros(0, bool)
        self.hits = np.zeros(0, np.int64)
        self.sums = np.zeros((0, 4), np.int64)  # SUMS
        self.links = np.zeros(0, np.int64)  # pairs of ids, stretch after stretch
        self.ends = np.zeros(0, np.int64)  # where each stretch's links end

    def places(self, texts: list[str | None], most: int, small: int) -> list[list[int]]:
        """The places of each text's stretches, which hold until the next call; most: how many stretches are kept, of how many characters at most."""
        if len(self.place) > most or self.chars > HOT_CHARS:
            self._forget(most // 2, small)
        cuts, place = [cut(t) if t else [] for t in texts], self.place
        if new := list(dict.fromkeys([s for c in cuts for s in c if s not in place])):
            self._add(self.t.encode(new))
        found = [list(map(place.__getitem__, c)) for c in cuts]
        self.hits += np.bincount(np.fromiter(chain.from_iterable(found), np.int64), minlength=len(self.hits))
        return found

    def _forget(self, most: int, small: int) -> None:
        """Keeps stretches that came more than once, most of them at most; what came long ago counts for less."""
        names, groups, hits = list(self.place), self.groups, self.hits
        hits[[k for k, name in enumerate(names) if len(name) > small]] = 0
        stay, least = np.flatnonzero(hits > 1), 2
        while len(stay) > most or (stay_chars := sum(len(names[k]) for k in stay.tolist())) > HOT_CHARS // 2:
            least *= 2
            stay = np.flatnonzero(hits >= least)
        self.links, self.fits, self.sums, self.hits = self.links_of(stay)[0], self.fits[stay], self.sums[stay], hits[stay] // 2
        self.place, self.groups, self.chars = {names[k]: n for n, k in enumerate(stay.tolist())}, [groups[k] for k in stay.tolist()], stay_chars
        self.ends = np.cumsum(self.sums[:, 3])

    def _add(self, encoded: list[tuple[list[str], list | None]]) -> None:
        fits, sums, links = [self.fits], [self.sums], [self.links]
        for some, sides in encoded:
            self.place.update(zip(some, range(len(self.place), len(self.place) + len(some)), strict=True))
            self.chars += sum(map(len, some))
            fits.append(np.full(len(some), sides is not None))
            if sides is None:
                sums.append(np.zeros((1, 4), np.int64))
                self.groups.append("")
            else:
                told = self._align(*sides)
                self.groups += told[0]
                sums.append(told[1])
                links.append(told[2])
        self.fits, self.sums, self.links = map(np.concatenate, (fits, sums, links))
        self.hits = np.concatenate([self.hits, np.zeros(len(self.fits) - len(self.hits), np.int64)])
        self.ends = np.cumsum(self.sums[:, 3])

    def _align(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Groups, sums and links of stretches in a row, from the ids of either side and how many each stretch has.

        Each range between two borders is one link, of the tokens that cover it; borders of both sides end groups.
        """
        ends = [np.cumsum(d.size[ids]) for d, (ids, _) in zip((self.t.a_bytes, self.t.b_bytes), (a, b), strict=True)]
        both = np.sort(np.concatenate(ends), kind="stable")
        again = np.diff(both, prepend=-1) == 0
        borders, common = both[~again], both[again]
        links = a[0][np.searchsorted(ends[0], borders)] << ID_BITS | b[0][np.searchsorted(ends[1], borders)]
        stops = ends[0][np.cumsum(a[1]) - 1]
        n_groups, n_links = (np.diff(np.searchsorted(x, stops, "right"), prepend=0) for x in (common, borders))
        group = [np.searchsorted(common, e) for e in ends]
        last = [common[g] == e for g, e in zip(group, ends, strict=True)]
        size_a, size_b = len(self.t.a_bytes.size), len(self.t.b_bytes.size)
        signs = np.concatenate([a[0] + size_a * last[0], 2 * size_a + b[0] + size_b * last[1]])
        signs = signs[np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")]
        told, upto = [self.t.signs[k] for k in signs.tolist()], np.cumsum(a[1] + b[1]).tolist()
        return ["".join(told[i:j])[:-1] for i, j in zip([0, *upto], upto, strict=False)], np.stack([a[1], b[1], n_groups, n_links], axis=1), links

    def links_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of some stretches, one stretch's after another's, and how many each has."""
        n = self.sums[places, 3]
        return self.links[np.arange(n.sum()) + np.repeat(self.ends[places] - np.cumsum(n), n)], n


def slices(texts: Iterable[pa.StringScalar], most: int) -> Iterator[list[str | None]]:
    """Texts in order, some at a time, most bytes at most unless it is one text."""
    part, size = [], 0
    for text in texts:
        more = len(text.as_buffer() or b"")
        if part and size + more > most:
            yield part
            part, size = [], 0
        part.append(text.as_py())
        size += more
    if part:
        yield part


def aligned(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """texts (doc_id, text) as doc_id, SUMS, groups, pairs and links (arrays: pairs of ids, and how many links have them).

    A text without tokens, or that holds a stretch whose tokens do not stand for its bytes, has zeros and no groups or pairs.
    """
    kind, block, most, small = texts.schema["doc_id"].dataType.simpleString(), BLOCK_BYTES, HOT_STRETCHES, 1 << SMALL_DIGITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Alignments.of(a_path, b_path)
        for batch in batches:
            first = 0
            for part in slices(batch.column(1), block):
                sums, groups, cuts = np.zeros((len(part), len(SUMS)), np.int64), [], [0]
                pairs, links = [], []
                for k, at in enumerate(known.places(part, most, small)):
                    if at and known.fits[at].all():
                        sums[k] = known.sums[at].sum(axis=0)
                        groups.append(";".join([known.groups[p] for p in at]))
                        told = np.sort(known.links_of(np.array(at))[0])
                        starts = np.flatnonzero(np.diff(told, prepend=-1))
                        pairs.append(told[starts])
                        links.append(np.diff(starts, append=len(told)).astype(np.int32))
                    else:
                        groups.append("")
                    cuts.append(cuts[-1] + (len(pairs[-1]) if groups[-1] else 0))
                lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([np.zeros(0, t), *x]))) for t, x in ((np.int64, pairs), (np.int32, links))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), *(pa.array(c) for c in sums.T.copy()), pa.array(groups, pa.string()), *lists], ["doc_id", *SUMS, "groups", "pairs", "links"])
                first += len(part)

    sums = ", ".join(f"{c} bigint" for c in SUMS)
    return texts.mapInArrow(tidy("alignment", run), f"doc_id {kind}, {sums}, groups string, pairs array<bigint>, links array<int>")


def exploded(rows: DataFrame, *keys: Column) -> DataFrame:
    """(keys, pair, n): a row for each pair of a row of aligned()."""
    return rows.select(*keys, F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(*keys, "x.pairs", "x.links").withColumnsRenamed({"pairs": "pair", "links": "n"})


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): how many links have both ids, and whether no other pair of the same B id has more."""
    pairs = exploded(rows).groupBy("pair").agg(F.sum("n").alias("n"))
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND((1 << ID_BITS) - 1))))


def scored(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """rows of aligned() with n_best and count_sum, as far as hot pairs (pair, n, best) make them up; there are HOT_PAIRS of these at most."""
    sent = rows.sparkSession.sparkContext.broadcast({"name": uuid.uuid4().hex, "table": hot.orderBy("pair").toArrow()})

    def told() -> tuple[np.ndarray, np.ndarray]:
        kept = worker_cache("alignment scores")
        if sent.value["name"] not in kept:
            kept.clear()
            table = sent.value["table"]
            kept[sent.value["name"]] = table.column("pair").to_numpy(), np.stack([table.column("best").to_numpy().astype(np.int64), table.column("n").to_numpy()], axis=1)
        return kept[sent.value["name"]]

    @F.arrow_udf("n_best bigint, count_sum bigint")
    def score(pairs: pa.Array, links: pa.Array) -> pa.Array:
        known, what = told()
        ids, n = pairs.flatten().to_numpy(), links.flatten().to_numpy()
        at = np.searchsorted(known, ids)
        found = at < len(known)
        found[found] = known[at[found]] == ids[found]
        sums = np.zeros((len(ids) + 1, 2), np.int64)
        sums[1:][found] = what[at[found]] * n[found, None]
        sums = np.cumsum(sums, axis=0)
        ends = np.cumsum(pairs.value_lengths().to_numpy())
        made = sums[ends] - sums[np.concatenate([np.zeros(1, np.int64), ends[:-1]])[: len(ends)]]
        return pa.StructArray.from_arrays([pa.array(made[:, 0].copy()), pa.array(made[:, 1].copy())], ["n_best", "count_sum"])

    return rows.withColumn("score", score("pairs", "links")).select("*", "score.n_best", "score.count_sum").drop("score")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    a_path: a file of the tokenizers library with a byte-level vocabulary, which gets a space and the text; b_path: a
    sentencepiece model that normalizes nothing and adds the space itself. groups: `a1,a2|b1;a3|b2,b3`, ids in
    order. A link's count is how many links in all of docs have the same two ids; n_best: links whose count is the
    highest of their B id, count_sum: the sum of the counts. Null and empty texts, and those whose tokens do not stand for
    their bytes (as where a text holds B's space mark), have zeros and an empty string, and add nothing to
    counts. Repeated rows count each.
    """
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows = materialize(aligned(texts, a_path, b_path), "aligned", "zstd")
    pairs = materialize(pair_counts(rows), "pairs")
    out = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    if pairs.count() <= HOT_PAIRS:
        return scored(rows, pairs).select(*out)
    hot = materialize(pairs.orderBy(F.desc("n"), "pair").limit(HOT_PAIRS), "hot-pairs")
    rows, key = row_key(rows)
    rest = exploded(rows, key.alias("key")).join(F.broadcast(hot.select("pair")), "pair", "left_anti").withColumnRenamed("n", "links").join(pairs.hint("merge"), "pair")
    rest = rest.groupBy("key").agg(F.sum(F.col("best").cast("int") * F.col("links")).alias("rare_best"), F.sum(F.col("n") * F.col("links")).alias("rare_sum"))
    both = scored(rows.withColumn("key", key), hot).join(rest.hint("merge"), "key", "left")
    return both.withColumns({k: F.col(k) + F.coalesce(more, F.lit(0)) for k, more in (("n_best", "rare_best"), ("count_sum", "rare_sum"))}).select(*out)

"""Byte-level BPE encoding and decoding against a public rank file.

A piece of text is encoded in linear time, without merging: the bytes, mapped to Latin-1,
run through an Aho-Corasick automaton of the vocabulary, which gives the longest token at
every start. From left to right the longest token is taken if it may follow the one before
it; if not, the next shorter one; if none fits, the one before is given back. Two tokens
may stand side by side exactly if BPE would turn their joined bytes into these two tokens;
that is found by undoing merges and kept in a memo. An encoding in which every adjacent pair
may stand side by side is the one that the merges make.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import tidy, worker_cache

#: A piece's encoding is kept for the next time, up to so many pieces; then the memo starts anew.
PIECE_MEMO = 250_000
PAIR_MEMO = 200_000
#: A token's size and rank are packed into one number.
RANK_BITS = 32
RANK_MASK = (1 << RANK_BITS) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Reads lines of `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


class Vocabulary:
    """Ranks, the two parts that each token is merged from, and its longest shorter prefix."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        #: rank -> (left rank, right rank); single bytes have none. Tokens that merges never make are left out.
        self.parts: dict[int, tuple[int, int] | None] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.parts[rank] = None
            elif (parts := self._last_merge(token)) is not None:
                self.parts[rank] = parts
        self.shorter: dict[int, int] = {}
        for rank in self.parts:
            token = self.bytes_of[rank]
            for n in range(len(token) - 1, 0, -1):
                if (r := ranks.get(token[:n])) is not None and r in self.parts:
                    self.shorter[rank] = r
                    break

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens left before the merge that completes token, if the merges get there."""
        left = merge(token, self.ranks, stop=2)
        return (left[0], left[1]) if len(left) == 2 and token in self.ranks else None


def merge(piece: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[int]:
    """BPE by its definition: the lowest-ranked adjacent pair merges first, leftmost of ties."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        best = min((ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
        if best[0] == 1 << 40:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Encoder:
    """Encodes texts; one lives in each Python worker."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.v = vocabulary
        self.split = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for rank in vocabulary.parts:
            token = vocabulary.bytes_of[rank]
            self.automaton.add_word(token.decode("latin-1"), len(token) << RANK_BITS | rank)
        self.automaton.make_automaton()
        self.size_of = {rank: len(token) for rank, token in vocabulary.bytes_of.items()}
        self.pairs: dict[int, bool] = {}  # by left << RANK_BITS | right
        self.pieces = Pieces(self.encode_piece)

    def may_adjoin(self, left: int, right: int) -> bool:
        """Whether BPE leaves the border between these tokens standing.

        The tokens are taken apart, always the one whose merge came last; a merge across the
        border that outranks the merges still standing would have happened before them.
        """
        ranks, bytes_of, parts = self.v.ranks, self.v.bytes_of, self.v.parts
        a, b = left, right
        undone, from_left = 1 << 40, False
        fits = True
        while True:
            across = ranks.get(bytes_of[a] + bytes_of[b], 1 << 40)
            # A pair across the border goes first if its rank is lower than that of the merge
            # undone last; of equal ranks the leftmost goes first, which is the one across the
            # border only where that merge lies to its right.
            if across < undone or (across == undone != 1 << 40 and not from_left):
                fits = False
                break
            pa_, pb = parts[a], parts[b]
            if pa_ is None and pb is None:
                break
            # Undo the merge made last: the higher rank; of equal ranks the right one.
            if pb is None or (pa_ is not None and a > b):
                undone, from_left, a = a, True, pa_[1]
            else:
                undone, from_left, b = b, False, pb[0]
        if len(self.pairs) >= PAIR_MEMO:
            self.pairs.clear()
        self.pairs[left << RANK_BITS | right] = fits
        return fits

    def encode_piece(self, piece: bytes) -> list[int]:
        ranks = self.v.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        longest = [0] * n  # at each start, size and rank of the longest token in one number
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            start = end - (token >> RANK_BITS) + 1
            if token > longest[start]:
                longest[start] = token
        shorter, size_of, pairs = self.v.shorter, self.size_of, self.pairs
        reachable = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, last, token = 0, -1, longest[0] & RANK_MASK
        while True:
            end = at + size_of[token]
            if reachable[end]:
                if last < 0:
                    fits = True
                elif (fits := pairs.get(last << RANK_BITS | token)) is None:
                    fits = self.may_adjoin(last, token)
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    at, last, token = end, token, longest[end] & RANK_MASK
                    continue
            if (less := shorter.get(token)) is not None:
                token = less
                continue
            reachable[at] = 0  # nothing fits here: the token before is tried shorter
            token = out.pop()
            at -= size_of[token]
            last = out[-1] if out else -1

    def forget(self) -> None:
        self.pieces.clear()
        self.pairs.clear()

    def pack(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers in native order."""
        if len(self.pieces) > PIECE_MEMO:
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> list[int]:
        return array("i", self.pack(text)).tolist()


class Pieces(dict[str, bytes]):
    """Packed encodings by piece; a piece that is missing is encoded, and kept unless it is long."""

    def __init__(self, make: Callable[[bytes], list[int]]):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.make(piece.encode("utf-8"))).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Decoder:
    """Joins the bytes of ids; many at once."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.size = np.zeros(max(bytes_of) + 1, np.int64)
        for rank, token in bytes_of.items():
            self.size[rank] = len(token)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(bytes_of[r] for r in sorted(bytes_of)), np.uint8)

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """The bytes of ids[cuts[k]:cuts[k + 1]] for each k; unknown ids fail."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        size = self.size[ids]
        end = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        at = np.arange(end[-1]) + np.repeat(self.start[ids] - end[:-1], size)
        joined, edge = self.data[at].tobytes(), end[cuts].tolist()
        return [joined[a:b] for a, b in zip(edge, edge[1:], strict=False)]


def encoder(path: str, pattern: str) -> Encoder:
    """This Python worker's encoder, built once."""
    kept = worker_cache("bpe")
    if ("encoder", path, pattern) not in kept:
        kept["encoder", path, pattern] = Encoder(Vocabulary(load_ranks(path)), pattern)
    return kept["encoder", path, pattern]


def decoder(path: str) -> Decoder:
    kept = worker_cache("bpe")
    if ("decoder", path) not in kept:
        kept["decoder", path] = Decoder({r: b for b, r in load_ranks(path).items()})
    return kept["decoder", path]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, ids (array of int), decoded (binary, the ids' bytes joined).

    Whole texts are encoded, each match of the pattern by itself, without special tokens.
    Null and empty texts: no ids, no bytes. Repeated rows: one result each. Characters that
    the pattern does not match are left out of the ids. Other columns are not read. The rank
    file is read by its path on every executor, once per Python worker. Texts stream through
    in Arrow batches; nothing is shuffled.
    """
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, d = encoder(ranks_path, pattern), decoder(ranks_path)
        try:
            yield from encoded(batches, e, d)
        finally:
            e.forget()

    def encoded(batches: Iterator[pa.RecordBatch], e: Encoder, d: Decoder) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for first in range(0, len(texts), 256):
                packed = [e.pack(t) if t else b"" for t in texts.slice(first, 256).to_pylist()]
                cuts = np.cumsum([0, *(len(p) // 4 for p in packed)])
                ids = np.frombuffer(b"".join(packed), np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, 256), lists, pa.array(d.decode(ids, cuts), pa.binary())], ["doc_id", "ids", "decoded"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(tidy("bpe", run), f"doc_id {kind}, ids array<int>, decoded binary")


def decode_ids(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", into: str = "text_bytes") -> DataFrame:
    """encoded with one more column: the bytes of its ids joined; null ids give no bytes. Unknown ids fail.

    A column of encoded that is named like the new one is replaced.
    """
    kept = encoded.drop(into)
    out = T.StructType([*kept.schema.fields, T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = decoder(ranks_path)
        for batch in batches:
            rows = [x or [] for x in batch.column(batch.schema.get_field_index(ids_col)).to_pylist()]
            cuts = np.cumsum([0, *map(len, rows)])
            made = d.decode(np.array([i for x in rows for i in x], np.int64), cuts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, into])

    return kept.mapInArrow(tidy("bpe", run), out)

"""Hashes over the bytes of many texts at once: prefix polynomials, and the words and shingles of texts.

Polynomials modulo 2**64 are quick but equal for some different strings with structure (such as Thue-Morse
sequences, whatever the base), so that they only order and pre-sort what is compared by its bytes in the end.
Words are hashed by mixing their bytes block by block instead, and spans whose equality decides by spans128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are worked on in pieces of about so many bytes together.
CHUNK_BYTES = 1 << 20

#: Tables of more powers than this are not kept.
KEPT_POWERS = 1 << 22
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, up to a bound, and doubled when more are asked for."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        while len(have) < max(n, 1 << 16):
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        if len(have) <= KEPT_POWERS:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit number's bits; one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with len(data) + 1 places: H[b] - H[a] is the hash of data[a:b] times BASE**a."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; inverse: powers(INVERSE, len(prefix))."""
    return (prefix[end] - prefix[start]) * inverse[start]


def blocks8(data: bytes) -> np.ndarray:
    """The eight bytes from every place of data, as numbers."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))


def spans128(data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each data[start:end], from one 128-bit hash that has no algebraic structure."""
    digest = xxhash.xxh3_128_digest
    both = np.frombuffer(b"".join([digest(data[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]), "<u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    first = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > size:
            yield first, k
            first, held = k, 0
        held += len(t)
    if first < len(texts):
        yield first, len(texts)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """Words of some texts: the number of the text that each is in, ascending, and its hash."""

    n_texts: int
    own: np.ndarray
    hash: np.ndarray


#: Words of more bytes than this are hashed one by one.
LONG_WORD = 64
#: The low 0 to 8 bytes of a number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; data goes on for 8 bytes after the last. Words of equal size and up to 8 bytes never collide."""
    out = mix(size.astype(np.uint64) * np.uint64(BASE))
    block, on = blocks8(data), np.flatnonzero(size <= LONG_WORD)
    for done in range(0, LONG_WORD, 8):
        on = on[size[on] > done]
        if not len(on):
            break
        out[on] = mix(out[on] ^ (block[start[on] + done] & _LOW[np.minimum(size[on] - done, 8)]))
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : start[k] + size[k]], digest_size=8).digest(), "little")
    return out


def words(texts: list[bytes]) -> Words:
    joined = b" ".join([b"", *texts, b"        "])
    data = np.frombuffer(joined, np.uint8)
    space = _SPACE[data]
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    firsts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    own = np.searchsorted(firsts, start, "right") - 1
    return Words(len(texts), own, word_hashes(joined, start, end - start))


def ngrams(w: Words, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(place of first word, hash) of each run of n words of one text.

    short: a text with fewer words, but at least one, gives one run of all its words.
    """
    count = len(w.own)
    own = np.concatenate([w.own, np.full(n - 1, -1)])
    value = np.concatenate([w.hash, np.zeros(n - 1, np.uint64)])
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total = total * np.uint64(BASE) + np.where(own[j : j + count] == w.own, value[j : j + count], np.uint64(0))
    whole = own[n - 1 : n - 1 + count] == w.own
    if short:
        first = np.ones(count, bool)
        first[1:] = w.own[1:] != w.own[:-1]
        whole |= first & (np.bincount(w.own, minlength=w.n_texts)[w.own] < n)
    at = np.flatnonzero(whole)
    return at, mix(total[at] + np.uint64(n))

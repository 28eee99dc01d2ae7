"""Cross-tokenizer alignment against a plain version that tokenizes whole texts and compares all tokens."""

from __future__ import annotations

import collections
import os
import random
import subprocess
import sys

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from geoloom.llm import alignment

from .test_operators import edge_rows, frame

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_version(rows, libraries):
    a, b = libraries
    signs = {c: x for x, c in alignment.byte_signs().items()}

    def tokens(text):
        if not text:
            return None
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids
        x = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in ids_a]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        want = f" {text}".encode()
        return (x, y) if b"".join(t for _, t in x) == want == b"".join(t for _, t in y) else None

    def ranges(x):
        out, at = [], 0
        for i, t in x:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    told, count = [], collections.Counter()
    for doc_id, text in rows:
        if (both := tokens(text)) is None:
            told.append((doc_id, None))
            continue
        x, y = map(ranges, both)
        links, k = [], 0
        for i, s, e in x:
            while y[k][2] <= s:
                k += 1
            j = k
            while j < len(y) and y[j][1] < e:
                links.append((i, y[j][0]))
                j += 1
        count.update(links)
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        parts, p, q = [], 0, 0
        for c in cuts:
            g, h = [], []
            while p < len(x) and x[p][2] <= c:
                g.append(str(x[p][0]))
                p += 1
            while q < len(y) and y[q][2] <= c:
                h.append(str(y[q][0]))
                q += 1
            parts.append(",".join(g) + "|" + ",".join(h))
        told.append((doc_id, (len(x), len(y), len(cuts), links, ";".join(parts))))
    most = collections.Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    out = []
    for doc_id, t in told:
        if t is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            links = t[3]
            out.append((doc_id, t[0], t[1], t[2], len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links), t[4]))
    return sorted(out, key=repr)


def result(spark, rows):
    return sorted(map(tuple, alignment.align(frame(spark, rows), A, B).collect()), key=repr)


def odd_rows():
    rng = random.Random(9)
    parts = ["a", "the", " the", "word", " ", "  ", "\n", "\t", "é", "日本", "🙂", "<s>", "<|endoftext|>", "'s", "1", "22.", "　", "\xa0", "\x00", "ﬁ", "①", "\r\n", "Ａ", " ", "٣", "᠎", "﻿", "unbelievable", " tokenization"]
    return [(k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))) for k in range(100, 500)]


def test_alignment(spark, libraries):
    rows = edge_rows() + odd_rows() + [(20, "x" * 3000 + " y"), (21, "日本語" * 500), (22, "same same same"), (22, "same same same"), (23, "a" + " " * 400)]
    assert result(spark, rows) == plain_version(rows, libraries)


def test_texts_with_the_space_mark_count_for_nothing(spark, libraries):
    rows = [(1, "some words here"), (2, "some ▁words here"), (3, "here some words"), (4, "▁"), (5, "some")]
    got = result(spark, rows)
    assert got == plain_version(rows, libraries)
    assert got[1][1:] == (0, 0, 0, 0, 0, 0, "")


@pytest.mark.parametrize("bound", [1, 4])
def test_rare_pairs_are_joined(spark, libraries, monkeypatch, bound):
    monkeypatch.setattr(alignment, "HOT_PAIRS", bound)
    monkeypatch.setattr(alignment, "HOT_STRETCHES", bound)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 64)
    monkeypatch.setattr(alignment, "SMALL_DIGITS", 3)
    rows = odd_rows()[:120]
    assert result(spark, rows) == plain_version(rows, libraries)


def test_empty_table(spark):
    assert alignment.align(frame(spark, [(1, "x")]).limit(0), A, B).count() == 0


def test_stretches_join_to_texts():
    for _, text in odd_rows():
        assert "".join(alignment.cut(text)) == f" {text}"


def test_texts_and_stretches_do_not_travel(spark):
    """What blocks of texts asked for filled the disk: with pairs known to every worker nothing is dealt out after the counts."""
    made = alignment.align(frame(spark, odd_rows()), A, B)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CoGroup" not in plan


def test_frequent_stretches_are_kept():
    known = alignment.Alignments(alignment.Tokenizers(A, B))
    known.places(["one two two", None, "two three" + "x" * 40], 2, 8)
    kept = known.groups[known.place[" two"]]
    (at,) = known.places(["two four"], 2, 8)
    assert set(known.place) == {" two", " four"}
    assert [known.groups[k] for k in at][0] == kept and known.sums[at, 3].sum() == len(known.links)


def test_a_worker_holds_few_stretches():
    """Words that never come twice: what a worker has at once is what it keeps and one block's, in less memory than an executor has to spare."""
    code = f"""
import random, resource
import pyarrow as pa
from geoloom.llm import alignment

rng = random.Random(1)
texts = [" ".join("%06x" % rng.getrandbits(24) for _ in range(800)) for _ in range(1000)]
known = alignment.Alignments(alignment.Tokenizers({A!r}, {B!r}))
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
before, most = peak(), 0
for part in alignment.slices(pa.array(texts), alignment.BLOCK_BYTES):
    known.places(part, alignment.HOT_STRETCHES, 1 << alignment.SMALL_DIGITS)
    most = max(most, len(known.place))
print(most, peak() - before)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    told = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(told[0]) < 250_000 and int(told[1]) < 170

"""Fill-in-middle against a plain version, and back again."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from geoloom.llm import fill_middle

from .test_operators import edge_rows, frame


def plain_version(doc_id, text):
    text = text or ""
    parts = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(parts)
    told = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(told[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    rng = random.Random(6)
    parts = ["a", " ", "\n", "\t\t", "<", "P>", "<S", ">", "é", "🙂", "\x85", " ", "\x00", "word", "\r\n", "<M>", "M"]
    rows = edge_rows() + [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for k in range(10, 800)]
    made = fill_middle.fill_in_middle(frame(spark, rows))
    got = made.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr(r)
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got], key=key) == sorted([(k, *plain_version(k, t), t or "") for k, t in rows], key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_blocks_cut_where_tokens_end():
    rng = random.Random(7)
    split = Split(Regex(fill_middle.TOKEN), "isolated")
    for _ in range(200):
        text = "".join(rng.choice("ab  \n\té🙂") for _ in range(rng.randint(0, 200)))
        assert "".join(p for _, p in fill_middle.blocks(text, 7)) == text
        assert [s + b for s, p in fill_middle.blocks(text, 7) for _, (_, b) in split.pre_tokenize_str(p)] == [b for _, (_, b) in split.pre_tokenize_str(text)]


def test_long_texts(spark):
    rows = [(k, ("wörd \n" * 200_000) if k % 2 else "x" * 500_000) for k in range(6)]
    got = {r.doc_id: r for r in fill_middle.fill_in_middle(frame(spark, rows)).collect()}
    for k, t in rows:
        assert (got[k].n, got[k].form, got[k].prefix_chars, got[k].middle_chars, got[k].output) == plain_version(k, t)


def test_rates_and_empty_table(spark):
    rows = [(k, "one two three four") for k in range(300)]
    made = fill_middle.fill_in_middle(frame(spark, rows), rate=100, spm_rate=0)
    assert {r.form for r in made.collect()} == {"psm"}
    assert fill_middle.fill_in_middle(frame(spark, rows).limit(0)).count() == 0

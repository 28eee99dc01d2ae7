"""Personal data against Python's own pattern matching, and the spans that the method adds."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from geoloom.llm import pii

from .test_operators import edge_rows, frame

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    odd = [int(c) for c in reversed(digits)]
    return sum(odd[0::2] + [sum(divmod(2 * d, 10)) for d in odd[1::2]]) % 10 == 0


def fits(kind: str, found: str) -> bool:
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple]:
    found = [(m.start(), list(BASE).index(k), m.end(), k) for k, p in BASE.items() for m in re.finditer(p, text or "") if fits(k, m.group())]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def spans_of(spark, rows):
    got = pii.find_personal_data(frame(spark, rows))
    return sorted(((r.doc_id is None, r.doc_id or 0, [tuple(s) for s in r.spans]) for r in got.collect()), key=repr)


def test_base_spans(spark):
    rng = random.Random(5)
    parts = ["a", "b.c", "@", "@x", ".", "com", "1", "255", "256", "0001", "4111", "1111", " ", "-", "+", "+1", "(", ")", "é", "🙂", "\n", "_", "4111 1111 1111 1111", "x@y.z", "10.0.0.1", "+1 (555) 010-9999", "%"]
    rows = edge_rows() + [(k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for k in range(10, 1500)]
    want = sorted(((k is None, k or 0, base_spans(t)) for k, t in rows), key=repr)
    got = [(a, b, [(s[0], s[1], s[2]) for s in c if s[4]]) for a, b, c in spans_of(spark, rows)]
    assert sorted(got, key=repr) == want


def test_added_spans(spark):
    told = {
        "pay to DE89370400440532013000 now": ["iban:7:29"],
        "pay to DE89 3704 0044 0532 0130 00 now": ["iban:7:34"],
        "pay to DE88370400440532013000 now": [],
        "GB82 WEST 1234 5698 7654 32": ["iban:0:27"],
        "Call me: 555-010-9999 today": ["phone:9:21"],
        "part 555-010-9999 of": [],
        "call +1 (555) 010-9999": ["phone:5:22"],
        "his SSN is 123-45-6789.": ["ssn:11:22"],
        "code 123-45-6789": [],
        "host 2001:0db8:0000:0000:0000:ff00:0042:8329": ["ipv6:5:44"],
        "mail jo (at) host [dot] org": ["email:5:27"],
        "meet me at noon": [],
        "visa 4222222222222 expired": ["card:5:18"],
        "number 4222222222222": [],
    }
    rows = list(enumerate(told))
    got = pii.find_personal_data(frame(spark, rows)).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()
    assert {rows[r.doc_id][1]: r.s.split(",") if r.s else [] for r in got} == told


def test_scores_rise_with_words_nearby(spark):
    rows = [(1, "card 4111 1111 1111 1111"), (2, "4111 1111 1111 1111"), (3, "card" + " " * 60 + "4111 1111 1111 1111")]
    got = {r.doc_id: r.spans[0].score for r in pii.find_personal_data(frame(spark, rows)).collect()}
    assert got[1] > got[2] == got[3]


def test_long_and_odd_texts(spark):
    """Runs without an end, and very many matches, take linear time or little more."""
    many = "a@b.c 10.0.0.1 " * 30_000
    rows = [(1, "a" * 400_000), (2, "1." * 200_000), (3, "1 " * 200_000), (4, "+" * 100_000 + "1" * 300_000), (5, "x@" + "a." * 200_000), (6, "ab:" * 100_000), (7, many)]
    began = time.time()
    got = {r.doc_id: r.n for r in pii.find_personal_data(frame(spark, rows)).select("doc_id", F.size("spans").alias("n")).collect()}
    assert got[7] == 60_000 and got[1] == got[3] == 0 and got[5] == 1
    assert time.time() - began < 120


def test_empty_table(spark):
    assert pii.find_personal_data(frame(spark, [(1, "x")]).limit(0)).count() == 0

"""Training-data operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import byte_bpe, chat_format, components, exact_dedup, lm_score, mixing, near_dedup, quality_rules, substring_dedup, toxicity, warc
from geoloom.llm.common import row_key
from geoloom.llm.hashing import words
from geoloom.llm.suffix_sort import Suffixes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that operators might use themselves.
CLASH = "rid bigint, name string, key int, block string, size bigint, stats string, label int, bucket int"
CLASHING = (7, "n", 1, "b", 2, "s", 0, 3)


def frame(spark, rows, extra=True):
    """rows of (doc_id, text); with a source, a lang and clashing columns."""
    data = [(i, t, f"s{(i or 0) % 3}" if i is not None else None, "en", *(CLASHING if extra else ())) for i, t in rows]
    return spark.createDataFrame(data, "doc_id bigint, text string, source string, lang string" + (f", {CLASH}" if extra else ""))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows():
    rng = random.Random(1)
    long = prose(rng, 9000)
    return [(1, None), (2, ""), (3, "  \n\t"), (4, "one"), (5, "one"), (5, "one"), (5, "two words"), (None, "no id at all"), (None, None), (6, long), (7, long), (8, long + " x"), (9, "é漢🙂 ñ")]


# 1


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, rng.randint(0, 60))) for k in range(400)] + [(None, "a b c"), (3, None)]
    got = mixing.mix(frame(spark, rows)).collect()
    again = mixing.mix(frame(spark, rows)).collect()
    pick = lambda x: sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.taken) for r in x)
    assert pick(got) == pick(again) and len(got) == len(rows)
    total = sum(r["size"] for r in got)
    assert total == sum(len(WORDS.findall(t or "")) for _, t in rows)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * total) < 150
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    assert sum(x[0].target for x in by.values()) == pytest.approx(1.5 * total)
    for x in by.values():
        assert abs(sum(r.taken for r in x) - x[0].target) <= 200
        assert x[0].target <= 2 * x[0].source_size


@pytest.mark.parametrize("seed", [0, 7])
def test_mixing_takes_what_a_loop_takes(spark, seed):
    """Also with one hot id, equal rows, and nulls."""
    rng = random.Random(4)
    rows = [(k, prose(rng, rng.randint(0, 60))) for k in range(150)] + [(5, prose(rng, rng.randint(1, 9))) for _ in range(80)] + [(5, "tie tie")] * 40 + [(None, "a b"), (None, None)]
    docs, rid = row_key(frame(spark, rows))
    docs = docs.withColumn("rid", rid)
    got = {tuple(r.rid): r for r in mixing.mix(docs, seed=seed, row_col="rid").collect()}
    told = docs.select("rid", "doc_id", "source", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("h")).collect()
    assert len(got) == len(told) == len(rows)
    queues = collections.defaultdict(list)
    for r in told:
        queues[r.source].append((r.h, r.doc_id is not None, r.doc_id or 0, tuple(r.rid), len(WORDS.findall(r.text or ""))))
    sizes = {s: sum(x[-1] for x in q) for s, q in queues.items()}
    aims, copies = loop_targets(sizes), []
    for s, q in queues.items():
        cum = 0
        for h, _, _, key, size in sorted(q):
            cum += size
            copies += [((cum + sizes[s] * c) / aims[s], h, key, c, size) for c in (0, 1) if size]
    left, taken = sum(sizes.values()) * 150 // 100, collections.Counter()
    for _, _, key, _, size in sorted(copies):
        left -= size
        if left < 0:
            break
        taken[key] += size
    assert {k: r.taken for k, r in got.items()} == {k: taken[k] for k in got}


def loop_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        whole = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / whole > 2 * sizes[s]}
        if not over:
            return out | {s: left * w[s] / whole for s in free}
        for s in over:
            out[s] = 2 * sizes[s]
        left, free = left - sum(out[s] for s in over), free - over
    return out


def test_mixing_targets(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = {f"s{k}": rng.randint(0, 500) for k in range(7)} | {None: 40}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx(loop_targets(sizes))


# 2


def test_restoring():
    text = "you are an idiot and a clown some of the other words are here the idiot went to the pathetic clown " * 50
    n = np.zeros(1 << 18)
    c = toxicity.codes(f"  {text}  ").astype(np.int64)
    np.add.at(n, c[:-2] << 12 | c[1:-1] << 6 | c[2:], 1)
    tri = n.reshape(64, 64, 64)
    p = (tri + 1e-3) / (tri + 1e-3).sum(2, keepdims=True)
    r = toxicity.Restorer(-np.log(p))
    assert r.restore("an 1d10t here") == "an idiot here"
    assert r.restore("i d i o t") == "idiot"
    assert r.restore("idiiiiiot") == "idiot"
    assert r.restore("c-l-0-w-n went") == "clown went"
    assert r.restore("nothing to see here") == "nothing to see here"
    for told, want in {"idio+": "idiot", "idiioott": "idiot", "i  d  i  o  t": "idiot", "i - d - i - o - t": "idiot", "an idiot! no": "an idiot! no", "clown !": "clown !", "c1own!": "clown!", "it is a b": "it is a b"}.items():
        assert r.restore(told) == want
    assert r.restore("x" * 3000 + "1d10t").startswith("x")


def test_viterbi_finds_the_cheapest_reading():
    rng = np.random.default_rng(8)
    r = toxicity.Restorer(rng.uniform(0.1, 6, (64, 64, 64)))
    draw = random.Random(8)
    for _ in range(300):
        span = "".join(draw.choices("ab1!$+ -é", k=draw.randint(1, 6)))
        if not any(x.isalpha() for x in span):
            assert r.viterbi(span) == (span, 0.0)
            continue
        readings = [((0, 0), 0.0, "")]
        for k in range(len(span)):
            readings = [((t := r.step(state, code))[0], had + extra + t[1], text + y) for state, had, text in readings for y, code, extra in r.options(span, k)]
        costs = {text: had + (r.cost[a][b][0] if b else 0.0) for (a, b), had, text in sorted(readings, key=lambda x: -x[1])}
        text, cost = r.viterbi(span)
        assert cost == pytest.approx(min(costs.values())) and costs[text] == pytest.approx(cost)


def test_long_spans_are_read_whole(monkeypatch):
    """What is settled on the way changes no reading."""
    rng = np.random.default_rng(9)
    r = toxicity.Restorer(rng.uniform(0.1, 6, (64, 64, 64)))
    draw = random.Random(9)
    spans = ["i-d-i-o-t-" * 500, "1d10t" * 1000, *("".join(draw.choices("abe1!$+ -é", k=700)) for _ in range(10))]
    got = [r.viterbi(x) for x in spans]
    monkeypatch.setattr(toxicity, "SETTLE", 1 << 30)
    assert got == [r.viterbi(x) for x in spans]


def test_readings():
    """Signs inside words are letters; numbers, doubled letters and digits at the edges of words stay, under a model that has seen neither."""
    text = "you are an idiot and a moron or some loser who is shit and an ass and the clown with his own model there " * 50
    n = np.zeros(1 << 18)
    c = toxicity.codes(f"  {text}  ").astype(np.int64)
    np.add.at(n, c[:-2] << 12 | c[1:-1] << 6 | c[2:], 1)
    tri = n.reshape(64, 64, 64)
    r = toxicity.Restorer(-np.log((tri + 1e-2) / (tri + 1e-2).sum(2, keepdims=True)))
    for told, want in {"a$$": "ass", "sh!t": "shit", "1d1ot": "idiot", "1d10t": "idiot", "m0r0n": "moron", "3d model": "3d model", "3rd": "3rd", "mp3": "mp3", "committee": "committee", "success": "success", "address": "address"}.items():
        assert r.restore(told) == want


def test_short_and_long_words_are_features():
    words = {k: set(zip(*toxicity.beginnings([k]), strict=True)) for k in ("ab", "abc", "abcd", "abcdefgh", "abcdefgi", "ab abcdefgh")}
    assert len(words["ab"]) == len(words["abc"]) == 1 and words["ab"] != words["abc"]
    assert len(words["abcdefgh"] ^ words["abcdefgi"]) == 2
    assert words["ab abcdefgh"] == words["ab"] | words["abcdefgh"]


def test_toxicity(spark):
    rng = random.Random(4)
    bad = ["moron", "clown", "scum", "pathetic"]
    rows, labels = [], []
    for k in range(900):
        words = prose(rng, 40).split() + [rng.choice(["lorem", "ipsum", "dolor"]) for _ in range(10)]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(2000, "what a m0r0n and cl0wn"), (2001, None), (2002, ""), (2003, "m o r o n s c u m")]
    docs = frame(spark, rows)
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.learn(docs, table.filter(~toxicity.held_out()))
    scores = {r.doc_id: r.score for r in toxicity.score_texts(docs, model).collect()}
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores.values())
    held = [r.doc_id for r in table.filter(toxicity.held_out()).collect()]
    truth = dict(labels)
    right = sum((scores[i] >= toxicity.THRESHOLD) == bool(truth[i]) for i in held)
    assert right / len(held) > 0.98
    assert scores[2000] >= 0.3 and scores[2003] >= 0.3 and scores[2001] < 0.3 and scores[2002] < 0.3
    assert toxicity.score_texts(docs.limit(0), model).count() == 0
    assert toxicity.deobfuscate_texts(docs.limit(0), model.cost).count() == 0
    none = toxicity.learn(docs, table.filter("false"))
    assert {round(r.score, 6) for r in toxicity.score_texts(docs, none).collect()} == {round(1 / (1 + np.exp(6.0)), 6)}


# 3


def brute_repeats(rows, window=50):
    first = {}
    data = [(substring_dedup.NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - window + 1):
            k = b[s : s + window]
            first[k] = min(first.get(k, i), i)
    out = []
    for (i, b), (raw, _) in zip(data, rows, strict=True):
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if first[b[s : s + window]] < i:
                gone[s : s + window] = b"\x01" * window
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((raw, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found_repeats(df, **given):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring_dedup.remove_repeats(df, **given).collect()), key=repr)


def test_substring_dedup_edges(spark):
    rows = edge_rows()
    assert found_repeats(frame(spark, rows)) == brute_repeats(rows)
    assert found_repeats(frame(spark, [(1, "x")]).limit(0)) == []


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_random(spark, seed):
    """Few letters and much repetition: shared parts of all lengths around the window, runs of one byte, repeats within a text."""
    rng = random.Random(seed)
    parts = ["".join(rng.choices("ab", k=rng.randint(30, 90))) for _ in range(6)] + ["a" * 70, "é" * 40, "ab" * 60]
    rows = [(rng.randrange(30), "".join(rng.choice(parts)[rng.randint(0, 20) :] + rng.choice("xyz") for _ in range(rng.randint(0, 5)))) for _ in range(40)]
    want = brute_repeats(rows)
    assert found_repeats(frame(spark, rows)) == want
    assert found_repeats(frame(spark, rows), hot_stretches=0) == want


def test_substring_dedup_passages_near_the_window(spark):
    """Passages of 46 to 70 bytes in unlike surroundings: the representative lies anywhere in the one window, or two, that are shared."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz 0123456789"
    text = lambda n: "".join(rng.choices(letters, k=n))
    passages = [text(46 + k % 25) for k in range(120)]
    rows = [(k, text(rng.randint(0, 80)).join([text(rng.randint(0, 20)), *rng.choices(passages, k=4), text(9)])) for k in range(150)]
    want = brute_repeats(rows)
    assert 0 < sum(r[2] for r in want) < sum(r[1] for r in want)
    assert found_repeats(frame(spark, rows)) == want
    assert found_repeats(frame(spark, rows), hot_stretches=1) == want


def thue_morse(n):
    return [bin(k).count("1") % 2 for k in range(n)]


@pytest.mark.parametrize("hot", [1, 1000])
def test_substring_dedup_periodic(spark, hot):
    """Periodic documents with different ends, also with a repeated id, as brute force has them."""
    unit = "w0rd1 $ab i d i o t "
    rows = [(k, ("" if k % 2 else "own start ") + unit[k % 3 :] + unit * (60 + 7 * k) + f"end {k}") for k in range(6)]
    rows += [(3, unit * 90), (2, "x" * 300), (4, "x" * 400), (5, "xy" * 200)]
    got = substring_dedup.remove_repeats(frame(spark, rows), with_kept=True, hot_stretches=hot).collect()
    want = brute_repeats(rows)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)


def test_substring_dedup_of_long_periodic_texts(spark):
    """Work goes with the different windows of a document: two of 1.2 MB take seconds."""
    text = "w0rd1 $ab i d i o t " * 60_000
    rows = [(1, "first " + text), (2, text + " last"), *((k, f"document {k} says nothing that others say") for k in range(3, 11))]
    began = time.time()
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert time.time() - began < 40
    assert got[1].n_removed == 0 and got[2].n_removed == len(text) and got[2].n_spans == 1


def test_substring_dedup_where_polynomials_collide(spark):
    """Texts whose polynomial hashes modulo 2**64 are equal, whatever the base, and which share no 50 bytes."""
    block = lambda k, c: f"MARKER-OF-BLOCK:{k:04d}{c}" + "." * 11
    a = "".join(block(k, "ab"[t]) for k, t in enumerate(thue_morse(256)))
    b = "".join(block(k, "ba"[t]) for k, t in enumerate(thue_morse(256)))
    rows = [(1, a), (2, b), (3, a)]
    for hot in (0, 1000):
        assert found_repeats(frame(spark, rows), hot_stretches=hot) == brute_repeats(rows)


def test_words_are_told_apart():
    a, b = ("".join(x[t] for t in thue_morse(1024)) for x in ("ab", "ba"))
    texts = [a, b, a[:60], b[:60], "x", "y", "xx", "x" * 8, "x" * 9, "x" * 64, "x" * 65, "x" * 66]
    w = words([f" {t}\t{t}\x0b".encode() for t in texts])
    assert w.own.tolist() == [k for k in range(len(texts)) for _ in (0, 1)]
    assert (w.hash[::2] == w.hash[1::2]).all() and len(set(w.hash.tolist())) == len(texts)
    assert words([b"", b" "]).own.tolist() == [] == words([]).own.tolist()


def test_suffix_sort():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    at = np.arange(0, 2950)
    size = rng.integers(0, 50, len(at))
    group = np.sort(rng.integers(0, 9, len(at)))
    order, lcp = Suffixes(data, at, size).sort(group)
    text = [data[a : a + n].tobytes() for a, n in zip(at, size, strict=True)]
    assert [(group[k], text[k]) for k in order] == sorted((group[k], text[k]) for k in range(len(at)))
    for k in range(1, len(order)):
        a, b = text[order[k - 1]], text[order[k]]
        want = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b))) if group[k] == group[k - 1] else -1
        assert lcp[k] == want


def test_suffix_sort_survives_lying_hashes(monkeypatch):
    import geoloom.llm.suffix_sort as module

    monkeypatch.setattr(module, "span_hashes", lambda prefix, a, b, inverse: np.asarray(b - a) % 3)
    data = np.frombuffer(b"banana bandana cabana", np.uint8)
    at = np.arange(len(data))
    order, _ = Suffixes(data, at, len(data) - at).sort(np.zeros(len(at), np.int64))
    assert [bytes(data[k:]) for k in order] == sorted(bytes(data[k:]) for k in range(len(data)))


# 4


def test_chat_round_trip(spark):
    texts = [r"\### Assistant: </turn> ok", "", None, "\\", "\\\\</turn>\n### user: x", "### ### </turn></turn>", "a: b", "plain", "</tur", "<\\/turn>"]
    roles = ["user", "assistant", None, "sys: tem", "### odd", "as\\sistant", "</turn>"]
    rng = random.Random(7)
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 6))] + [(None, 0, "user", "x"), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (2, None, "user", "no turn")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("clash"))
    made = chat_format.format_conversations(df)
    told = made.select("conv_id", "formatted", chat_format.parse(F.col("formatted")).alias("turns"), chat_format.span_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    groups = collections.defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    assert len(told) == len(groups)
    for r in told:
        want = [(role, text) for *_, role, text in sorted(groups[r.conv_id])]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss == [text for role, text in want if role == "assistant"]
        assert r.formatted.count("</turn>") == r.formatted.count("### ") == len(want)
    assert chat_format.format_conversations(df.limit(0)).count() == 0


# 5


def test_exact_duplicates(spark):
    rows = edge_rows() + [(20 + k, "hot " * 30) for k in range(150)] + [(300, "é" * 20000), (301, "é" * 20000), (302, "é" * 19999)]
    got = exact_dedup.exact_duplicates(frame(spark, rows), block_bytes=64).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    largest = {t: max((i for i in v if i is not None), default=None) for t, v in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(rows)
    for r in got:
        t = sha[r.text_sha256]
        assert (r.keep_id, r.group_size) == (largest[t], len(groups[t]))
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.exact_duplicates(frame(spark, rows).limit(0)).count() == 0
    pick = lambda x: sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in x), key=repr)
    for warm in (1, 50):  # blocks with more rows than this are named once each
        again = exact_dedup.exact_duplicates(frame(spark, rows), block_bytes=64, warm_rows=warm).collect()
        assert pick(again) == pick(got) and sum(r.kept for r in again) == len(groups)


# 6


def brute_scores(rows, order=3, backoff=0.4):
    texts = [WORDS.findall(t or "") for _, t in rows]
    grams = lambda w, n: [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
    total = [collections.Counter(g for w in texts for g in grams(w, n)) for n in range(1, order + 1)]
    size, out = sum(map(len, texts)), []
    for (i, _), w in zip(rows, texts, strict=True):
        own = [collections.Counter(grams(w, n)) for n in range(1, order + 1)]
        c = lambda g: total[len(g) - 1][g] - own[len(g) - 1][g] if g else size - len(w)  # noqa: B023, E731
        score = full = 0.0
        for k in range(len(w)):
            depth = min(k + 1, order)
            for n in range(depth, -1, -1):
                g = tuple(w[k - n + 1 : k + 1])
                if n == 0:
                    score += np.log(backoff**depth / max(size - len(w), 1))
                elif c(g) > 0:
                    score += np.log(c(g) / c(g[:-1]) * backoff ** (depth - n))
                    full += n == depth
                    break
        out.append((i is None, i or 0, len(w), round(score, 4), int(full)))
    return sorted(out)


def test_lm_scores(spark):
    rng = random.Random(9)
    rows = edge_rows() + [(100 + k, prose(rng, rng.randint(0, 50), 30)) for k in range(60)]
    for order in (1, 3):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, round(r.log_score, 4), r.n_full) for r in lm_score.score_texts(frame(spark, rows), order=order).collect())
        want = brute_scores(rows, order)
        assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
        assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-3)
    assert lm_score.score_texts(frame(spark, rows).limit(0)).count() == 0


# 7


def test_warc(spark):
    big, other = "<p>é</p>" * 200, "<i>x</i>" * 200
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y%0A%250D%20%25", big), (3, None, big), (4, "", "small"), (5, "u", "small"), (6, "u", None), (7, "u", other), (8, "u", ""), (8, "u", big), (8, "u", big), (None, "n", other)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, size int")
    archive = warc.round_trip(df)
    got = archive.collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for i, u, h in rows:
        data = (h or "").encode()
        owner = max((j for j, _, k in rows if (k or "") == (h or "") and j is not None), default=None)
        revisit = len(data) >= 1000 and i != owner
        want[i, u or None, data, "revisit" if revisit else "response", owner if revisit else None, hashlib.sha1(data).hexdigest()] += 1
    assert collections.Counter((r.id, r.url, bytes(r.payload), r.record_type, r.refers_to, r.payload_digest) for r in got) == want
    for r in got:
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[length:] == b"\r\n\r\n" and b"\r\nWARC-Date: " in head
        assert body[:length] == (b"" if r.record_type == "revisit" else bytes(r.payload))
    assert warc.round_trip(df.limit(0)).count() == 0


# 8


def brute_links(rows, idf):
    raw = [(t or "").encode() for _, t in rows]
    text, shingle, weight = near_dedup.weighted_shingles(raw, idf)
    sets = [{} for _ in rows]
    for a, b, c in zip(text.tolist(), shingle.tolist(), weight.tolist(), strict=True):
        sets[a][b] = c
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = sum(min(sets[a][k], sets[b][k]) for k in sets[a].keys() & sets[b].keys())
                if common / (sum(sets[a].values()) + sum(sets[b].values()) - common) >= 0.8:
                    yield a, b


def brute_classes(rows, idf):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute_links(rows, idf):
        parent[root(a)] = root(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(k)
    return groups


def near_rows():
    rng = random.Random(11)
    rows, k = [], 0
    for _ in range(12):
        base = prose(rng, 200, 5000).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(200)] = f"e{rng.randrange(9999)}"
            rows.append((k, " ".join(copy)))
            k += 1
    return rows + [(None, "a b c"), (500, "a b c"), (501, None), (502, ""), (503, " "), (504, "a b c d")]


def test_near_duplicates(spark):
    rows = near_rows()
    df = frame(spark, rows)
    got = near_dedup.near_duplicates(df).collect()
    groups = brute_classes(rows, near_dedup.document_frequencies(df))
    want = {rows[k][0]: min(rows[j][0] for j in v if rows[j][0] is not None) for v in groups.values() for k in v}
    assert {r.doc_id: r.class_id for r in got} == want
    assert sum(r.kept for r in got) == len(groups) and len(got) == len(rows)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_within_one_template(spark):
    """All documents share most of their text, and near copies in pairs a little more: buckets are full of unlinked parts."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    template, rows = [word() for _ in range(1400)], []
    for k in range(60):
        pair = [word() for _ in range(20)]
        rows += [(2 * k + j, " ".join(template + pair + [word() for _ in range(20)])) for j in (0, 1)]
    df = frame(spark, rows)
    groups = brute_classes(rows, near_dedup.document_frequencies(df))
    assert sorted(map(len, groups.values())) == [2] * 60
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {rows[k][0]: min(v) for v in groups.values() for k in v}


def test_prefix_pairs_miss_no_alike_pair(spark):
    """The exact join alone, without bands: of nodes with different labels every alike pair comes out, and few others."""
    rng = random.Random(6)
    template = prose(rng, 120, 5000).split()
    texts = []
    for k in range(80):
        words_ = (template if k % 2 else prose(rng, 120, 5000).split()) + prose(rng, rng.randint(0, 60), 5000).split()
        texts += [" ".join(words_), " ".join(w if rng.random() > 0.01 else "changed" for w in words_)]
    rows = list(enumerate(texts))
    idf = near_dedup.document_frequencies(frame(spark, rows))
    t, _, w = near_dedup.weighted_shingles([x.encode() for x in texts], idf)
    total = np.bincount(t, w)
    given = spark.createDataFrame([(k, k, float(total[k]), x) for k, x in rows], "node bigint, label bigint, weight double, text string")
    got = {(r.a, r.b) for r in near_dedup.prefix_pairs(given, idf).collect()}
    want = {(b, a) for a, b in brute_links(rows, idf)}
    assert want and want <= got and len(got) < 20 * len(want)


def test_near_duplicates_recall(spark):
    """Links of every 50th document against all, by brute force: families with a few to many changes, and long words that polynomials confuse."""
    rng = random.Random(21)
    rows = []
    for f in range(60):
        base = prose(rng, rng.randint(40, 300), 3000).split()
        for _ in range(rng.randint(2, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 45))):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(copy)))
    a, b = ("".join(x[t] for t in thue_morse(1024)) for x in ("ab", "ba"))
    rows += [(len(rows), a), (len(rows) + 1, b)]
    df = frame(spark, rows)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()}
    assert got[rows[-1][0]] != got[rows[-2][0]]
    found = total = 0
    for x, y in brute_links(rows, near_dedup.document_frequencies(df)):
        if rows[x][0] % 50 == 0 or rows[y][0] % 50 == 0:
            total += 1
            found += got[rows[x][0]] == got[rows[y][0]]
    assert total > 20 and found / total >= 0.95


def test_near_duplicates_with_repeated_ids(spark):
    """One id for different texts, and equal rows: each row has its own text."""
    rng = random.Random(22)
    base = [prose(rng, 80, 5000) for _ in range(5)]
    rows = [(7, t) for t in base for _ in range(3)] + [(8, base[0] + " more"), (None, base[1]), (None, base[2] + " more")]
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(r.class_size for r in got) == sorted([4] * 12 + [3] * 6)
    assert sum(r.kept for r in got) == 5


def test_samples_estimate_similarity():
    rng = np.random.default_rng(1)
    shingle = np.sort(rng.integers(0, 1 << 62, 400).astype(np.uint64))
    w1, w2 = rng.uniform(0.5, 9, 400).astype(np.float32), rng.uniform(0.5, 9, 400).astype(np.float32)
    both = near_dedup.samples(np.repeat([0, 1], 400), np.tile(shingle, 2), np.concatenate([w1, w2]), 600)
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs((both[0] == both[1]).mean() - want) < 0.07


def test_components(spark):
    rng = random.Random(12)
    links = [(k, k + 1) for k in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(15)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {x: x for p in links if None not in p for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a is not None and parent[a] != parent[b]:
                parent[a] = parent[b] = min(parent[a], parent[b])
                changed = True
    assert got == parent


# 9


def test_bpe_equals_tiktoken(spark):
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.load_ranks(path)
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(13)
    vocabulary = list(ranks)
    rows = edge_rows() + [(1000 + k, "".join(rng.choices("abcdeaaathein \n\t..'sréü漢字🙂0019$=", k=rng.randint(0, 60)))) for k in range(200)]
    rows += [(2000 + k, b"".join(rng.choices(vocabulary, k=rng.randint(1, 6))).decode("utf-8", "replace")) for k in range(200)]
    rows += [(3000, " " * 3000), (3001, "a" * 3000), (3002, "ab" * 2000)]
    df = frame(spark, rows)
    encoded = byte_bpe.encode_texts(df, path, P.PATTERN)
    texts = collections.Counter((i, tuple(ref.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert collections.Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in encoded.collect()) == texts
    again = byte_bpe.decode_ids(encoded.select("doc_id", "ids"), path)
    assert collections.Counter((r.doc_id, tuple(r.ids), bytes(r.text_bytes)) for r in again.collect()) == texts
    assert byte_bpe.encode_texts(df.limit(0), path, P.PATTERN).count() == 0
    clashing = byte_bpe.decode_ids(encoded.select("doc_id", "ids", F.lit(1).alias("text_bytes")), path)
    assert clashing.columns == ["doc_id", "ids", "text_bytes"] and clashing.schema["text_bytes"].dataType.simpleString() == "binary"
    with pytest.raises(ValueError):
        byte_bpe.decoder(path).decode(np.array([10**6]), np.array([0, 1]))


# 10


def brute_statistics(text):
    t = text or ""
    w = WORDS.findall(t)
    c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in t.split("\n"):
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), dups, len(covered)


def test_quality_statistics():
    rng = random.Random(14)
    texts = [t for _, t in edge_rows()] + ["a b\x1cc\xa0d e\vf\fg\rh", "x\nx\n \n \nx", "# * $ % & | < >"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(0, 60))) for _ in range(200)] + ["\n".join(rng.choices(["one two", "one two ", " ", "three"], k=9)) for _ in range(20)]
    for t in texts:
        assert quality_rules.statistics(t)[:5] == brute_statistics(t)


def test_quality_rules(spark):
    rng = random.Random(15)
    rows, labels = [], []
    for k in range(900):
        words = prose(rng, rng.randint(25, 60), 3000).split()
        bad = k % 5 == 0
        if bad and k % 2:
            words = [w + "***" for w in words]
        elif bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(not bad)))
    docs, table = frame(spark, rows + [(9000, None), (9001, "")]), spark.createDataFrame(labels, "doc_id bigint, quality int")
    rules = quality_rules.learn_rules(docs, table)
    assert rules
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs.select("doc_id", "text"), rules).collect()}
    assert all(got[i] == bool(q) for i, q in labels) and not got[9000] and not got[9001]
    kept = quality_rules.keep_good(docs, table)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, q in labels if q}
    judged = quality_rules.judge(docs.withColumn("kept", F.lit("clash")).withColumn("rule", F.lit(None)), rules)
    assert {r.doc_id: r.kept for r in judged.collect()} == got and judged.columns.count("kept") == 1
    one = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, quality int")
    hot = frame(spark, [(1, prose(rng, 30)) for _ in range(50)] + [(2, prose(rng, 30))])
    assert quality_rules.learn_rules(hot, one, most=1) == []
    assert quality_rules.learn_rules(docs, table.filter("false")) == []
    assert quality_rules.learn_rules(docs, table.filter("quality = 1")) == []
    assert quality_rules.keep_good(docs.limit(0), table.filter("false")).count() == 0

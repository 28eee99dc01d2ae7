"""The pipeline's stages, each judged on its own input, and its queries with a twin."""

from __future__ import annotations

import collections

import pytest

from ..duck import connect, same

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf_dir):
    from geoloom.llm.common import documents, materialize

    rows = documents(spark, sf_dir)
    columns, seen = rows.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = materialize(stage(spark, rows, sf_dir), "test-stage")
        seen.append(rows)
        if k < 4:
            assert rows.columns == columns
    texts = [[(r.doc_id, r.text) for r in x.collect()] for x in seen[:4]]
    whole = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    assert all(whole[i] == t for x in texts for i, t in x)
    quality, exact, near, mixed = texts
    by_text = collections.defaultdict(list)
    for i, t in quality:
        by_text[t].append(i)
    assert sorted(exact) == sorted((max(v), t) for t, v in by_text.items())
    assert set(near) <= set(exact) and len(set(near)) == len(near)
    assert set(mixed) <= set(near) and max(collections.Counter(mixed).values()) <= 2
    tokens = seen[4].collect()
    assert collections.Counter(r.doc_id for r in tokens) == collections.Counter(i for i, _ in mixed)
    assert all(r.n_tokens == len(r.ids) for r in tokens)


def test_stages_with_odd_rows(spark, sf_dir):
    """Nulls, repeated rows, and columns with names that stages use."""
    rows = [(1, None, None, None, None, 1), (1, "a b", "en", "s", 3, 2), (1, "a b", "en", "s", 3, 2), (None, "a b c", "en", None, 5, 3), (2, "x " * 30, "en", "s", 60, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, decided bigint")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for given in (df, df.limit(0)):
            out = stage(spark, given, sf_dir)
            out.collect()
            if k < 4:
                assert out.columns == df.columns


def test_rows_keep_their_columns(spark, sf_dir):
    """Rows that share id and text are told apart: each keeps its source, and the mix's decision on it is its own."""
    from geoloom.llm.common import materialize
    from geoloom.llm.mixing import mix

    rows = [(1, f"a b c {k % 3}", "en", s, k) for k in range(30) for s in ("s1", "s2", None)] + [(2, None, "en", "s1", 0), (2, "", "en", "s2", 0)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for df in (made, materialize(made, "test-rows")):
        out = corpus_pipeline.mixing_stage(spark, df, sf_dir).collect()
        got = collections.Counter(map(tuple, out))
        assert set(got) <= set(rows) and max(got.values()) <= 2
        taken = collections.Counter()
        for r in mix(df).collect():
            taken[r.source] += r.copies
        assert collections.Counter(r.source for r in out) == +taken
        for stage in (corpus_pipeline.exact_stage, corpus_pipeline.near_stage):
            left = collections.Counter(map(tuple, stage(spark, df, sf_dir).collect()))
            assert set(left) <= set(rows) and max(left.values()) == 1
            by_text = collections.Counter(t or "" for _, t, *_ in left)
            if stage is corpus_pipeline.exact_stage:
                assert set(by_text.values()) == {1} and len(by_text) == 4


def test_twins(spark, sf_dir):
    from geoloom.llm import queries as q

    con = connect(sf_dir)
    for name, sql in q.oracle_sql().items():
        same(q.queries()[name](spark, sf_dir), con, sql)

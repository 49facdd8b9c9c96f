from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from guildmart.llm import mixing as M
from guildmart.llm.queries import QUERIES
from tests.llm.samples import TEXTS, edge_docs, no_docs, texts_of


def plain_targets(sizes, weights):
    capped = set()
    while True:
        rest = sum(sizes) - sum(3 * sizes[i] for i in capped)
        share = sum(w for i, w in enumerate(weights) if i not in capped)
        now = [3 * s if i in capped else rest * weights[i] / share for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if now[i] > 3 * s}
        if not over:
            return now
        capped |= over


def test_query(spark, sf_dir):
    rows = {r["doc_id"]: r for r in texts_of(sf_dir)}
    ours = QUERIES["op4_mixing"](spark, sf_dir).collect()
    assert {r.doc_id for r in ours} == set(rows) and len(ours) == len(rows)
    size = {i: len((r["text"] or "").encode().split()) for i, r in rows.items()}
    sources = sorted({r["source"] for r in rows.values()})
    total = [sum(size[i] for i, r in rows.items() if r["source"] == s) for s in sources]
    target = dict(zip(sources, plain_targets(total, [(5, 2, 1)[i % 3] for i in range(len(sources))])))
    taken = Counter()
    for r in ours:
        source = rows[r.doc_id]["source"]
        assert r["size"] == size[r.doc_id] and r.source_size == dict(zip(sources, total))[source]
        assert r.target == pytest.approx(target[source]) and r.taken <= 3 * r["size"]
        taken[source] += r.taken
    assert all(abs(taken[s] - target[s]) <= M.BLOCK_WORDS * 3 for s in sources)
    again = QUERIES["op4_mixing"](spark, sf_dir).repartition(3).collect()
    assert sorted(ours) == sorted(again)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=9))
def test_targets(sizes):
    weights = [float((5, 2, 1)[i % 3]) for i in range(len(sizes))]
    ours = M.targets(sizes, weights)
    assert ours == pytest.approx(plain_targets(sizes, weights))
    assert sum(ours) == pytest.approx(sum(sizes))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 9))
def test_permutations(n, key):
    assert sorted(M.permute(np.arange(n), n, key).tolist()) == list(range(n))


def test_shards_draw_the_totals():
    slots = np.array([1000, 10, 0, 313])
    draws = [M.shard_counts(slots, s, 14, 100) for s in range(14)]
    assert (sum(c for c, _ in draws) == slots).all()
    assert all(c.sum() == 100 for c, _ in draws[:-1])
    firsts = np.cumsum([np.zeros(4, dtype=int)] + [c for c, _ in draws], axis=0)
    assert all((f == firsts[i]).all() for i, (_, f) in enumerate(draws))


@pytest.mark.parametrize("size", [10, 10**6, 10**12])
def test_draws_follow_one_law_at_every_size(size):
    """Mean and spread of a source's slots in half of all are those of draws without replacement."""
    totals = np.array([3 * size, size])
    draws = np.array([M._left_counts(totals, 2 * size, (7, i))[1] for i in range(4000)])
    variance = 2 * size * 0.25 * 0.75 * 2 * size / (4 * size - 1)
    assert (draws >= 0).all() and (draws <= size).all()
    assert abs(draws.mean() - size / 2) <= 4 * (variance / 4000) ** 0.5 + 0.02
    assert draws.std() == pytest.approx(variance**0.5, rel=0.1)


def test_reruns_agree_without_ids(spark):
    docs = spark.createDataFrame([(None, "s", f"w{i} " * (1 + i % 9)) for i in range(400)], "doc_id bigint, source string, text string")
    one, two = (Counter(map(tuple, M.mixed_documents(d, block_words=4).collect())) for d in (docs, docs.repartition(7)))
    assert one == two


def test_edge_rows(spark):
    docs = edge_docs(spark)
    mix = M.Mix(docs, block_words=4)
    rows = mix.taken().collect()
    size = lambda t: len((t or "").encode().split())
    assert Counter((r.row.doc_id, r["size"]) for r in rows) == Counter((i, size(t)) for i, t, _, _ in TEXTS)
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert mix.sources.orderBy("source_no").collect()[-1].source is None
    mixed = M.mixed_documents(docs, block_words=4)
    assert mixed.columns == docs.columns
    assert Counter(size(r.text) for r in mixed.collect()).total() > 0
    assert sum(size(r.text) for r in mixed.collect()) == sum(r.taken for r in rows)


def test_no_documents(spark):
    assert M.Mix(no_docs(spark)).taken().count() == 0
    assert M.mixed_documents(no_docs(spark)).count() == 0


def test_texts_are_cut_at_words():
    text = " a b\tc\nd e "
    piece = lambda a, n, times: {"from_word": a, "n_words": n, "times": times}
    assert M.cuts(text, 5, [piece(0, 3, 2), piece(3, 2, 1)]) == [text, "a b\tc"]
    assert M.cuts(text, 5, [piece(0, 1, 1), piece(3, 2, 1)]) == ["a\nd e"]
    assert re.sub(r"\s", "", text) == "abcde"


def test_capped_small_sources_get_three_whole_passes(spark):
    sizes = {"a": 100_000, "b": 130, "c": 20, "d": 1, "e": 500}
    docs = spark.createDataFrame([(i, s, "w " * n) for i, (s, n) in enumerate(sizes.items())], "doc_id bigint, source string, text string")
    # The first source has next to no weight, so that all others are capped.
    mix = M.Mix(docs, weights=(0.001, 1, 1, 1, 1))
    words = {r.source_no: r.n for r in mix.segments().join(mix.slot_blocks(), ["source_no", "block"]).groupBy("source_no").agg(F.sum("n_words").alias("n")).collect()}
    assert [words[k] for k in range(1, 5)] == [3 * 130, 3 * 20, 3 * 1, 3 * 500]

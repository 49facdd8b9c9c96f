from __future__ import annotations

import math
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from guildmart.llm import ngram_lm as N
from guildmart.llm.common import unpack
from guildmart.llm.elias_fano import HIGHEST, LOWEST, STEPS, EliasFano, Trie, _select, quantise, quantise_counts, restore, restore_counts
from guildmart.llm.queries import QUERIES
from tests.llm.samples import TEXTS, edge_docs, no_docs, table_dir, texts_of


def plain(rows):
    """Rows of results, from (doc_id, text), by plain counts of words, pairs and triples."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    texts = [[*(t or "").encode().lower().split(), b"\n"] for _, t in rows]
    learnt = [t for t, h in zip(texts, held) if not h]
    one = Counter(w for t in learnt for w in t)
    two = Counter(p for t in learnt for p in zip([None, *t], t))
    total, unit = sum(one.values()), sum(one.values()) + len(one) + 1
    three = Counter(p for t in learnt for p in zip([None, *t], t, t[1:]))
    heads = Counter(one) + Counter({None: len(learnt)})
    for (i, _), t, h in zip(rows, texts, held):
        base = sum(math.log10((one[w] + 1) / unit) for w in t)
        score = 0.0
        for k, b in enumerate(t):
            a = t[k - 1] if k else None
            p = (two[a, b] + N.MU * (one[b] + 1) / unit) / (heads[a] + N.MU)
            if k:
                z = t[k - 2] if k > 1 else None
                p = (three[z, a, b] + N.MU * p) / (two[z, a] + N.MU)
            score += math.log10(p)
        yield i, h, len(t), sum(one[w] > 0 for w in t), total, base, score


def same(ours, wanted):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    ours = [tuple(r[c] for c in names) for r in ours]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6))
    ours, wanted = sorted(ours, key=key), sorted(wanted, key=key)
    assert len(ours) == len(wanted)
    for a, b in zip(ours, wanted):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
        assert a[6] == pytest.approx(b[6], abs=b[2] * (LOWEST + 2 * HIGHEST) / STEPS)


def test_query_equals_plain_model(spark, sf_dir):
    same(QUERIES["op7_ngram_lm"](spark, sf_dir).collect(), plain([(r["doc_id"], r["text"]) for r in texts_of(sf_dir)]))


def test_many_chunks_and_shards(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(N, "CHUNK_WORDS", 500)
    monkeypatch.setattr(N, "SHARD_BYTES", 20_000)
    same(QUERIES["op7_ngram_lm"](spark, sf_dir).collect(), plain([(r["doc_id"], r["text"]) for r in texts_of(sf_dir)]))


def test_edge_rows(spark, tmp_path):
    folder = table_dir(spark, tmp_path, edge_docs(spark))
    same(QUERIES["op7_ngram_lm"](spark, folder).collect(), plain([(i, t) for i, t, _, _ in TEXTS]))


def test_no_documents_and_nothing_to_learn_from(spark):
    assert N.score(no_docs(spark), F.lit(False)).count() == 0
    rows = N.score(edge_docs(spark), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(0) for r in rows)


def test_probabilities_sum_to_one():
    words, pairs, context = np.array([5, 3, 2]), np.array([4, 0, 1]), 6
    unit = int(words.sum()) + len(words) + 1
    of_known = 10 ** N.smoothed(pairs, np.full(3, context), words, unit)
    unknown = 10 ** N.smoothed(np.array([0]), np.array([context]), np.array([0]), unit)
    # The context's own count is what its pairs sum to, here five of six.
    assert of_known.sum() + unknown.sum() == pytest.approx((5 + N.MU) / (context + N.MU))


def test_a_hot_context_is_spread():
    words = np.arange(2, 5000)
    hot = N.pair_shards(np.zeros(len(words), int), np.full(len(words), 10**6), words, 64, 10**7)
    rare = N.pair_shards(np.ones(len(words), int), np.full(len(words), 10), words, 64, 10**7)
    assert len(set(hot)) >= 24 and len(set(rare)) == 1


def test_a_hot_pair_is_one_entry_per_chunk():
    hashes, texts, shards = np.array([4, 7], np.uint64), [0] * 100_000 + [1] + [0, 0, 1], 2
    row = SimpleNamespace(
        words=N.pack(hashes, "<u8"),
        numbers=N.pack(np.array(texts), "<u4"),
        lengths=N.pack(np.array([100_001, 3]), "<u4"),
        held=N.pack(np.array([0, 1]), "u1"),
        answers=[
            {"shard": k, "ids": N.pack(np.array([k + N.FIRST_WORD]), "<u8"), "counts": N.pack(np.array([n]), "<u8")}
            for k, n in ((0, 100_000), (1, 1))
        ],
    )
    sent = [N.unpack_all(N.pack_all(m, N._MESSAGE), N._MESSAGE) for _, m in N._Chunk(row, shards, 100_001, 1).messages()]
    # After the start, after the hot word and the end: three pairs. After the start or the hot word: three triples.
    assert sum(m[7].sum() for m in sent) == 3
    assert sorted(n for m in sent for n, own in zip(m[6].tolist(), m[7].tolist()) if own) == [1, 1, 99_999]
    assert sorted(n for m in sent for n in m[11].tolist()) == [1, 1, 99_998]


def test_a_hot_pair_over_many_chunks_equals_plain_model(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK_WORDS", 300)
    monkeypatch.setattr(N, "SHARD_BYTES", 100)
    rows = [(i, "all rights reserved " * 20 + f"w{i % 7} w{i % 3}") for i in range(60)] + [(99, "a " * 2000)]
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    same(N.score(spark.createDataFrame(rows, "doc_id bigint, text string"), held).collect(), plain(rows))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 10**12), max_size=200), st.lists(st.integers(0, 10**12), max_size=50))
def test_elias_fano(values, asked):
    values = np.sort(np.array(values, dtype=np.int64))
    one = EliasFano(*EliasFano.parts(values))
    assert one.values().tolist() == values.tolist()
    assert one.search(values)[1].all()
    asked = np.array([*asked, *values.tolist()], dtype=np.int64)
    for shift in (0, 1):
        assert one.find(asked + shift).tolist() == np.searchsorted(values, asked + shift).tolist()


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.tuples(st.integers(0, 40), st.integers(0, 60)), st.floats(-11, 0), max_size=300),
    st.dictionaries(st.tuples(st.integers(0, 299), st.integers(0, 30)), st.integers(1, 10**6), max_size=300),
)
def test_trie(pairs, triples):
    keys = sorted(pairs)
    triples = {k: n for k, n in triples.items() if k[0] < len(keys)}
    below = sorted(triples)

    def column(rows, i):
        return np.array([k[i] for k in rows], dtype=np.int64)

    logs, counts = np.array([pairs[k] for k in keys]), np.array([triples[k] for k in below], dtype=np.int64)
    trie = Trie(column(keys, 0), column(keys, 1), logs, column(below, 0), column(below, 1), counts)
    contexts, words = (x.ravel() for x in np.meshgrid(np.arange(42), np.arange(62)))
    places = trie.place(np.arange(42), np.arange(62), contexts, words)
    codes = trie.probabilities(places)
    for a, b, place, code in zip(contexts.tolist(), words.tolist(), places.tolist(), codes):
        assert place == (keys.index((a, b)) if (a, b) in pairs else -1)
        assert (code > 0) == ((a, b) in pairs)
        assert not code or restore(np.array([code]))[0] == pytest.approx(pairs[a, b], abs=LOWEST / STEPS)
    assert [trie.children(c) for c in range(42)] == [sum(k[0] == c for k in keys) for c in range(42)]
    asked, before = (x.ravel() for x in np.meshgrid(np.arange(-1, len(keys)), np.arange(32)))
    for a, b, n in zip(asked.tolist(), before.tolist(), restore_counts(trie.counts(asked, np.arange(32), before)).tolist()):
        assert n == pytest.approx(triples.get((a, b), 0), rel=6e-4)


def test_triples_of_frequent_words_are_spread():
    before = np.arange(2, 5000)
    frequent = N.triple_shards(np.full(len(before), 5), np.full(len(before), 10**6), before, 64, 10**7)
    rare = N.triple_shards(np.full(len(before), 5), np.full(len(before), 10), before, 64, 10**7)
    assert len(set(frequent)) >= 24 and set(rare) == {5}


def test_quantised_probabilities():
    logs = np.linspace(-LOWEST, 0, 1000)
    assert np.abs(restore(quantise(logs)) - logs).max() <= LOWEST / STEPS


def test_quantised_counts():
    counts = np.unique(np.logspace(0, 15, 1000).astype(np.int64))
    assert restore_counts(quantise_counts(counts)) == pytest.approx(counts, rel=3e-4)
    assert restore_counts(np.zeros(1, dtype="<u2"))[0] == 0


def test_distinct_values_by_one_sort_are_those_of_numpy():
    rng = np.random.default_rng(3)
    for top in (1, 5, 10**6, 2**62):
        for n in (0, 1, 2, 1000):
            values = rng.integers(0, top, n)
            found, place = N._unique(values)
            expected, inverse = np.unique(values, return_inverse=True)
            assert found.tolist() == expected.tolist() and place.tolist() == inverse.tolist()


def test_places_of_ones_and_zeros():
    rng = np.random.default_rng(5)
    words = np.append(rng.integers(0, 2**63, 50).astype("<u8"), np.array([0, 2**64 - 1, 1, 2**63], dtype="<u8"))
    bits = np.unpackbits(words.view(np.uint8), bitorder="little")
    for zeros in (False, True):
        places = np.flatnonzero(bits == (0 if zeros else 1))
        each = (bits.reshape(-1, 64) == (0 if zeros else 1)).sum(axis=1)
        found = _select(words, np.cumsum(each) - each, np.arange(len(places)), zeros)
        assert found.tolist() == places.tolist()


def test_chunks_are_joined_without_their_words(spark):
    """Hashes do not pack; a chunk needs its words' shards, which do, to read the answers."""
    rows = [(n, n, False, False, bytearray(f"word{n} other word{n % 7}", "utf-8")) for n in range(40)]
    docs = spark.createDataFrame(rows, "row long, doc_id long, missing boolean, held_out boolean, text binary")
    chunks = N._chunks(docs)
    placed = N._placed(chunks, 5)
    words = {row.chunk: unpack(row.words, "<u8") for row in chunks.collect()}
    assert max(len(w) for w in words.values()) > 5
    for row in placed.collect():
        assert unpack(row.words, "<u8").tolist() == (words[row.chunk] % np.uint64(5)).tolist()

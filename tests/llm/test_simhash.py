from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
import xxhash

from guildmart.llm import simhash
from guildmart.llm.queries import QUERIES
from tests.llm.samples import TEXTS, edge_docs, no_docs, texts_of


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """doc_id -> smallest reachable doc_id, for (doc_id, fingerprint) rows."""
    fps = np.array([f for _, f in rows], dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    label = np.arange(len(rows))
    while True:
        new = np.where(near, label[None, :], len(rows)).min(axis=1)
        if (new == label).all():
            break
        label = new
    found = {}
    for (i, _), at in zip(rows, label):
        if i is not None:
            found[at] = min(found.get(at, i), i)
    return Counter((i, f, found.get(at)) for (i, f), at in zip(rows, label))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in texts_of(sf_dir)]
    ours = QUERIES["op10_simhash"](spark, sf_dir).collect()
    assert Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in ours) == plain_components(rows)


def test_edge_rows(spark):
    rows = [(i, plain_fingerprint(t)) for i, t, _, _ in TEXTS]
    ours = simhash.near_duplicates(edge_docs(spark)).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in ours) == plain_components(rows)


def test_no_documents(spark):
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    assert simhash.one_of_each(no_docs(spark)).count() == 0


def test_one_of_each_keeps_the_smallest_and_all_columns(spark):
    docs = edge_docs(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # 4, 5 and the row without id and text link with 3 (fingerprint 0); 8 appears once, 9 with both texts.
    named = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    rows = kept.collect()
    ids = sorted(r.doc_id for r in rows if r.doc_id is not None)
    assert ids == sorted([*{i for i, c in named.items() if i is not None and i == c}, 9])
    assert [r.text for r in rows if r.doc_id is None] == ["a text without an id\nshared line of text"]


def test_one_of_each_without_ids(spark):
    """Copies without an id are one document, near copies of it go, other texts stay."""
    text = " ".join(f"word{i}" for i in range(400))
    rows = [(None, text)] * 5 + [(None, text + " end"), (None, "another text altogether, of its own words"), (4, "x y z"), (4, "p q r s t")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    linked = bin(simhash.fingerprint(text.encode()) ^ simhash.fingerprint(f"{text} end".encode())).count("1") <= 3
    assert len(kept) == (4 if linked else 5)
    assert {r.text for r in kept} >= {"x y z", "p q r s t", rows[6][1]}


@pytest.mark.parametrize("ball", [0, 400])
def test_links_over_many_shards_lose_no_pair(spark, monkeypatch, ball):
    """Random points, chains of neighbours and a dense ball, in shards of about 100 points."""
    monkeypatch.setattr(simhash, "SHARD_POINTS", 100)
    rng = np.random.default_rng(3)
    points = [rng.integers(0, 2**64, 800, dtype=np.uint64)]
    chain = points[0][:60]
    for _ in range(4):
        flips = [np.uint64(1) << b for b in rng.integers(0, 64, (3, 60)).astype(np.uint64)]
        chain = chain ^ flips[0] ^ flips[1] ^ flips[2]
        points.append(chain)
    if ball:
        flips = np.uint64(1) << rng.integers(0, 64, (4, ball)).astype(np.uint64)
        points.append(points[0][0] ^ np.bitwise_xor.reduce(flips, axis=0))
    fps = np.unique(np.concatenate(points))
    rows = [(int(i), int(f)) for i, f in enumerate(fps)]
    signed = [(int(f),) for f in fps.view(np.int64)]
    distinct = spark.createDataFrame(signed, "fp bigint")
    from guildmart.sources.warehouse import written

    labels = simhash.components(written(simhash.links(written(distinct), len(rows)))).collect()
    ours = {r.node: r.label for r in labels}
    groups = {}
    for i, f in rows:
        s = int(np.uint64(f).view(np.int64))
        groups.setdefault(ours.get(s, s), []).append(i)
    got = Counter((i, f, min(groups[ours.get(s, s)])) for i, f in rows for s in [int(np.uint64(f).view(np.int64))])
    assert got == plain_components(rows)

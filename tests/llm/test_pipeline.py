from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as P
from guildmart.llm import decontamination as D
from guildmart.llm import simhash
from tests.llm.samples import edge_docs, no_docs, table_dir, texts_of


def plain_groups(rows):
    """The rows that near dedup keeps: of linked fingerprints the smallest id, by comparing all pairs."""
    fps = [simhash.fingerprint((r.text or "").encode()) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.MAX_BITS:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    smallest = {}
    for i, r in enumerate(rows):
        k = root(i)
        smallest[k] = min(smallest.get(k, r.doc_id), r.doc_id)
    return sorted(smallest.values())


def holds(text, item):
    return b" " + b" ".join(item) + b" " in b" " + b" ".join(D.words(text)) + b" "


def test_stages_on_a_small_corpus(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest with enough toxic documents to learn from
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    toxic = {r["doc_id"] for r in texts_of(sf_dir, "labels") if r["toxic"] == 1}
    ordinary = {r["doc_id"] for r in texts_of(sf_dir, "labels") if r["toxic"] == 0}
    items = [D.words(r["text"]) for r in texts_of(sf_dir, "benchmark")]
    tables = [docs]
    for name, stage in P.STAGES[:3]:
        tables.append(P.written(stage(spark, tables[-1], sf_dir)))
        assert tables[-1].columns == columns, name
        assert tables[-1].exceptAll(tables[-2]).count() == 0, name
    every, polite, single, clean = (t.collect() for t in tables)
    # Toxic documents go and ordinary ones stay.
    kept = {r.doc_id for r in polite}
    assert len(kept & toxic) <= 0.2 * len(toxic) and len(kept & ordinary) >= 0.98 * len(ordinary)
    # Of each group of near copies the smallest id stays.
    assert sorted(r.doc_id for r in single) == plain_groups(polite)
    # Documents that hold an item go, and others stay.
    leaking = {r.doc_id for r in single if any(holds(r.text, i) for i in items)}
    assert leaking and not leaking & {r.doc_id for r in clean}
    assert len(clean) >= len(single) - 2 * len(leaking)
    mixed = P.written(P.STAGES[3][1](spark, tables[-1], sf_dir))
    times = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and max(times.values()) <= 3 and set(times) <= {r.doc_id for r in clean}
    placed = P.STAGES[4][1](spark, mixed, sf_dir)
    assert placed.columns == [*columns, "shard", "slot"] and placed.count() == mixed.count()
    slots = Counter((r.shard, r.slot) for r in placed.collect())
    assert max(slots.values()) == 1


@pytest.mark.parametrize("docs", [edge_docs, no_docs])
def test_missing_values_repeated_rows_and_clashing_columns(spark, tmp_path, docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (None, None, None)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, None), (2, ""), (3, "shared line of text")], "item_id bigint, text string")
    folder = table_dir(spark, tmp_path, docs(spark), labels=labels, benchmark=items)
    frame = P.documents(spark, folder)
    for name, stage in P.STAGES:
        before, frame = frame, P.written(stage(spark, frame, folder))
        wanted = [c for c in before.columns if name != "sharding" or c not in ("shard", "slot")]
        assert frame.columns == [*wanted, *(["shard", "slot"] if name == "sharding" else [])], name
    assert frame.count() <= 3 * 14 and (frame.count() > 0) == (docs is edge_docs)


def test_reruns_agree(spark, sf_dir):
    one, two = (Counter((r.doc_id, r.text, r.shard, r.slot) for r in P.run(spark, sf_dir).collect()) for _ in range(2))
    assert one == two

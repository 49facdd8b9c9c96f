from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from guildmart.llm import decontamination as D
from guildmart.llm.queries import QUERIES
from tests.llm.samples import edge_docs, no_docs, table_dir, texts_of

ITEMS = [
    (1, "Shared line of text. The quick brown fox jumps over the lazy dog"),
    (2, ""),
    (3, None),
    (4, "alpha beta gamma delta alpha beta gamma delta"),
    (4, "alpha beta gamma delta alpha beta gamma delta"),
    (None, "one id with two different texts"),
]


def plain_scores(index, items, all_words):
    """(passage, item) -> score over all pairs, from the postings alone."""
    weights = {}
    for (term, _), found in index.postings.items():
        for item, weight in found:
            weights.setdefault(item, {})[term] = weight
    result = {}
    for passage in range(-(-len(all_words) // index.segment)):
        start = passage * index.segment
        there = {index.terms.get(w) for w in all_words[start : start + 2 * index.segment]}
        for item, own in weights.items():
            result[passage, item] = sum(w for t, w in own.items() if t in there)
    return result


def test_pruning_loses_no_item_above_the_threshold(sf_dir):
    items = [(r["item_id"], r["text"]) for r in texts_of(sf_dir, "benchmark")]
    index = D.Index(items, 64)
    for row in texts_of(sf_dir)[:60]:
        words = D.words(row["text"])
        plain = {k: v for k, v in plain_scores(index, items, words).items() if v >= D.THRESHOLD}
        ours = {(p, i): s for p, i, s in index.retrieve(words)}
        assert ours.keys() == plain.keys() and all(ours[k] == pytest.approx(plain[k]) for k in ours)


def test_query_finds_the_documents_that_hold_an_item(spark, sf_dir):
    spaced = lambda t: b" " + b" ".join(D.words(t)) + b" "
    items = [(r["item_id"], spaced(r["text"])) for r in texts_of(sf_dir, "benchmark")]
    whole = {(r["doc_id"], i) for r in texts_of(sf_dir) for i, t in items if t in spaced(r["text"])}
    rows = QUERIES["op9_decontamination"](spark, sf_dir).collect()
    ours = {(r.doc_id, r.item_id) for r in rows}
    assert whole and whole <= ours and len(rows) == len(ours)
    assert all(r.question_overlap >= 0.8 and r.answer_overlap >= 0.8 and 0.6 <= r.score <= 1.0001 for r in rows)


def test_a_changed_answer_is_no_leak():
    index = D.Index([(7, "What is the tallest hill of the whole wide land? It is the old green hill.")], 64)
    text = "before it What is the tallest hill of the whole wide land? {} after it"
    assert [x["item_id"] for x in index.leaks(text.format("It is the old green hill."))] == [7]
    assert index.leaks(text.format("Nobody knows that yet, say all.")) == []


def test_items_across_segments_and_long_items(spark):
    rng = np.random.default_rng(1)
    word = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 5000, n))
    items = [(i, word(n)) for i, n in enumerate([20, 64, 65, 300, 2000])]
    docs = [(i, f"{word(at)} {items[i][1]} {word(50)}") for i, at in enumerate([50, 63, 64, 999, 10])] + [(9, word(4000))]
    leaks = D.find_leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert Counter((r.doc_id, r.item_id) for r in leaks) == Counter((i, i) for i in range(5))


def test_edge_rows(spark, tmp_path):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    folder = table_dir(spark, tmp_path, edge_docs(spark), benchmark=items)
    rows = {(r.doc_id, r.item_id) for r in QUERIES["op9_decontamination"](spark, folder).collect()}
    assert {(6, 4), (9, None)} <= rows
    cleaned = D.clean_documents(edge_docs(spark), items)
    assert cleaned.columns == edge_docs(spark).columns
    assert Counter(r.doc_id for r in cleaned.collect())[9] == 1


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert D.find_leaks(no_docs(spark), items).count() == 0
    assert D.find_leaks(edge_docs(spark), items.limit(0)).count() == 0
    assert D.clean_documents(edge_docs(spark), items.limit(0)).count() == edge_docs(spark).count()

from __future__ import annotations

import zlib

import numpy as np
import pytest

from guildmart.llm import ranking
from guildmart.llm.queries import op12_ranking
from tests.llm.samples import TEXTS, edge_docs, no_docs, table_dir, texts_of

EDGE_ALL = TEXTS
EDGE = [t for t in TEXTS if t[0] is not None]
LABELS = "doc_id bigint, quality int, toxic int"


def held_out_counts(rows, sf_dir):
    """{label: (documents, of them predicted 1)} of the held-out part."""
    quality = {r["doc_id"]: r["quality"] for r in texts_of(sf_dir, "labels")}
    found = {}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.held_out and quality.get(r.doc_id) is not None:
            n, kept = found.get(quality[r.doc_id], (0, 0))
            found[quality[r.doc_id]] = (n + 1, kept + r.predicted)
    return found


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_held_out(spark, folder):
    rows = op12_ranking(spark, folder).collect()
    assert len(rows) == len(texts_of(folder))
    found = held_out_counts(rows, folder)
    (good, kept), (poor, wrong) = found[1], found[0]
    assert kept >= 0.99 * good and wrong <= 0.1 * poor


def test_reruns_agree(spark, sf_dir):
    first, second = (sorted(map(tuple, op12_ranking(spark, sf_dir).collect())) for _ in range(2))
    assert first == second


def test_scores_do_not_read_labels_or_ids(spark, sf_dir, tmp_path):
    """The held-out documents' own labels change nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    other = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end quality")
    rows = ranking.with_features(docs.select("doc_id", "text")).drop("text")
    one, two = ranking.fit(rows, labels), ranking.fit(rows, other)
    assert np.array_equal(one.weights, two.weights) and one.cut == two.cut


def test_edge_rows(spark, tmp_path):
    good = [i for i, t, *_ in EDGE if t and len(t) > 30]
    labels = spark.createDataFrame([*((i, int(i in good), 0) for i, *_ in EDGE), (None, 1, 0), (1, 1, 0), (77, 0, None), (3, None, 0)], LABELS)
    folder = table_dir(spark, tmp_path, edge_docs(spark), labels=labels)
    rows = op12_ranking(spark, folder).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i, *_ in EDGE_ALL)
    by_text = {}
    for r in rows:
        assert 0 <= r.score <= 1
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_text[8]) == 1 and by_text[3] == by_text[4] == by_text[5]
    assert ranking.good_documents(edge_docs(spark), labels).columns == edge_docs(spark).columns


def test_one_label_or_no_rows(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    rows = op12_ranking(spark, table_dir(spark, tmp_path, edge_docs(spark), labels=labels)).collect()
    assert rows and all(r.score == 0 and r.predicted == 0 for r in rows)
    empty = table_dir(spark, tmp_path, no_docs(spark), labels=labels)
    assert op12_ranking(spark, empty).collect() == []
    assert ranking.good_documents(no_docs(spark), labels).collect() == []


def test_good_documents_keep_their_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "1 as score", "'x' as features")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = ranking.good_documents(docs, labels)
    wanted = {r.doc_id for r in op12_ranking(spark, sf_dir).where("predicted = 1").collect()}
    rows = kept.collect()
    assert kept.columns == docs.columns and {r.doc_id for r in rows} == wanted
    assert all(r.score == 1 and r.features == "x" for r in rows)


def test_weights_are_the_most_likely_ones():
    """At the fitted weights the penalised likelihood of the pairs has no slope."""
    rng = np.random.default_rng(3)
    good, poor = rng.normal(0.3, 1, (60, 4)), rng.normal(0, 1, (40, 4))
    ranker = ranking.bradley_terry(good, poor)
    first, second = ranking.pairs(60, 40)

    def loss(weights):
        x = (good[first] - poor[second]) @ weights
        return np.log1p(np.exp(-x)).sum() + ranking.RIDGE * len(first) / 2000 * weights @ weights

    for i in range(4):
        step = np.eye(4)[i] * 1e-4
        assert loss(ranker.weights) < loss(ranker.weights + step) and loss(ranker.weights) < loss(ranker.weights - step)


def test_every_document_is_in_pairs():
    first, second = ranking.pairs(50, 7)
    assert len(first) == len(second) == 400
    assert np.bincount(first, minlength=50).min() >= 8 and np.bincount(second, minlength=7).min() >= 57


def test_the_threshold_balances_both_shares():
    apart = ranking.threshold(np.linspace(2, 3, 11), np.linspace(0, 1, 11))
    assert apart == 1.5
    good, poor = np.linspace(0, 10, 1001), np.linspace(-5, 5, 1001)
    cut = ranking.threshold(good, poor)
    assert abs((good < cut).mean() - (poor > cut).mean()) < 0.01
    assert ranking.Ranker(np.ones(1), cut).score(np.array([[cut]]))[0] == pytest.approx(0.7)

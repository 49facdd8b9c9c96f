from __future__ import annotations

from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import tokenizers

from guildmart.llm import alignment
from guildmart.llm.queries import op11_alignment
from tests.llm.samples import edge_docs, no_docs, table_dir, texts_of

ODD = [
    None,
    "",
    "▁x",
    "a\u0000b",
    "<|endoftext|> x</s><unk><0x41>",
    "你好 世界 \U0001f600 " * 50,
    "ab" * 4000,
    " " * 3000,
    "é" * 700,
    "  \n\t x\n",
    "don't I'll 'S ﬁ ½ ①  x y z\r\n",
    "x",
]


@pytest.fixture(scope="module")
def merging():
    """The byte-level vocabulary by its merges."""
    found = tokenizers.Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.BYTE_BPE}")
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(alignment.Vocabularies.read())


def plain(texts, merging, encoders):
    """Per text (n_a, n_b, groups digest) and the linked pairs, by sets of ends."""
    results = []
    for text in texts:
        a = merging.encode(" " + text, add_special_tokens=False).ids if text else []
        b = encoders.pieces.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if b"".join(encoders.a_bytes[i] for i in a) != raw or b"".join(encoders.b_bytes[i] for i in b) != raw:
            a, b = [], []
        ends_a = np.cumsum([len(encoders.a_bytes[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(encoders.b_bytes[i]) for i in b]).tolist()
        after_a, after_b = ({e: i + 1 for i, e in enumerate(x)} for x in (ends_a, ends_b))
        i = j = 0
        links, shown = Counter(), []
        for end in sorted(set(ends_a) & set(ends_b)):
            own_a, own_b = a[i : after_a[end]], b[j : after_b[end]]
            i, j = after_a[end], after_b[end]
            for x, n in Counter(own_a).items():
                for y, m in Counter(own_b).items():
                    links[x, y] += n * m
            shown.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
        digest = sha256(";".join(shown).encode()).hexdigest() if a else ""
        results.append((len(a), len(b), len(shown), sum(links.values()), digest, links))
    return results


def plain_rows(rows, merging, encoders):
    found = plain([r["text"] for r in rows], merging, encoders)
    held = Counter(pair for *_, links in found for pair in links)
    highest: dict[int, int] = {}
    for (a, _), n in held.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for r, (n_a, n_b, n_groups, n_links, digest, links) in zip(rows, found):
        best = sum(n for (a, b), n in links.items() if held[a, b] == highest[a])
        out.append((r["doc_id"], n_a, n_b, n_groups, n_links, best, sum(n * held[p] for p, n in links.items()), digest))
    return sorted(out, key=str)


def ours(spark, folder):
    return sorted(map(tuple, op11_alignment(spark, folder).collect()), key=str)


def test_equals_sets_of_ends(spark, sf_dir, merging, encoders):
    assert ours(spark, sf_dir) == plain_rows(texts_of(sf_dir), merging, encoders)


def test_edge_rows(spark, tmp_path, merging, encoders):
    rows = [r.asDict() for r in edge_docs(spark).collect()]
    assert ours(spark, table_dir(spark, tmp_path, edge_docs(spark))) == plain_rows(rows, merging, encoders)


def test_no_rows(spark, tmp_path):
    folder = table_dir(spark, tmp_path, no_docs(spark))
    assert ours(spark, folder) == []
    assert alignment.groups(no_docs(spark)).collect() == []


def test_many_chunks_and_hot_pairs(spark, sf_dir, merging, encoders):
    """Chunks of a few documents; of a pair that many hold, some joins are by broadcast."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [r.asDict() for r in docs.collect()]
    found = alignment.Alignment(docs, chunk_tokens=500, batch_bytes=1000)
    assert found.chunks.count() > 20
    assert sorted(map(tuple, found.documents().collect()), key=str) == plain_rows(rows, merging, encoders)


@pytest.mark.parametrize("longest", [3, 512])
@pytest.mark.parametrize("limit", [1, 1024])
def test_odd_texts(merging, encoders, monkeypatch, longest, limit):
    monkeypatch.setattr(alignment, "LANE_TOKENS", longest)
    monkeypatch.setattr(alignment, "GROUP_LINKS", limit)
    monkeypatch.setattr(alignment.lockstep, "__defaults__", (longest,))
    found = alignment.Aligner(encoders).align(ODD)
    for k, (n_a, n_b, n_groups, n_links, digest, links) in enumerate(plain(ODD, merging, encoders)):
        own = found["doc"] == k
        assert (found["n_a"][k], found["n_b"][k], found["n_groups"][k], found["n_links"][k]) == (n_a, n_b, n_groups, n_links)
        assert found["groups_sha256"][k] == digest
        pairs = {a * 32000 + b: n for (a, b), n in links.items()}
        assert dict(zip(found["pair"][own].tolist(), found["times"][own].tolist())) == pairs


def test_a_group_that_never_ends_costs_its_distinct_ids(encoders):
    """Ends that never meet: one group of 10**10 links, of two pairs."""
    n = 100_000
    a_end, b_end = np.arange(1, n + 1) * 2, np.append(np.arange(n - 1) * 2 + 1, 2 * n)
    groups, links = alignment.lockstep(a_end, b_end, np.array([0, n]), np.array([0, n]))
    assert groups.tolist() == [[0, 0, n - 1, n - 1]] and len(links) == 0
    ids = np.zeros(n, dtype=np.int64)
    _, pair, times = alignment.Aligner(encoders)._distinct(ids + 5, ids + 7, ids, groups[0])
    assert pair.tolist() == [5 * 32000 + 7] and times.tolist() == [n * n]


def test_ranks_and_merges_give_the_same_ids(merging, encoders):
    """Every character, in words, between digits, spaces and marks, as both ways split texts alike."""
    assert encoders.ranked
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF][::7]
    texts = [f" x{c}y {c}1{c}  {c}.{c}{c}" for c in every] + [" " + t for t in ODD if t]
    by_merges = [e.ids for e in merging.encode_batch(texts, add_special_tokens=False)]
    assert [encoders.encode_a(t) for t in texts] == by_merges


def test_groups_cover_the_text(spark):
    docs = spark.createDataFrame([(1, "Straßen über 12,5 don't"), (2, None)], "doc_id bigint, text string")
    one, two = sorted(alignment.groups(docs).collect())
    assert one.groups[-1].end == len(" Straßen über 12,5 don't".encode()) and two.groups == []
    assert [g.end for g in one.groups] == sorted({g.end for g in one.groups})

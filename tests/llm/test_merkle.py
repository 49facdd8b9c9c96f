from __future__ import annotations

import os
import zlib
from hashlib import sha256

import duckdb
import pytest

from guildmart.llm import merkle
from guildmart.llm.queries import op13_merkle
from guildmart.llm.sql import OP13
from tests.llm.samples import edge_docs, no_docs, table_dir, texts_of


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(rows):
    """All levels as lists, and each path by walking them."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    leaves = {}
    for lang in langs:
        own = [(r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r) for r in rows if r["lang"] == lang]
        leaves[lang] = sorted(own, key=lambda x: x[:3])

    def levels(nodes):
        result = [nodes]
        while len(result[-1]) > 1:
            last = result[-1]
            result.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
        return result

    trees = {lang: levels([x[2] for x in leaves[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for i, (_, _, own, r) in enumerate(leaves[lang]):
            path = []
            for place, tree in ((i, trees[lang]), (n, top)):
                for level in tree[:-1]:
                    first = place // 8 * 8
                    path.append((level[first:place], level[place + 1 : first + 8]))
                    place //= 8
            folded, text = own, r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                folded = leaf_of(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in path:
                folded = h(*left, folded, *right)
            root, proof = top[-1][0], h(*(x for left, right in path for x in left + right))
            out.append((r["doc_id"], own, trees[lang][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def ours(spark, folder):
    """The query's rows, which its SQL gives too."""
    found = sorted(map(tuple, op13_merkle(spark, folder).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet{'/*.parquet' if os.path.isdir(folder + '/documents.parquet') else ''}')")
    assert found == sorted(con.execute(OP13).fetchall(), key=str)
    return found


def test_equals_plain_trees(spark, sf_dir):
    assert ours(spark, sf_dir) == plain(texts_of(sf_dir))


@pytest.mark.parametrize("levels", [1, 2])
def test_small_blocks_make_the_same_tree(spark, sf_dir, levels):
    versions = merkle.tampered(spark.read.parquet(f"{sf_dir}/documents.parquet"), levels).versions().drop("copied")
    assert sorted(map(tuple, versions.collect()), key=str) == plain(texts_of(sf_dir))


def test_edge_rows(spark, tmp_path):
    folder = table_dir(spark, tmp_path, edge_docs(spark))
    rows = [r.asDict() for r in edge_docs(spark).collect()]
    assert ours(spark, folder) == plain(rows)


def test_no_rows(spark, tmp_path):
    assert ours(spark, table_dir(spark, tmp_path, no_docs(spark))) == []


@pytest.mark.parametrize("n", [1, 8, 9, 65])
def test_one_language_of_any_size_and_equal_rows(spark, tmp_path, n):
    docs = spark.createDataFrame([(i // 3, "Same Text", "en", "s") for i in range(n)], "doc_id bigint, text string, lang string, source string")
    docs = docs.selectExpr("*", "cast(9 as bigint) n_chars")
    folder = table_dir(spark, tmp_path, docs)
    assert ours(spark, folder) == plain([r.asDict() for r in docs.collect()])


def test_many_languages(spark, tmp_path):
    rows = [(i, "Text %d" % i, None if i == 5 else "l%s" % chr(40 + i % 90), "s", 6) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert ours(spark, table_dir(spark, tmp_path, docs)) == plain([r.asDict() for r in docs.collect()])


def test_a_version_copies_its_ancestors_only():
    tree = merkle.PersistentTree([h(str(i)) for i in range(100)], 3)
    nodes, root = len(tree.digests), tree.digests[tree.root]
    copies = tree.changed(tree.root, 42, h("other"))
    assert len(copies) == 4 and len(tree.digests) == nodes + 4
    assert tree.digests[tree.root] == root
    assert [tree.digests[n] for n in copies] == merkle.fold(h("other"), tree.beside(tree.root, 42))
    shared = set(tree.children[copies[-1]]) & set(tree.children[tree.root])
    assert len(shared) == len(tree.children[tree.root]) - 1
    again = tree.changed(copies[-1], 7, h("more"))
    plain_tree = merkle.PersistentTree([h("more") if i == 7 else h("other") if i == 42 else h(str(i)) for i in range(100)], 3)
    assert tree.digests[again[-1]] == plain_tree.digests[plain_tree.root]


def test_versions_hold_their_copied_nodes(spark, sf_dir):
    versions = merkle.tampered(spark.read.parquet(f"{sf_dir}/documents.parquet")).versions()
    rows = versions.where("copied is not null").collect()
    assert rows and all(r.copied[-1] == r.folded_root for r in rows)
    assert all((r.copied[0] == r.leaf) == r.verified for r in rows)

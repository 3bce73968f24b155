"""The Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from subsmart.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, columns):
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns))


def tree(nodes, fanout):
    """The root, and for each node its siblings (before, after) by level."""
    proofs, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            low = at // fanout * fanout
            proofs[i].append(("".join(nodes[low:at]), "".join(nodes[at + 1 : low + fanout])))
            places[i] = at // fanout
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], proofs


def plain(rows, columns, group, order, fanout):
    """``(order value, leaf, subroot, root, proof)`` of every row."""
    by_group = {}
    for row in rows:
        by_group.setdefault(row[group], []).append((row[order], leaf_of(row, columns)))
    names = sorted(by_group, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for name in names:
        leaves = sorted(by_group[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((leaves, *tree([leaf for _, leaf in leaves], fanout)))
    root, above = tree([sub for _, sub, _ in trees], fanout)
    return sorted(
        (
            (key, leaf, sub, root, proof + top)
            for (leaves, sub, proofs), top in zip(trees, above)
            for (key, leaf), proof in zip(leaves, proofs)
        ),
        key=repr,
    )


def found(built, order):
    rows = built.proofs().select(order, "leaf", "subroot", "root", "proof").collect()
    return sorted(((r[0], r[1], r[2], r[3], [tuple(x) for x in r[4]]) for r in rows), key=repr)


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_all_documents(documents, fanout):
    rows = documents.collect()
    expected = plain(rows, manifest.LEAF_COLUMNS, "lang", "doc_id", fanout)
    assert found(manifest.build(documents, fanout=fanout), "doc_id") == expected


def test_many_groups(documents):
    """More groups than slots, so that the tree over groups has levels."""
    rows = documents.collect()
    expected = plain(rows, ("text",), "source", "doc_id", 2)
    assert found(manifest.build(documents, ("text",), "source", fanout=2), "doc_id") == expected


def test_odd_rows(odd):
    expected = plain(odd.collect(), manifest.LEAF_COLUMNS, "lang", "doc_id", 8)
    assert found(manifest.build(odd), "doc_id") == expected


def test_no_rows_and_one_row(empty, documents):
    built = manifest.build(empty)
    assert built.proofs().collect() == [] and built.subroots().collect() == [] and built.groups.nodes().collect() == []
    one = documents.limit(1)
    (row,) = manifest.build(one).proofs().collect()
    assert row.leaf == row.subroot == row.root and row.proof == []


def test_repeated_rows_stand_side_by_side(spark):
    docs = spark.range(500).select(
        F.lit(1).alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).alias("n_chars"), F.lit("x").alias("text"),
    )
    assert found(manifest.build(docs), "doc_id") == plain(docs.collect(), manifest.LEAF_COLUMNS, "lang", "doc_id", 8)


def test_inner_nodes(documents):
    built = manifest.build(documents, fanout=4)
    nodes = built.groups.nodes().collect()
    subroots = {r.tree: r.subroot for r in built.subroots().collect()}
    highest = {}
    for r in nodes:
        highest[r.tree] = max(highest.get(r.tree, (0, "")), (r.level, r["hash"]))
    assert {t: x for t, (_, x) in highest.items()} == {t: s for t, s in subroots.items() if t in highest}


def test_folding_finds_every_change(documents):
    built = manifest.build(documents, carry={"other": F.sha2(F.lit("x"), 256)})
    rows = built.proofs().select(
        "root",
        manifest.folded(F.col("leaf"), F.col("proof")).alias("kept"),
        manifest.folded(F.col("other"), F.col("proof")).alias("changed"),
    ).collect()
    assert rows and all(r.kept == r.root != r.changed for r in rows)

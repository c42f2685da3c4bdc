"""Merkle manifest against a plain tree: odd counts, many groups, null and repeated rows, proofs by jumps of any length."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from skygrid.llm.merkle_manifest import digest, encoded, folded, merkle_manifest, proof_digest


def _h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def _way(levels, k):
    found = []
    for level in levels[:-1]:
        found.append(level[k ^ 1] if k ^ 1 < len(level) else None)
        k >>= 1
    return found


def _plain(rows):
    """(id, leaf, subroot, root, siblings) of rows (id, group, leaf)."""
    groups = {}
    for i, g, leaf in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(g, []).append((i, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([leaf for _, leaf in groups[g]]) for g in order}
    top = _levels([trees[g][-1][0] for g in order])
    return sorted(((i, leaf, trees[g][-1][0], top[-1][0], [s for s in _way(trees[g], k) + _way(top, at)])
                   for at, g in enumerate(order) for k, (i, leaf) in enumerate(groups[g])), key=repr)


def _given(spark, rows):
    df = spark.createDataFrame(rows, "id long, g string, leaf string, root string")
    return df.withColumn("leaf", F.unhex("leaf"))


def _rows(n, groups, seed):
    rng = random.Random(seed)
    return [(rng.choice([None, k, k, k, k // 2]), rng.choice(groups), _h(str(rng.randrange(max(2, n))))) for k in range(n)]


@pytest.mark.parametrize("span, n, groups", [
    (1, 70, ["a", "b", None]), (2, 150, ["en"]), (3, 333, ["b", "", "ä", "\U0001f600", "￿", None]), (8, 40, [f"g{k}" for k in range(40)]),
    (1, 1, [None]), (4, 17, ["x"])])
def test_against_plain_tree(spark, span, n, groups):
    rows = _rows(n, groups, n)
    out = merkle_manifest(_given(spark, [(*r, "clash") for r in rows]), group_col="g", order_cols=["id"], span=span)
    assert out.columns == ["id", "g", "leaf", "subroot", "root", "siblings", "path"]
    out = out.withColumn("again", folded(F.col("leaf"), F.col("siblings"), F.col("path"))).withColumn("proof", proof_digest(F.col("siblings"))).collect()
    got = sorted(((r.id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), [s and s.hex() for s in r.siblings]) for r in out), key=repr)
    assert got == _plain(rows)
    assert all(r.again == r.root.hex() for r in out)
    assert all(r.proof == _h(*[s.hex() for s in r.siblings if s]) for r in out)


def test_blocks_of_ancestors(spark):
    """Jumps longer than a block: a shared ancestor is copied for each block of leaves."""
    rows = [(k, "a" if k % 3 else "b", _h(str(k))) for k in range(1500)]
    out = merkle_manifest(_given(spark, [(*r, None) for r in rows]), group_col="g", order_cols=["id"], span=2)
    assert sorted(((r.id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), [s and s.hex() for s in r.siblings]) for r in out.collect()), key=repr) == _plain(rows)


def test_altered_leaf_and_empty_table(spark):
    rows = [(k, "a", _h(str(k))) for k in range(9)]
    out = merkle_manifest(_given(spark, [(*r, None) for r in rows]), group_col="g", order_cols=["id"])
    bad = out.select((folded(digest(F.lit("other")), F.col("siblings"), F.col("path")) == F.lower(F.hex("root"))).alias("ok"))
    assert {r.ok for r in bad.collect()} == {False}
    assert merkle_manifest(_given(spark, []), group_col="g", order_cols=["id"]).collect() == []


def test_encoding_tells_rows_apart(spark):
    rows = [(None, ""), ("", None), ("a", "b"), ("ab", ""), ("ä", "-"), ("-", "1:a"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string").select(encoded(F.col("a"), F.col("b")).alias("e"))
    got = [r.e for r in df.collect()]
    assert len(set(got)) == len(rows) and got[0] == "-0:" and got[4] == "2:ä1:-"

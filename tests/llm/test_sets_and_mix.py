"""Similarity join, mixture and components on small tables: edge cases and plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.llm import set_join
from skygrid.llm.components import components
from skygrid.llm.set_join import candidate_pairs, similarity_components
from skygrid.llm.source_mixing import Mix, mix_sources, mixed_blocks, permuted


def _plain_components(rows):
    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
    out = []
    for members in groups.values():
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        out += [(rows[k][0], len(sets[k]), min(ids) if ids else None) for k in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("short_runs", [64, 2])
def test_join_against_all_pairs(docs_of, monkeypatch, short_runs):
    """Copies, chains of near copies whose ends are not linked, borderline pairs, a passage most texts share."""
    monkeypatch.setattr(set_join, "LONGEST_RUN", short_runs)
    random.seed(11)
    words = [f"w{k}" for k in range(400)]
    passage = random.choices(words, k=30)
    texts = [None, "", "one", "One", "a b c d e", "a b c d e f", " \t\n"]
    for _ in range(12):
        base = random.choices(words, k=random.randint(20, 90))
        texts += [" ".join(base), " ".join(base).upper()]
        for _ in range(6):
            base = list(base)
            base[random.randrange(len(base))] = random.choice(words)
            texts.append(" ".join(base))
    texts += [" ".join(passage + random.choices(words, k=n)) for n in (2, 3, 5, 8, 10, 40, 41, 42)]
    rows = list(enumerate(texts)) + [(None, texts[8]), (None, "only me here"), (3, texts[20])]
    random.shuffle(rows)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similarity_components(docs_of(rows, "n_shingles")).collect()), key=repr)
    assert got == _plain_components(rows)


def test_sets_of_many_texts_at_once():
    """Words of every length and byte, cut as one text at a time would be."""
    texts = [b"", b" ", b"a", b"A b\x0bc d", b"a b c d e", b"x y z " * 9, b"\n\ta  b ", b"a\x00", b"\x00", "é \x1c \x85 x".encode(), b""]
    texts += [b" ".join(b"w" * n for n in range(k, k + 7)) for k in range(1, 80)] + [b"q" * 5000 + b" " + b"q" * 5001]
    h, n = set_join.word_hashes(texts)
    words = [w for t in texts for w in t.lower().split()]
    assert n.tolist() == [len(t.split()) for t in texts]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
    flat, edge = set_join.shingle_sets(texts)
    for k, text in enumerate(texts):
        alone = set_join.shingle_sets([text])[0]
        w = text.lower().split()
        assert flat[edge[k]:edge[k + 1]].tolist() == alone.tolist() == sorted(set(alone.tolist()))
        assert len(alone) == len({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else ())
    assert [x.tolist() for x in set_join.shingle_sets([])] == [[], [0]]


def test_join_of_nothing(docs_of):
    assert similarity_components(docs_of([])).count() == 0
    assert [tuple(r) for r in similarity_components(docs_of([(4, None)])).collect()] == [(4, 0, 4)]


def test_block_skipping_leaves_out_no_pair():
    rng = np.random.default_rng(3)
    n = rng.integers(5, 60, 300)
    place = np.minimum(rng.integers(0, 20, 300), n - 1)
    root = rng.integers(0, 40, 300)
    by = np.lexsort((place, n, root))
    n, place, root = n[by], place[by], root[by]
    found = {tuple(sorted(p)) for a, b in candidate_pairs(np.zeros(300, int), root, np.arange(300), n, place) for p in zip(a.tolist(), b.tolist())}
    want = {(a, b) for b in range(300) for a in range(b) if root[a] != root[b] and 5 * min(n[a], n[b]) >= 4 * max(n[a], n[b])
            and 9 * min(n[a] - place[a], n[b] - place[b]) >= 4 * (n[a] + n[b])}
    assert found == want and want


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 5), (200, 201), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- mixture

@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation_is_one(spark, size):
    df = spark.range(size).select(F.col("id").alias("k"), F.lit(size).cast("long").alias("n"), F.lit(5).cast("long").alias("key"), F.col("id").alias("old"))
    rows = permuted(df, "k", "n", "key").collect()
    assert sorted(r.k for r in rows) == list(range(size))
    assert size < 64 or sum(r.k == r.old for r in rows) < size / 4


def _plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in open_}
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_targets_and_takings(spark):
    random.seed(2)
    rows = [(k, " ".join("w" for _ in range(random.randint(0, 60))), random.choice(["b", "a", None, "é"])) for k in range(400)]
    rows += [(1000, "x " * 20000, "huge"), (1001, None, "null text"), (1002, "tiny one", "z"), (1003, "", "a"), (None, "no id here", "a"), (5, "same id", "a"), (5, "same id", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("taken", F.lit("clash"))
    got = mix_sources(docs, block_words=8, shard_blocks=64).collect()
    assert sorted((r.id, r.size) for r in got if r.id is not None) == sorted((i, len((t or "").split())) for i, t, _ in rows if i is not None) and len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = _plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.02, abs=3 * 8), s
    again = mix_sources(docs.repartition(7), block_words=8, shard_blocks=64).collect()
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_blocks_hold_what_was_taken(spark):
    random.seed(4)
    rows = [(k, " ".join(f"d{k}.{n}" for n in range(random.randint(0, 50))), "ab"[k % 2]) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    blocks = mixed_blocks(docs, block_words=16, shard_blocks=8).collect()
    taken = {r.id: r.taken for r in mix_sources(docs, block_words=16, shard_blocks=8).collect()}
    seen = {}
    for b in blocks:
        ws = b.text.split(" ")
        assert len(ws) == b.n_words <= 16 and sorted({int(w[1:].split(".")[0]) for w in ws}) == sorted(b.doc_ids)
        for w in ws:
            seen[int(w[1:].split(".")[0])] = seen.get(int(w[1:].split(".")[0]), 0) + 1
    assert seen == {k: v for k, v in taken.items() if v}
    assert len({(b.shard, b.slot, b.source) for b in blocks}) == len(blocks)


def test_mixture_is_native_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(docs).count() == 0 and mixed_blocks(docs).count() == 0
    some = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mixed_blocks(some)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
    assert Mix(some).n_shards == 1


def test_counts_of_shards_are_drawn(spark):
    """Counts of a source over the shards spread as draws without replacement do, and add up to what the mixture expects."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 64).alias("text"),
                                    F.element_at(F.array(*map(F.lit, "abc")), F.pmod("id", F.lit(3)).cast("int") + 1).alias("source"))
    mix = Mix(docs, shard_blocks=60)
    got = {}
    for r in mix.draws().collect():
        got.setdefault(r.source_no, {})[r.shard] = r.n_slots
    n, shards = mix.slots_per_shard, mix.n_shards
    assert shards == 100 and n == 60
    per_shard = [sum(of.get(k, 0) for of in got.values()) for k in range(shards)]
    assert per_shard == [n] * shards
    for source, p in enumerate((5 / 8, 2 / 8, 1 / 8)):
        counts = np.array([got[source].get(k, 0) for k in range(shards)])
        assert abs(counts.sum() - p * n * shards) <= 1
        assert 0.6 < counts.var() / (n * p * (1 - p)) < 1.6

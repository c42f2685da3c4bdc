"""SimHash components against plain versions: fingerprints bit by bit, all pairs of fingerprints, hot buckets, edge cases."""

import random

import numpy as np
import pytest
import xxhash

from skygrid.llm import QUERIES
from skygrid.llm.components import components
from skygrid.llm.simhash_ball import ball_links, collisions, fingerprint, forest, masks, simhash_components


def _plain_fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        str.maketrans("\t\n\v\f\r", "     ")).split(" ")
    w = [x for x in w if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[k:k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _plain_components(fps):
    """The smallest place reached by each."""
    fps = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:k] ^ fps[k]) <= 4).tolist():
            a, b = sorted((find(j), find(k)))
            root[b] = a
    return [find(k) for k in range(len(fps))]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "ONE two\tthree", "a b c d", "É x É x É x É x", "  non breaking"]
    texts += [" ".join(rng.choices("ab cd ef Gh ij".split(), k=n)) for n in (4, 5, 6, 50, 300)]
    for t in texts:
        assert fingerprint((t or "").encode()) == _plain_fingerprint(t)
    long = " ".join(f"w{k % 700}" for k in range(70_000))
    assert fingerprint(long.encode()) == _plain_fingerprint(long)


@pytest.mark.parametrize("distance", range(6))
def test_two_fingerprints_meet_at_a_variant(distance):
    """Whatever bits differ, and wherever the leading bits end."""
    rng = random.Random(distance)
    for bits in (1, 7, 32, 60, 64):
        for _ in range(6):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << k for k in rng.sample(range(64), distance))
            met = False
            for lead in masks(bits, 2):
                bucket = (a >> (64 - bits)) ^ lead
                spent = [bin((x >> (64 - bits)) ^ bucket).count("1") for x in (a, b)]
                if max(spent) <= 2:
                    met |= len(collisions(np.array([a, b], np.uint64), np.array(spent), bits)[0]) > 0
            assert met == (distance <= 4)


def test_forest():
    a, b = forest(np.array([5, 1, 3, 7]), np.array([3, 0, 6, 7]), 8)
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 1), (3, 5), (3, 6)]


@pytest.mark.parametrize("per_bucket, max_variants", [(512, 2_000_000), (4, 4000), (40, 3000)])
def test_links_against_all_pairs(spark, per_bucket, max_variants):
    """Chains, a dense cluster that overfills its bucket, pairs at four and five bits; dealt out again down to whole variants."""
    rng = random.Random(9)
    fps = [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for base in fps[:8]:
        for d in (1, 2, 3, 4, 5, 6):
            fps.append(base ^ sum(1 << k for k in rng.sample(range(64), d)))
    center, weak = rng.getrandbits(64), rng.sample(range(64), 9)
    fps += [center ^ sum(1 << k for k in weak if rng.random() < .5) for _ in range(120)]
    for _ in range(10):
        fps.append(fps[-1] ^ sum(1 << k for k in rng.sample(range(64), 4)))
    fps = sorted(set(fps), key=_signed)
    df = spark.createDataFrame([(_signed(x),) for x in fps], "fp long")
    got = {r.node: r.root for r in components(ball_links(df, n_fps=len(fps), per_bucket=per_bucket, max_variants=max_variants)).collect()}
    assert [got.get(_signed(x), _signed(x)) for x in fps] == [_signed(fps[k]) for k in _plain_components(fps)]


def _plain(rows):
    fps = [_plain_fingerprint(t) for _, t in rows]
    root = _plain_components(fps)
    ids = {}
    for (i, _), r in zip(rows, root):
        ids.setdefault(r, []).append(i)
    low = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    return sorted(((i, f"{fp:016x}", low[r]) for (i, _), fp, r in zip(rows, fps, root)), key=repr)


def test_operator_edge_cases(docs_of):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    base = rng.choices(words, k=120)
    rows = [(9, None), (8, ""), (None, " "), (7, "only"), (7, "ONLY"), (None, "nobody else has this text here")]
    rows += [(20 + k, " ".join(base[:k] + ["x"] + base[k + 1:])) for k in range(40)]
    rows += [(100 + k, " ".join(rng.choices(words, k=30))) for k in range(20)] + [(3, "same text twice"), (3, "same text twice")]
    out = simhash_components(docs_of(rows, "fingerprint"))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == _plain(rows)
    assert simhash_components(docs_of([])).collect() == []


def test_query_against_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_simhash_ball"](spark, sf_dir).collect()), key=repr) == _plain(rows)

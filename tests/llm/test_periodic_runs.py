"""Grammar extensions and runs against plain versions; edge cases of the operator."""

import random

import numpy as np
import pytest

from skygrid.llm import periodic_runs
from skygrid.llm.periodic_runs import collapse_runs, collapsed, runs_of
from skygrid.llm.recompression import Grammar


def _plain_runs(w, least):
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, 2 * q):
                out.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def _texts(rng):
    out = []
    for _ in range(rng.randint(1, 8)):
        letters, n = rng.choice([1, 2, 2, 3, 5, 40]), rng.choice([0, 1, 5, 11, 12, 13, 30, 80, 200])
        w = [b"%d" % rng.randrange(letters) for _ in range(n)]
        if rng.random() < .4 and n > 3:
            p = rng.randint(1, n // 2)
            w = [w[i % p] if rng.random() < .99 else b"x" for i in range(n)]
        out.append(w)
    return out


@pytest.mark.parametrize("candidates", [1 << 20, 40])
def test_runs_against_plain_version(monkeypatch, candidates):
    monkeypatch.setattr(periodic_runs, "CANDIDATES", candidates)
    rng = random.Random(5)
    for _ in range(60):
        texts = _texts(rng)
        for least in (2, 12):
            assert [list(map(tuple, r.tolist())) for r in runs_of(texts, least)] == [_plain_runs(w, least) for w in texts]


def test_extensions_against_plain_version():
    """All pairs of positions, both ways, of sequences with fences."""
    rng = random.Random(3)
    for letters in (1, 2, 4):
        parts = [[rng.randrange(letters) for _ in range(rng.randint(2, 40))] for _ in range(3)]
        w, fence = [], letters
        for k, part in enumerate(parts):
            w += [fence + k, *part]
        w.append(fence + len(parts))
        inner = [k for k, s in enumerate(w) if s < fence]
        i, j = np.array([(a, b) for a in inner for b in inner if a != b]).T
        grammar = Grammar(np.array(w), fence)

        def reach(a, b, step):
            n = 0
            while w[a] == w[b]:
                a, b, n = a + step, b + step, n + 1
            return n

        assert grammar.extension(i, j).tolist() == [reach(a, b, 1) for a, b in zip(i, j)]
        assert grammar.extension(i, j, back=True).tolist() == [reach(a, b, -1) for a, b in zip(i, j)]


def test_levels_grow_with_the_logarithm():
    rng = np.random.default_rng(2)
    for body in (rng.integers(0, 1000, 50_000), np.zeros(50_000, int), np.arange(50_000) % 7):
        grammar = Grammar(np.concatenate([[60_000], body, [60_001]]), 60_000)
        assert len(grammar.symbols[-1]) == 3 and len(grammar.symbols) < 120
        assert sum(map(len, grammar.symbols)) < 10 * len(body)


def test_operator_edge_cases(docs_of):
    cycle = "a b c " * 9
    rows = [(1, None), (2, ""), (3, " \n"), (4, cycle), (4, cycle), (None, "x " * 12), (5, "x " * 11), (6, "p q  r\ts"),
            (7, " ".join(f"w{k}" for k in range(3000)) + " z" * 20)]
    out = collapse_runs(docs_of(rows, "runs"), slice_bytes=40)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_words", "runs"]
    got = sorted(((r.doc_id, r.text, r.n_words, [tuple(x) for x in r.runs]) for r in out.collect()), key=repr)
    want = [(1, None, 0, []), (2, "", 0, []), (3, "", 0, []), (4, "a b c", 27, [(0, 27, 3)]), (4, "a b c", 27, [(0, 27, 3)]),
            (None, "x", 12, [(0, 12, 1)]), (5, " ".join("x" * 11), 11, []), (6, "p q r s", 4, []),
            (7, " ".join(f"w{k}" for k in range(3000)) + " z", 3020, [(3000, 20, 1)])]
    assert got == sorted(want, key=repr)
    assert collapse_runs(docs_of([])).collect() == []


def test_overlapping_runs():
    w = b"a b a b a b a b a b a b c a b c a b c a b c a b c".split()
    runs = runs_of([w], 12)[0]
    assert [tuple(r) for r in runs.tolist()] == _plain_runs(w, 12) and len(runs) == 2
    assert collapsed(w, runs) == b"a b c"

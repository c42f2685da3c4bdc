"""Line dedup, decontamination and PII on small texts: edge cases and plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.llm import pii_surrogates as pii
from skygrid.llm.decontamination import find_contamination, without_spans
from skygrid.llm.fm_index import FMIndex, suffix_order
from skygrid.llm.line_windows import remove_repeated_windows

A, B, C, D = "one line here", "two lines here", "three lines here", "a fourth line"


# -- line dedup

def test_later_windows_go_first_stays(docs_of, texts_by_id):
    got = remove_repeated_windows(docs_of([(2, "\n".join(["x", A, B, C, "y"])), (1, "\n".join([A, B, C, D]))], "n_lines"))
    assert texts_by_id(got) == {1: "\n".join([A, B, C, D]), 2: "x\ny"}
    assert texts_by_id(got, "n_removed") == {1: 0, 2: 3} and texts_by_id(got, "n_lines") == {1: 4, 2: 5}


def test_line_edge_cases(docs_of, spark):
    rows = [(1, None), (2, ""), (3, A), (4, "\n".join([A, B, C])), (4, "\n".join([A, B, C])), (None, "\n".join([A, "", B, " " + C])), (5, "\n".join([A] * 6))]
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in remove_repeated_windows(docs_of(rows)).collect()), key=repr)
    # Rows of one id leave each other alone; a null id comes last; blank lines and blanks at the ends do not matter.
    assert got == sorted([(1, None, 0), (2, "", 0), (3, A, 0), (4, "\n".join([A, B, C]), 0), (4, "\n".join([A, B, C]), 0), (None, "", 3), (5, A, 5)], key=repr)
    assert remove_repeated_windows(docs_of([])).count() == 0


# -- FM index and decontamination

@pytest.mark.parametrize("seed", range(6))
def test_index_against_scan(seed):
    rng = np.random.default_rng(seed)
    s = rng.integers(1, [2, 3, 5, 9, 40, 300][seed] + 1, 400)
    full = np.r_[s, 0]
    assert suffix_order(full).tolist() == sorted(range(401), key=lambda k: full[k:].tolist())
    index = FMIndex(s, sample=7)
    phrases = [s[k:k + n].tolist() for k, n in [(0, 1), (5, 3), (100, 7), (390, 10)]] + [[int(s.max()) + 3], [1, 1, 1, 1, 1]]
    padded = np.array([p[::-1] + [0] * (10 - len(p)) for p in phrases])
    lo, hi = index.search(padded, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, lo, hi):
        assert sorted(index.locate(np.arange(a, b)).tolist()) == [k for k in range(400) if s[k:k + len(p)].tolist() == p]


def _plain_hits(text, items, window=10):
    fold = lambda t: re.findall("[0-9a-z\u0080-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    ws, hit, names = fold(text), set(), set()
    for name, item in items:
        iw = fold(item)
        for p in [iw[k:k + window] for k in range(max(1, len(iw) - window + 1))] if iw else []:
            for k in range(len(ws) - len(p) + 1):
                if ws[k:k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    names.add(str(name))
    return len(ws), len(hit), sorted(names)


@pytest.mark.parametrize("block", [32 << 20, 60])
def test_decontamination_against_scan(spark, docs_of, block):
    random.seed(5)
    words = [f"w{k}" for k in range(30)] + ["Élan", "x9", "THE"]
    items = [(k, " ".join(random.choices(words, k=n))) for k, n in enumerate([1, 4, 12, 15, 0, 30])] + [(7, None), (2, "again w1 w2")]
    texts = [" ".join(random.choices(words, k=n)) for n in (0, 3, 50, 400)]
    texts += [f"{texts[2]}, {items[3][1].upper()}! {texts[1]}", items[5][1].replace(" ", "--") * 2, None, "ö" * 5000]
    docs = docs_of(list(enumerate(texts)), "spans")
    got = find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"), block_chars=block, shard_words=300, sample=3)
    for r in got.collect():
        assert (r.n_words, r.n_hit, r["items"]) == _plain_hits(r.text, items), r.doc_id
    clean = without_spans(got).select("doc_id", "text")
    again = find_contamination(clean, spark.createDataFrame([i for i in items if i[0] in (3, 5)], "item_id long, text string"))
    assert again.where("n_hit > 0").count() == 0


def test_nothing_to_search(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in find_contamination(docs_of([(1, "a b c")]), none).collect()] == [0]
    assert find_contamination(docs_of([]), none).count() == 0


# -- PII

MENTIONS = {"email": "Jo.98@Mail5.example.com", "phone": "+1 (504) 555-2652", "card": "4111 1111 1111 1111", "ip": "10.2.33.4",
            "ssn": "123-45-6789", "secret": "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "name": "Mrs. Anna SCHMIDT"}


@pytest.mark.parametrize("kind", MENTIONS)
def test_surrogates_keep_kind_and_format(kind):
    m = MENTIONS[kind]
    (a, b, found), = pii.find_entities(f"so {m}, then.")
    assert found == kind and b - a == len(m)
    new = pii.dressed(kind, m, pii.surrogate(kind, pii.entity(kind, m), b"k"))
    assert new != m and [x[2] for x in pii.find_entities(f"so {new}, then.")] == [kind]
    if kind not in ("name", "ip"):
        shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", s)))
        assert shape(new) == shape(m) or kind == "secret" and new.isupper()
    if kind == "card":
        assert pii._luhn(new.replace(" ", "")) == 0
    if kind == "name":
        given = new.split()[1]
        assert given in pii.GIVEN["latin", "f"] and new.split()[2].isupper()


def test_same_entity_same_surrogate_in_any_dress(docs_of, texts_by_id):
    docs = docs_of([(1, "call +1 (504) 555-2652 or jo.9@mail.example.com"), (2, "504-555-2652 JO.9@mail.example.com 504-555-2653"), (3, None), (4, ""), (None, "plain")])
    got = pii.replace_entities(docs, key=b"k")
    t = texts_by_id(got)
    phones = [re.sub(r"\D", "", x)[-10:] for x in (t[1][5:22], t[2][:12])]
    assert phones[0] == phones[1] != "5045552652" and t[3] is None and t[4] == "" and t[None] == "plain"
    assert t[2].split()[2] != t[2].split()[0] and t[1].split()[-1].lower() == t[2].split()[1].lower()
    assert texts_by_id(got, "n_replaced") == {1: 2, 2: 3, 3: 0, 4: 0, None: 0}
    assert pii.replace_entities(docs, key=b"other").where("doc_id = 1").first().text != t[1]


def test_addresses_with_little_to_change(docs_of, texts_by_id):
    """Dividers are no addresses; addresses with a host alone that collide are drawn again until they differ."""
    assert not pii.find_entities("x _@_._ y -@-.- z")
    assert all(pii.surrogate("email", f"_@{c}.com", b"k", n) != f"_@{c}.com" for c in "abcdefgh" for n in range(20))
    docs = docs_of([(k, f"{chr(97 + k)} _@{chr(97 + k)}.com") for k in range(9)] + [(20, "_@_._"), (21, "-@-.-")])
    got = texts_by_id(pii.replace_entities(docs, key=b"k"))
    new = {got[k].split()[1] for k in range(9)}
    assert len(new) == 9 and not new & {f"_@{chr(97 + k)}.com" for k in range(9)}
    assert got[20] == "_@_._" and got[21] == "-@-.-"


def test_collisions_are_settled(docs_of, monkeypatch):
    """With one-digit freedom first surrogates collide; after the rounds all differ, and none is an original."""
    docs = docs_of([(k, f"ip 1.2.3.{k}") for k in range(40)])
    real = pii.surrogate
    rows = pii.checked_attempts(docs, text_col="text", key=b"k")
    given = {(r.kind, r.plain): r.attempt for r in rows.collect()}
    new = [real("ip", f"1.2.3.{k}", b"k", given.get(("ip", f"1.2.3.{k}"), 0)) for k in range(40)]
    assert len(set(new)) == 40 and not set(new) & {f"1.2.3.{k}" for k in range(40)}
    names = docs_of([(k, f"Herr Hans {chr(65 + k % 26)}x{'y' * (k // 26)}") for k in range(60)])
    got = pii.replace_entities(names, key=b"k").select(F.regexp_extract("text", "Herr (.*)", 1).alias("n"))
    assert got.distinct().count() == 60

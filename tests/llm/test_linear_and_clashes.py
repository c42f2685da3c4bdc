"""Detection time on long texts, dresses of unusual letters, and pipeline stages on tables with clashing columns and odd rows."""

import time

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from skygrid.llm.common import written
from skygrid.llm.pii_surrogates import PATTERNS, dressed, entity, find_entities, replace_entities, surrogate

KEY = b"k"


def _overlap_by_overlap(text):
    """Every match of every kind against all taken before it."""
    import re

    taken = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            if kind == "name" and not m["family"][0].isupper():
                continue
            if all(m.end() <= a or m.start() >= b for a, b, _ in taken):
                taken.append((m.start(), m.end(), kind))
    return sorted(taken)


MIXED = ("Mail a.b+c@mail.example.org or _x@-y.z, call +1 415-555-0123, (020) 7946 0958, card 4111 1111 1111 1111, 10.0.0.255, "
         "Mrs Anna Smith and Пётр Иванов, DE89 3704 0044 0532 0130 00, 123-45-6789, " + "0a" * 20 + " x@y 1.2.3.4@host.de 192.168.0.1:80 ")


def test_detection_against_plain_version():
    for text in (MIXED, MIXED * 3, MIXED.replace(" ", ""), "", "@", "a@b.c" * 5, "Anna Smith@x.org 4111-1111-1111-1111@x.org"):
        assert find_entities(text) == _overlap_by_overlap(text)
    assert {k for _, _, k in find_entities(MIXED)} == set(PATTERNS)


@pytest.mark.parametrize("text", ["a" * 1_000_000 + " x@y.org", "_" * 1_000_000 + "@", "a@" * 500_000, "x@" + "y" * 1_000_000, "0a" * 500_000, "Anna " + "b" * 1_000_000 + "1",
                                  "1" * 1_000_000, "1-" * 500_000, "+" * 1_000_000, "9 " * 500_000, "." * 1_000_000])
def test_long_runs_take_linear_time(text):
    start = time.perf_counter()
    find_entities(text)
    assert time.perf_counter() - start < 5


def test_many_entities_take_linear_time():
    text = " ".join(f"u{k}@host{k % 97}.org 10.{k % 250}.{k % 199}.7" for k in range(100_000))
    start = time.perf_counter()
    assert len(find_entities(text)) == 200_000
    assert time.perf_counter() - start < 5


def test_unusual_letters_and_digits(docs_of):
    for mention in ("İx@a.com", "ẞtraße@ſ.de", "Ünïcode@ex-ämple.org"):
        plain = entity("email", mention)
        assert len(plain) == len(mention) == len(dressed("email", mention, surrogate("email", plain, KEY)))
    texts = ["call ٠٢٠ ٧٩٤٦ ٠٩٥٨ now", "İx@a.com and İY@a.com", "a" * 100_000 + "@b.org"]
    out = {r.doc_id: r for r in replace_entities(docs_of(list(enumerate(texts))), key=KEY).collect()}
    assert out[0].text == texts[0] and out[0].n_replaced == 0
    first, second = out[1].text.split(" and ")
    assert first != second and len(first) == len("İx@a.com") and first.endswith(".com") and out[2].n_replaced == 1


ADDED = ("score", "predicted", "held_out", "n_lines", "n_removed", "n_words", "n_hit", "items", "spans", "n_shingles", "component_id", "Score", "g", "id")


@pytest.fixture(scope="module")
def odd(spark):
    """Clean texts, repeated lines and rows, a benchmark passage, nulls, an empty and a very long text; every added name as a column."""
    good = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "a text without an id\nof two lines", "en", "s", 3), (9003, "word " * 300_000, "en", "s", 1)]
    docs = good.union(good.limit(20)).union(spark.createDataFrame(rows, good.schema))
    names = [c for c in ADDED if c.lower() not in {d.lower() for d in docs.columns}]
    seen, extra = set(), []
    for c in names:
        if c.lower() not in seen:
            seen.add(c.lower())
            extra.append(c)
    return docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in extra}), extra


def test_stages_touch_no_column_of_the_user(spark, sf_dir, odd):
    docs, extra = odd
    for name, stage in pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, sf_dir), f"odd-{name}")
        assert after.dtypes == docs.dtypes
        wrong = after.where(" or ".join(f"`{c}` <> concat('{c}-', coalesce(cast(doc_id as string), 'none'))" for c in extra))
        assert after.count() > 0 and wrong.count() == 0, name
        if name in ("line_dedup", "benchmark_decontamination"):
            assert after.where("n_chars <> length(text)").count() == 0
        docs = after
    assert pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0


def test_stages_on_an_empty_table(spark, sf_dir, odd):
    none = odd[0].where("false")
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name

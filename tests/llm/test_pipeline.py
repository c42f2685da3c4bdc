"""The pipeline's stages on the smallest table: every decision takes effect, nothing else changes."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from skygrid.llm.common import table, written
from skygrid.llm.decontamination import find_contamination
from skygrid.llm.quality_crf import score_quality
from skygrid.llm.set_join import similarity_components


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    steps = {"given": docs}
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        steps[name] = docs
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in steps.items() if n != "source_mixing"}
    assert all(steps[n].columns == steps["given"].columns for n in ids)

    scored = score_quality(steps["given"], table(spark, sf_dir, "labels"))
    assert ids["quality_classifier"] == {r.doc_id for r in scored.where("score >= 0.3").select("doc_id").collect()} != ids["given"]
    assert ids["line_dedup"] == ids["quality_classifier"]
    seen, before = set(), {r.doc_id: r for r in steps["quality_classifier"].collect()}
    after = {r.doc_id: r for r in steps["line_dedup"].collect()}
    for i in sorted(after):
        lines = before[i].text.split("\n")
        bare = [(k, x.strip()) for k, x in enumerate(lines) if x.strip()]
        gone = set()
        for k in range(len(bare) - 2):
            window = tuple(x for _, x in bare[k:k + 3])
            gone |= {p for p, _ in bare[k:k + 3]} if window in seen else set()
            seen.add(window)
        assert after[i].text == "\n".join(x for k, x in enumerate(lines) if k not in gone) and after[i].n_chars == len(after[i].text)

    groups = similarity_components(steps["line_dedup"])
    assert ids["jaccard_join"] == {r.component_id for r in groups.collect()}
    clean = steps["benchmark_decontamination"]
    assert ids["benchmark_decontamination"] == ids["jaccard_join"]
    hit = find_contamination(steps["jaccard_join"], table(spark, sf_dir, "benchmark"))
    assert {r.doc_id for r in hit.where("n_hit > 0").collect()} == {
        r.doc_id for r in clean.join(steps["jaccard_join"].select("doc_id", F.col("text").alias("old")), "doc_id").where("text <> old").collect()} != set()

    texts = {r.doc_id: r.text for r in clean.collect()}
    mixed = docs.collect()
    assert sum(r.n_words for r in mixed) > 0.9 * sum(len(t.split()) for t in texts.values())
    assert all(set(r.text.split(" ")) <= set().union(*(texts[i].split() for i in r.doc_ids)) for r in mixed)

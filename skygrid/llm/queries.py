"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygrid.llm import check_sql
from skygrid.llm.chat_events import chat_events, digest_conversations, fold_events, render
from skygrid.llm.common import table, written
from skygrid.llm.decontamination import find_contamination
from skygrid.llm.divergence_rules import judge_by_distribution
from skygrid.llm.line_windows import remove_repeated_windows
from skygrid.llm.lm_difference import score_difference
from skygrid.llm.merkle_manifest import digest, encoded, folded, hex_text, merkle_manifest, proof_digest
from skygrid.llm.periodic_runs import collapse_runs
from skygrid.llm.pii_surrogates import replace_entities
from skygrid.llm.quality_crf import score_quality
from skygrid.llm.registry import query
from skygrid.llm.set_join import similarity_components
from skygrid.llm.simhash_ball import simhash_components
from skygrid.llm.source_mixing import mix_sources
from skygrid.llm.warc import CRLF, assemble_captures, read_archives, write_archives
from skygrid.session import shared_dir


@query("op9_benchmark_decontamination", check_sql.OP9)
def op9(spark, sf_dir):
    """Hit words and items of every document, by FM-index search of the whole benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op2_line_windows", check_sql.OP2)
def op2(spark, sf_dir):
    """Texts without the later occurrences of repeated three-line windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_windows(docs).select("doc_id", "text", "n_lines", "n_removed")


@query("op5_divergence_rules")
def op5(spark, sf_dir):
    """Plain counts and the verdict by distance from the language references, of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge_by_distribution(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance")


@query("op6_quality_crf")
def op6(spark, sf_dir):
    """Quality of every document from the marginals of its lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op7_source_mixing")
def op7(spark, sf_dir):
    """Words that the mixture takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


@query("op3_warc_transactions", check_sql.OP3)
def op3(spark, sf_dir):
    """Every page written to archives, read back and assembled from its request, response and metadata records."""
    path = shared_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    captures = assemble_captures(read_archives(spark, path))
    # All three records of a capture feed the row; its payload is digested where it is read and does not travel.
    parts = captures.select("record_id", "response.record_type", "response.refers_to", "response.sent_bytes", "response.sent_digest",
                            "response.payload_digest", "metadata.fields", "n_requests", "n_metadata",
                            F.substring_index("request.block", CRLF, 1).alias("request_line"))
    first = F.col("record_type") == "response"
    rows = written(parts.select(
        "record_id", F.col("fields")["pageId"].cast("long").alias("page_id"),
        F.when(first, F.col("sent_bytes")).otherwise(F.col("fields")["payloadBytes"].cast("long")).alias("payload_bytes"),
        F.when(first, F.col("sent_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.col("refers_to").alias("_to"), "request_line", "n_requests", "n_metadata"), "captures")
    # A revisit names the response's record; that record's page is looked up.
    named = rows.where("record_type = 'response'").groupBy(F.col("record_id").alias("_to")).agg(F.min("page_id").alias("refers_to"))
    return rows.join(named, "_to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                                  "request_line", "n_requests", "n_metadata")


@query("op8_chat_events", check_sql.OP8)
def op8(spark, sf_dir):
    """All conversations, and one full of control strings, as event logs folded, rendered, stored and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], rows.schema))
    return digest_conversations(written(render(fold_events(chat_events(rows))), "chat"))


@query("op10_set_join", check_sql.OP10)
def op10(spark, sf_dir):
    """Component of every document under links of five-word shingle sets."""
    return similarity_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op4_lm_difference")
def op4(spark, sf_dir):
    """Loss of every document under a model of documents of good quality less that under a model of all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return score_difference(docs, good).select("doc_id", "n_tokens", "target_loss", "background_loss", "loss_difference")


# A fixed key, so that runs agree; a real one is a secret of whoever runs the job.
PII_KEY = b"surrogate key of the registered query"


@query("op1_pii_surrogates")
def op1(spark, sf_dir):
    """Texts with keyed surrogates in place of personal data and secrets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, key=PII_KEY).select("doc_id", "text", "n_replaced", "entities")


@query("op11_merkle_manifest", check_sql.OP11)
def op11(spark, sf_dir):
    """Leaf, roots and proof of every document, and whether its (for some ids altered) row still gives the root."""
    docs = table(spark, sf_dir, "documents")
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [*row[:3], F.col("n_chars").cast("decimal(20,0)") + 1, row[4]]
    leaves = docs.select("doc_id", "lang", digest(encoded(*row)).alias("leaf"), F.when(altered, digest(encoded(*more))).alias("altered"))
    proofs = merkle_manifest(leaves, group_col="lang", order_cols=["doc_id"])
    again = proofs.withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("siblings"), F.col("path")))
    return again.select("doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), hex_text(F.col("root")).alias("root"),
                        proof_digest(F.col("siblings")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == hex_text(F.col("root"))).alias("verified"))


def _repeating(docs):
    """``docs``, where every tenth text (by CRC-32 of its id) repeats a stretch of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.withColumn("g", F.floor(h / 10)).withColumn(
        "w", F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[^ \\t-\\r]+"), F.lit(0))))
    d = d.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    d = d.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.expr("array_join(transform(w, (x, i) -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs", check_sql.OP12)
def op12(spark, sf_dir):
    """Runs of every document (some made to repeat), the longest one, and the text without repetitions."""
    docs = _repeating(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = collapse_runs(docs, least=12)
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.signum(y["length"] - x["length"]))
                              .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]))
                              .otherwise(F.signum(x["period"] - y["period"])).cast("int")), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
                                                   F.lit("\n")))
    return (found.withColumn("best", best).withColumn("lines", F.array_join(lines, ""))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2("lines", 256).alias("runs_sha256"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256")))


@query("op13_simhash_ball")
def op13(spark, sf_dir):
    """Fingerprint of every document and its component under links of at most four differing bits."""
    return simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")

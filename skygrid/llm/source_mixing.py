"""Mixing sources to target weights: fixed-length blocks, drawn counts per shard, permuted indexes. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygrid.llm.common import SPACE_RUN, n_words, written

BUCKET_ROWS = 2048
SLOTS_PER_TASK = 500_000
URN_CHUNK = 4096


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def sized(docs: DataFrame, *, id_col: str, text_col: str, source_col: str, seed: int, n_buckets: int, with_text: bool = False) -> DataFrame:
    """id, source, size in words, and a place in a fixed pseudorandom order: bucket first, then ``at``."""
    at = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    out = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), at.alias("at"),
                      *([F.col(text_col).alias("words")] if with_text else []))
    return out.withColumn("bucket", F.pmod("at", F.lit(n_buckets)))


def source_targets(buckets: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """One row a source: its words and blocks, its number in code point order (null last), and its target in words.

    The whole is shared by weight; where a share is over ``max_repeats`` times the source, the target stops there
    and the rest is shared again. Sources in order of that limit per weight stop in turn, so running sums decide at once.
    """
    every, limit = Window.partitionBy(), F.col("source_size") * max_repeats
    by_limit = Window.orderBy(F.col("_limit") / F.col("weight"), "source_no")
    return (buckets.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n_blocks").alias("source_blocks"))
            .withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod("source_no", F.lit(len(weights))) + 1).cast("double"))
            .withColumn("_limit", limit.cast("double"))
            .withColumn("_level", (F.sum("source_size").over(every)
                                   - F.coalesce(F.sum("_limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
                        / F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("_stops", F.col("_limit") <= F.col("_level") * F.col("weight"))
            .withColumn("_final", F.max(F.when(~F.col("_stops"), F.col("_level"))).over(every))
            .withColumn("target", F.when(F.col("_stops"), F.col("_limit")).otherwise(F.col("_final") * F.col("weight")))
            .drop("_limit", "_level", "_stops", "_final"))


def permuted(df: DataFrame, index: str, size: str, key: str, rounds: int = 12) -> DataFrame:
    """``index`` sent through a keyed permutation of 0 .. ``size`` - 1 (swap-or-not rounds: exact for any size, invertible)."""
    for r in range(rounds):
        df = df.withColumn("_other", F.pmod(F.pmod(F.xxhash64(F.col(key), F.lit(2 * r)), F.col(size)) - F.col(index), F.col(size)))
        df = df.withColumn(index, F.when(F.xxhash64(F.col(key), F.lit(2 * r + 1), F.greatest(index, "_other")).bitwiseAND(F.lit(1)) == 1,
                                         F.col("_other")).otherwise(F.col(index)))
    return df.drop("_other")


class Mix:
    """The plan of one mixture; see ``mix_sources``."""

    def __init__(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: Sequence[float] = (5.0, 2.0, 1.0), max_repeats: int = 3, block_words: int = 64,
                 shard_blocks: int = 4096, seed: int = 17):
        self.block_words, self.max_repeats, self.seed = block_words, max_repeats, seed
        names = dict(id_col=id_col, text_col=text_col, source_col=source_col, seed=seed)
        n_rows = docs.count()
        names["n_buckets"] = -(-n_rows // BUCKET_ROWS) or 1
        self.rows = written(sized(docs, **names), "mix-sizes")
        self.texts = lambda: sized(docs, **names, with_text=True)
        buckets = written(self.rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
                          .withColumn("n_blocks", F.ceil(F.col("words") / block_words)), "mix-buckets")
        self.sources = written(source_targets(buckets, weights, max_repeats), "mix-sources")
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        buckets = buckets.withColumn("first_block", F.coalesce(F.sum("n_blocks").over(before), F.lit(0)))
        self.buckets = written(buckets.join(self.sources, _same_source(buckets, self.sources)).drop(self.sources["source"])
                               .select("source", "bucket", "first_block", "source_no", "source_size", "target"), "mix-placed")
        # A slot brings a source's mean block, so its share of slots follows from its target and that mean.
        self.expected = F.col("target") * F.col("source_blocks") / F.col("source_size")
        total = self.sources.where("source_size > 0").agg(F.sum(self.expected)).first()[0] or 0.0
        self.n_shards = max(1, -(-int(total) // shard_blocks))
        self.slots_per_shard = max(1, round(total / self.n_shards)) if total else 0

    def packed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``row`` (a number in its bucket) and ``start`` (its first word among the words of the bucket)."""
        order = Window.partitionBy("source", "bucket").orderBy("at", "id", "size")
        rows = (rows.withColumn("row", F.row_number().over(order))
                .withColumn("start", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
        b = self.buckets
        return (rows.join(b, (rows["bucket"] == b["bucket"]) & rows["source"].eqNullSafe(b["source"]))
                .drop(b["bucket"]).drop(b["source"]))

    def pieces(self, packed: DataFrame) -> DataFrame:
        """One row for each block a document reaches into: ``block``, ``piece.skip`` (words of the document before it), ``piece.n``."""
        size = F.lit(self.block_words)
        step = F.transform(
            F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("size") - 1) / size)),
            lambda k: F.struct(k.alias("k"), F.greatest(k * size - F.col("start"), F.lit(0)).alias("skip"),
                               (F.least((k + 1) * size, F.col("start") + F.col("size")) - F.greatest(k * size, F.col("start"))).alias("n")))
        return (packed.where("size > 0").withColumn("piece", F.explode(step))
                .withColumn("block", F.col("first_block") + F.col("piece.k")))

    def draws(self) -> DataFrame:
        """How many slots each shard gives each source: a multinomial draw from what the shards before it have left.

        Every source owns as many places of one urn as the whole mixture expects of it. A keyed permutation deals the places to
        the slots of all shards, so a shard's counts have the spread of a draw and their sums over all shards are the expected ones.
        A source's places are made in chunks, so that none is one task.
        """
        total, every = max(self.n_shards * self.slots_per_shard, 1), Window.partitionBy()
        upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        owned = (self.sources.where("source_size > 0").withColumn("_share", self.expected / F.sum(self.expected).over(every))
                 .withColumn("_to", F.round(F.sum("_share").over(upto) * total).cast("long"))
                 .withColumn("_from", F.coalesce(F.lag("_to").over(Window.orderBy("source_no")), F.lit(0).cast("long")))
                 .where("_to > _from"))
        first = F.explode(F.sequence(F.col("_from"), F.col("_to") - 1, F.lit(URN_CHUNK).cast("long")))
        chunks = (owned.select("source_no", "source_blocks", "_to", first.alias("_first"))
                  .repartition(-(-total // SLOTS_PER_TASK) or 1, "_first"))
        places = chunks.select("source_no", "source_blocks", F.explode(F.sequence("_first", F.least(F.col("_first") + URN_CHUNK, "_to") - 1)).alias("_at"),
                               F.lit(total).cast("long").alias("_total"), F.xxhash64(F.lit(self.seed), F.lit("urn")).alias("_key"))
        return (permuted(places, "_at", "_total", "_key")
                .groupBy("source_no", "source_blocks", F.floor(F.col("_at") / F.lit(max(self.slots_per_shard, 1))).alias("shard"))
                .agg(F.count(F.lit(1)).alias("n_slots")))

    def slots(self) -> DataFrame:
        """source_no, shard, slot (a number in its source and shard), epoch, block."""
        before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        most = F.col("source_blocks") * self.max_repeats
        n_tasks = -(-self.n_shards * self.slots_per_shard // SLOTS_PER_TASK) or 1
        taken = (self.draws().withColumn("first", F.coalesce(F.sum("n_slots").over(before), F.lit(0)))
                 .withColumn("n_slots", F.least(F.col("n_slots"), most - F.col("first"))).where("n_slots > 0"))
        slots = (taken.repartition(n_tasks, "source_no", "shard").select("source_no", "source_blocks", "shard", "first",
                              F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_slots") - 1)).alias("slot"))
                 .withColumn("epoch", F.floor((F.col("first") + F.col("slot")) / F.col("source_blocks")))
                 .withColumn("block", F.pmod(F.col("first") + F.col("slot"), F.col("source_blocks")))
                 .withColumn("_key", F.xxhash64(F.lit(self.seed), "source_no", "epoch")))
        slots = permuted(slots, "block", "source_blocks", "_key").select("source_no", "shard", "slot", "epoch", "block")
        # Written down: a filter pushed through the rounds would write each of them out inside the next.
        return written(slots, "mix-slots")


def mix_sources(docs: DataFrame, **parameters) -> DataFrame:
    """Which words a mixture takes: one row for every document, id, source, size, source_size, target, taken.

    Texts are packed, in a pseudorandom order, into blocks of ``block_words`` words of one source (the last block
    of an order bucket may be shorter). Sources in code point order, null last, carry ``weights`` in turn; targets share all words by
    weight, none above ``max_repeats`` times its source. Each output shard draws its counts of sources, a source's slots
    run through pseudorandom permutations of its block numbers, one per epoch, and slots meet blocks in a join on
    the number. No source is ever one group: order buckets of about ``BUCKET_ROWS`` rows are packed apart.

    A null text has size 0; size 0 is taken 0 times. A null id is a document like others; so is a repeated row. An
    empty table gives no rows. Reruns agree: all randomness is hashing. Only id, text and source are read.
    """
    mix = Mix(docs, **parameters)
    packed = written(mix.packed(mix.rows), "mix-packed")
    key = ["source_no", "bucket", "row"]
    taken = (mix.pieces(packed).select(*key, "block", F.col("piece.n").alias("n")).join(mix.slots(), ["source_no", "block"])
             .groupBy(*key).agg(F.sum("n").alias("taken")))
    return (packed.join(taken, key, "left")
            .select("id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_blocks(docs: DataFrame, **parameters) -> DataFrame:
    """The mixture itself: shard, slot, source, epoch, block, doc_ids, n_words, text (words joined by a blank).

    Same plan and same cases as ``mix_sources``. Texts move twice: into their order bucket and to their block.
    """
    mix = Mix(docs, **parameters)
    words = F.split(F.regexp_replace("words", "^" + SPACE_RUN, ""), SPACE_RUN)
    packed = mix.packed(mix.texts()).withColumn("words", words)
    pieces = mix.pieces(packed).select(
        "source_no", "source", "block", "id", (F.col("start") + F.col("piece.skip")).alias("at"), F.col("piece.n").alias("n"),
        F.array_join(F.slice("words", (F.col("piece.skip") + 1).cast("int"), F.col("piece.n").cast("int")), " ").alias("text"))
    blocks = (pieces.groupBy("source_no", "block")
              .agg(F.first("source").alias("source"), F.sum("n").alias("n_words"),
                   F.sort_array(F.collect_list(F.struct("at", "id", "text"))).alias("p"))
              .select("source_no", "block", "source", "n_words", F.col("p.id").alias("doc_ids"), F.array_join("p.text", " ").alias("text")))
    return (mix.slots().join(blocks, ["source_no", "block"])
            .select("shard", "slot", "source", "epoch", "block", "doc_ids", "n_words", "text"))

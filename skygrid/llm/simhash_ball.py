"""SimHash near-duplicates by meeting in the middle: fingerprints meet at the variants within half the radius of both."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import raw, written
from skygrid.llm.components import components

U = np.uint64
BITS, HALF = 64, 2  # fingerprints of 64 bits; links differ in at most 2 * HALF of them
SEED = 42
PER_BUCKET = 512  # fingerprints that a bucket of the first round has on average, at most
MAX_VARIANTS = 2_000_000  # of a bucket held in memory; a larger one is dealt out again by more bits
MORE_BITS = 6
_CHUNK = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, width: int = 4) -> int:
    """Majority bits of the XXH64 of all ``width``-word shingles, repeats included; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    plain, k = b" ".join(words), min(width, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist()
    seen = np.zeros(BITS, np.int64)
    for at in range(0, len(first), _CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(plain[a:b], SEED) for a, b in zip(first[at:at + _CHUNK], last[at:at + _CHUNK])], "<u8")
        seen += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * seen > len(first)).tolist())


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """id and fp (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, width) for t in raw(batch, text_col)], U).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=[id_col, "fp"])

    kept = docs.select(id_col, text_col)
    return kept.mapInArrow(run, f"`{id_col}` {kept.schema[id_col].dataType.simpleString()}, fp long")


@lru_cache
def masks(n_bits: int, flips: int) -> tuple[int, ...]:
    """All words of ``n_bits`` with at most ``flips`` bits set."""
    return tuple(sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(range(n_bits), k))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flipped(start: Column, n_bits: int, flips: int) -> Column:
    return F.explode(F.array(*[start.bitwiseXOR(F.lit(_signed(m)).cast("long")) for m in masks(n_bits, flips)]))


def _dealt(fps: DataFrame, bits: int) -> DataFrame:
    """bucket, fp: a fingerprint goes to every bucket, named by the leading bits of a variant, that has a variant of it."""
    lead = F.shiftrightunsigned("fp", BITS - bits) if bits < BITS else F.col("fp")
    return fps.select(_flipped(lead, bits, HALF).alias("bucket"), "fp")


def _dealt_again(held: DataFrame, bits: int, was: int) -> DataFrame:
    """The same for buckets of fewer bits, ``was``; flips already spent on their leading bits are counted."""
    spent = F.bit_count(F.shiftrightunsigned("fp", BITS - was).bitwiseXOR(F.col("bucket")))
    lead = F.shiftrightunsigned("fp", BITS - bits) if bits < BITS else F.col("fp")
    # Leading bits of the bucket, and the fingerprint's own next ones.
    start = F.shiftleft("bucket", bits - was).bitwiseOR(lead.bitwiseAND(F.lit((1 << (bits - was)) - 1).cast("long")))
    parts = [held.where(spent == s).select(_flipped(start, bits - was, HALF - s).alias("bucket"), "fp") for s in range(HALF + 1)]
    return parts[0].union(parts[1]).union(parts[2])


def collisions(fp: np.ndarray, spent: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of fingerprints of one bucket that share a variant: each with the first one at the variant, without repeats."""
    rest = BITS - bits
    low = fp & U((1 << rest) - 1) if rest < BITS else fp
    value, owner = [], []
    for s in range(HALF + 1):
        who = np.flatnonzero(spent == s)
        flips = np.array(masks(rest, HALF - s), U)
        value.append((low[who][:, None] ^ flips).ravel())
        owner.append(np.repeat(who, len(flips)))
    value, owner = np.concatenate(value), np.concatenate(owner)
    order = np.argsort(value)
    value, owner = value[order], owner[order]
    new = np.append(True, value[1:] != value[:-1])
    first = owner[np.maximum.accumulate(np.where(new, np.arange(len(value)), 0))]
    pair = np.unique(first[~new] * len(fp) + owner[~new])
    a, b = pair // len(fp), pair % len(fp)
    near = np.bitwise_count(fp[a] ^ fp[b]) <= 2 * HALF
    return a[near], b[near]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs' components as pairs with the smallest place of each."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        now = now[now]
        if (now == root).all():
            break
        root = now
    member = np.flatnonzero(root != np.arange(n))
    return root[member], member


def _met(bits: int, max_variants: int):
    """Links inside buckets, which come sorted; a bucket with too many variants leaves as it came, to be dealt again."""
    load = np.array([len(masks(BITS - bits, HALF - s)) for s in range(HALF + 1)])
    names = ["a", "b", "bucket", "fp"]

    def rows(a=None, b=None, bucket=None, fp=None) -> pa.RecordBatch:
        n = len(a if a is not None else fp)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()) if c is None else pa.array(np.ascontiguousarray(c).view(np.int64), pa.int64()) for c in (a, b, bucket, fp)], names=names)

    def spent_of(fp: np.ndarray, bucket: np.uint64) -> np.ndarray:
        return np.bitwise_count((fp >> U(BITS - bits)) ^ bucket).astype(np.int64)

    def linked(key: np.uint64, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        fp = np.concatenate(held) if held else np.zeros(0, U)
        if len(fp) > 1:
            a, b = forest(*collisions(fp, spent_of(fp, key), bits), len(fp))
            if len(a):
                yield rows(a=fp[a], b=fp[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, variants = None, [], 0
        for batch in batches:
            bucket, fp = (batch.column(k).to_numpy(zero_copy_only=False).view(U) for k in (0, 1))
            edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)] if len(bucket) else []
            for s, e in zip(edges[:-1], edges[1:]):
                if key is None or bucket[s] != key:
                    yield from linked(key, held)
                    key, held, variants = bucket[s], [], 0
                held.append(fp[s:e].copy())
                variants += int(load[spent_of(held[-1], key)].sum())
                if variants > max_variants and bits < BITS:
                    late = np.concatenate(held)
                    yield rows(bucket=np.full(len(late), key), fp=late)
                    held = []
        yield from linked(key, held)

    return run


def ball_links(fps: DataFrame, *, n_fps: int, per_bucket: int = PER_BUCKET, max_variants: int = MAX_VARIANTS) -> DataFrame:
    """a, b: links that join all fingerprints (distinct longs, column fp) that differ in at most four bits.

    Two fingerprints that differ in four bits or fewer share a variant that is at most two flips from either. All 2,081 variants of
    every fingerprint meet, but a variant is named in two parts: the shuffle is on its leading bits, to which a
    fingerprint is sent once for each way to flip them, and the rest is spelled out where it arrives. Fingerprints that meet
    at a variant are verified and leave as links with the smallest place of their bucket's component.

    Leading bits grow with the logarithm of the number of fingerprints. A bucket that would hold more than ``max_variants``
    variants, as under a large group of near copies, is dealt out again by more leading bits, at last by whole variants, at which no
    more than 2,081 fingerprints can meet. Nothing is dropped.
    """
    spark = fps.sparkSession
    bits = min(max((n_fps // per_bucket).bit_length(), 1), 24)
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt, links = _dealt(fps, bits), None
    while True:
        met = written(dealt.repartition(max(at_least, (1 << bits) // 8 if links is None else 0), "bucket").sortWithinPartitions("bucket")
                      .mapInArrow(_met(bits, max_variants), "a long, b long, bucket long, fp long"), "ball-links")
        found = met.where("a is not null").select("a", "b")
        links = found if links is None else links.union(found)
        late = met.where("fp is not null").select("bucket", "fp")
        if bits == BITS or late.isEmpty():
            return links
        was, bits = bits, min(bits + MORE_BITS, BITS)
        dealt = _dealt_again(late, bits, was)


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of every row: the smallest id reached by links, itself included.

    Fingerprints are of words in lower case (A-Z only) between ASCII white space. Equal fingerprints are one node, which is
    linked with all nodes that differ in four bits or fewer. Null and empty texts have fingerprint zero and are linked like any other.
    A row of null id is a node like any other, links others, and names no component but one of null ids only (null). Rows that
    share an id are rows of their own. Only id and text are read. Any number of rows may share a fingerprint: the most
    frequent ones (at most a thousand, by their share) are broadcast for the last join, the others are joined by shuffle.
    """
    facts = written(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "fingerprints")
    nodes = written(facts.groupBy("fp").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    size = nodes.agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("rows")).first()
    roots = components(ball_links(nodes.select("fp"), n_fps=size["nodes"]), "ball-groups")
    home = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = home.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = written(home.select("fp", "root", "n").join(named, "root").select("fp", "n", "component_id"), "fingerprint-groups")
    often = F.broadcast(of_fp.where(F.col("n") * 1000 > (size["rows"] or 0)).drop("n"))
    out = facts.join(often, "fp").unionByName(facts.join(often.select("fp"), "fp", "left_anti").join(of_fp.drop("n"), "fp"))
    return out.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

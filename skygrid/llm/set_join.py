"""N-gram Jaccard join: exact prefix-filtered self-join of shingle sets with index-level and answer-level skipping."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skygrid.llm.common import passing, raw, spot, spot_filter, written
from skygrid.llm.components import components

U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.random.default_rng(20240607).integers(1, 2**63, 64, dtype=np.int64).astype(U) * U(2) + U(1)
KEYS, ROWS_PER_KEY = 6, 2
KEY_BITS, FILTER_SHIFT = 32, 5
MAX_HEAVY = 1_000_000  # bound of the collected list of frequent shingles
LONGEST_RUN = 64
LONG_WORD = 64
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
SLICE = 4 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts end to end, A-Z lowered, and how many each text has.

    Words are read eight bytes at a time, all words at once; the few beyond ``LONG_WORD`` bytes are hashed one by one.
    """
    joined = (b" " + b" ".join(texts)).translate(_LOWER) + b" " * 8
    data = np.frombuffer(joined, np.uint8)
    space = (data == 32) | (data - np.uint8(9) < 5)
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, size = change[::2], change[1::2] - change[::2]
    eight = np.ndarray(data.size - 7, "<u8", joined, strides=(1,))
    h = mixed((eight[start] & _BYTES[np.minimum(size, 8)]) ^ (size.astype(U) * _STEP))
    for k in range(8, LONG_WORD, 8):
        more = np.flatnonzero(size > k)
        if not more.size:
            break
        h[more] = mixed(h[more] * _STEP ^ (eight[start[more] + k] & _BYTES[np.minimum(size[more] - k, 8)]))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(joined[start[i]:start[i] + size[i]])
    after = np.cumsum([0] + [len(t) + 1 for t in texts])
    return h, np.diff(np.searchsorted(start, after + 1))


def shingle_sets(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of all texts end to end, sorted and distinct in each, and the edges between texts.

    Of fewer words than ``width`` the whole sequence is one shingle. Everything but sorting is done for all texts at
    once: a text has some hundred words, too few for array operations of its own.
    """
    h, n = word_hashes(texts)
    count = np.where(n > 0, np.maximum(n - width, 0) + 1, 0)
    begin, edge = np.cumsum(n) - n, np.r_[0, np.cumsum(count)]
    v, padded = np.full(h.size, width, U), np.r_[h, np.zeros(width, U)]
    for j in range(width):
        v = v * _STEP + padded[j:j + h.size]
    flat = v[np.repeat(begin - edge[:-1], count) + np.arange(edge[-1])]
    for i in np.flatnonzero((n > 0) & (n < width)):
        whole = n[i:i + 1].astype(U)
        for x in h[begin[i]:begin[i] + n[i]]:
            whole = whole * _STEP + x
        flat[edge[i]] = whole[0]
    flat = mixed(flat)
    ends = edge.tolist()
    for i in np.flatnonzero(count > 1).tolist():
        flat[ends[i]:ends[i + 1]].sort()
    new = np.ones(flat.size, bool)
    new[1:] = flat[1:] != flat[:-1]
    new[edge[:-1][count > 0]] = True
    return flat[new], np.r_[0, np.cumsum(new)][edge]


def classes_of(flat: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The class of each (not empty) set: equal sets share it, others but for an accident of 64 bits do not."""
    return np.add.reduceat(mixed(flat + _ODD[60]), edge[:-1])


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U).view(np.int64), pa.int64())


def _cut(sizes: list[int]) -> Iterator[slice]:
    """Ranges of texts of about ``SLICE`` bytes; a longer text is one of its own."""
    start = full = 0
    for k, size in enumerate(sizes):
        if full and full + size > SLICE:
            yield slice(start, k)
            start, full = k, 0
        full += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def _describe(text_col: str, width: int, shared):
    """Class, size, minhash keys, and how many shingles are not frequent: few in the most typical set of a group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = shared.value
        for batch in batches:
            texts = raw(batch, text_col)
            for part in _cut([len(t) for t in texts]):
                flat, edge = shingle_sets(texts[part], width)
                n = np.diff(edge)
                some = n > 0
                first = edge[:-1][some]
                g, own, keys = np.zeros(n.size, np.int64), np.zeros(n.size, np.int64), np.zeros((0, KEYS), U)
                if flat.size:
                    g[some] = classes_of(flat, np.r_[first, flat.size]).view(np.int64)
                    own[some] = np.add.reduceat((freq.levels(flat) == 0).astype(np.int64), first)
                    low = [np.minimum.reduceat(flat * odd, first) for odd in _ODD[:KEYS * ROWS_PER_KEY]]
                    keys = np.stack([mixed(low[2 * k] * _ODD[40] + low[2 * k + 1] + U(k)) for k in range(KEYS)], 1)
                offsets = np.r_[0, np.cumsum(some) * KEYS].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(g, mask=~some), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(offsets), _long(keys.ravel()), mask=pa.array(~some)), pa.array(own, mask=~some)],
                    ["doc_id", "g", "n", "keys", "own"])

    return run


def _slices(batches: Iterator[pa.RecordBatch], text_col: str, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle sets of some texts at a time, none of them empty; each text of a task only once."""
    seen = set()
    for batch in batches:
        texts = []
        for text in raw(batch, text_col):
            mark = xxhash.xxh3_128_digest(text)
            if mark not in seen:
                seen.add(mark)
                texts.append(text)
        for part in _cut([len(t) for t in texts]):
            flat, edge = shingle_sets(texts[part], width)
            if flat.size:
                yield flat, np.r_[edge[:-1][np.diff(edge) > 0], flat.size]


def _shingle_keys(text_col: str, width: int, parts: int):
    """Leading bits of all shingles, sorted and cut by range: one row for each range and slice of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, _ in _slices(batches, text_col, width):
            keys = (flat >> U(64 - KEY_BITS)).astype(np.uint32)
            keys.sort()
            part = (keys.astype(U) * U(parts)) >> U(KEY_BITS)
            edge = np.searchsorted(part, np.arange(parts + 1).astype(U))
            rows = [(p, keys[edge[p]:edge[p + 1]].tobytes()) for p in range(parts) if edge[p] < edge[p + 1]]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                                             ["part", "keys"])

    return run


def _count_keys(least: int, parts: int):
    """Of each range: keys of at least ``least`` sets, and one row (n = 0) with the bits of keys that more than one set has."""
    spots = (1 << (KEY_BITS - FILTER_SHIFT)) // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for p, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(p, []).append(np.frombuffer(k, np.uint32))
        for p, own in held.items():
            key, n = np.unique(np.concatenate(own), return_counts=True)
            heavy, bits = n >= least, np.zeros(spots, bool)
            bits[(key[n > 1] >> FILTER_SHIFT).astype(np.int64) - p * spots] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[0, n[heavy]], pa.int64()), pa.array(np.r_[p, key[heavy].astype(np.int64)], pa.int64()),
                                              pa.array([np.packbits(bits, bitorder="little").tobytes()] + [None] * int(heavy.sum()), pa.binary())],
                                             ["n", "key", "bits"])

    return run


class Frequencies:
    """What ordering and pruning need of the counts; bounded by ``MAX_HEAVY`` and by the filter's 2**27 bits."""

    def __init__(self, heavy: list[tuple[int, int]], bits: list[tuple[int, bytes]]):
        heavy.sort()
        self.heavy = np.array([k for k, _ in heavy], U)
        self.level = np.log2(np.array([n for _, n in heavy], np.float64)).astype(U)
        self.filter = np.zeros(1 << (KEY_BITS - FILTER_SHIFT - 3), np.uint8)
        for part, data in bits:
            self.filter[part * len(data):(part + 1) * len(data)] = np.frombuffer(data, np.uint8)

    def levels(self, s: np.ndarray) -> np.ndarray:
        """Logarithm of each shingle's count where it is frequent, else 0."""
        if not self.heavy.size:
            return np.zeros(len(s), U)
        key = s >> U(64 - KEY_BITS)
        at = np.minimum(np.searchsorted(self.heavy, key), self.heavy.size - 1)
        return np.where(self.heavy[at] == key, self.level[at], U(0))

    def prefixes(self, flat: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shingles of the probing prefixes, rare first, that another set may have; the sets they are of, and their places in that order."""
        n, level = np.diff(edge), self.levels(flat)
        of = np.repeat(np.arange(n.size), n)
        place = np.arange(flat.size) - edge[of]
        order = np.argsort(of * 64 + level.astype(np.int64), kind="stable") if level.any() else np.arange(flat.size)
        inside = place < (n - -(-4 * n // 5) + 1)[of]
        token, of, place = flat[order[inside]], of[inside], place[inside]
        spot = token >> U(64 - KEY_BITS + FILTER_SHIFT)
        shared = (self.filter[(spot >> U(3)).astype(np.int64)] >> (spot & U(7)).astype(np.uint8)) & 1 == 1
        return token[shared], of[shared], place[shared]


def _frequencies(docs: DataFrame, text_col: str, width: int, n_shingles: int) -> Frequencies:
    """Counts of all shingles by their leading bits, each text of a task once."""
    parts = 64
    while parts * 4_000_000 < n_shingles and parts < 1 << 20:
        parts *= 2
    counted = written(docs.select(text_col).mapInArrow(_shingle_keys(text_col, width, parts), "part long, keys binary").repartition(parts, "part")
                      .mapInArrow(_count_keys(16, parts), "n long, key long, bits binary"), "shingle-counts")
    level = F.floor(F.log2("n")).cast("int")
    by_level = {r[0]: r[1] for r in counted.where("n > 0").groupBy(level.alias("level")).count().collect()}
    least = next(k for k in range(4, 99) if sum(v for x, v in by_level.items() if x >= k) <= MAX_HEAVY)
    top = [(r[0], r[1]) for r in counted.where(F.col("n") >= 2**least).select("key", "n").toLocalIterator()]
    return Frequencies(top, [(r[0], bytes(r[1])) for r in counted.where("n = 0").select("key", "bits").toLocalIterator()])


def _tokens(text_col: str, width: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = shared.value
        for flat, edge in _slices(batches, text_col, width):
            token, of, place = freq.prefixes(flat, edge)
            yield pa.RecordBatch.from_arrays([_long(token), _long(classes_of(flat, edge)[of]), pa.array((np.diff(edge)[of] << 32) + place)],
                                             ["token", "g", "at"])

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    held = list(batches)
    if not held:
        return {}
    return {c: pa.concat_arrays([b.column(k) for b in held]).to_numpy(zero_copy_only=False) for k, c in enumerate(held[0].schema.names)}


def _shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index lists of at least two different sets, each set once."""
    x = _whole(batches)
    if x:
        by = np.lexsort((x["at"], x["g"], x["token"]))
        t, g, at = x["token"][by], x["g"][by], x["at"][by]
        new = np.r_[True, (t[1:] != t[:-1]) | (g[1:] != g[:-1])] if t.size else np.zeros(0, bool)
        t, g, at = t[new], g[new], at[new]
        keep = np.zeros(t.size, bool)
        if t.size:
            same = t[1:] == t[:-1]
            keep[1:] |= same
            keep[:-1] |= same
        yield pa.RecordBatch.from_arrays([pa.array(v[keep], pa.int64()) for v in (t, g, at)], ["token", "g", "at"])


def _possible(na, pa_, nb, pb):
    """Size and position filters: what follows the shared shingle must suffice for 0.8."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    return (5 * small >= 4 * large) & (9 * np.minimum(na - pa_, nb - pb) >= 4 * (na + nb))


def candidate_pairs(token: np.ndarray, root: np.ndarray, g: np.ndarray, n: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places whose sets share a prefix shingle, pass the filters and are not known to be connected.

    Short lists are compared entry by entry. Long ones are cut into blocks in order of (root, size, position), and a pair of blocks
    is skipped whole when its largest remainders, its sizes or a common root rule out every pair in it.
    """
    edge = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True]) if token.size else np.zeros(1, int)
    length = np.diff(edge)
    short = np.repeat(length <= LONGEST_RUN, length)
    s = np.flatnonzero(short)
    for step in range(1, LONGEST_RUN):
        if step >= s.size:
            break
        a, b = s[:-step], s[step:]
        same = token[a] == token[b]
        if not same.any():
            break
        a, b = a[same], b[same]
        ok = (root[a] != root[b]) & _possible(n[a], place[a], n[b], place[b])
        if ok.any():
            yield a[ok], b[ok]
    for r in np.flatnonzero(length > LONGEST_RUN):
        at = np.arange(edge[r], edge[r + 1])
        cut = np.arange(0, at.size, LONGEST_RUN)
        low, high = np.minimum.reduceat(n[at], cut), np.maximum.reduceat(n[at], cut)
        left = np.maximum.reduceat(n[at] - place[at], cut)
        first, last = root[at][cut], root[at][np.r_[cut[1:], at.size] - 1]
        for i in range(cut.size):
            j = np.arange(i, cut.size)
            useful = ((9 * np.minimum(left[i], left[j]) >= 4 * (low[i] + low[j])) & (5 * high[i] >= 4 * low[j]) & (5 * high[j] >= 4 * low[i])
                      & ~((first[i] == last[i]) & (first[j] == last[j]) & (first[i] == first[j])))
            for k in j[useful]:
                x, y = at[cut[i]:cut[i] + LONGEST_RUN], at[cut[k]:cut[k] + LONGEST_RUN]
                a, b = np.repeat(x, y.size), np.tile(y, x.size)
                ok = (a < b) & (root[a] != root[b]) & _possible(n[a], place[a], n[b], place[b])
                if ok.any():
                    yield a[ok], b[ok]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    x = _whole(batches)
    if not x:
        return
    n, place = x["at"] >> 32, x["at"] & 0xFFFFFFFF
    by = np.lexsort((place, n, x["root"], x["token"]))
    token, root, g, n, place = x["token"][by], x["root"][by], x["g"][by], n[by], place[by]
    for a, b in candidate_pairs(token, root, g, n, place):
        lo, hi = np.minimum(g[a], g[b]), np.maximum(g[a], g[b])
        pair = np.unique(np.stack([lo, hi], 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0], pa.int64()), pa.array(pair[:, 1], pa.int64())], ["a", "b"])


def _sets(text_col: str, width: int, shared):
    """Sets of the documents whose id may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = (passing(batch, "spot", shared.value) for batch in batches)
        for flat, edge in _slices(wanted, text_col, width):
            yield pa.RecordBatch.from_arrays([_long(classes_of(flat, edge)), pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), _long(flat))],
                                             ["g", "shingles"])

    return run


_NO_ID = 2**63 - 1


def _id_of(column: str):
    return F.coalesce(F.col(column).cast("long"), F.lit(_NO_ID))


def _fetch_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """g, shingles of the representatives named by ``wanted`` (column first_id), and of a few others.

    The names meet in a filter of fixed size, which the texts pass on their way; no text is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spot_filter(wanted, "first_id"))
    return written(docs.select(text_col, spot(_id_of(id_col)).alias("spot"))
                   .mapInArrow(_sets(text_col, width, shared), "g long, shingles array<long>"), "shingle-sets")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with both sizes and the exact overlap. The many-to-one side comes second, so its sets are not moved again."""
    met = (pairs.join(sets.withColumnRenamed("g", "a").withColumnRenamed("shingles", "sa"), "a")
           .join(sets.withColumnRenamed("g", "b").withColumnRenamed("shingles", "sb"), "b"))
    return met.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("both"))


LINK = "100 * both >= 80 * (na + nb - both)"


def similarity_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """id, n_shingles and component_id of every row (smallest id reached by links of Jaccard 0.8 or more, itself included).

    1. A count of all shingles gives the frequent ones, which come last in the prefix order, and a filter of those that occur
    twice. 2. Equal sets are one class, known by a 64-bit sum over its shingles. 3. Classes that share one of a few minhash keys
    are compared with the key's leader, its most typical class, and the links found are joined into first groups. 4. Prefix
    shingles that may be shared meet by shingle; lists skip blocks by position and size, and pairs already connected (a set's answers follow from
    those of its group). 5. What is left goes first through the leaders: the overlap of two leaders bounds that of their
    members, and only pairs the bounds leave open are compared in full. All links between different groups are found.

    Nulls and empty texts have no shingles and are linked with nothing. A null id counts as larger than any other; a component of
    null ids only has a null id. Rows that share an id are rows of their own. Only id and text are read.
    """
    base = docs.select(id_col, text_col)
    total = (base.agg(F.sum(F.length(text_col))).first()[0] or 0) // 4  # no fewer than there are shingles in most languages
    freq = base.sparkSession.sparkContext.broadcast(_frequencies(base, text_col, width, total))
    facts = written(base.select(_id_of(id_col).alias("doc_id"), text_col).mapInArrow(
        _describe(text_col, width, freq), "doc_id long, g long, n long, keys array<long>, own long"), "shingle-facts")
    classes = written(facts.where("n > 0").groupBy("g").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("keys").alias("keys"),
                                                            F.first("own").alias("own")), "classes")

    # Leaders: of each key the class with the fewest shingles of its own; each class is compared with its leaders.
    keyed = classes.select("g", "own", F.explode("keys").alias("key"))
    leads = (keyed.groupBy("key").agg(F.min(F.struct("own", "g")).alias("lead"), F.count(F.lit(1)).alias("many"))
             .where("many > 1").select("key", F.col("lead.g").alias("b")))
    stars = written(keyed.join(leads, "key").where("g <> b").select(F.col("g").alias("a"), "b").distinct(), "stars")
    named = lambda pairs: pairs.select(F.col("a").alias("g")).union(pairs.select("b")).distinct().join(classes.select("g", "first_id"), "g")
    star_sets = _fetch_sets(base, named(stars), id_col, text_col, width)
    star_links = written(_linked(stars, star_sets).where(LINK), "star-links")
    groups = written(components(star_links.select("a", "b"), "first-groups"), "first-groups")

    # Prefix index over all classes.
    n_parts = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total * 0.2 / 2_000_000) + 1)
    lists = written(base.select(text_col).mapInArrow(_tokens(text_col, width, freq), "token long, g long, at long")
                    .repartition(n_parts, "token").mapInArrow(_shared_lists, "token long, g long, at long"), "shared-lists")
    rooted = (lists.join(groups.withColumnRenamed("node", "g"), "g", "left").withColumn("root", F.coalesce("root", "g"))
              .select("token", "root", "g", "at"))
    cross = written(rooted.repartition(n_parts, "token").mapInArrow(_pairs, "a long, b long").distinct(), "cross-pairs")

    # Answers of members follow from those of leaders as far as bounds reach.
    lead = (star_links.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("both"), "b"))).where("r = 1")
            .select(F.col("a").alias("g"), F.col("b").alias("lead"), (F.col("na") - F.col("both")).alias("more"), (F.col("nb") - F.col("both")).alias("less")))
    side = lambda x: (classes.select(F.col("g").alias(x), F.col("n").alias(f"n{x}"))
                      .join(lead.select(F.col("g").alias(x), F.col("lead").alias(f"l{x}"), F.col("more").alias(f"more_{x}"), F.col("less").alias(f"less_{x}")), x, "left")
                      .select(x, f"n{x}", F.coalesce(f"l{x}", x).alias(f"l{x}"), F.coalesce(f"more_{x}", F.lit(0)).alias(f"more_{x}"),
                              F.coalesce(f"less_{x}", F.lit(0)).alias(f"less_{x}")))
    pairs = written(cross.join(side("a"), "a").join(side("b"), "b"), "placed-pairs")
    leaders = pairs.where("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    known = leaders.union(pairs.select("a", "b")).distinct()
    sets = _fetch_sets(base, named(known), id_col, text_col, width)
    answers = _linked(leaders, sets).select(F.col("a").alias("la"), F.col("b").alias("lb"), F.col("both").alias("lead_both"))
    bounded = (pairs.join(answers, ["la", "lb"], "left")
               .withColumn("most", F.col("lead_both") + F.col("more_a") + F.col("more_b")).withColumn("least", F.col("lead_both") - F.col("less_a") - F.col("less_b")))
    bounded = written(bounded.withColumn("sure", F.coalesce(F.expr("100 * least >= 80 * (na + nb - least)"), F.lit(False)))
                      .where("most is null or 100 * most >= 80 * (na + nb - most)").select("a", "b", "sure"), "bounded-pairs")
    exact = _linked(bounded.where("not sure").select("a", "b"), sets).where(LINK).select("a", "b")
    links = bounded.where("sure").select("a", "b").union(exact).union(groups.select(F.col("node").alias("a"), F.col("root").alias("b")))

    roots = components(links, "set-groups")
    home = classes.select("g", "first_id").join(roots.withColumnRenamed("node", "g"), "g", "left").withColumn("root", F.coalesce("root", "g"))
    named_root = home.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = home.select("g", "root").join(named_root, "root").select("g", "component_id")
    out = facts.select("doc_id", "g", "n").join(of_class, "g", "left")
    return out.select(F.nullif("doc_id", F.lit(_NO_ID)).alias(id_col), F.col("n").alias("n_shingles"),
                      F.nullif(F.coalesce("component_id", "doc_id"), F.lit(_NO_ID)).alias("component_id"))

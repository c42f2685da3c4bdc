"""LM scoring: per-token loss under a target model less that under a matched background model."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skygrid.llm.common import raw, without, written

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
UNKNOWN, START, END = 0, 1, 2
FIELDS = "n_tokens long, target_loss double, background_loss double, loss_difference double"
BACKGROUND, TARGET = 0, 1


@dataclass(frozen=True)
class ModelSize:
    """Smoothing of both models and what they hold. All counts are exact and grow with the corpus; ``words`` is a limit of the
    vocabulary that a caller may set. ``cells`` belonged to hashed pair counts and has no effect."""

    words: int | None = None
    cells: int | None = None
    pair_weight: float = 0.7
    add: float = 0.5
    min_count: int = 2
    # Shares of the work, whatever the corpus: bytes of text in a block, tokens whose words or pairs (each once a block) are in a bucket.
    block_bytes: int = 8 << 20
    bucket_tokens: int = 1_500_000


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


_CODEC = pa.Codec("zstd", compression_level=1)


def _pack(*columns: np.ndarray, plain: int = 0) -> bytes:
    """Columns of numbers by byte, all lowest bytes first: the high ones are mostly zero. The lowest ``plain`` bytes of the first
    column look random and are left as they are."""
    width = [(int(c.max(initial=0)).bit_length() + 7) // 8 for c in columns]
    by_byte = [np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for c, w in zip(columns, width)]
    data, low = b"".join(by_byte), min(plain, width[0]) * len(columns[0])
    return len(columns[0]).to_bytes(4, "little") + bytes(width) + data[:low] + (_CODEC.compress(data[low:], asbytes=True) if len(data) > low else b"")


def _unpack(packed: bytes, columns: int = 1, plain: int = 0) -> list[np.ndarray]:
    n, width = int.from_bytes(packed[:4], "little"), packed[4:4 + columns]
    low, size, start = min(plain, width[0]) * n, sum(width) * n, 4 + columns
    data = packed[start:start + low] + (_CODEC.decompress(packed[start + low:], size - low, asbytes=True) if size > low else b"")
    out, at = np.zeros((columns, n, 8), np.uint8), 0
    for k, w in enumerate(width):
        out[k, :, :w] = np.frombuffer(data, np.uint8, w * n, at).reshape(w, n).T
        at += w * n
    return list(out.view("<i8")[:, :, 0])


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs with the places of its members, in order."""
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if part.size:
            yield int(bucket[part[0]]), part


def _word_bucket(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def _folded(x: np.ndarray) -> np.ndarray:
    """Whole numbers without a sign: 0, -1, 1, -2 as 0, 1, 2, 3."""
    return np.where(x < 0, -2 * x - 1, 2 * x)


def _unfolded(x: np.ndarray) -> np.ndarray:
    return (x >> 1) ^ -(x & 1)


@dataclass(frozen=True)
class PairKeys:
    """Pairs of vocabulary numbers as scattered numbers, no two alike, dealt to ``buckets`` in their order.

    A block's keys in a bucket lie as close as all its keys do, however many buckets there are: so their differences take no more room
    when a larger corpus needs more buckets. Numbers below 2**common, those of frequent words, take that many bits, others ``bits``: a
    pair is of one of four kinds, told by the highest two bits of its key, and scattered over the room of its kind."""

    bits: int
    common: int
    buckets: int

    @classmethod
    def of(cls, largest: int, word_buckets: int, buckets: int) -> PairKeys:
        bits = largest.bit_length()
        if bits > 32:
            raise ValueError("more words than 32 bits can number")
        # Every bucket of words numbers its most frequent first. Numbers of 32 bits leave no room for a kind: all are of the first.
        return cls(max(2, bits), bits if bits == 32 else min(max(2, bits), max(12, (4 * word_buckets).bit_length())), buckets)

    def _width(self, kind: np.ndarray) -> np.ndarray:
        return np.array([2 * self.common, self.common + self.bits, self.bits + self.common, 2 * self.bits], np.uint64)[kind]

    def keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        kind = 2 * (first >> self.common > 0) + (second >> self.common > 0)
        width = self._width(kind)
        mask = (np.uint64(1) << width) - np.uint64(1)
        x = (first.astype(np.uint64) << np.where(kind & 1, self.bits, self.common).astype(np.uint64)) | second.astype(np.uint64)
        # Multiplied by odd numbers and folded: each step can be undone, so different pairs stay different.
        x = (x * np.uint64(0xBF58476D1CE4E5B9)) & mask
        return (kind.astype(np.uint64) << np.uint64(62)) | (((x ^ (x >> (width >> np.uint64(1)))) * np.uint64(0x94D049BB133111EB)) & mask)

    def kinds(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(62)).astype(np.int64) if self.common < self.bits else np.zeros(keys.size, np.int64)

    def _within(self, keys: np.ndarray) -> np.ndarray:
        return keys & np.uint64((1 << 62) - 1) if self.common < self.bits else keys

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        high = (self._within(keys) << (np.uint64(64) - self._width(self.kinds(keys)))) >> np.uint64(32)
        return ((high * np.uint64(self.buckets)) >> np.uint64(32)).astype(np.int64)

    def _base(self, bucket: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Numbers no larger than any key of a kind in a bucket."""
        return (((bucket.astype(np.uint64) << np.uint64(32)) // np.uint64(self.buckets)) << np.uint64(32)) >> (np.uint64(64) - self._width(kind))

    def spans(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Each bucket that occurs with the place of its keys, of all keys sorted by bucket."""
        bucket = self.bucket(keys)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for k, start, end in zip(bucket[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), keys.size]):
            yield k, slice(start, end)

    def distances(self, keys: np.ndarray) -> np.ndarray:
        """From the key before, of keys sorted by bucket, kind and number; the first of a kind in a bucket from the base."""
        bucket, kind, x = self.bucket(keys), self.kinds(keys), self._within(keys)
        out = np.diff(x, prepend=np.uint64(0))
        first = np.flatnonzero(np.diff(4 * bucket + kind, prepend=-1))
        out[first] = x[first] - self._base(bucket[first], kind[first])
        return out

    def restored(self, bucket: int, distances: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """A bucket's keys."""
        sums, first = np.cumsum(distances.view(np.uint64), dtype=np.uint64), np.flatnonzero(np.diff(kind, prepend=-1))
        start = self._base(np.full(first.size, bucket), kind[first]) - np.where(first > 0, sums[first - 1], np.uint64(0))
        return (kind.astype(np.uint64) << np.uint64(62)) | (sums + np.repeat(start, np.diff(first, append=kind.size)))


class Block:
    """The words of some texts in order of first sight, and their pairs of neighbours by place in that list (0 start, 1 end)."""

    def __init__(self, texts: list[bytes]):
        # Text by text, so that a block's words are held once each and not once for every time they occur.
        seen: dict[bytes, int] = {}
        lists = [np.fromiter((seen.setdefault(w, len(seen)) for w in tokens(t)), np.int32) for t in texts]
        self.length = np.array([x.size for x in lists], np.int64)
        word = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        del lists
        self.words = list(seen)
        self.word_counts = np.bincount(word, minlength=len(seen))
        self.doc = np.flatnonzero(self.length)
        n = self.length[self.doc] + 2
        after = np.cumsum(n)
        line = np.full(int(n.sum()), -1, np.int64)
        line[after - n], line[after - 1] = 0, 1
        line[line < 0] = word + 2
        pair = (line[:-1] * (len(seen) + 2) + line[1:])[line[1:] != 0]
        self.pairs, self.at, self.pair_counts = np.unique(pair, return_inverse=True, return_counts=True)


def _texts(packed: bytes, text_col: str) -> list[bytes]:
    return [t for x in pa.ipc.open_stream(packed) for t in raw(x, text_col)]


def _block_sums(b: Block, ids: np.ndarray, marked: np.ndarray, deal: PairKeys) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's keys by bucket with their places for each of its pairs, then words, and what it counts of each in all and in the marked texts.

    A word alone is the pair of it and the start, which no text has: counts of words are summed and told like those of pairs."""
    v, ids = len(b.words) + 2, np.r_[START, END, ids]
    first, second = np.divmod(b.pairs, v)
    keys, at = np.unique(deal.keys(np.r_[ids[first], ids[2:]], np.r_[ids[second], np.full(v - 2, START)]), return_inverse=True)
    order = np.argsort(deal.bucket(keys), kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(order.size)
    keys, at = keys[order], place[at]
    mine = np.bincount(b.at[np.repeat(marked[b.doc], b.length[b.doc] + 1)], minlength=b.pairs.size)
    counts = [(b.pair_counts, b.word_counts), (mine, np.bincount(second, mine, v)[2:])]
    return keys, at, np.stack([np.bincount(at, np.concatenate(c), keys.size) for c in counts]).astype(np.int64)


STORED = "block long, rows binary, lengths binary, n_docs long, n_tokens long, n_words long"


def _blocks(text_col: str, size: ModelSize):
    """Rows packed in blocks, with their numbers of tokens, their texts that have any, and their different words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number, full = TaskContext.get().partitionId() << 32, 0

        def block() -> pa.RecordBatch:
            sink, words, n = pa.BufferOutputStream(), set(), []
            for found in (tokens(t) for x in held for t in raw(x, text_col)):
                words.update(found)
                n.append(len(found))
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            held.clear()
            return _table([(number, sink.getvalue().to_pybytes(), _pack(np.array(n, np.int64)), sum(map(bool, n)), sum(n), len(words))], STORED).to_batches()[0]

        for batch in batches:
            start = 0
            for k, text in enumerate(raw(batch, text_col)):
                full += len(text) + 64
                if full >= size.block_bytes:
                    held.append(batch.slice(start, k + 1 - start))
                    yield block()
                    start, full, number = k + 1, 0, number + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield block()

    return run


def _table(rows: list[tuple], fields: str) -> pa.Table:
    parts = [f.split() for f in fields.split(", ")]
    cols = list(zip(*rows)) if rows else [()] * len(parts)
    return pa.table({name: pa.array(list(c), pa.binary() if kind == "binary" else pa.int64()) for c, (name, kind) in zip(cols, parts)})


MESSAGE = "bucket long, block long, words binary, n binary"


def _word_messages(text_col: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                bag = Counter(chain.from_iterable(map(tokens, _texts(r["rows"], text_col))))
                words, n = list(bag), np.array(list(bag.values()), np.int64)
                yield from _table([(k, r["block"], zlib.compress(b"\n".join([words[x] for x in part]), 1), _pack(n[part]))
                                   for k, part in _split(_word_bucket(words, buckets))], MESSAGE).to_batches()

    return run


REPLY = "block long, bucket long, ids binary, n binary"
NUMBERED = "block long, bucket long, ids binary, vocabulary long"


def _number_words(size: ModelSize, allowed):
    """A bucket's words: numbers of the vocabulary's from 1, frequent ones first, told to each block that has them."""
    def run(messages: pa.Table) -> pa.Table:
        rows, seen = messages.to_pylist(), {}
        at = [np.array([seen.setdefault(w, len(seen)) for w in zlib.decompress(r["words"]).split()], np.int64) for r in rows]
        counts = np.zeros(len(seen), np.int64)
        for r, x in zip(rows, at):
            counts[x] += _unpack(r["n"])[0]
        known = counts >= size.min_count
        if allowed is not None:
            known &= np.array([w in allowed.value for w in seen], bool)
        numbers = np.zeros(len(seen), np.int64)
        numbers[np.argsort(np.where(known, -counts, 0), kind="stable")] = np.arange(1, len(seen) + 1)
        numbers[~known] = 0
        out = [(r["block"], rows[0]["bucket"], _pack(numbers[x]), None) for r, x in zip(rows, at)]
        return _table([*out, (-1, rows[0]["bucket"], None, int(known.sum()))], NUMBERED)

    return run


def _ids(words: list[bytes], told: list[dict], buckets: int) -> np.ndarray:
    """Numbers in the whole vocabulary of a block's words. The counter and the block see words in the same order."""
    out, packed = np.zeros(len(words), np.int64), {r["bucket"]: r["ids"] for r in told if r["ids"] is not None}
    for k, part in _split(_word_bucket(words, buckets)):
        number = _unpack(packed[k])[0]
        out[part] = np.where(number > 0, END + 1 + (number - 1) * buckets + k, UNKNOWN)
    return out


# What a block is told of its texts in the target comes like a word bucket's numbers, under this number.
MARKS = -1


def _marked(told: list[dict], n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    for r in told:
        if r["bucket"] == MARKS:
            out[_unpack(r["ids"])[0]] = True
    return out


SUMS = "bucket long, block long, data binary"


def _pair_messages(text_col: str, buckets: int, deal: PairKeys):
    """Each key once: its distance from the one before, what the block counts of it in all and in marked texts."""
    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        out, told = [], replies.to_pylist()
        for r in blocks.to_pylist():
            b = Block(_texts(r["rows"], text_col))
            keys, _, n = _block_sums(b, _ids(b.words, told, buckets), _marked(told, b.length.size), deal)
            distances, kinds = deal.distances(keys), deal.kinds(keys)
            out += [(k, r["block"], _pack(distances[s], kinds[s], n[0, s], n[1, s], plain=1)) for k, s in deal.spans(keys)]
        return _table(out, SUMS)

    return run


@dataclass(frozen=True)
class Totals:
    """What one number tells of each model: words in the vocabulary, texts, tokens."""

    vocabulary: int
    docs: tuple[int, int]
    tokens: tuple[int, int]


def _expected(n: np.ndarray, totals: Totals) -> np.ndarray:
    """Of counts in all texts, about what the target's share of tokens has of them."""
    return (n * round((totals.tokens[TARGET] << 16) / max(1, totals.tokens[BACKGROUND]))) >> 16


def _sum_pairs(totals: Totals, deal: PairKeys):
    """Counts of a bucket's pairs over all blocks, told to each block less its own in the order it sent them, the target's from what
    is expected."""
    def run(messages: pa.Table) -> pa.Table:
        bucket, blocks = messages.column("bucket")[0].as_py(), messages.column("block").to_pylist()
        sent = [_unpack(x.as_buffer().to_pybytes(), 4, plain=1) for x in messages.column("data")]
        keys, at = np.unique(np.concatenate([deal.restored(bucket, *x[:2]) for x in sent]), return_inverse=True)
        # Sums of whole numbers below 2**53: exact as doubles.
        counts = [np.bincount(at, np.concatenate([x[m] for x in sent]), keys.size).astype(np.int64) for m in (2, 3)]
        out, end = [], 0
        for block, x in zip(blocks, sent):
            start, end = end, end + len(x[0])
            rest, target = (c[at[start:end]] - own for c, own in zip(counts, x[2:]))
            out.append((block, bucket, None, _pack(rest, _folded(target - _expected(rest, totals)))))
        return _table(out, REPLY)

    return run


def _score(text_col: str, totals: Totals, buckets: int, deal: PairKeys, size: ModelSize, schema: pa.Schema):
    whole = [t + 2 * d for t, d in zip(totals.tokens, totals.docs)]
    # The background's counts are scaled to the target's tokens, so both are smoothed alike.
    scale = ((whole[TARGET] / whole[BACKGROUND] if whole[BACKGROUND] else 0.0) or 1.0, 1.0)

    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        told = replies.to_pylist()
        done = [schema.empty_table()]
        for packed in blocks.column("rows").to_pylist():
            rows = pa.ipc.open_stream(packed).read_all().combine_chunks()
            b = Block([t for x in rows.to_batches() for t in raw(x, text_col)])
            keys, at, n = _block_sums(b, _ids(b.words, told, buckets), _marked(told, b.length.size), deal)
            of_pairs = {r["bucket"]: r["n"] for r in told if r["n"] is not None}
            for k, s in deal.spans(keys):
                rest, target = _unpack(of_pairs[k], 2)
                n[:, s] += rest, _unfolded(target) + _expected(rest, totals)
            pairs, words = n[:, at[:b.pairs.size]], n[:, at[b.pairs.size:]]
            doc, losses = np.repeat(b.doc, b.length[b.doc] + 1), {}
            for m in (BACKGROUND, TARGET):
                single = np.r_[totals.docs[m], totals.docs[m], words[m]] * scale[m]
                first, second = single[b.pairs // single.size], single[b.pairs % single.size]
                total = whole[m] * scale[m]
                alone = (second + size.add) / (total + size.add * (totals.vocabulary + 3))
                weight = np.where(first > 0, size.pair_weight, 0.0)
                loss = -np.log(weight * pairs[m] * scale[m] / np.maximum(first, 1e-9) + (1 - weight) * alone)
                losses[m] = np.bincount(doc, loss[b.at], b.length.size) / (b.length + 1)
            none = b.length == 0
            for name, v in (("n_tokens", pa.array(b.length)), ("target_loss", pa.array(losses[TARGET], mask=none)),
                            ("background_loss", pa.array(losses[BACKGROUND], mask=none)),
                            ("loss_difference", pa.array(losses[TARGET] - losses[BACKGROUND], mask=none))):
                rows = rows.append_column(name, v)
            done.append(rows.cast(schema))
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(done)

    return run


def _most_frequent(docs: DataFrame, text_col: str, size: ModelSize):
    """The limited vocabulary of a caller who set a limit, as a set on all executors."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bag = Counter(chain.from_iterable(map(tokens, raw(batch, text_col))))
            yield pa.RecordBatch.from_arrays([pa.array(list(bag), pa.binary()), pa.array(list(bag.values()), pa.int64())], ["word", "n"])

    top = (docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= size.min_count).orderBy(F.desc("n"), "word").limit(size.words).collect())
    return docs.sparkSession.sparkContext.broadcast({bytes(r[0]) for r in top})


MARKED = "block long, bucket long, ids binary, n_docs long, n_tokens long"


def _marks(stored: DataFrame, base: DataFrame, target_ids: DataFrame, id_col: str) -> DataFrame:
    """Places of the texts in the target by block: ids travel, texts do not."""
    at = [c.lower() for c in base.columns].index(id_col.lower())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = pa.ipc.open_stream(r["rows"], options=pa.ipc.IpcReadOptions(included_fields=[at])).read_all().combine_chunks()
                n = _unpack(r["lengths"])[0]
                found = pa.table([ids.column(0), pa.array(np.full(n.size, r["block"])), pa.array(np.arange(n.size)), pa.array(n)], ["_id", "_block", "_place", "_n"])
                yield from found.filter(pa.array(n > 0)).to_batches()

    def packed(found: pa.Table) -> pa.Table:
        n = found.column("_n").to_numpy()
        return _table([(found.column("_block")[0].as_py(), MARKS, _pack(np.sort(found.column("_place").to_numpy())), n.size, int(n.sum()))], MARKED)

    ids = T.StructType([T.StructField("_id", base.schema[at].dataType)] + T.StructType.fromDDL("_block long, _place long, _n long").fields)
    targets = target_ids.select(F.col(id_col).alias("_id")).distinct()
    return (stored.select("block", "rows", "lengths").mapInArrow(places, ids).join(targets, "_id", "left_semi")
            .drop("_id").groupBy("_block").applyInArrow(packed, MARKED))


def score_difference(docs: DataFrame, target_ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     size: ModelSize = ModelSize()) -> DataFrame:
    """``docs`` with n_tokens, target_loss, background_loss (nats a token) and their difference; lower is closer to the target.

    Interpolated two-word models over one vocabulary, all words found at least ``size.min_count`` times in the documents; other
    words are one unknown. Counts of words and of pairs are exact and stay in tables. Documents are packed in blocks of a bounded size, each
    with marks for its texts in the target, so that both models are counted in one reading. A block
    sends each of its words, then each of its pairs, once to the bucket that sums it, and is told the sums in the order sent: so neither a
    frequent word nor a frequent pair makes more than a number for each block, and nothing but totals reaches the driver.

    A null or empty text has no tokens and null losses. Null ids are in no target. Without a target text all
    differences come from smoothing alone. Repeated target ids count once, repeated documents as often as they occur.
    Input columns of the added names are replaced.
    """
    extra = T.StructType.fromDDL(FIELDS)
    base = without(docs, *extra.fieldNames())
    stored = written(base.mapInArrow(_blocks(text_col, size), STORED), "blocks")
    marks = written(_marks(stored, base, target_ids, id_col), "marks")
    sums = [df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]).first()
            for df, cols in ((stored, ("n_docs", "n_tokens", "n_words")), (marks, ("n_docs", "n_tokens")))]
    buckets = 1 + sums[0]["n_tokens"] // size.bucket_tokens
    # Words come as bytes and are held as objects: a fourth of the number for a bucket.
    word_buckets = 1 + 4 * sums[0]["n_words"] // size.bucket_tokens

    allowed = None if size.words is None else _most_frequent(base, text_col, size)
    texts = stored.select("block", "rows")
    numbered = written(texts.mapInArrow(_word_messages(text_col, word_buckets), MESSAGE)
                       .groupBy("bucket").applyInArrow(_number_words(size, allowed), NUMBERED), "words")
    t = numbered.where("block = -1").agg(F.coalesce(F.sum("vocabulary"), F.lit(0)), F.coalesce(F.max("vocabulary"), F.lit(0))).first()
    totals = Totals(t[0], tuple(x["n_docs"] for x in sums), tuple(x["n_tokens"] for x in sums))
    deal = PairKeys.of(END + t[1] * word_buckets, word_buckets, buckets)
    words = numbered.where("block >= 0").select("block", "bucket", "ids").union(marks.select("block", "bucket", "ids"))

    # The blocks are dealt out once: both steps name the same exchange of ``texts``, and Spark makes it a single one.
    pairs = (texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(_pair_messages(text_col, word_buckets, deal), SUMS)
             .groupBy("bucket").applyInArrow(_sum_pairs(totals, deal), REPLY))
    told = words.withColumn("n", F.lit(None).cast("binary")).union(pairs)
    schema = T.StructType(base.schema.fields + extra.fields)
    return (texts.groupBy("block").cogroup(told.groupBy("block"))
            .applyInArrow(_score(text_col, totals, word_buckets, deal, size, to_arrow_schema(schema)), schema))

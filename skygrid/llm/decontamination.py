"""Benchmark decontamination: one FM-index per shard of training text, searched for all test phrases."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import appended, map_rows, raw
from skygrid.llm.fm_index import FMIndex

# A-Z become a-z, other ASCII but digits and letters becomes a blank; bytes above 127 stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
FIELDS = "n_words long, n_hit long, items array<string>, spans array<struct<start: int, end: int>>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Phrases:
    """Windows of one block of test items, as symbol rows written backwards, with the items each one stands in."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.symbol: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            # 0 is the index's end mark, 1 its break.
            ids = [self.symbol.setdefault(w, len(self.symbol) + 2) for w in words(text)]
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[k:k + window]), set()).update([item] if item is not None else [])
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.rows = np.zeros((len(owners), window), np.int64)
        for k, w in enumerate(owners):
            self.rows[k, :len(w)] = w[::-1]
        self.owners = list(owners.values())
        self.shortest = int(self.lengths.min()) if len(owners) else 0


class Shard:
    """Texts of some batches. Words no phrase has break the text; stretches shorter than any phrase cannot match."""

    def __init__(self, phrases: Phrases, sample: int):
        self.phrases, self.sample = phrases, sample
        self.pieces: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []  # columns: place in the shard, row, word
        self.size = self.rows = self.n_words = 0
        self.counts: list[int] = []

    def add(self, text: bytes) -> None:
        ws = words(text)
        self.counts.append(len(ws))
        row, self.rows, self.n_words = self.rows, self.rows + 1, self.n_words + len(ws)
        if not self.phrases.shortest or len(ws) < self.phrases.shortest:
            return
        get = self.phrases.symbol.get
        ids = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
        edge = np.flatnonzero(np.diff(np.r_[0, (ids > 0).astype(np.int8), 0]))
        a, b = edge[::2], edge[1::2]
        long = b - a >= self.phrases.shortest
        a, b = a[long], b[long]
        if not a.size:
            return
        n = b - a + 1
        place = self.size + np.r_[0, np.cumsum(n)[:-1]]
        piece = np.ones(int(n.sum()), np.int64)
        inside = np.repeat(a - (place - self.size), n) + np.arange(piece.size)
        keep = inside < np.repeat(b, n)
        piece[keep] = ids[inside[keep]]
        self.pieces.append(piece)
        self.starts.append(np.stack([place, np.full(a.size, row), a], 1))
        self.size += piece.size

    def hits(self) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """For each row with a hit: merged spans of words, and the items found."""
        if not self.pieces:
            return {}
        index = FMIndex(np.concatenate(self.pieces), self.sample)
        starts = np.concatenate(self.starts)
        lo, hi = index.search(self.phrases.rows, self.phrases.lengths)
        found = np.flatnonzero(hi > lo)
        n = (hi - lo)[found]
        which = np.repeat(found, n)
        at = index.locate(np.repeat(lo[found] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum())))
        stretch = np.searchsorted(starts[:, 0], at, "right") - 1
        row = starts[stretch, 1]
        begin = starts[stretch, 2] + at - starts[stretch, 0]
        end = begin + self.phrases.lengths[which]
        out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        for k in np.lexsort((begin, row)).tolist():
            spans, items = out.setdefault(int(row[k]), ([], set()))
            items |= self.phrases.owners[which[k]]
            if spans and begin[k] <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], int(end[k])))
            else:
                spans.append((int(begin[k]), int(end[k])))
        return out


def _as_chars(text: bytes, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    s = text.decode("utf-8", "replace")
    at = [m.span() for m in _WORD.finditer(s)]
    return s, [(at[a][0], at[b - 1][1]) for a, b in spans]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pass(phrases: Phrases, text_col: str, shard_words: int, sample: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard = Shard(phrases, sample)

        def flush():
            hits, row = shard.hits(), 0
            for batch in held:
                n_hit, items, spans, texts = [], [], [], raw(batch, text_col)
                for text in texts:
                    # Spans and items are lists of one entry per block of phrases; word spans first.
                    found, names = hits.get(row, ([], set()))
                    n_hit.append(found)
                    items.append(sorted(names))
                    spans.append(_as_chars(text, found)[1] if found else [])
                    row += 1
                yield batch, shard.counts[row - len(texts):row], n_hit, items, spans

        for batch in batches:
            for text in raw(batch, text_col):
                shard.add(text)
            held.append(batch)
            if shard.n_words >= shard_words:
                yield from flush()
                held, shard = [], Shard(phrases, sample)
        yield from flush()

    return run


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_STRINGS = pa.list_(pa.string())


def _structs(rows):
    return pa.array([[{"start": a, "end": b} for a, b in r] for r in rows], _SPAN)


def find_contamination(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = 10, shard_words: int = 4_000_000, sample: int = 16,
                       block_chars: int = 32 << 20) -> DataFrame:
    """``docs`` with n_words, n_hit, items (as strings, sorted) and spans (merged character spans of hit words).

    A phrase is ``window`` consecutive words of an item; an item of fewer words, but not none, is one phrase. Each task
    gathers whole texts up to ``shard_words`` words (a longer text is a shard of its own), builds an FM-index
    over them, searches every phrase backwards through wavelet ranks, locates the occurrences by sampled suffix
    positions and merges them. Only texts and results pass through the task; nothing is shuffled.

    Items reach the tasks in blocks of about ``block_chars`` characters, each collected, broadcast and applied in turn,
    so no more than a block is ever held; items of any total size are searched.

    Null and empty texts have no words and no hits. An item without a text has no phrase; one without an id
    still marks words but has no name to report. Items that share an id count once. Repeated rows each get
    their own result. Input columns called n_words, n_hit, items or spans are replaced.
    """
    pairs = items.select(F.col(item_id).cast("string").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    total = pairs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-total // block_chars) or 1
    out = None
    for block in range(n_blocks):
        mine = pairs.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block)
        phrases = Phrases([(r[0], r[1].encode("utf-8", "replace")) for r in mine.collect()], window)
        shared = docs.sparkSession.sparkContext.broadcast(phrases)
        out = _apply(docs if out is None else out, shared, text_col, shard_words, sample, fresh=out is None)
    # Word spans of all blocks are merged in the last step of the chain; the working column goes.
    return out.drop("_hit")


def _apply(docs: DataFrame, shared, text_col: str, shard_words: int, sample: int, fresh: bool) -> DataFrame:
    def run(batches):
        for batch, n, hit, items, spans in _pass(shared.value, text_col, shard_words, sample)(batches):
            if not fresh:
                old = batch.select(["_hit", "items", "spans"]).to_pylist()
                pair = lambda x: [(y["start"], y["end"]) for y in x]
                hit = [_merged(a + pair(o["_hit"])) for a, o in zip(hit, old)]
                items = [sorted({*a, *o["items"]}) for a, o in zip(items, old)]
                spans = [_merged(a + pair(o["spans"])) for a, o in zip(spans, old)]
                batch = batch.select([c for c in batch.schema.names if c not in ("n_words", "n_hit", "items", "spans", "_hit")])
            yield appended(batch, {"n_words": pa.array(n, pa.int64()),
                                   "n_hit": pa.array([sum(b - a for a, b in h) for h in hit], pa.int64()),
                                   "items": pa.array(items, _STRINGS), "spans": _structs(spans), "_hit": _structs(hit)})

    if fresh:
        return map_rows(docs, run, FIELDS + ", _hit array<struct<start: int, end: int>>")
    return docs.mapInArrow(run, docs.schema)


def without_spans(docs: DataFrame, *, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with the characters of ``spans_col`` (sorted, apart) cut from the text, a line break in each place."""
    kept = F.expr(f"""
        array_join(transform(sequence(0, size({spans_col})), k -> substring({text_col},
            if(k = 0, 0, get({spans_col}, k - 1).`end`) + 1,
            if(k = size({spans_col}), length({text_col}), get({spans_col}, k).`start`) - if(k = 0, 0, get({spans_col}, k - 1).`end`))), '\n')""")
    return docs.withColumn(text_col, F.when(F.size(spans_col) > 0, kept).otherwise(F.col(text_col)))

"""Periodic runs of words: harmonic-grid candidates, extended exactly by grammar queries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skygrid.llm.common import map_rows, raw
from skygrid.llm.recompression import Grammar

SLICE = 1 << 20  # bytes of texts that share a grammar; a longer text has one of its own
CANDIDATES = 1 << 20  # pairs of grid places looked at together
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Ids(dict):
    """Numbers of words by first occurrence."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _grid_matches(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grid places (i, i + q) with equal words: for every period q up to half a text, the multiples of q next to each other.

    A run of period q and length 2 q or more covers two neighbouring multiples of q. There are n ln n such pairs in n words.
    """
    half = size // 2
    text = np.repeat(np.arange(len(size)), half)
    q = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    count = (size[text] - 1) // q
    end = np.cumsum(count)
    cuts = np.unique(np.append(np.searchsorted(end, np.arange(CANDIDATES, int(end[-1]) if len(end) else 0, CANDIDATES)), [0, len(end)]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        c, period = count[a:b], np.repeat(q[a:b], count[a:b])
        k = np.arange(len(period)) - np.repeat(np.cumsum(c) - c, c)
        i = np.repeat(start[text[a:b]], c) + k * period
        hit = words[i] == words[i + period]
        yield i[hit], i[hit] + period[hit], period[hit]


def _distinct(runs: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) without repeats; of one stretch the smallest period stays."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))] if len(runs) else runs


def runs_of(texts: list[list[bytes]], least: int) -> list[np.ndarray]:
    """Of each list of words its runs as rows (start, length, period), by start and period."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    long = [k for k, t in enumerate(texts) if len(t) >= max(least, 2)]
    if not long:
        return out
    ids = _Ids()
    size = np.array([len(texts[k]) for k in long])
    start = np.cumsum(size + 1) - size
    words = np.empty(int(start[-1] + size[-1]) + 1, np.int64)
    for k, at, n in zip(long, start, size):
        words[at:at + n] = np.fromiter(map(ids.__getitem__, texts[k]), np.int64, n)
    words[np.append(0, start + size)] = len(ids) + np.arange(len(long) + 1)
    grammar, found, waiting = None, [np.zeros((0, 3), np.int64)], []

    def extend() -> None:
        i, j, q = (np.concatenate(c) for c in zip(*waiting))
        waiting.clear()
        ahead = grammar.extension(i, j)
        behind = grammar.extension(i - 1, j - 1, back=True)
        run = (ahead + behind >= q) & (ahead + behind + q >= least)
        found.append(_distinct(np.stack([i - behind, j + ahead, q], axis=1)[run]))

    for match in _grid_matches(words, start, size):
        grammar = grammar or Grammar(words, len(ids))
        waiting.append(match)
        if sum(len(m[0]) for m in waiting) >= CANDIDATES // 4:
            extend()
    if waiting:
        extend()
    runs = _distinct(np.concatenate(found))
    text = np.searchsorted(start, runs[:, 0], "right") - 1
    rows = np.stack([runs[:, 0] - start[text], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    order = np.lexsort((rows[:, 2], rows[:, 0], text))
    for k, part in zip(long, np.split(rows[order], np.searchsorted(text[order], np.arange(1, len(long))))):
        out[k] = part
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = compress(words, (np.cumsum(edge[:-1]) == 0).tolist())
    return b" ".join(words)


def collapse_runs(docs: DataFrame, *, text_col: str = "text", least: int = 12, slice_bytes: int = SLICE) -> DataFrame:
    """``docs`` with n_words and runs, and with texts that keep only the first period of each run.

    ``runs`` are the stretches of words, of ``least`` words and of two smallest periods or more, that no neighbouring word extends
    with that period kept: start (word number from 0), length, period; by start, then period. Words are whatever lies between
    ASCII white space; they are joined by one space.

    Texts stay where they are; nothing is shuffled. The texts of a slice are one sequence with fences, and one grammar
    answers the extensions of all of them; a text is never cut. Working memory is some hundred bytes a word of a slice.

    A null text stays null with 0 words and no runs, an empty one stays empty. Repeated rows are rows of their own. Input columns
    named n_words or runs are replaced.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_col)
            known = batch.column(at).is_valid().to_pylist()
            texts, n_words, runs, part, size = [], [], [], [], 0
            rows = raw(batch, text_col)
            for k, text in enumerate(rows):
                part.append(text.split())
                size += len(text)
                if size > slice_bytes or k == len(rows) - 1:
                    for words, found in zip(part, runs_of(part, least)):
                        n_words.append(len(words))
                        runs.append([dict(zip(("start", "length", "period"), r)) for r in found.tolist()])
                        texts.append(collapsed(words, found))
                    part, size = [], 0
            text = pa.array([t if ok else None for t, ok in zip(texts, known)], pa.binary()).cast(batch.schema.field(at).type)
            columns = [text if c == at else batch.column(c) for c in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(n_words, pa.int64()), pa.array(runs, pa.list_(_RUN))],
                                             names=batch.schema.names + ["n_words", "runs"])

    return map_rows(docs, run, "n_words long, runs array<struct<start:long,length:long,period:long>>")

"""Quality classifier: a chain labels every line good or bad, its marginals weigh up to the document's score."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm import crf
from skygrid.llm.common import appended, map_rows, raw

FEATURES = ("log_chars", "word_length", "upper", "digit", "call", "bar", "symbol", "mark", "wide", "stuttered", "distinct", "seen")
_ASCII = bytes(range(128))
_SETS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b"#*$%&<>@^_~=+\\/", b".,;:")


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample and of the fit."""

    max_documents: int = 3000  # the labelled documents of lowest hash
    max_lines: int = 2000  # documents of more lines are left out of the sample, not of scoring
    steps: int = 120


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    emit: np.ndarray
    move: np.ndarray
    slope: float
    offset: float


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``FEATURES`` for each line with content, and the lines' lengths in bytes."""
    rows, sizes, before = [], [], set()
    for line in text.split(b"\n"):
        ws = line.split()
        if not ws:
            continue
        n = len(line)
        shares = [(n - len(line.translate(None, s))) / n for s in _SETS]
        rows.append((np.log1p(n), n / len(ws), *shares, len(line.translate(None, _ASCII)) / n,
                     sum(map(eq, ws, ws[1:])) / len(ws), len(set(ws)) / len(ws), line in before))
        sizes.append(n)
        before.add(line)
    return np.array(rows, np.float64).reshape(-1, len(FEATURES)), np.array(sizes, np.float64)


def in_context(features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the line before and the line after, marks for the ends, and a constant."""
    n = len(features)
    end = np.cumsum(lengths[lengths > 0])
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    last[end - 1] = True
    first[end - lengths[lengths > 0]] = True
    before, after = np.roll(features, 1, 0), np.roll(features, -1, 0)
    before[first], after[last] = 0.0, 0.0
    return np.hstack([features, before, after, first[:, None], last[:, None], np.ones((n, 1))])


def _good_share(x: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals of a good line; 0 for a text without lines."""
    good = np.zeros(len(lengths))
    for part, rows in crf.chunks(lengths):
        score, mask = crf.padded(lengths[part], x[rows] @ emit)
        p, _ = crf.marginals(score, mask, move)
        w, _ = crf.padded(lengths[part], sizes[rows])
        good[part] = (p[:, :, crf.GOOD] * w).sum(1) / np.maximum(w.sum(1), 1)
    return good


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn the good share into a probability (Newton, slightly penalised)."""
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta = beta + np.linalg.solve(hess, design.T @ (y - p) - 0.1 * beta)
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          held_out, training: Training = Training()) -> Model:
    """Fit on at most ``max_documents`` labelled documents outside ``held_out``, each line taking its document's label."""
    rows = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
            .groupBy(id_col).agg(F.min(label_col).alias("_label")).where(~held_out(F.col(id_col)))
            .orderBy(F.xxhash64(id_col), id_col).limit(training.max_documents))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(t) for t in raw(batch, text_col)]
            keep = [k for k, (f, _) in enumerate(found) if len(f) <= training.max_lines]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("_label")).take(pa.array(keep, pa.int64())).cast(pa.int32()),
                 pa.array([found[k][0].astype(np.float32).tobytes() for k in keep], pa.binary()),
                 pa.array([found[k][1].astype(np.float32).tobytes() for k in keep], pa.binary())], ["label", "features", "sizes"])

    # The labelled sample has a bounded number of rows, so it may be broadcast.
    sample = (docs.select(id_col, text_col).join(F.broadcast(rows), id_col).select("_label", text_col)
              .mapInArrow(features, "label int, features binary, sizes binary").collect())
    return fit_model([(int(r[0]), np.frombuffer(r[1], np.float32).reshape(-1, len(FEATURES)).astype(np.float64),
                       np.frombuffer(r[2], np.float32).astype(np.float64)) for r in sample], training)


def fit_model(sample: list[tuple[int, np.ndarray, np.ndarray]], training: Training = Training()) -> Model:
    sample.sort(key=lambda r: (r[0], r[1].tobytes()))  # the same model however the rows arrived
    lengths = np.array([len(f) for _, f, _ in sample], np.int64)
    if not lengths.sum():
        zero = np.zeros(len(FEATURES))
        return Model(zero, zero + 1, np.zeros((3 * len(FEATURES) + 3, 2)), np.zeros((2, 2)), 0.0, 0.0)
    plain, sizes = np.vstack([f for _, f, _ in sample]), np.concatenate([s for _, _, s in sample])
    mean, spread = plain.mean(0), plain.std(0) + 1e-6
    x = in_context((plain - mean) / spread, lengths)
    y = np.array([r[0] for r in sample], np.int64)
    emit, move = crf.fit(x, lengths, np.repeat(y, lengths), steps=training.steps)
    slope, offset = _logistic(_good_share(x, lengths, sizes, emit, move), y.astype(np.float64))
    return Model(mean, spread, emit, move, slope, offset)


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    found = [line_features(t) for t in texts]
    lengths = np.array([len(f) for f, _ in found], np.int64)
    if not len(lengths):
        return np.zeros(0)
    sizes = np.concatenate([s for _, s in found])
    x = in_context((np.vstack([f for f, _ in found]) - model.mean) / model.spread, lengths)
    good = _good_share(x, lengths, sizes, model.emit, model.move)
    return 1 / (1 + np.exp(-(model.slope * good + model.offset)))


def held_out_fold(id_col):
    """crc32 of the id as text, modulo 5, is 0; a null id is in no fold."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = 0.3, held_out=held_out_fold,
                  training: Training = Training(), slice_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (score >= ``threshold``), from every line of every text.

    Line labels come from a linear-chain conditional random field over features of the line, the line before and the
    line after; forward-backward marginals, weighted by line length, are averaged and calibrated. The model is fitted
    once on a bounded labelled sample and is a few hundred numbers; texts are scored in place, nothing is shuffled.

    Labels, language, source and id are never inputs of a score. A null or empty text has no good line and gets
    the score of a share of 0. Of repeated labels of an id the lowest counts; null ones do not. Without any usable label
    every score is 0.5. Repeated rows get the same score. Input columns of the added names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, held_out=held_out, training=training))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, part, size = [], [], 0
            for text in raw(batch, text_col):
                part.append(text)
                size += len(text)
                if size > slice_bytes:
                    scores.append(score_texts(part, shared.value))
                    part, size = [], 0
            scores.append(score_texts(part, shared.value))
            score = np.concatenate(scores)
            yield appended(batch, {"score": pa.array(score, pa.float64()),
                                   "predicted": pa.array((score >= threshold).astype(np.int32), pa.int32())})

    return map_rows(docs.withColumn("held_out", held_out(F.col(id_col))), run, "score double, predicted int")

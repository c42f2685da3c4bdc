"""Quality rules: plain counts of a text, and its distance from the usual distributions of its language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import appended, map_rows, raw, written
from skygrid.llm.decontamination import words as folded_words

# The classes of the character histogram, as ASCII sets; the rest is by code.
CLASSES = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789",
           "blank": " \t\r\x0b\x0c", "newline": "\n", "stop": ".,;:", "call": "!?", "bracket": "'\"()[]{}-"}
SYMBOLS = "#*$%&|<>"
FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "char_distance double, word_distance double, kept boolean")

_CLASS = np.full(256, len(CLASSES), np.int64)  # other ASCII
_CLASS[0x80:] = len(CLASSES) + 1  # first bytes of longer characters
for _k, _set in enumerate(CLASSES.values()):
    _CLASS[list(_set.encode())] = _k
N_CLASSES = len(CLASSES) + 2
_CONTINUED = slice(0x80, 0xC0)
_SPACE = list(b" \t\n\x0b\x0c\r")
_SYMBOL = list(SYMBOLS.encode())


@dataclass(frozen=True)
class Rules:
    """Parameters of the operator; distances lie between 0 and 1."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars: int = 200  # shorter texts have no character histogram worth comparing
    min_folded_words: int = 100  # likewise for words
    max_char_distance: float = 0.2
    max_word_distance: float = 0.36
    min_reference_chars: int = 2_000  # a reference of less, without the judged text, is none
    min_reference_words: int = 1_000
    common_share: float = 0.002  # a word is common from this share of its language's words: at most 500 a language


def base_counts(text: bytes) -> tuple[np.ndarray, int, int, int, int, int]:
    """Byte histogram, words, code points in words, symbols, lines seen before, words in repeated triples."""
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    ws = text.split()
    n = len(ws)
    chars = int(hist.sum() - hist[_CONTINUED].sum() - hist[_SPACE].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return hist, n, chars, int(hist[_SYMBOL].sum()), len(lines) - len(set(lines)), _repeated(ws)


def _repeated(ws: list[bytes]) -> int:
    if len(ws) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in ws], np.int64)
    pair = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:  # keeps the triple's number below 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    _, inverse, count = np.unique(pair[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    covered = np.zeros(len(ws), bool)
    for k in range(3):
        covered[k:len(ws) - 2 + k] |= again
    return int(covered.sum())


def char_histogram(hist: np.ndarray) -> np.ndarray:
    whole = hist.copy()
    whole[_CONTINUED] = 0
    return np.bincount(_CLASS, weights=whole, minlength=N_CLASSES)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, base 2."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    half = lambda x: float(np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])))
    return float(np.sqrt(max(0.0, (half(p) + half(q)) / 2)))


def failed(n: int, repeated: int, rules: Rules) -> bool:
    return n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n


def _count(text_col: str, lang_col: str, rules: Rules, limit: int = 400_000):
    """Histograms of the texts that pass the plain rules, summed inside each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, tuple[np.ndarray, Counter]] = {}

        def rows():
            lang, kind, key, n = [], [], [], []
            for name, (chars, bag) in found.items():
                for k, v in [*enumerate(chars.tolist()), *bag.items()]:
                    lang.append(name)
                    kind.append(isinstance(k, bytes))
                    key.append(k if isinstance(k, bytes) else str(k).encode())
                    n.append(int(v))
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.bool_()), pa.array(key, pa.binary()),
                                               pa.array(n, pa.int64())], ["lang", "is_word", "key", "n"])

        for batch in batches:
            langs = batch.column(batch.schema.get_field_index(lang_col)).to_pylist()
            for name, text in zip(langs, raw(batch, text_col)):
                hist, n, _, _, _, repeated = base_counts(text)
                if failed(n, repeated, rules):
                    continue
                chars, bag = found.setdefault(name, (np.zeros(N_CLASSES), Counter()))
                chars += char_histogram(hist)
                bag.update(folded_words(text))
            if sum(len(bag) for _, bag in found.values()) > limit:
                yield rows()
        yield rows()

    return run


class References:
    """Character and common-word histograms of each language; words outside the common ones share the last place."""

    def __init__(self, rows: list[tuple[str | None, bool, bytes, int, int]]):
        self.chars: dict[str | None, np.ndarray] = {}
        common: dict[str | None, list[tuple[bytes, int]]] = {}
        total: dict[str | None, int] = {}
        for lang, is_word, key, n, of in rows:
            if is_word:
                common.setdefault(lang, []).append((bytes(key), n))
                total[lang] = of
            else:
                self.chars.setdefault(lang, np.zeros(N_CLASSES))[int(key)] = n
        self.place, self.words = {}, {}
        for lang, ws in common.items():
            ws.sort()
            self.place[lang] = {w: k for k, (w, _) in enumerate(ws)}
            counts = [n for _, n in ws]
            self.words[lang] = np.array([*counts, total[lang] - sum(counts)], float)

    def distances(self, lang: str | None, hist: np.ndarray, text: bytes, rules: Rules, counted: bool) -> tuple[float | None, float | None]:
        """Distances from the language's own references without this text, which is in them if ``counted``; None where what is
        left of them is too small or the text too short."""
        chars = char_histogram(hist)
        by_char = by_word = None
        if lang in self.chars and chars.sum() >= rules.min_chars:
            others = self.chars[lang] - counted * chars
            if others.sum() >= rules.min_reference_chars:
                by_char = distance(chars, others)
        bag = Counter(folded_words(text))
        if lang in self.words and (n := sum(bag.values())) >= rules.min_folded_words:
            h = np.zeros(len(self.words[lang]))
            for w, k in self.place[lang].items():
                h[k] = bag[w]
            h[-1] = n - h.sum()
            others = self.words[lang] - counted * h
            if others.sum() >= rules.min_reference_words:
                by_word = distance(h, others)
        return by_char, by_word


def language_references(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> References:
    """Histograms over all documents that pass the plain rules. What is collected is a few classes
    and at most 1 / ``common_share`` words for each language."""
    counts = written(docs.select(text_col, lang_col)
                     .mapInArrow(_count(text_col, lang_col, rules), "lang string, is_word boolean, key binary, n long")
                     .groupBy("lang", "is_word", "key").agg(F.sum("n").alias("n")), "language-counts")
    total = counts.where("is_word").groupBy(F.col("lang").alias("of_lang")).agg(F.sum("n").alias("of"))
    rows = (counts.join(total, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
            .where(~F.col("is_word") | (F.col("n") >= F.col("of") * rules.common_share))
            .select("lang", "is_word", "key", "n", "of"))
    return References([tuple(r) for r in rows.collect()])


def judge_by_distribution(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with plain counts, distances from the language references and the verdict ``kept``.

    One pass sums the references inside each task, a second one compares every whole text; only the sums are
    shuffled. A text that fails the plain rules is not kept. Any other is kept while its distances stay within ``rules``; a text
    too short for one of the comparisons (null distance) is not judged by it.

    Null and empty texts have no words and fail. Every language, however rare, is compared
    with its own references, and texts of null language with those of all such texts. The judged text is left out of them, and where
    less than the smallest reference is left, or no word is common, there is no distance (null). Repeated rows each get the same result. Input columns
    that carry an added name are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(language_references(docs, text_col=text_col, lang_col=lang_col, rules=rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = shared.value
        for batch in batches:
            out: list[tuple] = []
            for lang, text in zip(batch.column(batch.schema.get_field_index(lang_col)).to_pylist(), raw(batch, text_col)):
                hist, n, chars, symbols, dup, repeated = base_counts(text)
                bad = failed(n, repeated, rules)
                dc, dw = refs.distances(lang, hist, text, rules, not bad)
                ok = not bad and (dc is None or dc <= rules.max_char_distance) and (dw is None or dw <= rules.max_word_distance)
                out.append((n, chars, symbols, dup, repeated, bad, dc, dw, ok))
            kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.float64()] * 2 + [pa.bool_()]
            names = [f.split()[0] for f in FIELDS.split(", ")]
            cols = list(zip(*out)) if out else [()] * len(kinds)
            yield appended(batch, {c: pa.array(list(v), k) for c, v, k in zip(names, cols, kinds)})

    return map_rows(docs, run, FIELDS)

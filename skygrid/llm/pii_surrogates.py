"""PII: detected entities get keyed surrogates of their own kind, distinct from each other and from every original."""

from __future__ import annotations

import hmac
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import appended, map_rows, raw, without, written

# Given names by script and gender, and syllables for family names of that script.
GIVEN = {
    ("latin", "f"): "Anna Maria Laura Julia Emma Sophie Clara Elena Lucia Marie Alice Helen Susan Karen Nancy Linda Barbara Patricia Jennifer Elizabeth".split(),
    ("latin", "m"): "John James Robert Michael William David Richard Joseph Thomas Daniel Paul Peter Martin Andreas Carlos Pedro Pierre Hans Karl Luis".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил Владимир Павел".split(),
}
SYLLABLES = {"latin": "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo".split(),
             "cyrillic": "ба ве го да же за ки ла ми но пе ра си та фо ха чи ша".split()}
TITLES = {"f": "Mrs Ms Miss Frau Señora Madame Mme".split(), "m": "Mr Herr Señor Monsieur".split()}
# Kinds in order of precedence where matches overlap.
PATTERNS = {
    # With a letter or digit in the local part or the host: nothing else can be replaced. Only the start of a run is tried.
    "email": r"(?<![\w.+%-])(?:(?=[_.+%-]*[^\W_])[\w.+%-]+@|[_.+%-]+@(?=[_.-]*[^\W_][\w-]*\.[\w-]))[\w-]+(?:\.[\w-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?=[A-Fa-f]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\d|\.\d)",
    "card": r"(?<![\d-])[0-9](?:[ -]?[0-9]){12,18}(?![\d-]|\.\d)",
    "ssn": r"(?<![\d-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{4}(?!\w)",
    "name": r"(?:(?<!\w)(?P<title>" + "|".join(sum(TITLES.values(), [])) + r")\.? )?(?<!\w)(?P<given>"
            + "|".join(sum(GIVEN.values(), [])) + r") (?P<family>[^\W\d_]+)(?!\w)",
}
_FIND = {kind: re.compile(p) for kind, p in PATTERNS.items()}
_DIGIT = re.compile(r"\d")
_GENDER = {n: k for k, names in GIVEN.items() for n in names}
FIELDS = "n_replaced long, entities array<struct<kind: string, start: int, end: int>>"


class Stream:
    """Pseudorandom numbers that follow from key, kind, entity and attempt."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hmac.new(key, "\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), "blake2b").digest()
        self.count, self.pool = 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < n * 1000:
            self.pool = int.from_bytes(blake2b(self.count.to_bytes(8, "big"), key=self.seed).digest(), "big")
            self.left, self.count = 1 << 512, self.count + 1
        self.pool, out = divmod(self.pool, n)
        self.left //= n
        return out


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of entities, apart and in order; where matches overlap the kind listed first wins.

    The matches of a kind come in order and are walked beside those taken before, so the time grows with the text.
    """
    taken: list[tuple[int, int, str]] = []
    digits = _DIGIT.search(text) is not None
    for kind, pattern in _FIND.items():
        # What no match can lack is looked for first.
        if not ("@" in text if kind == "email" else any(n in text for n in _GENDER) if kind == "name" else digits):
            continue
        at, more = 0, []
        for m in pattern.finditer(text):
            if kind == "name" and not m["family"][0].isupper():
                continue
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at == len(taken) or m.end() <= taken[at][0]:
                more.append((m.start(), m.end(), kind))
        taken = sorted(taken + more) if more else taken
    return taken


def entity(kind: str, mention: str) -> str:
    """What mentions of one entity have in common: case and separators do not matter, nor a leading country code 1."""
    if kind == "name":
        m = _FIND["name"].search(mention)
        return f"{m['given']} {m['family']}".lower()
    if kind == "ip":
        return ".".join(str(int(x)) for x in mention.split("."))
    if kind == "email":
        # Letter by letter, so that each keeps its place; a letter whose small form is longer stays as it is.
        return "".join(low if len(low := c.lower()) == 1 else c for c in mention)
    plain = re.sub(r"[^0-9a-z]", "", mention.lower())
    return plain[1:] if kind == "phone" and len(plain) == 11 and plain[0] == "1" else plain


def _letters(plain: str, stream: Stream) -> str:
    """Digits become digits, hexadecimal stays so, letters become letters of their script; the rest stays."""
    out = []
    for ch in plain:
        if ch.isdigit():
            out.append(str(stream.below(10)))
        elif "a" <= ch <= "z":
            out.append(chr(97 + stream.below(26)))
        elif "а" <= ch <= "я":
            out.append(chr(ord("а") + stream.below(32)))
        elif ch.isalnum():
            out.append("áéíóúüöäñç"[stream.below(10)])
        else:
            out.append(ch)
    return "".join(out)


def _host(host: str, domain: str, key: bytes, attempt: int) -> str:
    """A host's replacement, never the host itself if it has a letter or digit."""
    stream = Stream(key, "domain", domain, *([attempt] if attempt else []))
    while (out := _letters(host, stream)) == host and any(map(str.isalnum, host)):
        pass
    return out


def _luhn(digits: str) -> int:
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10


def surrogate(kind: str, plain: str, key: bytes, attempt: int = 0) -> str:
    """The replacement of an entity in plain form. Format facts hold on: length, alphabet, a valid check digit, ranges, gender."""
    stream = Stream(key, kind, plain, attempt)
    while True:
        if kind == "ip":
            out = ".".join(str(stream.below(256)) for _ in range(4))
        elif kind == "secret":
            out = "".join("0123456789abcdef"[stream.below(16)] for _ in plain)
        elif kind == "card":
            out = "".join(str(stream.below(10)) for _ in plain[:-1])
            check = next(str(d) for d in range(10) if _luhn(out + str(d)) == 0)
            out += check if _luhn(plain) == 0 else str((int(check) + 1 + stream.below(9)) % 10)
        elif kind == "email":
            local, _, domain = plain.partition("@")
            host, dot, top = domain.rpartition(".")
            # A domain is an entity inside an entity: it has one replacement in all addresses. Only where the local part leaves nothing
            # to draw again, a further attempt draws another host.
            again = 0 if any(map(str.isalnum, local)) else attempt
            out = _letters(local, stream) + "@" + _host(host, domain, key, again) + dot + top
        elif kind == "iban":
            out = plain[:2] + _letters(plain[2:], stream)
        elif kind == "name":
            given, family = plain.split(" ", 1)
            script, gender = next(v for n, v in _GENDER.items() if n.lower() == given)
            names = GIVEN[script, gender]
            tail = "".join(SYLLABLES[script][stream.below(len(SYLLABLES[script]))] for _ in range(4))
            out = f"{names[stream.below(len(names))]} {tail}".lower()
        else:
            out = _letters(plain, stream)
        if out != plain:
            return out


def dressed(kind: str, mention: str, new: str) -> str:
    """``new`` in the dress of a mention: its separators, case, country code and title."""
    if kind == "name":
        m = _FIND["name"].search(mention)
        words = [w.upper() if old.isupper() and len(old) > 1 else w.capitalize() for w, old in zip(new.split(" "), (m["given"], m["family"]))]
        return mention[:m.start("given")] + " ".join(words)
    if kind == "ip":
        return new
    if kind == "email":
        return "".join(c.upper() if o.isupper() else c for c, o in zip(new, mention))
    new = new.upper() if mention.isupper() else new
    places = [k for k, ch in enumerate(mention) if ch.isalnum()][-len(new):]
    out = list(mention)
    for k, ch in zip(places, new):
        out[k] = ch.upper() if mention[k].isupper() else ch
    return "".join(out)


def _entities(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(kind, entity(kind, s[a:b])) for s in (t.decode("utf-8", "replace") for t in raw(batch, text_col)) for a, b, kind in find_entities(s)}
            rows = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["kind", "plain"])

    return run


def _assign(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(k, p, key, n) for k, p, n in zip(*(c.to_pylist() for c in batch.columns))]
            yield appended(batch, {"new": pa.array(new, pa.string())})

    return run


def checked_attempts(docs: DataFrame, *, text_col: str, key: bytes, most_rounds: int = 50) -> DataFrame:
    """kind, plain, attempt of entities whose first surrogate was another's too, or an original: each round settles all but
    the smallest of those that collide. An error is raised if some still do after ``most_rounds`` rounds."""
    known = written(docs.select(text_col).mapInArrow(_entities(text_col), "kind string, plain string").distinct(), "entities")
    current = known.withColumn("attempt", F.lit(0))
    for _ in range(most_rounds):
        given = written(current.mapInArrow(_assign(key), "kind string, plain string, attempt int, new string"), "surrogates")
        twice = given.groupBy("kind", "new").agg(F.min("plain").alias("keeps"), F.count(F.lit(1)).alias("n")).where("n > 1")
        clash = (given.join(twice, ["kind", "new"]).where("plain <> keeps").select("kind", "plain")
                 .union(given.join(known.select("kind", F.col("plain").alias("new")), ["kind", "new"]).select("kind", "plain")).distinct())
        clash = written(clash.withColumn("again", F.lit(1)), "clashes")
        if clash.isEmpty():
            return given.where("attempt > 0").select("kind", "plain", "attempt")
        current = given.drop("new").join(clash, ["kind", "plain"], "left").select("kind", "plain", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"))
    raise ValueError(f"surrogates still collide after {most_rounds} rounds")


def _mentions(id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted({(i, kind, entity(kind, s[a:b])) for i, s in zip(batch.column(batch.schema.names.index(id_col)).to_pylist(),
                                                                         (t.decode("utf-8", "replace") for t in raw(batch, text_col)))
                           if i is not None for a, b, kind in find_entities(s)})
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64())] + [pa.array([r[k] for r in rows], pa.string()) for k in (1, 2)],
                                             ["doc", "kind", "plain"])

    return run


def replace_entities(docs: DataFrame, *, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, n_replaced, and entities (kind and characters in the new text).

    A surrogate follows from ``key`` and the entity alone, so all mentions of an entity, in any document and any
    dress, get the same one, and nobody without the key gets back. Distinct entities are gathered (duplicates combined
    in the tasks), surrogates that meet each other or an original are drawn again, and only documents that mention such an
    entity receive its attempt, through a join on the id; all others are rewritten where they are read.

    Null texts stay null, empty ones empty. Where kinds overlap the more telling one wins (order of ``PATTERNS``). A row of null id cannot
    be told of a second attempt and keeps first surrogates, so distinctness is not promised there. Rows that share an id
    share attempts, which changes nothing: an attempt belongs to the entity. Input columns of the added names are replaced.
    """
    base = without(docs, "n_replaced", "entities", "_again")
    again = written(checked_attempts(base, text_col=text_col, key=key), "attempts")
    if not again.isEmpty():
        told = (base.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(_mentions(id_col, text_col), "doc long, kind string, plain string")
                .join(again, ["kind", "plain"]).groupBy(F.col("doc").alias("_doc")).agg(F.collect_set(F.struct("kind", "plain", "attempt")).alias("_again")))
        base = base.join(told, F.col(id_col).cast("long") == F.col("_doc"), "left").drop("_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.schema.get_field_index(text_col)
            attempts = batch.column(batch.schema.names.index("_again")).to_pylist() if "_again" in batch.schema.names else [None] * batch.num_rows
            texts, spans = [], []
            for data, null, more in zip(raw(batch, text_col), batch.column(col).is_null().to_pylist(), attempts):
                s = data.decode("utf-8", "replace")
                later = {(x["kind"], x["plain"]): x["attempt"] for x in more or ()}
                out, place, done, found = [], 0, 0, []
                for a, b, kind in find_entities(s):
                    plain = entity(kind, s[a:b])
                    new = dressed(kind, s[a:b], surrogate(kind, plain, key, later.get((kind, plain), 0)))
                    out += [s[done:a], new]
                    place += a - done
                    found.append({"kind": kind, "start": place, "end": place + len(new)})
                    place, done = place + len(new), b
                texts.append(None if null else "".join([*out, s[done:]]) if out else s)
                spans.append(found)
            batch = batch.set_column(col, batch.schema.field(col), pa.array(texts, batch.column(col).type))
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield appended(batch, {"n_replaced": pa.array([len(x) for x in spans], pa.int64()), "entities": pa.array(spans, kind)})

    return without(map_rows(base, run, FIELDS), "_again")

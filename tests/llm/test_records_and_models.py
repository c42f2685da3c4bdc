"""Archives, chat logs, language models, quality rules and the chain classifier: edge cases, round trips, plain versions."""

import base64
import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.llm import crf, divergence_rules, quality_crf
from skygrid.llm.chat_events import chat_events, digest_conversations, fold_events, read_piece, render
from skygrid.llm.common import table, written
from skygrid.llm.lm_difference import ModelSize, score_difference
from skygrid.llm.warc import VERSION, assemble_captures, read_archives, write_archives

# -- archives

HTML = ["<p>same</p>", "<p>same</p>", None, "", "é" * 3000, f"a {VERSION} b\r\n{VERSION}\r\nWARC-Type: request\r\n\r\n", f"{VERSION}", "0\r\n\r\nx\r\n",
        f"x\r{VERSION}\r", f"{VERSION}{VERSION}\n\n", "<p>other</p>"]


def test_archive_round_trip(spark, tmp_path):
    rows = [(k, f"http://h{k}.example/p?{k}", h) for k, h in enumerate(HTML)] + [(20, "x\r\ny " + VERSION, "<p>same</p>"), (None, None, "<p>same</p>"), (4, "u", HTML[4])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    write_archives(pages.repartition(3), str(tmp_path / "w"))
    records = read_archives(spark, str(tmp_path / "w"))
    assert records.count() == 3 * len(rows)
    got = assemble_captures(records).collect()
    assert len(got) == len(rows)
    payloads = Counter()
    for r in got:
        assert r.request.block.startswith("GET ") and r.n_requests == 1 and r.n_metadata == 1
        page, payload = r.metadata.fields.get("pageId"), bytes(r.response.payload)
        html = dict((str(i), h) for i, _, h in rows if i is not None)[page] if page else "<p>same</p>"
        full = (html or "").encode()
        assert r.response.payload_digest == base64.b32encode(hashlib.sha1(full).digest()).decode()
        first = min(int(i) for i, _, h in rows if i is not None and (h or "") == (html or ""))
        revisit = page is None or int(page) != first
        assert r.response.record_type == ("revisit" if revisit else "response") and payload == (b"" if revisit else full)
        payloads[r.response.record_type] += 1
    assert payloads["revisit"] == 4  # pages 1, 20 and the one without an id, and the second empty payload
    ids = {r.record_id for r in got if r.response.record_type == "response"}
    assert all(r.response.refers_to in ids for r in got if r.response.record_type == "revisit")


def test_partners_of_a_capture(spark):
    """Several, repeated and missing partners, and partners of no capture."""
    rows = [("r1", "response", None), ("r2", "revisit", None), ("q2", "request", "r1"), ("q1", "request", "r1"), ("q1", "request", "r1"),
            ("m1", "metadata", "r1"), ("m9", "metadata", "gone"), ("q9", "request", None)]
    records = spark.createDataFrame(rows, "record_id string, record_type string, concurrent_to string").selectExpr(
        "*", "cast(null as string) refers_to", "'u' target_uri", "'d' date", "'x' payload_digest", "cast(concat('k: ', record_id) as binary) block",
        "'h' http_head", "cast('p' as binary) payload")
    got = {r.record_id: r for r in assemble_captures(records).collect()}
    assert set(got) == {"r1", "r2"}
    one, two = got["r1"], got["r2"]
    assert (one.n_requests, one.n_metadata, one.request.id, one.request.block) == (2, 1, "q1", "k: q1")
    assert (one.metadata.id, one.metadata.fields) == ("m1", {"k": "m1"})
    assert (two.n_requests, two.n_metadata, two.request, two.metadata) == (0, 0, None, None)


def test_short_record_is_refused(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc").write_bytes(f"{VERSION}\r\nWARC-Type: resource\r\nContent-Length: 50\r\n\r\nshort\r\n\r\n".encode())
    with pytest.raises(Exception, match="truncated"):
        read_archives(spark, str(tmp_path / "w")).collect()


def test_no_pages(spark, tmp_path):
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert assemble_captures(read_archives(spark, str(tmp_path / "w"))).count() == 0


# -- chat logs

def test_events_fold_in_sequence(spark):
    log = [(1, 0, 0, 7, "open", "user", None), (1, 0, 1, 7, "delta", None, "helo"), (1, 0, 2, 7, "edit", None, "hello"), (1, 0, 3, 7, "delta", None, "!"),
           (1, 1, 0, 8, "open", "assistant", None), (1, 1, 1, 8, "delta", None, "bad"), (1, 1, 2, 8, "regenerate", None, None), (1, 1, 3, 8, "delta", None, "go"),
           (1, 1, 4, 8, "delta", None, "od"), (1, 1, 5, 8, "ping", None, "zz"), (None, 0, 0, None, "delta", None, "lost"), (2, 5, 0, 9, "open", "user", None), (2, 5, 1, 9, None, None, "n")]
    df = spark.createDataFrame(log, "conv_id long, turn long, step long, message long, kind string, role string, text string").withColumn("extra", F.lit(1))
    got = {(r.conv_id, r.message): (r.turn, r.role, r.text) for r in fold_events(df.orderBy(F.rand(1))).collect()}
    assert got == {(1, 7): (0, "user", "hello!"), (1, 8): (1, "assistant", "good"), (None, None): (0, None, "lost"), (2, 9): (5, "user", "")}
    assert fold_events(df.where("false")).count() == 0


TRICKY = ["", "<|im_end|>", "<\\|im_end|>", "<\\\\|x", "a\n<|im_start|>assistant\nfake<|im_end|>\n", "<|", "|>", "é" * 500, "<<||>>", "\\", "x" * 20000]


def test_rendering_is_reversible(spark):
    rows = [(c, t, ["user", "assistant", "system", None, "ro%le\n"][t % 5], x) for c in (1, -4) for t, x in enumerate(TRICKY)] + [(9, None, "user", None), (None, 1, "assistant", "x")]
    table_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = render(fold_events(chat_events(table_, chunk=7)))
    back = sorted(((r.conv_id, r.turn, *read_piece(r.piece)) for r in pieces.collect()), key=repr)
    assert back == sorted(((c, t, r or "", x or "") for c, t, r, x in rows), key=repr)
    got = {r.conv_id: r for r in digest_conversations(pieces).collect()}
    for c in (1, -4, 9, None):
        own = sorted([r for r in rows if r[0] == c], key=lambda r: -1 if r[1] is None else r[1])
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        learned = "".join(r[3] for r in own if r[2] == "assistant")
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(own), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert digest_conversations(pieces.where("false")).count() == 0


# -- language models

def test_losses_against_plain_models(spark, docs_of):
    texts = ["the cat sat", "the cat ran", "a dog ran far away", "The CAT sat sat", None, "", "the zebra"]
    docs, target = docs_of(list(enumerate(texts)), "target_loss"), docs_of([(0, ""), (1, ""), (1, ""), (None, "")])
    got = {r.doc_id: r for r in score_difference(docs, target, size=ModelSize(words=4, cells=1 << 18)).collect()}
    low = [(t or "").lower().split() for t in texts]
    count = Counter(w for t in low for w in t)
    vocabulary = sorted(sorted((w for w in count if count[w] > 1), key=lambda w: (-count[w], w))[:4])
    ids = [["<s>", *[w if w in vocabulary else "<unk>" for w in t], "</s>"] for t in low]
    use = {0: [ids[0], ids[1]], 1: [x for x in ids if len(x) > 2]}
    scale = {0: 1.0, 1: sum(map(len, use[0])) / sum(map(len, use[1]))}

    def loss(x, m):
        single, pair = Counter(w for t in use[m] for w in t), Counter(p for t in use[m] for p in itertools.pairwise(t))
        s, total, v = scale[m], scale[m] * sum(single.values()), len(vocabulary) + 3
        out = []
        for a, b in itertools.pairwise(x):
            one = (s * single[b] + 0.5) / (total + 0.5 * v)
            out.append(-math.log(0.7 * pair[a, b] / single[a] + 0.3 * one if single[a] else one))
        return sum(out) / len(out)

    for k, x in enumerate(ids):
        assert got[k].n_tokens == len(x) - 2
        if len(x) == 2:
            assert got[k].target_loss is None and got[k].loss_difference is None
        else:
            assert got[k].target_loss == pytest.approx(loss(x, 0), rel=1e-5) and got[k].background_loss == pytest.approx(loss(x, 1), rel=1e-5)
            assert got[k].loss_difference == pytest.approx(loss(x, 0) - loss(x, 1), abs=1e-5)
    assert score_difference(docs_of([]), docs_of([])).count() == 0


def test_counts_are_whole_and_exact(spark, docs_of):
    """More repeated words than 50,000, in many blocks and buckets: none is unknown, and no pair shares a count."""
    random.seed(5)
    words = [f"w{k}" for k in range(60_000)] * 2
    random.shuffle(words)
    texts = [" ".join(words[k:k + 1000]) for k in range(0, len(words), 1000)] + ["once here", "w1 w2 " * 300]
    size = ModelSize(block_bytes=100_000, bucket_tokens=20_000)
    got = {r.doc_id: r for r in score_difference(docs_of(list(enumerate(texts))), docs_of([(0, ""), (1, "")]), size=size).collect()}
    count = Counter(w for t in texts for w in t.split())
    ids = [["<s>", *[w if count[w] > 1 else "<unk>" for w in t.split()], "</s>"] for t in texts]
    v = len([w for w in count if count[w] > 1]) + 3
    assert v == 60_003
    use = {0: ids[:2], 1: ids}
    scale = {0: 1.0, 1: sum(map(len, ids[:2])) / sum(map(len, ids))}
    single = {m: Counter(w for t in use[m] for w in t) for m in use}
    pair = {m: Counter(p for t in use[m] for p in itertools.pairwise(t)) for m in use}

    def loss(x, m):
        s, total = scale[m], scale[m] * sum(single[m].values())
        one = [(s * single[m][b] + 0.5) / (total + 0.5 * v) for b in x[1:]]
        return -sum(math.log(0.7 * pair[m][a, b] / single[m][a] + 0.3 * p if single[m][a] else p) for a, b, p in zip(x, x[1:], one)) / (len(x) - 1)

    assert len(got) == len(texts)
    for k, x in enumerate(ids):
        assert got[k].target_loss == pytest.approx(loss(x, 0), rel=1e-9) and got[k].background_loss == pytest.approx(loss(x, 1), rel=1e-9)


# -- quality rules

def test_plain_counts():
    random.seed(1)
    texts = ["", "a", "a b c a b c", "x y z x y z x", "#a $b\n#a $b\n\n\nq", " é\té\x0b\x0cü\r\n", "\x1ca\x85b \xa0c"]
    texts += [" ".join(random.choices("ab", k=n)) for n in (3, 4, 30)] + ["\n".join(random.choices(["u v", "w", ""], k=12))]
    for t in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        triples = Counter(tuple(ws[k:k + 3]) for k in range(len(ws) - 2))
        covered = {k + j for k in range(len(ws) - 2) if triples[tuple(ws[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert divergence_rules.base_counts(t.encode())[1:] == want, t


def test_distance_is_jensen_shannon():
    p, q = np.array([1.0, 3, 0]), np.array([2.0, 0, 2])
    m = (p / 4 + q / 4) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a / 4, m) if x)
    assert divergence_rules.distance(p, q) == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2))
    assert divergence_rules.distance(p, p) == 0 and divergence_rules.distance(p, np.array([0, 0, 1.0])) == pytest.approx(1)


def test_rules_on_the_given_table(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    got = divergence_rules.judge_by_distribution(docs).join(labels, "doc_id").toPandas()
    assert got[~got.base_failed & (got.quality == 1)].kept.mean() > 0.97
    assert got[got.quality == 0].kept.mean() < 0.4


def test_rules_edge_cases(docs_of):
    rows = [(1, None), (2, ""), (3, "word " * 200), (4, " ".join(f"w{k} the" for k in range(60))), (None, "x")]
    got = {r.doc_id: r for r in divergence_rules.judge_by_distribution(docs_of(rows, "kept")).collect()}
    assert [got[k].base_failed for k in (1, 2, 3, 4, None)] == [True, True, True, False, True] and got[4].kept
    assert divergence_rules.judge_by_distribution(docs_of([])).count() == 0


def test_rare_languages_have_their_own_references(spark):
    """A language far below 0.1 % of all words is judged by itself, one without common words by characters only."""
    big = [(k, " ".join(f"e{(7 * k + 3 * j) % 100}" for j in range(400)), "en") for k in range(400)]
    random.seed(3)
    rare = [(1000, " ".join(random.choices([f"zz{j}" for j in range(60)], k=120)), "xx"), (1001, " ".join(f"字{j}" for j in range(600)), "yy")]
    docs = spark.createDataFrame(big + rare, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in divergence_rules.judge_by_distribution(docs).where("doc_id >= 1000").collect()}
    # Without the judged text nothing is left of their references: a text is never compared with itself.
    assert got[1000].kept and got[1000].word_distance is None and got[1000].char_distance is None
    assert got[1001].kept and got[1001].word_distance is None and got[1001].char_distance is None


def test_distances_against_a_plain_version(spark):
    """References of each language without the judged text, common words by their share of all, small references none."""
    rng = random.Random(8)
    rows = []
    for k in range(120):
        lang = rng.choice(["aa", "bb", "bb", None])
        vocabulary = [f"{lang}{'x' * (j % 5)}{j}" for j in range(400)]
        rows.append((k, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(400)], k=rng.randint(40, 300))), lang))
    rows += [(500, " ".join(f"{chr(97 + j % 26)}{j}" for j in range(150)), "cc"), (501, "# $ " * 300, "cc"), (502, "# 1 " * 300, "aa")]
    rules = divergence_rules.Rules(min_reference_chars=1500, min_reference_words=500)
    got = {r.doc_id: r for r in divergence_rules.judge_by_distribution(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rules=rules).collect()}

    kinds = lambda t: Counter("lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "blank" if c == " " else "other" for c in t)
    bag = lambda t: Counter(w for w in t.split() if w[0].isalnum())
    used = [r for r in rows if not got[r[0]].base_failed]
    assert 0 < len(used) < len(rows)

    def js(p, q):
        keys, a, b = set(p) | set(q), sum(p.values()), sum(q.values())
        part = lambda x, m: x * math.log2(x / m) if x else 0.0
        return math.sqrt(max(0.0, sum(part(p[c] / a, (p[c] / a + q[c] / b) / 2) + part(q[c] / b, (p[c] / a + q[c] / b) / 2) for c in keys) / 2))

    for i, text, lang in rows:
        every = sum((bag(t) for _, t, x in used if x == lang), Counter())
        common = {w for w, n in every.items() if n >= 0.002 * sum(every.values())}
        folded = lambda b: Counter({**{w: n for w, n in b.items() if w in common}, None: sum(n for w, n in b.items() if w not in common)})
        others = [t for j, t, x in used if x == lang and j != i]
        chars, words = sum(map(kinds, others), Counter()), folded(sum(map(bag, others), Counter()))
        want_char = js(kinds(text), chars) if sum(kinds(text).values()) >= 200 and sum(chars.values()) >= 1500 else None
        want_word = js(folded(bag(text)), words) if sum(bag(text).values()) >= 100 and common and sum(words.values()) >= 500 else None
        r = got[i]
        assert (r.char_distance, r.word_distance) == (pytest.approx(want_char), pytest.approx(want_word)), i
        assert r.kept == (not r.base_failed and (want_char or 0) <= rules.max_char_distance and (want_word or 0) <= rules.max_word_distance)


# -- chain classifier

def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    lengths, move = np.array([4, 1, 3]), rng.normal(size=(2, 2))
    score, mask = crf.padded(lengths, rng.normal(size=(8, 2)))
    p, pairs = crf.marginals(score, mask, move)
    want_pairs = np.zeros((2, 2))
    for k, n in enumerate(lengths):
        z, own = 0.0, np.zeros((n, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(score[k, t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in itertools.pairwise(path)))
            z += w
            for t, y in enumerate(path):
                own[t, y] += w
        assert p[k, :n] == pytest.approx(own / z) and (p[k, n:] == 0).all()
        for path in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(score[k, t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in itertools.pairwise(path)))
            for a, b in itertools.pairwise(path):
                want_pairs[a, b] += w / z
    assert pairs == pytest.approx(want_pairs)


def test_held_out_accuracy_and_edges(spark, docs_of):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    odd = docs_of([(-1, None), (-2, ""), (None, "a line\nmore")]).select("doc_id", "text")
    got = quality_crf.score_quality(docs.union(odd), labels).toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    seen = got.merge(labels.toPandas(), on="doc_id")
    held = seen[seen.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.9
    empty = got[got.doc_id.isin([-1, -2])]
    assert empty.score.nunique() == 1
    none = quality_crf.score_quality(odd, labels.where("false")).toPandas()
    assert (none.score == 0.5).all() and quality_crf.score_quality(docs_of([]), labels).count() == 0


def test_a_block_holds_a_word_once():
    """A word that comes a million times in a block takes a number each time, not an object."""
    import tracemalloc

    from skygrid.llm.lm_difference import Block

    texts = [b" ".join(b"word%d" % (k * 7 % 50) for k in range(2000))] * 150
    tracemalloc.start()
    b = Block(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(b.words) == 50 and b.word_counts.sum() == 300_000 and int(b.pair_counts.sum()) == 150 * 2001
    assert peak < 80 * 300_000


def test_targets_are_marked_in_blocks_and_counted_in_one_reading(spark, monkeypatch):
    """Repeated, null and text ids over many blocks and buckets; a text in the target is held and dealt out once, not for each model."""
    from skygrid.llm import lm_difference

    rng, held = random.Random(11), {}
    monkeypatch.setattr(lm_difference, "written", lambda df, name: held.setdefault(name, written(df, name)))
    words = [f"w{k}" for k in range(3000)]
    rows = [(rng.choice([None, *(f"id{j}" for j in range(250))]), " ".join(rng.choices(words, [1 / (j + 1) for j in range(3000)], k=rng.randint(0, 60)))) for _ in range(400)]
    targets = [f"id{j}" for j in range(0, 250, 2)]
    docs, wanted = spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame([(x,) for x in [*targets, targets[0], None, "other"]], "doc_id string")
    got = lm_difference.score_difference(docs, wanted, size=ModelSize(block_bytes=2000, bucket_tokens=300)).collect()
    assert held["blocks"].count() > 30 and held["blocks"].agg(F.sum("n_docs")).first()[0] == sum(bool(t) for _, t in rows)
    assert len(got) == len(rows)

    count = Counter(w for _, t in rows for w in t.split())
    line = lambda t: ["<s>", *[w if count[w] > 1 else "<unk>" for w in t.split()], "</s>"]
    use = [[line(t) for _, t in rows if t], [line(t) for i, t in rows if t and i in targets]]
    single, pair = [Counter(w for t in u for w in t) for u in use], [Counter(p for t in u for p in itertools.pairwise(t)) for u in use]
    scale, v = (sum(single[1].values()) / sum(single[0].values()), 1.0), sum(n > 1 for n in count.values()) + 3

    def loss(x, m):
        one = [(scale[m] * single[m][b] + 0.5) / (scale[m] * sum(single[m].values()) + 0.5 * v) for b in x[1:]]
        return -sum(math.log(0.7 * pair[m][a, b] / single[m][a] + 0.3 * p if single[m][a] else p) for a, b, p in zip(x, x[1:], one)) / (len(x) - 1)

    want = sorted((i or "", t, loss(line(t), 0), loss(line(t), 1)) for i, t in rows if t)
    for r, (i, t, all_texts, target) in zip(sorted((r for r in got if r.text), key=lambda r: (r.doc_id or "", r.text)), want, strict=True):
        assert (r.doc_id or "", r.text, r.n_tokens) == (i, t, len(t.split()))
        assert r.background_loss == pytest.approx(all_texts, rel=1e-9) and r.target_loss == pytest.approx(target, rel=1e-9)


def test_pairs_take_the_same_room_in_many_buckets():
    """More buckets come with a larger corpus: what a block sends them and hears from them must not grow with their number."""
    from skygrid.llm.lm_difference import PairKeys, _folded, _pack, _unfolded, _unpack

    every = np.arange(64)
    assert np.unique(PairKeys(6, 3, 1).keys(np.repeat(every, 64), np.tile(every, 64))).size == 64 * 64
    rng, room = np.random.default_rng(2), {}
    words = np.minimum(rng.zipf(1.2, (2, 400_000)), 999_999)
    pairs = np.unique(words[0] * 1_000_000 + words[1])
    n = rng.zipf(1.5, pairs.size) % 500
    for buckets in (20, 600):
        deal = PairKeys.of(1_000_000, 25, buckets)
        keys, sent = np.sort(deal.keys(pairs // 1_000_000, pairs % 1_000_000)), []
        assert np.unique(keys).size == keys.size and set(deal.kinds(keys)) == {0, 1, 2, 3}
        keys = keys[np.argsort(deal.bucket(keys), kind="stable")]
        distances, kinds = deal.distances(keys), deal.kinds(keys)
        for k, s in deal.spans(keys):
            sent.append(_pack(distances[s], kinds[s], n[s], plain=1))
            distance, kind, count = _unpack(sent[-1], 3, plain=1)
            assert (deal.restored(k, distance, kind) == keys[s]).all() and (count == n[s]).all()
        assert len(sent) == buckets
        room[buckets] = sum(map(len, sent))
    assert room[600] < 1.35 * room[20]
    for bits, common, buckets in ((5, 2, 3), (16, 12, 3), (31, 13, 7919), (31, 31, 100), (32, 32, 100)):
        deal = PairKeys(bits, common, buckets)
        first, second = (rng.integers(0, 1 << np.array([common, bits])[rng.integers(0, 2, 50_000)]) for _ in range(2))
        keys = np.unique(deal.keys(first, second))
        assert keys.size == len(set(zip(first.tolist(), second.tolist())))
        keys = keys[np.argsort(deal.bucket(keys), kind="stable")]
        found, distances = list(deal.spans(keys)), deal.distances(keys)
        assert [s.stop for _, s in found] == [*[s.start for _, s in found[1:]], keys.size] and len({k for k, _ in found}) == len(found)
        assert all((deal.restored(k, distances[s], deal.kinds(keys[s])) == keys[s]).all() for k, s in found)
    assert _unpack(_pack(np.zeros(0, np.int64), np.zeros(0, np.int64)), 2)[1].size == 0
    assert PairKeys.of((1 << 32) - 1, 9, 9) == PairKeys(32, 32, 9) and PairKeys.of((1 << 31) - 1, 9, 9) == PairKeys(31, 12, 9)
    with pytest.raises(ValueError):
        PairKeys.of(1 << 32, 9, 9)
    odd = np.arange(-50, 50)
    assert (_unfolded(_folded(odd)) == odd).all() and _folded(odd).min() == 0

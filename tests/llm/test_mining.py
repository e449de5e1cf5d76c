"""Hard negatives, encoding and decoding, divergence of sources: against brute force on odd rows and ties."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.data import SF, no_docs, odd_docs
from wattloom.llm import bpe, divergence, hard_negatives as hard
from wattloom.llm.queries import QUERIES

# ---- hard negatives


def brute_negatives(rows, k=5, m=5, scale=256, is_anchor=lambda i: i % 100 == 0):
    fit = defaultdict(list)
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit[i].append((label, [math.floor(scale * x) for x in v]))
    fit = {i: min(x) for i, x in fit.items()}
    out = []
    for a, (label, q) in fit.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in fit.items() if i != a)
        for s, i, _ in [x for x in scored if x[2] == label][:k]:
            found = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:m]
            out += [(a, i, r, j, -s, -t) for r, (t, j, _) in enumerate(found, 1)]
    return sorted(out)


def vectors(seed, n=700, dims=3, wide=4):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-wide, wide) / 256 for _ in range(dims)], rng.randint(0, 3)) for i in range(0, n * 10, 10)]
    rows += [(i, [x for x in rows[0][1]], 1) for i in range(7, 60, 10)]  # many equal vectors
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, id long, rank int, a int, score string"


@pytest.mark.parametrize("block", [64, 4096])
def test_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard, "ROW_BLOCK", block)
    monkeypatch.setattr(hard, "ANCHOR_BLOCK", 32)
    rows = vectors(3)
    rows += [(None, rows[0][1], 1), (11, None, 1), (12, rows[0][1], None), (13, [1.0, None, 0.5], 1), (14, [float("nan"), 0.0, 1.0], 2),
             (15, [float("inf"), 0.0, 1.0], 2), (100, rows[3][1], 0), (100, rows[3][1], 0), (200, [0.0, 0.0, 0.0], 1), (-300, [0.5, -1.0, 0.25], 2)]
    df = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in hard.mine(df).collect())
    assert got == brute_negatives(rows) and len(got) > 500


def test_negatives_of_other_shapes(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard.mine(empty).count() == 0
    assert hard.mine(empty).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    one = spark.createDataFrame([(0, [1.0], 1, 0, 0, 0, "")], SCHEMA)
    assert hard.mine(one).count() == 0
    uneven = [(0, [1.0, 2.0], 1), (1, [1.0], 1), (2, [0.95, 0.0, 5.0], 2), (3, [], 2)]
    got = hard.mine(spark.createDataFrame([(*r, 0, 0, 0, "") for r in uneven], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 65536, 256 * math.floor(256 * np.float32(0.95)))]


def test_negatives_too_large_fail(spark):
    df = spark.createDataFrame([(0, [1e12], 1, 0, 0, 0, ""), (1, [1e12], 1, 0, 0, 0, "")], SCHEMA)
    with pytest.raises(Exception, match="64 bits"):
        hard.mine(df).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 120), st.integers(1, 6), st.sampled_from([1, 3, 200, 1 << 20, 1 << 28]))
def test_threshold_stops_only_when_nothing_is_missed(seed, n, dims, most):
    rng = np.random.default_rng(seed)
    lists = hard.Lists(rng.permutation(n), rng.integers(0, 3, n), rng.integers(-most, most + 1, (n, dims)))
    anchor, own = rng.integers(-most, most + 1, dims), 1
    scores = lists.vectors @ anchor
    windows = [(None, None), (int(np.quantile(scores, 0.3)), int(np.quantile(scores, 0.8))), (int(scores.max()) + 1, None)]
    for (low, high), found in zip(windows, hard.first_k(lists, anchor, lists.labels == own, windows, 4), strict=True):
        want = sorted((-s, i) for s, i, x in zip(scores.tolist(), lists.ids.tolist(), lists.labels.tolist(), strict=True)
                      if x == own and (low is None or s >= low) and (high is None or s <= high))[:4]
        assert [(-s, i) for i, s in found.T.tolist()] == want


def test_threshold_leaves_lists_early():
    rng = np.random.default_rng(1)
    values = rng.integers(-5, 6, (4096, 2))
    values[:8] = 1000 + np.arange(16).reshape(8, 2)
    lists = hard.Lists(np.arange(4096), np.zeros(4096, np.int64), values)
    rounds = list(lists.read(np.array([3, 2])))
    met = 0
    for new, scores, best in rounds:
        met += len(new)
        if best is not None and best < 5 * 1000:
            break
    assert met < 100
    assert sum(len(new) for new, *_ in rounds) == 4096


# ---- encoding

@pytest.fixture(scope="module")
def coder():
    path = public_tokenizers.path(bpe.VOCABULARY)
    return bpe.Bpe(path), Tokenizer.from_file(path)


def same(coder, texts):
    own, library = coder
    got = own.encode([t.encode() for t in texts])
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in got] == [e.ids for e in want]
    assert [own.decode(x.tolist()) for x in got] == [library.decode(e.ids, skip_special_tokens=False) for e in want]


def test_ids_of_odd_texts(coder):
    rng = random.Random(7)
    parts = [*"abcstrevlmdAIS'' \n\t\r  0123é漢!?.<|>\x1c\x85\xa0²\U0001F600ΑΣİ", "́", "࢙ٕ", " ", "<|endoftext|>", "<|startoftext|>",
             "'re", "'LL", "ing", "the ", "aaaa", "!!!!"]
    same(coder, ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(4000)])
    same(coder, ["".join(chr(c) for c in (rng.randrange(0x110000) for _ in range(20)) if not 0xD800 <= c < 0xE000) for _ in range(500)])


def test_ids_of_long_words(coder, monkeypatch):
    rng = random.Random(2)
    texts = ["a" * 700, "".join(rng.choice("abcdefgh") for _ in range(900)), "漢" * 200 + "字", "aab" * 300]
    same(coder, texts)
    monkeypatch.setattr(bpe, "LONG_WORD", 40)  # the heap for long words
    coder[0].known.clear()
    coder[0].memo.clear()
    same(coder, texts + ["a" * n for n in range(39, 60)])


def test_ids_when_the_memo_is_full(coder, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PARTS", 3)
    for n in range(4):
        same(coder, [f"one two{n} three four{n} one", "five one", ""])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_ids_of_any_text(coder, texts):
    same(coder, texts)


def test_encoded_rows(spark, coder):
    _, library = coder
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs(spark).collect() if r["doc_id"] is not None}
    rows = bpe.encode_texts(odd_docs(spark)).collect()
    assert len(rows) == odd_docs(spark).count()
    for r in rows:
        if r["doc_id"] is not None:
            e = library.encode(texts[r["doc_id"]], add_special_tokens=False)
            assert (r["n_tokens"], r["ids"], r["decoded"]) == (len(e.ids), e.ids, library.decode(e.ids, skip_special_tokens=False))
    assert bpe.encode_texts(no_docs(spark)).count() == 0


def test_bpe_query(spark, coder):
    _, library = coder
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# ---- divergence

def brute_audit(rows, least=3, ranks=200):
    own, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        own[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        q = shares(sum((own[lang, s] for s in sources), Counter()))
        p = {s: shares(own[lang, s]) for s in sources}
        for g in sources:
            pair = [(s, sum((p[g][t] - p[s][t]) ** 2 // p[s][t] for t in kept)) for s in sources if s != g]
            term = [(t, (p[g][t] - q[t]) ** 2 // q[t]) for t in kept if own[lang, g][t] and p[g][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, g, part, i, v, r) for r, (i, v) in enumerate(items if part == "pair" else items[:ranks], 1)]
    return sorted(out)


def audited(df, **options):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(df, **options).collect())


def text_rows(seed, n=150):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcDEfé漢" for b in "xyZ"] + ["b-c", "it's", "x1y", "\U0001F600", "\x85", "A\x00B"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice("ab"), rng.choice("pqrs")) for _ in range(n)]
    copy = rows[3][0]
    return rows + [(copy, "a", s) for s in "ppppqqrv"] + [("only here", "c", "p"), (None, "c", "q"), ("", None, None), (None, "d", "p")]


@pytest.mark.parametrize("options", [{}, {"block": 7}])
def test_audit_equals_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", options.get("block", divergence.BLOCK_COUNTS))
    rows = text_rows(4)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "text string, lang string, source string, n long, v long, digest string")
    assert audited(df) == brute_audit(rows)
    assert audited(df, ranks=2, least_docs=1) == brute_audit(rows, 1, 2)


def test_audit_of_odd_rows(spark):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs(spark).collect()]
    assert audited(odd_docs(spark)) == brute_audit(rows)
    assert audited(no_docs(spark)) == []
    assert divergence.audit(no_docs(spark)).columns == ["lang", "source", "part", "item", "value", "rank"]


def test_copies_are_read_once(spark):
    rows = [("same text here", "a", "p")] * 5 + [("same text here", "a", "q")] * 2 + [("same text here", "b", "q")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = {r["lang"]: {s["source"]: s["n"] for s in r["sources"]} for r in divergence.collapsed(df, "text", "lang", "source").collect()}
    assert got == {"a": {"p": 5, "q": 2}, "b": {"q": 1}}

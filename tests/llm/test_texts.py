"""Operators on single texts, conversations and pages, and the mix."""

import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.data import SF, no_docs, odd_docs
from tests.oracle import compare, connect
from wattloom.llm import chat, mixing, pii, quality, token_count, toxicity, warc
from wattloom.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) is None


# ---- quality

def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality_odd_rows(spark):
    rows = quality.judge(odd_docs(spark).unionByName(spark.createDataFrame(
        [(20, "a b c a b c\nx\nx\n\n x\n#|<>", None, None, 0, 0, "", 0, 0, 0, 0)], odd_docs(spark).schema))).collect()
    texts = {r["doc_id"]: r["text"] for r in odd_docs(spark).collect() if r["doc_id"]} | {20: "a b c a b c\nx\nx\n\n x\n#|<>"}
    assert len(rows) == 14
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_quality(
                texts[r["doc_id"]])
            assert not (r["kept"] and r["base_failed"])
    assert quality.judge(no_docs(spark)).count() == 0


# ---- tokens

@pytest.fixture(scope="module")
def counter():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_count.VOCABULARY)
    return token_count.TokenCounter(path), Tokenizer.from_file(path)


def test_tokens_of_odd_texts(counter):
    own, library = counter
    rng = random.Random(1)
    parts = [*"abcstrevlmd'' \n\t\r  0123é漢!?.<|>\x1c\x85\xa0\u3000²\U0001F600", "<|endoftext|>", "'re", "'ll", " '", "ing", "the ", "   "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    assert own.count(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_tokens_of_any_text(counter, texts):
    own, library = counter
    assert own.count(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_tokens_of_rows(spark, counter):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for source in (docs, odd_docs(spark)):
        texts = Counter((r["doc_id"], r["text"] or "") for r in source.collect())
        want = Counter()
        for (d, t), n in texts.items():
            k = len(counter[1].encode(t, add_special_tokens=False).ids)
            want[d, len(t.encode()), k, k > 1024] += n
        got = Counter((None if r[0] is None else r[0], *r[1:]) for r in token_count.count_tokens(source).collect())
        if source is docs:
            assert got == want
        else:  # ids beside nulls pass through pandas as floats
            assert Counter(k[1:] for k in got.elements()) == Counter(k[1:] for k in want.elements())
    assert token_count.count_tokens(no_docs(spark)).count() == 0


# ---- personal data

def brute_base(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            spans.append(("card", *m.span()))
    return spans + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_base_spans():
    rng = random.Random(2)
    parts = [*"ab.@-+()0123456789 12.9 5", "a@b.c", "1.2.3.4", "+1 (702) 555-0742", "4242424242424242", "..", "@@", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == brute_base(text)
    assert len(pii.base_spans("a" * 200_000 + " " + "1" * 200_000)) == 0


@pytest.fixture(scope="module")
def field():
    return pii.train(pii.labelled_rows())


def test_field_is_decoded_as_a_whole(field):
    """Runs between settled words give the labels of plain Viterbi over the whole text."""
    table = pii.labelled_rows()
    texts = [w for w in table["words"]] + [sum(table["words"].tolist()[:40], [])]
    tagger = pii.Tagger(field)
    got = {(i, j) for i, j in tagger.secrets(texts)}
    want = set()
    for i, words in enumerate(texts):
        rows = [field.scores(w) for w in words]
        score = np.zeros((len(words), 3))
        for t in range(len(words)):
            for k, d in enumerate(pii.OFFSETS):
                if 0 <= t + d < len(words):
                    score[t] += rows[t + d][k]
        best, came = score[0], []
        for t in range(1, len(words)):
            step = best[:, None] + field.pairs
            came.append(step.argmax(0))
            best = step.max(0) + score[t]
        label = int(best.argmax())
        for t in range(len(words) - 1, -1, -1):
            if label:
                want.add((i, t))
            label = int(came[t - 1][label]) if t else label
    assert got == want
    gold = {(i, j) for i, labels in enumerate(table["labels"]) for j, x in enumerate(labels) if x != "O"}
    assert {g for g in got if g[0] < len(table)} == gold


def test_field_on_unseen_rows(field):
    """Trained on the first two thirds of the labelled table, it finds the secrets of the rest."""
    table = pii.labelled_rows()
    tagger = pii.Tagger(pii.train(table.iloc[:120]))
    rest = table.iloc[120:].reset_index(drop=True)
    gold = {(i, j) for i, labels in enumerate(rest["labels"]) for j, x in enumerate(labels) if x != "O"}
    got = set(tagger.secrets(rest["words"].tolist()))
    assert len(got & gold) >= 0.9 * len(gold) and len(got - gold) <= 0.1 * len(gold)


def test_personal_data_of_rows(spark):
    secret = hashlib.sha256(b"x").hexdigest()[:40]
    text = f"call +1 (702) 555-0742, token = \"{secret}\" at 10.0.0.1"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.find_personal(docs).collect()}
    assert (rows[1]["n_phone"], rows[1]["n_ip"], rows[1]["n_secret"], rows[2]["spans"]) == (1, 1, 1, "")
    ip, hidden = text.index("10.0"), text.index(secret)
    base = f"ip:{ip}:{ip + 8},phone:5:22"
    assert rows[1]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert rows[1]["spans"] == f"{base},secret:{hidden}:{hidden + 40}"
    assert {r["text"] for r in pii.redact_texts(docs).collect()} == {'call [PHONE], token = "[SECRET]" at [IP]', None}
    assert pii.find_personal(odd_docs(spark)).count() == 13 == pii.redact_texts(odd_docs(spark)).count()
    assert pii.redact_texts(no_docs(spark)).count() == 0


# ---- mix

def test_targets_share_out_excess(spark):
    sizes = [("a", 100), ("b", 10_000), ("c", 50), (None, 3_000), ("d", 0)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weight = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    left, open_, want = 1.5 * 13_150, set(weight), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * dict(sizes)[s]}
        if not over:
            want |= {s: left * weight[s] / total for s in open_}
            break
        want |= {s: 2.0 * dict(sizes)[s] for s in over}
        left -= sum(2.0 * dict(sizes)[s] for s in over)
        open_ -= over
    assert got == pytest.approx(want)


def test_mix_meets_targets(spark):
    rows = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) < 5 for s, t in target.items())
    whole = mixing.mix(odd_docs(spark), whole_rows=True)
    assert whole.count() == 13 and {"text", "lang", "taken"} <= set(whole.columns)
    assert mixing.mix(no_docs(spark)).count() == 0


# ---- chat

@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "s>", "[", "INST]", "a", "é", "\n"]), max_size=12).map("".join))
def test_escapes(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in chat.CONTROLS)


def test_chat_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", ""), (1, 1, "assistant", "\\</s>"), (None, 0, "tool", "[ROLE]x"), (2, 5, "system", "s"),
            (2, 1, "user", "u"), (2, 1, "user", "u")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS input_ids", "2 AS loss_mask"))).collect()}
    sha = {k: hashlib.sha256(v.encode()).hexdigest() for k, v in {
        1: "\n\nassistant\n\nassistant\n\\</s>\n", None: "tool\n[ROLE]x\n", 2: "user\nu\nuser\nu\nsystem\ns\n"}.items()}
    assert {k: (r["turns_sha256"], r["n_turns"]) for k, r in got.items()} == {k: (v, {1: 3, None: 1, 2: 3}[k]) for k, v in sha.items()}
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (5, hashlib.sha256(b"\\</s>").hexdigest())
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


# ---- archives

def test_archive_predicates(spark, tmp_path):
    body = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\n</p>"
    pages = spark.createDataFrame([(3, "http://a/\r\nX: y", body), (1, None, body), (None, "http://n/", body), (2, "http://b/", None), (2, "http://b/", None),
                                   (4, "http://c/", "short")], "page_id long, url string, html string").selectExpr("*", "1 AS payload")
    folder = f"file://{tmp_path}/warc"
    warc.write(pages.coalesce(1), folder)
    rows = warc.read(spark, folder)
    digests = sorted(((r["page_id"] is None, r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.page_digests(rows).collect()), key=str)
    n = len(body)
    assert digests == sorted([(False, 3, "revisit", 1, n), (False, 1, "response", None, n), (True, 0, "revisit", 1, n), (False, 2, "response", None, 0),
                              (False, 2, "response", None, 0), (False, 4, "response", None, 5)], key=str)
    revisits = rows.where("record_type = 'revisit'")
    assert revisits.count() == 2 and revisits.where("payload IS NOT NULL").count() == 0
    assert rows.where("target_uri IN ('http://c/', 'http://none/')").select("record_id").collect()[0][0] == warc.PAGE_URN + "4"
    assert rows.where("refers_to IS NOT NULL AND payload_length > 5").count() == 2
    assert warc.read(spark, folder, payload="false").where("payload IS NOT NULL").count() == 0
    part = next(p for p in (tmp_path / "warc").iterdir() if p.name.startswith("part-"))
    (tmp_path / "zipped").mkdir()
    with gzip.open(tmp_path / "zipped" / "a.warc.gz", "wb") as f:
        f.write(part.read_bytes())
    assert warc.read(spark, f"{tmp_path}/zipped").count() == 6
    warc.write(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read(spark, f"file://{tmp_path}/none").count() == 0


def test_reader_settles_predicates():
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull

    reader = warc.WarcReader({"path": "/nowhere"})
    left = [EqualTo(("record_type",), "response"), GreaterThan(("payload_length",), 5), IsNotNull(("refers_to",))]
    assert list(reader.pushFilters(left)) == [left[1]]
    assert reader.wanted == [("record_type", {"response"}), ("refers_to", set())]


# ---- toxicity

def toxic_table(n, seed):
    rng = random.Random(seed)
    plain = [a + b for a in ("ba", "lo", "mi", "tu", "re") for b in ("na", "sel", "tor", "dim", "kes")]
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(3, 90))
        if i % 4 == 0:
            for _ in range(1 + len(words) // 30):
                words[rng.randrange(len(words))] = "zork" + rng.choice(["ul", "an", "ex", "ib"])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_gradient():
    words = ["abc", "de", "fghi", "x"]
    weights = {k: v if k == "words" else v.astype(np.float64) for k, v in toxicity.new_weights([words] * 3, np.array([1, 0, 1])).items()}
    windows, labels = np.array([[0, 1, 2, -1], [3, 3, -1, -1], [2, 0, 1, 3]]), np.array([1.0, 0, 1])
    _, grads = toxicity.loss_gradient(weights, windows, words, labels)
    rng = np.random.default_rng(0)
    for name in (k for k in weights if k != "words"):
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in weights[name].shape)
            if name == "char":
                at = (ord(rng.choice(list("abcdx"))), at[1])
            old, ends = weights[name][at], []
            for step in (1e-5, -1e-5):
                weights[name][at] = old + step
                ends.append(toxicity.loss_gradient(weights, windows, words, labels)[0])
            weights[name][at] = old
            if name != "word" or at[0]:  # row 0 stands for unknown words and stays zero
                assert abs((ends[0] - ends[1]) / 2e-5 - grads[name][at]) < 1e-7


def test_held_out_accuracy(spark):
    weights = toxicity.train(*toxic_table(300, 1))
    texts, labels = toxic_table(200, 2)
    frame = spark.createDataFrame([(i, t, y, "x") for i, (t, y) in enumerate(zip(texts, labels, strict=True))], "doc_id long, text string, y int, score string")
    rows = {r["doc_id"]: r for r in toxicity.score_texts(frame, weights).collect()}
    assert sum(rows[i]["predicted"] == y for i, y in enumerate(labels)) >= 190
    kept = {r["doc_id"] for r in toxicity.without_toxic(frame, weights).collect()}
    assert kept == {i for i, r in rows.items() if not r["predicted"]}
    assert toxicity.score_texts(odd_docs(spark), weights).where("score BETWEEN 0 AND 1").count() == 13
    assert toxicity.score_texts(no_docs(spark), weights).count() == 0


def test_sample_leaves_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts, y = toxicity.labelled_sample(docs, labels)
    held = {r[0] for r in docs.where(toxicity.remainder() == 0).select("text").collect()}
    others = {r[0] for r in docs.where(toxicity.remainder() != 0).select("text").collect()}
    assert len(texts) == len(y) and not (set(texts) & held) - others


def test_training_without_both_classes():
    assert toxicity.Scorer(toxicity.train(["a b", "c"], [0, 0])).scores([["a"], []]).max() < 0.5
    assert toxicity.Scorer(toxicity.train([], [])).scores([["a"]]).tolist()[0] < 0.5


def test_windows_cover_texts():
    for n in range(0, 200):
        starts = toxicity.window_places(n)
        assert {p for s in starts.tolist() for p in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))


def slow_toxicity(w: dict, text: str | None) -> float:
    """The score of a text, one state at a time."""
    words = (text or "").lower().split()
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(inputs, hidden):
        s, out = hidden.shape[0], []
        h = np.zeros(s)
        for x in inputs:
            g = h @ hidden
            z, r = sigmoid(x[:s] + g[:s]), sigmoid(x[s:2 * s] + g[s:2 * s])
            n = np.tanh(x[2 * s:] + r * g[2 * s:])
            h = (1 - z) * n + z * h
            out.append(h)
        return out

    def read(word):
        core = word.strip(toxicity.EDGES) or word
        chars = [w["char"][ord(c) % toxicity.CHARS] for c in core]
        ends = [states([c @ w[f"{k}_x"] + w[f"{k}_b"] for c in way], w[f"{k}_h"])[-1] for k, way in (("cf", chars), ("cb", chars[::-1]))]
        return np.concatenate([w["word"][w["words"].get(core, 0)], *ends])

    best = None
    starts = [0] if len(words) <= toxicity.WINDOW else [*range(0, len(words) - toxicity.WINDOW, toxicity.STRIDE), len(words) - toxicity.WINDOW]
    for start in starts if words else []:
        inputs = [read(x) for x in words[start:start + toxicity.WINDOW]]
        ahead = states([x @ w["wf_x"] + w["wf_b"] for x in inputs], w["wf_h"])
        back = states([x @ w["wb_x"] + w["wb_b"] for x in inputs[::-1]], w["wb_h"])[::-1]
        both = [np.concatenate(x) for x in zip(ahead, back, strict=True)]
        weight = np.exp([np.tanh(x @ w["att_w"] + w["att_b"]) @ w["att_v"] for x in both])
        logit = sum(a * x for a, x in zip(weight / weight.sum(), both, strict=True)) @ w["out_w"] + w["out_b"][0]
        best = logit if best is None else max(best, logit)
    return 0.0 if best is None else float(sigmoid(best))


def test_toxicity_scores_equal_a_slow_scorer(spark):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("ba", "ko", "é", "漢字", "(mi", "\"su\"", "--") for b in ("", "r", "ndo.", "X!")]
    texts = [" ".join(rng.choices(vocabulary, k=n)) for n in (1, 2, 31, 32, 33, 56, 57, 80, 200)] + ["", None, " \n\t", "\x85 word", "a" * 300]
    weights = toxicity.new_weights([t.split() for t in texts if t], np.arange(12) % 2)
    weights["out_w"] = weights["out_w"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs, weights).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(slow_toxicity(weights, text), abs=1e-4), text
    assert len({round(x, 3) for x in got.values()}) > 8


def test_features_read_whole_words():
    """What stands far inside a word without blanks counts as at its beginning."""
    rng = random.Random(8)
    for n in (10, 70, 500, 5000):
        word = "".join(rng.choice("ab") for _ in range(n)) + "9aB" * 3 + "=x"
        core = word.strip(pii.EDGES)
        turns = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:]))
        got = pii.features(word)
        assert f"turns={min(turns, 4)}" in got and any(f.startswith("mixed=True") for f in got)
        kinds = re.sub(r"([aA9=])\1+", r"\1", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", word))))
        assert f"shape={kinds[:6]}" in got

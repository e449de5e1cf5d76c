"""Personal data: fixed patterns, and secrets found by a linear-chain conditional random field over word shapes.

The field is trained from a small labelled table and decoded by Viterbi in numpy batches. A word whose score for "no secret" is so
far ahead that no transition can change it is settled at once; it cuts the chain, and only the runs between such words are decoded,
which gives the same labels as decoding whole texts.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import slices, workers_import

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
SLICE_CHARS = 2_000_000
MEMO_WORDS = 400_000

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits begins
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """At each @, the run of local characters before it, not before the last match's end, and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and non-overlapping for each kind; by kind, then start."""
    spans = [("email", *s) for s in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [("ip", *m.span()) for m in _IP.finditer(text)
              if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


# ---- the field

LABELS = ("O", "B", "I")
OFFSETS = (-2, -1, 0, 1)
EDGES = "\"'`.,;:!?#$%&*|()[]{}<>"
#: Words that announce a secret.
CUES = frozenset("token key secret password passwd pwd passphrase api_key apikey access_key bearer auth credential credentials".split())
SIGNS = frozenset(("=", ":", ":=", "=>", "->"))


def shape(word: str) -> str:
    """Upper case A, lower case a, digits 9, and runs written once; the first six signs."""
    out: list[str] = []
    for c in word:
        s = "9" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c if c.isascii() else "?"
        if not out or out[-1] != s:
            if len(out) == 6:
                break
            out.append(s)
    return "".join(out)


def features(word: str) -> list[str]:
    core = word.strip(EDGES)
    low = core.lower()
    letters, digits = any(map(str.isalpha, core)), any(map(str.isdigit, core))
    turns = len([*islice((1 for a, b in pairwise(core) if a.isdigit() != b.isdigit()), 4)])
    size = next(i for i, n in enumerate((2, 4, 8, 16, 24, 1 << 30)) if len(core) < n)
    out = ["bias", f"shape={shape(word)}", f"size={size}", f"turns={turns}", f"mixed={letters and digits}{size}"]
    if low in CUES or low.rstrip("=:") in CUES:
        out.append("cue")
    if word in SIGNS:
        out.append("sign")
    if core != word:
        out.append("edged")
    if digits and letters and len(core) >= 16 and all(c in "0123456789abcdef" for c in low):
        out.append("hex")
    return out


def labelled_rows() -> pd.DataFrame:
    """The small labelled table ``(words, labels)``: sentences with made-up secrets, and look-alikes that are none."""
    def digest(i: int) -> str:
        return hashlib.sha256(f"row {i}".encode()).hexdigest()

    def made(i: int) -> str:
        h = digest(i)
        mixed = "".join(c.upper() if k % 3 else c for k, c in enumerate(h))
        return (h[:40], h[:32], f"sk_live_{mixed[:24]}", f"AKIA{h.upper()[:16]}", f"ghp_{mixed[:36]}", h[:64], f"{mixed[:20]}+{mixed[20:40]}")[i % 7]

    plain = "the of an ing ention der die und que les una para with report theand ereonti schung mentre adoie value line house".split()
    with_secret = ("{w} {w} token = \"{s}\" {w} {w}", "api_key: {s} {w}", "{w} password = {s}", "{w} {w} secret: \"{s}\", {w}",
                   "{w} bearer {s} {w} {w}", "token = \"{s}\"### {w}", "{w}, {w} token = \"{s}\"!! {w}", "{w} key = '{s}' {w}")
    without = ("{w} {w} {n} {w}", "{w} token of {w} {w}", "{w}. The key {w} to {w}", "{w} 4{n}{n} {w}", "{w} +1 (702) 555-0742 {w}",
               "{w} 203.0.113.{n} {w}", "{w} ann.{n}@mail9.example.com {w}", "{w} = {w} {n}", "Licensed under CC BY-NC 4.0. {w}",
               "{w} | {w} | {w} |", "{w}### {w}$$$ {w}%%% {w}***", "{W}!! {W}!! {w}", "{w}: {w} {w}", "{w} 2024-01-{n} v1.{n}.3 {w}",
               "{w}{w}{w}{w} {w}, {w}{w}{w}", "{w} password {w} {w}.", "\"{w} {w}\" {w} ('{w}') {w}", "{w} 4242424242424242 {w} 12345678901234567890")
    rows = []
    for i in range(180):
        forms = with_secret if i % 3 == 0 else without
        form, k = forms[i // 3 % len(forms)] if i % 3 == 0 else forms[i % len(forms)], 0
        while "{w}" in form or "{W}" in form:
            word = plain[int(digest(i)[k:k + 4], 16) % len(plain)]
            form = form.replace("{W}", word.upper(), 1) if "{W}" in form else form.replace("{w}", word, 1)
            k = (k + 3) % 56
        form = form.replace("{n}", str(10 + int(digest(i)[:4], 16) % 89))
        secret = made(i // 3)
        text = form.replace("{s}", secret).split()
        rows.append((text, ["B" if "{s}" in form and secret in w else "O" for w in text]))
    return pd.DataFrame(rows, columns=["words", "labels"])


class Field:
    """Weights by feature and label, and by pair of labels."""

    def __init__(self, weights: dict[str, np.ndarray], pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def scores(self, word: str) -> np.ndarray:
        """What a word adds to the scores of the words two and one after it, its own, and the one before it."""
        out = np.zeros((len(OFFSETS), len(LABELS)))
        for f in features(word):
            for k, d in enumerate(OFFSETS):
                w = self.weights.get(f"{d}:{f}")
                if w is not None:
                    out[k] += w
        return out


def train(table: pd.DataFrame, rounds: int = 150, rate: float = 0.3, decay: float = 2e-3) -> Field:
    """Gradient ascent on the log-likelihood of the labelled rows, by forward-backward over padded batches."""
    longest = max(len(w) for w in table["words"])
    n, k = len(table), len(LABELS)
    names: dict[str, int] = {}
    at: list[tuple[int, int]] = []
    gold = np.zeros((n, longest), int)
    real = np.zeros((n, longest), bool)
    for i, (words, labels) in enumerate(zip(table["words"], table["labels"], strict=True)):
        real[i, :len(words)] = True
        gold[i, :len(words)] = [LABELS.index(x) for x in labels]
        for t, word in enumerate(words):
            for f in features(word):
                for d in OFFSETS:  # the feature counts for the word d places on
                    if 0 <= t - d < len(words):
                        at.append((i * longest + t - d, names.setdefault(f"{d}:{f}", len(names))))
    x = np.zeros((n * longest, len(names)))
    x[tuple(zip(*at, strict=True))] = 1
    w, pairs = np.zeros((len(names), k)), np.zeros((k, k))
    speed_w, speed_p = np.zeros_like(w), np.zeros_like(pairs)
    hot = np.eye(k)[gold] * real[..., None]
    both = real[:, 1:] & real[:, :-1]
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    for _ in range(rounds):
        score = (x @ w).reshape(n, longest, k)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.where(real[:, t, None], score[:, t] + _lse(ahead[:, t - 1, :, None] + pairs, 1), ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            back[:, t] = np.where(real[:, t + 1, None], _lse(pairs + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2), 0)
        whole = _lse(ahead[:, -1], 1)
        node = np.exp(ahead + back - whole[:, None, None]) * real[..., None]
        edge = np.exp(ahead[:, :-1, :, None] + pairs + (score + back)[:, 1:, None, :] - whole[:, None, None, None]) * both[..., None, None]
        grad_w = x.T @ (hot - node).reshape(-1, k) / n - decay * w
        grad_p = (gold_pairs - edge.sum((0, 1))) / n - decay * pairs
        for value, grad, speed in ((w, grad_w, speed_w), (pairs, grad_p, speed_p)):
            speed[:] = 0.9 * speed + grad
            value += rate * speed
    return Field({f: w[i] for f, i in names.items()}, pairs)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Labels of the words of many texts at once."""

    def __init__(self, field: Field):
        self.field = field
        swing = field.pairs.max() - field.pairs.min()
        self.margin = 2 * swing + 1e-6
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.kinds: dict[tuple | bytes, int] = {}

    def _id(self, word: str) -> int:
        """Words with equal scores share a row; words of letters only are told apart by case, edges, length and cue."""
        core = word.strip(EDGES)
        like = core.isalpha() and len(word) < 64 and (core.lower() if core.lower() in CUES else "a" * len(core))
        if like:
            case = 0 if core.islower() else 1 if core.isupper() else 2 if core[0].isupper() and core[1:].islower() else None
            left = len(word) - len(word.lstrip(EDGES))
            brief = None if case is None else (case, like, word[:left], word[left + len(core):])
            row = self.kinds.get(brief) if brief else None
            if row is None:
                row = self._row(word)
                if brief:
                    self.kinds[brief] = row
        else:
            row = self._row(word)
        self.index[word] = row
        return row

    def _row(self, word: str) -> int:
        scores = self.field.scores(word).astype(np.float32)
        key = scores.tobytes()
        if key not in self.kinds:
            self.kinds[key] = len(self.rows)
            self.rows.append(scores)
        return self.kinds[key]

    def secrets(self, texts: list[list[str]]) -> list[tuple[int, int]]:
        """``(text, word)`` of every word labelled as a secret or part of one."""
        if len(self.index) > MEMO_WORDS:
            self._clear()
        get = self.index.get
        ids, lengths = [], []
        for words in texts:
            ids += [self._id(w) if (i := get(w)) is None else i for w in words]
            lengths.append(len(words))
        if not ids:
            return []
        ids = np.array(ids)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        owner = np.repeat(np.arange(len(texts)), lengths)
        place = np.arange(len(ids)) - starts[owner]
        size = np.array(lengths)[owner]
        table = np.array(self.rows)
        score = np.zeros((len(ids), len(LABELS)), np.float32)
        for k, d in enumerate(OFFSETS):  # a word d places away adds its part
            own = (place + d >= 0) & (place + d < size)
            at = np.flatnonzero(own)
            score[at] += table[ids[at + d], k]
        open_ = score[:, 0] - score[:, 1:].max(1) <= self.margin
        return [(int(owner[i]), int(place[i])) for i in self._decode(score, np.flatnonzero(open_), owner)]

    def _decode(self, score: np.ndarray, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Viterbi over runs of open words; the words beside a run, if any, are settled as O."""
        if not len(at):
            return at
        cut = np.flatnonzero((np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])) + 1
        first = at[np.concatenate([[0], cut])]
        length = np.diff(np.concatenate([[0], cut, [len(at)]]))
        found, pairs = [], self.field.pairs
        order = np.argsort(length, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(np.ceil(np.log2(length[order])))) + 1):
            begin, n = first[group], length[group]
            b, longest = len(group), int(n.max())
            known_left = (begin > 0) & (owner[np.maximum(begin - 1, 0)] == owner[begin])
            stop = begin + n
            known_right = (stop < len(score)) & (owner[np.minimum(stop, len(score) - 1)] == owner[begin])
            best = score[begin] + np.where(known_left[:, None], pairs[0], 0)
            came = np.zeros((longest, b, len(LABELS)), np.int8)
            for t in range(1, longest):
                step = best[:, :, None] + pairs
                live = t < n
                came[t] = np.where(live[:, None], step.argmax(1), np.arange(len(LABELS)))
                best = np.where(live[:, None], step.max(1) + score[np.minimum(begin + t, len(score) - 1)], best)
            label = (best + np.where(known_right[:, None], pairs[:, 0], 0)).argmax(1)
            for t in range(longest - 1, -1, -1):
                hit = (t < n) & (label > 0)
                found.append(begin[hit] + t)
                label = came[t][np.arange(b), label]
        return np.sort(np.concatenate(found))


_WORD = re.compile(r"\S+")


def secret_spans(text: str, places: list[int]) -> list[tuple[str, int, int]]:
    """Spans of words by their places, without the punctuation around them."""
    wanted, spans = set(places), []
    for i, m in enumerate(_WORD.finditer(text)):
        if i in wanted:
            word = m[0]
            left = len(word) - len(word.lstrip(EDGES))
            core = word.strip(EDGES)
            if core:
                spans.append((SECRET, m.start() + left, m.start() + left + len(core)))
    return spans


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Replace each span by its kind in brackets; of overlapping spans one mark stays, that of the first."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def find_personal(docs: DataFrame, id_column: str = "doc_id", text: str = "text", labelled: pd.DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret)`` of every row's whole text.

    ``spans`` lists ``kind:start:end`` in code points, base kinds first; a secret that overlaps a base span is dropped. A null text
    has no spans. Equal rows get equal results; extra columns are dropped.
    """
    workers_import(docs.sparkSession)
    field = train(labelled_rows() if labelled is None else labelled)
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_t"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"doc_id {dict(rows.dtypes)['_id']}, {counts}, base_sha256 string, spans string, n_secret long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(field)
        for frame in frames:
            out = []
            for _, base, extra in _spans_of(tagger, frame["_t"].tolist()):
                n = [sum(s[0] == k for s in base) for k in KINDS] if base else [0] * len(KINDS)
                out.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + extra), len(extra)))
            made = pd.DataFrame(out, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_secret"])
            made.insert(0, "doc_id", frame["_id"])
            yield made

    return rows.mapInPandas(run, schema)


def _spans_of(tagger: Tagger, texts: list[str | None]) -> Iterator[tuple[str | None, list, list]]:
    """Each text with its base spans and its secrets that overlap none of them."""
    for a, b in slices([len(t or "") for t in texts], SLICE_CHARS):
        part = [t or "" for t in texts[a:b]]
        tagged: dict[int, list[int]] = {}
        for i, place in tagger.secrets([t.split() for t in part]):
            tagged.setdefault(i, []).append(place)
        for i, t in enumerate(part):
            base = base_spans(t)
            extra = [s for s in secret_spans(t, tagged[i]) if all(s[2] <= x or y <= s[1] for _, x, y in base)] if i in tagged else []
            yield texts[a + i], base, extra


def redact_texts(docs: DataFrame, text: str = "text", labelled: pd.DataFrame | None = None) -> DataFrame:
    """All rows and columns, with every span in ``text`` replaced by its kind in brackets; a null text stays null."""
    workers_import(docs.sparkSession)
    field = train(labelled_rows() if labelled is None else labelled)
    place = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        tagger = Tagger(field)
        for batch in batches:
            clean = [t if t is None or not (base or extra) else redact(t, base + extra)
                     for t, base, extra in _spans_of(tagger, batch.column(place).to_pylist())]
            yield batch.set_column(place, batch.schema.field(place), pa.array(clean, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)

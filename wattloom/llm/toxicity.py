"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is its embedding beside the last states of two gated networks that read its characters from either end. Words seen in
several labelled texts have embeddings, whose first column starts at the log-odds of the word in toxic texts; other words have none,
and in training some words lose theirs, so that characters must tell. The network reads windows of words both ways, attention pools the states of a window, and a text's score is that of its worst window; windows
overlap by a quarter and cover the whole text. Training takes for each labelled text the window that scores highest so far.
"""

import os
import pickle
import subprocess
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import filter_rows, slices, workers_import

WINDOW, STRIDE = 32, 24
HELD_OUT_OF = 5
#: The bounded sample of labelled rows: so many of each class, of at most so many characters.
ROWS_PER_CLASS, TRAIN_CHARS = 1500, 20_000
SLICE_CHARS = 1_000_000
MEMO_WORDS = 200_000
BATCH = 512
EDGES = "\"'`.,;:!?#$%&*|()[]{}<>-_"

WORD_DIM, CHARS, CHAR_DIM, CHAR_STATE, STATE, ATTENTION = 8, 512, 8, 8, 12, 8
INPUT = WORD_DIM + 2 * CHAR_STATE
#: Labelled texts in which a word must occur to get an embedding, and the part of embeddings left out in a training step.
LEAST_TEXTS, DROPPED = 3, 0.2


def split_words(text: str) -> list[str]:
    return text.lower().split()


def bare(word: str) -> str:
    return word.strip(EDGES) or word


def new_weights(texts: list[list[str]], labels: np.ndarray, seed: int = 7) -> dict:
    """Starting weights; under ``words`` the places of words in the embedding, 0 for all others."""
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float | None = None) -> np.ndarray:
        return rng.normal(0, scale or 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    counts = [Counter(x for t, y in zip(texts, labels, strict=True) if y == c for x in set(map(bare, t))) for c in (0, 1)]
    sizes = [int((labels == c).sum()) for c in (0, 1)]
    words = sorted(x for x, n in (counts[0] + counts[1]).items() if n >= LEAST_TEXTS)
    w = {"words": {x: i + 1 for i, x in enumerate(words)}, "word": normal(len(words) + 1, WORD_DIM, scale=0.05),
         "char": normal(CHARS, CHAR_DIM, scale=0.5)}
    w["word"][0] = 0
    for x, i in w["words"].items():
        odds = (counts[1][x] + 1) / (sizes[1] + 2) / ((counts[0][x] + 1) / (sizes[0] + 2))
        w["word"][i, 0] = np.clip(np.log(odds), -1, 4) / 2
    for name, size, state in (("cf", CHAR_DIM, CHAR_STATE), ("cb", CHAR_DIM, CHAR_STATE), ("wf", INPUT, STATE), ("wb", INPUT, STATE)):
        w |= {f"{name}_x": normal(size, 3 * state), f"{name}_h": normal(state, 3 * state), f"{name}_b": np.zeros(3 * state, np.float32)}
    return w | {"att_w": normal(2 * STATE, ATTENTION), "att_b": np.zeros(ATTENTION, np.float32), "att_v": normal(ATTENTION),
                "out_w": normal(2 * STATE), "out_b": np.full(1, -1.0, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gru(inputs: np.ndarray, live: np.ndarray, hidden: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States ``(steps, rows, state)`` for projected inputs; a row keeps its state where it isn't live."""
    steps, rows, width = inputs.shape
    s = width // 3
    h = np.zeros((rows, s), inputs.dtype)
    states, kept = np.empty((steps, rows, s), inputs.dtype), []
    for t in range(steps):
        on = live[t]
        full = on.all()
        before, x = (h, inputs[t]) if full else (h[on], inputs[t][on])
        g = before @ hidden
        zr = _sigmoid(x[:, :2 * s] + g[:, :2 * s])
        z, r = zr[:, :s], zr[:, s:]
        n = np.tanh(x[:, 2 * s:] + r * g[:, 2 * s:])
        if keep:
            kept.append((before, z, r, n, g[:, 2 * s:]))
        after = n + z * (before - n)
        if full:
            h = after
        else:
            h = h.copy()
            h[on] = after
        states[t] = h
    return states, kept


def gru_gradient(d_states: np.ndarray, live: np.ndarray, hidden: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of the hidden weights."""
    steps, rows, s = d_states.shape
    d_in, d_hidden = np.zeros((steps, rows, 3 * s), d_states.dtype), np.zeros_like(hidden)
    dh = np.zeros((rows, s), d_states.dtype)
    for t in range(steps - 1, -1, -1):
        h, z, r, n, gn = kept[t]
        on = live[t]
        dh = dh + d_states[t]
        d = dh[on]
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * gn * r * (1 - r)
        d_in[t, on] = np.concatenate([dz, dr, dn], 1)
        dg = np.concatenate([dz, dr, dn * r], 1)
        d_hidden += h.T @ dg
        dh[on] = d * z + dg @ hidden.T
    return d_in, d_hidden


def char_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character ids ``(steps, words)`` and where they are real."""
    lengths = np.array([len(w) for w in words])
    ids = np.zeros((len(words), max(1, int(lengths.max(initial=0)))), np.int32)
    live = np.arange(ids.shape[1]) < lengths[:, None]
    ids[live] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32) % CHARS
    return ids.T, live.T


def word_inputs(w: dict, words: list[str], keep: bool = False, rng: np.random.Generator | None = None) -> tuple[np.ndarray, tuple]:
    chars, live = char_matrix(words)
    embedded = w["char"][chars]
    runs, last = [], []
    for name, way in (("cf", 1), ("cb", -1)):
        projected = embedded[::way] @ w[f"{name}_x"] + w[f"{name}_b"]
        states, kept = gru(projected, live[::way], w[f"{name}_h"], keep)
        runs.append(kept)
        last.append(states[-1])
    rows = np.array([w["words"].get(x, 0) for x in words], np.int64)
    if rng is not None:
        rows[rng.random(len(rows)) < DROPPED] = 0
    return np.concatenate([w["word"][rows], *last], 1), (chars, live, embedded, runs, rows)


def project(w: dict, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return inputs @ w["wf_x"] + w["wf_b"], inputs @ w["wb_x"] + w["wb_b"]


def pooled(w: dict, ahead: np.ndarray, back: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Log-odds of windows, from states ``(steps, rows, state)`` of both ways."""
    both = np.concatenate([ahead, back], 2)
    u = np.tanh(both @ w["att_w"] + w["att_b"])
    e = np.where(live, u @ w["att_v"], -1e9)
    a = np.exp(e - e.max(0))
    a = a * live
    a /= np.maximum(a.sum(0), 1e-9)
    summed = np.einsum("tb,tbs->bs", a, both)
    return summed @ w["out_w"] + w["out_b"], (both, u, a, summed)


def loss_gradient(w: dict, windows: np.ndarray, words: list[str], labels: np.ndarray,
                  rng: np.random.Generator | None = None) -> tuple[float, dict]:
    """Mean log loss of windows of word places (-1: none) and its gradient."""
    live = (windows >= 0).T
    used, at = np.unique(np.maximum(windows, 0), return_inverse=True)
    at = at.reshape(windows.shape).T
    inputs, (chars, char_live, embedded, runs, rows) = word_inputs(w, [words[i] for i in used], True, rng)
    x = inputs[at]
    (pf, pb), grads = project(w, x), {}
    ahead, kept_f = gru(pf, live, w["wf_h"], True)
    back, kept_b = gru(pb[::-1], live[::-1], w["wb_h"], True)
    logit, (both, u, a, summed) = pooled(w, ahead, back[::-1], live)
    p = _sigmoid(logit)
    d = (p - labels).astype(logit.dtype) / len(labels)
    grads["out_w"], grads["out_b"] = summed.T @ d, d.sum(keepdims=True)
    d_sum = d[:, None] * w["out_w"]
    d_both = a[:, :, None] * d_sum
    da = np.einsum("tbs,bs->tb", both, d_sum)
    de = a * (da - (a * da).sum(0))
    grads["att_v"] = np.einsum("tba,tb->a", u, de)
    du = de[:, :, None] * w["att_v"] * (1 - u * u)
    grads["att_w"], grads["att_b"] = np.einsum("tbs,tba->sa", both, du), du.sum((0, 1))
    d_both = d_both + du @ w["att_w"].T
    d_f, grads["wf_h"] = gru_gradient(d_both[..., :STATE], live, w["wf_h"], kept_f)
    d_b, grads["wb_h"] = gru_gradient(d_both[::-1, :, STATE:], live[::-1], w["wb_h"], kept_b)
    d_b = d_b[::-1]
    for name, g in (("wf", d_f), ("wb", d_b)):
        grads[f"{name}_x"], grads[f"{name}_b"] = np.einsum("tbi,tbj->ij", x, g), g.sum((0, 1))
    dx = d_f @ w["wf_x"].T + d_b @ w["wb_x"].T
    d_inputs = np.zeros_like(inputs)
    np.add.at(d_inputs, at[live], dx[live])
    grads["word"] = np.zeros_like(w["word"])
    np.add.at(grads["word"], rows, d_inputs[:, :WORD_DIM])
    grads["word"][0] = 0
    d_char = np.zeros_like(embedded)
    for k, (name, way) in enumerate((("cf", 1), ("cb", -1))):
        d_states = np.zeros((*chars.shape, CHAR_STATE), inputs.dtype)
        d_states[-1] = d_inputs[:, WORD_DIM + k * CHAR_STATE:WORD_DIM + (k + 1) * CHAR_STATE]
        g, grads[f"{name}_h"] = gru_gradient(d_states, char_live[::way], w[f"{name}_h"], runs[k])
        grads[f"{name}_x"], grads[f"{name}_b"] = np.einsum("tbi,tbj->ij", embedded[::way], g), g.sum((0, 1))
        d_char += (g @ w[f"{name}_x"].T)[::way]
    grads["char"] = np.zeros_like(w["char"])
    np.add.at(grads["char"], chars[char_live], d_char[char_live])
    q = np.clip(np.where(labels > 0, p, 1 - p), 1e-7, 1)
    return float(-np.log(q).mean()), grads


def window_places(n: int) -> np.ndarray:
    """Starts of the windows of a text of ``n`` words: each STRIDE words on, the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(1 if n else 0, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


class Scorer:
    """Scores texts; inputs of words met before are kept."""

    def __init__(self, weights: dict):
        self.w = weights
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ahead = np.zeros((1 << 12, 3 * STATE), np.float32)
        self.back = np.zeros_like(self.ahead)

    def ids(self, words: list[str]) -> np.ndarray:
        get = self.index.get
        out = [get(x, -1) for x in words]
        new: dict[str, int] = {}
        for i, k in enumerate(out):
            if k < 0:
                out[i] = new.setdefault(words[i], len(self.index) + len(new))
        self._add(new)
        return np.array(out, np.int64)

    def _add(self, new: dict[str, int]) -> None:
        if not new:
            return
        names = list(new)
        known: dict[str, int] = {}
        stripped = [bare(x) for x in names]
        for x in stripped:
            known.setdefault(x, len(known))
        cores = sorted(known, key=len)
        rows = np.empty((len(cores), 6 * STATE), np.float32)
        for a, b in slices([len(x) for x in cores], 1 << 16):
            part = word_inputs(self.w, cores[a:b])[0]
            rows[a:b] = np.concatenate(project(self.w, part), 1)
        place = {x: i for i, x in enumerate(cores)}
        got = rows[[place[x] for x in stripped]]
        have, need = len(self.index), len(self.index) + len(new)
        while len(self.ahead) < need:
            self.ahead, self.back = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ahead, self.back))
        self.ahead[have:need], self.back[have:need] = got[:, :3 * STATE], got[:, 3 * STATE:]
        self.index |= new

    def windows(self, ids: np.ndarray, at: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Log-odds of windows ``at`` (rows, steps) into ``ids``."""
        out = np.empty(len(at), np.float32)
        order = np.argsort(live.sum(1), kind="stable")  # whole windows together, as they need no masks
        for a in range(0, len(at), BATCH):
            rows = order[a:a + BATCH]
            w_ids, m = ids[at[rows]].T, live[rows].T
            ahead = gru(self.ahead[w_ids], m, self.w["wf_h"])[0]
            back = gru(self.back[w_ids[::-1]], m[::-1], self.w["wb_h"])[0][::-1]
            out[rows] = pooled(self.w, ahead, back, m)[0]
        return out

    def texts(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-odds of all windows, and the text and the start of each."""
        if len(self.index) > MEMO_WORDS:
            self._clear()
        lengths = np.array([len(t) for t in texts], np.int64)
        ids = self.ids([x for t in texts for x in t])
        offsets = np.cumsum(lengths) - lengths
        starts = [window_places(n) for n in lengths]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        begin = np.concatenate([*starts, np.zeros(0, np.int64)])
        step = begin[:, None] + np.arange(WINDOW)
        live = step < lengths[owner][:, None]
        at = np.minimum(step + offsets[owner][:, None], max(len(ids) - 1, 0))
        return self.windows(ids, at, live), owner, begin

    def scores(self, texts: list[list[str]], empty: float = 0.0) -> np.ndarray:
        """The highest window probability of each text; ``empty`` for a text without words."""
        logit, owner, _ = self.texts(texts)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, owner, logit)
        return np.where(np.isinf(out), empty, _sigmoid(out.astype(np.float64)))


def calibrated(w: dict, texts: list[list[str]], y: np.ndarray) -> dict:
    """Scale and shift the output so that a text's highest window gives the odds seen in texts that training left out.

    Logistic regression on one figure, by Newton steps, with targets a little inside 0 and 1.
    """
    if len(set(y.tolist())) < 2:
        return w
    scorer, top = Scorer(w), np.full(len(texts), -np.inf)
    for a, b in slices([len(t) for t in texts], 200_000):
        logit, owner, _ = scorer.texts(texts[a:b])
        np.maximum.at(top, owner + a, logit)
    ones, zeros = y.sum(), (1 - y).sum()
    want = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x, fit_ = np.stack([top, np.ones_like(top)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ fit_)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        fit_ = fit_ + np.clip(np.linalg.solve(curve, x.T @ (want - p)), -1, 1)
    if fit_[0] <= 0:
        return w
    return w | {"out_w": (w["out_w"] * fit_[0]).astype(np.float32), "out_b": (w["out_b"] * fit_[0] + fit_[1]).astype(np.float32)}


def train(texts: list[str], labels: list[int], rounds: int = 6, rate: float = 1e-2, seed: int = 7) -> dict:
    """Weights from labelled texts by Adam; every fifth text is left to calibrate the output. Without both classes the bias says no."""
    order = np.random.default_rng(seed).permutation(len(texts))
    texts, labels = [texts[i] for i in order], [labels[i] for i in order]
    left = [i for i in range(len(texts)) if i % 5 == 0 and len(texts) >= 50 and texts[i].strip()]
    used = sorted(set(range(len(texts))) - set(left))
    w = _descend([texts[i] for i in used], [labels[i] for i in used], rounds, rate, seed)
    return calibrated(w, [split_words(texts[i]) for i in left], np.array([labels[i] for i in left], float))


def _descend(texts: list[str], labels: list[int], rounds: int, rate: float, seed: int) -> dict:
    y = np.array(labels, np.float32)
    split = [split_words(t) for t in texts]
    keep = [i for i, t in enumerate(split) if t]
    split, y = [split[i] for i in keep], y[keep]
    w = new_weights(split, y, seed)
    if len(set(y.tolist())) < 2:
        return {k: v if k == "words" else np.zeros_like(v) for k, v in w.items()} | {"out_b": np.full(1, -3.0, np.float32)}
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    places = [[vocabulary.setdefault(bare(x), len(vocabulary)) for x in t] for t in split]
    words = list(vocabulary)
    first, second = ({k: np.zeros_like(v) for k, v in w.items() if k != "words"} for _ in range(2))
    tick = 0
    starts = [window_places(len(t)) for t in split]
    # few texts: more passes, so that about as many steps are made
    rounds = max(rounds, min(40, rounds * 1200 // len(split)))
    for number in range(rounds):
        if number == 0:
            chosen = [(i, int(rng.choice(starts[i]))) for i in range(len(split))]
        else:
            scorer, best = Scorer(w), {}
            for a, b in slices([len(t) for t in split], 200_000):
                logit, owner, begin = scorer.texts(split[a:b])
                for s, o, p in zip(logit.tolist(), owner.tolist(), begin.tolist(), strict=True):
                    if s > best.get(a + o, (-1e9, 0))[0]:
                        best[a + o] = (s, p)
            chosen = [(i, best[i][1]) for i in range(len(split))]
            chosen += [(i, int(rng.choice(starts[i]))) for i in range(len(split)) if y[i] == 0 and len(starts[i]) > 1]
        rng.shuffle(chosen)
        for a in range(0, len(chosen), 64):
            part = chosen[a:a + 64]
            windows = np.full((len(part), WINDOW), -1)
            for k, (i, p) in enumerate(part):
                row = places[i][p:p + WINDOW]
                windows[k, :len(row)] = row
            _, grads = loss_gradient(w, windows, words, y[[i for i, _ in part]], rng)
            tick += 1
            pace = rate * (1 - 0.8 * number / rounds)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] = (w[k] - pace * (first[k] / (1 - 0.9 ** tick)) / (np.sqrt(second[k] / (1 - 0.99 ** tick)) + 1e-8)).astype(np.float32)
    return w


def remainder(id_column: str = "doc_id"):
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % HELD_OUT_OF


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id", text: str = "text",
                    rows_per_class: int = ROWS_PER_CLASS, most_chars: int = TRAIN_CHARS) -> tuple[list[str], list[int]]:
    """Texts and labels of a bounded sample, by the order of a hash of the id; held-out ids are never in it."""
    usable = labels.where((remainder(id_column) != 0) & F.col(label).isin(0, 1)).select(F.col(id_column).alias("_id"), F.col(label).alias("_y"))
    ranked = usable.withColumn("_h", F.xxhash64("_id"))
    picked = ranked.where("_y = 0").orderBy("_h", "_id").limit(rows_per_class).unionByName(
        ranked.where("_y = 1").orderBy("_h", "_id").limit(rows_per_class))
    rows = docs.where(F.length(text) <= most_chars).select(F.col(id_column).alias("_id"), F.col(text).alias("_t")).join(
        F.broadcast(picked), "_id").orderBy("_h", "_id", "_t").limit(2 * rows_per_class).collect()
    return [r["_t"] for r in rows], [r["_y"] for r in rows]


def score_texts(docs: DataFrame, weights: dict, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row's whole text.

    Only the text decides a score. A null or empty text scores 0. Equal texts score alike; other columns are dropped.
    """
    workers_import(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("_t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(weights)
        for frame in frames:
            texts = frame["_t"].tolist()
            parts = [scorer.scores([split_words(t or "") for t in texts[a:b]]) for a, b in slices([len(t or "") for t in texts], SLICE_CHARS)]
            frame["score"] = np.concatenate(parts) if parts else np.zeros(0)
            yield frame.drop(columns="_t")

    return rows.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double").select(
        "doc_id", (remainder("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


_TRAIN = "import pickle, sys; from wattloom.llm.toxicity import train; sys.stdout.buffer.write(pickle.dumps(train(*pickle.load(sys.stdin.buffer))))"


def fit(docs: DataFrame, labels: DataFrame, **options) -> dict:
    """Weights from the bounded sample of labelled rows. Runs jobs while the plan is built.

    Training runs in a process of its own, which gives all of its memory back. The number of rounds and the part of the texts that is
    left for calibration follow the number of labelled rows; scores of other rows don't depend on their number.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = os.pathsep.join(x for x in (root, os.environ.get("PYTHONPATH", "")) if x)
    done = subprocess.run([sys.executable, "-c", _TRAIN], input=pickle.dumps(labelled_sample(docs, labels, **options)), capture_output=True,
                          env=os.environ | {"PYTHONPATH": paths}, check=False)
    if done.returncode:
        raise RuntimeError(f"training failed: {done.stderr.decode(errors='replace')[-2000:]}")
    return pickle.loads(done.stdout)


def without_toxic(docs: DataFrame, weights: dict, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with all their columns; null and empty texts stay."""
    workers_import(docs.sparkSession)

    def make():
        scorer = Scorer(weights)

        def clean(texts: list[str | None]) -> np.ndarray:
            parts = [scorer.scores([split_words(t or "") for t in texts[a:b]]) for a, b in slices([len(t or "") for t in texts], SLICE_CHARS)]
            return np.concatenate([np.zeros(0), *parts]) < threshold

        return clean

    return filter_rows(docs, text, make)

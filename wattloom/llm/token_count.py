"""Token counts by finite-state transducers.

Two deterministic transducers stand for a byte-level pair-merge tokenizer. The first reads character classes and marks where pieces
start. It runs over fixed-size chunks for every start state at once; each chunk then is a map of states, the maps are composed by a
parallel prefix scan, and a second run from the true start states gives the marks. The second reads the bytes of a piece. Its
transitions carry the change of the token count, and its states, made when first met, hold what later bytes can depend on: for each
place where a longer token may have begun, the trie node reached, the token that ends there, and the count up to there.
"""

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import slices, workers_import

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CHUNK = 128
SLICE_CHARS = 1_500_000
#: Pieces and states kept by a worker before it starts anew; the counts don't depend on it.
MEMO_PIECES, MEMO_STATES = 600_000, 400_000

# character classes; the last stands between texts
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, SINGLE, R_OR_V, L_LETTER, E_LETTER, END = range(11)
LETTERS = (LETTER, SINGLE, R_OR_V, L_LETTER, E_LETTER)
N_CLASSES = 11
# states: nothing open; in white space whose last character is a space, or another; in a run of letters, numbers, others; after a
# quote that began a piece; after it and r or v; after it and l; after a whole contraction
START, IN_SPACE, IN_BLANK, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AT_QUOTE, QUOTE_RV, QUOTE_L, CONTRACTED = range(10)
N_STATES = 10
HERE, BEFORE = 1, 2  # a piece starts at this character; at the one before
#: White space of the split pattern beside the space.
BLANKS = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _open(c: int) -> int:
    """The state after a character that starts a piece."""
    if c in LETTERS:
        return IN_LETTERS
    return {SPACE: IN_SPACE, BLANK: IN_BLANK, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: AT_QUOTE, END: START}[c]


def _step(state: int, c: int) -> tuple[int, int]:
    """The next state, and where pieces start, of the pattern that splits text before merges."""
    fresh = (_open(c), HERE)
    if state in (IN_SPACE, IN_BLANK):
        if c in (SPACE, BLANK):
            return (IN_SPACE if c == SPACE else IN_BLANK), 0
        if c == END:
            return START, HERE
        if state == IN_BLANK:
            return fresh[0], HERE | BEFORE
        return (IN_OTHERS if c == QUOTE else _open(c)), BEFORE  # the space belongs to the run that follows
    if state == IN_LETTERS and c in LETTERS or state == IN_NUMBERS and c == NUMBER or state == IN_OTHERS and c in (OTHER, QUOTE):
        return state, 0
    if state == AT_QUOTE:
        if c in (OTHER, QUOTE):
            return IN_OTHERS, 0
        pending = {SINGLE: CONTRACTED, R_OR_V: QUOTE_RV, L_LETTER: QUOTE_L}
        return (pending[c], 0) if c in pending else fresh
    if state == QUOTE_RV and c == E_LETTER or state == QUOTE_L and c == L_LETTER:
        return CONTRACTED, 0
    if state in (QUOTE_RV, QUOTE_L):  # no contraction: the letter before starts a piece
        follow, marks = _step(IN_LETTERS, c)
        return follow, marks | BEFORE
    return fresh


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next states and marks by state and class, and the class of every code point."""
    steps = [_step(s, c) for s in range(N_STATES) for c in range(N_CLASSES)]
    following, marks = (np.array(x, np.uint8) for x in zip(*steps, strict=True))
    kinds = {"L": LETTER, "N": NUMBER}
    classes = np.array([kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)], np.uint8)
    classes[BLANKS] = BLANK
    for c, chars in ((SPACE, " "), (QUOTE, "'"), (SINGLE, "stmd"), (R_OR_V, "rv"), (L_LETTER, "l"), (E_LETTER, "e")):
        classes[[ord(x) for x in chars]] = c
    return following, marks, classes


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Places where pieces start, in texts that are each followed by an END."""
    following, marks, _ = _tables()
    n = len(classes)
    columns = np.full(-(-n // CHUNK) * CHUNK, END, np.uint8)
    columns[:n] = classes
    columns = np.ascontiguousarray(columns.reshape(-1, CHUNK).T)
    chunks = columns.shape[1]
    maps = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], chunks, 1)
    for c in columns:
        maps = following[maps * np.uint8(N_CLASSES) + c]
    reach = 1
    while reach < chunks:  # after each round a map covers twice as many chunks
        maps = np.concatenate([maps[:, :reach], np.take_along_axis(maps[:, reach:], maps[:, :-reach], 0)], 1)
        reach *= 2
    state = np.concatenate([[START], maps[START, :-1]]).astype(np.uint8)
    found = np.empty_like(columns)
    for t, c in enumerate(columns):
        at = state * np.uint8(N_CLASSES) + c
        found[t], state = marks[at], following[at]
    found = found.T.ravel()[:n]
    starts = (found & HERE).astype(bool)
    starts[:-1] |= (found[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts)


class MergeTransducer:
    """Token counts of pieces for a list of merges in order of rank; built as pieces are read."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[bytes, bytes]]):
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for t in tokens:
            if self.merged(t) == [t]:
                self._insert(t)
        self.joins: dict[tuple[bytes, bytes], bool] = {}
        self._clear()

    def _insert(self, token: bytes) -> None:
        node = 0
        for b in token:
            if b not in self.children[node]:
                self.children[node][b] = len(self.children)
                self.children.append({})
                self.token.append(None)
            node = self.children[node][b]
        self.token[node] = token

    def merged(self, piece: bytes) -> list[bytes]:
        """The tokens of a piece by merging the pair of lowest rank, leftmost first, until none is left."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.ranks):
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _clear(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.arcs: dict[int, tuple[int, int]] = {}
        self.first = self._state(((0, None, 0),))

    def _state(self, key: tuple) -> int:
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
        return self.ids[key]

    def _fits(self, before: bytes | None, token: bytes) -> bool:
        """Whether the two stay two tokens when merged as one text."""
        if before is None:
            return True
        pair = (before, token)
        if pair not in self.joins:
            self.joins[pair] = self.merged(before + token) == [before, token]
        return self.joins[pair]

    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        """The next state and the change of the count. Exactly one token can end a prefix's own tokens."""
        alive, last, change = [], None, 0
        for node, before, count in self.states[state]:
            node = self.children[node].get(byte)
            if node is None:
                continue
            token = self.token[node]
            if last is None and token is not None and self._fits(before, token):
                last, change = token, count + 1
            alive.append((node, before, count))
        if last is None:
            raise ValueError(f"no token ends with byte {byte}")
        alive = [(n, b, c - change) for n, b, c in alive if self.children[n]]
        arc = (self._state((*alive, (0, last, 0))), change)
        self.arcs[state << 8 | byte] = arc
        return arc

    def count(self, piece: bytes) -> int:
        if len(self.states) > MEMO_STATES:
            self._clear()
        state, total, arcs = self.first, 0, self.arcs
        for b in piece:
            state, change = arcs.get(state << 8 | b) or self._arc(state, b)
            total += change
        return total


class _Pieces(dict):
    """Counts of pieces met before."""

    def __init__(self, transducer: MergeTransducer):
        self.transducer = transducer

    def __missing__(self, piece: str) -> int:
        n = self.transducer.count(piece.encode())
        if len(self) < MEMO_PIECES:
            self[piece] = n
        return n


def _byte_names() -> dict[str, int]:
    """Vocabulary files write a byte as a printable character: itself, or the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = _byte_names()

        def raw(token: str) -> bytes:
            return bytes(names[c] for c in token)

        self.special = [t["content"] for t in spec["added_tokens"]]
        merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        self.pieces = _Pieces(MergeTransducer([raw(t) for t in spec["model"]["vocab"] if t not in self.special], merges))

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; the strings of added tokens count as one token each."""
        out = np.zeros(len(texts), np.int64)
        if not texts:
            return out
        parts, owner = [], []
        for i, text in enumerate(texts):
            segments = [text]
            for s in self.special:
                segments = [y for x in segments for y in x.split(s)] if s in text else segments
            out[i] = len(segments) - 1
            parts += segments
            owner += [i] * len(segments)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        whole = "\n".join([*parts, ""])
        classes = _tables()[2][np.frombuffer(whole.encode("utf-32-le"), np.uint32)]
        classes[ends] = END
        starts = piece_starts(classes)
        stops = np.append(starts[1:], len(whole))
        real = classes[starts] != END
        at, to = starts[real].tolist(), stops[real].tolist()
        counts = np.fromiter(map(self.pieces.__getitem__, map(whole.__getitem__, map(slice, at, to))), np.int64, len(at))
        sums = np.concatenate([[0], np.cumsum(counts)])
        edges = np.searchsorted(starts[real], ends)
        np.add.at(out, owner, np.diff(sums[np.concatenate([[0], edges])]))
        return out


@cache
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, id_column: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row's whole text.

    A null or empty text has no tokens. Rows are counted one by one, so equal rows get equal counts; extra columns are ignored.
    ``tokenizer`` is the path of a byte-level vocabulary in JSON that every executor can read.
    """
    workers_import(docs.sparkSession)
    path = tokenizer or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(path)
        for frame in frames:
            texts = frame["_t"].tolist()
            counts = [counter.count(texts[a:b]) for a, b in slices([len(t) for t in texts], SLICE_CHARS)]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": [len(t.encode()) for t in texts],
                                "n_tokens": np.concatenate(counts) if counts else np.zeros(0, np.int64)})

    counted = rows.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, n_tokens long")
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))

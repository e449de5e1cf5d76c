"""Pair-merge encoding and decoding by merge rounds in numpy.

Texts are cut at ASCII blanks; normalization and the split pattern never look across one. Parts that are new to a worker are normalized,
split into words, and the symbols of all their words lie in one flat array. In a round every neighbouring pair is looked up by binary
search in the sorted keys of the merges, each word's lowest rank is found, and all its pairs of that rank are merged at once, in a run of
equal symbols from the left. Words without a pair left drop out. A merge's product only occurs in merges of higher rank, so a round never
passes over a pair that should have come first.
"""

import hashlib
import heapq
import json
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import workers_import

VOCABULARY = "word_bpe_49k.json"
#: Parts and words that a worker keeps before it starts anew, and the bytes of one; results don't depend on them.
MEMO_PARTS, MEMO_BYTES = 400_000, 60
#: Symbols of a word from which on a heap takes its merges one by one, as rounds over it could be as many as there are merges.
LONG_WORD = 4096
NONE = np.iinfo(np.int64).max
ALL_CODE_POINTS = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)


def _byte_names() -> list[str]:
    """Vocabulary files write a byte as a printable character: itself, or the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _ranges(codes: np.ndarray) -> str:
    """Sorted code points as ranges of a pattern's class."""
    edges = np.flatnonzero(np.diff(codes) != 1)
    starts, ends = codes[np.concatenate([[0], edges + 1])], codes[np.concatenate([edges, [len(codes) - 1]])]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts.tolist(), ends.tolist(), strict=True))


class Bpe:
    """A vocabulary file with merges, word ends, a normalizer and a split pattern."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, normalizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, self.end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, str] = {i: t for t, i in vocabulary.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.width = max(self.tokens) + 1
        names = _byte_names()
        self.inner = np.array([vocabulary[n] for n in names], np.int64)
        self.last = np.array([vocabulary[n + self.end] for n in names], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in merges], np.int64)
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        self.product = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.memo: dict[bytes, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.cut = re.compile(b"(" + b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + b")") if self.special else None

        # the normalizer and the classes of the split pattern are those of the library that the file is for
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str

        def members(pattern: str) -> str:
            others = normalizers.Replace(Regex(pattern), "").normalize_str(ALL_CODE_POINTS)
            return _ranges(np.setdiff1d(_code_points(ALL_CODE_POINTS), _code_points(others), assume_unique=True))

        letters, numbers, blanks = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{blanks}{letters}{numbers}]+").findall
        self.ascii_words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\s0-9a-z]+", re.ASCII).findall

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Ranks of pair keys, NONE where there is no such merge."""
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], NONE)

    def merge_long(self, symbols: list[int]) -> list[int]:
        """The same merges for one very long word, from a heap of pairs."""
        n = len(symbols)
        following, before = [*range(1, n), -1], [-1, *range(n - 1)]
        ranks = self.find(np.array(symbols[:-1], np.int64) * self.width + np.array(symbols[1:], np.int64)).tolist()
        heap = [(r, i, symbols[i], symbols[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        memo: dict[int, int] = {}

        def push(i: int) -> None:
            j = following[i]
            key = symbols[i] * self.width + symbols[j]
            if key not in memo:
                memo[key] = int(self.find(np.array([key]))[0])
            if memo[key] != NONE:
                heapq.heappush(heap, (memo[key], i, symbols[i], symbols[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = following[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j] = int(self.product[rank]), -1
            following[i] = following[j]
            if following[j] >= 0:
                before[following[j]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbols if s >= 0]

    def merge(self, words: Sequence[bytes]) -> list[bytes]:
        """Token ids of words, none of them empty, as little-endian 32-bit numbers."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        for i in {*range(len(words))} - {*short}:
            raw = np.frombuffer(words[i], np.uint8)
            out[i] = np.array(self.merge_long([*self.inner[raw[:-1]].tolist(), int(self.last[raw[-1]])]), "<u4").tobytes()
        if not short:
            return out
        lengths = np.array([len(words[i]) for i in short])
        flat = np.frombuffer(b"".join([words[i] for i in short]), np.uint8)
        symbols, ends = self.inner[flat], np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        names = np.array(short)
        while len(symbols):
            starts = np.cumsum(lengths) - lengths
            rank = np.full(len(symbols), NONE)
            rank[:-1] = self.find(symbols[:-1] * self.width + symbols[1:])
            rank[starts + lengths - 1] = NONE  # a word's last symbol begins no pair
            least = np.minimum.reduceat(rank, starts)
            done = least == NONE
            if done.any():
                ended = np.repeat(done, lengths)
                raw, to = symbols[ended].astype("<u4").tobytes(), (4 * np.cumsum(lengths[done])).tolist()
                for i, a, b in zip(names[done].tolist(), [0, *to], to):
                    out[i] = raw[a:b]
                symbols, rank = symbols[~ended], rank[~ended]
                names, lengths, least = names[~done], lengths[~done], least[~done]
                if not len(symbols):
                    break
                starts = np.cumsum(lengths) - lengths
            hit = rank == np.repeat(least, lengths)
            # in a run of hits every second one from the left is merged
            at = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), at, 0))
            chosen = np.flatnonzero(hit & ((at - run_start) % 2 == 0))
            symbols[chosen] = self.product[rank[chosen]]
            kept = np.ones(len(symbols), bool)
            kept[chosen + 1] = False
            lengths = np.add.reduceat(kept, starts, dtype=np.int64)
            symbols = symbols[kept]
        return out

    def parts(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of parts between blanks, as little-endian 32-bit numbers."""
        split = [self.ascii_words(p.decode().lower()) if p.isascii() else self.words(self.normalize(p.decode())) for p in new]
        known = self.known
        missing = list({w for words in split for w in words if w not in known})
        known.update(zip(missing, self.merge([w.encode() for w in missing]), strict=True))
        made = {p: b"".join([known[w] for w in words]) for p, words in zip(new, split, strict=True)}
        self._forget(known, missing)
        return made

    @staticmethod
    def _forget(kept: dict, new: list) -> None:
        if len(kept) > MEMO_PARTS:
            kept.clear()
        for w in new:
            if len(w) > MEMO_BYTES:
                kept.pop(w, None)

    def encode(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        """Token ids of UTF-8 texts; the strings of added tokens in a text become those tokens."""
        segments = []
        for text in texts:
            pieces = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
            segments.append([(None, p.split()) if i % 2 == 0 else (self.special[p], None) for i, p in enumerate(pieces)])
        memo = self.memo
        missing = list({p for text in segments for _, parts in text if parts for p in parts if p not in memo})
        memo.update(self.parts(missing))
        ids = [np.frombuffer(b"".join([
            token.to_bytes(4, "little") if token is not None else b"".join([memo[p] for p in parts])
            for token, parts in text]), "<u4") for text in segments]
        self._forget(memo, missing)
        return ids

    def decode(self, ids: Sequence[int]) -> str:
        """Tokens with a space between them; the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@cache
def load(path: str) -> Bpe:
    return Bpe(path)


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Consecutive rows of up to about a million bytes, or one longer row."""
    start, total, held = 0, 0, []
    for i, text in enumerate(column.cast(pa.binary()).to_pylist()):
        if held and total + len(text) > 1 << 20:
            yield start, i, held
            start, total, held = i, 0, []
        held.append(text)
        total += len(text)
    if held:
        yield start, start + len(held), held


def encode_texts(docs: DataFrame, tokenizer: str | None = None, id_column: str = "doc_id", text: str = "text",
                 digests: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of every row's whole text; with ``digests`` the SHA-256 of the last two in their place.

    ``ids`` are token ids, ``decoded`` is the text that they decode to. A null or empty text has no tokens and decodes to an empty text.
    Rows are encoded one by one, so equal rows give equal results and no order matters; an empty table gives an empty result. A very long
    text is encoded whole, a million bytes of texts or one longer text at a time. A null id stays null; extra columns are ignored.
    ``tokenizer`` is the path of a vocabulary file that every executor can read.
    """
    workers_import(docs.sparkSession)
    path = tokenizer or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(path)
        for batch in batches:
            for a, b, texts in _texts(batch.column(1)):
                ids = own.encode(texts)
                decoded = [own.decode(x.tolist()) for x in ids]
                counts = pa.array([len(x) for x in ids], pa.int64())
                if digests:
                    made = [pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded])]
                else:
                    made = [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(decoded)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), counts, *made], names)

    names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    kinds = ("string", "string") if digests else ("array<int>", "string")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, {names[2]} {kinds[0]}, {names[3]} {kinds[1]}")

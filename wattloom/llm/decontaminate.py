"""Benchmark passages in documents, by a random-walk embedding of word edits into Hamming distance.

A walk stands on a word of a window, writes it at each step, and then stays or moves on by one word, as a bit of the word's hash for that
step says. Two windows that differ in a few word edits write the same words at most steps, so an edit distance becomes a Hamming
distance. Walks of an item's size start at every word of the documents and of the items. Their outputs are compared on samples of
steps, in several walks; equal samples make a candidate, and each candidate is settled by the exact edit distance in words.

Samples are drawn from stretches of a walk that grow from a few steps to the whole window. The longer ones are sure of themselves: they
agree nearly nowhere but at a passage. Two walks part at an edit and may meet late, so at the full allowed edits the shorter ones do the
finding. The shortest has as many steps as the piece of words that ``k`` edits must leave whole somewhere in an item (``k + 1`` pieces),
and a walk never moves more words than steps; so the recall within the allowed edits is 1 and not only the target of 0.9.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import filter_rows, slices, workers_import
from wattloom.llm.hashing import ascii_words, mix, word_hashes

#: Edits allowed, as a part of the item's words.
MOST_EDITS = 0.2
#: Walks compared on the shortest stretch, and on each longer one.
SHORT_WALKS, LONG_WALKS = 4, 2
#: Steps sampled from a stretch.
SAMPLED = 5
#: Steps of a walk for which every word is a start; twice as many steps start at every second word, and so on.
DENSE = 64
#: Characters of benchmark text that one pass over the documents holds, about 90 bytes a word; a larger benchmark takes several passes.
BLOCK_CHARS = 4_000_000
SLICE_CHARS = 2_000_000
BLOCK = 1 << 14
#: Words of regions that are counted at once.
CELLS = 1_000_000
_SEED = 20_240_501


def walk_steps(n: int) -> int:
    """Steps of a walk over an item of ``n`` words: the power of two above ``n``, at most ``2 n``, as every other step moves on."""
    return 1 << n.bit_length()


def stretches(steps: int, most_edits: float) -> list[int]:
    """The stretches compared for items with walks of so many steps, shortest first."""
    n = np.arange(max(1, steps // 2), max(2, steps))
    whole = max(1, int((n // ((most_edits * n).astype(np.int64) + 1)).min()))
    longer = [16 * 4 ** i for i in range(16) if whole < 16 * 4 ** i < steps]
    return sorted({whole, *longer, steps})


@lru_cache(4096)
def sampled(walk: int, stretch: int) -> np.ndarray:
    """The steps of a walk that one sample compares."""
    if stretch <= SAMPLED:
        return np.arange(stretch)
    return np.sort(np.random.default_rng([_SEED, walk, stretch]).choice(stretch, SAMPLED, replace=False))


def word_signs(words: np.ndarray) -> np.ndarray:
    """What a walk writes for each word."""
    return mix(words + np.uint64(0x51ED270B))


def walk_keys(words: np.ndarray, signs: np.ndarray, starts: np.ndarray, walk: int, wanted: list[int],
              track: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(stretch, starts, keys, sampled places if tracked)`` of a walk for each wanted stretch.

    ``words`` and their ``signs`` go on past the longest stretch. Stretches over ``DENSE`` steps are left to starts that are multiples of
    ``stretch / DENSE``.
    """
    factor = np.uint64(0x9FB21C651E98DF25)
    place, begun = starts.copy(), starts
    open_ = {s: (set(sampled(walk, s).tolist()), np.full(len(starts), np.uint64(s * 64 + walk), np.uint64), []) for s in wanted}
    moves = None
    for t in range(max(wanted)):
        if t >= DENSE and not t & t - 1:
            keep = begun % (2 * t // DENSE) == 0
            place, begun = place[keep], begun[keep]
            open_ = {s: (at, keys[keep], [p[keep] for p in seen]) for s, (at, keys, seen) in open_.items()}
        if t % 64 == 0:
            moves = mix(words ^ np.uint64(0xA5A5A5A5 + (walk << 40) + (t << 48)))
        sign = None
        for s, (at, keys, seen) in list(open_.items()):
            if t in at:
                sign = signs[place] if sign is None else sign
                keys *= factor
                keys += sign
                if track:
                    seen.append(place.copy())
                at.remove(t)
                if not at:
                    yield s, begun, mix(keys), np.array(seen)
                    del open_[s]
        if not open_:
            return
        move = moves[place]
        move >>= np.uint64(t % 64)
        move &= np.uint64(1)
        place += move.view(np.int64)


def edits(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """The fewest word edits between the item and any part of the region, and where such a part ends."""
    columns = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for word in item:
        step = row + 1
        np.minimum(step[1:], row[:-1] + (region != word), out=step[1:])
        row = np.minimum.accumulate(step - columns) + columns
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """The walks of one block of items, and the check of candidates."""

    def __init__(self, texts: list[str], most_edits: float = MOST_EDITS):
        self.words = [word_hashes(ascii_words(t)) for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.allowed = [int(most_edits * n) for n in self.sizes.tolist()]
        steps = np.array([walk_steps(n) for n in self.sizes.tolist()], np.int64)
        self.wanted: dict[int, set[int]] = {}  # stretches by walk
        found = []  # keys, items, offsets
        for size in sorted(set(steps[self.sizes > 0].tolist())):
            mine = np.flatnonzero(steps == size)
            sizes = self.sizes[mine]
            words = np.concatenate([*(self.words[i] for i in mine), np.zeros(size + 1, np.uint64)])
            item, end = np.repeat(mine, sizes), np.repeat(np.cumsum(sizes), sizes)
            offset = np.arange(len(item)) - (end - np.repeat(sizes, sizes))
            for stretch in stretches(size, most_edits):
                short = stretch == stretches(size, most_edits)[0]
                best, kept = np.zeros(len(item), np.int64), np.zeros(len(item), np.uint64)
                for walk in range(SHORT_WALKS if short else LONG_WALKS):
                    self.wanted.setdefault(walk, set()).add(stretch)
                    keys, places = self._all_keys(words, len(item), walk, stretch)
                    # only samples inside the item can be found again
                    distinct = np.where(places[-1] < end, 1 + (np.diff(places, axis=0) > 0).sum(0), 0)
                    if short:  # of the walks from one start the one whose sample holds most words
                        better = distinct > best
                        kept[better], best[better] = keys[better], distinct[better]
                    else:
                        found.append((keys[distinct > 0], item[distinct > 0], offset[distinct > 0]))
                if short:
                    found.append((kept[best > 0], item[best > 0], offset[best > 0]))
        keys = np.concatenate([np.zeros(0, np.uint64), *(f[0] for f in found)])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.item, self.offset = (np.concatenate([np.zeros(0, np.int64), *(f[j] for f in found)])[order].astype(np.int32) for j in (1, 2))
        bits = int(np.clip(np.ceil(np.log2(max(1, len(keys)))) + 8, 16, 28))
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.keys >> self.shift] = True
        # words by item, to count what a region shares with an item
        own = np.concatenate([np.zeros(0, np.uint64), *self.words])
        bits = int(np.clip(np.ceil(np.log2(max(1, len(own)))) + 8, 16, 26))
        self.own_shift = np.uint64(64 - bits)
        self.own = np.zeros(1 << bits, bool)
        self.own[mix(own + np.repeat(self.salts(np.arange(len(self.words))), self.sizes)) >> self.own_shift] = True

    @staticmethod
    def _all_keys(words: np.ndarray, n: int, walk: int, stretch: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and sampled places from every start, whatever the stretch: a stretch that skips starts is begun at 0 by shifts."""
        step = max(1, stretch // DENSE)
        keys, places, signs = np.zeros(n, np.uint64), None, word_signs(words)
        for shift in range(min(step, n)):
            starts = np.arange(0, n - shift, step)
            for _, begun, got, seen in walk_keys(words[shift:], signs[shift:], starts, walk, [stretch], True):
                places = np.zeros((len(seen), n), np.int64) if places is None else places
                keys[begun + shift], places[:, begun + shift] = got, seen + shift
        return keys, places

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, the places where they would begin, and the starts of the walks that agree."""
        reach = max((max(w) for w in self.wanted.values()), default=0)
        padded = np.concatenate([words, np.zeros(reach + 1, np.uint64)])
        items, places, hits = [], [], []
        for a in range(0, len(words), BLOCK):
            part = padded[a:a + BLOCK + reach + 1]
            signs = word_signs(part)
            starts = np.arange(min(BLOCK, len(words) - a))
            for walk, wanted in self.wanted.items():
                for _, begun, keys, _ in walk_keys(part, signs, starts, walk, sorted(wanted)):
                    hit = np.flatnonzero(self.seen[keys >> self.shift])
                    if not len(hit):
                        continue
                    low = np.searchsorted(self.keys, keys[hit], "left")
                    n = np.searchsorted(self.keys, keys[hit], "right") - low
                    at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    items.append(self.item[at].astype(np.int64))
                    hits.append(np.repeat(begun[hit] + a, n))
                    places.append(hits[-1] - self.offset[at])
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *items]), np.concatenate([empty, *places]), np.concatenate([empty, *hits])

    @staticmethod
    def salts(items: np.ndarray) -> np.ndarray:
        return mix(items.astype(np.uint64) + np.uint64(1))

    def shares(self, words: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether each region has as many words of its item as a passage within the allowed edits must have. Never too few are counted."""
        need = self.sizes[item] - np.array(self.allowed, np.int64)[item]
        out = np.zeros(len(item), bool)
        for a, b in slices((end - start).tolist(), CELLS):
            width = end[a:b] - start[a:b]
            at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width - start[a:b], width)
            known = self.own[mix(words[at] + np.repeat(self.salts(item[a:b]), width)) >> self.own_shift]
            sums = np.concatenate([[0], np.cumsum(known)])
            ends = np.cumsum(width)
            out[a:b] = sums[ends] - sums[ends - width] >= need[a:b]
        return out

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """``(text, item, edits, end word)`` of the best place of each item in each text."""
        split = [ascii_words(t) for t in texts]
        lengths = np.array([len(s) for s in split], np.int64)
        if not len(self.keys) or not lengths.sum():
            return []
        words = word_hashes([w for s in split for w in s])
        ends = np.cumsum(lengths)
        item, place, hit = self.candidates(words)
        owner = np.searchsorted(ends, hit, "right")
        # places as near as the allowed edits have one region, which reaches far enough for all of them
        most = np.array(self.allowed, np.int64)
        near = place // (most[item] + 1)
        order = np.lexsort((near, item, owner))
        item, place, owner, near = item[order], place[order], owner[order], near[order]
        new = np.append(True, (np.diff(owner) != 0) | (np.diff(item) != 0) | (np.diff(near) != 0))[:len(item)]
        item, place, owner = item[new], place[new], owner[new]
        begin, slack = ends[owner] - lengths[owner], 3 * most[item] + 2
        left, right = np.maximum(begin, place - slack), np.minimum(ends[owner], place + self.sizes[item] + slack)
        able = np.flatnonzero(self.shares(words, item, left, right))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for o, i, a, b, start in zip(*(x[able].tolist() for x in (owner, item, left, right, begin)), strict=True):
            cost, end = edits(self.words[i], words[a:b])
            if cost <= self.allowed[i] and (cost, a + end - start) < best.get((o, i), (1 << 40, 0)):
                best[o, i] = (cost, a + end - start)
        return [(o, i, c, e) for (o, i), (c, e) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size; the number of blocks follows the size of the benchmark."""
    items = benchmark.select(F.col(item_id).alias("_i"), F.col(text).alias("_t")).where(F.length("_t") > 0)
    chars = items.agg(F.sum(F.length("_t"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("_i", "_t"), F.lit(blocks)) == b) if blocks > 1 else items
        yield [(r["_i"], r["_t"]) for r in mine.orderBy("_i", "_t").collect()]


def find_items(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", most_edits: float = MOST_EDITS) -> DataFrame:
    """``(doc_id, item_id, edits, item_words, end_word)``: the best place of each item that a row's whole text holds.

    A row holds an item if some run of its words is at most ``most_edits`` of the item's words away from it. Items and rows without
    words match nothing. Equal rows, and equal items, match each for itself. Extra columns are ignored. An empty table on either side
    gives no rows; very long texts are walked in blocks of words. Reading the items runs jobs when this is called.
    """
    workers_import(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("_t"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, item_id {dict(benchmark.dtypes)[item_id]}, edits int, item_words int, end_word long"
    found = rows.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id, item_text):
        found = found.unionByName(rows.mapInPandas(_finder(block, most_edits), schema))
    return found


def _finder(block: list[tuple], most_edits: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = Items([t for _, t in block], most_edits)
        for frame in frames:
            texts, ids, out = frame["_t"].tolist(), frame["doc_id"].tolist(), []
            for a, b in slices([len(t or "") for t in texts], SLICE_CHARS):
                out += [(ids[a + o], block[i][0], c, len(items.words[i]), e) for o, i, c, e in items.matches(texts[a:b])]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "edits", "item_words", "end_word"])

    return run


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  most_edits: float = MOST_EDITS) -> DataFrame:
    """The rows whose text holds no item, with all their columns.

    Rows without words and all rows of an empty benchmark stay; repeated rows are judged alike. Reading the items runs jobs when this is
    called.
    """
    workers_import(docs.sparkSession)
    kept = docs
    for block in item_blocks(benchmark, item_id, item_text):
        kept = filter_rows(kept, text, _judge(block, most_edits))
    return kept


def _judge(block: list[tuple], most_edits: float):
    def make():
        items = Items([t for _, t in block], most_edits)

        def clean(texts: list[str | None]) -> np.ndarray:
            out = np.ones(len(texts), bool)
            for a, b in slices([len(t or "") for t in texts], SLICE_CHARS):
                out[[a + o for o, *_ in items.matches(texts[a:b])]] = False
            return out

        return clean

    return make

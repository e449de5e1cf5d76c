"""Removal of long repeated passages by bucket-pointer refinement.

Suffixes are put into buckets by a q-gram, buckets with one suffix are done, and the others are refined by the buckets of later
offsets until a bucket's suffixes share the whole passage length. Here a bucket stands for a run of starts at once: all starts whose
passage holds the same least q-gram (an anchor, chosen by the passage alone, so equal passages have equal anchors). The first buckets
are anchors by their q-gram. A refinement cuts a run into blocks by the distance to the anchor. What all passages of a block share is its
core, what they cover together its context. A core that occurs once settles the block as unrepeated, a context that occurs again as
repeated; the rest is cut into smaller blocks, down to single starts, where core and context are the passage itself.
"""

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wattloom.llm.common import slices, small_enough, stored, workers_import
from wattloom.llm.hashing import mix

LENGTH = 400
GRAM = 64
BLOCKS = (64, 8, 1)
HOT = 10_000
SLICE_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Hasher:
    """Hashes of any byte ranges of one buffer in constant time each."""

    _values = np.random.default_rng(20_240_502).integers(0, 1 << 64, 256, np.uint64)
    _up = _down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        cls = type(self)
        if len(cls._up) <= len(data):
            size = 1 << len(data).bit_length()
            cls._up, cls._down = (np.multiply.accumulate(np.append(np.uint64(1), np.full(size, x, np.uint64))) for x in (_BASE, _INVERSE))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(cls._values[data] * cls._up[:len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self._down[start]
        return mix(raw + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self._down[:n] + np.uint64(size))


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(gram hash, anchor, first start, last start)`` of all runs of starts; texts end at ``ends`` in the buffer."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty, empty, empty
    grams = Hasher(data).grams(gram)
    low = np.uint64((1 << len(data).bit_length()) - 1)
    least = window_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    anchor = (least & low).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    alive = np.zeros(len(anchor) + 1, np.int32)
    long = ends - begins >= length
    np.add.at(alive, begins[long], 1)
    np.add.at(alive, ends[long] - length + 1, -1)
    alive = np.cumsum(alive[:-1]) > 0
    # at a text's first start a new run begins even if the anchor were the same
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new[begins[long]] = True
    first = np.flatnonzero(alive & (new | np.concatenate([[True], ~alive[:-1]])))
    stops = np.flatnonzero(alive & np.concatenate([new[1:] | ~alive[1:], [True]]))
    return grams[anchor[first]], anchor[first], first, stops


def _buffers(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Parts of a frame with their texts' bytes in one buffer, and where each ends."""
    raw = [t.encode() for t in frame["_t"]]
    for a, b in slices([len(r) for r in raw], SLICE_BYTES):
        yield frame.iloc[a:b], np.frombuffer(b"".join(raw[a:b]), np.uint8), np.cumsum([len(r) for r in raw[a:b]]).astype(np.int64)


def first_buckets(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(gram, tid, a, lo, hi)`` of every text ``(tid, _t)``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, data, ends in _buffers(frame):
                grams, anchor, lo, hi = runs(data, ends, length, gram)
                text = np.searchsorted(ends, lo, "right")
                begin = (ends - np.diff(np.concatenate([[0], ends])))[text]
                yield pd.DataFrame({"gram": grams.view(np.int64), "tid": part["tid"].to_numpy()[text], "a": anchor - begin,
                                    "lo": lo - begin, "hi": hi - begin})

    return texts.mapInPandas(run, "gram long, tid long, a long, lo long, hi long")


def refine(texts: DataFrame, blocks: DataFrame, size: int, length: int) -> DataFrame:
    """``(tid, a, k0, c0, c1, core, context)`` of blocks ``(tid, a, c0, c1)`` cut at multiples of ``size``.

    Starts lie ``c0`` to ``c1`` before the anchor. The context is null for a block that its run covers in part.
    """
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, data, ends in _buffers(frame):
                hasher = Hasher(data)
                counts = [len(x) for x in part["_a"]]
                begin = np.repeat(ends - np.diff(np.concatenate([[0], ends])), counts)
                tid = np.repeat(part["tid"].to_numpy(), counts)
                a, c0, c1 = (np.concatenate(list(part[c])).astype(np.int64) for c in ("_a", "_c0", "_c1"))
                pieces = c1 // size - c0 // size + 1
                row = np.repeat(np.arange(len(a)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                k0 = (c0[row] // size + nth) * size
                k1 = k0 + size - 1
                whole = (c0[row] <= k0) & (k1 <= c1[row])
                at = a[row] + begin[row]
                core = hasher.ranges(at - k0, at - k1 + length) ^ mix(k0.astype(np.uint64) + np.uint64(size << 32))
                left = np.where(whole, at - k1, 0)
                context = hasher.ranges(left, np.where(whole, at - k0 + length, 0)) ^ mix(k0.astype(np.uint64) + np.uint64(size << 33))
                yield pd.DataFrame({
                    "tid": tid[row], "a": a[row], "k0": k0, "c0": np.maximum(k0, c0[row]), "c1": np.minimum(k1, c1[row]),
                    "core": core.view(np.int64), "context": pd.Series(context.view(np.int64), dtype="Int64").where(whole)})

    gathered = blocks.groupBy("tid").agg(F.collect_list(F.struct("a", "c0", "c1")).alias("_b")).select(
        "tid", F.col("_b.a").alias("_a"), F.col("_b.c0").alias("_c0"), F.col("_b.c1").alias("_c1"))
    return texts.join(gathered, "tid").mapInPandas(
        cut, "tid long, a long, k0 long, c0 long, c1 long, core long, context long")


def repeated(hashes: DataFrame, column: str, *more: Column) -> DataFrame:
    """Values that occur in two rows or more, with their number ``_n``."""
    return stored(hashes.groupBy(column).agg(F.count(F.lit(1)).alias("_n"), *more).where("_n > 1"), "values")


def meet(rows: DataFrame, values: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` joined, ``left`` or ``left_semi``, to ``values`` of one row a key with its number of rows ``_n``.

    A key of over ``HOT`` rows would fill one task, as a word without end does whose every period begins a run. There are few such keys, at
    most one in ``HOT`` rows, so they are broadcast and their rows stay where they lie; only the other rows are dealt by key.
    """
    hot = values.where(F.col("_n") > HOT)
    if hot.isEmpty():
        return rows.join(values, key, how)
    hot = small_enough(hot)
    rest = rows.join(hot, key, "left_anti").join(values.where(F.col("_n") <= HOT), key, how)
    return rest.unionByName(rows.join(hot, key, "inner" if how == "left" else how))


def repeated_starts(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(tid, lo, hi)``: runs of starts whose passage also starts elsewhere, for distinct texts ``(tid, _t)``."""
    first = stored(first_buckets(texts, length, gram), "runs")
    least, most = (f(F.struct("tid", "a")) for f in (F.min, F.max))
    shared = repeated(first, "gram", least.alias("_x"), most.alias("_y")).where("_x <> _y").select("gram", "_n")
    open_ = meet(first, shared, "gram", "left_semi").select(
        "tid", "a", (F.col("a") - F.col("hi")).alias("c0"), (F.col("a") - F.col("lo")).alias("c1"))
    open_ = stored(open_, "blocks")
    some = stored(texts.join(small_enough(open_.select("tid").distinct()), "tid", "left_semi"), "texts")
    done = []
    for size in BLOCKS:
        hashes = stored(refine(some, open_, size, length), "cores")
        again = meet(hashes, repeated(hashes, "core"), "core", "left_semi")
        whole = repeated(hashes.where("context IS NOT NULL"), "context", least.alias("_first"))
        met = meet(again.where("context IS NOT NULL"), whole, "context", "left").select(
            "tid", "a", "c0", "c1", "core", F.col("_n").isNotNull().alias("_again"),
            F.coalesce(F.struct("tid", "a") == F.col("_first"), F.lit(False)).alias("_stands"))
        no = F.lit(False)
        judged = stored(met.unionByName(again.where("context IS NULL").select(
            "tid", "a", "c0", "c1", "core", no.alias("_again"), no.alias("_stands"))), "judged")
        done.append(judged.where("_again").select(
            "tid", (F.col("a") - F.col("c1")).alias("lo"), (F.col("a") - F.col("c0")).alias("hi")))
        # one of the blocks with a repeated context goes on, where others with its core are open, as what they may repeat
        left = judged.where("NOT _again")
        standing = judged.where("_stands").join(left.select("core").distinct(), "core", "left_semi")
        open_ = left.unionByName(standing.select(left.columns)).select("tid", "a", "c0", "c1")
    return reduce(DataFrame.unionByName, done)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text)`` of every row.

    Every byte is removed that lies in a passage of ``length`` bytes which also starts elsewhere, in the same text or another row's. A
    null text has no bytes. A row whose text occurs in another row goes as a whole if it has ``length`` bytes. Texts are told apart by a
    64-bit hash, passages by another. Bytes that are left of a cut character are dropped in ``kept_text``, but count in the digest.
    Extra columns are ignored.
    """
    workers_import(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t")).withColumn(
        "tid", F.xxhash64("_t")).withColumn("n_bytes", F.octet_length("_t").cast("long"))
    copies = stored(rows.where(F.col("n_bytes") >= length).groupBy("tid").agg(
        F.count(F.lit(1)).alias("_copies"), F.min("doc_id").alias("_first")).where("_copies > 1"), "copies")
    # one row stands for all copies of a text; copies that share an id too are told from nothing, and give equal runs
    marked = rows.join(small_enough(copies), "tid", "left")
    texts = marked.where((F.col("n_bytes") >= length) & (F.col("_copies").isNull() | F.col("doc_id").eqNullSafe(F.col("_first")))).select(
        "tid", "_t")
    starts = repeated_starts(texts, length).join(small_enough(copies), "tid", "left_anti")
    spans = stored(starts.groupBy("tid").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("_s")).select(
        "tid", F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi")), "spans")
    ids = small_enough(spans.select("tid"))
    untouched = marked.join(ids, "tid", "left_anti")
    whole = F.col("_copies").isNotNull()
    plain = untouched.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"), F.when(whole, 1).otherwise(0).cast("long").alias("n_spans"),
        F.sha2(F.when(whole, F.lit("")).otherwise(F.col("_t")).cast("binary"), 256).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("_t")).alias("kept_text"))
    kind = dict(rows.dtypes)["doc_id"]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for i, t, lo, hi in zip(frame["doc_id"], frame["_t"], frame["_lo"], frame["_hi"], strict=True):
                raw = t.encode()
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, np.asarray(lo), 1)
                np.add.at(edge, np.asarray(hi) + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((i, len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    touched = rows.join(ids, "tid", "left_semi").join(spans, "tid").select("doc_id", "_t", "_lo", "_hi").mapInPandas(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return plain.unionByName(touched)

"""Jaccard join of texts on word n-grams by parity sketches.

A text's set is its distinct n-grams as 64-bit hashes. A sketch has blocks; every n-gram XORs its hash into one block, so the blocks in
which two sketches differ are at most the n-grams that one set has and the other has not. Sets of a band of sizes share a number of
blocks. Two sets that link differ in at most ``d`` blocks, so any ``d + 1`` filled blocks, taken in one order by both, have one in
common. The order takes frequent blocks last. Any order gives the same links, so it may rest on a table of fixed size: for each slot of
the key space, how many sets have the most frequent block there.

Equal blocks are joined by stars: the smallest member of a block is paired with each other one, first within the texts that one task
reads, then among all. Pairs are first held against sketches of single bits, whose Hamming distance is at most the symmetric difference
of the sets, and then verified on the whole sets. Where that leaves members of a block in different components, the sketches of those
still apart are compared, a bounded number of members against as many in a task, and the sets of those that may link are verified there
until all are joined that can be. So no component is missed. Links are counted last: in a component where not every pair is known to link, all sets are compared exactly, again in cells of
bounded size, and only the sums per set leave a cell.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from wattloom.llm.common import settle, slices, small_enough, stored, workers_import
from wattloom.llm.components import components
from wattloom.llm.hashing import ascii_words, mix, word_hashes

WORDS = 5
#: Similarity at or above which texts link, as a fraction of whole numbers.
SHARE, WHOLE = 75, 100
#: Sets below this size have a block for each n-gram.
SMALL_SET = 128
#: The most slots of the frequency table, a byte each, and the least number of sets that counts as frequent. The table is broadcast;
#: fewer n-grams have fewer slots.
SLOT_BITS, LEAST_SLOT_BITS, OFTEN = 24, 14, 3
#: Block keys that a map task holds before it sends them on, and about how many a reduce task gets.
CHUNK_KEYS, SHARD_KEYS = 1_000_000, 1_000_000
COUNT_KEYS, LEAST_SHARD_BITS = 1_500_000, 8
#: Members of a block that are compared with as many others at once; larger blocks are cut into cells.
CELL = 2000
#: Sets of a component, and their n-grams, that are compared exactly with as many others at once to count links.
LINK_CELL, LINK_CELL_GRAMS = 500, 2_000_000
SLICE_CHARS = 1_000_000
KEY_BYTES = 6


_FACTOR = np.uint64(0x9FB21C651E98DF25)


def text_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct n-grams of each text; a shorter text is one n-gram, a text without words none."""
    split = [ascii_words(t) for t in texts]
    mixed = mix(word_hashes([w for s in split for w in s]))
    # n-grams that run over the end of a text are never taken
    grams = _joined(mixed, n)
    out, end = [], 0
    for s in split:
        start, end = end, end + len(s)
        if len(s) < n:
            out.append(_joined(mixed[start:end], len(s)) if s else mixed[:0])
            continue
        own = np.sort(grams[start:end - n + 1])
        new = own[1:] != own[:-1]
        out.append(own if new.all() else own[np.concatenate([[True], new])])
    return out


def _joined(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    grams = np.full(max(0, len(words) - size + 1), np.uint64(size), np.uint64)
    for k in range(size):
        grams *= _FACTOR
        grams += words[k:len(grams) + k]
    return mix(grams)


def set_id(grams: np.ndarray) -> int:
    """A 63-bit hash of a set: texts with equal sets have equal ids."""
    if not len(grams):
        return -1
    both = np.array([grams.sum(dtype=np.uint64), np.bitwise_xor.reduce(grams * _FACTOR)]) + np.uint64(len(grams))
    return int(np.bitwise_xor.reduce(mix(both)) >> np.uint64(1))


def bands(size: int) -> list[tuple[int, int]]:
    """``(blocks, largest size)`` of the bands a set of this size takes part in; 0 blocks: one for each n-gram.

    A band begins at a power of two; a set also takes part in the next one if it can link with a set there.
    """
    lower = SMALL_SET if size < SMALL_SET else 1 << (size.bit_length() - 1)
    own = (0, SMALL_SET - 1) if size < SMALL_SET else (lower, 2 * lower - 1)
    above = lower if size < SMALL_SET else 2 * lower
    return [own, (above, 2 * above - 1)] if size * WHOLE >= SHARE * above else [own]


def block_keys(grams: np.ndarray, blocks: int) -> np.ndarray:
    """Keys of the filled blocks of a sketch. N-grams are sorted, so a block's are neighbours."""
    if not blocks:
        return mix(grams ^ np.uint64(0x0123456789ABCDEF))
    place = ((grams >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    parity = np.bitwise_xor.reduceat(mix(grams ^ np.uint64(0x5DEECE66D)), first)
    return mix(parity ^ mix(place[first] + np.uint64(blocks << 20)))


def differing(size: int, largest: int) -> int:
    """The most n-grams that are in only one of a set of this size and one that it links with, of up to ``largest``."""
    other = min(size * WHOLE // SHARE, largest)
    return (size + other) * (WHOLE - SHARE) // (WHOLE + SHARE)


def bit_sketch(grams: np.ndarray) -> bytes:
    """Parities of the n-grams that hash to each bit; the number of bits is two to four times that of a set's n-grams, 64 at least."""
    bits = max(64, 2 << len(grams).bit_length())
    odd = np.bincount((grams >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance at the smaller one's number of bits; the larger one's halves are put together by exclusive or."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def chosen_keys(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Of each band, the first ``d + 1`` filled blocks in the order of frequency and key."""
    out = []
    for blocks, largest in bands(len(grams)):
        keys = block_keys(grams, blocks)
        need = differing(len(grams), largest) + 1
        if len(keys) > need:
            slot = keys >> np.uint64(65 - len(table).bit_length())
            order = keys >> np.uint64(8) | table[slot].astype(np.uint64) << np.uint64(56)
            keys = keys[np.argpartition(order, need - 1)[:need]]
        elif blocks and len(keys) < need:
            raise ValueError(f"a sketch of {len(grams)} n-grams fills only {len(keys)} blocks of {blocks}")
        out.append(keys)
    return np.concatenate(out)


def _frames(frames: Iterator[pd.DataFrame], n: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    for frame in frames:
        texts = frame["_t"].tolist()
        for a, b in slices([len(t or "") for t in texts], SLICE_CHARS):
            yield frame.iloc[a:b], text_sets(texts[a:b], n)


def identify(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, row, n_shingles, set_id, sketch)`` for ``(doc_id, row, _t)``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, sets in _frames(frames, n):
            yield pd.DataFrame({"doc_id": part["doc_id"], "row": part["row"], "n_shingles": [len(s) for s in sets], "set_id": [set_id(s) for s in sets],
                                "sketch": [bit_sketch(s) for s in sets]})

    return docs.mapInPandas(run, f"doc_id {dict(docs.dtypes)['doc_id']}, row long, n_shingles long, set_id long, sketch binary")


def frequency_table(docs: DataFrame, n: int, total: int) -> np.ndarray:
    """For each slot of the key space the level of its most frequent block, 0 if all are rare; counted over all sets.

    A map task counts its own keys, sends repeated ones with their counts and the others by 32 bits, by the leading bits of the key.
    """
    slot_bits = min(SLOT_BITS, max(LEAST_SLOT_BITS, total.bit_length()))
    lead = min(slot_bits, max(LEAST_SHARD_BITS, (total // SHARD_KEYS).bit_length()))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, ids = [], 0, set()

        def packed() -> pd.DataFrame:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            brief = (keys >> np.uint64(32 - lead)).astype(np.uint32)
            rows = []
            for s, a, b in _runs(keys >> np.uint64(64 - lead)):
                k, c = brief[a:b], times[a:b]
                rows.append((s, k[c == 1].tobytes(), k[c > 1].tobytes(), c[c > 1].astype(np.uint32).tobytes()))
            return pd.DataFrame(rows, columns=["shard", "once", "more", "times"])

        for _, sets in _frames(frames, n):
            for s in sets:
                if len(s) and (i := (len(s), int(s[0]), int(s[-1]))) not in ids:  # copies count once
                    ids.add(i)
                    found = [block_keys(s, blocks) for blocks, _ in bands(len(s))]
                    held += found
                    size += sum(map(len, found))
            if size > COUNT_KEYS:
                yield packed()
                held, size, ids = [], 0, set()
        if held:
            yield packed()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        once, more, times = (np.frombuffer(b"".join(group[c]), np.uint32) for c in ("once", "more", "times"))
        keys, back = np.unique(np.concatenate([once, more]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([np.ones(len(once)), times]), len(keys))
        often = counts >= OFTEN
        levels = np.zeros(1 << (slot_bits - lead), np.uint8)
        np.maximum.at(levels, keys[often] >> np.uint32(32 - slot_bits + lead), np.minimum(8 * np.log2(counts[often]), 255).astype(np.uint8))
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "levels": [levels.tobytes()]})

    sent = docs.mapInPandas(send, "shard int, once binary, more binary, times binary")
    table = np.zeros(1 << slot_bits, np.uint8)
    width = 1 << (slot_bits - lead)
    for r in sent.groupBy("shard").applyInPandas(add, "shard int, levels binary").toLocalIterator():
        table[r["shard"] * width:(r["shard"] + 1) * width] = np.frombuffer(r["levels"], np.uint8)
    return table


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(value, start, end)`` of the runs of sorted values."""
    if len(values):
        starts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
        yield from zip(values[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True)


def star_pairs(docs: DataFrame, n: int, table, shards: int) -> DataFrame:
    """``(key, center, member)``: for every block with several members, each of them but the smallest paired with a smaller one."""
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, owners, ids, size = [], [], [], 0

        def packed() -> pd.DataFrame:
            order = np.argsort(ids)
            names, back = np.array(ids, np.int64)[order], np.empty(len(ids), np.int64)
            back[order] = np.arange(len(ids))
            key, owner = np.concatenate(keys), back[np.concatenate(owners)]
            by = np.lexsort((owner, key))
            key, owner = key[by], owner[by]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            first = owner[new][np.cumsum(new) - 1]
            shard = (key >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)
            rows, place = [], np.zeros(len(names), np.uint32)
            for s, a, b in _runs(shard):
                k, lead = key[a:b], new[a:b]
                # a shard gets the ids of its own members only; the first member of a block is one of them
                mine = np.zeros(len(names), bool)
                mine[owner[a:b]] = True
                own = np.flatnonzero(mine)
                place[own] = np.arange(len(own))
                o, f = place[owner[a:b]], place[first[a:b]]
                rows.append((s, _cut(k[lead]), o[lead].tobytes(), names[own].tobytes(), _cut(k[~lead]), f[~lead].tobytes(), o[~lead].tobytes()))
            return pd.DataFrame(rows, columns=["shard", "key", "node", "names", "e_key", "e_center", "e_member"])

        place: dict[int, int] = {}
        for _, sets in _frames(frames, n):
            for s in sets:
                if len(s) and (i := set_id(s)) not in place:
                    place[i] = len(ids)
                    ids.append(i)
                    found = np.unique(chosen_keys(s, table.value))
                    keys.append(found)
                    owners.append(np.full(len(found), place[i], np.int64))
                    size += len(found)
            if size > CHUNK_KEYS:
                yield packed()
                keys, owners, ids, size, place = [], [], [], 0, {}
        if keys:
            yield packed()

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        names = [np.frombuffer(x, np.int64) for x in group["names"]]

        def column(c: str) -> np.ndarray:
            return np.concatenate([m[np.frombuffer(x, np.uint32)] for m, x in zip(names, group[c], strict=True)])

        key, node = _uncut(b"".join(group["key"])), column("node")
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        center = node[new][np.cumsum(new) - 1]
        apart = center != node
        # a member that leads its own chunk is paired with the smallest leader
        all_keys = np.concatenate([key[apart], _uncut(b"".join(group["e_key"]))])
        out = pd.DataFrame({"key": all_keys * shards + int(group["shard"].iloc[0]),
                            "center": np.concatenate([center[apart], column("e_center")]),
                            "member": np.concatenate([node[apart], column("e_member")])})
        return out[out["center"] != out["member"]]

    sent = docs.mapInPandas(send, "shard int, key binary, node binary, names binary, e_key binary, e_center binary, e_member binary")
    return sent.groupBy("shard").applyInPandas(meet, "key long, center long, member long")


def _cut(keys: np.ndarray) -> bytes:
    """The low bytes of keys; the shard stands for the high ones. Keys only propose pairs, so a clash costs one check."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _uncut(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return out.view(np.int64).ravel()


def verified(pairs: DataFrame, docs: DataFrame, known: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """``(u, v)`` of the pairs whose sets are similar enough, and the ``(set_id, grams)`` they were judged on."""
    own = known.groupBy("set_id").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))

    def side(c: str) -> DataFrame:
        return own.select(F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            apart = [sketch_distance(a, b) for a, b in zip(f["s_u"], f["s_v"], strict=True)]
            yield f.loc[np.array(apart) * (WHOLE + SHARE) <= (f["n_u"] + f["n_v"]) * (WHOLE - SHARE), ["u", "v"]]

    sized = pairs.join(side("u"), "u").join(side("v"), "v").where(
        F.least("n_u", "n_v") * WHOLE >= F.greatest("n_u", "n_v") * SHARE)
    pairs = stored(sized.mapInPandas(near, "u long, v long"), "near")
    sets = whole_sets(pairs.select(F.explode(F.array("u", "v")).alias("set_id")).distinct(), docs, known, n)
    both = pairs.join(sets.select(F.col("set_id").alias("u"), F.col("grams").alias("a")), "u").join(
        sets.select(F.col("set_id").alias("v"), F.col("grams").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.withColumn("_i", shared).where(
        F.col("_i") * WHOLE >= (F.size("a") + F.size("b") - F.col("_i")) * SHARE).select("u", "v"), sets


def whole_sets(wanted: DataFrame, docs: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """``(set_id, grams)`` of the wanted ``(set_id)``, made anew from one text of each."""
    wanted = settle(wanted)
    one = known.join(small_enough(wanted), "set_id", "left_semi").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    ids = settle(one.select("doc_id").distinct())
    some = docs.join(small_enough(ids.withColumnRenamed("doc_id", "_id")), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def sets_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets in _frames(frames, n):
            yield pd.DataFrame({"set_id": [set_id(s) for s in sets], "grams": [s.view(np.int64) for s in sets]})

    # rows with equal ids may hold other texts, and rows with equal sets repeat
    sets = some.mapInPandas(sets_of, "set_id long, grams array<long>").join(wanted, "set_id", "left_semi").dropDuplicates(["set_id"])
    return stored(sets, "sets")


def _folded(sketches: np.ndarray, size: int) -> np.ndarray:
    while sketches.shape[1] > size:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def near_pairs(root: np.ndarray, size: np.ndarray, part: np.ndarray, sketch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of members with different roots, sizes that can link, and sketches near enough; with two parts only pairs across them."""
    across = part.min() != part.max()
    lengths = np.array([len(x) for x in sketch])
    kinds = np.unique(lengths)
    matrix = {k: np.frombuffer(b"".join(x for x in sketch if len(x) == k), np.uint64).reshape(-1, k // 8) for k in kinds.tolist()}
    rows = {k: np.flatnonzero(lengths == k) for k in kinds.tolist()}
    left, right = [], []
    for a, small in enumerate(kinds.tolist()):
        for large in kinds.tolist()[a:]:
            other, at = _folded(matrix[large], small // 8), rows[large]
            for i, mine in zip(rows[small].tolist(), matrix[small], strict=True):
                fit = root[at] != root[i]
                fit &= np.minimum(size[at], size[i]) * WHOLE >= np.maximum(size[at], size[i]) * SHARE
                if small == large:
                    fit &= at > i
                if across:
                    fit &= part[at] != part[i]
                if fit.any():
                    j = np.flatnonzero(fit)
                    gap = np.bitwise_count(other[j] ^ mine).sum(1, dtype=np.int64)
                    j = at[j[gap * (WHOLE + SHARE) <= (size[at[j]] + size[i]) * (WHOLE - SHARE)]]
                    left.append(np.full(len(j), i))
                    right.append(j)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(none + left), np.concatenate(none + right)


def _cells(members: DataFrame, by_size: DataFrame | None = None) -> DataFrame:
    """Members of blocks in which several components meet, dealt to pairs of parts of bounded size: ``(key, c1, c2, node, root, part)``.

    With ``(node, size)`` parts are bounded by their n-grams too.
    """
    cells = F.ceil(F.col("_n") / CELL)
    if by_size is not None:
        members = members.join(by_size, "node")
        cells = F.greatest(cells, F.ceil(F.col("_grams") / LINK_CELL_GRAMS))
    grams = F.lit(0) if by_size is None else F.sum("size")
    split = members.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b"), F.count(F.lit(1)).alias("_n"), grams.alias("_grams")).where(
        "_a <> _b").select("key", cells.cast("int").alias("_cells"))
    dealt = members.join(split, "key").withColumn("part", F.pmod(F.xxhash64("node"), "_cells").cast("int")).withColumn(
        "_with", F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)))
    return dealt.select("key", F.least("part", "_with").alias("c1"), F.greatest("part", "_with").alias("c2"), "node", "root", "part")


def apart_links(members: DataFrame, rows: DataFrame, known: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """``(u, v)`` links that join the components of members ``(key, node, root)`` of a block, and the ``(set_id, grams)`` they rest on.

    Sketches tell first which members may link with one of another component. The sets of those meet in cells again, where near pairs
    are verified until the members are joined as far as they can be: a cell sends on fewer links than it has members.
    """
    names = ["key", "c1", "c2"]
    own = known.groupBy("set_id").agg(F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch")).withColumnRenamed("set_id", "node")
    wide = members.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 2").select("key")  # of two the stars have tried the pair
    sketched = _cells(members.join(wide, "key", "left_semi")).join(own, "node")

    def hopeful(frame: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
        columns, sketches, hit = [frame[c].to_numpy() for c in ("root", "size", "part")], frame["sketch"].tolist(), np.zeros(len(frame), bool)
        for a, b in zip(cuts, cuts[1:], strict=False):
            for side in near_pairs(*(c[a:b] for c in columns), sketches[a:b]):
                hit[a + side] = True
        return frame.loc[hit, ["key", "node", "root"]]

    ordered = sketched.select(*names, "node", "root", "size", "part", "sketch").repartition(*names).sortWithinPartitions(*names)
    near = stored(ordered.mapInPandas(_by_groups(names, hopeful), "key long, node long, root long").distinct(), "hopeful")
    sets = whole_sets(near.select(F.col("node").alias("set_id")).distinct(), rows, known, n)
    again = _cells(near, own.select("node", "size")).join(own, "node").join(sets.withColumnRenamed("set_id", "node"), "node")

    def joined(frame: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
        links, columns = [], [frame[c].to_numpy() for c in ("root", "size", "part")]
        sketches, all_nodes, all_grams, all_roots = (frame[c].tolist() for c in ("sketch", "node", "grams", "root"))
        for a, b in zip(cuts, cuts[1:], strict=False):
            left, right = near_pairs(*(c[a:b] for c in columns), sketches[a:b])
            node, grams, roots = all_nodes[a:b], all_grams[a:b], all_roots[a:b]
            above = {r: r for r in roots}

            def top(x: int) -> int:
                while above[x] != x:
                    above[x] = x = above[above[x]]
                return x

            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                x, y = top(roots[i]), top(roots[j])
                if x != y:
                    shared = len(np.intersect1d(grams[i], grams[j], assume_unique=True))
                    if shared * WHOLE >= (len(grams[i]) + len(grams[j]) - shared) * SHARE:
                        above[max(x, y)] = min(x, y)
                        links.append((min(node[i], node[j]), max(node[i], node[j])))
        return pd.DataFrame(links, columns=["u", "v"], dtype=np.int64)

    met = again.select(*names, "node", "root", "size", "part", "sketch", "grams").repartition(*names).sortWithinPartitions(*names)
    return met.mapInPandas(_by_groups(names, joined), "u long, v long").distinct(), sets


def _by_groups(names: list[str], found):
    """Calls ``found(frame, cuts)`` with whole groups of neighbouring rows, whatever batches they come in."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            keys = frame[names].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            held = frame.iloc[cuts[-1]:] if len(cuts) else frame
            yield found(frame, [0, *cuts.tolist()])
        if held is not None:
            yield found(held, [0, len(held)])

    return run


def linked_copies(grams: list[np.ndarray], part: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """For each set the copies of all other sets that it links with; with two parts only across them."""
    order = np.lexsort(([len(g) for g in grams], part))
    grams, weight = [grams[i] for i in order.tolist()], copies[order]
    size = np.array([len(g) for g in grams], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    names, flat = np.unique(np.concatenate(grams), return_inverse=True)
    across = part.min() != part.max()
    second = int((part == part.min()).sum()) if across else len(grams)
    mine, counts = np.zeros(len(names), np.uint8), np.zeros(len(grams), np.int64)
    for i in range(second):
        if across:
            low = second + int(np.searchsorted(size[second:], -(-size[i] * SHARE // WHOLE)))
            high = second + int(np.searchsorted(size[second:], size[i] * WHOLE // SHARE, "right"))
        else:
            low, high = i + 1, int(np.searchsorted(size, size[i] * WHOLE // SHARE, "right"))
        if low >= high:
            continue
        own = flat[start[i]:start[i + 1]]
        mine[own] = 1
        shared = np.add.reduceat(mine[flat[start[low]:start[high]]], start[low:high] - start[low], dtype=np.int64)
        mine[own] = 0
        near = low + np.flatnonzero(shared * WHOLE >= (size[i] + size[low:high] - shared) * SHARE)
        counts[i] += weight[near].sum()
        counts[near] += weight[i]
    out = np.empty_like(counts)
    out[order] = counts
    return out


def link_counts(links: DataFrame, roots: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """``(set_id, n_links)``: how many other rows each row of a set links with, equal sets among them.

    Links stay within components. Where the verified links are all pairs of a component they are summed; the other components are cut
    into cells, so the work grows with the square of a component's sets and the rows don't.
    """
    own = settle(known.where("n_shingles > 0").groupBy("set_id").agg(F.first("n_shingles").alias("_size"), F.count(F.lit(1)).alias("copies")))
    nodes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).join(
        own.withColumnRenamed("set_id", "node"), "node")
    nodes = settle(nodes)
    pairs = links.join(nodes.select(F.col("node").alias("u"), "root"), "u").groupBy("root").agg(F.count(F.lit(1)).alias("_pairs"))
    shape = settle(nodes.groupBy("root").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_grams")).join(pairs, "root").select(
        "root", (F.col("_pairs") * 2 < F.col("_n") * (F.col("_n") - 1)).alias("_open"),
        F.greatest(F.ceil(F.col("_n") / LINK_CELL), F.ceil(F.col("_grams") / LINK_CELL_GRAMS)).cast("int").alias("_cells")))
    placed = nodes.join(shape, "root")
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    whole = placed.where("NOT _open").select(F.col("node").alias("v"), "copies").join(both, "v").select(F.col("u").alias("set_id"), "copies")
    cells = placed.where("_open").withColumn("part", F.pmod(F.xxhash64("node"), "_cells").cast("int")).withColumn(
        "_with", F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)))
    names = ["root", "c1", "c2"]
    cells = cells.select("root", F.least("part", "_with").alias("c1"), F.greatest("part", "_with").alias("c2"), "node", "part", "copies")
    rows = cells.join(sets.withColumnRenamed("set_id", "node"), "node").select(*names, "node", "part", "copies", "grams")

    def found(frame: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
        part, copies, grams = frame["part"].to_numpy(), frame["copies"].to_numpy(), frame["grams"].tolist()
        counts = [linked_copies(grams[a:b], part[a:b], copies[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pd.DataFrame({"set_id": frame["node"].to_numpy()[:cuts[-1]], "copies": np.concatenate([np.zeros(0, np.int64), *counts])})

    counted = rows.repartition(*names).sortWithinPartitions(*names).mapInPandas(_by_groups(names, found), "set_id long, copies long")
    others = whole.unionByName(counted).groupBy("set_id").agg(F.sum("copies").alias("_others"))
    return own.join(others, "set_id", "left").select(
        "set_id", (F.coalesce("_others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def _ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def link(docs: DataFrame, id_column: str = "doc_id", text: str = "text", n: int = WORDS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, set_id, n_links, root, row)`` for every row.

    Texts link when their n-gram sets have a similarity of at least three quarters; the component is the smallest ``doc_id`` reachable
    by links. ``n_links`` counts all other rows that a row links with, rows with an equal set among them. A null or empty text has no
    n-grams and links with nothing. A null id is never the smallest; a component of null ids has a null id. ``root`` names the
    component also where ids are null or repeat, and ``row`` is a hash of all columns. Extra columns are ignored. An empty table gives an
    empty result. Very long texts are read whole, one at a time. Runs jobs while the plan is built.
    """
    known, links, roots, sets = _joined_sets(docs, id_column, text, n)
    counts = link_counts(links, roots, sets, known)
    return _named(known, roots).join(counts, "set_id", "left").select(
        "doc_id", "n_shingles", "component_id", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "root", "row")


def _joined_sets(docs: DataFrame, id_column: str, text: str, n: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What is known of each row, links that join every component, its roots, and the whole sets of all members."""
    workers_import(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), row_hash(docs).alias("row"), F.col(text).alias("_t"))
    known = stored(identify(rows, n), "known")
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    shards = max(1, -(-total * 45 // 100 // SHARD_KEYS))
    table = docs.sparkSession.sparkContext.broadcast(frequency_table(rows, n, total))
    stars = stored(star_pairs(rows, n, table, shards), "stars")
    table.destroy()
    tried = settle(_ordered(stars, "center", "member"))
    links, sets = verified(tried, rows, known, n)
    links = settle(links)
    roots = settle(components(links))
    # blocks whose members are not all in one component yet
    members = stars.select("key", F.explode(F.array("center", "member")).alias("node")).distinct().join(roots, "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root"))
    more, others = apart_links(members, rows, known, n)
    more = settle(more)
    if not more.isEmpty():
        links = settle(links.unionByName(more))
        sets = sets.unionByName(others.join(sets.select("set_id"), "set_id", "left_anti"))
        roots = settle(components(links))
    return known, links, roots, sets


def _named(known: DataFrame, roots: DataFrame) -> DataFrame:
    """``known`` with ``component_id`` and ``root``."""
    per_set = known.groupBy("set_id").agg(F.min("doc_id").alias("_first")).join(
        roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = per_set.groupBy("root").agg(F.min("_first").alias("_least"))
    named = per_set.join(least, "root").select("set_id", "_least", "root")
    return known.join(named, "set_id").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(F.col("doc_id")).alias("component_id"),
        "set_id", F.when(F.col("n_shingles") > 0, F.col("root")).alias("root"), "row")


def _holds_map(kind: DataType) -> bool:
    inner = [f.dataType for f in kind.fields] if isinstance(kind, StructType) else [kind.elementType] if isinstance(kind, ArrayType) else []
    return isinstance(kind, MapType) or any(map(_holds_map, inner))


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns. Maps are hashed as their JSON, entries in their order; names are hashed with it, so no column is lost."""
    columns = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if _holds_map(f.dataType) else F.col(f"`{f.name}`") for f in docs.schema.fields]
    return F.xxhash64(*columns)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", n: int = WORDS) -> DataFrame:
    """The row with the smallest id of each component, and every row without words; all columns stay. Of equal rows one stays.

    Rows are told apart by a 64-bit hash of all columns, whatever their names and kinds. A null id is never the smallest while another is
    there. An empty table stays empty; very long texts are read whole, one at a time.
    """
    known, _, roots, _ = _joined_sets(docs, id_column, text, n)
    linked = _named(known, roots)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row")
    best = linked.where("root IS NOT NULL").groupBy("root").agg(first).select("row").unionByName(
        linked.where("root IS NULL").select("row"))
    times = linked.where("root IS NOT NULL").groupBy("row").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    best = settle(best.distinct().join(times, "row", "left"))
    whole = docs.select(row_hash(docs).alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"))
    marked = whole.join(small_enough(best), "row")
    once = marked.where("times IS NULL").unionByName(marked.where("times IS NOT NULL").dropDuplicates(["row"]))
    return once.select("all.*")

"""Near copies, repeated passages and benchmark passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.data import SF, no_docs, odd_docs, planted
from wattloom.llm import decontaminate, ngram_join, suffix_dedup
from wattloom.llm.components import components


def shingles(text, n=5):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sets, {i: min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(rows))}


def test_link_equals_brute_force(spark):
    rows = planted()
    sets, want = brute_components(rows)
    got = {r["doc_id"]: r for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, (doc, _) in enumerate(rows):
        assert (got[doc]["n_shingles"], got[doc]["component_id"]) == (len(sets[i]), want[i])
    assert len(set(want.values())) < len(rows) - 10


def brute_links(rows):
    sets = [shingles(t) for _, t in rows]
    return {d: sum(i != j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0 for j in range(len(rows)))
            for i, (d, _) in enumerate(rows)}


@pytest.mark.parametrize("cell", [500, 4])
def test_all_links_are_counted(spark, monkeypatch, cell):
    """Groups of like texts with copies: every pair counts, also within a component and over cells."""
    monkeypatch.setattr(ngram_join, "LINK_CELL", cell)
    rows = planted(7, 5)
    base = [f"k{i}" for i in range(90)]
    rows += [(1000 + i, " ".join([*base[:i], f"x{i}", *base[i + 1:]])) for i in range(25)]
    rows += [(2000 + i, t) for i, (_, t) in enumerate(rows[-3:] * 2)] + [(3000, None), (3001, "")]
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_links(rows)
    assert max(got.values()) > 20


def test_link_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _, want = brute_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link(docs).collect()}
    assert got == {rows[i][0]: c for i, c in want.items()}


def test_link_near_the_threshold():
    """Pairs at and just under three quarters, of all sizes, share a chosen block exactly when they must."""
    rng = np.random.default_rng(1)
    table = np.zeros(1 << ngram_join.SLOT_BITS, np.uint8)
    for _ in range(300):
        union = int(rng.integers(4, 900))
        shared = -(-union * 75 // 100)
        pool = rng.permutation(np.unique(rng.integers(0, 2**64 - 1, union, np.uint64)))
        left = int(rng.integers(0, union - shared + 1))
        a, b = np.sort(pool[:shared + left]), np.sort(np.concatenate([pool[:shared], pool[shared + left:]]))
        assert len(np.intersect1d(ngram_join.chosen_keys(a, table), ngram_join.chosen_keys(b, table)))
        gap = ngram_join.sketch_distance(ngram_join.bit_sketch(a), ngram_join.bit_sketch(b))
        assert gap <= len(np.setxor1d(a, b))


def test_hot_group_in_unlike_parts(spark):
    """A chain of texts in one block group: neighbours link, ends don't, and none may be lost."""
    words = [f"k{i}" for i in range(80)]
    rows = []
    for i in range(12):
        text = list(words)
        for k in range(3 * i):
            text[(7 * k) % 80] = f"z{k}"
        rows.append((i, " ".join(text)))
    _, want = brute_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {rows[i][0]: c for i, c in want.items()}


def test_link_odd_rows(spark):
    rows = ngram_join.link(odd_docs(spark)).collect()
    assert len(rows) == odd_docs(spark).count()
    plain = [r for r in rows if r["n_shingles"] == 12]
    assert len(plain) == 5 and {r["component_id"] for r in plain} == {5}
    assert {r["doc_id"]: r["component_id"] for r in rows if r["n_shingles"] == 0} == {1: 1, 2: 2, 3: 3, None: None}
    assert ngram_join.link(no_docs(spark)).count() == 0


def test_keep_one(spark):
    kept = ngram_join.keep_one(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.select("doc_id").collect())
    # the plain text, its copies, its null id and its upper-case form are one group; rows without words all stay
    assert [i for n, i in ids if not n] == [1, 2, 3, 4, 5, 7, 8, 2**60 + 1]
    assert sum(n for n, _ in ids) == 1
    assert ngram_join.keep_one(no_docs(spark)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    root = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: r for n, r in root.items() if n != r}


def brute_removed(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for i, r in enumerate(raw):
        for p in range(len(r) - length + 1):
            seen.setdefault(r[p:p + length], []).append((i, p))
    gone = [np.zeros(len(r), bool) for r in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p:p + length] = True
    out = []
    for r, g in zip(raw, gone, strict=True):
        kept = bytes(b for b, x in zip(r, g, strict=True) if not x)
        out.append((len(r), int(g.sum()), int((np.diff(np.concatenate([[False], g]).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rows = planted(seed, 8)
    rng = random.Random(seed)
    rows += [(1000, "ab" * 700), (1001, "".join(rng.choice("ab") for _ in range(1500))), (1002, rows[0][1]), (1003, "é" * 500)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[d] for d, _ in rows] == brute_removed(rows, suffix_dedup.LENGTH)


def test_repeats_of_one_word_without_end(spark, monkeypatch):
    """Every period of such a text begins a run of the same gram, core and context."""
    monkeypatch.setattr(suffix_dedup, "HOT", 5)
    rows = [(i, "line of text. " * n) for i, n in enumerate((40, 60, 61, 90, 90))] + [(10, "x" * 1200), (11, "y" + "x" * 900)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[d] for d, _ in rows] == brute_removed(rows, suffix_dedup.LENGTH)


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_rows_of_a_hot_key_stay_spread(spark, monkeypatch, how):
    monkeypatch.setattr(suffix_dedup, "HOT", 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.range(0, 4000, 1, 8).selectExpr("id", "IF(id % 10 > 0, 7, id % 1000) AS key")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        values = suffix_dedup.repeated(rows, "key")
        met = suffix_dedup.meet(rows, values, "key", how)
        largest = max(met.rdd.glom().map(len).collect())
        assert met.columns == rows.join(values, "key", how).columns
        assert sorted(met.collect()) == sorted(rows.join(values, "key", how).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert largest <= 500


def test_repeats_odd_rows(spark):
    got = suffix_dedup.remove_repeats(odd_docs(spark)).collect()
    assert len(got) == odd_docs(spark).count()
    assert all(r["n_removed"] == 0 for r in got if r["n_bytes"] < suffix_dedup.LENGTH)
    assert suffix_dedup.remove_repeats(no_docs(spark)).count() == 0


def test_edit_distance_to_a_part():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item, region = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 14))

        def distance(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a):
                last, row = row, [i + 1]
                for j, y in enumerate(b):
                    row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
            return row[-1]

        want = min(distance(item, region[i:j]) for i in range(len(region) + 1) for j in range(i, len(region) + 1))
        assert decontaminate.edits(item, region)[0] == want


def brute_items(texts, items, most=decontaminate.MOST_EDITS):
    found = set()
    for d, t in texts:
        words = decontaminate.word_hashes(decontaminate.ascii_words(t))
        for i, q in items:
            item = decontaminate.word_hashes(decontaminate.ascii_words(q))
            if len(item) and len(words) and decontaminate.edits(item, words)[0] <= int(most * len(item)):
                found.add((d, i))
    return found


def test_items_with_edits(spark):
    rng = random.Random(4)
    given = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    vocabulary = " ".join(t for _, t in given).split()
    docs, verbatim = [], set()
    for k, (i, text) in enumerate(given):
        words = text.split()
        for _ in range(k % 4 * len(words) // 30):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if words == text.split():
            verbatim.add((k, i))
        docs.append((k, " ".join([*rng.choices(vocabulary, k=50), *words, *rng.choices(vocabulary, k=30)])))
    docs += [(500, given[0][1]), (501, " ".join(rng.choices(vocabulary, k=300)))]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(given, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(*frames).collect()}
    want = brute_items(docs, given)
    assert verbatim | {(500, given[0][0])} <= got <= want
    assert len(got) >= 0.95 * len(want)
    clean = {r["doc_id"] for r in decontaminate.without_items(*frames).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in got}


def edited(words, edits, rng):
    """So many words changed, dropped or put in."""
    out = list(words)
    for place in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.randrange(3)
        out[place:place + 1] = [[f"n{rng.random()}"], [], [out[place], f"n{rng.random()}"]][kind]
    return out


@pytest.mark.parametrize("size", [1, 4, 5, 9, 10, 15, 17, 20, 33, 40, 64, 80, 129])
def test_no_item_is_missed_at_the_full_edits(size):
    rng = random.Random(size)
    texts = [[f"w{i}_{k}" for k in range(size)] for i in range(60)]
    items = decontaminate.Items([" ".join(t) for t in texts])
    docs = []
    for i, words in enumerate(texts):
        around = [[f"a{rng.random()}" for _ in range(rng.choice([0, 30]))] for _ in range(2)]
        docs.append(" ".join([*around[0], *edited(words, int(0.2 * size), rng), *around[1]]))
    got = {(o, i) for o, i, *_ in items.matches(docs)}
    assert got == {(i, i) for i in range(len(texts))}


@pytest.mark.parametrize("size", [16, 33, 80, 300])
def test_walks_agree_over_item_sized_windows(size):
    """Copies agree in every sample, also where only some starts walk far; texts of other words agree in none."""
    words = [f"w{k}" for k in range(size)]
    items = decontaminate.Items([" ".join(words)])
    steps = decontaminate.walk_steps(size)
    assert size < steps <= 2 * size
    before = [f"b{k}" for k in range(37)]
    item, place, hit = items.candidates(decontaminate.word_hashes(decontaminate.ascii_words(" ".join(before + words))))
    assert set(item.tolist()) == {0}
    at = hit[place == 37]  # walks from neighbouring words can meet, so other places come up too
    assert len(set(at.tolist())) >= size - 4
    assert not len(items.candidates(decontaminate.word_hashes([w.encode() for w in before * 20]))[0])


def test_close_windows_have_close_walks():
    """The embedding keeps order: fewer edits, fewer steps that differ."""
    rng = random.Random(9)
    differ = {0: 0, 1: 0, 4: 0, 60: 0}
    for _ in range(100):
        words = [f"{rng.random()}" for _ in range(60)]
        for n in differ:
            both = [decontaminate.word_hashes([w.encode() for w in x] + [b"end"] * 140) for x in (words, edited(words, n, rng))]
            places = [next(decontaminate.walk_keys(b, decontaminate.word_signs(b), np.zeros(1, np.int64), 0, [64], True))[3] for b in both]
            differ[n] += int((both[0][places[0]] != both[1][places[1]]).sum())
    assert differ[0] == 0 < differ[1] < differ[4] < differ[60]


def test_items_odd_rows(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "lazy dog"), (3, "lazy dog"), (None, "one")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(odd_docs(spark), items).collect()}
    assert found == {(5, 3), (6, 3), (None, 3), (9, 3), (4, None)}
    assert decontaminate.without_items(odd_docs(spark), items).count() == odd_docs(spark).count() - 6
    assert decontaminate.find_items(no_docs(spark), items).count() == 0
    assert decontaminate.find_items(odd_docs(spark), items.limit(0)).count() == 0


def test_keep_one_takes_any_columns(spark):
    """Columns of any name and kind stay as they are: those that helpers use too, and maps, alone or inside others."""
    text = "one two three four five six seven eight nine ten"
    rows = [(i, text if i < 4 else f"{text} {i}" * 3, i, i * 2, -i, "x", {"a": i % 2}, [{"k": i}], (i, {"z": 1})) for i in (1, 2, 2, 3, 7, 8)]
    schema = ("doc_id long, text string, row int, times long, all int, _times string, m map<string,int>, a array<map<string,int>>, "
              "s struct<n:int,m:map<string,int>>, _row_hash int")
    df = spark.createDataFrame([(*r, 5) for r in rows], schema)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["row"], r["times"], r["all"], r["_times"], r["m"], r["a"], r["_row_hash"]) for r in kept.collect()) == [
        (i, i, i * 2, -i, "x", {"a": i % 2}, [{"k": i}], 5) for i in (1, 7, 8)]
    assert ngram_join.link(df).count() == 6


def test_pairs_do_not_depend_on_shards(spark):
    docs = [(i, " ".join(f"w{(i % 90 * 7 + k * k) % 911}" for k in range(60 + i // 90))) for i in range(300)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "doc_id AS row", "text AS _t")
    found = []
    for shards in (1, 8, 2048):
        table = spark.sparkContext.broadcast(np.zeros(1 << ngram_join.LEAST_SLOT_BITS, np.uint8))
        found.append(sorted(map(tuple, ngram_join.star_pairs(rows, 5, table, shards).select("center", "member").distinct().collect())))
        table.destroy()
    assert found[0] == found[1] == found[2] and found[0]

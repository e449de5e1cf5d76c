"""Hard negatives by Fagin's threshold algorithm.

Rows are dealt into blocks, anchors into smaller ones, and every block of rows meets every block of anchors: the anchors are a stated
query set. In a block each dimension has a list of its rows sorted by that component. An anchor reads the lists from the end that its own
sign favours, scores each row when it is first met in any list, and stops when the best score that an unread row could have, the sum
over dimensions of the anchor's component times the component reached, is strictly below the kth score of every window. As it is strictly
below, rows with equal scores have all been read, and ties are broken by id. Each block keeps its first k; the first k of all blocks are
ranked afterwards.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.llm.common import stored, workers_import

SCALE = 256
ROW_BLOCK, ANCHOR_BLOCK = 4096, 4096
#: Components of a block of rows, so that long vectors make smaller blocks.
BLOCK_COMPONENTS = 1 << 20
FIRST_DEPTH = 16


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) for each component, as integers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """True for a vector whose components are all finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


class Lists:
    """The rows of one block, with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.most = int(np.abs(vectors).max(initial=0))
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.exact: dict[str, np.ndarray] = {}

    def _numbers(self, anchor: np.ndarray) -> np.ndarray:
        """The vectors in the shortest type in which every sum of products with the anchor is exact."""
        bound = self.most * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor))
        if bound >= 1 << 63:
            raise ValueError("scores exceed 64 bits")
        kind = "f4" if bound < 1 << 24 else "f8" if bound < 1 << 53 else "i8"
        if kind not in self.exact:
            self.exact[kind] = self.vectors.astype(kind)
        return self.exact[kind]

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Rounds of ``(rows met first in this round, their scores, best score of rows not met yet)``; None after the last round."""
        numbers = self._numbers(anchor)
        query = anchor.astype(numbers.dtype)
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        used = np.concatenate([up, down])
        met, depth, step = np.zeros(n, bool), 0, FIRST_DEPTH
        while depth < n:
            to = min(n, depth + step) if len(used) else n  # an anchor of zeros has no list to read
            here = np.zeros(n, bool)
            here[self.order[up, n - to:n - depth].ravel()] = True
            here[self.order[down, depth:to].ravel()] = True
            if to == n:
                here[:] = True
            new = np.flatnonzero(here & ~met)
            met[new] = True
            # many rows are scored faster in place than picked out first
            scores = (numbers @ query)[new] if 4 * len(new) > n else numbers[new] @ query
            best = None
            if to < n:
                reached = np.concatenate([self.vectors[self.order[up, n - to], up], self.vectors[self.order[down, to - 1], down]])
                best = int(reached @ anchor[used])
            yield new, scores.astype(np.int64), best
            depth, step = to, step * 2


def first_k(lists: Lists, anchor: np.ndarray, eligible: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[np.ndarray]:
    """For each window of scores, both ends included, the first k eligible rows: higher scores first, ties by smaller id."""
    kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
    for new, scores, best in lists.read(anchor):
        open_windows = False
        fits = eligible[new]
        new, scores = new[fits], scores[fits]
        for i, (low, high) in enumerate(windows):
            inside = np.ones(len(new), bool)
            if low is not None:
                inside &= scores >= low
            if high is not None:
                inside &= scores <= high
            rows = np.concatenate([kept[i][0], new[inside]])
            values = np.concatenate([kept[i][1], scores[inside]])
            first = np.lexsort((lists.ids[rows], -values))[:k]
            kept[i] = (rows[first], values[first])
            kth = int(kept[i][1][-1]) if len(first) == k else low
            open_windows |= best is not None and (kth is None or best >= kth)
        if not open_windows:
            break
    return [np.stack([lists.ids[rows], values]) for rows, values in kept]


def _block(frame: pd.DataFrame, vector: str) -> np.ndarray:
    """Vectors of a group as a matrix; shorter ones end in zeros."""
    given = frame[vector].tolist()
    wide = max((len(v) for v in given), default=0)
    out = np.zeros((len(given), wide), np.int64)
    for i, v in enumerate(given):
        out[i, :len(v)] = v
    return out


def _met(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, run, schema: str) -> DataFrame:
    """``run(rows, anchors)`` for each block of rows with each block of anchors."""
    left = rows.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    right = anchors.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(run, schema)


def mine(rows: DataFrame, anchor: Column | None = None, positives: int = 5, negatives: int = 5, least_percent: int = 80,
         scale: int = SCALE, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for each anchor and positive its hard negatives.

    Scores are inner products of ``floor(scale * component)``; more first, ties by smaller id. An anchor's positives are its first
    ``positives`` other rows of its label. Their negatives are the first ``negatives`` rows of other labels with
    ``least_percent * positive_score <= 100 * negative_score <= 100 * positive_score``; all, if there are fewer. ``anchor`` is a condition on
    the id column; without it ids divisible by 100 are anchors.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no part. Of rows that share an id the
    one with the smallest label, then vector, takes part. A shorter vector counts as ending in zeros; long vectors make smaller blocks.
    Rows of equal vectors and different ids are rows of their own. Empty tables, and anchors without positives, give nothing. Extra columns
    are ignored. Labels are whole numbers. Scores beyond 64 bits fail. Runs jobs while the plan is built.
    """
    spark = rows.sparkSession
    workers_import(spark)
    named = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    named = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    whole = named.select("id", "label", quantized(F.col("v"), scale).alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("s"))
    whole = stored(whole.select("id", "s.label", "s.v"), "vectors")
    chosen = whole.where(F.pmod("id", F.lit(100)) == 0 if anchor is None else anchor)
    n, wide = whole.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    row_block = max(1, min(ROW_BLOCK, BLOCK_COMPONENTS // max(1, wide or 1)))
    row_blocks, anchor_blocks = -(-max(n, 1) // row_block), -(-max(chosen.count(), 1) // min(ANCHOR_BLOCK, 16 * row_block))
    dealt = whole.withColumn("a", F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int"))
    asked = chosen.select(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(anchor_blocks)).cast("int").alias("b"), F.col("id").alias("anchor"),
                          F.col("label").alias("own"), F.col("v").alias("q"))

    def block(rows: pd.DataFrame, anchors: pd.DataFrame) -> tuple[Lists, np.ndarray]:
        vectors, queries = _block(rows, "v"), _block(anchors, "q")
        wide = max(vectors.shape[1], queries.shape[1])
        vectors, queries = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (vectors, queries))
        return Lists(rows["id"].to_numpy(), rows["label"].to_numpy(), vectors), queries

    def same_label(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((3, 0), np.int64)]
        if len(rows) and len(anchors):
            lists, queries = block(rows, anchors)
            for anchor, own, q in zip(anchors["anchor"].tolist(), anchors["own"].tolist(), queries, strict=True):
                found, = first_k(lists, q, (lists.labels == own) & (lists.ids != anchor), [(None, None)], positives)
                out.append(np.stack([np.full(found.shape[1], anchor), *found]))
        return pd.DataFrame(np.concatenate(out, axis=1).T, columns=["anchor", "id", "score"])

    def other_labels(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((4, 0), np.int64)]
        if len(rows) and len(anchors):
            lists, queries = block(rows, anchors)
            for anchor, own, scores, q in zip(anchors["anchor"].tolist(), anchors["own"].tolist(), anchors["scores"].tolist(), queries,
                                              strict=True):
                scores = [int(s) for s in scores]
                windows = [(-(-least_percent * s // 100), s) for s in scores]
                for s, found in zip(scores, first_k(lists, q, lists.labels != own, windows, negatives), strict=True):
                    m = found.shape[1]
                    out.append(np.stack([np.full(m, anchor), np.full(m, s), *found]))
        return pd.DataFrame(np.concatenate(out, axis=1).T, columns=["anchor", "score", "negative", "negative_score"])

    near = _met(dealt, asked, row_blocks, anchor_blocks, same_label, "anchor long, id long, score long")
    by_score = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = stored(near.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= positives).drop("rank"), "positives")
    wanted = near.groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("scores"))  # at most ``positives`` of each anchor
    far = _met(dealt, asked.join(wanted, "anchor"), row_blocks, anchor_blocks, other_labels,
               "anchor long, score long, negative long, negative_score long")
    in_window = Window.partitionBy("anchor", "score").orderBy(F.desc("negative_score"), "negative")
    far = far.withColumn("rank", F.row_number().over(in_window)).where(F.col("rank") <= negatives)
    return near.join(far, ["anchor", "score"]).select(
        F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("rank"), F.col("negative").alias("negative_id"),
        F.col("score").alias("positive_score"), "negative_score")


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """The table with a label of another class for every seventh id."""
    return vectors.withColumn("label", F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def mine_sql(embeddings: str = "embeddings") -> str:
    """The same result over ``shifted_labels`` in DuckDB SQL, by all scores of the anchors."""
    return f"""
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v
  FROM {embeddings} WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, a.label = e.label AS same, e.id,
             CAST(coalesce(list_sum(list_transform(list_zip(a.v, e.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
      FROM e a JOIN e ON a.id <> e.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5"""

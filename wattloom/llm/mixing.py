"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 48-bit hash. A source's budget of words is a number of whole passes over the source and a remainder; the
remainder is met by the documents whose hash is below a threshold. The threshold is found without sorting documents: words are
summed by source and the first 16 bits of the hash, the bucket in which the budget ends is summed by the next 16 bits, and that one
by the last 16. Documents that share the threshold's whole hash each give the same part of their words, so the mix meets each
target to less than a word for each of them. As thresholds only grow with the budget, a larger budget takes what a smaller one took.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.llm.common import settle, small_enough, words

WEIGHTS = (5.0, 2.0, 1.0)
LEVELS = 3
BITS = 16
HASH_DIGITS = LEVELS * BITS // 4


def hash48(key: Column) -> Column:
    """The first 48 bits of the MD5 of a key's text; null counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def _bucket(level: int) -> Column:
    return F.shiftright(F.col("_h"), BITS * (LEVELS - 1 - level)).bitwiseAND((1 << BITS) - 1)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, target)``.

    Weights are dealt to sources by code point, null last, and repeat. ``share`` of all sizes is divided by weight; no source gets
    over ``most`` times its size, and the excess goes to the others by weight. This is a water level: with sources in order of
    cap / weight, those before some point get their cap, and the others their weight times one level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    up_to, everything = by_fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("_w", weight).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    ranked = ranked.withColumn("_fill", F.col("_cap") / F.col("_w"))
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    levels = ranked.select(
        "*", (total - F.coalesce(F.sum("_cap").over(up_to), F.lit(0.0))).alias("_left"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(up_to), F.lit(0.0))).alias("_rest"))
    level = F.min(F.when(F.col("_left") / F.col("_rest") <= F.col("_fill"), F.struct("_fill", (F.col("_left") / F.col("_rest")).alias("l")))
                  ).over(everything)["l"]
    return levels.withColumn("_level", level).select(
        "source", "source_size", F.least("_cap", F.coalesce(F.col("_w") * F.col("_level"), "_cap")).alias("target"))


def mix(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, whole_rows: bool = False,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row; with ``whole_rows`` all columns of ``docs`` and the last four.

    ``taken`` counts the words that the mix takes from a row, repeats counted. A null text has size 0 and gives nothing; a null
    source is a source of its own; a null id hashes as the empty text. Rows with equal ids share a hash and are treated alike.
    Extra columns are ignored, and give way where they clash; an empty table gives an empty result. Reruns agree, as nothing depends on row order.
    """
    named = (F.col(id_column).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"),
             hash48(F.col(id_column)).alias("_h"))
    rows = settle(docs.select(*named))
    same = F.col("source").eqNullSafe(F.col("b_source"))
    totals = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = settle(totals.withColumn("_full", full).select(
        F.col("source").alias("b_source"), "source_size", "target", "_full",
        (F.floor("target") - F.col("_full") * F.col("source_size")).alias("_left"), F.lit(0).cast("long").alias("_path")))

    for level in range(LEVELS):
        shift = BITS * (LEVELS - level)
        inside = rows.join(small_enough(budget.select("b_source", "_path")),
                           same & (F.shiftright("_h", shift) == F.col("_path")))
        sums = inside.groupBy("b_source", _bucket(level).alias("_b")).agg(F.sum("size").alias("_words"))
        before = F.sum("_words").over(Window.partitionBy("b_source").orderBy("_b")) - F.col("_words")
        marked = sums.withColumn("_before", before).alias("m").join(
            budget.select(F.col("b_source").alias("_s"), "_left"), F.col("b_source").eqNullSafe(F.col("_s")))
        edge = marked.where((F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_words"))).select(
            F.col("_s").alias("e_source"), "_b", "_before", "_words")
        # without a bucket in which it ends, the budget covers all or nothing of the source
        budget = settle(budget.join(edge, F.col("b_source").eqNullSafe(F.col("e_source")), "left").select(
            "b_source", "source_size", "target", "_full", (F.col("_left") - F.coalesce("_before", F.lit(0))).alias("_left"),
            (F.col("_path") * (1 << BITS) + F.coalesce("_b", F.lit(0))).alias("_path"), F.coalesce("_words", F.lit(0)).alias("_leaf")))

    part = (F.when(F.col("_h") < F.col("_path"), F.col("size"))
            .when((F.col("_h") == F.col("_path")) & (F.col("_leaf") > 0), F.floor(F.col("size") * F.col("_left") / F.col("_leaf")))
            .otherwise(0))
    if whole_rows:
        own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
        rows = docs.select(F.struct(*own).alias("_row"), *named)
        given = [F.col("_row")[c].alias(c) for c in own]
        return rows.join(small_enough(budget), same).select(
            *given, "size", "source_size", "target", (F.col("_full") * F.col("size") + part).cast("long").alias("taken"))
    return rows.join(small_enough(budget), same).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("_full") * F.col("size") + part).cast("long").alias("taken"))


def mix_sql(documents: str = "documents") -> str:
    """The same result in DuckDB SQL with sorted running sums, for three weights of 5, 2, 1, a share of 150 % and caps of 200 %."""
    return f"""
WITH r AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HASH_DIGITS}) AS BIGINT) AS h
  FROM {documents}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w,
             2.0::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, cap / w AS fill FROM w),
l AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS lft, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest
      FROM f WINDOW o AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT arg_min(lft / rest, fill) AS lvl FROM l WHERE lft / rest <= fill),
t AS (SELECT source, source_size, least(cap, coalesce(w * lvl, cap)) AS target FROM l, v),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS fl FROM t),
c AS (SELECT *, CAST(floor(target) AS BIGINT) - fl * source_size AS budget FROM b),
h AS (SELECT source, h, CAST(sum(size) AS BIGINT) AS leaf FROM r GROUP BY source, h),
p AS (SELECT *, CAST(sum(leaf) OVER (PARTITION BY source ORDER BY h) AS BIGINT) - leaf AS before FROM h)
SELECT r.doc_id, r.size, c.source_size, c.target,
       CAST(c.fl * r.size + CASE WHEN p.before + p.leaf <= c.budget THEN r.size WHEN p.before < c.budget
            THEN CAST(floor(CAST(r.size * (c.budget - p.before) AS DOUBLE) / p.leaf) AS BIGINT) ELSE 0 END AS BIGINT) AS taken
FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source
JOIN p ON r.source IS NOT DISTINCT FROM p.source AND r.h = p.h"""

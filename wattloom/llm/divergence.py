"""How far the sources of each language differ in their words.

Equal texts of a language are collapsed first: one row for each text with its multiplicity in every source, so that each text is cut into
terms once. A text adds its term counts and one document for each of its terms, times the multiplicity, to all its sources; a task
sums before anything is shuffled. Of a pair of sources only terms that both have are visited: with c(p, q) = floor((p - q)^2 / q),
p0 and q0 the shares of a term without occurrences, and V kept terms,

    sum of c(p, q) = V c(p0, q0) + sum over g's terms of (c(p, q0) - c(p0, q0)) + sum over s's terms of (c(p0, q) - c(p0, q0))
                     + sum over common terms of (c(p, q) - c(p, q0) - c(p0, q) + c(p0, q0)).

The sums over one source's terms only depend on how often each count occurs, so they are taken over the distinct counts.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattloom.llm.common import small_enough, stored, workers_import

SHARE = 1_000_000_000
LEAST_DOCS = 3
RANKS = 200
#: Texts with copies whose digests may be broadcast, with a few sources each.
COPIED_TEXTS = 200_000
#: Sums that a task holds before it hands them on, and counts in a block of terms.
HELD_SUMS, BLOCK_COUNTS = 300_000, 200_000
#: Bytes as they are read: A-Z in lower case, other ASCII characters that are no letters as blanks.
READ_AS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def collapsed(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``(lang, text, sources)``: each text of a language once, with ``(source, n)`` of the documents that have it.

    Copies are counted by the SHA-256 of their text. Only texts that have copies are shuffled, each once by every task.
    """
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    named = named.withColumn("digest", F.unhex(F.sha2("text", 256)))
    times = named.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = times.groupBy("lang", "digest").agg(F.sum("n").alias("_n"), F.collect_list(F.struct("source", "n")).alias("sources"))  # one entry a source
    copies = stored(copies.where("_n > 1").drop("_n"), "copies")
    marked = named.join(small_enough(copies, COPIED_TEXTS), ["lang", "digest"], "left")
    alone = marked.where("sources IS NULL").select("lang", "text", F.array(F.struct("source", F.lit(1).cast("long").alias("n"))).alias("sources"))
    shared = marked.where("sources IS NOT NULL").select("lang", "digest", "text").dropDuplicates(["lang", "digest"]).join(copies, ["lang", "digest"])
    return alone.unionByName(shared.select("lang", "text", "sources"))


def term_sums(texts: DataFrame) -> DataFrame:
    """``(lang, source, term, count, docs)`` of collapsed texts, summed within tasks: occurrences, and documents that have the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(Counter)
        found: dict = defaultdict(Counter)

        def hand_on() -> pa.RecordBatch:
            keys = [(key, term) for key, terms in counts.items() for term in terms]
            out = pa.RecordBatch.from_arrays([
                pa.array([k[0] for k, _ in keys], pa.string()), pa.array([k[1] for k, _ in keys], pa.string()),
                pa.array([t.decode() for _, t in keys], pa.string()),
                pa.array([n for terms in counts.values() for n in terms.values()], pa.int64()),
                pa.array([found[key][term] for key, term in keys], pa.int64())], ["lang", "source", "term", "count", "docs"])
            counts.clear()
            found.clear()
            return out

        held = 0
        for batch in batches:
            columns = [batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()]
            for lang, text, sources in zip(*columns, strict=True):
                terms = Counter(text.translate(READ_AS).split())
                for given in sources:
                    key, n = (lang, given["source"]), given["n"]
                    own, docs = counts[key], found[key]
                    held -= len(own)
                    if n == 1:
                        own.update(terms)
                        docs.update(terms.keys())
                    else:
                        own.update({t: c * n for t, c in terms.items()})
                        docs.update(dict.fromkeys(terms, n))
                    held += len(own)
                if held > HELD_SUMS:
                    yield hand_on()
                    held = 0
        yield hand_on()

    return texts.mapInArrow(run, "lang string, source string, term string, count long, docs long")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)), exact."""
    above = (count + 1).cast("decimal(19,0)") * F.lit(SHARE).cast("decimal(10,0)")
    return F.call_function("div", above, (total + terms).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most 10^9 + 1, so the square fits in 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every occurring pair of language and source.

    Terms are runs of letters A-Z, read in lower case, and of characters beyond ASCII. A language keeps the terms that at least
    ``least_docs`` of its documents have. A group's share of a kept term is 1 + floor(10^9 (count + 1) / (N + V)): N sums its counts of
    kept terms, V is the number of them. Part ``pair`` has each other source of the language and the sum of floor((p - q)^2 / q) over all
    kept terms, 0 without any. Part ``term`` has the group's own terms whose share is above the language's, against which the same is
    taken, the first ``ranks`` of them. Higher values rank first, ties by the item's UTF-8 bytes.

    A null text, language or source counts as empty; empty texts are documents without terms. Repeated rows are documents of their own,
    ids are not read, and no order matters. A very long text is cut into terms whole, in one task. Extra columns are ignored, and an
    empty table gives an empty result. Runs jobs while the plan is built.
    """
    spark = docs.sparkSession
    workers_import(spark)
    groups = stored(docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                                F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct(), "groups")
    # one shuffle by term serves its sums in every source and in the language
    parts = term_sums(collapsed(docs, text, lang, source)).repartition("lang", "term")
    sums = parts.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    terms = sums.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("lang_count"), F.collect_list(F.struct("source", "count")).alias("own"))
    terms = stored(terms.where(F.col("docs") >= least_docs).drop("docs"), "terms")
    counts = terms.select("lang", "term", "lang_count", F.inline("own"))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_n"))
    own = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("long")
    sized = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"), F.coalesce("lang_n", zero).alias("lang_n"))
    sized = stored(sized.withColumn("p0", F.when(F.col("v") > 0, share(zero, F.col("n"), F.col("v")))), "groups")

    shares = counts.join(small_enough(sized, 200_000), ["lang", "source"])
    p, q = share(F.col("count"), F.col("n"), F.col("v")), share(F.col("lang_count"), F.col("lang_n"), F.col("v"))
    above = shares.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term_part = above.select("lang", "source", F.lit("term").alias("part"), "item", gap(F.col("p"), F.col("q")).alias("value")).withColumn(
        "rank", F.row_number().over(by_value)).where(F.col("rank") <= ranks)

    pairs = pair_values(shares.select("lang", "source", "term", p.alias("p"), "p0"), sized)
    pair_part = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by_value))
    return pair_part.unionByName(term_part)


def pair_values(shares: DataFrame, sized: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for each ordered pair of a language's sources, from the shares of terms that they have."""
    total = shares.count()
    blocks = max(1, -(-total // BLOCK_COUNTS))

    def common(block: pd.DataFrame) -> pd.DataFrame:
        names, source = np.unique(block["source"].to_numpy(object).astype(str), return_inverse=True)
        _, term = np.unique(block["term"].to_numpy(object).astype(str), return_inverse=True)
        order = np.lexsort((source, term))
        source, term = source[order], term[order]
        p, p0 = block["p"].to_numpy()[order], block["p0"].to_numpy()[order]
        first = np.searchsorted(term, np.arange(term.max() + 1))
        size = np.bincount(term)
        out = []
        for g in range(len(names)):
            mine = np.flatnonzero(source == g)
            reach = size[term[mine]]
            # every entry of every term that this source has
            at = np.repeat(first[term[mine]] - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())
            pg, q, q0, pg0 = np.repeat(p[mine], reach), p[at], p0[at], p0[mine[0]]
            sums = np.zeros(len(names), np.int64)
            np.add.at(sums, source[at], _gaps(pg, q) - _gaps(pg, q0) - _gaps(pg0, q) + _gaps(pg0, q0))
            others = np.setdiff1d(np.unique(source[at]), [g])
            out.append(pd.DataFrame({"source": names[g], "item": names[others], "value": sums[others]}))
        frame = pd.concat(out)
        frame.insert(0, "lang", block["lang"].iat[0])
        return frame

    dealt = shares.withColumn("b", F.pmod(F.xxhash64("lang", "term"), F.lit(blocks)))
    both = dealt.groupBy("lang", "b").applyInPandas(common, "lang string, source string, item string, value long").select(
        "lang", "source", "item", F.col("value").cast("decimal(38,0)").alias("value"))

    # what one source's terms add against another's share of a missing term
    times = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    other = small_enough(sized.select("lang", F.col("source").alias("item"), F.col("p0").alias("i0")), 200_000)
    alone = stored(times.join(other, "lang").where("item <> source").join(
        small_enough(sized.select("lang", "source", "p0"), 200_000), ["lang", "source"]), "alone")
    wide = "decimal(38,0)"
    one_way = alone.select("lang", "source", "item", (
        F.col("m").cast("decimal(19,0)") * (gap(F.col("p"), F.col("i0")) - gap(F.col("p0"), F.col("i0"))).cast("decimal(19,0)")).cast(wide).alias("value"))
    other_way = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (
        F.col("m").cast("decimal(19,0)") * (gap(F.col("i0"), F.col("p")) - gap(F.col("i0"), F.col("p0"))).cast("decimal(19,0)")).cast(wide).alias("value"))
    base = sized.join(small_enough(sized.select("lang", F.col("source").alias("item"), F.col("p0").alias("i0")), 200_000), "lang").where(
        "item <> source").select("lang", "source", "item", F.coalesce(
            F.col("v").cast("decimal(19,0)") * gap(F.col("p0"), F.col("i0")).cast("decimal(19,0)"), F.lit(0)).cast(wide).alias("value"))
    return base.unionByName(one_way).unionByName(other_way).unionByName(both).groupBy("lang", "source", "item").agg(
        F.sum("value").cast("long").alias("value"))


def audit_sql(documents: str = "documents") -> str:
    """The same result in DuckDB SQL, by all terms of all pairs."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM {documents}),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
l AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT k) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM l GROUP BY ALL),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN l ON w.lang = l.lang AND w.term = l.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT s.lang, s.source, l.term, coalesce(c.n, 0) AS n,
             1 + ({SHARE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + v.v)::HUGEINT AS p,
             1 + ({SHARE}::HUGEINT * (l.n + 1)) // (v.total + v.v)::HUGEINT AS q
      FROM s JOIN l ON s.lang = l.lang JOIN v ON v.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = l.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= {RANKS}"""

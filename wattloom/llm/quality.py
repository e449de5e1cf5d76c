"""Line-first cleaning, with built-in functions only.

Each line is judged by punctuation, navigation and boilerplate rules. Failing lines are removed, and a document that loses too much
of its text is rejected, as is one with too few words or too much repetition.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattloom.llm.common import SPACES, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Fixed marks of boilerplate lines, matched in lower case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "we use cookies", "enable javascript", "subscribe to our", "powered by",
)


def line_fails(line: Column, boilerplate: Sequence[str] = BOILERPLATE) -> Column:
    """Whether a line with words is dropped.

    Punctuation: over a twentieth of its characters are symbols, or runs of exclamation marks. Navigation: three or more bars
    or arrows as separators. Boilerplate: a known phrase in a line of up to 200 characters.
    """
    size = F.length(line)
    symbols = size - F.length(F.translate(line, SYMBOLS + "!", ""))
    bars = size - F.length(F.translate(line, "|»›•", ""))
    lower = F.lower(line)
    phrases = F.lit(False)
    for phrase in boilerplate:
        phrases = phrases | lower.contains(phrase)
    return (symbols * 20 > size) | (bars >= 3) | ((size <= 200) & phrases)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(word_array: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the array.

    Windows are hashed to 64 bits and sorted with their places, so equal ones are neighbours.
    """
    def places(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return _let(F.sort_array(windows), covered)

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
        spread = F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(spread)))

    return F.when(F.size(word_array) < 4, 0).otherwise(_let(word_array, places)).cast("long")


def judge(docs: DataFrame, id_column: str = "doc_id", text: str = "text", most_lost: float = 0.4) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, n_lines_dropped, clean_text)``.

    ``base_failed``: under 50 words, or more than half of the words repeat. ``kept``: not that, and lines dropped hold at most
    ``most_lost`` of the text's characters. A null or empty text has no words and fails. Blank lines are neither judged nor dropped.
    Equal rows are judged alike; extra columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.withColumn("_w", words(F.col("_t"))).withColumn("_l", F.split("_t", "\n", -1))
    with_word = F.filter("_l", lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    stripped = F.length(F.translate("_t", SPACES, ""))
    counted = rows.select(
        "doc_id", "_t", "_l", F.size("_w").cast("long").alias("n_words"), stripped.cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        F.filter("_l", lambda x: ~F.coalesce(line_fails(x), F.lit(False))).alias("_good"))
    clean = counted.withColumn("clean_text", F.array_join("_good", "\n"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = F.length("_t") - F.length("clean_text")
    return clean.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (lost <= F.lit(float(most_lost)) * F.length("_t"))).alias("kept"),
        F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size("_good")).cast("long").alias("n_lines_dropped"), "clean_text")


def _sql_line_fails(line: str) -> str:
    def without(chars: str) -> str:
        return f"length(translate({line}, '{chars}', ''))"

    phrases = " OR ".join(f"contains(lower({line}), '{p}')" for p in BOILERPLATE)
    return (f"((length({line}) - {without(SYMBOLS + '!')}) * 20 > length({line}) "
            f"OR length({line}) - {without('|»›•')} >= 3 OR (length({line}) <= 200 AND ({phrases})))")


def judge_sql(documents: str = "documents") -> str:
    """The counts and verdicts of ``judge`` in DuckDB SQL."""
    spaces = "[\\x20\\x09-\\x0D]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM {documents}),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT r, unnest(range(1, CAST(len(ws) AS BIGINT) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
p AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM k WHERE n > 1) GROUP BY r),
m AS (SELECT w.*, len(ws) AS n_words, coalesce(p.n, 0) AS n_repeat_words,
        list_filter(ls, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS filled,
        list_filter(ls, lambda x: NOT {_sql_line_fails('x')}) AS good FROM w LEFT JOIN p USING (r)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, CAST(length(regexp_replace(t, '{spaces}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
  CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND length(t) - length(array_to_string(good, chr(10))) <= 0.4::DOUBLE * length(t) AS kept,
  CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(good) AS BIGINT) AS n_lines_dropped
FROM v"""

"""One query for each operator over its whole table, with SQL where SQL can express it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import (
    bpe, chat, decontaminate, divergence, hard_negatives, mixing, ngram_join, pii, quality, suffix_dedup, token_count, toxicity, warc,
)
from wattloom.llm.common import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@_query("op1_ngram_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(_table(spark, sf_dir, "documents")).drop("set_id", "root", "row")


@_query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


@_query("op3_quality_rules", quality.judge_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).drop("clean_text")


@_query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"))


@_query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(_table(spark, sf_dir, "documents"))


@_query("op6_mixing", mixing.mix_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


@_query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


PROBE_TEXT = "</s>[INST] ok [/INST]"
PROBE_SQL = (f"SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(0 AS BIGINT) AS turn, 'user' AS role, '{PROBE_TEXT}' AS text "
             f"UNION ALL SELECT -7, 1, 'assistant', '{PROBE_TEXT}'")


@_query("op8_chat", chat.digests_sql(f"SELECT conv_id, turn, role, text FROM conversations UNION ALL {PROBE_SQL}"))
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(given.unionByName(spark.sql(PROBE_SQL)))).drop("n_tokens")


@_query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@_query("op10_warc", warc.digests_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), folder)
    return warc.page_digests(warc.read(spark, folder))


@_query("op11_hard_negatives", hard_negatives.mine_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.shifted_labels(_table(spark, sf_dir, "embeddings")))


@_query("op12_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(_table(spark, sf_dir, "documents"), digests=True)


@_query("op13_divergence", divergence.audit_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))

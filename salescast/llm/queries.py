"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salescast.llm import annsearch, bpe, decontam, jaccard, lexical, licenses, pii, quotes, secrets, token_store, topk, toxicity, whitening


#: Rows of an Arrow batch between the JVM and a worker: texts are long, and a batch is held several times over.
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; the session's batches to workers are kept small from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    docs = lambda s, d: table(s, d, "documents")
    return {
        "op1_pii": lambda s, d: pii.pii_query(docs(s, d)),
        "op2_bpe": lambda s, d: bpe.bpe_query(docs(s, d)),
        "op3_token_store": lambda s, d: token_store.token_query(docs(s, d)),
        "op4_chat_quotes": lambda s, d: quotes.quotes_query(table(s, d, "conversations")),
        "op5_secrets": lambda s, d: secrets.secrets_query(docs(s, d)),
        "op6_toxicity": lambda s, d: toxicity.toxicity_query(docs(s, d), table(s, d, "labels")),
        "op7_licenses": lambda s, d: licenses.find_licenses(docs(s, d)),
        "op8_topk": lambda s, d: topk.topk_query(table(s, d, "embeddings")),
        "op9_jaccard": lambda s, d: jaccard.jaccard_groups(docs(s, d)),
        "op10_decontamination": lambda s, d: decontam.decontam_query(docs(s, d), table(s, d, "benchmark")),
        "op11_whitening": lambda s, d: whitening.whitening_query(table(s, d, "embeddings")),
        "op12_lexical": lambda s, d: lexical.rank_documents(docs(s, d), table(s, d, "benchmark")),
        "op13_ann": lambda s, d: annsearch.ann_query(table(s, d, "embeddings")),
    }


def all_sql() -> dict[str, str]:
    return {"op7_licenses": licenses.SQL, "op8_topk": topk.SQL, "op12_lexical": lexical.SQL}

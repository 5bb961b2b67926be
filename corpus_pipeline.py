"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run`` writes what a stage returns
and reads it again for the next one.  All but the last return the columns of ``documents``:

1. toxicity: documents that the classifier rejects go;
2. exact dedup: of equal texts the one with the smallest ``doc_id`` stays;
3. n-gram Jaccard join: of each group of near copies the one with the smallest ``doc_id`` stays;
4. secret scan: every secret becomes a marker, ``n_chars`` of changed texts is set anew;
5. best-fit packing: pieces with their places in sequences of at most 4096 tokens.

A NULL text passes the first four stages as the empty text would, and stays NULL.  Rows repeated in every column are one
document after stage 2.  An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmart.llm import exact_dedup, ngram_join, packing, secret_scan, toxicity
from starmart.llm.common import documents, ship, stored

BATCH_BYTES = "4m"


def _begin(spark: SparkSession) -> None:
    """The package for the executors' Python, and whole texts in Arrow batches of bounded size: a batch of 10,000 rows holds tens
    of MB of texts, once in the JVM and several times in each worker."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return toxicity.keep_harmless(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return ngram_join.keep_one_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None  # a trained classifier and a packing are not SQL; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus from raw documents: judged, deduplicated, mixed and encoded.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as
Parquet and read again for the next one. All but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.bpe import tokenize
from changeflow.llm.line_dedup import without_repeats
from changeflow.llm.mixing import mixed
from changeflow.llm.quality import KEEP_FROM, good_documents
from changeflow.llm.simhash import MAX_BITS, SHINGLE, one_of_each
from changeflow.session import written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality score is high enough."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(spark, docs, labels, keep_from=KEEP_FROM)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with one occurrence of each group of like lines."""
    return without_repeats(spark, docs, length="n_chars")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(spark, docs, shingle=SHINGLE, max_bits=MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document at least once, sources in their target shares, in slot order."""
    return mixed(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text again."""
    done = tokenize(spark, docs, TOKENIZER)
    return done.select("doc_id", "lang", "source", "n_chars", F.size("ids").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", judge),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

# Dictionaries, SimHashes, the schedule and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

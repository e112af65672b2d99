"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.bpe import token_digests
from changeflow.llm.embeddings import near_vectors
from changeflow.llm.filter_audit import ORACLE as FILTER_SQL
from changeflow.llm.filter_audit import audit
from changeflow.llm.html_text import extract
from changeflow.llm.line_dedup import without_repeats
from changeflow.llm.mixing import mix
from changeflow.llm.nearest import nearest
from changeflow.llm.quality import HELD_OUT, KEEP_FROM, fit, fold, scored
from changeflow.llm.quality_rules import judge_quality
from changeflow.llm.quality_sql import ORACLE as QUALITY_SQL
from changeflow.llm.secrets import scan, span_digests
from changeflow.llm.simhash import near_duplicates
from changeflow.llm.source_divergence import ORACLE as DIVERGENCE_SQL
from changeflow.llm.source_divergence import divergence
from changeflow.llm.url_rules import judge

Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        RUNS[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op2_url_rules", """
WITH split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(.|\\s)*?://([^/?#]*)', 2), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(.|\\s)*?://[^/?#]*([^?#]*)', 2), '') AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'),
  ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT s.page_id, arg_max(struct_pack(rule := rule_host || rule_path, verdict := verdict),
                            length(rule_host || rule_path)) AS best
  FROM split s JOIN rules r
    ON (s.host = rule_host OR ends_with(s.host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY s.page_id)
SELECT s.page_id, s.host, s.path, f.best.rule AS rule,
  coalesce(f.best.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f USING (page_id)""")
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, load(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, load(spark, sf_dir, "documents"))


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark, load(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(spark, docs, load(spark, sf_dir, "labels"))
    return scored(spark, docs, model, keep_text=False).select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digests(scan(spark, docs, keep_text=False)).drop("secrets")


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, load(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op1_embeddings")
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, load(spark, sf_dir, "embeddings"))


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(spark, docs).select("row.doc_id", "row.source", "epoch", "block", "release",
                                   "deadline", "slot")


@query("op5_line_dedup")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(spark, docs, dropped="n_dropped")


@query("op4_quality_rules", QUALITY_SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge_quality(spark, docs).drop("lang", "class_distance", "word_distance")


@query("op11_filter_audit", FILTER_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op12_nearest")
def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, load(spark, sf_dir, "embeddings"))


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark, load(spark, sf_dir, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

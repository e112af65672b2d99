"""Bounded snapshots of several tables, chunk by chunk, with restart."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import path_exists, remove_dir
from changeflow.sources.chunks import CHUNK_ROWS, ChunkPlan, EvenChunks, RankedChunks, plan_chunks

EVEN = "first bigint, step bigint, n bigint"
FINISHED = "table_name string, first int, last int"


def label_chunks(df: DataFrame, plan: ChunkPlan, name: str = "chunk_id") -> DataFrame:
    """Add each row's chunk."""
    return plan.label(df, name)


def _kept_plan(spark: SparkSession, df: DataFrame, key: str, size: int,
               path: str) -> tuple[ChunkPlan, bool]:
    """The plan a first run wrote to ``path``, or a new one, written there; and whether
    it was there.

    A restart must cut the table where the first run did. Even chunks are kept as
    their first end, step and number, ranked ones as their table of keys.
    """
    if path_exists(spark, f"{path}/even/_SUCCESS"):
        first, step, n = spark.read.schema(EVEN).json(f"{path}/even").first()
        return EvenChunks(key, range(first, first + step * n, step)), True
    if path_exists(spark, f"{path}/keys/_SUCCESS"):
        keys = spark.read.parquet(f"{path}/keys")
        return RankedChunks(key, keys, (keys.agg(F.max("chunk")).first()[0] or 0) + 1), True
    plan = plan_chunks(spark, df, key, size, path=f"{path}/keys")
    if isinstance(plan, EvenChunks):
        ends = plan.ends
        kept = spark.createDataFrame([(ends[0] if ends else 0, ends.step, len(ends))], EVEN)
        kept.coalesce(1).write.mode("overwrite").json(f"{path}/even")  # a single row
    return plan, False


def _finished(spark: SparkSession, out: str) -> set[tuple[str, int]]:
    """The waves recorded as done, as (table, first chunk)."""
    if not path_exists(spark, f"{out}/_finished"):
        return set()
    rows = spark.read.schema(FINISHED).json(f"{out}/_finished").collect()
    return {(r["table_name"], r["first"]) for r in rows}


def snapshot(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, str]], out: str,
             size: int = CHUNK_ROWS, waves: int = 8,
             on_wave: Callable[[str, int], object] | None = None) -> dict[str, ChunkPlan]:
    """Copy each table once into ``out/<table>``, then stop.

    ``tables`` maps a name to (frame, key). A table is read and labelled once, into a
    staged copy with a folder for each wave, a run of chunks; there are at most
    ``waves``. Then each wave is a job of its own that reads only its folder, writes
    the wave and is recorded, in the order of keys, and ``on_wave`` is called. A
    restart keeps the first run's cuts and its staged copy, skips recorded waves, begins
    with the first one that is missing, and picks up tables added to the list. A
    staged copy goes when all of its table's waves are recorded.
    """
    done = _finished(spark, out)
    plans = {}
    for name, (df, key) in tables.items():
        plan, kept = _kept_plan(spark, df, key, size, f"{out}/_plans/{name}")
        plans[name] = plan
        chunks = -(-len(plan) // waves)
        firsts = [first for first in range(0, len(plan), chunks) if (name, first) not in done]
        if not firsts:
            continue
        staged = f"{out}/_staged/{name}"
        if not path_exists(spark, f"{staged}/_SUCCESS"):
            wave = F.col("chunk_id") - F.col("chunk_id") % chunks
            plan.label(df, later=kept).withColumn("wave", wave).where(F.col("wave").isin(firsts)) \
                .hint("rebalance", F.col("wave")).write.mode("overwrite") \
                .option("partitionOverwriteMode", "static").partitionBy("wave").parquet(staged)
        schema = df.withColumn("chunk_id", F.lit(0)).schema
        for first in firsts:
            rows = spark.read.schema(schema).parquet(f"{staged}/wave={first}") \
                if path_exists(spark, f"{staged}/wave={first}") else spark.createDataFrame([], schema)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static") \
                .parquet(f"{out}/{name}/wave={first}")
            record = [(name, first, min(first + chunks, len(plan)) - 1)]
            spark.createDataFrame(record, FINISHED).coalesce(1).write.mode("append") \
                .json(f"{out}/_finished")  # a single row
            if on_wave is not None:
                on_wave(name, first)
        remove_dir(spark, staged)
    return plans


def read_snapshot(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The rows of a snapshot, each with its ``chunk_id``."""
    return spark.read.parquet(f"{out}/{table}").drop("wave")


def as_inserts(df: DataFrame) -> DataFrame:
    """Snapshot rows as a changelog."""
    return df.withColumn("op", F.lit("+I"))

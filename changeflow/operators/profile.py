"""Profiles of a key column that grow with a table: sketches kept for each of its parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.counting import factor_of
from changeflow.session import path_exists

LOG_REGISTERS = 14  # of the distinct count: its standard error is 1.04 / sqrt(2^14), 0.8 %
WIDTH = 1600  # of the quantile sketch: ranks err by about 0.2 % of the rows


def sketched(df: DataFrame, key: str, log_registers: int = LOG_REGISTERS,
             width: int = WIDTH) -> DataFrame:
    """One row with what a key's profile is made of, in one pass.

    Columns: row_count, null_count, min_key, max_key, distinct (a distinct-count
    sketch) and ranks (a quantile sketch of the key as bigint, or as double if it is no
    whole number; null for keys that are no numbers). Sketches have a fixed size
    and are combined inside the map tasks.
    """
    kind = df.schema[key].dataType
    whole = isinstance(kind, T.IntegralType)
    if whole:
        ranks = F.kll_sketch_agg_bigint(F.col(key).cast("bigint"), F.lit(width))
    elif isinstance(kind, T.NumericType):
        ranks = F.kll_sketch_agg_double(F.col(key).cast("double"), F.lit(width))
    else:
        ranks = F.lit(None).cast("binary")
    hashed = key if whole or isinstance(kind, T.StringType) else F.col(key).cast("string")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count(F.when(F.col(key).isNull(), 1)).alias("null_count"),
        F.min(key).alias("min_key"), F.max(key).alias("max_key"),
        F.hll_sketch_agg(hashed, log_registers).alias("distinct"), ranks.alias("ranks"))


class KeyProfile:
    """A key's profile over the parts of a table that have been added.

    Each part is scanned once, when it is added, and leaves one row in ``path``; adding a
    part of the same name again replaces it. Statistics merge the rows of all
    parts, so they follow appended parts without another scan, and are the same as
    one pass over all parts gives but for the sketches' errors.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, kind: T.DataType,
                 log_registers: int = LOG_REGISTERS, width: int = WIDTH):
        self.spark, self.path, self.key, self.kind = spark, path, key, kind
        self.log_registers, self.width = log_registers, width
        self.whole = isinstance(kind, T.IntegralType)

    def add(self, df: DataFrame, part: str) -> None:
        if df.schema[self.key].dataType != self.kind:
            raise ValueError(f"{self.key} is {df.schema[self.key].dataType}, not {self.kind}")
        sketched(df, self.key, self.log_registers, self.width).coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.path}/part={part}")  # a single row

    def parts(self) -> DataFrame:
        """The rows that the parts have left."""
        schema = T.StructType([
            T.StructField("row_count", T.LongType()), T.StructField("null_count", T.LongType()),
            T.StructField("min_key", self.kind), T.StructField("max_key", self.kind),
            T.StructField("distinct", T.BinaryType()), T.StructField("ranks", T.BinaryType()),
            T.StructField("part", T.StringType())])
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def _merged(self) -> DataFrame:
        ranked = isinstance(self.kind, T.NumericType)
        merge = F.kll_merge_agg_bigint if self.whole else F.kll_merge_agg_double
        ranks = merge("ranks", F.lit(self.width)) if ranked else F.lit(None).cast("binary")
        return self.parts().agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("null_count"), F.lit(0)).alias("null_count"),
            F.min("min_key").alias("min_key"), F.max("max_key").alias("max_key"),
            F.hll_union_agg("distinct").alias("distinct"), ranks.alias("ranks"))

    def stats(self) -> DataFrame:
        """row_count, null_count, min_key, max_key, distinct_count (estimated) and, for whole
        numbers, the distribution ``factor`` that chunk plans go by; one row."""
        found = self._merged().withColumn(
            "distinct_count", F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0)))
        names = ["row_count", "null_count", "min_key", "max_key", "distinct_count"]
        return found.select(*names, *([factor_of().alias("factor")] if self.whole else []))

    def quantiles(self, fractions: Sequence[float]) -> list:
        """The keys below or at which these fractions of the rows with a key lie, about."""
        if not isinstance(self.kind, T.NumericType):
            raise ValueError(f"{self.key} is no number")
        get = F.kll_sketch_get_quantile_bigint if self.whole else F.kll_sketch_get_quantile_double
        found = self._merged().where(F.col("row_count") > F.col("null_count")) \
            .select(get("ranks", F.array(*[F.lit(float(f)) for f in fractions]))).first()
        return list(found[0]) if found and fractions else []

    def chunk_ends(self, size: int) -> list:
        """Ends of chunks of about ``size`` rows, without a look at the table: each chunk
        begins at an end; the first has no lower, the last no upper bound."""
        row = self.stats().first()
        keyed = row["row_count"] - row["null_count"]
        chunks = -(-keyed // size)
        ends = self.quantiles([i / chunks for i in range(1, chunks)]) if chunks > 1 else []
        return sorted({e for e in ends if row["min_key"] < e <= row["max_key"]})

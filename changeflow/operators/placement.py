"""Which shard a row goes to. Each strategy is a column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType

STRATEGIES = ("balanced", "shuffle", "hash", "value")


def balanced(n: int) -> Column:
    """Round robin inside each writer task, starting at shard 1 mod n.

    A row's number within its task is the low 33 bits of its monotonic id, so
    no numbering pass over the table is needed.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return ((row + 1) % n).cast("int")


def shuffled(n: int, seed: int | None = None) -> Column:
    """Uniform random; the seed keeps a retried task on the same draw."""
    return F.floor(F.rand(seed) * n).cast("int")


def hashed(key: str, n: int) -> Column:
    """Equal keys share a shard; a null key goes to shard 0."""
    return F.when(F.col(key).isNull(), 0).otherwise(
        F.pmod(F.xxhash64(F.col(key)), F.lit(n))).cast("int")


def hashed_long(key: str, n: int) -> Column:
    """The placement of a 64-bit key by the xor of its two 32-bit halves."""
    value = F.col(key).cast("bigint")
    low = value.bitwiseXOR(F.shiftrightunsigned(value, 32)).bitwiseAND(F.lit(0xFFFFFFFF))
    signed = F.when(low >= (1 << 31), low - (1 << 32)).otherwise(low)
    return F.coalesce(F.abs(signed % n), F.lit(0)).cast("int")


def by_value(df: DataFrame, key: str, n: int) -> Column:
    """The residue of a numeric key.

    Integers and floats give the absolute truncated residue, decimals the
    non-negative residue of their integer part. A null key stops the job.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, NumericType):
        raise ValueError(f"value placement needs a numeric key, {key} is {kind.simpleString()}")
    value = F.col(key)
    if isinstance(kind, DecimalType):
        whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
        shard = F.pmod(whole.cast("decimal(38,0)"), F.lit(n).cast("decimal(38,0)")).cast("int")
    elif isinstance(kind, IntegralType):
        shard = F.abs(value % n).cast("int")
    else:
        shard = F.abs((value % n).cast("int"))
    stop = F.raise_error(F.lit(f"null key {key} has no shard")).cast("int")
    return F.when(value.isNull(), stop).otherwise(shard)


def shard_column(df: DataFrame, strategy: str, n: int, key: str | None = None,
                 seed: int = 0) -> Column:
    """The shard of each row under ``strategy``; bad combinations fail at once."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, use one of {STRATEGIES}")
    if strategy in ("hash", "value"):
        if not key:
            raise ValueError(f"strategy {strategy} needs a key")
        if key not in df.columns:
            raise ValueError(f"key {key} is not a column")
    if strategy == "balanced":
        return balanced(n)
    if strategy == "shuffle":
        return shuffled(n, seed)
    return hashed(key, n) if strategy == "hash" else by_value(df, key, n)


def with_shard(df: DataFrame, strategy: str, n: int, key: str | None = None,
               seed: int = 0, name: str = "shard") -> DataFrame:
    return df.withColumn(name, shard_column(df, strategy, n, key, seed))

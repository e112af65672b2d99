"""Bring rows to the column types a foreign store declares."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Foreign type names by the Spark type that holds them. Unsigned
# integers take the next wider type; intervals are counts of their unit.
_BY_NAME = {
    "INT8": T.ByteType(),
    "INT16": T.ShortType(), "UINT8": T.ShortType(), "SHORT": T.ShortType(),
    "INT32": T.IntegerType(), "UINT16": T.IntegerType(), "INT": T.IntegerType(),
    "INTERVALYEAR": T.IntegerType(), "INTERVALQUARTER": T.IntegerType(),
    "INTERVALMONTH": T.IntegerType(), "INTERVALWEEK": T.IntegerType(),
    "INTERVALDAY": T.IntegerType(), "INTERVALHOUR": T.IntegerType(),
    "INTERVALMINUTE": T.IntegerType(), "INTERVALSECOND": T.IntegerType(),
    "INT64": T.LongType(), "UINT32": T.LongType(), "BIGINT": T.LongType(),
    "INT128": T.DecimalType(38, 0), "INT256": T.DecimalType(38, 0),
    "UINT64": T.DecimalType(38, 0), "UINT128": T.DecimalType(38, 0),
    "UINT256": T.DecimalType(38, 0),
    "BIGDECIMAL": T.DecimalType(38, 18),
    "FLOAT32": T.FloatType(), "FLOAT": T.FloatType(),
    "FLOAT64": T.DoubleType(), "DOUBLE": T.DoubleType(),
    "BOOL": T.BooleanType(), "BOOLEAN": T.BooleanType(),
    "BINARY": T.BinaryType(), "BYTE": T.BinaryType(),
    "STRING": T.StringType(), "ENUM8": T.StringType(), "ENUM16": T.StringType(),
    "FIXEDSTRING": T.StringType(), "IPV4": T.StringType(), "IPV6": T.StringType(),
    "UUID": T.StringType(), "CHAR": T.StringType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(), "DATETIME32": T.TimestampNTZType(),
    "DATETIME64": T.TimestampNTZType(), "TIMESTAMP": T.TimestampNTZType(),
    "UNIXTIME_MICROS": T.TimestampNTZType(), "TIME": T.TimestampNTZType(),
}
_DECIMAL_DIGITS = {"DECIMAL32": 9, "DECIMAL64": 18, "DECIMAL128": 38, "DECIMAL256": 38}
MAX_DIGITS = 38


def _arguments(text: str) -> list[str]:
    """Split at the commas outside brackets."""
    return [p.strip() for p in re.split(r",(?![^()]*\))", text)] if text else []


def foreign_type(name: str) -> T.DataType:
    """The Spark type for a declared type such as ``Map(String, Array(Int32))``."""
    match = re.fullmatch(r"\s*(\w+)\s*(?:\((.*)\))?\s*", name, re.S)
    if not match:
        raise ValueError(f"unreadable type {name!r}")
    head, inner = match.group(1).upper(), (match.group(2) or "").strip()
    if head in ("NULLABLE", "LOWCARDINALITY"):
        return foreign_type(inner)
    if head == "ARRAY":
        return T.ArrayType(foreign_type(inner))
    if head == "MAP":
        key, value = _map_arguments(inner)
        return T.MapType(foreign_type(key), foreign_type(value))
    if head == "DECIMAL":
        digits, scale = ([int(a) for a in _arguments(inner)] + [0, 0])[:2]
        return T.DecimalType(min(digits or 10, MAX_DIGITS), min(scale, MAX_DIGITS))
    if head in _DECIMAL_DIGITS:
        return T.DecimalType(_DECIMAL_DIGITS[head], min(int(inner or 0), MAX_DIGITS))
    if head not in _BY_NAME:
        raise ValueError(f"unsupported type {name!r}")
    return _BY_NAME[head]


def _map_arguments(inner: str) -> tuple[str, str]:
    """A map key is a plain type, so the first comma outside brackets ends it."""
    depth = 0
    for at, char in enumerate(inner):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            return inner[:at].strip(), inner[at + 1:].strip()
    raise ValueError(f"a map needs a key and a value type, got {inner!r}")


def foreign_schema(columns: Mapping[str, str], keys: Sequence[str] = ()) -> T.StructType:
    """A schema from declared types; key columns are not nullable."""
    return T.StructType([T.StructField(c, foreign_type(t), c not in keys)
                         for c, t in columns.items()])


def number_to_bool(value: Column) -> Column:
    """A stored number is true exactly when it is 1."""
    return value == 1


def truncate_to_ms(ts: Column) -> Column:
    """Stores with millisecond times drop the finer digits."""
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def conform(df: DataFrame, columns: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared types, in the declared order; misfits become null.

    Numbers stored for booleans are true when 1. Key columns are not nullable: a
    row without its key, or whose key does not fit, stops the job. Pair with a
    quarantine rule to keep rows whose cast lost a value.
    """
    def cast(name: str, kind: T.DataType) -> Column:
        have = df.schema[name].dataType
        if isinstance(kind, T.BooleanType) and isinstance(have, T.NumericType):
            return number_to_bool(F.col(name))
        return F.col(name).try_cast(kind)

    def stored(field: T.StructField) -> Column:
        value = cast(field.name, field.dataType)
        if field.nullable:
            return value.alias(field.name)
        # The literal is never used; it tells Spark that the column has no nulls.
        stop = F.raise_error(F.lit(f"no value for the key column {field.name}"))
        filled = F.when(value.isNull(), stop.cast(field.dataType)).otherwise(value)
        return F.coalesce(filled, _any_value(field.dataType)).alias(field.name)

    return df.select(*[stored(f) for f in foreign_schema(columns, keys).fields])


def _any_value(kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.make_date(F.lit(1970), F.lit(1), F.lit(1))
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(datetime(1970, 1, 1)).cast(kind)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit("").cast(kind)
    return F.lit(False) if isinstance(kind, T.BooleanType) else F.lit(0).cast(kind)


EXACT = T.DecimalType(38, 18)
WHOLE = T.DecimalType(38, 0)
_NUMBERS = (T.IntegralType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def misfits(df: DataFrame, columns: Mapping[str, str]) -> Column:
    """True where a non-null value, or one nested in it, does not survive its cast.

    See :func:`lossy` for what counts.
    """
    lost = F.lit(False)
    for field in foreign_schema(columns).fields:
        lost = lost | lossy(F.col(field.name), df.schema[field.name].dataType, field.dataType)
    return lost


def lossy(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether a value of one type loses something by a cast to another; never null.

    A value is lost if the cast gives none. Whole numbers and decimals must come
    back the same from whatever numbers they are cast to; binary fractions from whole
    numbers and decimals. A double as a float is only lost where it is too large,
    since all but a few are rounded. Texts that are numbers lose nonzero digits behind
    the scale, and whole ones the digits a float has no room for. Times lose their
    time of day as dates. Numbers for booleans fit always. Elements of arrays, keys
    and values of maps and fields of structs are looked at one by one.
    """
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return _either(F.exists(value, lambda x: lossy(x, have.elementType, want.elementType)))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return _either(F.exists(F.map_entries(value), lambda e:
                                lossy(e["key"], have.keyType, want.keyType)
                                | lossy(e["value"], have.valueType, want.valueType)))
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        parts = [lossy(value[h.name], h.dataType, w.dataType)
                 for h, w in zip(have.fields, want.fields)]
        return _either(reduce(or_, parts, F.lit(len(have.fields) != len(want.fields))))
    if isinstance(want, T.BooleanType) and isinstance(have, T.NumericType):
        return F.lit(False)
    cast = value.try_cast(want)
    return value.isNotNull() & (cast.isNull() | _either(_changed(value, cast, have, want)))


def _either(found: Column) -> Column:
    return F.coalesce(found, F.lit(False))


def _changed(value: Column, cast: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether a cast that gave a value gave another one than it was."""
    if isinstance(want, T.NumericType) and isinstance(have, _NUMBERS):
        back = cast.try_cast(have)
        return back.isNull() | (back != value)
    if isinstance(have, T.FractionalType) and isinstance(want, _NUMBERS):
        return cast.cast("double") != value.cast("double")
    if isinstance(have, T.DoubleType) and isinstance(want, T.FloatType):
        return (F.abs(cast) == float("inf")) & (F.abs(value) != float("inf"))
    if isinstance(have, T.StringType):
        text = F.trim(value)
        if isinstance(want, T.DecimalType):
            behind = text.rlike(f"^[+-]?[0-9]*[.][0-9]{{{want.scale}}}[0-9]*[1-9][0-9]*$")
            shifted = text.rlike("[eE]") & _either(
                (value.try_cast(EXACT) != cast.try_cast(EXACT))
                | (value.try_cast("double") != cast.cast("double")))
            return behind | shifted
        if isinstance(want, T.FractionalType):
            back = cast.try_cast(WHOLE)
            return text.rlike("^[+-]?[0-9]+$") & _either(
                back.isNull() | (value.try_cast(WHOLE) != back))
        if isinstance(want, T.DateType):
            return value.try_cast("timestamp_ntz") != cast.cast("timestamp_ntz")
    if isinstance(have, _TIMES) and isinstance(want, T.DateType):
        return cast.cast(have) != value
    return F.lit(False)

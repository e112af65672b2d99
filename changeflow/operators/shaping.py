"""JSON messages, change envelopes and trace events into typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from changeflow.functions import text as X
from changeflow.functions.time import SECOND, format_ms

BAD = "_corrupt"


# ---- JSON -------------------------------------------------------------------


def _check_mode(on_error: str) -> None:
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be fail or quarantine, not {on_error!r}")


def _schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _with_items(df: DataFrame, column: str, row: StructType) -> DataFrame:
    """Add the typed items of an array message and whether the message is damaged.

    A second reading as plain string maps shows fields that were given but did
    not fit their type, which the typed reading alone turns into nulls.
    """
    body = F.trim(column)
    as_array = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    read = df.withColumns({
        "_items": F.from_json(column, ArrayType(row)),
        "_texts": F.from_json(as_array, "array<map<string,string>>")})

    def lost(item: Column, text: Column) -> Column:
        found = item.isNull()
        for name in row.fieldNames():
            given = F.try_element_at(text, F.lit(name)).isNotNull()
            found = found | (given & item[name].isNull())
        return found

    torn = F.coalesce(F.exists(F.zip_with("_items", "_texts", lost), lambda x: x), F.lit(True))
    nothing = F.coalesce(body == "null", F.lit(False))
    return read.withColumn("_damaged", X.missing(F.col(column)) | (~nothing & torn)).drop("_texts")


def _refuse(missing: Column, parsed: Column) -> Column:
    """``parsed``, but a message that is not there stops the job."""
    stop = F.raise_error(F.lit("blank or missing message"))
    return F.when(missing, stop).otherwise(parsed)


def explode_json(df: DataFrame, column: str, schema: StructType | str,
                 on_error: str = "fail") -> DataFrame:
    """Each message is a JSON array of objects; one row per object.

    Empty arrays and JSON ``null`` give no rows, unknown keys are ignored and
    missing ones are null; a lone object counts as an array of one. Damaged text,
    a blank or missing message, or a value that does not fit its type stops the
    job. With
    ``on_error='quarantine'`` such messages are left out whole;
    :func:`unreadable_json` returns them.
    """
    _check_mode(on_error)
    rest, row = [c for c in df.columns if c != column], _schema(schema)
    if on_error == "fail":
        sent = F.nullif(F.trim(column), F.lit("null"))
        strict = F.from_json(sent, ArrayType(row), {"mode": "FAILFAST"})
        return df.select(*rest, F.inline(_refuse(X.missing(F.col(column)), strict)))
    kept = _with_items(df, column, row).where(~F.col("_damaged"))
    return kept.select(*rest, F.inline("_items"))


def parse_json(df: DataFrame, column: str, schema: StructType | str,
               on_error: str = "fail") -> DataFrame:
    """Each message is one JSON object; its fields become columns.

    Damage anywhere in a record, or a blank or missing message, stops the job. With
    ``on_error='quarantine'`` only records whose text is a readable object are kept;
    :func:`unreadable_json` returns the others.
    """
    _check_mode(on_error)
    rest = [c for c in df.columns if c != column]
    ddl = _schema(schema)
    if on_error == "fail":
        parsed = F.from_json(column, ddl, {"mode": "FAILFAST"})
        whole = _refuse(X.missing(F.col(column)), parsed)
        return df.select(*rest, whole.alias("_r")).select(*rest, "_r.*")
    return (_with_record(df, column, ddl).where(~F.col("_damaged"))
            .select(*rest, *[F.col(f"_r.{f.name}").alias(f.name) for f in ddl.fields]))


def unreadable_json(df: DataFrame, column: str, schema: StructType | str,
                    array: bool = False) -> DataFrame:
    """The messages the tolerant readers leave out."""
    ddl = _schema(schema)
    if array:
        return _with_items(df, column, ddl).where("_damaged").drop("_items", "_damaged")
    return _with_record(df, column, ddl).where("_damaged").drop("_r", "_damaged")


def _with_record(df: DataFrame, column: str, ddl: StructType) -> DataFrame:
    """Add the typed record of a message and whether the message is damaged."""
    marked = StructType(list(ddl.fields)).add(BAD, "string")
    parsed = F.from_json(column, marked, {"columnNameOfCorruptRecord": BAD})
    return df.withColumn("_r", parsed).withColumn(
        "_damaged", X.missing(F.col(column)) | F.col(f"_r.{BAD}").isNotNull())


def render_json(df: DataFrame, columns: Sequence[str] | None = None,
                name: str = "value") -> DataFrame:
    """Rows as JSON text; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(name))


# ---- change envelopes -------------------------------------------------------

def _image_fields(df: DataFrame) -> list[str]:
    return df.schema["after"].dataType.fieldNames()


def normalize_envelope(df: DataFrame, now_ms: int | Column) -> DataFrame:
    """``{before, after, source}`` to ``ts, dbName, tableName, table_details``.

    After alone is an insert, both an update, before alone a delete; neither
    drops the row. ``table_details`` is JSON of the image with ``op`` (i, u, d)
    and ``system_time``.
    """
    op = (F.when(F.col("before").isNull(), "i").when(F.col("after").isNull(), "d")
          .otherwise("u"))
    stamp = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    kept = df.where(F.col("before").isNotNull() | F.col("after").isNotNull())
    imaged = kept.select("source", op.alias("op"),
                         F.coalesce("after", "before").alias("image"))
    fields = [F.col(f"image.{f}").alias(f) for f in _image_fields(df)]
    details = F.to_json(F.struct(*fields, "op", stamp.cast("bigint").alias("system_time")))
    return imaged.select(
        F.col("source.ts_ms").alias("ts"), F.col("source.db").alias("dbName"),
        F.col("source.table").alias("tableName"), details.alias("table_details"))


def normalize_map_envelope(df: DataFrame, now_ms: int | Column) -> DataFrame:
    """The same for streams of many tables, whose images are string maps."""
    op = (F.when(F.col("before").isNull(), "i").when(F.col("after").isNull(), "d")
          .otherwise("u"))
    stamp = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    extra = F.create_map(F.lit("op"), op, F.lit("system_time"), stamp.cast("string"))
    kept = df.where(F.col("before").isNotNull() | F.col("after").isNotNull())
    return kept.select(
        F.col("source.ts_ms").alias("ts"), F.col("source.db").alias("dbName"),
        F.col("source.table").alias("tableName"),
        F.to_json(F.map_concat(F.coalesce("after", "before"), extra)).alias("table_details"))


def as_envelopes(df: DataFrame, db: str | Column, table: str | Column,
                 ts_ms: int = 0) -> DataFrame:
    """Rows of a snapshot as envelopes of inserts."""
    names = [c if isinstance(c, Column) else F.lit(c) for c in (db, table)]
    row = F.struct(*df.columns)
    return df.select(
        F.when(F.lit(False), row).alias("before"), row.alias("after"),
        F.struct(F.lit(ts_ms).cast("bigint").alias("ts_ms"), names[0].alias("db"),
                 names[1].alias("table")).alias("source"))


def envelope_images(df: DataFrame) -> DataFrame:
    """Both images of a change as JSON, in one column per kind.

    Insert: ``op='c'`` and ``only_insert``. Update: ``after_update`` and
    ``before_update`` with the markers ``after`` and ``before``, no ``op``.
    Delete: ``op='d'`` and ``before_delete``.
    """
    has_before, has_after = F.col("before").isNotNull(), F.col("after").isNotNull()
    inserted, deleted = has_after & ~has_before, has_before & ~has_after
    updated = has_after & has_before
    return df.where(has_before | has_after).select(
        F.col("source.ts_ms").alias("ts"), F.col("source.db").alias("dbName"),
        F.col("source.table").alias("tableName"),
        F.when(inserted, "c").when(deleted, "d").alias("op"),
        F.when(inserted, F.to_json("after")).alias("only_insert"),
        F.when(updated, "after").alias("after"),
        F.when(updated, F.to_json("after")).alias("after_update"),
        F.when(updated, "before").alias("before"),
        F.when(updated, F.to_json("before")).alias("before_update"),
        F.when(deleted, F.to_json("before")).alias("before_delete"))


# Metadata keys and where an envelope carries them.
_METADATA = {"database_name": "source.db", "table_name": "source.table", "op_ts": "source.ts_ms"}


def with_metadata(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the asked metadata of each change as columns."""
    unknown = [k for k in keys if k not in _METADATA]
    if unknown:
        raise ValueError(f"unknown metadata keys: {unknown}")
    return df.select("*", *[F.col(_METADATA[k]).alias(k) for k in keys])


def changed_columns(df: DataFrame) -> DataFrame:
    """For each update the names of the columns whose value differs."""
    names = [F.when(~F.col(f"before.{f}").eqNullSafe(F.col(f"after.{f}")), F.lit(f))
             for f in _image_fields(df)]
    return (df.where(F.col("before").isNotNull() & F.col("after").isNotNull())
            .withColumn("changed", F.array_compact(F.array(*names))))


# ---- events -----------------------------------------------------------------

def extract_attributes(df: DataFrame, event: Mapping, time_col: str = "occurrenceTime",
                       zone: str = "UTC") -> DataFrame:
    """Pick the attributes an event definition names, in its order.

    ``event`` is ``{code, name, attributesJSON: [{attributeId}, ...]}``. A named
    attribute must be a column, else the call fails before any job; a null value
    stays null.
    """
    wanted = [a["attributeId"] for a in event["attributesJSON"]]
    absent = [a for a in wanted if a not in df.columns]
    if absent:
        raise ValueError(f"attributes not in the event rows: {absent}")
    pairs = [F.struct(F.lit(a).alias("attributeId"), F.col(a).cast("string").alias("value"))
             for a in wanted]
    return df.select(
        F.lit(event["code"]).alias("eventId"), F.lit(event["name"]).alias("eventName"),
        format_ms(F.col(time_col).cast("bigint"), SECOND, zone).alias("occurrenceTime"),
        "channelCode", "accountId", F.array(*pairs).alias("attributesJSON"))


# Output fields of a full trace and the key in ``value`` they come from.
_DETAIL_KEYS = {
    "activityId": "activityId",
    "activityType": "activityType",
    "apiUri": "api",
    "eventDetail": "eventName",
    "requestBody": "body",
    "requestResult": "result",
    "tenantId": "tenantId",
}


def flatten_trace(df: DataFrame, full: bool = False, on_error: str = "fail") -> DataFrame:
    """Trace events to flat user events; events without a project drop out.

    ``value`` is parsed once into a map and all keys are looked up there. A blank
    one has no details; a damaged one stops the job or, with
    ``on_error='quarantine'``, leaves its event out: :func:`unreadable_traces`
    returns those.
    """
    _check_mode(on_error)
    named = df.where(F.col("projectId").isNotNull())
    if on_error == "quarantine":
        named = named.where(~X.damaged_map(F.col("value")))
    parsed = named.withColumn("_v", X.json_map(F.col("value"), on_error))

    def detail(key: str) -> Column:
        return F.try_element_at("_v", F.lit(key))

    lite = [
        F.col("uuid").alias("id"),
        F.col("projectId"),
        F.col("event").alias("eventName"),
        F.col("userId"),
        F.col("url").alias("visitUrl"),
        F.coalesce(detail("requestUrl"), "url").alias("url"),
        F.date_format(F.to_timestamp("createTime", SECOND), SECOND).alias("visitTime"),
        F.coalesce(detail("appId"), detail("appid")).alias("appId"),
        F.col("iPv4").alias("visitIp"),
        X.query_param(F.col("queryString"), "from").alias("visitByChannel"),
        detail("costTime").try_cast("bigint").alias("requestCostTime"),
    ]
    if not full:
        return parsed.select(*lite)
    more = [
        F.col("subject"), F.col("method"), F.col("eventType"), F.col("userAgent"),
        F.col("referer").alias("refererUrl"), F.lit("").alias("activityScene"),
        F.col("value").alias("eventValue"),
        *[detail(key).alias(name) for name, key in _DETAIL_KEYS.items()],
    ]
    return parsed.select(*lite, *more)


def unreadable_traces(df: DataFrame) -> DataFrame:
    """The trace events with a project whose ``value`` is damaged."""
    return df.where(F.col("projectId").isNotNull() & X.damaged_map(F.col("value")))

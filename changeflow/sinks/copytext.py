"""Bulk-load text: one delimited line per row, as a COPY command reads it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

# The format's characters.
DELIMITER = "|"
QUOTE = '"'
ESCAPE = "\\"


def quoted(text: Column) -> Column:
    """Always in quotes; quotes and escapes get the escape, NUL characters go."""
    clean = F.regexp_replace(text, "\\x00", "")
    escaped = F.regexp_replace(clean, r'(["\\])', r"\\$1")
    return F.concat(F.lit(QUOTE), escaped, F.lit(QUOTE))


def octal(data: Column) -> Column:
    """Bytes as text: a doubled backslash, and ``\\ooo`` for what does not print."""
    def shown(char: Column) -> Column:
        code = F.ascii(char)
        digits = F.lpad(F.conv(code.cast("string"), 10, 8), 3, "0")
        return (F.when(char == ESCAPE, F.lit(ESCAPE * 2))
                .when((code < 0x20) | (code > 0x7E), F.concat(F.lit(ESCAPE), digits))
                .otherwise(char))

    chars = F.split(F.decode(data, "ISO-8859-1"), "")
    return F.when(F.length(data) == 0, F.lit("")).otherwise(
        F.array_join(F.transform(chars, shown), ""))


def copy_lines(df: DataFrame) -> DataFrame:
    """Each row as one line; null is the empty field, numbers stay bare and exact."""
    def field(name: str) -> Column:
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, StringType):
            text = quoted(value)
        elif isinstance(kind, BinaryType):
            text = octal(value)
        else:
            text = value.cast("string")
        return F.coalesce(text, F.lit(""))

    return df.select(F.concat_ws(DELIMITER, *[field(c) for c in df.columns]).alias("value"))


def write_copy_text(df: DataFrame, path: str, max_rows: int = 0,
                    mode: str = "errorifexists") -> None:
    """Write bulk-load files, one for a task, or of at most ``max_rows`` rows each."""
    copy_lines(df).write.mode(mode).option("maxRecordsPerFile", max_rows).text(path)


def read_copy_text(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read bulk-load files back; quoted fields may hold line ends.

    A bare empty field is null and a quoted one the empty text. NUL stands for
    null inside the reader, since the files cannot contain it.
    """
    return (spark.read.schema(schema)
            .options(sep=DELIMITER, quote=QUOTE, escape=ESCAPE, multiLine=True, lineSep="\n",
                     nullValue="\x00", emptyValue="", header=False, mode="FAILFAST",
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            .csv(path))

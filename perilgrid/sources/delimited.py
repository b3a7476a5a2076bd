"""Pipe-delimited text: split by position, keep empty fields, convert leniently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NEVER = "\u0001"
ROWS_PER_FILE = 250_000  # of a compressed text file, which is not split


def read_lines(spark: SparkSession, path: str | list[str], header: bool) -> DataFrame:
    """Text lines as ``value``; with ``header`` the first line of every file is left out.

    The header case goes through the CSV reader with quoting off and a delimiter that hardly
    occurs, because that reader drops one line per file and still splits large files. A line
    that holds the delimiter is more than the one column asked for and comes back whole from the
    corrupt-record column. That reader takes blank lines for no records; without a header they
    are lines like any other.
    """
    if not header:
        return spark.read.text(path)
    return (
        spark.read.schema("value string, _whole string")
        .option("columnNameOfCorruptRecord", "_whole")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", _NEVER)
        .option("quote", "")
        .option("maxCharsPerColumn", -1)
        .csv(path)
        .select(F.coalesce("_whole", "value", F.lit("")).alias("value"))
    )


def read_fields(spark: SparkSession, path: str | list[str], header: bool, sep: str = "|") -> DataFrame:
    """``line`` and ``fields``: every field of each line, trailing empty ones included."""
    # a single escaped character needs no regex engine
    pattern = sep if sep.isalnum() else "\\" + sep if len(sep) == 1 else f"\\Q{sep}\\E"
    lines = read_lines(spark, path, header)
    return lines.select(F.col("value").alias("line"), F.split("value", pattern, -1).alias("fields"))


def field(index: int, data_type: T.DataType) -> str:
    """SQL for a field by position, converted to its type; missing or unparsable gives null.

    Strings stay as they are, including empty ones and the token ``NULL``. Most unparsable
    numbers are one of these two: sorting them out first avoids a failed parse for each.
    The conversion itself ignores surrounding blanks.
    """
    text = f"get(fields, {index})"
    if isinstance(data_type, T.StringType):
        return text
    return f"CASE WHEN {text} NOT IN ('', 'NULL') THEN try_cast({text} AS {data_type.simpleString()}) END"


def write_delimited(
    df: DataFrame,
    path: str,
    header: bool,
    sep: str = "|",
    null_token: str = "",
    compression: str | None = "gzip",
    rows_per_file: int = ROWS_PER_FILE,
) -> str:
    """Write columns as text fields in order, nulls as ``null_token``.

    Every file carries its own header line when one is asked for. Files are compressed, as wide rows of text repeat
    themselves; one is read by one task then, so each holds at most ``rows_per_file`` rows.
    """
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_token)) for c in df.columns]
    lines = df.select(F.concat_ws(sep, *texts).alias(sep.join(df.columns)))
    writer = lines.write
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", rows_per_file)
    if not header:
        writer.text(path)
    else:
        (
            writer.option("header", True)
            .option("sep", _NEVER)
            .option("quote", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    return path

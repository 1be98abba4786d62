"""File sources and sinks for click logs.

* Delimited text (the raw log): ``spark.read.text`` + ``split(line, sep, -1)``
  so trailing empty fields survive, then an explicit schema is applied with
  ``try_cast`` (bad text becomes null instead of failing under ANSI mode).
* CSV with a header, read with an explicit schema (inference costs a full extra
  scan and guesses differently per file).
* Parquet feature tables: one table instead of one file per column; reading a
  single column is then plain column pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.functions import split_fields


def write_delimited_text(df: DataFrame, path: str, sep: str = "\t") -> str:
    """Write rows as delimited lines, nulls as empty fields (the raw log layout).

    The layout has no quoting: a value that holds the separator or a line end is
    an error, since it could not be read back."""
    def field(c):
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        broken = F.contains(text, F.lit(sep)) | F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
        return F.when(broken, F.raise_error(F.lit(f"column {c}: separator or line end in a value"))).otherwise(text)

    line = F.concat_ws(sep, *[field(c) for c in df.columns])
    df.select(line.alias("value")).write.mode("errorifexists").text(path)
    return path


def read_delimited_text(spark: SparkSession, path: str, schema: T.StructType,
                        sep: str = "\t", ascii_only: bool = False) -> DataFrame:
    """Parse delimited lines into ``schema``; empty fields become null.

    Fields are positional: field i gets the name and type of schema field i, so
    a file without names (``_1 .. _n``) is typed without an RDD round trip. A line
    with too few fields has nulls in the missing ones; surplus fields are dropped.
    """
    lines = spark.read.text(path)
    value = F.col("value")
    if ascii_only:
        value = F.regexp_replace(value, r"[^\x00-\x7F]", "")
    parts = split_fields(value, sep)
    cols = []
    for i, f in enumerate(schema.fields):
        raw = F.nullif(F.get(parts, F.lit(i)), F.lit(""))
        typed = raw if isinstance(f.dataType, T.StringType) else raw.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
    return lines.select(*cols)


NULL_MARKER = "\\N"   # fixed value: how a null is spelled in CSV files


def _csv_options(rw, header: bool, line_ends: bool):
    """Options shared by the CSV writer and reader: nulls as \\N, no whitespace
    trimming, quotes doubled inside quotes, so null, '' and ' ' survive a round trip,
    and with ``line_ends`` text of several lines does too. Files that may hold such
    text cannot be split: one task reads each of them whole."""
    return (rw.option("header", str(header).lower()).option("nullValue", NULL_MARKER)
              .option("multiLine", str(line_ends).lower()).option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))


def _holds_text(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, T.StringType) for f in schema.fields)


def write_csv(df: DataFrame, path: str, header: bool = True, line_ends: bool = True) -> str:
    """CSV sink with a header. ``line_ends=False``: a line end in a text is an error,
    and the files may be read in splits."""
    if not line_ends:
        def checked(f):
            c = F.col(f"`{f.name}`")
            broken = F.contains(c, F.lit("\n")) | F.contains(c, F.lit("\r"))
            return F.when(broken, F.raise_error(F.lit(f"column {f.name}: line end in a value"))).otherwise(c).alias(f.name)
        df = df.select(*[checked(f) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])
    # empty strings are written quoted ("") so they differ from the null marker
    _csv_options(df.write.mode("errorifexists"), header, line_ends).option("emptyValue", '""').csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, infer: bool = False, line_ends: bool | None = None) -> DataFrame:
    """CSV scan. With ``schema`` no inference pass runs (the production path);
    ``infer=True`` samples the files for types (an extra full pass); otherwise
    every column is a string.

    ``line_ends``: texts may hold line ends, so every file is one task's. By default
    only a schema without text columns rules that out; say False for files written
    with ``line_ends=False``, which any number of tasks read."""
    reader = _csv_options(spark.read, header, (schema is None or _holds_text(schema)) if line_ends is None else line_ends)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_parquet_table(df: DataFrame, path: str, partition_cols=()) -> str:
    w = df.write.mode("errorifexists")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return path


def read_parquet_table(spark: SparkSession, path: str, columns=None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df

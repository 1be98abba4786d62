"""The raw click-log layout: tab-separated, no header.

Training files hold a 0/1 label, then the numeric fields, then the hashed
categorical fields; scoring files are the same without the label. Missing
values are empty fields. Columns can be named positionally (``_1 .. _n``, as
``toDF()`` names them) or by role (``label``, ``I1..``, ``C1..``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.sources.files import read_delimited_text
from clickspark.spec import FeatureSpec

# fixed values: field counts of the click-log layout
N_NUMERIC = 13
N_CATEGORICAL = 26


def click_log_schema(labelled: bool = True, named: bool = True, n_numeric: int = N_NUMERIC,
                     n_categorical: int = N_CATEGORICAL) -> T.StructType:
    roles = ([("label", T.IntegerType())] if labelled else [])
    roles += [(f"I{i + 1}", T.IntegerType()) for i in range(n_numeric)]
    roles += [(f"C{i + 1}", T.StringType()) for i in range(n_categorical)]
    fields = [T.StructField(name if named else f"_{i + 1}", typ, True) for i, (name, typ) in enumerate(roles)]
    return T.StructType(fields)


def content_key(columns, name: str = "row_key") -> Column:
    """A row key from the row's content, for logs without a natural key.
    Identical rows share a key (and therefore a split), which is harmless for
    sampling and splitting; keyed reassembly needs a unique key instead."""
    return F.xxhash64(*[F.col(c) for c in columns]).alias(name)


def read_click_log(spark: SparkSession, path: str, labelled: bool = True, named: bool = True,
                   ascii_only: bool = False, with_key: bool = True, **counts) -> tuple[DataFrame, FeatureSpec]:
    """Typed click log plus its FeatureSpec (key = content hash when ``with_key``)."""
    schema = click_log_schema(labelled, named, **counts)
    df = read_delimited_text(spark, path, schema, "\t", ascii_only=ascii_only)
    names = [f.name for f in schema.fields]
    label = names[0] if labelled else None
    numeric = [f.name for f in schema.fields[1 if labelled else 0:] if isinstance(f.dataType, T.IntegerType)]
    categorical = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    key: tuple[str, ...] = ()
    if with_key:
        df = df.select(content_key(names), *names)
        key = ("row_key",)
    return df, FeatureSpec(key, label or "label", tuple(numeric), tuple(categorical))

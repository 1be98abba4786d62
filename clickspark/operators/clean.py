"""Missing values, blanks, casts and schema alignment.

All rewrites are one ``select`` of native expressions (no Python UDF), so a
40-column clean is a single projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.functions import ascii_only, blank_or_null, strip_ws
from clickspark.spec import FeatureSpec

DUMMY_CATEGORY = "__Dummy__"   # fixed value: the blank-category marker


def _numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_numeric_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``na.fill(0)``: numeric nulls become 0, string columns are untouched."""
    cols = list(columns) if columns is not None else _numeric_columns(df)
    return df.na.fill(0, subset=cols) if cols else df


def clean_blanks(df: DataFrame, spec: FeatureSpec, numeric_type: str = "double") -> DataFrame:
    """Text columns to typed features in one projection.

    numeric:     blank or null -> 0, otherwise ``try_cast`` (unparsable text -> null)
    categorical: blank or null -> '__Dummy__', otherwise the value with whitespace stripped
    """
    out = []
    for c in df.columns:
        if c in spec.numeric:
            out.append(F.when(blank_or_null(c), F.lit(0).cast(numeric_type))
                        .otherwise(strip_ws(F.col(c).cast("string")).try_cast(numeric_type)).alias(c))
        elif c in spec.categorical:
            out.append(F.when(blank_or_null(c), F.lit(DUMMY_CATEGORY)).otherwise(strip_ws(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Blank (whitespace-only) strings become null."""
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.when(~blank_or_null(c), F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def binarize_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """x > 0 -> 1, otherwise (including null) 0."""
    cols = set(columns)
    return df.select(*[F.when(F.col(c) > 0, F.lit(1)).otherwise(F.lit(0)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def impute_mean(df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Nulls replaced by the column mean of the non-null values (MLlib ``Imputer``).

    The fit is one distributed aggregate; only one surrogate per column reaches
    the driver.
    """
    cols = list(columns)
    casted = df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    outs = [f"{c}__imp" for c in cols]
    model = Imputer(inputCols=cols, outputCols=outs, strategy=strategy).fit(casted)
    res = model.transform(casted)
    return res.select(*[F.col(f"{c}__imp").alias(c) if c in cols else F.col(c) for c in df.columns])


def ascii_clean(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Strip non-ASCII characters from a text column (whole texts)."""
    return df.withColumn(out or column, ascii_only(column))


def align_scoring_schema(scoring: DataFrame, spec: FeatureSpec, label_value: int = 0) -> DataFrame:
    """Give an unlabelled, positionally named log the training schema.

    Scoring logs have no label column, so field i of the scoring file is field
    i+1 of the training layout. Fields are renamed in one projection and the
    label is added as a constant.
    """
    train_order = [c for c in spec.columns if c != spec.label]
    if len(scoring.columns) != len(train_order):
        raise ValueError(f"scoring data has {len(scoring.columns)} fields, expected {len(train_order)}")
    renamed = scoring.withColumnsRenamed(dict(zip(scoring.columns, train_order)))
    return renamed.select(*spec.key, F.lit(label_value).cast("int").alias(spec.label), *spec.features)

"""FeatureSpec: explicit column roles instead of positional slices."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the columns of a click table.

    key          natural row key (one or more columns); drives splits and joins
    label        0/1 response column (1 = click)
    numeric      continuous features
    categorical  string-valued features
    """

    key: tuple[str, ...]
    label: str
    numeric: tuple[str, ...] = field(default_factory=tuple)
    categorical: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.numeric) + tuple(self.categorical)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.key) + (self.label,) + self.features


    @classmethod
    def from_schema(cls, df: DataFrame, label: str, key, exclude=()) -> "FeatureSpec":
        """Resolve roles from column types (replaces ``df.columns[a:b]`` slicing).

        Numeric types become numeric features, strings become categorical; the
        key, the label and ``exclude`` are left out.
        """
        key = (key,) if isinstance(key, str) else tuple(key)
        skip = set(key) | {label} | set(exclude)
        numeric, categorical = [], []
        for f in df.schema.fields:
            if f.name in skip:
                continue
            if isinstance(f.dataType, _NUMERIC):
                numeric.append(f.name)
            elif isinstance(f.dataType, T.StringType):
                categorical.append(f.name)
        return cls(key, label, tuple(numeric), tuple(categorical))

"""Running Python code of this package inside Spark tasks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once per application.

    The sources go out as a zip through Spark's own file distribution
    (``addPyFile``), so executors need no installed copy and no shared path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="clickspark-py-")) / "clickspark.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package importable in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)

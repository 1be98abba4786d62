"""clickspark: click-through-rate analytics and binary-response modelling on Spark.

Every operator is a function from DataFrame (plus a FeatureSpec where column
roles matter) to DataFrame, built from Spark SQL expressions and Spark ML
estimators. Sub-packages:

* ``sources``    -- table, text, TSV and CSV readers and sinks
* ``functions``  -- column expressions (strip, hashing, sigmoid, entropy ...)
* ``operators``  -- cleaning, profiling, sampling, encoding, selection,
                    evaluation, models and tuning
* ``plans``      -- feature sets over the driver tables and the query registry
* ``streaming``  -- Structured Streaming variants (incremental CTR, scoring)
"""

from clickspark.spec import FeatureSpec

__all__ = ["FeatureSpec"]

"""Score arriving logs with a fitted pipeline and model.

The feature pipeline and the classifier are stateless transformers, so the
stream is a plain projection: new files -> features -> model -> append sink.
Exactly-once output comes from the file sink's commit log in the checkpoint.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_stream(stream: DataFrame, pipeline, model, key, sink_path: str, checkpoint_path: str,
                 available_now: bool = True):
    """Start (and, with ``available_now``, finish) a scoring query; returns the query."""
    scored = model.transform(pipeline.transform(stream))
    out = scored.select(*key, F.col("prediction"),
                        vector_to_array(F.col("rawPrediction"))[1].alias("score"))
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint_path))
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q

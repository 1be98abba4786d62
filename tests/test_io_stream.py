"""Sources, sinks, feature roles, one-hot and the streaming operators."""

import pytest
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from clickspark.operators import encode
from clickspark.plans.featuresets import FS_E, events_clicks, events_to_clicks
from clickspark.session import scratch_path
from clickspark.sources import files, read_table
from clickspark.spec import FeatureSpec
from clickspark.streaming import run_hourly_ctr
from conftest import SF_SMALL


def test_feature_spec_from_schema(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    got = FeatureSpec.from_schema(df, label="label", key="event_id")
    assert got.numeric == FS_E.numeric and got.categorical == FS_E.categorical
    assert got.columns == spec.columns


def test_csv_without_schema_is_strings_and_inference_types(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    path = files.write_csv(df.select(*spec.columns), scratch_path(spark, "csv"))
    raw = files.read_csv(spark, path)
    assert all(t == "string" for _, t in raw.dtypes)
    inferred = dict(files.read_csv(spark, path, infer=True).dtypes)
    assert inferred["value"] == "double" and inferred["k"] == "int" and inferred["uid"] == "int"
    assert raw.count() == df.count()


def test_one_hot_long_matches_onehotencoder(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    index = encode.index_category(df, spec.categorical)
    sizes = encode.label_sizes(index)
    enc = encode.apply_category_index(df, index, spec.categorical)
    ours = {(r["event_id"], r["feature"], r["slot"]) for r in
            encode.one_hot_long(enc, spec.key, spec.categorical, sizes).collect()}
    # MLlib with the same sizes: index columns carry no metadata, so pass the width via a max row
    ohe = OneHotEncoder(inputCols=[c + "_idx" for c in spec.categorical],
                        outputCols=[c + "_oh" for c in spec.categorical], dropLast=True, handleInvalid="keep")
    model = ohe.fit(enc)
    theirs = set()
    for r in model.transform(enc).select("event_id", *[c + "_oh" for c in spec.categorical]).collect():
        for c in spec.categorical:
            for i in r[c + "_oh"].indices:
                theirs.add((r["event_id"], c, int(i)))
    assert ours == theirs


def _set_arrival_order(folder, parts):
    """The file source takes new files in modification-time order; make it explicit."""
    import glob
    import os
    import time
    base = time.time() - 3600
    for i, part in enumerate(parts):
        for f in glob.glob(os.path.join(folder.replace("file:", ""), part, "*.parquet")):
            os.utime(f, (base + 60 * i, base + 60 * i))


def _hourly_batch(ev):
    return {r["w"]: (r["n"], r["c"]) for r in ev.groupBy(F.date_trunc("hour", "ts").cast("string").alias("w"))
            .agg(F.count("*").alias("n"), F.sum((F.col("event_type") == "click").cast("int")).alias("c")).collect()}


def test_stream_ctr_over_several_batches(spark):
    ev = read_table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "events-stream")
    # files arrive in event-time order; the cuts fall inside an hour, so that
    # hour's window is opened by one micro-batch and updated by the next
    cuts = ["2024-01-01 00:00:00", "2024-01-11 00:30:00", "2024-01-21 12:15:00", "2100-01-01 00:00:00"]
    for i in range(3):
        (ev.where((F.col("ts") >= F.lit(cuts[i]).cast("timestamp_ntz")) &
                  (F.col("ts") < F.lit(cuts[i + 1]).cast("timestamp_ntz")))
           .coalesce(1).write.parquet(f"{folder}/part{i}"))
    _set_arrival_order(folder, ["part0", "part1", "part2"])
    got = {r["window_start"]: (r["n"], r["clicks"]) for r in
           run_hourly_ctr(spark, f"{folder}/part*", max_files_per_trigger=1).collect()}
    assert got == _hourly_batch(ev)
    assert events_to_clicks(ev).count() == ev.count()


def test_stream_ctr_counts_late_data(spark):
    ev = read_table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "events-late")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    ev.where(F.col("ts") >= cut).coalesce(1).write.parquet(f"{folder}/part0")
    ev.where(F.col("ts") < cut).coalesce(1).write.parquet(f"{folder}/part1")   # arrives 10+ days late
    _set_arrival_order(folder, ["part0", "part1"])
    got = {r["window_start"]: (r["n"], r["clicks"]) for r in
           run_hourly_ctr(spark, f"{folder}/part*", max_files_per_trigger=1).collect()}
    assert got == _hourly_batch(ev)


def test_watermarked_running_aggregate(spark):
    from clickspark.streaming import hourly_ctr_stream
    ev = read_table(spark, SF_SMALL, "events")
    got = {str(r["window_start"]): (r["n"], r["clicks"]) for r in hourly_ctr_stream(ev).collect()}
    assert got == _hourly_batch(ev)


def test_stream_scoring_query_rows(spark):
    from clickspark.plans.queries import QUERIES
    out = QUERIES["stream_scoring"](spark, SF_SMALL)
    assert out.count() == read_table(spark, SF_SMALL, "events").count()
    assert set(out.columns) == {"event_id", "prediction", "score"}


def test_stream_ctr_empty_source(spark):
    ev = read_table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "events-empty")
    ev.where(F.lit(False)).coalesce(1).write.parquet(f"{folder}/part0")
    out = run_hourly_ctr(spark, f"{folder}/part*")
    assert out.count() == 0 and out.columns == ["window_start", "n", "clicks", "ctr"]


def test_watermarked_running_aggregate_as_stream(spark):
    from clickspark.streaming import file_stream, hourly_ctr_stream
    ev = read_table(spark, SF_SMALL, "events")
    folder = scratch_path(spark, "events-live")
    cuts = ["2024-01-01 00:00:00", "2024-01-15 06:30:00", "2100-01-01 00:00:00"]
    for i in range(2):
        (ev.where((F.col("ts") >= F.lit(cuts[i]).cast("timestamp_ntz")) &
                  (F.col("ts") < F.lit(cuts[i + 1]).cast("timestamp_ntz")))
           .coalesce(1).write.parquet(f"{folder}/part{i}"))
    _set_arrival_order(folder, ["part0", "part1"])
    q = (hourly_ctr_stream(file_stream(spark, f"{folder}/part*", 1)).writeStream.outputMode("update")
         .format("memory").queryName("live_ctr").option("checkpointLocation", scratch_path(spark, "live-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("SELECT * FROM live_ctr").collect()
    # update mode emits running values; with in-order input the last value per window is the total
    final = {}
    for r in rows:
        k = str(r["window_start"])
        final[k] = max(final.get(k, (0, 0)), (r["n"], r["clicks"]))
    assert final == _hourly_batch(ev)
    assert len(rows) >= len(final)


def test_csv_of_one_large_file_is_read_in_splits(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, null, concat('a \"b\", ', id)) as t", "id / 7 as x").coalesce(1)
    path = files.write_csv(rows, str(tmp_path / "one"), line_ends=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        split = files.read_csv(spark, path, rows.schema, line_ends=False)
        assert split.rdd.getNumPartitions() > 4 and files.read_csv(spark, path, rows.schema).rdd.getNumPartitions() == 1
        assert split.exceptAll(rows).count() == 0 and split.count() == 60_000
        numbers = files.write_csv(rows.select("id", "x"), str(tmp_path / "numbers"))
        assert files.read_csv(spark, numbers, rows.select("id", "x").schema).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(Exception, match="line end"):
        files.write_csv(spark.createDataFrame([("a\nb",)], "t string"), str(tmp_path / "broken"), line_ends=False)

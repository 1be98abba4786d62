"""Inputs that once gave a wrong answer."""

import math

import pytest
from pyspark.sql import functions as F

from clickspark.operators import encode, profile, rowid, sample, select, theory
from clickspark.session import scratch_path
from clickspark.sources import files
from clickspark.spec import FeatureSpec

SPEC = FeatureSpec(key=("a", "b"), label="y", numeric=(), categorical=("c",))


def test_log_loss_keeps_certain_rows(spark):
    loss = lambda rows: theory.log_loss(spark.createDataFrame(rows, "label int, probability double")).first()
    assert loss([(1, 1.0), (0, 1.0), (1, 0.5)]).log_loss == math.inf
    assert loss([(1, 1.0), (0, 0.0), (1, 0.5)]).log_loss == pytest.approx(math.log(2) / 3)
    assert loss([(1, 0.5), (None, 0.2), (1, None)]).log_loss == pytest.approx(math.log(2))


def test_reassembly_of_a_repeated_key_is_an_error(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y")], "k int, s string")
    right = spark.createDataFrame([(1, 10), (1, 5)], "k int, n int")
    with pytest.raises(Exception, match="repeats inside one piece"):
        rowid.reassemble_by_key([left, right], ["k"]).collect()
    ok = rowid.reassemble_by_key([left.limit(1), spark.createDataFrame([(2, 10)], "k int, n int")], ["k"])
    assert sorted(map(tuple, ok.collect())) == [(1, "x", None), (2, None, 10)]


@pytest.mark.parametrize(("fraction", "part"), [(1.0, "train"), (0.0, "test")])
def test_split_fractions_at_the_ends(spark, fraction, part):
    df = spark.range(500).select(F.col("id").alias("a"), F.lit(1).alias("b"), F.lit(0).alias("y"))
    assert {r.split for r in sample.hash_split(df, SPEC, fraction).select("split").distinct().collect()} == {part}


def test_null_keys_are_sampled_split_and_folded(spark):
    df = spark.createDataFrame([(None, 1, 1), (1, None, 0), (None, None, 1)], "a int, b int, y int")
    assert sample.hash_sample(df, SPEC, 1.0).count() == 3
    assert all(r.fold is not None for r in sample.kfold_assign(df, SPEC).collect())
    assert {r.split for r in sample.hash_split(df, SPEC, 1.0).collect()} == {"train"}


def test_label_index_of_one_class(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, None)], "a int, b int, y int")
    assert [r.label_idx for r in encode.index_label(df, SPEC).orderBy("a").collect()] == [1.0, 1.0, None]


def test_short_lines_have_nulls(spark):
    path = scratch_path(spark, "short")
    spark.createDataFrame([("1\tx\t5",), ("2",), ("",)], "value string").coalesce(1).write.text(path)
    rows = files.read_delimited_text(spark, path, spark.createDataFrame([], "a int, s string, n int").schema).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "x", 5), (2, None, None), (None, None, None)]


def test_csv_round_trip_of_awkward_text(spark):
    df = spark.createDataFrame([(1, "two\nlines"), (2, 'a "quoted", b\\'), (3, ""), (4, " "), (5, None), (6, "\r\n,\t"), (7, '"')], "a int, s string")
    path = files.write_csv(df, scratch_path(spark, "csv"))
    back = files.read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_delimited_text_refuses_what_it_cannot_hold(spark):
    with pytest.raises(Exception, match="separator or line end"):
        files.write_delimited_text(spark.createDataFrame([("a\tb",)], "s string"), scratch_path(spark, "tab"))


def test_decimals_are_counted_exactly(spark):
    df = spark.sql("select explode(array(12345678901234567890.01BD, 12345678901234567890.02BD)) as d")
    assert profile.distinct_all_fields(df).first().n_distinct == 2


def test_chi_square_of_one_class_and_null_labels(spark):
    df = spark.createDataFrame([(1, 1, 1, "x"), (2, 1, 1, "y"), (3, 1, None, "z")], "a int, b int, y int, c string")
    r = select.chi_square_stat(df, SPEC, ["c"]).first()
    assert r.statistic == pytest.approx(0.0) and r.dof == 0

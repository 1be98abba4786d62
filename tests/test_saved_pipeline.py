"""A saved model carries its category index; the index is applied in two shuffles."""

import re
import shutil
import subprocess
import sys
import textwrap

from clickspark.operators import encode, models
from clickspark.plans.featuresets import events_clicks
from conftest import SF_SMALL
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F


def _fitted(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    prep = models.prepare(df, spec)
    return df, spec, prep, models.full_model(prep, models.train(prep, "lr", maxIter=5))


def test_saved_model_outlives_its_scratch_folder_and_session(spark, tmp_path):
    df, spec, prep, model = _fitted(spark)
    want = sorted(tuple(r) for r in models.score(model, df, spec).collect())
    model.write().save(str(tmp_path / "model"))
    model.write().overwrite().save(str(tmp_path / "model"))
    prep.unpersist()
    shutil.rmtree(model.stages[0].getOrDefault("indexPath").removeprefix("file:"))
    shutil.move(tmp_path / "model", tmp_path / "moved")
    again = PipelineModel.load(str(tmp_path / "moved"))
    assert sorted(tuple(r) for r in models.score(again, df, spec).collect()) == want
    again.write().save(str(tmp_path / "third"))             # a loaded model can be saved too
    shutil.rmtree(tmp_path / "moved")
    code = textwrap.dedent(f"""
        from clickspark.session import local_session
        from clickspark.operators import models
        from clickspark.plans.featuresets import events_clicks
        from pyspark.ml import PipelineModel
        spark = local_session(2)
        df, spec = events_clicks(spark, "{SF_SMALL}")
        out = models.score(PipelineModel.load("{tmp_path}/third"), df, spec)
        out.write.parquet("{tmp_path}/scores")
        """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "scores")).collect())
    assert got == want


def _stored(spark, df, columns, tmp_path):
    return encode.load_index(spark, encode.store_index(encode.index_category(df, columns), str(tmp_path / "index")))


def test_wide_columns_take_two_shuffles_whatever_their_number(spark, tmp_path):
    facts = spark.range(3000).selectExpr("id", *[f"cast(id % {7 + i} as string) as c{i}" for i in range(8)])
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    index = _stored(spark, facts, [f"c{i}" for i in range(8)], tmp_path)
    exchanges = []
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    for n in (2, 8):
        out = encode.apply_category_index(facts, index, [f"c{i}" for i in range(n)], max_broadcast_bytes=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert sum(k.startswith("digest") for k in found) == 1 and sum("salt" in k for k in found) == 2     # rows, index
        exchanges.append([re.sub(r"#\d+L?", "", k) for k in found])
        assert len(re.findall(r"FileScan parquet \[id", plan)) == 1
    for k, v in before.items():
        spark.conf.set(k, v)
    assert exchanges[0] == exchanges[1]                     # the rows' two, and those of the index itself


def test_wide_and_broadcast_agree_on_odd_rows(spark, tmp_path):
    rows = [(1, "a", None, 0.0, b"\x00"), (1, "a", None, -0.0, b"\x00"), (1, "a", None, 0.0, b"\x00"), (2, None, None, None, None),
            (2, None, None, None, None), (3, "", " ", float("nan"), b""), (4, "unseen", "1:a", 1.5, b"1"), (None, "a:1", "-", 2.5, None)]
    df = spark.createDataFrame(rows * 3, "digest long, `value` string, `feature` string, salt double, row binary")
    hot = df.unionByName(spark.range(2000).selectExpr("id as digest", "'hot' as value", "'hot' as feature", "1.0 as salt", "cast(null as binary) as row"))
    hot = hot.unionByName(spark.range(900).selectExpr("-1L as digest", "'hot' as value", "'b' as feature", "2.0 as salt", "cast(null as binary) as row"))
    index = _stored(spark, hot.where("value is null or value <> 'unseen'"), ["value", "feature"], tmp_path)
    show = lambda d: sorted(map(repr, d.collect()))
    narrow = encode.apply_category_index(hot, index, ["value", "feature"])
    for few in (0, 40):                                     # every column in long form, none but the small one
        wide = encode.apply_category_index(hot, index, ["value", "feature"], max_broadcast_bytes=few)
        assert wide.columns == narrow.columns and show(wide) == show(narrow)
    empty = encode.apply_category_index(hot.limit(0), index, ["value", "feature"], max_broadcast_bytes=0)
    assert empty.count() == 0
    dropped = encode.apply_category_index(hot, index, ["value"], max_broadcast_bytes=0, drop_source=True)
    assert dropped.columns == ["digest", "feature", "salt", "row", "value_idx"] and dropped.count() == hot.count()


def test_broadcasts_are_bounded_by_their_sum(spark, tmp_path):
    facts = spark.range(500).selectExpr("id", "cast(id as string) as a", "cast(id as string) as b", "repeat(cast(id % 3 as string), 5000) as c")
    index = _stored(spark, facts, ["a", "b", "c"], tmp_path)
    sizes = {c: b for c, (_, b) in encode._index_bytes(index).items()}
    assert sizes["c"] > 15_000                              # few labels, many bytes
    plan = lambda n: encode.apply_category_index(facts, index, ["a", "b", "c"], max_broadcast_bytes=n)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(digest" not in plan(sum(sizes.values()))
    assert "hashpartitioning(digest" in plan(sum(sizes.values()) - 1)


def test_one_hot_equals_mllib_and_stays_sparse(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    df = df.withColumn("uid", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("uid")))
    train = df.where("event_id % 3 <> 0")
    ours = encode.fit_category_index(train, spec.categorical).transform(df)
    ours = encode.one_hot_encoder(spec.categorical).fit(ours).transform(ours)
    theirs = df
    for c in spec.categorical:
        theirs = StringIndexer(inputCol=c, outputCol=c + "_idx", handleInvalid="keep", stringOrderType="frequencyDesc").fit(train.where(F.col(c).isNotNull())).transform(theirs)
        theirs = OneHotEncoder(inputCol=c + "_idx", outputCol=c + "_vec", dropLast=True).fit(theirs).transform(theirs)
    cols = ["event_id", *[c + "_vec" for c in spec.categorical]]
    assert sorted(map(repr, ours.select(cols).collect())) == sorted(map(repr, theirs.select(cols).collect()))


def test_one_hot_training_holds_no_dense_vector(spark):
    rows = spark.range(4000).selectExpr("id", "cast(id % 2000 < 1000 as int) as label", "cast(id % 10 as double) as x", "cast(id % 2000 as string) as who")
    spec = models.FeatureSpec(("id",), "label", ("x",), ("who",))
    prep = models.prepare(rows, spec, one_hot=True)
    try:
        vec = prep.train.select(models.FEATURES).first()[0]
        assert type(vec).__name__ == "SparseVector" and vec.size > 1500 and len(vec.indices) <= 2
        result = models.train(prep, "lr", regParam=0.001)
        auc = models.evaluate(result, spec).where("metric = 'auc_test'").first()["value"]
        assert auc > 0.75                                   # the label hangs on the category alone
    finally:
        prep.unpersist()


def test_written_features_are_the_only_copy(spark):
    df, spec = events_clicks(spark, SF_SMALL)
    prep = models.prepare(df, spec, materialize="write")
    assert not prep.train.is_cached and not prep.test.is_cached and prep.train.count() + prep.test.count() == df.count()


def test_wide_index_looks_up_combinations_not_rows(spark):
    """Rows that agree in every wide column meet the index once, however many they are."""
    df = spark.range(0, 20_000, 1, 4).select("id", (F.col("id") % 3).cast("string").alias("a"),
                                             F.when(F.col("id") % 5 != 0, (F.col("id") % 5).cast("string")).alias("b"))
    df = df.unionByName(df.where("id < 7"))                            # rows that come twice
    index = encode.index_category(df.where("id % 5 != 4"), ["a", "b"])  # b = 4 is unseen
    wide = encode.apply_category_index(df, index, ["a", "b"], max_broadcast_bytes=0)
    narrow = encode.apply_category_index(df, index, ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, narrow.collect()))
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    generated = [line for line in plan.splitlines() if "Generate explode(array(" in line]
    assert generated and all("row" not in line for line in generated)
    assert plan.count("Generate explode(array(") == 1


def test_wide_index_spreads_a_frequent_combination(spark, monkeypatch):
    monkeypatch.setattr(encode, "SALT_ROWS", 100)
    df = spark.range(0, 3_000, 1, 3).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("x").alias("a"))
    index = encode.index_category(df, ["a"])
    out = encode.apply_category_index(df, index, ["a"], max_broadcast_bytes=0)
    known = {r["value"]: r["idx"] for r in index.collect()}
    rows = out.collect()
    assert sorted(r["id"] for r in rows) == list(range(3_000)) and all(r["a_idx"] == known[r["a"]] for r in rows)

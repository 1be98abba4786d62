"""The raw click-log layout (FIXTURES F1/F2) end to end on a seeded fixture."""

import random

from pyspark.sql import functions as F

from clickspark.operators import clean, models, profile, sample
from clickspark.session import scratch_path
from clickspark.sources import click_log_schema, read_click_log


def _lines(n=400, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        label = 1 if rnd.random() < 0.3 else 0
        nums = ["" if rnd.random() < 0.2 else str(rnd.randint(0, 50 + 40 * label)) for _ in range(13)]
        cats = ["" if rnd.random() < 0.15 else format(rnd.randint(0, 9 if j else 3), "08x") for j in range(26)]
        if i == 5:
            cats[3] = "café"            # one non-ASCII category
        line = "\t".join([str(label)] + nums + cats)
        if i % 10 == 0:
            line = "\t".join([str(label)] + nums + cats[:-1] + [""])   # row ends in a tab
        out.append(line)
    return out


def _write(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2).write.text(path)
    return path


def test_schema_layouts():
    s = click_log_schema()
    assert len(s.fields) == 40 and s.fields[0].name == "label" and s.fields[14].name == "C1"
    p = click_log_schema(labelled=False, named=False)
    assert len(p.fields) == 39 and p.fields[0].name == "_1" and str(p.fields[13].dataType) == "StringType()"


def test_read_profile_and_train(spark):
    lines = _lines()
    df, spec = read_click_log(spark, _write(spark, lines, "clicklog"), ascii_only=True)
    assert df.count() == len(lines)
    assert len(spec.numeric) == 13 and len(spec.categorical) == 26
    nulls = {r["feature"]: r["n_null"] for r in profile.null_profile(df).collect()}
    assert nulls["I1"] > 0 and nulls["C26"] >= len(lines) // 10
    assert df.where(F.col("C4") == "caf").count() == 1          # non-ASCII stripped
    bal = profile.class_balance(df, spec).first()
    assert bal["n_pos"] + bal["n_neg"] == len(lines)
    filled = clean.fill_numeric_zero(df, list(spec.numeric))
    assert filled.where(F.col("I1").isNull()).count() == 0
    tr, te = sample.train_test(df, spec)
    assert tr.count() + te.count() == len(lines)
    prep = models.prepare(df, spec)
    try:
        m = {r["metric"]: r["value"] for r in models.evaluate(models.train(prep, "lr"), spec).collect()}
        assert m["auc_test"] > 0.6          # numerics carry the label signal
    finally:
        prep.unpersist()


def test_scoring_file_aligns_to_training_layout(spark):
    lines = ["\t".join(x.split("\t")[1:]) for x in _lines(50)]
    df, spec = read_click_log(spark, _write(spark, lines, "scorelog"), labelled=False, named=False,
                              with_key=False)
    assert len(df.columns) == 39
    from clickspark.spec import FeatureSpec
    target = FeatureSpec((), "label", tuple(f"I{i + 1}" for i in range(13)), tuple(f"C{i + 1}" for i in range(26)))
    aligned = clean.align_scoring_schema(df, target)
    assert aligned.columns[0] == "label" and aligned.columns[1] == "I1" and len(aligned.columns) == 40
    assert aligned.where(F.col("label") != 0).count() == 0

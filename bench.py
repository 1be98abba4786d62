"""Benchmark: headline queries and the end-to-end CTR pipeline at $BENCH_SF_DIR.

Prints ONE JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

* ``queries``: registered queries, each forced with a ``noop`` sink (full
  execution, nothing collected), plus ``stage_*`` timings of the pipeline whose
  stages mirror the reference's published timings (encode/reassemble, scaler
  fit, split + counts, class weights, four classifiers trained and evaluated).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ctr_by_category", "class_balance", "describe_all_fields", "null_profile", "category_frequency",
    "histogram_numeric", "correlation_matrix", "skew_profile", "clean_blanks", "index_category",
    "encoded_feature_table", "standard_scale", "hash_split", "kfold_assign", "stable_row_id",
    "reassemble_by_row_id", "chi_square_stat", "information_gain", "auc_exact", "roc_curve",
    "weighted_metrics", "top_confident_negatives", "csv_roundtrip", "ascii_clean", "ctr_stream_hourly",
    "limit_extract", "encoded_feature_table_long", "saved_feature_pipeline", "drop_correlated", "best_threshold",
    "permutation_importance", "stratified_sample_exact", "sketch_profile", "select_fpr", "stream_scoring",
    "compare_classifiers_sample",
]


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def run_queries(spark, sf_dir, names):
    from clickspark.plans.queries import QUERIES
    out = {}
    for name in names:
        t0 = time.time()
        _force(QUERIES[name](spark, sf_dir))
        out[name] = round(time.time() - t0, 3)
    return out


def run_pipeline(spark, sf_dir):
    """Stages of the reference's full run, on the lineitem click table."""
    from pyspark.sql import functions as F

    from clickspark.operators import encode, models
    from clickspark.operators.evaluate import auc_exact
    from clickspark.plans.featuresets import lineitem_returns

    out = {}
    t0 = time.time()
    df, spec = lineitem_returns(spark, sf_dir)
    index = encode.index_category(df, spec.categorical)
    enc = encode.apply_category_index(df, index, spec.categorical)
    enc.write.format("noop").mode("overwrite").save()
    out["stage_encode"] = round(time.time() - t0, 3)

    t0 = time.time()
    prep = models.prepare(df, spec)         # split, fit pipeline (indexer + assembler + scaler) on train, weights
    n_train, n_test = prep.train.count(), prep.test.count()
    out["stage_split_scale_weights"] = round(time.time() - t0, 3)

    t0 = time.time()
    prep.train.groupBy("label").agg(F.sum(models.WEIGHT)).collect()
    out["stage_weight_check"] = round(time.time() - t0, 3)

    for kind in ("lr", "rf", "gbt", "lsvc"):
        t0 = time.time()
        res = models.train(prep, kind, **models.REFERENCE_PARAMS[kind])
        auc_exact(res.pred_test, models.LABEL, models.score_column(kind)).collect()
        out[f"stage_train_eval_{kind}"] = round(time.time() - t0, 3)
    prep.unpersist()
    out["_rows_train"], out["_rows_test"] = n_train, n_test
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from clickspark.session import local_session
    spark = local_session(cpus)
    t_all = time.time()
    # JVM start-up, JIT and the first Python worker are not query time: one
    # untimed pass over a table (reported separately as warmup_sec)
    from clickspark.sources import read_table
    read_table(spark, sf_dir, "events").groupBy("event_type").count().collect()
    warmup = round(time.time() - t_all, 3)
    timings = run_queries(spark, sf_dir, HEADLINE)
    pipe = run_pipeline(spark, sf_dir)
    rows = {k: v for k, v in pipe.items() if k.startswith("_")}
    timings.update({k: v for k, v in pipe.items() if not k.startswith("_")})
    total = round(sum(timings.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": timings,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "wall_sec": round(time.time() - t_all, 3), "warmup_sec": warmup,
                      "pipeline_rows": {"train": rows.get("_rows_train"), "test": rows.get("_rows_test")}}))
    spark.stop()


if __name__ == "__main__":
    main()

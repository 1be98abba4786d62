"""Named queries over the driver tables, each with its DuckDB twin where SQL can
express it.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB
SQL over the pre-registered views). Doubles are rounded on both sides, every
computed column is aliased identically, counts are bigint on both sides.
Model fits have no twin (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.operators import (
    clean,
    collinear,
    encode,
    evaluate,
    importance,
    models,
    profile,
    rowid,
    sample,
    select,
    sketches,
    splits,
    theory,
    tuning,
)
from clickspark.plans.featuresets import (
    FS_D,
    FS_E,
    FS_L,
    SQL_FS_D,
    SQL_FS_E,
    SQL_FS_L,
    documents_toxic,
    events_clicks,
    events_to_clicks,
    lineitem_returns,
)
from clickspark.session import scratch_path
from clickspark.sources import files, read_table
from clickspark.spec import FeatureSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (both sides of the oracle compare do the same)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _union(fs: str, cols, select_fmt: str, where: str = "") -> str:
    """UNION ALL of one SELECT per column; ``select_fmt`` uses {c} for the column name."""
    parts = [f"SELECT {select_fmt.format(c=c)} FROM {fs}{(' WHERE ' + where.format(c=c)) if where else ''}"
             for c in cols]
    return "\nUNION ALL\n".join(parts)


E_NUM, E_CAT = list(FS_E.numeric), list(FS_E.categorical)
L_NUM, L_CAT = list(FS_L.numeric), list(FS_L.categorical)
L_KEY = list(FS_L.key)
L_KEY_SQL = ", ".join(L_KEY)
E_COLS = ", ".join(FS_E.columns)
_L_SPLIT = ("CASE WHEN substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), "
            "CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_shipdate) || '-2019'), 1, 4) < 'b333' "
            "THEN 'train' ELSE 'test' END")
L_COLS = ", ".join(FS_L.columns)

# ---------------------------------------------------------------------------
# 2.5 counts, balance, CTR
# ---------------------------------------------------------------------------


@register("row_count", _with(SQL_FS_L) + "SELECT count(*) AS n_rows FROM fs_l")
def q_row_count(spark, sf):
    df, _ = lineitem_returns(spark, sf)
    return profile.row_count(df)


@register("label_counts", _with(SQL_FS_E) + "SELECT label, count(*) AS n FROM fs_e GROUP BY label")
def q_label_counts(spark, sf):
    df, spec = events_clicks(spark, sf)
    return profile.label_counts(df, spec)


@register("class_balance", _with(SQL_FS_L) + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label <> 1) AS n_neg,
       round(avg(CAST(label = 1 AS DOUBLE)) * 100.0, 6) AS pct_pos
FROM fs_l""")
def q_class_balance(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(profile.class_balance(df, spec))


@register("ctr_overall", _with(SQL_FS_E) + """
SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_clicks, round(avg(CAST(label AS DOUBLE)), 6) AS ctr
FROM fs_e""")
def q_ctr_overall(spark, sf):
    df, spec = events_clicks(spark, sf)
    return rounded(profile.ctr_overall(df, spec))


_CTR_BY_CAT_SQL = _with(SQL_FS_E) + f"""
SELECT feature, value, count(*) AS n, CAST(sum(label) AS BIGINT) AS clicks, round(avg(CAST(label AS DOUBLE)), 6) AS ctr
FROM ({_union('fs_e', E_CAT, "'{c}' AS feature, CAST({c} AS VARCHAR) AS value, label")}) t
GROUP BY feature, value"""


@register("ctr_by_category", _CTR_BY_CAT_SQL)
def q_ctr_by_category(spark, sf):
    df, spec = events_clicks(spark, sf)
    return rounded(profile.ctr_by_category(df, spec))


# ---------------------------------------------------------------------------
# 2.5 describe / nulls / categories
# ---------------------------------------------------------------------------


@register("describe_numeric", _with(SQL_FS_L) + _union(
    "fs_l", L_NUM,
    "'{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
    "round(CAST(min({c}) AS DOUBLE), 6) AS min_value, round(CAST(max({c}) AS DOUBLE), 6) AS max_value"))
def q_describe_numeric(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(profile.describe_numeric(df, spec.numeric))


_FS_L_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_shipdate": "string",
               "label": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
               "l_tax": "double"}


def _describe_all_sql() -> str:
    parts = []
    for c in FS_L.columns:
        t = _FS_L_TYPES.get(c, "string")
        d = f"CAST({c} AS DOUBLE)"
        none = "CAST(NULL AS {0}) AS {1}"
        stats = ([none.format("DOUBLE", k) for k in ("mean", "stddev", "min_value", "max_value")]
                 + [f"min({c}) AS min_str", f"max({c}) AS max_str"] if t == "string" else
                 [f"round(avg({d}), 6) AS mean", f"round(stddev_samp({d}), 6) AS stddev",
                  f"round(min({d}), 6) AS min_value", f"round(max({d}), 6) AS max_value"]
                 + [none.format("VARCHAR", k) for k in ("min_str", "max_str")])
        parts.append(f"SELECT '{c}' AS feature, '{t}' AS dtype, count({c}) AS n_non_null, "
                     f"count(*) - count({c}) AS n_null, {', '.join(stats)} FROM fs_l")
    return _with(SQL_FS_L) + "\nUNION ALL\n".join(parts)


@register("describe_all_fields", _describe_all_sql())
def q_describe_all_fields(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(profile.describe_all_fields(df, list(spec.columns)))


@register("distinct_all_fields", _with(SQL_FS_L) + _union(
    "fs_l", list(FS_L.columns), "'{c}' AS feature, count(DISTINCT {c}) AS n_distinct"))
def q_distinct_all_fields(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return profile.distinct_all_fields(df, list(spec.columns))


@register("null_profile", _with(SQL_FS_L) + _union(
    "fs_l", list(FS_L.columns),
    "'{c}' AS feature, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
    "round((count(*) - count({c})) * 100.0 / count(*), 6) AS pct_null"))
def q_null_profile(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(profile.null_profile(df, list(spec.columns)))


@register("category_frequency", _with(SQL_FS_L) + f"""
SELECT feature, value, count(*) AS n
FROM ({_union('fs_l', L_CAT, "'{c}' AS feature, CAST({c} AS VARCHAR) AS value")}) t
GROUP BY feature, value""")
def q_category_frequency(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return profile.category_frequency(df, spec.categorical)


@register("category_cardinality", _with(SQL_FS_L) + _union(
    "fs_l", L_CAT, "'{c}' AS feature, count(DISTINCT {c}) AS n_distinct"))
def q_category_cardinality(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return profile.category_cardinality(df, spec.categorical)


# ---------------------------------------------------------------------------
# 2.5 histograms, correlation, shape
# ---------------------------------------------------------------------------


def _hist_sql(fs: str, cte: str, cols, bins: int, by: str | None = None) -> str:
    rng = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in cols)
    byc = f"{by}, " if by else ""
    parts = []
    for c in cols:
        b = (f"CASE WHEN hi_{c} = lo_{c} THEN CAST(0 AS BIGINT) ELSE least(CAST({bins - 1} AS BIGINT), "
             f"CAST(floor((CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) * {float(bins)}) AS BIGINT)) END")
        parts.append(f"SELECT '{c}' AS feature, {byc}{b} AS bin, count(*) AS n FROM {fs}, rng "
                     f"WHERE {c} IS NOT NULL GROUP BY ALL")
    return _with(cte, f"rng AS (SELECT {rng} FROM {fs})") + "\nUNION ALL\n".join(parts)


@register("histogram_numeric", _hist_sql("fs_e", SQL_FS_E, E_NUM, 50))
def q_histogram_numeric(spark, sf):
    df, spec = events_clicks(spark, sf)
    return profile.histogram_numeric(df, spec.numeric, 50)


@register("histogram_by_label", _hist_sql("fs_e", SQL_FS_E, E_NUM, 25, by="label"))
def q_histogram_by_label(spark, sf):
    df, spec = events_clicks(spark, sf)
    return profile.histogram_by_label(df, spec, bins=25)


def _corr_sql(fs: str, cte: str, cols, where: str = "", threshold: float | None = None) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    w = f" WHERE {where}" if where else ""
    body = "\nUNION ALL\n".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM {fs}{w}"
                                for a, b in pairs)
    if threshold is not None:
        body = f"SELECT * FROM ({body}) t WHERE abs(corr) > {threshold}"
    return _with(cte) + body


@register("correlation_matrix", _corr_sql("fs_l", SQL_FS_L, L_NUM))
def q_correlation_matrix(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(profile.correlation_matrix(df, spec.numeric))


@register("correlation_clicked", _corr_sql("fs_e", SQL_FS_E, E_NUM, where="label = 1"))
def q_correlation_clicked(spark, sf):
    df, spec = events_clicks(spark, sf)
    return rounded(profile.correlation_matrix(df.where(F.col(spec.label) == 1), spec.numeric))


@register("correlated_pairs", _corr_sql("fs_l", SQL_FS_L, L_NUM, threshold=0.001))
def q_correlated_pairs(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(profile.correlated_pairs(df, spec.numeric, 0.001))


@register("correlated_pairs_documents", _corr_sql("fs_d", SQL_FS_D, list(FS_D.numeric), threshold=0.5))
def q_correlated_pairs_documents(spark, sf):
    df, spec = documents_toxic(spark, sf)
    return rounded(profile.correlated_pairs(df, spec.numeric, 0.5))


def _drop_correlated_sql(cols, threshold: float) -> str:
    """Ranked columns, then one recursion step per column: it joins the kept ones
    unless it is too strongly correlated with one of them."""
    pairs = "\nUNION ALL\n".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM fs_x" for a in cols for b in cols if a != b)
    own = "\nUNION ALL\n".join(f"SELECT '{a}' AS feature, round(corr(CAST(label AS DOUBLE), {a}), 9) AS label_corr FROM fs_x" for a in cols)
    return _with(SQL_FS_L, _L_CHARGE, f"pairs AS ({pairs})", f"own AS ({own})",
                 "ranked AS (SELECT *, row_number() OVER (ORDER BY label_corr IS NULL, abs(label_corr) DESC, feature) - 1 AS rank FROM own)",
                 f"""foes AS (SELECT feature, label_corr, rank,
                   coalesce(list(b ORDER BY b) FILTER (WHERE abs(r) > {threshold}), []) AS foes
                 FROM ranked JOIN pairs ON a = feature GROUP BY ALL)""",
                 """steps(i, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) UNION ALL
                 SELECT i + 1, CASE WHEN len(list_intersect(kept, foes)) > 0 THEN kept ELSE list_append(kept, feature) END
                 FROM steps JOIN foes ON rank = i)""",
                 "final AS (SELECT unnest(kept) AS feature FROM steps WHERE i = (SELECT max(i) FROM steps))",
                 """rivals AS (SELECT f.feature, arg_min(k.feature, k.rank) AS rival FROM foes f JOIN foes k
                 ON list_contains(f.foes, k.feature) AND k.rank < f.rank AND k.feature IN (SELECT feature FROM final) GROUP BY f.feature)""",
                 ).replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT f.feature, round(f.label_corr, 6) AS label_corr, CAST(f.rank AS INTEGER) AS rank,
       f.feature IN (SELECT feature FROM final) AS kept, rivals.rival, round(pairs.r, 6) AS rival_corr
FROM foes f LEFT JOIN rivals ON rivals.feature = f.feature LEFT JOIN pairs ON a = f.feature AND b = rivals.rival"""


#: A column that follows another one closely, so that there is something to drop.
_L_CHARGE = "fs_x AS (SELECT *, l_extendedprice * (1.0 + coalesce(l_tax, 0.0)) AS charge FROM fs_l)"


@register("drop_correlated", _drop_correlated_sql([*L_NUM, "charge"], 0.9))
def q_drop_correlated(spark, sf):
    df, spec = lineitem_returns(spark, sf, stored=True)
    df = df.withColumn("charge", F.col("l_extendedprice") * (1.0 + F.coalesce("l_tax", F.lit(0.0))))
    return rounded(collinear.drop_correlated(df, spec, 0.9, [*spec.numeric, "charge"]))


def _vif_sql(a: str, b: str, c: str) -> str:
    """The diagonal of the inverse of a 3 x 3 correlation matrix."""
    det = "(1 - ab * ab - ac * ac - bc * bc + 2 * ab * ac * bc)"
    return _with(SQL_FS_E, f"""r AS (SELECT corr({a}, {b}) AS ab, corr({a}, {c}) AS ac, corr({b}, {c}) AS bc FROM fs_e
                 WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {c} IS NOT NULL)""") + "\nUNION ALL\n".join(
        f"SELECT '{x}' AS feature, round((1 - {r} * {r}) / {det}, 6) AS vif FROM r" for x, r in ((a, "bc"), (b, "ac"), (c, "ab")))


@register("variance_inflation", _vif_sql(*E_NUM))
def q_variance_inflation(spark, sf):
    df, spec = events_clicks(spark, sf)
    return rounded(collinear.variance_inflation(df, spec.numeric))


_E_PAIRS = [(a, b) for i, a in enumerate(E_NUM) for b in E_NUM[i + 1:]]


def _pair_density_sql(bins: int = 10) -> str:
    cols = E_NUM
    rng = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in cols)

    def b(c):
        return (f"CASE WHEN hi_{c} = lo_{c} THEN CAST(0 AS BIGINT) ELSE least(CAST({bins - 1} AS BIGINT), "
                f"CAST(floor((CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) * {float(bins)}) AS BIGINT)) END")
    parts = [f"SELECT '{a}' AS col_a, '{bb}' AS col_b, {b(a)} AS bin_a, {b(bb)} AS bin_b, count(*) AS n "
             f"FROM fs_e, rng WHERE {a} IS NOT NULL AND {bb} IS NOT NULL GROUP BY ALL" for a, bb in _E_PAIRS]
    return _with(SQL_FS_E, f"rng AS (SELECT {rng} FROM fs_e)") + "\nUNION ALL\n".join(parts)


@register("pair_density", _pair_density_sql(10))
def q_pair_density(spark, sf):
    df, _ = events_clicks(spark, sf)
    return profile.pair_density(df, _E_PAIRS, 10)


def _skew_sql() -> str:
    parts = []
    for c in E_NUM:
        parts.append(
            f"SELECT '{c}' AS feature, round(m, 6) AS mean, round(sd, 6) AS stddev_pop, "
            f"round(avg(power((CAST({c} AS DOUBLE) - m) / sd, 3)), 6) AS skewness, "
            f"round(avg(power((CAST({c} AS DOUBLE) - m) / sd, 4)) - 3.0, 6) AS kurtosis "
            f"FROM fs_e, (SELECT avg(CAST({c} AS DOUBLE)) AS m, stddev_pop(CAST({c} AS DOUBLE)) AS sd FROM fs_e) s "
            f"WHERE {c} IS NOT NULL GROUP BY m, sd")
    return _with(SQL_FS_E) + "\nUNION ALL\n".join(parts)


@register("skew_profile", _skew_sql())
def q_skew_profile(spark, sf):
    df, spec = events_clicks(spark, sf)
    return rounded(profile.skew_profile(df, spec.numeric))


@register("quantile_profile", _with(SQL_FS_E) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, round(quantile_disc(CAST({c} AS DOUBLE), {p}), 6) AS value FROM fs_e"
    for c in E_NUM for p in (0.25, 0.5, 0.75)))
def q_quantile_profile(spark, sf):
    df, spec = events_clicks(spark, sf)
    return rounded(profile.quantile_exact(df, spec.numeric))


# ---------------------------------------------------------------------------
# 2.2 / 2.3 projections, filters, missing values
# ---------------------------------------------------------------------------


@register("project_features", _with(SQL_FS_L) + f"SELECT {L_COLS} FROM fs_l")
def q_project_features(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return df.select(*spec.columns)


@register("filter_clicked_numeric", _with(SQL_FS_E) + f"SELECT {', '.join(E_NUM)} FROM fs_e WHERE label = 1")
def q_filter_clicked_numeric(spark, sf):
    df, spec = events_clicks(spark, sf)
    return df.where(F.col(spec.label) == 1).select(*spec.numeric)


_L_FILLED = ", ".join(L_KEY + ["label"] + [f"coalesce({c}, 0.0) AS {c}" for c in L_NUM] + L_CAT)


@register("fill_numeric_zero", _with(SQL_FS_L) + f"SELECT {_L_FILLED} FROM fs_l")
def q_fill_numeric_zero(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return clean.fill_numeric_zero(df, list(spec.numeric))


_BLANK = "({c} IS NULL OR regexp_replace({c}, '^\\s+|\\s+$', '', 'g') = '')"


def _clean_blanks_sql() -> str:
    cols = L_KEY + ["label"]
    cols += [f"coalesce({c}, 0.0) AS {c}" for c in L_NUM]
    cols += [f"CASE WHEN {_BLANK.format(c=c)} THEN '__Dummy__' "
             f"ELSE regexp_replace({c}, '^\\s+|\\s+$', '', 'g') END AS {c}" for c in L_CAT]
    return _with(SQL_FS_L) + f"SELECT {', '.join(cols)} FROM fs_l"


@register("clean_blanks", _clean_blanks_sql())
def q_clean_blanks(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    raw = df.select(*spec.key, spec.label, *[F.col(c).cast("string").alias(c) for c in spec.features])
    return clean.clean_blanks(raw, spec)


def _blank_to_null_sql() -> str:
    cols = L_KEY + ["label"] + L_NUM + [f"CASE WHEN {_BLANK.format(c=c)} THEN NULL ELSE {c} END AS {c}"
                                        for c in L_CAT]
    return _with(SQL_FS_L) + f"SELECT {', '.join(cols)} FROM fs_l"


@register("blank_to_null", _blank_to_null_sql())
def q_blank_to_null(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return clean.blank_to_null(df, spec.categorical)


@register("binarize_numeric", _with(SQL_FS_L) + "SELECT " + ", ".join(
    L_KEY + ["label"] + [f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END AS {c}" for c in L_NUM]) + " FROM fs_l")
def q_binarize_numeric(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return clean.binarize_numeric(df.select(*spec.key, spec.label, *spec.numeric), spec.numeric)


@register("impute_mean", _with(SQL_FS_L) + "SELECT " + ", ".join(
    L_KEY + ["label"] + [f"round(coalesce({c}, (SELECT avg({c}) FROM fs_l)), 6) AS {c}"
                         for c in ("l_discount", "l_tax")]) + " FROM fs_l")
def q_impute_mean(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(clean.impute_mean(df.select(*spec.key, spec.label, "l_discount", "l_tax"),
                                     ["l_discount", "l_tax"]))


@register("ascii_clean", """
SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text_ascii,
       CAST(length(text) - length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS BIGINT) AS n_removed
FROM documents""")
def q_ascii_clean(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    out = clean.ascii_clean(docs, "text", "text_ascii")
    return out.select("doc_id", "text_ascii",
                      (F.length("text") - F.length("text_ascii")).cast("bigint").alias("n_removed"))


@register("align_scoring_schema", _with(SQL_FS_E) + "SELECT " + ", ".join(
    ["event_id", "CAST(0 AS INTEGER) AS label"] + E_NUM + E_CAT) + " FROM fs_e")
def q_align_scoring_schema(spark, sf):
    df, spec = events_clicks(spark, sf)
    # an unlabelled log with positional names _1 .. _n, as a scoring file arrives
    unlabelled = df.drop(spec.label)
    positional = unlabelled.toDF(*[f"_{i + 1}" for i in range(len(unlabelled.columns))])
    return clean.align_scoring_schema(positional, spec)


# ---------------------------------------------------------------------------
# 2.1 sources and sinks
# ---------------------------------------------------------------------------

_FS_E_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("value", T.DoubleType()), T.StructField("k", T.IntegerType()),
    T.StructField("hour", T.IntegerType()), T.StructField("uid", T.StringType()),
    T.StructField("dow", T.StringType())])


@register("tsv_roundtrip", _with(SQL_FS_E) + f"SELECT {E_COLS} FROM fs_e")
def q_tsv_roundtrip(spark, sf):
    df, spec = events_clicks(spark, sf)
    path = files.write_delimited_text(df.select(*spec.columns), scratch_path(spark, "tsv"), "\t")
    return files.read_delimited_text(spark, path, _FS_E_SCHEMA, "\t")


def _fs_l_schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


@register("csv_roundtrip", _with(SQL_FS_L) + f"SELECT {L_COLS} FROM fs_l")
def q_csv_roundtrip(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    df = df.select(*spec.columns)
    path = files.write_csv(df, scratch_path(spark, "csv"))
    return files.read_csv(spark, path, _fs_l_schema(df))


@register("single_column_scan", "SELECT l_quantity FROM lineitem")
def q_single_column_scan(spark, sf):
    # one parquet table instead of one file per column: this is a pruned scan
    return read_table(spark, sf, "lineitem").select("l_quantity")


@register("limit_extract", _with(SQL_FS_E) + f"SELECT {E_COLS} FROM fs_e ORDER BY event_id LIMIT 5000")
def q_limit_extract(spark, sf):
    df, spec = events_clicks(spark, sf)
    extract = sample.limit_extract(df.select(*spec.columns), spec, 5000)
    path = files.write_csv(extract, scratch_path(spark, "extract"))
    return files.read_csv(spark, path, _FS_E_SCHEMA)


@register("schema_profile", _with(SQL_FS_E) + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
    f"count({f.name}) AS n_non_null FROM fs_e" for i, f in enumerate(_FS_E_SCHEMA.fields)))
def q_schema_profile(spark, sf):
    df, spec = events_clicks(spark, sf)
    df = df.select(*spec.columns)
    wide = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"n{i}").alias("n_non_null"))
            for i, f in enumerate(df.schema.fields)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _preview_sql() -> str:
    parts = [f"SELECT CAST(rn AS INTEGER) AS row_n, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM top"
             for c in FS_E.columns]
    return _with(SQL_FS_E, f"top AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS rn FROM "
                           f"(SELECT * FROM fs_e ORDER BY event_id LIMIT 5) t)") + "\nUNION ALL\n".join(parts)


@register("preview_transposed", _preview_sql())
def q_preview_transposed(spark, sf):
    df, spec = events_clicks(spark, sf)
    top = df.select(*spec.columns).orderBy("event_id").limit(5)
    # limit(5) is the feature: five rows, so numbering them needs no distributed rank
    top = top.withColumn("row_n", (F.row_number().over(Window.orderBy("event_id")) - 1).cast("int"))
    long = profile.melt(top, list(spec.columns), keep=["row_n"])
    return long


# ---------------------------------------------------------------------------
# 2.4 row identity
# ---------------------------------------------------------------------------


@register("stable_row_id", _with(SQL_FS_L) +
          f"SELECT {L_KEY_SQL}, row_number() OVER (ORDER BY {L_KEY_SQL}) - 1 AS row_id FROM fs_l")
def q_stable_row_id(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rowid.stable_row_id(df.select(*spec.key), spec)


@register("reassemble_by_row_id", _with(SQL_FS_E) + f"SELECT {E_COLS} FROM fs_e")
def q_reassemble_by_row_id(spark, sf):
    df, spec = events_clicks(spark, sf)
    groups = [[spec.label], list(spec.numeric), list(spec.categorical)]
    paths = [files.write_parquet_table(p, scratch_path(spark, "piece"))
             for p in rowid.split_by_columns(df, spec.key, groups)]
    pieces = [files.read_parquet_table(spark, p) for p in paths]
    return rowid.reassemble_by_key(pieces, spec.key).select(*spec.columns)


# ---------------------------------------------------------------------------
# 2.6 sampling and splitting
# ---------------------------------------------------------------------------

_E_KEY_STR = "CAST(event_id AS VARCHAR)"
_E_UNIT = f"CAST(('0x' || substr(md5({_E_KEY_STR} || '-sample-0'), 1, 8)) AS BIGINT) / 4294967296.0"
_E_SPLIT = f"CASE WHEN substr(md5({_E_KEY_STR} || '-2019'), 1, 4) < 'b333' THEN 'train' ELSE 'test' END"


@register("hash_sample", _with(SQL_FS_E) + f"SELECT {E_COLS} FROM fs_e WHERE {_E_UNIT} < 0.25")
def q_hash_sample(spark, sf):
    df, spec = events_clicks(spark, sf)
    return sample.hash_sample(df, spec, 0.25, seed=0)


@register("stratified_sample", _with(SQL_FS_E) + f"SELECT {E_COLS} FROM fs_e WHERE "
          f"(label = 0 AND {_E_UNIT} < 0.1) OR (label = 1 AND {_E_UNIT} < 0.5)")
def q_stratified_sample(spark, sf):
    df, spec = events_clicks(spark, sf)
    return sample.sample_by_label(df, spec, {0: 0.1, 1: 0.5}, seed=0)


@register("stratified_sample_exact", _with(SQL_FS_E, """h AS (SELECT *, row_number() OVER (PARTITION BY label
              ORDER BY md5(CAST(event_id AS VARCHAR) || '-exact-7'), event_id) AS place, count(*) OVER (PARTITION BY label) AS n FROM fs_e)""")
          + f"SELECT {E_COLS} FROM h WHERE place <= CASE label WHEN 1 THEN ceil(round(0.25 * n, 6)) ELSE ceil(round(0.05 * n, 6)) END")
def q_stratified_sample_exact(spark, sf):
    df, spec = events_clicks(spark, sf)
    return sample.sample_exact_by_label(df.select(*spec.columns), spec, {0: 0.05, 1: 0.25}, seed=7)


@register("hash_split", _with(SQL_FS_E) + f"SELECT event_id, label, {_E_SPLIT} AS split FROM fs_e")
def q_hash_split(spark, sf):
    df, spec = events_clicks(spark, sf)
    return sample.hash_split(df.select(*spec.key, spec.label), spec)


@register("split_counts", _with(SQL_FS_L) + f"""
SELECT split, count(*) AS n, count(*) FILTER (WHERE label = 1) AS n_pos, round(avg(CAST(label = 1 AS DOUBLE)), 6) AS ctr
FROM (SELECT label, {_L_SPLIT} AS split FROM fs_l) t GROUP BY split""")
def q_split_counts(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(sample.split_counts(df, spec))


@register("kfold_assign", _with(SQL_FS_E) + f"""
SELECT event_id, CAST(CAST(('0x' || substr(md5({_E_KEY_STR} || '-fold-2019'), 1, 8)) AS BIGINT) % 3 AS INTEGER) AS fold
FROM fs_e""")
def q_kfold_assign(spark, sf):
    df, spec = events_clicks(spark, sf)
    return sample.kfold_assign(df.select(*spec.key), spec, 3)


# ---------------------------------------------------------------------------
# 2.5 profiles from stored sketches
# ---------------------------------------------------------------------------

_SKETCH_PARTS = "(SELECT count(DISTINCT CAST(ts AS DATE)) FROM events)"


@register("sketch_profile", _with(SQL_FS_E) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {_SKETCH_PARTS} AS parts, count({c}) AS n, count(*) - count({c}) AS n_null, "
    + (f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, " if c in E_NUM else
       "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, ")
    + f"true AS distinct_close, {'true' if c in E_NUM else 'CAST(NULL AS BOOLEAN)'} AS median_close FROM fs_e" for c in (*E_NUM, *E_CAT)))
def q_sketch_profile(spark, sf):
    """One state per day, stored, merged and set against the exact figures: distinct
    counts within four standard errors, the median within 3 % of the rows."""
    events = read_table(spark, sf, "events")
    df = events_to_clicks(events).join(events.select("event_id", F.to_date("ts").alias("day")), "event_id")
    path = scratch_path(spark, "sketches")
    for some in (F.dayofyear("day") % 2 == 0, F.lit(True)):           # the second round adds the other days
        states = sketches.update_states(df.where(some), path, F.col("day"), E_NUM, E_CAT)
    found = sketches.profile_states(sketches.merge_states(states), (0.5,))
    exact = profile.distinct_all_fields(df, [*E_NUM, *E_CAT]).select(F.col("feature").alias("of"), F.col("n_distinct").alias("exact"))
    found = found.join(F.broadcast(exact), F.col("feature") == F.col("of"))     # a row per column
    long = profile.melt(df, E_NUM, value_type="double").select(F.col("feature").alias("f"), "value")
    rank = (long.join(F.broadcast(found.select(F.col("feature").alias("f"), F.col("quantiles")[0].alias("median"))), "f")
            .groupBy("f").agg(F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"),
                              F.avg((F.col("value") <= F.col("median")).cast("double")).alias("up_to")))
    return (found.join(rank, F.col("feature") == F.col("f"), "left")
            .select("feature", "parts", "n", "n_null", "min_value", "max_value",
                    (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.065 * F.col("exact") + 1).alias("distinct_close"),
                    ((F.col("below") <= 0.53) & (F.col("up_to") >= 0.47)).alias("median_close")))


# ---------------------------------------------------------------------------
# 2.10 encoding, scaling, weights, selection
# ---------------------------------------------------------------------------

def _index_sql(fs: str, cols, where: str = "") -> str:
    body = _union(fs, cols, "'{c}' AS feature, CAST({c} AS VARCHAR) AS value", where="{c} IS NOT NULL" +
                  (f" AND {where}" if where else ""))
    return (f"cnt AS (SELECT feature, value, count(*) AS n FROM ({body}) u GROUP BY feature, value),\n"
            f"idx AS (SELECT feature, value, n, CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 "
            f"AS DOUBLE) AS idx FROM cnt),\n"
            f"sizes AS (SELECT feature, count(*) AS n_labels FROM idx GROUP BY feature)")


@register("index_category", _with(SQL_FS_L, _index_sql("fs_l", L_CAT)) + "SELECT feature, value, n, idx FROM idx")
def q_index_category(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return encode.index_category(df, spec.categorical)


def _apply_index_sql(fs: str, key, cols, extra=()) -> str:
    sel = [f"{fs}.{c}" for c in key] + [f"{fs}.{c} AS {c}" if c.isidentifier() else c for c in extra]
    joins = []
    for i, c in enumerate(cols):
        sel.append(f"coalesce(i{i}.idx, (SELECT CAST(n_labels AS DOUBLE) FROM sizes WHERE feature = '{c}'), 0.0) "
                   f"AS {c}_idx")
        joins.append(f"LEFT JOIN idx i{i} ON i{i}.feature = '{c}' AND i{i}.value = {fs}.{c}")
    return f"SELECT {', '.join(sel)} FROM {fs} " + " ".join(joins)


_L_BRAND_NULL = SQL_FS_L.replace("CASE WHEN p.p_brand = 'Brand#1' THEN '' ELSE p.p_brand END",
                                 "CASE WHEN p.p_brand = 'Brand#1' THEN NULL ELSE p.p_brand END")


@register("index_category_keep", _with(_L_BRAND_NULL, _index_sql("fs_l", L_CAT, where=f"{_L_SPLIT} = 'train'"))
          + _apply_index_sql("fs_l", L_KEY, L_CAT))
def q_index_category_keep(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    df = clean.blank_to_null(df, ["p_brand"])          # blanks become nulls -> the 'keep' bucket
    train = sample.train_test(df, spec)[0]
    out = encode.fit_category_index(train, spec.categorical).transform(df)
    return out.select(*spec.key, *[c + "_idx" for c in spec.categorical])


@register("index_label", _with(SQL_FS_E) + "SELECT event_id, CAST(label AS DOUBLE) AS label_idx FROM fs_e")
def q_index_label(spark, sf):
    df, spec = events_clicks(spark, sf)
    return encode.index_label(df.select(*spec.key, spec.label), spec).drop(spec.label)


@register("encoded_feature_table", _with(SQL_FS_L, _index_sql("fs_l", L_CAT)) +
          f"SELECT * FROM ({_apply_index_sql('fs_l', L_KEY, L_CAT, ['label'] + [f'coalesce({c}, 0.0) AS {c}' for c in L_NUM])}) t")
def q_encoded_feature_table(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    index = encode.index_category(df, spec.categorical)
    enc = encode.apply_category_index(clean.fill_numeric_zero(df, list(spec.numeric)), index, spec.categorical)
    table = enc.select(*spec.key, spec.label, *spec.numeric, *[c + "_idx" for c in spec.categorical])
    path = files.write_parquet_table(table, scratch_path(spark, "encoded"))
    return files.read_parquet_table(spark, path)


@register("encoded_feature_table_long", ORACLE_SQL["encoded_feature_table"])
def q_encoded_feature_table_long(spark, sf):
    """The encoded table with every index beyond the broadcast bound. The joined rows
    are stored once: the index, its combinations and the result all read them."""
    df, spec = lineitem_returns(spark, sf)
    df = files.read_parquet_table(spark, files.write_parquet_table(df, scratch_path(spark, "joined")))
    index = encode.load_index(spark, encode.store_index(encode.index_category(df, spec.categorical), scratch_path(spark, "index")))
    enc = encode.apply_category_index(clean.fill_numeric_zero(df, list(spec.numeric)), index, spec.categorical, max_broadcast_bytes=0)
    return enc.select(*spec.key, spec.label, *spec.numeric, *[c + "_idx" for c in spec.categorical])


@register("assemble_features", _with(SQL_FS_E, _index_sql("fs_e", E_CAT)) + "SELECT event_id, " + ", ".join(
    [f"CAST({c} AS DOUBLE) AS f_{c}" for c in E_NUM] + [f"{c}_idx AS f_{c}_idx" for c in E_CAT]) +
    f" FROM ({_apply_index_sql('fs_e', ['event_id'], E_CAT, E_NUM)}) t")
def q_assemble_features(spark, sf):
    df, spec = events_clicks(spark, sf)
    index = encode.index_category(df, spec.categorical)
    enc = encode.apply_category_index(df, index, spec.categorical)
    names = list(spec.numeric) + [c + "_idx" for c in spec.categorical]
    vec = encode.assemble(enc, names, "features").select("event_id", "features")
    return encode.vector_columns(vec, "features", names, prefix="f_")


def _scale_sql(kind: str) -> str:
    stat = "stddev_samp" if kind == "std" else "max(abs"
    close = ")" if kind == "std" else "))"
    sel = L_KEY[:]
    for c in L_NUM:
        x = f"coalesce({c}, 0.0)"
        s = f"(SELECT {stat}({x}{close} FROM fs_l)"
        sel.append(f"round(CASE WHEN {s} = 0 THEN 0.0 ELSE {x} / {s} END, 6) AS scaled_{c}")
    return _with(SQL_FS_L) + f"SELECT {', '.join(sel)} FROM fs_l"


@register("standard_scale", _scale_sql("std"))
def q_standard_scale(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    filled = clean.fill_numeric_zero(df.select(*spec.key, *spec.numeric), list(spec.numeric))
    out = encode.standard_scale(filled, spec.numeric)
    return rounded(out.select(*spec.key, *[f"scaled_{c}" for c in spec.numeric]))


@register("max_abs_scale", _scale_sql("maxabs"))
def q_max_abs_scale(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    filled = clean.fill_numeric_zero(df.select(*spec.key, *spec.numeric), list(spec.numeric))
    out = encode.max_abs_scale(filled, spec.numeric)
    return rounded(out.select(*spec.key, *[f"scaled_{c}" for c in spec.numeric]))


def _fit_transform_sql() -> str:
    split_e = _E_SPLIT
    base = (f"base AS (SELECT event_id, {split_e} AS split, " + ", ".join(
        [f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in E_NUM] + E_CAT) + " FROM fs_e)")
    idx = _index_sql("base", E_CAT, where="split = 'train'")
    enc = f"enc AS ({_apply_index_sql('base', ['event_id', 'split'], E_CAT, E_NUM)})"
    names = E_NUM + [c + "_idx" for c in E_CAT]
    sel = ["event_id", "split"]
    for c in names:
        s = f"(SELECT stddev_samp({c}) FROM enc WHERE split = 'train')"
        sel.append(f"round(CASE WHEN {s} = 0 THEN 0.0 ELSE {c} / {s} END, 6) AS scaled_{c}")
    return _with(SQL_FS_E, base, idx, enc) + f"SELECT {', '.join(sel)} FROM enc"


@register("feature_fit_transform", _fit_transform_sql())
def q_feature_fit_transform(spark, sf):
    df, spec = events_clicks(spark, sf)
    prep = models.prepare(df, spec, persist=False)
    names = models.feature_names(spec)
    parts = []
    for name, part in (("train", prep.train), ("test", prep.test)):
        parts.append(part.select(*spec.key, F.lit(name).alias("split"), models.FEATURES))
    both = parts[0].unionByName(parts[1])
    return rounded(encode.vector_columns(both, models.FEATURES, names, prefix="scaled_"))


@register("saved_feature_pipeline", _fit_transform_sql())
def q_saved_feature_pipeline(spark, sf):
    """The features of ``feature_fit_transform`` by a pipeline that was saved and loaded again."""
    df, spec = events_clicks(spark, sf)
    base = sample.hash_split(clean.fill_numeric_zero(df, list(spec.numeric)), spec)
    path = scratch_path(spark, "saved-pipeline")
    models.fit_feature_pipeline(base.where(F.col("split") == "train"), spec).write().save(path)
    features = PipelineModel.load(path).transform(base).select(*spec.key, "split", models.FEATURES)
    return rounded(encode.vector_columns(features, models.FEATURES, models.feature_names(spec), prefix="scaled_"))


@register("class_weights", _with(SQL_FS_E) + f"""
SELECT event_id, label, {_E_SPLIT} AS split,
       round(CASE WHEN label = 1 THEN r ELSE 1.0 - r END, 8) AS class_weight
FROM fs_e, (SELECT CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) / count(*) AS r
            FROM fs_e WHERE {_E_SPLIT} = 'train') w""")
def q_class_weights(spark, sf):
    df, spec = events_clicks(spark, sf)
    df = sample.hash_split(df.select(*spec.key, spec.label), spec)
    return rounded(encode.class_weights(df, spec, fit_on=df.where(F.col("split") == "train")), 8)


@register("one_hot_long", _with(SQL_FS_E, _index_sql("fs_e", E_CAT)) + f"""
SELECT event_id, feature, CAST(slot AS INTEGER) AS slot FROM (
{_union('fs_e', E_CAT, "event_id, '{c}' AS feature, (SELECT idx FROM idx WHERE idx.feature = '{c}' AND idx.value = fs_e.{c}) AS slot")}
) t WHERE slot IS NOT NULL""")
def q_one_hot_long(spark, sf):
    df, spec = events_clicks(spark, sf)
    index = encode.index_category(df, spec.categorical)
    sizes = encode.label_sizes(index)
    enc = encode.apply_category_index(df, index, spec.categorical)
    return encode.one_hot_long(enc, spec.key, spec.categorical, sizes)


def _chi_sql(where: str = "", digits: int = 4) -> str:
    body = _union("fs_l", L_CAT, "'{c}' AS feature, CAST({c} AS VARCHAR) AS value, label", where)
    return _with(SQL_FS_L, f"""cells AS (SELECT feature, value, label, count(*) AS n FROM ({body}) u GROUP BY ALL),
r AS (SELECT feature, value, sum(n) AS r FROM cells GROUP BY ALL),
c AS (SELECT feature, label, sum(n) AS c FROM cells GROUP BY ALL),
t AS (SELECT feature, sum(n) AS big_n, count(DISTINCT value) AS nv, count(DISTINCT label) AS nl FROM cells GROUP BY ALL)""") + f"""
SELECT t.feature, round(CAST(t.big_n AS DOUBLE) * (sum(CAST(cells.n AS DOUBLE) * cells.n / (CAST(r.r AS DOUBLE) * c.c)) - 1.0), {digits}) AS statistic,
       CAST((t.nv - 1) * (t.nl - 1) AS BIGINT) AS dof
FROM cells JOIN r USING (feature, value) JOIN c USING (feature, label) JOIN t USING (feature)
GROUP BY t.feature, t.big_n, t.nv, t.nl"""


@register("chi_square_stat", _chi_sql())
def q_chi_square_stat(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(select.chi_square_stat(df, spec, spec.categorical), 4)


def _select_sql(chosen: str) -> str:
    """P-value: 1 less the series of the regularised lower incomplete gamma function,
    whose term n is z^(a+n) e^-z / Gamma(a+n+1); the terms rise until n is about z."""
    a, z = "(dof / 2.0)", "(statistic / 2.0)"
    lower = f"list_sum([exp(({a} + i) * ln({z}) - {z} - lgamma({a} + i + 1)) FOR i IN range(0, 4000)])"
    return f"""SELECT feature, round(statistic, 4) AS statistic, dof, round(p, 6) AS p_value, {chosen} AS selected
FROM (SELECT *, 1.0 - {lower} AS p FROM ({_chi_sql(where=f"{_L_SPLIT} = 'train'", digits=12)}) x) y"""


def _selected(spark, sf, mode, threshold):
    df, spec = lineitem_returns(spark, sf)
    out = select.univariate_select(sample.train_test(df, spec)[0], spec, spec.categorical, mode, threshold)
    return out.withColumns({"statistic": F.round("statistic", 4), "p_value": F.round("p_value", 6)})


@register("select_fpr", _select_sql("p < 0.05"))
def q_select_fpr(spark, sf):
    return _selected(spark, sf, "fpr", 0.05)


@register("select_top_n", _select_sql("row_number() OVER (ORDER BY p, feature) <= 3"))
def q_select_top_n(spark, sf):
    return _selected(spark, sf, "numTopFeatures", 3)


# ---------------------------------------------------------------------------
# theory: fixed-weight scorer, log-loss, gradient, entropy, votes
# ---------------------------------------------------------------------------

# fixed values: weights of the worked scorer (all ones) and its intercept
FIXED_WEIGHTS = {"value": 1.0, "k": 1.0, "hour": 1.0}
FIXED_INTERCEPT = -1.5


def _scaled_events(spark, sf):
    """FS-E numerics divided by their max |x| (one aggregate, 3 numbers to the driver)."""
    df, spec = events_clicks(spark, sf)
    mx = df.agg(*[F.max(F.abs(F.col(c).cast("double"))).alias(c) for c in spec.numeric]).first()
    scaled = df.select(*spec.key, spec.label,
                       *[F.try_divide(F.col(c).cast("double"), F.lit(float(mx[c]))).alias(c) for c in spec.numeric])
    return scaled, spec


def _fixed_scored(spark, sf):
    scaled, spec = _scaled_events(spark, sf)
    return theory.fixed_lr_scores(scaled, spec, FIXED_WEIGHTS, FIXED_INTERCEPT), spec


_SCORED_CTES = (
    SQL_FS_E,
    "mx AS (SELECT " + ", ".join(f"max(abs(CAST({c} AS DOUBLE))) AS m_{c}" for c in E_NUM) + " FROM fs_e)",
    "sc AS (SELECT event_id, label, " + ", ".join(f"CAST({c} AS DOUBLE) / m_{c} AS {c}" for c in E_NUM) +
    " FROM fs_e, mx)",
    "zz AS (SELECT event_id, label, value, k, hour, "
    "((CAST(-1.5 AS DOUBLE) + CAST(1.0 AS DOUBLE) * value) + CAST(1.0 AS DOUBLE) * k) + CAST(1.0 AS DOUBLE) * hour AS z "
    "FROM sc)",
    "scored AS (SELECT event_id, label, z, CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-z)) AS probability, "
    "CAST(CASE WHEN z > 0 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM zz)",
)


@register("lr_score_fixed", _with(*_SCORED_CTES) +
          "SELECT event_id, label, round(z, 8) AS z, round(probability, 8) AS probability, prediction FROM scored")
def q_lr_score_fixed(spark, sf):
    scored, _ = _fixed_scored(spark, sf)
    return rounded(scored, 8)


@register("log_loss", _with(*_SCORED_CTES) + """
SELECT count(*) AS n, round(avg(-label * ln(probability) - (1 - label) * ln(1 - probability)), 8) AS log_loss
FROM scored""")
def q_log_loss(spark, sf):
    scored, _ = _fixed_scored(spark, sf)
    return rounded(theory.log_loss(scored), 8)


def _gradient_sql() -> str:
    parts = [("__intercept__", FIXED_INTERCEPT, "CAST(1.0 AS DOUBLE)")] + [(c, w, c) for c, w in FIXED_WEIGHTS.items()]
    sel = []
    for name, w, x in parts:
        g = f"avg((probability - label) * {x})"
        sel.append(f"SELECT '{name}' AS feature, CAST({w} AS DOUBLE) AS weight, round({g}, 8) AS gradient, "
                   f"round(CAST({w} AS DOUBLE) - 0.25 * {g}, 8) AS new_weight FROM g")
    return _with(*_SCORED_CTES, "g AS (SELECT s.probability, s.label, z.value, z.k, z.hour FROM scored s "
                                "JOIN zz z USING (event_id))") + "\nUNION ALL\n".join(sel)


@register("lr_gradient_step", _gradient_sql())
def q_lr_gradient_step(spark, sf):
    scaled, spec = _scaled_events(spark, sf)
    return rounded(theory.gradient_step(scaled, spec, FIXED_WEIGHTS, FIXED_INTERCEPT, alpha=0.25), 8)


@register("label_entropy", _with(SQL_FS_E) + """
SELECT n, n_pos, round(-(p * ln(p)) - ((1 - p) * ln(1 - p)), 8) AS entropy
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS n_pos,
             CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / count(*) AS p FROM fs_e) t""")
def q_label_entropy(spark, sf):
    df, spec = events_clicks(spark, sf)
    return rounded(theory.label_entropy(df, spec), 8)


def _ig_sql() -> str:
    body = _union("fs_l", L_CAT, "'{c}' AS feature, CAST({c} AS VARCHAR) AS value, label")
    h = "(CASE WHEN {p} > 0 THEN -({p}) * ln({p}) ELSE 0.0 END + CASE WHEN {p} < 1 THEN -(1 - {p}) * ln(1 - {p}) ELSE 0.0 END)"
    pv = "CAST(pos_v AS DOUBLE) / n_v"
    pp = "CAST(sum(pos_v) AS DOUBLE) / sum(n_v)"
    return _with(SQL_FS_L, f"cells AS (SELECT feature, value, count(*) AS n_v, count(*) FILTER (WHERE label = 1) "
                           f"AS pos_v FROM ({body}) u GROUP BY ALL)") + f"""
SELECT feature, round({h.format(p=pp)}, 8) AS parent_entropy,
       round(sum(n_v * {h.format(p=pv)}) / sum(n_v), 8) AS conditional_entropy,
       round({h.format(p=pp)} - sum(n_v * {h.format(p=pv)}) / sum(n_v), 8) AS information_gain
FROM cells GROUP BY feature"""


@register("information_gain", _ig_sql())
def q_information_gain(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(theory.information_gain(df, spec, spec.categorical), 8)


def _threshold_sql() -> str:
    body = _union("fs_l", L_NUM, "'{c}' AS feature, CAST({c} AS DOUBLE) AS value, label", where="{c} IS NOT NULL AND label IS NOT NULL")
    h = "(CASE WHEN {0} > 0 THEN -({0}) * ln({0}) ELSE 0.0 END + CASE WHEN {0} < 1 THEN -(1 - {0}) * ln(1 - {0}) ELSE 0.0 END)"
    return _with(SQL_FS_L, f"""c AS (SELECT feature, value, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos
                 FROM ({body}) u GROUP BY ALL)""",
                 """run AS (SELECT feature, value, sum(n) OVER up AS nl, sum(pos) OVER up AS pl,
                 sum(n) OVER (PARTITION BY feature) AS tn, sum(pos) OVER (PARTITION BY feature) AS tp FROM c
                 WINDOW up AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING))""",
                 f"""g AS (SELECT *, {h.format('(tp / tn)')} AS parent, {h.format('(tp / tn)')}
                 - (nl * {h.format('(pl / nl)')} + (tn - nl) * {h.format('((tp - pl) / (tn - nl))')}) / tn AS gain FROM run WHERE nl < tn)""") + """
SELECT feature, value AS threshold, CAST(nl AS BIGINT) AS n_left, CAST(pl AS BIGINT) AS pos_left, CAST(tn - nl AS BIGINT) AS n_right,
       CAST(tp - pl AS BIGINT) AS pos_right, round(parent, 8) AS parent_entropy, round(gain, 8) AS gain
FROM g QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 12) DESC, value) = 1"""


@register("best_threshold", _threshold_sql())
def q_best_threshold(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return rounded(splits.best_threshold(df, spec), 8)


@register("majority_vote", _with(*_SCORED_CTES) + """
SELECT event_id, CASE WHEN (CASE WHEN value > 0.5 THEN 1 ELSE 0 END) + (CASE WHEN k > 0.5 THEN 1 ELSE 0 END)
                      + (CASE WHEN hour > 0.5 THEN 1 ELSE 0 END) >= 2 THEN 1 ELSE 0 END AS vote,
       CAST(3 AS BIGINT) AS n_voters
FROM sc""")
def q_majority_vote(spark, sf):
    scaled, spec = _scaled_events(spark, sf)
    # three decision stumps (x > 0.5 on each scaled feature), one vote row per (row, stump)
    stumps = [F.struct(F.lit(c).alias("stump"), (F.col(c) > 0.5).cast("int").alias("vote")) for c in spec.numeric]
    votes = scaled.select(*spec.key, F.explode(F.array(*stumps)).alias("v")).select(*spec.key, "v.vote")
    return theory.majority_vote(votes, spec.key, "vote")


# ---------------------------------------------------------------------------
# 2.12 evaluation (fixed scorer, so the twin is exact)
# ---------------------------------------------------------------------------


def _auc_sql() -> str:
    body = _union("fs_l", L_NUM, "'{c}' AS feature, CAST({c} AS DOUBLE) AS score, label", where="{c} IS NOT NULL")
    return _with(SQL_FS_L, f"""s AS (SELECT feature, score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
                 CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS n FROM ({body}) u GROUP BY ALL)""",
                 """r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY feature ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s)""") + """
SELECT feature, round(sum(p * (nb + 0.5 * n)) / (sum(p) * sum(n)), 8) AS auc,
       CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n) AS BIGINT) AS n_neg
FROM r GROUP BY feature"""


@register("auc_exact", _auc_sql())
def q_auc_exact(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    long = profile.melt(df, spec.numeric, value_type="double", keep=[spec.label], value="score")
    return rounded(evaluate.auc_exact(long, spec.label, "score", group=["feature"]), 8)


_CURVE_CTE = """curve AS (SELECT z AS threshold,
      sum(n) OVER (ORDER BY z DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
      sum(p) OVER (ORDER BY z DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
      sum(n) OVER () AS tn, sum(p) OVER () AS tp
  FROM (SELECT z, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
               CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS n FROM scored GROUP BY z) t)"""


@register("roc_curve", _with(*_SCORED_CTES, _CURVE_CTE) + """
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS fpr, CAST(0.0 AS DOUBLE) AS tpr
UNION ALL
SELECT round(threshold, 8), round(cn / tn, 8), round(cp / tp, 8) FROM curve""")
def q_roc_curve(spark, sf):
    scored, _ = _fixed_scored(spark, sf)
    return rounded(evaluate.roc_curve(scored, "label", "z"), 8)


@register("pr_curve", _with(*_SCORED_CTES, _CURVE_CTE) + """
SELECT round(threshold, 8) AS threshold, round(cp / tp, 8) AS recall, round(cp / (cp + cn), 8) AS precision FROM curve""")
def q_pr_curve(spark, sf):
    scored, _ = _fixed_scored(spark, sf)
    return rounded(evaluate.pr_curve(scored, "label", "z"), 8)


@register("confusion_matrix", _with(*_SCORED_CTES) +
          "SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction")
def q_confusion_matrix(spark, sf):
    scored, _ = _fixed_scored(spark, sf)
    return evaluate.confusion_matrix(scored, "label", "prediction")


def _weighted_sql() -> str:
    return _with(*_SCORED_CTES, """cm AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY ALL)""",
                 """pl AS (SELECT label AS c, CAST(sum(n) AS DOUBLE) AS n_c,
                           CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) AS tp FROM cm GROUP BY label)""",
                 """pp AS (SELECT prediction AS c, CAST(sum(n) AS DOUBLE) AS pred_c FROM cm GROUP BY prediction)""",
                 """t AS (SELECT pl.c, n_c, tp, coalesce(pred_c, 0.0) AS pred_c, sum(n_c) OVER () AS big_n
                          FROM pl LEFT JOIN pp USING (c))""",
                 """m AS (SELECT *, CASE WHEN pred_c > 0 THEN tp / pred_c ELSE 0.0 END AS prec,
                                 CASE WHEN n_c > 0 THEN tp / n_c ELSE 0.0 END AS rec,
                                 CASE WHEN big_n - n_c > 0 THEN (pred_c - tp) / (big_n - n_c) ELSE 0.0 END AS fpr,
                                 n_c / big_n AS w FROM t)""",
                 """f AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM m)""") + """
SELECT 'accuracy' AS metric, round(sum(tp) / max(big_n), 8) AS value FROM f
UNION ALL SELECT 'weighted_precision', round(sum(w * prec), 8) FROM f
UNION ALL SELECT 'weighted_recall', round(sum(w * rec), 8) FROM f
UNION ALL SELECT 'weighted_f1', round(sum(w * f1), 8) FROM f
UNION ALL SELECT 'weighted_fpr', round(sum(w * fpr), 8) FROM f
UNION ALL SELECT 'weighted_tpr', round(sum(w * rec), 8) FROM f"""


@register("weighted_metrics", _weighted_sql())
def q_weighted_metrics(spark, sf):
    scored, _ = _fixed_scored(spark, sf)
    return rounded(evaluate.weighted_metrics(scored, "label", "prediction"), 8)


@register("top_confident_negatives", _with(*_SCORED_CTES) + """
SELECT event_id, label, round(1.0 - probability, 8) AS prob_neg, prediction FROM scored WHERE prediction = 0
ORDER BY round(1.0 - probability, 8) DESC, event_id LIMIT 10""")
def q_top_confident_negatives(spark, sf):
    scored, spec = _fixed_scored(spark, sf)
    prob0 = F.round(F.lit(1.0) - F.col("probability"), 8)
    return evaluate.top_confident_negatives(scored, spec.key, prob0, 10, columns=["label"])


def _importance_sql() -> str:
    z = "((CAST(-1.5 AS DOUBLE) + CAST(1.0 AS DOUBLE) * {0}) + CAST(1.0 AS DOUBLE) * {1}) + CAST(1.0 AS DOUBLE) * {2}"
    parts = ["SELECT '' AS variant, label, " + z.format(*E_NUM) + " AS z FROM o"]
    for j, c in enumerate(E_NUM):
        cols = ["d." + x if x == c else "o." + x for x in E_NUM]
        parts.append(f"SELECT '{c}', o.label, {z.format(*cols)} FROM o JOIN o d ON d.seq = (o.seq + {j + 1}) % o.n")
    return _with(*_SCORED_CTES, """o AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR) || '-permute-0'), event_id) - 1 AS seq,
                 count(*) OVER () AS n FROM sc)""", "v AS (" + " UNION ALL ".join(parts) + ")",
                 """s AS (SELECT variant, z, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
                 CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS n FROM v WHERE z IS NOT NULL GROUP BY ALL)""",
                 """r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY variant ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s)""",
                 "a AS (SELECT variant, sum(p * (nb + 0.5 * n)) / (sum(p) * sum(n)) AS auc FROM r GROUP BY variant)") + """
SELECT a.variant AS feature, round(b.auc, 8) AS auc, round(a.auc, 8) AS auc_exchanged, round(b.auc - a.auc, 8) AS importance
FROM a, a b WHERE b.variant = '' AND a.variant <> ''"""


@register("permutation_importance", _importance_sql())
def q_permutation_importance(spark, sf):
    scaled, spec = _scaled_events(spark, sf)
    spec = FeatureSpec(spec.key, spec.label, spec.numeric)

    def score(rows):
        z = F.lit(FIXED_INTERCEPT)
        for c, w in FIXED_WEIGHTS.items():
            z = z + F.lit(w) * F.col(c)
        return rows.withColumn("score", z)
    return rounded(importance.permutation_importance(scaled, spec, score), 8)


@register("permutation_importance_gbt")
def q_permutation_importance_gbt(spark, sf):
    """Of a fitted forest of boosted trees, on the test rows."""
    df, spec = events_clicks(spark, sf)
    prep = models.prepare(df, spec)
    try:
        model = models.train(prep, "gbt", maxIter=5).model
        test = sample.train_test(df, spec)[1]
        scored = importance.permutation_importance(test, spec, importance.model_scorer(prep.pipeline, model, spec))
        path = scratch_path(spark, "importance")
        scored.write.parquet(path)
        return spark.read.parquet(path)
    finally:
        prep.unpersist()


# ---------------------------------------------------------------------------
# 2.11 models and tuning (MLlib fits: rows-only checks)
# ---------------------------------------------------------------------------


def _model_query(kind: str):
    def q(spark, sf):
        df, spec = events_clicks(spark, sf)
        return models.train_report(df, spec, kind)
    return q


for _kind in ("lr", "rf", "gbt", "lsvc"):
    register(f"train_{_kind}")(_model_query(_kind))


@register("train_lr_selected")
def q_train_lr_selected(spark, sf):
    df, spec = lineitem_returns(spark, sf)
    return models.train_report(df, spec, "lr", selection=("numTopFeatures", 3))


@register("train_lr_one_hot")
def q_train_lr_one_hot(spark, sf):
    """One coefficient per label, order keys included: about 1.5 million labels at scale 1."""
    df, spec = lineitem_returns(spark, sf)
    df = df.withColumn("order", F.col("l_orderkey").cast("string"))
    spec = FeatureSpec(spec.key, spec.label, spec.numeric, (*spec.categorical, "order"))
    return models.train_report(df, spec, "lr", one_hot=True)


@register("train_lr_uncorrelated")
def q_train_lr_uncorrelated(spark, sf):
    """Trained on the numeric columns that ``drop_correlated`` keeps on the train rows."""
    df, spec = lineitem_returns(spark, sf, stored=True)
    df = df.withColumn("charge", F.col("l_extendedprice") * (1.0 + F.coalesce("l_tax", F.lit(0.0))))
    wide = FeatureSpec(spec.key, spec.label, (*spec.numeric, "charge"), spec.categorical)
    return models.train_report(df, wide, "lr", uncorrelated=0.9, materialize="rows")


def _preview_query(kind: str, negatives_first: bool):
    def q(spark, sf):
        df, spec = events_clicks(spark, sf)
        prep = models.prepare(df, spec)
        try:
            pred = models.train(prep, kind, **models.REFERENCE_PARAMS[kind]).pred_test
            return models.prediction_preview(pred, spec, 10, negatives_first)
        finally:
            prep.unpersist()
    return q


for _kind in ("rf", "gbt"):
    register(f"preview_{_kind}")(_preview_query(_kind, False))
    register(f"top_negatives_{_kind}")(_preview_query(_kind, True))


@register("lr_one_binary_feature", _with(SQL_FS_E) + """
SELECT round(ln(n11 / n01) - ln(n10 / n00), 4) AS coefficient, round(ln(n10 / n00), 4) AS intercept
FROM (SELECT CAST(count(*) FILTER (WHERE hour >= 12 AND label = 1) AS DOUBLE) AS n11,
             CAST(count(*) FILTER (WHERE hour >= 12 AND label = 0) AS DOUBLE) AS n01,
             CAST(count(*) FILTER (WHERE hour < 12 AND label = 1) AS DOUBLE) AS n10,
             CAST(count(*) FILTER (WHERE hour < 12 AND label = 0) AS DOUBLE) AS n00 FROM fs_e) t""")
def q_lr_one_binary_feature(spark, sf):
    """Unregularised logistic regression on one 0/1 feature has a closed form: the log odds ratio."""
    df, spec = events_clicks(spark, sf)
    rows = encode.assemble(df.select(F.col(spec.label).cast("double").alias(models.LABEL),
                                     (F.col("hour") >= 12).cast("double").alias("afternoon")),
                           ["afternoon"], models.FEATURES)
    model = models.make_classifier("lr", weighted=False, regParam=0.0, tol=1e-12, maxIter=100).fit(rows)
    return rounded(spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))],
                                         "coefficient double, intercept double"), 4)


def _tune_query(kind: str):
    def q(spark, sf):
        df, spec = events_clicks(spark, sf)
        return tuning.tune(df, spec, kind)
    return q


for _kind in ("lr", "rf", "gbt", "lsvc"):
    register(f"tune_{_kind}")(_tune_query(_kind))


@register("search_lr_resumed")
def q_search_lr_resumed(spark, sf):
    """A search that finds half of its fits already made by an earlier one."""
    df, spec = events_clicks(spark, sf)
    path = scratch_path(spark, "search")
    tuning.resumable_search(df, spec, "lr", path, {"regParam": [0.01]})
    return tuning.resumable_search(df, spec, "lr", path, {"regParam": [0.01, 0.1]})


@register("lr_coefficients")
def q_lr_coefficients(spark, sf):
    df, spec = events_clicks(spark, sf)
    prep = models.prepare(df, spec)
    try:
        res = models.train(prep, "lr", **models.REFERENCE_PARAMS["lr"])
        return models.lr_coefficients(res.model, models.feature_names(spec))
    finally:
        prep.unpersist()


@register("feature_importance")
def q_feature_importance(spark, sf):
    df, spec = events_clicks(spark, sf)
    prep = models.prepare(df, spec)
    try:
        res = models.train(prep, "rf")
        return models.feature_importance(res.model, models.feature_names(spec))
    finally:
        prep.unpersist()


@register("compare_classifiers")
def q_compare_classifiers(spark, sf):
    df, spec = events_clicks(spark, sf)
    return models.compare_classifiers(df, spec)


@register("compare_classifiers_sample")
def q_compare_classifiers_sample(spark, sf):
    df, spec = events_clicks(spark, sf)
    return models.compare_classifiers(df, spec, params=models.SAMPLE_PARAMS)


@register("document_features", _with(SQL_FS_D) + """
SELECT lang, count(*) AS n, CAST(sum(label) AS BIGINT) AS toxic, round(avg(CAST(n_words AS DOUBLE)), 6) AS mean_words
FROM fs_d GROUP BY lang""")
def q_document_features(spark, sf):
    df, spec = documents_toxic(spark, sf)
    return rounded(df.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("toxic"),
                                          F.avg(F.col("n_words").cast("double")).alias("mean_words")))


# ---------------------------------------------------------------------------
# streaming
# ---------------------------------------------------------------------------


@register("ctr_stream_hourly", """
SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, count(*) AS n,
       CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
       round(CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS ctr
FROM events GROUP BY 1""")
def q_ctr_stream_hourly(spark, sf):
    from clickspark.streaming import run_hourly_ctr
    return rounded(run_hourly_ctr(spark, f"{sf.rstrip('/')}/events.parquet"))


@register("stream_scoring")
def q_stream_scoring(spark, sf):
    from clickspark.streaming import file_stream, score_stream
    df, spec = events_clicks(spark, sf)
    prep = models.prepare(df, spec)
    try:
        res = models.train(prep, "lr", **models.REFERENCE_PARAMS["lr"])
        path = f"{sf.rstrip('/')}/events.parquet"
        stream = file_stream(spark, path)
        feats = clean.fill_numeric_zero(events_to_clicks(stream), list(spec.numeric))
        sink = scratch_path(spark, "scored")
        score_stream(feats, prep.pipeline, res.model, spec.key, sink, scratch_path(spark, "scored-ckpt"))
        return spark.read.parquet(sink)
    finally:
        prep.unpersist()

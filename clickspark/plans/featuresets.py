"""Click tables built from the driver's parquet tables.

FS-E  events                 key event_id, label event_type = 'click'
FS-L  lineitem + dimensions  key (orderkey, partkey, suppkey, linenumber, shipdate), label returnflag = 'R'
FS-D  documents + labels     key doc_id, label toxic

The test tables hold no nulls or blanks, so FS-L injects them by rule
(``nullif`` on discount and tax, brand 'Brand#1' written as a blank) to
exercise the missing-value operators.

Join plan for FS-L at scale: the two fact-sized inputs (lineitem, orders) meet
in one shuffle join on the order key (AQE splits skewed keys); supplier is
joined to nation first (nation is 25 rows by definition, the only explicit
broadcast), part and supplier are left to AQE, which broadcasts them only when
their runtime size is under ``spark.sql.autoBroadcastJoinThreshold`` and keeps
a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.session import discard, store
from clickspark.sources import read_table
from clickspark.spec import FeatureSpec

FS_E = FeatureSpec(key=("event_id",), label="label",
                   numeric=("value", "k", "hour"), categorical=("uid", "dow"))

FS_L = FeatureSpec(key=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"), label="label",
                   numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
                   categorical=("l_linestatus", "p_brand", "p_type", "o_orderpriority", "n_name"))

FS_D = FeatureSpec(key=("doc_id",), label="label",
                   numeric=("n_chars", "n_words"), categorical=("lang", "source"))


def events_clicks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeatureSpec]:
    return events_to_clicks(read_table(spark, sf_dir, "events")), FS_E


def events_to_clicks(ev: DataFrame) -> DataFrame:
    """The FS-E projection; a plain projection, so it also applies to a stream of events."""
    return ev.select(
        "event_id",
        (F.col("event_type") == "click").cast("int").alias("label"),
        "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.hour("ts").alias("hour"),
        F.col("user_id").cast("string").alias("uid"),
        F.date_format("ts", "EEE").alias("dow"),
    )


def lineitem_returns(spark: SparkSession, sf_dir: str, stored: bool = False) -> tuple[DataFrame, FeatureSpec]:
    """``stored``: the rows are written after each of the joins with orders, part and supplier, so that the
    disk holds the shuffle of one join at a time, and the result reads scratch files only."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supp = (read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "n_name"))
    joined = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if stored:
        first = store(joined.drop("o_orderkey"), "joined-orders")
        second = joined = store(first.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"), "joined-part")
        discard(first)
    else:
        joined = joined.join(part, F.col("l_partkey") == F.col("p_partkey"))
    joined = joined.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    df = joined.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        "l_quantity", "l_extendedprice",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
        "l_linestatus",
        F.when(F.col("p_brand") == "Brand#1", F.lit("")).otherwise(F.col("p_brand")).alias("p_brand"),
        "p_type", "o_orderpriority", "n_name",
    )
    if stored:
        df = store(df, "joined")
        discard(second)
    return df, FS_L


def documents_toxic(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeatureSpec]:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    df = docs.join(labels, "doc_id").select(
        "doc_id",
        F.col("toxic").alias("label"),
        "n_chars",
        F.size(F.split("text", r"\s+")).cast("bigint").alias("n_words"),
        "lang", "source",
    )
    return df, FS_D


# ---------------------------------------------------------------------------
# DuckDB twins of the feature sets, used as CTEs by the oracle SQL.
# ---------------------------------------------------------------------------

SQL_FS_E = """fs_e AS (
  SELECT event_id,
         CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS INTEGER) AS label,
         value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST(user_id AS VARCHAR) AS uid,
         strftime(ts, '%a') AS dow
  FROM events)"""

SQL_FS_L = """fs_l AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
         strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS label,
         l.l_quantity, l.l_extendedprice,
         nullif(l.l_discount, 0.0) AS l_discount, nullif(l.l_tax, 0.0) AS l_tax,
         l.l_linestatus,
         CASE WHEN p.p_brand = 'Brand#1' THEN '' ELSE p.p_brand END AS p_brand,
         p.p_type, o.o_orderpriority, n.n_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

SQL_FS_D = """fs_d AS (
  SELECT d.doc_id, lb.toxic AS label, d.n_chars,
         CAST(len(string_split_regex(d.text, '\\s+')) AS BIGINT) AS n_words,
         d.lang, d.source
  FROM documents d JOIN labels lb ON d.doc_id = lb.doc_id)"""

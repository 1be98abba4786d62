"""URL filter: suffix rules, then a blocked Bloom filter before an exact join.

The listed canonical URLs are set in a blocked Bloom filter: a URL's hash picks
one 64-bit block, and ``PROBES`` bits inside it. The filter is a table (block,
word). A page whose bits are all set in its block is a possible hit; possible
hits are joined by hash to the listed URLs themselves, which removes the false
positives. Pages that the filter rejects never reach the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.text import lower_ascii
from clickspark.session import scratch_path

#: (host, path prefix, verdict): a rule fits its host and all subdomains.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
PROBES = 5
BITS_PER_URL = 16


def host(url: Column) -> Column:
    """After the first '://' up to '/', '?' or '#', A-Z lowered; '' without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to '?' or '#'; '' without '://'."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without 'www.' or port, path without trailing '/', query without utm_*
    parameters; scheme and fragment dropped. Null without '://'."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(rest, r"([?&])utm_[^&=]*(=[^&]*)?", "$1"), r"[?&]+", "&")
    query = F.regexp_replace(F.btrim(query, F.lit("&")), r"^(.+)$", r"?$1")
    bare = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":[0-9]*$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(bare, F.regexp_replace(path(url), "/+$", ""), query))


def rule_of(h: Column, p: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule (ties: first listed);
    null fields if none fits."""
    fits = lambda rh, rp: ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for rh, rp, verdict in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        out = F.when(fits(rh, rp), F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(key, F.lit(blocks))


def _mask(text: Column) -> Column:
    """The URL's bits inside its block, from a hash independent of the block's."""
    h = F.xxhash64(F.lit("bits"), text)
    bits = F.lit(0).cast("long")
    for i in range(PROBES):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"),
                                              F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return bits


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, word) of the non-empty blocks; ``listed`` has the column url_key."""
    return (listed.groupBy(_block(F.xxhash64("url_key"), blocks).alias("block"))
            .agg(F.bit_or(_mask(F.col("url_key"))).alias("word")))


def blocks_for(n: int) -> int:
    return max(1, -(-n * BITS_PER_URL // 64))


def judge_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules=RULES) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, possible, listed.

    ``listed``: column ``url`` of listed URLs, in any spelling; duplicates and
    nulls have no effect. The verdict is the longest fitting rule's, else
    'block' if the page's canonical URL is listed, else 'allow'. ``possible``:
    the Bloom filter passed it. A null URL, or one without '://', has empty host
    and path, no rule, and is allowed. Repeated rows each get a row; other
    columns are ignored.

    Neither join is given a broadcast hint: Spark broadcasts the filter or the
    listed URLs only when it measures them under its threshold, and splits the
    page side of a hot URL otherwise.
    """
    spark = pages.sparkSession
    where = scratch_path(spark, "urls")
    listed.select(canonical(F.col("url")).alias("url_key")).where("url_key is not null").distinct().write.parquet(where)
    keys = spark.read.schema("url_key string").parquet(where)
    blocks = blocks_for(keys.count())
    filter_path = scratch_path(spark, "url-filter")
    bloom_filter(keys, blocks).write.parquet(filter_path)
    words = spark.read.schema("block long, word long").parquet(filter_path)

    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).select(
        "id", host(url).alias("host"), path(url).alias("path"), canonical(url).alias("key"))
    probed = (rows.withColumn("at", _block(F.xxhash64("key"), blocks))
              .join(words, (F.col("at") == F.col("block")) & F.col("key").isNotNull(), "left")
              .withColumn("possible", F.coalesce(F.col("word").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key")), F.lit(False))
                          & F.col("key").isNotNull()))
    exact = probed.join(keys, F.col("possible") & (F.col("key") == F.col("url_key")), "left")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return exact.select(
        F.col("id").alias(id_col), "host", "path", rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], F.when(F.col("url_key").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "possible", F.col("url_key").isNotNull().alias("listed"))

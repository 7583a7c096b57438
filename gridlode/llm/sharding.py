"""Extendible hashing of rows into byte-limited shards, in DataFrame operations alone.

A row's bucket is a prefix of its 60-bit hash. A directory node (a prefix of d
bits) is a shard as soon as its rows fit the limit, so only oversized nodes
split on one more bit. Byte sums of the deepest level are rolled up to all
levels above it; where the deepest level still has oversized nodes, rows of
those nodes alone are resolved on further bits.

Defined cases: a null key hashes as the empty text; a null payload weighs 0
bytes; repeated rows share a hash, so a node whose rows have one single hash
can't split and stays a shard, with fits = false if it is over the limit (one
row larger than the limit is such a node); an empty table gives no rows; other
columns play no part. Rows of equal hash share a shard, so a tie can't arise; a
very long payload counts as one row's bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import written

HASH_BITS = 60
SPARE_BITS = 3  # the deepest level starts this many bits below the mean depth
STEP_BITS = 6  # bits that a further round adds for nodes that are still too large


def hash60(key: Column, payload: Column) -> Column:
    """The first 60 bits of the MD5 of key and payload."""
    text = F.concat_ws("\x1f", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(payload, F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _leaves(deep: DataFrame, first: int, last: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """deep has a row (deep_prefix, bytes, n, lo, hi) for each node of depth last.

    Returns the shards found at depths first..last by deep_prefix, and the deep
    nodes under no shard.
    """
    levels = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("depth")
    up = deep.select("*", levels).withColumn(
        "prefix", F.call_function("shiftright", F.col("deep_prefix"), (F.lit(last) - F.col("depth")).cast("int"))
    )
    nodes = up.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    # written, so that the join can deal out again what lies under the nodes next to the root, which hold all
    nodes = written(nodes.where((F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi"))))
    found = (
        up.select("depth", "prefix", "deep_prefix")
        .join(nodes.drop("lo", "hi").hint("merge"), ["depth", "prefix"])
        .groupBy("deep_prefix")
        .agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("leaf"))
    )
    return found, deep.join(found.select("deep_prefix").hint("merge"), "deep_prefix", "left_anti").select("deep_prefix")


def shard(df: DataFrame, key: str, payload: str, limit: int) -> DataFrame:
    """Rows (key, bytes, h, depth, shard, shard_bytes, shard_rows, fits); shard is the node's prefix as bits."""
    rows = df.select(
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(F.col(payload)), F.lit(0)).cast("long").alias("bytes"),
        hash60(F.col(key), F.col(payload)).alias("h"),
    )
    rows = written(rows)
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    first, last = 0, min(HASH_BITS, max(1, math.ceil(math.log2(max(1.0, total / limit))) + SPARE_BITS))
    left, parts = rows, []
    while True:
        at = left.withColumn("deep_prefix", F.call_function("shiftright", F.col("h"), F.lit(HASH_BITS - last)))
        deep = written(
            at.groupBy("deep_prefix").agg(
                F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
            )
        )
        found, open_nodes = _leaves(deep, first, last, limit)
        found, open_nodes = written(found), written(open_nodes)
        # nodes grow with the data, so they are merged, not broadcast; both sides can be dealt out again where a node is hot
        parts.append(at.join(found.hint("merge"), "deep_prefix").select("key", "bytes", "h", "leaf.*"))
        if last == HASH_BITS or open_nodes.isEmpty():
            break
        left = written(at.join(open_nodes.hint("merge"), "deep_prefix", "left_semi").drop("deep_prefix"))
        first, last = last + 1, min(HASH_BITS, last + STEP_BITS)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    bits = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    return out.select(
        F.col("key").alias(key),
        "bytes",
        "h",
        F.col("depth").cast("int").alias("depth"),
        bits.alias("shard"),
        "shard_bytes",
        "shard_rows",
        (F.col("shard_bytes") <= limit).alias("fits"),
    )


def write_shards(df: DataFrame, key: str, payload: str, limit: int, path: str) -> None:
    """Write df's rows as Parquet, one folder a shard."""
    plan = shard(df, key, payload, limit).select("h", "shard").distinct()
    rows = df.withColumn("h", hash60(F.col(key), F.col(payload)))
    rows.join(plan, "h").drop("h").repartition("shard").write.partitionBy("shard").parquet(path)


LIMIT = 1 << 20


def query(spark, sf_dir):
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", LIMIT).drop("h")


ORACLE = f"""
WITH r AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
lv AS (SELECT doc_id, bytes, h, CAST(d AS INTEGER) AS depth, h >> (60 - d) AS prefix FROM r, range(0, 61) t(d)),
nodes AS (
  SELECT depth, prefix, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows
  FROM lv GROUP BY ALL HAVING sum(bytes) <= {LIMIT} OR min(h) = max(h)),
leaf AS (
  SELECT l.doc_id, l.bytes, l.h, n.depth, n.prefix, n.shard_bytes, n.shard_rows,
         row_number() OVER (PARTITION BY l.doc_id, l.h ORDER BY n.depth) AS k
  FROM lv l JOIN nodes n USING (depth, prefix))
SELECT doc_id, bytes, depth, CASE WHEN depth = 0 THEN '' ELSE substr(CAST(CAST(h AS BIT) AS VARCHAR), 5, depth) END AS shard,
       shard_bytes, shard_rows, shard_bytes <= {LIMIT} AS fits
FROM leaf WHERE k = 1
"""

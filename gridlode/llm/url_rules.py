"""URL verdicts: a fixed rule list first, then association rules mined by FP-growth.

A URL is the set of its tokens: host labels by place, path segments, query
names, with digits as #. Tokens that stand in exactly the same of the URLs to be
mined are one item, so that long URLs that share many tokens don't give all of
their subsets; a rule has all tokens of its items (it is closed). Half of the labelled URLs
(by a hash of the URL), with an item for the class "block" where the label says
so, go to Spark's FP-growth. Frequent sets that hold the class token give rules "tokens -> block". A rule stays
if its confidence is CONFIDENCE of the way from the share of blocked URLs to
certainty, in the half it was mined on and again in the other, each time on
LEAST_ROWS URLs at least; and if no other rule's tokens are among its own. Rules match by an
inverted index: they are joined with URLs on their rarest token, so neither
side is ever gathered.

Defined cases: a null URL, or one without "://", has an empty host and path,
fits no listed rule and has no tokens, so it is allowed; labels that are null
or belong to no URL are unused; without labels nothing is mined and all is
allowed; of equally rare tokens the smaller one is the index's; of listed rules
that fit the longest wins, and two different ones are never equally long; a very
long URL is a set of its tokens, all of them; repeated rows give a row each; an
empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from gridlode.llm.common import written

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

SUPPORT = 0.002
LEAST_ROWS = 5
CONFIDENCE = 0.5
BLOCK = "=block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null."""
    found = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host_ == h) | F.endswith(host_, F.lit("." + h))) & F.startswith(path_, F.lit(p))
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


_DIGITS = re.compile(r"[0-9]+")


def tokens(url: str | None) -> list[str]:
    if not url or "://" not in url:
        return []
    scheme, rest = url.split("://", 1)
    rest, _, fragment = rest.partition("#")
    rest, _, query = rest.partition("?")
    host_, _, path_ = rest.partition("/")
    out = {f"scheme:{scheme.lower()}"}
    labels = host_.lower().split(".")
    out.update(f"host{min(n, 3)}:{label}" for n, label in enumerate(reversed(labels)) if label)
    out.update(f"path:{_DIGITS.sub('#', s.lower())}" for s in path_.split("/") if s)
    out.update(f"query:{_DIGITS.sub('#', q.lower())}" for q in query.split("&") if q)
    if fragment:
        out.add(f"fragment:{_DIGITS.sub('#', fragment.lower())}")
    return sorted(out)


def tokenized(rows: DataFrame, column: str) -> DataFrame:
    """rows with their tokens."""
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.array([tokens(u.as_py()) for u in batch.column(at)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, "tokens"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add("tokens", ArrayType(StringType())))


def holding(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows with `antecedent`, once for each rule whose tokens are all among the row's `tokens`."""
    each = rules.select("antecedent", F.explode("antecedent").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n"))
    index = each.join(often, "token").groupBy("antecedent").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    found = rows.withColumn("token", F.explode("tokens")).join(index, "token").drop("token")
    return found.where(F.size(F.array_except("antecedent", "tokens")) == 0)


def item_groups(rows: DataFrame, least: int) -> DataFrame:
    """item, members: tokens that `least` rows (id, tokens) or more have, together where they are in the same rows; the first names them.

    Sets of rows are told apart by their number and 128 bits over their ids.
    """
    each = rows.select("id", F.explode("tokens").alias("token"))
    tokens_ = each.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).where(F.col("n") >= least)
    return written(tokens_.groupBy("n", "x", "y").agg(F.min("token").alias("item"), F.array_sort(F.collect_list("token")).alias("members")).select("item", "members"))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame | None:
    """antecedent, rows, confidence, held_rows, held_confidence from rows (url, bad); None where nothing is mined."""
    from pyspark.ml.fpm import FPGrowth

    rows = labelled.where("url is not null and bad is not null").select("url", F.col("bad").cast("boolean").alias("bad"))
    rows = tokenized(rows, "url").where("size(tokens) > 0").withColumn("held", F.crc32(F.col("url").cast("binary")) % 2 == 1)
    rows = written(rows.select(F.monotonically_increasing_id().alias("id"), "tokens", "bad", "held"))
    counts = {r["held"]: (r["n"], r["bad"] / r["n"]) for r in rows.groupBy("held").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")).collect()}
    if len(counts) < 2 or counts[False][0] < LEAST_ROWS:
        return None
    need = {held: share + confidence * (1 - share) for held, (_, share) in counts.items()}
    least = max(support, LEAST_ROWS / counts[False][0])
    mined = rows.where("not held")
    groups = item_groups(mined.select("id", "tokens"), math.ceil(least * counts[False][0] - 1e-9))
    named = groups.select("item", F.explode("members").alias("token"))
    own = mined.select("id", F.explode("tokens").alias("token")).join(named, "token").groupBy("id").agg(F.collect_set("item").alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    items = mined.select("id", "bad").join(own, "id", "left").select(F.when(F.col("bad"), F.array_append(items, F.lit(BLOCK))).otherwise(items).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=least).fit(items).freqItemsets
    found = found.select(F.array_sort("items").alias("items"), "freq")
    whole = found.where(~F.array_contains("items", BLOCK)).select(F.col("items").alias("antecedent"), F.col("freq").alias("rows"))
    bad = found.where(F.array_contains("items", BLOCK) & (F.size("items") > 1)).select(F.array_remove("items", BLOCK).alias("antecedent"), F.col("freq").alias("blocked"))
    rules = bad.join(whole, "antecedent").withColumn("confidence", F.col("blocked") / F.col("rows"))
    rules = rules.where(F.col("confidence") >= need[False]).select("rows", "confidence", "antecedent", F.explode("antecedent").alias("item"))
    rules = rules.join(groups, "item").groupBy("antecedent", "rows", "confidence").agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("closed"))
    rules = written(rules.select(F.col("closed").alias("antecedent"), "rows", "confidence"))
    checked = holding(rows.where("held").select("tokens", "bad"), rules)
    checked = checked.groupBy("antecedent").agg(F.count("*").alias("held_rows"), (F.count_if("bad") / F.count("*")).alias("held_confidence"))
    return rules.join(checked.where((F.col("held_rows") >= LEAST_ROWS) & (F.col("held_confidence") >= need[True])), "antecedent")


def pruned(rules: DataFrame) -> DataFrame:
    """Rules without those whose tokens hold another rule's."""
    own = rules.select(F.col("antecedent").alias("tokens"))
    more = holding(own, rules).where(F.size("tokens") > F.size("antecedent")).select(F.col("tokens").alias("antecedent")).distinct()
    return rules.join(more, "antecedent", "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The different ones of `urls` (column url) that some rule blocks."""
    return holding(tokenized(urls.where("url is not null").distinct(), "url"), rules).select("url").distinct()


def judge(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    rows = rows.withColumn("listed", listed(F.col("host"), F.col("path")))
    rules = mine(labelled)
    rules = written(pruned(rules)) if rules is not None else None
    if rules is None or rules.isEmpty():
        rows = rows.withColumn("mined", F.lit(False))
    else:
        blocked = written(matched(rows.where("listed is null").select("url"), rules.select("antecedent")))
        rows = rows.join(blocked.withColumn("mined", F.lit(True)), "url", "left")
    verdict = F.coalesce("listed.verdict", F.when(F.col("mined"), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): a URL's label is that of the document whose number is the last in its path; toxic or low quality means block."""
    number = F.regexp_extract(path(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1).try_cast("long")
    bad = labels.groupBy("doc_id").agg(F.max(((F.col("toxic") == 1) | (F.col("quality") == 0))).alias("bad"))
    return pages.select("url", number.alias("doc_id")).join(bad, "doc_id").select("url", "bad")


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, labelled_urls(pages, spark.read.parquet(f"{sf_dir}/labels.parquet")))

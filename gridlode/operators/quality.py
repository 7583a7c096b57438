"""Quality report: each section is a small table of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlode.functions.text import BUCKETS, confidence_bucket, connection_family, filled, flag_list, review_pattern
from gridlode.functions.values import percent
from gridlode.sources.files import erased_after, written


def _unmapped() -> Column:
    return filled(F.col("canonical_node_id")).isNull()


def reviews(rows: DataFrame) -> DataFrame:
    return rows.where(F.coalesce("needs_review", F.lit(False)))


def profiles(rows: DataFrame) -> DataFrame:
    """Rows summed up by all that the sections count: a registry repeats its texts and flags.

    Every section takes rows or profiles; a report reads its rows once for all of them.
    """
    shown = [c for c in ("connection_point_raw", "flags", "canonical_node_id", "parse_error", "activity_type", "confidence", "needs_review") if c in rows.columns]
    slim = rows.withColumn("flags", flag_list(F.col("flags"))).withColumn("canonical_node_id", F.when(~_unmapped(), "a")).withColumn("confidence", F.col("confidence").try_cast("double"))
    return slim.groupBy(*shown).agg(F.count("*").alias("_n"), F.min("record_key").alias("record_key"))


def _n(rows: DataFrame) -> Column:
    """How many records a row stands for."""
    return F.col("_n") if "_n" in rows.columns else F.lit(1).cast("bigint")


def _total(n: Column, where: Column | None = None) -> Column:
    return F.coalesce(F.sum(n if where is None else F.when(where, n)), F.lit(0))


def summary(rows: DataFrame) -> DataFrame:
    n = _n(rows)
    counts = rows.agg(
        _total(n).alias("total_records"),
        _total(n, ~_unmapped()).alias("mapped_records"),
        _total(n, F.coalesce("needs_review", F.lit(False))).alias("review_records"),
        _total(n, filled(F.col("parse_error")).isNotNull()).alias("parse_error_records"),
        _total(n, F.coalesce(F.col("activity_type") == "unknown", F.lit(False))).alias("unknown_activity_records"),
    )
    total = F.col("total_records")
    return counts.select("*", percent(F.col("mapped_records"), total).alias("mapped_pct"), percent(F.col("review_records"), total).alias("review_pct"))


def confidence_buckets(rows: DataFrame) -> DataFrame:
    bucket = confidence_bucket(F.col("confidence"))
    return rows.select(bucket.alias("b"), _n(rows).alias("_n")).agg(*(_total(F.col("_n"), F.col("b") == b).alias(b) for b in BUCKETS))


def _issues(rows: DataFrame) -> DataFrame:
    """A row for each flag of each review, with its place among the record's flags."""
    flags = flag_list(F.col("flags"))
    shown = F.when(F.size(flags) > 0, flags).otherwise(F.array(F.lit("review_without_flag")))
    return reviews(rows).select("*", F.posexplode(shown).alias("_place", "flag"))


def _of_all(part: Column, share: Column) -> Column:
    """part in percent of a section's records, by what its few rows add to them."""
    return percent(part, F.sum(share).over(Window.partitionBy(F.lit(0))))


def flag_counts(rows: DataFrame) -> DataFrame:
    """A record counts among all reviews where its first flag stands, so one pass has both counts."""
    n = _n(rows)
    counted = _issues(rows).groupBy("flag").agg(F.sum(n).alias("count"), _total(n, _unmapped()).alias("unmapped_count"), _total(n, F.col("_place") == 0).alias("_records"))
    return counted.select("flag", "count", "unmapped_count", _of_all(F.col("count"), F.col("_records")).alias("pct_of_review")).orderBy(F.desc("count"), "flag")


def quick_wins(rows: DataFrame) -> DataFrame:
    found = flag_counts(rows).select(F.col("flag").alias("issue"), F.col("count").alias("review_count"), "unmapped_count", "pct_of_review")
    return found.orderBy(F.desc("unmapped_count"), F.desc("review_count"), "issue")


def family_counts(rows: DataFrame) -> DataFrame:
    texts = reviews(rows).groupBy(F.col("connection_point_raw").alias("point")).agg(F.sum(_n(rows)).alias("n"))
    counted = texts.groupBy(connection_family(F.col("point")).alias("family")).agg(F.sum("n").alias("count"))
    return counted.select("family", "count", _of_all(F.col("count"), F.col("count")).alias("pct_of_review")).orderBy(F.desc("count"), "family")


def pattern_counts(rows: DataFrame, limit: int | None = 30) -> DataFrame:
    """Patterns with the family of their first row by record_key. Texts are summed up before they are classed."""
    point, n = F.coalesce("connection_point_raw", F.lit("")), _n(rows)
    texts = reviews(rows).groupBy(point.alias("point")).agg(F.sum(n).alias("n"), _total(n, _unmapped()).alias("unmapped"), F.min("record_key").alias("first"))
    named = texts.select("n", "unmapped", "first", review_pattern(F.col("point")).alias("pattern"), connection_family(F.col("point")).alias("family"))
    found = named.groupBy("pattern").agg(F.min_by("family", F.struct("first", "family")).alias("family"), F.sum("n").alias("count"), F.sum("unmapped").alias("unmapped_count"))
    if limit is None:
        return found
    return found.orderBy(F.desc("count"), "pattern").limit(limit)


def examples(rows: DataFrame, limit: int = 5) -> DataFrame:
    """The first rows of each flag by record_key. A flag's rows meet as `limit` a bucket at most."""
    keep = ("record_key", "tu_number", "connection_point_raw", "confidence", "canonical_node_id", "parse_error")
    found = _issues(rows).select("flag", *keep).withColumn("_salt", F.pmod(F.xxhash64("record_key"), F.lit(64)))
    order = [F.col(c) for c in keep]
    part = found.withColumn("_n", F.row_number().over(Window.partitionBy("flag", "_salt").orderBy(*order))).where(F.col("_n") <= limit)
    ranked = part.withColumn("position", F.row_number().over(Window.partitionBy("flag").orderBy(*order))).where(F.col("position") <= limit)
    return ranked.drop("_salt", "_n")


def review_rows(rows: DataFrame) -> DataFrame:
    """The columns of the review file."""
    return reviews(rows).select(
        "record_key", "tu_number", "connection_point_raw", connection_family(F.col("connection_point_raw")).alias("family"), "activity_type",
        "canonical_node_id", "confidence", F.array_join(flag_list(F.col("flags")), "|").alias("flags"), "parse_error", "parent_object_type",
    )


def report(rows: DataFrame, example_limit: int = 5, pattern_limit: int = 30) -> dict:
    """All sections as plain values; each has few rows. The rows are read once for the counts and once for the examples."""
    dicts = lambda df: [r.asDict() for r in df.collect()]
    shown = ("tu_number", "connection_point_raw", "confidence", "canonical_node_id", "parse_error")
    by_flag: dict[str, list[dict]] = {}
    for r in examples(rows, example_limit).orderBy("flag", "position").collect():
        by_flag.setdefault(r["flag"], []).append({c: r[c] for c in shown})
    with erased_after(rows.sparkSession):
        counted = written(profiles(rows))
        return {
            "summary": dicts(summary(counted))[0],
            "flag_counts": dicts(flag_counts(counted)),
            "confidence_buckets": dicts(confidence_buckets(counted))[0],
            "review_families": dicts(family_counts(counted)),
            "top_review_patterns": dicts(pattern_counts(counted, pattern_limit)),
            "quick_wins": dicts(quick_wins(counted)),
            "examples": by_flag,
        }


# Titles and line forms of the console report.
SECTIONS = (
    ("TOP FLAGS", "flag_counts", "  {flag}: review={count} unmapped={unmapped_count} ({pct_of_review}% of review)"),
    ("REVIEW FAMILIES", "review_families", "  {family}: {count} ({pct_of_review}%)"),
    ("QUICK WINS", "quick_wins", "  {issue}: unmapped={unmapped_count} review={review_count}"),
    ("TOP REVIEW PATTERNS", "top_review_patterns", "  {family} count={count} unmapped={unmapped_count} :: {pattern}"),
)


def render(found: dict, top: int = 10, label: str = "QUALITY") -> str:
    s = found["summary"]
    lines = [
        f"{label} total={s['total_records']} mapped={s['mapped_records']} ({s['mapped_pct']}%) review={s['review_records']} ({s['review_pct']}%) "
        f"parse_errors={s['parse_error_records']} unknown_activity={s['unknown_activity_records']}"
    ]
    for title, section, form in SECTIONS:
        lines += [title, *(form.format(**r) for r in found[section][:top])]
    return "\n".join(lines)

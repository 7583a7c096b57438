"""Integrity audit: how many records each identity tells apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.functions.schemas import SOURCE_FIELDS
from gridlode.functions.text import filled


def audit(ided: DataFrame) -> DataFrame:
    """One row of seven counts, in one pass over the records.

    Rows are summed up by version first, which settles both other keys; grouping
    sets then count versions by logical record and by legacy key at once.
    """
    by_version = ided.groupBy("logical_tu_key", "row_fingerprint", "record_key").agg(F.count("*").alias("rows"))
    groups = by_version.groupingSets([["logical_tu_key"], ["record_key"]], "logical_tu_key", "record_key").agg(
        F.grouping("record_key").alias("logical"), F.sum("rows").alias("rows"), F.count("*").alias("versions")
    )
    logical = F.col("logical") == 1
    counts = groups.agg(
        F.coalesce(F.sum(F.when(logical, F.col("rows"))), F.lit(0)).alias("fetched_rows"),
        F.count_if(~logical).alias("legacy_unique_records"),
        F.coalesce(F.sum(F.when(logical, F.col("versions"))), F.lit(0)).alias("unique_row_versions"),
        F.count_if(logical).alias("unique_logical_tus"),
        F.count_if(logical & (F.col("versions") > 1)).alias("logical_tus_with_multiple_versions"),
    )
    return counts.select(
        "fetched_rows",
        "legacy_unique_records",
        (F.col("fetched_rows") - F.col("legacy_unique_records")).alias("legacy_collision_loss"),
        "unique_row_versions",
        "unique_logical_tus",
        (F.col("fetched_rows") - F.col("unique_row_versions")).alias("duplicate_observations"),
        "logical_tus_with_multiple_versions",
    )


def collision_groups(ided: DataFrame, top: int | None = 20) -> DataFrame:
    """Legacy keys that several observations share, the largest first."""
    # few keys are shared; only their rows go on
    shared = ided.groupBy("record_key").agg(F.count("*").alias("n")).where("n > 1").select("record_key")
    versions = ided.join(shared, "record_key", "left_semi").groupBy("record_key", "row_fingerprint", *SOURCE_FIELDS).agg(F.count("*").alias("rows"))
    several = [(F.min(F.struct(F.col(c).isNull(), c)) != F.max(F.struct(F.col(c).isNull(), c))).alias(f"_{c}") for c in SOURCE_FIELDS]
    groups = versions.groupBy(F.col("record_key").alias("legacy_record_key")).agg(
        F.sum("rows").alias("observation_count"),
        F.count_distinct("row_fingerprint").alias("distinct_row_versions"),
        F.array_sort(F.collect_set(filled(F.col("tu_number")))).alias("tu_numbers"),
        *several,
    )
    groups = groups.select(
        "legacy_record_key", "observation_count", "distinct_row_versions", "tu_numbers", F.array_compact(F.array(*(F.when(F.col(f"_{c}"), c) for c in SOURCE_FIELDS))).alias("differing_fields")
    )
    if top is None:
        return groups
    return groups.orderBy(F.desc("observation_count"), F.desc("distinct_row_versions"), "legacy_record_key").limit(top)


# Labels and line forms of the console report.
_LABELS = (
    ("fetched", "fetched_rows"), ("observations", None), ("row_versions", "unique_row_versions"), ("logical_tus", "unique_logical_tus"),
    ("legacy_unique", "legacy_unique_records"), ("legacy_loss", "legacy_collision_loss"), ("duplicates", "duplicate_observations"), ("multi_version_tus", "logical_tus_with_multiple_versions"),
)


def render(found: dict, observations: int, groups: list) -> str:
    """The console lines of an audit row and its collision groups."""
    lines = ["INTEGRITY " + " ".join(f"{n}={observations if c is None else found[c]}" for n, c in _LABELS)]
    if groups:
        lines.append("LEGACY COLLISIONS")
    for g in groups[:20]:
        who, what = ",".join(g["tu_numbers"]) or "<NO_TU>", ",".join(g["differing_fields"]) or "exact_duplicate"
        lines.append(f"  {who}: observations={g['observation_count']} versions={g['distinct_row_versions']} differs={what}")
    return "\n".join(lines)

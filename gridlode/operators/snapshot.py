"""Snapshot resolution: one logical record, or the fields on which its versions differ.

Observations are dealt out once, by what their logical key is made of, and summed
up by version, signature and record where they lie. Hashes are made after that:
their digits don't compress, and would be most of what is written to disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.functions.schemas import MATERIAL_FIELDS, SOURCE_FIELDS
from gridlode.operators.identity import key_of_parts, key_parts, order, row_fingerprint
from gridlode.operators.points import parse_records
from gridlode.sources.files import written


def versions(ided: DataFrame) -> DataFrame:
    """The first observation of each fingerprint, with the number of all."""
    columns = F.struct(*(c for c in ided.columns if c not in ("logical_tu_key", "row_fingerprint")))
    first = ided.groupBy("logical_tu_key", "row_fingerprint").agg(F.count("*").alias("observations"), F.min_by(columns, order()).alias("r"))
    return first.select("logical_tu_key", "row_fingerprint", "observations", "r.*")


def _dealt(rows: DataFrame, *more: str) -> tuple[list[str], DataFrame]:
    """Observations dealt out by the parts of their logical key: the parts' names, and those parts, all fields that hashes need and `more`."""
    parts = key_parts()
    columns = dict.fromkeys(("source", *SOURCE_FIELDS, *more))
    # where the source is a constant, it is taken out of what rows are grouped by: dealt out by it, they would be dealt out again
    return list(parts), rows.select(*columns, *(x.alias(c) for c, x in parts.items())).repartition(*(c for c in parts if c != "_k_source"))


def _differs(c: str) -> Column:
    return F.coalesce(F.min(c) != F.max(c), F.lit(False)) | ((F.count(c) > 0) & (F.count(c) < F.count("*")))


def resolve(found: DataFrame) -> DataFrame:
    """A row for each logical record: counts, status, conflicts, range and representative.

    `found` are observations or versions(). They are summed up by version, by
    material signature and by record.
    """
    if "observations" in found.columns:
        key, v = ["logical_tu_key"], found
    else:
        key, dealt = _dealt(found)
        v = dealt.withColumn("row_fingerprint", row_fingerprint()).groupBy(*key, "row_fingerprint", *MATERIAL_FIELDS).agg(F.count("*").alias("observations"))
    signatures = v.groupBy(*key, *MATERIAL_FIELDS).agg(F.sum("observations").alias("observations"), F.count("*").alias("versions"), F.min("row_fingerprint").alias("first"))
    by_key = signatures.groupBy(*key).agg(
        F.sum("observations").alias("observation_count"),
        F.sum("versions").alias("row_version_count"),
        F.count("*").alias("material_signature_count"),
        F.min("first").alias("first"),
        F.min("requested_power_kw").alias("low"),
        F.max("requested_power_kw").alias("high"),
        *(_differs(c).alias(f"_{c}") for c in MATERIAL_FIELDS),
    )
    if len(key) > 1:
        by_key = by_key.withColumn("logical_tu_key", key_of_parts())
    clear = F.col("material_signature_count") == 1
    conflicts = F.array_compact(F.array(*(F.when(F.col(f"_{c}"), c) for c in MATERIAL_FIELDS)))
    return by_key.select(
        "logical_tu_key",
        F.when(clear, "canonical").otherwise("ambiguous").alias("status"),
        F.when(clear, F.col("first")).alias("representative_fingerprint"),
        "observation_count",
        "row_version_count",
        "material_signature_count",
        F.when(clear, F.array().cast("array<string>")).otherwise(conflicts).alias("conflict_fields"),
        F.when(~clear, F.col("low")).alias("ambiguous_capacity_min_kw"),
        F.when(~clear, F.col("high")).alias("ambiguous_capacity_max_kw"),
    )


#: What settled() keeps of a canonical record; the fields of its signature settle it.
_CANONICAL = (*MATERIAL_FIELDS, "activity_type", "confidence", "needs_review")


def settled(rows: DataFrame) -> DataFrame:
    """A row for each logical record, without its versions: status, range in kW, the node that all its variants have (else null), and fields.

    `rows` are observations or parsed ones. Canonical records have their
    representative's fingerprint and fields, of parsed ones with those of the
    point, and their first time of collection; what isn't asked for takes no
    part. Rows are dealt out once.
    """
    fields = [c for c in _CANONICAL if c in rows.columns]
    parsed = "canonical_node_id" in rows.columns
    node = ["canonical_node_id"] if parsed else []
    key, dealt = _dealt(rows, *fields, *node, "fetched_at")
    rest = [F.first(c).alias(c) for c in (*fields, *node) if c not in MATERIAL_FIELDS]  # equal in a signature
    signatures = dealt.withColumn("row_fingerprint", row_fingerprint()).groupBy(*key, *MATERIAL_FIELDS).agg(F.min("row_fingerprint").alias("row_fingerprint"), F.min("fetched_at").alias("fetched_at"), *rest)
    by_key = signatures.groupBy(*key).agg(
        F.count("*").alias("_signatures"),
        F.min("requested_power_kw").alias("ambiguous_capacity_min_kw"),
        F.max("requested_power_kw").alias("ambiguous_capacity_max_kw"),
        F.first("row_fingerprint").alias("row_fingerprint"),
        F.first("fetched_at").alias("fetched_at"),
        *(F.first(c).alias(c) for c in fields),
        *(F.when(~_differs(c), F.min(c)).alias(c) for c in node),
    )
    clear = F.col("_signatures") == 1
    return by_key.select(
        key_of_parts().alias("logical_tu_key"),
        F.when(clear, "canonical").otherwise("ambiguous").alias("status"),
        *(F.when(~clear, F.col(c)).alias(c) for c in ("ambiguous_capacity_min_kw", "ambiguous_capacity_max_kw")),
        *(F.when(clear, F.col(c)).alias(c) for c in ("row_fingerprint", "fetched_at", *fields)),
        *node,
    )


def representatives(found: DataFrame, resolved: DataFrame) -> DataFrame:
    """The version that stands for each canonical logical record."""
    chosen = resolved.where(F.col("status") == "canonical").select("logical_tu_key", F.col("representative_fingerprint").alias("row_fingerprint"))
    return found.drop("observations").join(chosen, ["logical_tu_key", "row_fingerprint"])


def parse_canonical(found: DataFrame, resolved: DataFrame) -> DataFrame:
    """Canonical records of versions() parsed once, with key and fingerprint, by key."""
    return parse_records(representatives(found, resolved)).orderBy("logical_tu_key")


def ambiguous_variants(found: DataFrame, resolved: DataFrame) -> DataFrame:
    """Of each material signature of the ambiguous records, the version of the smallest fingerprint, parsed: the nodes' evidence, by key."""
    keys = resolved.where(F.col("status") == "ambiguous").select("logical_tu_key")
    v = found.drop("observations").join(keys, "logical_tu_key")
    rest = F.struct(*(c for c in v.columns if c not in ("logical_tu_key", *MATERIAL_FIELDS)))
    one = v.groupBy("logical_tu_key", *MATERIAL_FIELDS).agg(F.min_by(rest, F.col("row_fingerprint")).alias("r"))
    return parse_records(one.select("logical_tu_key", *MATERIAL_FIELDS, "r.*")).orderBy("logical_tu_key", "row_fingerprint")


class Snapshot:
    """One snapshot's versions and their resolution, each computed once and written."""

    def __init__(self, ided: DataFrame) -> None:
        self.versions = written(versions(ided))
        self.resolved = written(resolve(self.versions))

    def canonical(self) -> DataFrame:
        return parse_canonical(self.versions, self.resolved)

    def variants(self) -> DataFrame:
        return ambiguous_variants(self.versions, self.resolved)

    def as_of(self) -> DataFrame:
        """default_as_of() of the canonical records, without parsing them."""
        from gridlode.operators.metrics import default_as_of

        return default_as_of(representatives(self.versions.select("logical_tu_key", "row_fingerprint", "tu_date", "fetched_at"), self.resolved))

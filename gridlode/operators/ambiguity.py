"""Uncertain capacity by node."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.functions.schemas import AMBIGUITY_METRICS, EXPORT_METRICS


def exact_sum(x: Column) -> Column:
    """A sum of doubles that no order of rows can change."""
    return F.sum(x.cast("decimal(28,6)")).cast("double")


def whole_sum(x: Column) -> Column:
    """The sum, or null as soon as one part is unknown."""
    return F.when(F.count(x) == F.count(F.lit(1)), exact_sum(x))


def attributed(variants: DataFrame, resolved: DataFrame) -> DataFrame:
    """The node of each ambiguous record, null unless all variants have the same one, and its range in MW."""
    same = (F.count_distinct("canonical_node_id") == 1) & (F.count("canonical_node_id") == F.count(F.lit(1)))
    nodes = variants.groupBy("logical_tu_key").agg(F.when(same, F.min("canonical_node_id")).alias("canonical_node_id"))
    ranges = resolved.select("logical_tu_key", *((F.col(f"ambiguous_capacity_{s}_kw") / 1000).alias(f"{s}_mw") for s in ("min", "max")))
    return nodes.join(ranges, "logical_tu_key")


def of_settled(records: DataFrame) -> DataFrame:
    """attributed() of the rows of snapshot.settled(), without their keys."""
    mw = ((F.col(f"ambiguous_capacity_{s}_kw") / 1000).alias(f"{s}_mw") for s in ("min", "max"))
    return records.where("status = 'ambiguous'").select("canonical_node_id", *mw)


def _bucket() -> list[Column]:
    # a range is known at both ends or at neither
    return [F.count("*").cast("int").alias(AMBIGUITY_METRICS[0]), whole_sum(F.col("min_mw")).alias(AMBIGUITY_METRICS[1]), whole_sum(F.col("max_mw")).alias(AMBIGUITY_METRICS[2])]


def by_node(found: DataFrame) -> DataFrame:
    return found.where("canonical_node_id is not null").groupBy("canonical_node_id").agg(*_bucket())


def _zero_if_none(df: DataFrame) -> DataFrame:
    none = F.col(AMBIGUITY_METRICS[0]) == 0
    return df.select(AMBIGUITY_METRICS[0], *(F.when(none, 0.0).otherwise(F.col(c)).alias(c) for c in AMBIGUITY_METRICS[1:]))


def unassigned(found: DataFrame) -> DataFrame:
    """One row: records without a single node."""
    return _zero_if_none(found.where("canonical_node_id is null").agg(*_bucket()))


def overall(resolved: DataFrame) -> DataFrame:
    """One row: all ambiguous records."""
    ranges = resolved.where("status = 'ambiguous'").select(*((F.col(f"ambiguous_capacity_{s}_kw") / 1000).alias(f"{s}_mw") for s in ("min", "max")))
    return _zero_if_none(ranges.agg(*_bucket()))


def overall_counters() -> dict[str, Column]:
    """overall() as aggregates to be observed while resolutions are written."""
    found = {"ambiguous_n": F.count_if(F.col("status") == "ambiguous")}
    for s in ("min", "max"):
        mw = F.when(F.col("status") == "ambiguous", F.col(f"ambiguous_capacity_{s}_kw") / 1000)
        found |= {f"{s}_known": F.count(mw), f"{s}_mw": exact_sum(mw)}
    return found


def overall_of(found: dict) -> tuple[float | None, float | None]:
    """The ends of the range in MW from what was observed: 0 of no record, unknown if one part is."""
    n = found["ambiguous_n"]
    return tuple(0.0 if not n else found[f"{s}_mw"] if found[f"{s}_known"] == n else None for s in ("min", "max"))


def with_ambiguity(nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """Node metrics with their buckets; a node known only from ambiguous records gets zero metrics."""
    metrics = [c for c in EXPORT_METRICS if c in nodes.columns and c not in AMBIGUITY_METRICS]
    joined = nodes.drop(*AMBIGUITY_METRICS).withColumn("_node", F.lit(True)).join(buckets.withColumn("_bucket", F.lit(True)), "canonical_node_id", "full_outer")
    zero = {c: F.lit(None) if c == "generation_load_ratio" else F.lit(0) for c in metrics}
    kinds = dict(nodes.dtypes)
    return joined.select(
        "canonical_node_id",
        *(F.when(F.col("_node"), F.col(c)).otherwise(zero[c].cast(kinds[c])).alias(c) for c in metrics),
        F.coalesce(AMBIGUITY_METRICS[0], F.lit(0)).alias(AMBIGUITY_METRICS[0]),
        *(F.when(F.col("_bucket").isNull(), 0.0).otherwise(F.col(c)).alias(c) for c in AMBIGUITY_METRICS[1:]),
    )

"""Node metrics: capacity, calendar windows, velocity, shares and mid-rank pressure."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlode.functions.schemas import EXPORT_METRICS, FAMILIES
from gridlode.functions.text import filled, metric_family
from gridlode.functions.values import iso_date
from gridlode.sources.files import written

WINDOWS = (3, 6, 12)
RANGES = 64


def dated(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("_date", iso_date(F.col("tu_date")))


def default_as_of(parsed: DataFrame) -> DataFrame:
    """One row: the latest date of all records, else of their collection, else today."""
    return dated(parsed).agg(F.coalesce(F.max("_date"), F.max(F.to_date("fetched_at")), F.current_date()).alias("as_of"))


def stats(parsed: DataFrame) -> DataFrame:
    """One row: total, mapped, unmapped records and those without a valid date."""
    mapped = filled(F.col("canonical_node_id")).isNotNull()
    return dated(parsed).agg(
        F.count("*").alias("total_records"), F.count_if(mapped).alias("mapped_records"), F.count_if(~mapped).alias("unmapped_records"), F.count_if(F.col("_date").isNull()).alias("invalid_date_records")
    )


def node_sums(parsed: DataFrame, as_of: datetime.date | DataFrame | None = None) -> DataFrame:
    """Everything about a node that needs no other node; as_of is a date, or one row of it, or taken from the records."""
    rows = dated(parsed.where(filled(F.col("canonical_node_id")).isNotNull()))
    if isinstance(as_of, datetime.date):
        rows = rows.withColumn("as_of", F.lit(as_of))
    else:
        rows = rows.crossJoin(F.broadcast(default_as_of(parsed) if as_of is None else as_of))  # one row
    age = F.when(F.col("_date") <= F.col("as_of"), F.lit(99))  # months of the narrowest window that holds the date
    for months in reversed(WINDOWS):
        age = F.when(F.col("_date").between(F.add_months("as_of", -months), F.col("as_of")), months).otherwise(age)
    rows = rows.select(
        "canonical_node_id", F.coalesce("needs_review", F.lit(False)).cast("int").alias("_review"), F.col("confidence").cast("decimal(28,6)").alias("_sure"),
        metric_family(F.col("activity_type")).alias("_family"), F.coalesce(age, F.lit(99)).alias("_age"), (F.coalesce("requested_power_kw", F.lit(0.0)) / 1000).cast("decimal(28,6)").alias("_mw"),
    )
    # a row for each node, family and window first: few rows then take the many conditional sums
    parts = rows.groupBy("canonical_node_id", "_family", "_age").agg(F.sum("_mw").alias("_mw"), F.count("*").alias("_n"), F.sum("_review").alias("_review"), F.sum("_sure").alias("_sure"))

    def total(what: str, family: str, months: int = 99) -> Column:
        return F.coalesce(F.sum(F.when((F.col("_family") == family) & (F.col("_age") <= months), F.col(what))), F.lit(0))

    sums = parts.groupBy("canonical_node_id").agg(
        *(total("_mw", f).cast("double").alias(f"{f}_mw") for f in (*FAMILIES, "other")),
        *(total("_n", f).cast("int").alias(f"{f}_tu_count") for f in (*FAMILIES, "other")),
        *(total("_mw", f, m).cast("double").alias(f"{f}_{m}m_mw") for f in FAMILIES for m in WINDOWS),
        *(total("_n", f, m).cast("int").alias(f"{f}_tu_{m}m_count") for f in FAMILIES for m in (3, 12)),
        F.sum("_review").cast("int").alias("review_count"),
        (100 * F.sum("_sure").cast("double") / F.sum("_n")).alias("data_confidence"),
    )
    all_mw = F.col("generation_mw") + F.col("load_mw") + F.col("bess_mw")
    return sums.select(
        "*",
        *((F.col(f"{f}_tu_{m}m_count") / float(m)).alias(f"{f}_tu_velocity_{m}m_per_month") for f in FAMILIES for m in (3, 12)),
        F.when(F.col("load_mw") > 0, F.col("generation_mw") / F.col("load_mw")).alias("generation_load_ratio"),
        (F.col("generation_mw") - F.col("load_mw")).alias("net_tu_imbalance_mw"),
        F.when(all_mw > 0, F.col("bess_mw") / all_mw).otherwise(0.0).alias("bess_share"),
    )


def mid_rank(nodes: DataFrame, columns: dict[str, str], key: str = "canonical_node_id") -> DataFrame:
    """nodes with the mid-rank percentile of each column: 0 up to a value of 0, 100 in a population of one.

    Ranks come from the different values: their counts are summed up in order
    within RANGES ranges of values first and over the ranges then, so no task
    sees all of them. The ranges' ends are approximate quantiles, in one row;
    computed again, they could be others, so the counts by range are written.
    `nodes` is read four times, so it should be a written table.
    """
    quantiles = [F.percentile_approx(F.col(c).cast("double"), [k / RANGES for k in range(1, RANGES)], 1000).alias(f"_cuts_{out}") for c, out in columns.items()]
    ends = F.broadcast(nodes.agg(F.count("*").alias("_n"), *quantiles))  # one row
    values = F.array(*(F.struct(F.lit(out).alias("name"), F.col(c).cast("double").alias("value"), F.col(f"_cuts_{out}").alias("cuts")) for c, out in columns.items()))
    long = nodes.crossJoin(ends).select(key, "_n", F.explode(values).alias("v")).select(key, "_n", "v.*")
    place = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")), lambda cut: cut < F.col("value")))
    counts = written(long.groupBy("name", "value", place.alias("range")).agg(F.count("*").alias("equal"), F.first("_n").alias("_n")))
    starts = counts.groupBy("name", "range").agg(F.sum("equal").alias("all"))
    starts = starts.select("name", "range", (F.sum("all").over(Window.partitionBy("name").orderBy("range")) - F.col("all")).alias("start"))  # RANGES rows a name
    within = F.sum("equal").over(Window.partitionBy("name", "range").orderBy("value")) - F.col("equal")
    less = counts.withColumn("within", within).join(F.broadcast(starts), ["name", "range"]).select("name", "value", "equal", "_n", (F.col("within") + F.col("start")).alias("less"))
    plain = F.array(*(F.struct(F.lit(out).alias("name"), F.col(c).cast("double").alias("value")) for c, out in columns.items()))
    rank = F.when(F.col("_n") <= 1, 100.0).otherwise(100.0 * (F.col("less") + (F.col("equal") - 1) / 2) / F.nullif(F.col("_n") - 1, F.lit(0)))
    ranked = nodes.select(key, F.explode(plain).alias("v")).select(key, "v.*").where("value > 0").join(less, ["name", "value"]).select(key, "name", rank.alias("rank"))
    wide = ranked.groupBy(key).agg(*(F.max(F.when(F.col("name") == out, F.col("rank"))).alias(out) for out in columns.values()))
    return nodes.join(wide, key, "left").select(*nodes.columns, *(F.coalesce(out, F.lit(0.0)).alias(out) for out in columns.values()))


def with_pressure(nodes: DataFrame) -> DataFrame:
    ranks = {f"{f}_mw": f"_{f}_mw" for f in FAMILIES} | {f"{f}_tu_velocity_3m_per_month": f"_{f}_v" for f in FAMILIES}
    ranked = mid_rank(nodes, ranks)
    pressure = [F.rint(0.7 * F.col(f"_{f}_mw") + 0.3 * F.col(f"_{f}_v")).cast("int").alias(f"{f}_pressure") for f in FAMILIES]
    return ranked.select("*", *pressure).drop(*ranks.values())


def aggregate_nodes(parsed: DataFrame, as_of: datetime.date | None = None) -> DataFrame:
    """All metrics of all nodes, without ambiguity, by node."""
    nodes = with_pressure(written(node_sums(parsed, as_of)))
    return nodes.select("canonical_node_id", *(c for c in EXPORT_METRICS if c in nodes.columns)).orderBy("canonical_node_id")

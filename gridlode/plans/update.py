"""The daily update: collect, store without loss, resolve, parse, aggregate, publish."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlode.functions.schemas import AMBIGUITY_METRICS, EXPORT_METRICS, METRICS, PARSED_FIELDS
from gridlode.functions.text import filled
from gridlode.functions.values import iso_date
from gridlode.operators import ambiguity, integrity, metrics, quality, snapshot
from gridlode.operators.identity import observation_key, order, with_identities
from gridlode.operators.points import parse_records
from gridlode.sources.files import erased_after
from gridlode.sources.store import Store, best_by_node, first_wins, last_wins


@dataclass
class Summary:
    run_id: int
    snapshot_date: datetime.date
    raw_count: int = 0
    parsed_count: int = 0
    mapped_count: int = 0
    node_count: int = 0
    review_count: int = 0
    observation_count: int = 0
    row_version_count: int = 0
    integrity_audit: dict | None = None
    canonical_count: int = 0
    ambiguous_count: int = 0
    metadata_collapsed_count: int = 0
    canonical_mapped_count: int = 0
    canonical_review_count: int = 0
    canonical_node_count: int = 0
    unassigned_ambiguous_count: int = 0
    ambiguous_capacity_min_mw: float | None = None
    ambiguous_capacity_max_mw: float | None = None

    def counts(self) -> dict[str, int]:
        return {k: v for k, v in self.__dict__.items() if isinstance(v, int) and k != "run_id"}


def today() -> datetime.date:
    return datetime.datetime.now(datetime.timezone.utc).date()


def run_update(spark: SparkSession, raw: DataFrame, store: Store, source: str, as_of: datetime.date | None = None) -> Summary:
    """One run over raw records. A failure leaves the run's parts unpublished and the run marked as failed."""
    run_id, as_of = store.start_run(source), as_of or today()
    try:
        with erased_after(spark):
            summary = _run(raw, store, run_id, as_of)
    except Exception as e:
        store.finish_run(run_id, "failed", {}, str(e))
        raise
    store.finish_run(run_id, "success", summary.counts())
    return summary


def _run(raw: DataFrame, store: Store, run_id: int, as_of: datetime.date) -> Summary:
    """The run's tables in the order of their references. Counters are observed on the rows as they are written."""
    s = Summary(run_id, as_of)
    every = F.count(F.lit(1))
    # the run's own copy: later steps read it, not the registry, again
    store.write_run("staged", run_id, with_identities(raw))
    ided = store.read_run("staged", run_id)

    s.integrity_audit = integrity.audit(ided).first().asDict()
    s.raw_count = s.integrity_audit["fetched_rows"]
    seen = [F.col("fetched_at").alias("first_seen_at"), F.col("fetched_at").alias("last_seen_at")]
    at_first = first_wins(ided, ["row_fingerprint"], order())
    s.row_version_count = store.upsert("tu_row_versions", at_first.select("*", *seen), ["row_fingerprint"], {"first_seen_at": "keep_old", "last_seen_at": "greatest"})
    keyed = ided.select(observation_key(F.lit(run_id)).alias("observation_key"), "row_fingerprint", "source_page", "source_row_index", "fetched_at")
    # the key holds the run, so a run's observations are a part of their own and no other is touched
    s.observation_count = store.write_run("tu_observations", run_id, first_wins(keyed, ["observation_key"], order()), n=every)["n"]

    snap = snapshot.Snapshot(ided)
    clear = F.col("status") == "canonical"
    counters = {"canonical": F.count_if(clear), "ambiguous": F.count_if(~clear), "collapsed": F.count_if(clear & (F.col("row_version_count") > 1))}
    got = store.write_run("tu_snapshot_resolution", run_id, snap.resolved, **counters, **ambiguity.overall_counters())
    s.canonical_count, s.ambiguous_count, s.metadata_collapsed_count = (got[c] for c in counters)
    s.ambiguous_capacity_min_mw, s.ambiguous_capacity_max_mw = ambiguity.overall_of(got)
    resolved = store.read_run("tu_snapshot_resolution", run_id)
    mapped, review = F.count_if(filled(F.col("canonical_node_id")).isNotNull()), F.count_if(F.coalesce("needs_review", F.lit(False)))
    got = store.write_run("tu_canonical_parsed", run_id, snap.canonical(), mapped=mapped, review=review)
    s.canonical_mapped_count, s.canonical_review_count = got["mapped"], got["review"]
    canonical = store.read_run("tu_canonical_parsed", run_id)
    store.write_run("node_evidence", run_id, snap.variants())

    got = store.write_run("legacy_parsed", run_id, parse_records(ided), parsed=every, mapped=mapped, review=review)
    s.parsed_count, s.mapped_count, s.review_count = got["parsed"], got["mapped"], got["review"]
    legacy = store.read_run("legacy_parsed", run_id)
    by_place: Column = F.struct("source_page", "source_row_index", "row_fingerprint")
    raw_columns = [c for c in ided.columns if c not in ("row_fingerprint", "logical_tu_key")]
    latest = last_wins(ided, ["record_key"], by_place).select(*raw_columns, *seen)
    store.upsert("tu_raw", latest, ["record_key"], {"first_seen_at": "keep_old"})
    own = ["record_key", *PARSED_FIELDS]
    store.upsert("tu_parsed", last_wins(legacy, ["record_key"], by_place).select(*own), ["record_key"])

    best = best_by_node(legacy, by_place).select(
        "canonical_node_id", F.col("parent_object_type").alias("object_type"), F.col("parent_number").alias("number"), F.col("parent_name").alias("name"),
        F.col("parent_voltage_levels_kv").alias("voltage_levels_kv"), F.lit(as_of).cast("timestamp").alias("first_seen_at"), F.lit(as_of).cast("timestamp").alias("last_seen_at"),
    )
    rules = {"object_type": "coalesce", "number": "coalesce", "name": "coalesce", "voltage_levels_kv": "filled_array", "first_seen_at": "least", "last_seen_at": "greatest"}
    s.node_count = store.upsert("grid_nodes", best, ["canonical_node_id"], rules)
    day = F.lit(as_of).alias("snapshot_date")
    nodes_v1 = metrics.aggregate_nodes(legacy, as_of)
    store.upsert(f"node_metrics/snapshot_date={as_of}", nodes_v1.select("canonical_node_id", day, *METRICS), ["canonical_node_id", "snapshot_date"])

    found = ambiguity.attributed(store.read_run("node_evidence", run_id), resolved)
    s.unassigned_ambiguous_count = store.write_run("node_ambiguity", run_id, found, n=F.count_if(F.col("canonical_node_id").isNull()))["n"]
    found = store.read_run("node_ambiguity", run_id)
    nodes_v2 = ambiguity.with_ambiguity(metrics.aggregate_nodes(canonical, as_of), ambiguity.by_node(found))
    s.canonical_node_count = store.write_run("node_metrics_v2", run_id, nodes_v2.select("canonical_node_id", day, *METRICS, *AMBIGUITY_METRICS), n=every)["n"]
    return s


QUALITY_FIELDS = ("record_key", "tu_number", "connection_point_raw", "activity_type", "canonical_node_id", "confidence", "needs_review", "flags", "parse_error", "parent_object_type")


def quality_rows_v1(store: Store) -> DataFrame:
    """Legacy records with their raw text, by key."""
    raw = store.read("tu_raw").select("record_key", "tu_number", "connection_point_raw")
    rows = store.read("tu_parsed").drop("tu_number", "connection_point_raw").join(raw, "record_key")
    return rows.select(*QUALITY_FIELDS).orderBy("record_key")


def quality_rows_v2(store: Store, run_id: int) -> DataFrame:
    """A run's canonical records with their version's text, by key; the logical key stands for the record key."""
    versions = store.read("tu_row_versions").select("row_fingerprint", "tu_number", "connection_point_raw")
    rows = store.read_run("tu_canonical_parsed", run_id).drop("record_key", "tu_number", "connection_point_raw").withColumnRenamed("logical_tu_key", "record_key")
    return rows.join(versions, "row_fingerprint").select(*QUALITY_FIELDS).orderBy("record_key")


def mw_text(value: float | None) -> str:
    return "unknown" if value is None else f"{round(value, 6)}".rstrip("0").rstrip(".")


def render_canonical(s: Summary) -> str:
    return (
        f"CANONICAL run_id={s.run_id} canonical={s.canonical_count} ambiguous={s.ambiguous_count} metadata_collapsed={s.metadata_collapsed_count} "
        f"ambiguous_min_mw={mw_text(s.ambiguous_capacity_min_mw)} ambiguous_max_mw={mw_text(s.ambiguous_capacity_max_mw)} unassigned_ambiguous={s.unassigned_ambiguous_count}"
    )


def reports(store: Store, s: Summary) -> str:
    """The console text of a run."""
    groups = integrity.collision_groups(store.read_run("staged", s.run_id)).collect()
    return "\n".join(
        [
            integrity.render(s.integrity_audit, s.observation_count, groups),
            render_canonical(s),
            quality.render(quality.report(quality_rows_v1(store))),
            quality.render(quality.report(quality_rows_v2(store, s.run_id)), label="QUALITY_V2"),
        ]
    )


def export_columns() -> tuple[str, ...]:
    return ("canonical_node_id", *EXPORT_METRICS)


def latest_date(parsed: DataFrame) -> datetime.date | None:
    return parsed.agg(F.max(iso_date(F.col("tu_date")))).first()[0]

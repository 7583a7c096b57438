"""Queries that run the update as a whole, sinks and scans, on the small registry of the adapter.

Two runs fill a store: the first, of 2001-12-01, lacks a third of the records;
the second, of 2001-12-31, has all. Each query reads one of the tables.
"""

from __future__ import annotations

import contextlib
import datetime
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlode.functions import text as T
from gridlode.functions.schemas import MATERIAL_FIELDS, PARSED_FIELDS
from gridlode.operators import integrity, metrics, quality, snapshot
from gridlode.operators.points import parse_records, parse_records_with
from gridlode.plans import adapter, update
from gridlode.plans.catalogue import _P, _VARIES, ORACLE, QUERIES, _observed, query
from gridlode.sources import buckets, export, pages, store
from gridlode.sources.files import scratch_dir

DAYS = (datetime.date(2001, 12, 1), datetime.date(2001, 12, 31))
_runs: dict[tuple[str, str], tuple[store.Store, update.Summary]] = {}


def updated(spark, sf_dir: str) -> tuple[store.Store, update.Summary]:
    """The store after both runs, filled once a session, and the second run's summary."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _runs:
        kept = store.Store(spark, _folder(spark, "registry"))
        for first, day in zip((True, False), DAYS):
            summary = update.run_update(spark, adapter.observed(spark, sf_dir, first), kept, "reg", day)
        _runs[key] = kept, summary
    return _runs[key]


_LAST = "lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY source_page DESC) AS k, bool_or(j < 2) OVER (PARTITION BY record_key) AS early FROM so) WHERE k = 1)"
_SEEN = "CASE WHEN early THEN '2001-12-01' ELSE '2001-12-31' END"
_day = lambda c: F.date_format(c, "yyyy-MM-dd")


@query(f", {_LAST} SELECT record_key, source_page, contract_number, requested_power_kw, {_SEEN} AS first_seen, '2001-12-31' AS last_seen FROM lt", records="observed")
def stored_raw(spark, d):
    rows = updated(spark, d)[0].read("tu_raw")
    return rows.select("record_key", "source_page", "contract_number", "requested_power_kw", _day("first_seen_at").alias("first_seen"), _day("last_seen_at").alias("last_seen"))


@query(f", {_LAST} SELECT record_key, source_page, canonical_node_id, confidence, needs_review, flags, activity_type, parent_object_type FROM lt", records="observed")
def stored_parsed(spark, d):
    rows = updated(spark, d)[0].read("tu_parsed")
    return rows.select("record_key", "source_page", "canonical_node_id", "confidence", "needs_review", F.array_join("flags", ",").alias("flags"), "activity_type", "parent_object_type")


@query(
    """SELECT canonical_node_id, min(parent_object_type) AS object_type, min(CASE WHEN kind = 1 THEN node || '-1' ELSE CAST(node AS VARCHAR) END) AS number,
    min(CASE WHEN kind IN (0, 4) THEN 'Вузол' END) AS name, max(CASE kind WHEN 0 THEN '35.0/10.0' WHEN 2 THEN '10.0/0.4' ELSE '' END) AS levels,
    CASE WHEN bool_or(j < 2) THEN '2001-12-01' ELSE '2001-12-31' END AS first_seen, '2001-12-31' AS last_seen FROM so WHERE canonical_node_id IS NOT NULL GROUP BY 1""",
    records="observed",
)
def stored_nodes(spark, d):
    levels = F.array_join("voltage_levels_kv", "/").alias("levels")
    return updated(spark, d)[0].read("grid_nodes").select("canonical_node_id", "object_type", "number", "name", levels, _day("first_seen_at").alias("first_seen"), _day("last_seen_at").alias("last_seen"))


_MW = lambda keep: f"coalesce(CAST(sum(CAST(CASE WHEN {keep} THEN coalesce(requested_power_kw, 0) / 1000 END AS DECIMAL(28,6))) AS DOUBLE), 0)"
_OF_NODE = f"""{_MW('n % 4 = 0')} AS generation_mw, {_MW('n % 4 = 1')} AS load_mw, {_MW('n % 4 = 2')} AS bess_mw, {_MW('n % 4 = 3')} AS other_mw,
  CAST(count(*) FILTER (n % 4 = 0) AS INTEGER) AS generation_tu_count, CAST(count(*) FILTER (needs_review) AS INTEGER) AS review_count"""
_NODE_FIELDS = ("generation_mw", "load_mw", "bess_mw", "other_mw", "generation_tu_count", "review_count")


@query(
    f""", two AS (SELECT *, '2001-12-01' AS day FROM so WHERE j < 2 UNION ALL SELECT *, '2001-12-31' FROM so)
    SELECT canonical_node_id, day, {_OF_NODE} FROM two WHERE canonical_node_id IS NOT NULL GROUP BY 1, 2""",
    records="observed",
)
def stored_metrics(spark, d):
    return updated(spark, d)[0].read_parts("node_metrics").select("canonical_node_id", _day("snapshot_date").alias("day"), *_NODE_FIELDS)


@query("SELECT row_fingerprint, min(source_page) AS source_page, CASE WHEN bool_or(j < 2) THEN '2001-12-01' ELSE '2001-12-31' END AS first_seen, '2001-12-31' AS last_seen FROM so GROUP BY 1", records="observed")
def stored_versions(spark, d):
    return updated(spark, d)[0].read("tu_row_versions").select("row_fingerprint", "source_page", _day("first_seen_at").alias("first_seen"), _day("last_seen_at").alias("last_seen"))


@query("SELECT observation_key, row_fingerprint, source_page, 2::BIGINT AS run FROM so", records="observed")
def stored_observations(spark, d):
    rows = updated(spark, d)[0].read_runs("tu_observations").where("run_id = 2")
    return rows.select("observation_key", "row_fingerprint", "source_page", F.col("run_id").cast("bigint").alias("run"))


_SIGNED = ", ".join(c if c in ("tu_date", "installation_type", "connection_point_raw", "voltage_raw", "requested_power_kw") else "'c'" for c in MATERIAL_FIELDS)
_RESOLVED = f"""res AS (SELECT logical_tu_key, count(*) AS observation_count, count(DISTINCT row_fingerprint) AS row_version_count, count(DISTINCT row({_SIGNED})) AS sigs, min(row_fingerprint) AS fp,
  min(requested_power_kw) AS lo, max(requested_power_kw) AS hi, {_VARIES(["requested_power_kw"])} AS conflicts FROM so GROUP BY 1)"""


@query(
    f""", {_RESOLVED} SELECT logical_tu_key, CASE WHEN sigs = 1 THEN 'canonical' ELSE 'ambiguous' END AS status, CASE WHEN sigs = 1 THEN fp END AS representative_fingerprint, observation_count, row_version_count,
    sigs AS material_signature_count, CASE WHEN sigs = 1 THEN '' ELSE conflicts END AS conflict_fields, CASE WHEN sigs > 1 THEN lo END AS low, CASE WHEN sigs > 1 THEN hi END AS high FROM res""",
    records="observed",
)
def stored_resolutions(spark, d):
    rows = updated(spark, d)[0].read_run("tu_snapshot_resolution", 2)
    counts = ("observation_count", "row_version_count", "material_signature_count")
    ends = (F.col("ambiguous_capacity_min_kw").alias("low"), F.col("ambiguous_capacity_max_kw").alias("high"))
    return rows.select("logical_tu_key", "status", "representative_fingerprint", *counts, F.array_join("conflict_fields", ",").alias("conflict_fields"), *ends)


_CANONICAL = f"{_RESOLVED}, cp AS (SELECT so.* FROM res JOIN (SELECT *, row_number() OVER (PARTITION BY row_fingerprint ORDER BY source_page) AS k FROM so) so ON so.row_fingerprint = fp AND k = 1 WHERE sigs = 1)"


@query(f", {_CANONICAL} SELECT logical_tu_key, row_fingerprint, source_page, canonical_node_id, confidence FROM cp", records="observed")
def stored_canonical(spark, d):
    return updated(spark, d)[0].read_run("tu_canonical_parsed", 2).select("logical_tu_key", "row_fingerprint", "source_page", "canonical_node_id", "confidence")


@query(
    f""", {_CANONICAL}, cm AS (SELECT canonical_node_id, {_OF_NODE} FROM cp WHERE canonical_node_id IS NOT NULL GROUP BY 1),
    am AS (SELECT canonical_node_id AS node, CAST(count(*) AS INTEGER) AS ambiguous_tu_count, CASE WHEN count(lo) = count(*) THEN CAST(sum(CAST(lo AS DECIMAL(28,6))) AS DOUBLE) END AS low
      FROM (SELECT logical_tu_key, min(canonical_node_id) AS canonical_node_id, any_value(lo) / 1000 AS lo FROM res JOIN so USING (logical_tu_key) WHERE sigs > 1 GROUP BY 1) WHERE canonical_node_id IS NOT NULL GROUP BY 1)
    SELECT coalesce(canonical_node_id, node) AS canonical_node_id, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _NODE_FIELDS)}, coalesce(ambiguous_tu_count, 0) AS ambiguous_tu_count, CASE WHEN node IS NULL THEN 0 ELSE low END AS low
    FROM cm FULL OUTER JOIN am ON canonical_node_id = node""",
    records="observed",
)
def stored_metrics_v2(spark, d):
    rows = updated(spark, d)[0].read_run("node_metrics_v2", 2)
    return rows.select("canonical_node_id", *_NODE_FIELDS, "ambiguous_tu_count", F.col("ambiguous_capacity_min_mw").alias("low"))


@query(f", {_RESOLVED} SELECT canonical_node_id, logical_tu_key, min(row_fingerprint) AS row_fingerprint FROM res JOIN so USING (logical_tu_key) WHERE sigs > 1 GROUP BY 1, 2, requested_power_kw", records="observed")
def node_evidence(spark, d):
    return updated(spark, d)[0].read_run("node_evidence", 2).select("canonical_node_id", "logical_tu_key", "row_fingerprint")


@query(
    """SELECT unnest([1, 2]) AS id, 'reg' AS source, 'success' AS status, unnest([(SELECT count(*) FROM so WHERE j < 2), (SELECT count(*) FROM so)]) AS raw_count,
    unnest([(SELECT count(DISTINCT row_fingerprint) FROM so WHERE j < 2), (SELECT count(DISTINCT row_fingerprint) FROM so)]) AS row_version_count""",
    records="observed",
)
def run_log(spark, d):
    counts = (F.col("counts")[c].alias(c) for c in ("raw_count", "row_version_count"))
    return updated(spark, d)[0].runs().where(F.col("finished_at") >= F.col("started_at")).select("id", "source", "status", *counts)


_COUNTED = {
    "raw_count": "(SELECT count(*) FROM so)",
    "observation_count": "(SELECT count(*) FROM so)",
    "parsed_count": "(SELECT count(*) FROM so)",
    "mapped_count": "(SELECT count(canonical_node_id) FROM so)",
    "review_count": "(SELECT count(*) FROM so WHERE needs_review)",
    "node_count": "(SELECT count(DISTINCT canonical_node_id) FROM so)",
    "row_version_count": "(SELECT count(DISTINCT row_fingerprint) FROM so)",
    "canonical_count": "(SELECT count(*) FROM res WHERE sigs = 1)",
    "ambiguous_count": "(SELECT count(*) FROM res WHERE sigs > 1)",
    "metadata_collapsed_count": "(SELECT count(*) FROM res WHERE sigs = 1 AND row_version_count > 1)",
    "canonical_mapped_count": "(SELECT count(canonical_node_id) FROM cp)",
    "canonical_review_count": "(SELECT count(*) FROM cp WHERE needs_review)",
    "canonical_node_count": "(SELECT count(DISTINCT canonical_node_id) FROM so)",
    "unassigned_ambiguous_count": "(SELECT count(*) FROM res JOIN (SELECT logical_tu_key, any_value(kind) AS kind FROM so GROUP BY 1) USING (logical_tu_key) WHERE sigs > 1 AND kind = 3)",
}


@query(f", {_CANONICAL} " + " UNION ALL ".join(f"SELECT '{k}' AS counter, {v} AS n" for k, v in _COUNTED.items()), records="observed")
def run_counters(spark, d):
    counts = updated(spark, d)[1].counts()
    return spark.createDataFrame([(k, counts[k]) for k in _COUNTED], "counter string, n bigint")


_V1 = f"{_LAST} SELECT record_key, tu_number, connection_point_raw, activity_type, canonical_node_id, confidence, needs_review, flags, parent_object_type FROM lt"


@query(f", {_V1}", records="observed")
def quality_join_v1(spark, d):
    return update.quality_rows_v1(updated(spark, d)[0]).withColumn("flags", F.array_join("flags", ",")).drop("parse_error")


@query(f", {_CANONICAL} SELECT logical_tu_key AS record_key, tu_number, connection_point_raw, activity_type, canonical_node_id, confidence, needs_review, flags, parent_object_type FROM cp", records="observed")
def quality_join_v2(spark, d):
    return update.quality_rows_v2(updated(spark, d)[0], 2).withColumn("flags", F.array_join("flags", ",")).drop("parse_error")


def _lines(spark, text: str):
    return spark.createDataFrame(list(enumerate(text.split("\n"))), "line int, text string")


_DISTINCT = "count(DISTINCT {})"


@query(
    f""", {_RESOLVED}, g AS (SELECT record_key, count(*) AS n, count(DISTINCT row_fingerprint) AS v, min(tu_number) AS t, {_VARIES(["contract_number"])} AS f FROM so GROUP BY 1 HAVING count(*) > 1),
    top AS (SELECT *, row_number() OVER (ORDER BY n DESC, v DESC, record_key) AS k FROM g)
    SELECT 0 AS line, 'INTEGRITY fetched=' || count(*) || ' observations=' || count(*) || ' row_versions=' || count(DISTINCT row_fingerprint) || ' logical_tus=' || count(DISTINCT logical_tu_key)
      || ' legacy_unique=' || count(DISTINCT record_key) || ' legacy_loss=' || (count(*) - count(DISTINCT record_key)) || ' duplicates=' || (count(*) - count(DISTINCT row_fingerprint))
      || ' multi_version_tus=' || (SELECT count(*) FROM res WHERE row_version_count > 1) AS text FROM so
    UNION ALL SELECT 1, 'LEGACY COLLISIONS' UNION ALL SELECT k + 1, '  ' || t || ': observations=' || n || ' versions=' || v || ' differs=' || f FROM top WHERE k <= 20""",
    records="observed",
)
def integrity_console(spark, d):
    kept, summary = updated(spark, d)
    return _lines(spark, integrity.render(summary.integrity_audit, summary.observation_count, integrity.collision_groups(kept.read_run("staged", 2)).collect()))


@query(
    f""", {_RESOLVED} SELECT 'CANONICAL run_id=2 canonical=' || count(*) FILTER (sigs = 1) || ' ambiguous=' || count(*) FILTER (sigs > 1) || ' metadata_collapsed=' || count(*) FILTER (sigs = 1 AND row_version_count > 1)
    || ' ambiguous_min_mw=' || coalesce(printf('%.12g', round(CAST(sum(CAST(CASE WHEN sigs > 1 THEN lo / 1000 END AS DECIMAL(28,6))) AS DOUBLE), 6)), 'unknown')
    || ' ambiguous_max_mw=' || coalesce(printf('%.12g', round(CAST(sum(CAST(CASE WHEN sigs > 1 THEN hi / 1000 END AS DECIMAL(28,6))) AS DOUBLE), 6)), 'unknown')
    || ' unassigned_ambiguous=' || {_COUNTED["unassigned_ambiguous_count"]} AS text FROM res""",
    records="observed",
)
def canonical_console(spark, d):
    return _lines(spark, update.render_canonical(updated(spark, d)[1])).select("text")


@query(
    f""", r AS (SELECT * FROM so WHERE needs_review), lines AS (
    SELECT 0 AS o, 0 AS k, 'Q total=' || count(*) || ' mapped=' || count(canonical_node_id) || ' (' || {_P('count(canonical_node_id)', 'count(*)')} || '%) review=' || count(*) FILTER (needs_review)
      || ' (' || {_P('count(*) FILTER (needs_review)', 'count(*)')} || '%) parse_errors=0 unknown_activity=' || count(*) FILTER (activity_type = 'unknown') AS text FROM so
    UNION ALL SELECT 1, 0, 'TOP FLAGS' UNION ALL
    SELECT 1, row_number() OVER (ORDER BY count(*) DESC, flags), '  ' || flags || ': review=' || count(*) || ' unmapped=' || count(*) FILTER (canonical_node_id IS NULL) || ' (' || {_P('count(*)', '(SELECT count(*) FROM r)')} || '% of review)' FROM r GROUP BY flags
    UNION ALL SELECT 2, 0, 'REVIEW FAMILIES' UNION ALL
    SELECT 2, row_number() OVER (ORDER BY count(*) DESC, CASE kind WHEN 3 THEN 'UNKNOWN' ELSE 'PS' END), '  ' || CASE kind WHEN 3 THEN 'UNKNOWN' ELSE 'PS' END || ': ' || count(*) || ' (' || {_P('count(*)', '(SELECT count(*) FROM r)')} || '%)' FROM r GROUP BY kind
    UNION ALL SELECT 3, 0, 'QUICK WINS' UNION ALL
    SELECT 3, row_number() OVER (ORDER BY count(*) FILTER (canonical_node_id IS NULL) DESC, count(*) DESC, flags), '  ' || flags || ': unmapped=' || count(*) FILTER (canonical_node_id IS NULL) || ' review=' || count(*) FROM r GROUP BY flags
    UNION ALL SELECT 4, 0, 'TOP REVIEW PATTERNS' UNION ALL
    SELECT 4, row_number() OVER (ORDER BY count(*) DESC, kind), '  ' || CASE kind WHEN 3 THEN 'UNKNOWN' ELSE 'PS' END || ' count=' || count(*) || ' unmapped=' || count(*) FILTER (canonical_node_id IS NULL)
      || ' :: ' || CASE kind WHEN 3 THEN 'ОПОРА {{N}} БІЛЯ ДОРОГИ' ELSE 'ПС №{{N}} ВУЗОЛ КТП-{{N}}' END FROM r GROUP BY kind)
    SELECT CAST(row_number() OVER (ORDER BY o, k) - 1 AS INTEGER) AS line, text FROM lines""",
    records="observed",
)
def quality_console(spark, d):
    rows = parse_records(_observed(spark, d))
    found = quality.report(rows, 1)
    return _lines(spark, quality.render(found, 10, "Q"))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS logical_tu_key, 'status' AS "constraint" FROM customer WHERE c_custkey % 11 = 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'counts' FROM customer WHERE c_custkey % 13 = 0
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'range' FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 2 = 1
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'representative' FROM customer WHERE (c_custkey % 2 = 0 AND c_custkey % 11 <> 0) <> (c_custkey % 3 = 0)
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'run_status' FROM customer WHERE c_custkey % 17 = 0""",
    records=False,
)
def store_violations(spark, d):
    k = F.col("c_custkey")
    rows = adapter.table(spark, d, "customer")
    resolutions = rows.select(
        k.cast("string").alias("logical_tu_key"), F.when(k % 11 == 0, "lost").when(k % 2 == 0, "canonical").otherwise("ambiguous").alias("status"), F.when(k % 3 == 0, "f").alias("representative_fingerprint"),
        F.when(k % 13 == 0, 0).otherwise(1).alias("observation_count"), F.lit(1).alias("row_version_count"), F.lit(1).alias("material_signature_count"),
        F.when((k % 5 == 0) & (k % 2 == 1), 2.0).when(k % 7 == 0, None).otherwise(1.0).alias("ambiguous_capacity_min_kw"), F.lit(1.0).alias("ambiguous_capacity_max_kw"),
    )
    runs = rows.select(k.alias("id"), F.when(k % 17 == 0, "odd").when(k % 2 == 0, "failed").otherwise("success").alias("status"))
    return store.violations(resolutions, runs)


def _folder(spark, what: str) -> str:
    return f"{scratch_dir(spark)}/{what}-{uuid.uuid4().hex}"


@query("SELECT s_suppkey, s_name, s_acctbal, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS s_nationkey FROM supplier", records=False)
def json_sink(spark, d):
    rows = adapter.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("s_nationkey"))
    export.json_lines(rows, path := _folder(spark, "json"))
    return spark.read.schema(rows.schema).option("mode", "FAILFAST").json(path)


def _csv(spark, path: str, columns):
    """A folder of CSV files as text; what is empty there is an empty text."""
    return spark.read.schema(", ".join(f"{c} string" for c in columns)).option("header", True).option("escape", '"').csv(path).fillna("")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, '["' || c_mktsegment || '", null]' AS both, '[' || c_custkey || ', ' || c_nationkey || ']' AS numbers, '2001-02-03' AS day, '' AS nothing,
    'a "' || c_name || '", b' AS quoted FROM customer""",
    records=False,
)
def csv_sink(spark, d):
    rows = adapter.table(spark, d, "customer").select(
        "c_custkey", "c_name", F.array("c_mktsegment", F.lit(None)).alias("both"), F.array(F.col("c_custkey").cast("bigint"), F.col("c_nationkey").cast("bigint")).alias("numbers"),
        F.lit(datetime.date(2001, 2, 3)).alias("day"), F.lit(None).cast("string").alias("nothing"), F.concat(F.lit('a "'), "c_name", F.lit('", b')).alias("quoted"),
    )
    export.csv_folder(rows, path := _folder(spark, "csv"))
    return _csv(spark, path, rows.columns)


@query(
    "SELECT record_key, tu_number, connection_point_raw, CASE kind WHEN 3 THEN 'UNKNOWN' ELSE 'PS' END AS family, activity_type, coalesce(canonical_node_id, '') AS canonical_node_id, CAST(confidence AS VARCHAR) AS confidence, flags, '' AS parse_error, coalesce(parent_object_type, '') AS parent_object_type FROM so WHERE needs_review",
    records="observed",
)
def review_csv(spark, d):
    rows = quality.review_rows(parse_records(_observed(spark, d)))
    export.csv_folder(rows, path := _folder(spark, "review"))
    return _csv(spark, path, rows.columns)


_REPORT = f"""r AS (SELECT *, CASE kind WHEN 3 THEN 'UNKNOWN' ELSE 'PS' END AS family, CASE kind WHEN 3 THEN 'ОПОРА {{N}} БІЛЯ ДОРОГИ' ELSE 'ПС №{{N}} ВУЗОЛ КТП-{{N}}' END AS pattern FROM so WHERE needs_review),
  f AS (SELECT flags AS flag, count(*) AS n, count(*) FILTER (canonical_node_id IS NULL) AS un, {_P('count(*)', '(SELECT count(*) FROM r)')} AS pct FROM r GROUP BY flags)"""


@query(
    f""", {_REPORT} SELECT 'flag_counts' AS section, CAST(row_number() OVER (ORDER BY n DESC, flag) - 1 AS INTEGER) AS position, flag AS key, n, un AS unmapped, pct FROM f
    UNION ALL SELECT 'quick_wins', row_number() OVER (ORDER BY un DESC, n DESC, flag) - 1, flag, n, un, pct FROM f
    UNION ALL SELECT 'review_families', row_number() OVER (ORDER BY count(*) DESC, family) - 1, family, count(*), NULL, {_P('count(*)', '(SELECT count(*) FROM r)')} FROM r GROUP BY family
    UNION ALL SELECT 'top_review_patterns', row_number() OVER (ORDER BY count(*) DESC, pattern) - 1, pattern, count(*), count(*) FILTER (canonical_node_id IS NULL), NULL FROM r GROUP BY pattern
    UNION ALL SELECT 'summary', 0, k, n, NULL, p FROM (SELECT unnest(['total_records', 'mapped_records', 'review_records', 'parse_error_records', 'unknown_activity_records']) AS k,
      unnest([count(*), count(canonical_node_id), count(*) FILTER (needs_review), 0, count(*) FILTER (activity_type = 'unknown')]) AS n,
      unnest([NULL, {_P('count(canonical_node_id)', 'count(*)')}, {_P('count(*) FILTER (needs_review)', 'count(*)')}, NULL, NULL]) AS p FROM so)
    UNION ALL SELECT 'confidence_buckets', 0, k, n, NULL, NULL FROM (SELECT unnest(['high_0_90_1_00', 'medium_0_75_0_89', 'low_0_50_0_74', 'critical_0_00_0_49']) AS k,
      unnest([count(*) FILTER (confidence >= 0.9), count(*) FILTER (confidence >= 0.75 AND confidence < 0.9), count(*) FILTER (confidence >= 0.5 AND confidence < 0.75), count(*) FILTER (confidence < 0.5)]) AS n FROM so)
    UNION ALL SELECT 'examples', CAST(k - 1 AS INTEGER), flags || ' ' || tu_number || ' ' || connection_point_raw || ' ' || coalesce(canonical_node_id, '-'), NULL, NULL, confidence
      FROM (SELECT *, row_number() OVER (PARTITION BY flags ORDER BY record_key, tu_number, connection_point_raw, confidence) AS k FROM r) WHERE k <= 5""",
    records="observed",
)
def quality_json(spark, d):
    """Every number of the report, as its JSON has it; the report itself is of bounded size."""
    found = json.loads(export.report_text(quality.report(parse_records(_observed(spark, d)))))
    s, rows = found["summary"], []
    for section, key, n in (("flag_counts", "flag", "count"), ("quick_wins", "issue", "review_count"), ("review_families", "family", "count"), ("top_review_patterns", "pattern", "count")):
        rows += [(section, k, r[key], r[n], r.get("unmapped_count"), r.get("pct_of_review")) for k, r in enumerate(found[section])]
    shares = {"mapped_records": s["mapped_pct"], "review_records": s["review_pct"]}
    rows += [("summary", 0, k, v, None, shares.get(k)) for k, v in s.items() if k.endswith("_records")]
    rows += [("confidence_buckets", 0, k, v, None, None) for k, v in found["confidence_buckets"].items()]
    text = lambda flag, r: f"{flag} {r['tu_number']} {r['connection_point_raw']} {r['canonical_node_id'] or '-'}"
    rows += [("examples", k, text(flag, r), None, None, r["confidence"]) for flag, shown in found["examples"].items() for k, r in enumerate(shown)]
    return spark.createDataFrame(rows, "section string, position int, key string, n bigint, unmapped bigint, pct double")


@query("SELECT n_nationkey, CAST(to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'note': CASE WHEN n_nationkey % 2 = 0 THEN 'ї\"' END}) AS VARCHAR) AS payload FROM nation", records=False)
def json_payload(spark, d):
    rows = adapter.table(spark, d, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 2 == 0, 'ї"').alias("note"))
    return export.payload(rows).select("n_nationkey", "payload")


@query("SELECT source_page, tu_number, canonical_node_id, requested_power_kw, flags, CASE WHEN c_mktsegment = 'BUILDING' THEN 'x' END AS parse_error FROM so JOIN customer ON c_custkey = source_page", records="observed")
def json_scan(spark, d):
    """Parsed records written as lists, one a task, with a field more, and read again by the fixed schema."""
    segments = adapter.table(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("source_page"), "c_mktsegment")
    rows = parse_records(adapter.observed(spark, d)).join(segments, "source_page").withColumn("parse_error", F.when(F.col("c_mktsegment") == "BUILDING", "x"))
    export.json_lists(rows.select(*PARSED_FIELDS, F.lit(1).alias("unknown")), path := _folder(spark, "lists"))
    return pages.parsed_json(spark, path).select("source_page", "tu_number", "canonical_node_id", "requested_power_kw", F.array_join("flags", ",").alias("flags"), "parse_error")


def _picky(text: str) -> dict:
    if "опора" in text:
        raise ValueError("no object in the text")
    return {"canonical_node_id": text.upper(), "confidence": 1.0, "needs_review": False, "flags": [], "parent_voltage_levels_kv": [1.0]}


@query(
    """SELECT source_page, CASE WHEN kind <> 3 THEN upper(connection_point_raw) END AS canonical_node_id, CASE WHEN kind = 3 THEN 0.0 ELSE 1.0 END::DOUBLE AS confidence, kind = 3 AS needs_review,
    CASE WHEN kind = 3 THEN 'parse_error' ELSE '' END AS flags, CASE WHEN kind = 3 THEN 'no object in the text' END AS parse_error, activity_type FROM so""",
    records="observed",
)
def parse_fallback(spark, d):
    found = parse_records_with(adapter.observed(spark, d), _picky)
    return found.select("source_page", "canonical_node_id", "confidence", "needs_review", F.array_join("flags", ",").alias("flags"), "parse_error", "activity_type")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN '' ELSE event_type END AS texts, CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 3 AS VARCHAR) ELSE '' END AS numbers, CASE WHEN event_id % 2 = 0 THEN 'True' ELSE '' END AS truths FROM events", records=False)
def flag_coercion(spark, d):
    e = F.col("event_id")
    rows = adapter.table(spark, d, "events").select("event_id", F.when(F.col("event_type") == "click", "").otherwise(F.col("event_type")).alias("t"), (e % 3).cast("int").alias("n"), (e % 2 == 0).alias("b"))
    return rows.select("event_id", *(F.array_join(T.flag_list(F.col(c), kind), ",").alias(out) for c, kind, out in (("t", "string", "texts"), ("n", "int", "numbers"), ("b", "boolean", "truths"))))


@query(
    f""", {_CANONICAL}, {_LAST}, o AS (SELECT 'nodes' AS output, canonical_node_id AS key FROM so WHERE canonical_node_id IS NOT NULL GROUP BY 2 UNION ALL SELECT 'canonical', logical_tu_key FROM cp
    UNION ALL SELECT 'quality_v1', record_key FROM lt UNION ALL SELECT 'quality_v2', logical_tu_key FROM cp)
    SELECT output, row_number() OVER (PARTITION BY output ORDER BY key) - 1 AS position, key FROM o
    UNION ALL SELECT 'flags', row_number() OVER (ORDER BY count(*) DESC, flags) - 1, flags FROM so WHERE needs_review GROUP BY flags
    UNION ALL SELECT 'quick_wins', row_number() OVER (ORDER BY count(*) FILTER (canonical_node_id IS NULL) DESC, count(*) DESC, flags) - 1, flags FROM so WHERE needs_review GROUP BY flags""",
    records="observed",
)
def output_order(spark, d):
    """The order in which outputs come, row by row, as their readers see it."""
    kept, _ = updated(spark, d)
    parsed = parse_records(_observed(spark, d))
    snap = snapshot.Snapshot(_observed(spark, d))
    outputs = {
        "nodes": metrics.aggregate_nodes(parsed, DAYS[1]).select("canonical_node_id"),
        "canonical": snap.canonical().select("logical_tu_key"),
        "quality_v1": update.quality_rows_v1(kept).select("record_key"),
        "quality_v2": update.quality_rows_v2(kept, 2).select("record_key"),
        "flags": quality.flag_counts(parsed).select("flag"),
        "quick_wins": quality.quick_wins(parsed).select("issue"),
    }
    return reduce(DataFrame.unionByName, (positions(spark, df).select(F.lit(name).alias("output"), "position", F.col(df.columns[0]).alias("key")) for name, df in outputs.items()))


def positions(spark, df):
    """df's rows with the position that they have in the files that it is written to: by file, then by row of it."""
    path = _folder(spark, "ordered")
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select(*df.columns, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))  # a row a task
    before = files.select("_file", (F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_file")) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_file").select(*df.columns, (F.col("_before") + F.col("_row")).cast("bigint").alias("position"))


_NODES_OF = "count(DISTINCT canonical_node_id)"
_ROWS = {  # of both runs, the first of which has no conflicts
    "pipeline_runs": "2",
    "tu_raw": "(SELECT count(DISTINCT record_key) FROM so)",
    "tu_parsed": "(SELECT count(DISTINCT record_key) FROM so)",
    "tu_row_versions": "(SELECT count(DISTINCT row_fingerprint) FROM so)",
    "tu_observations": "(SELECT count(*) + count(*) FILTER (j < 2) FROM so)",
    "tu_snapshot_resolution": "(SELECT count(DISTINCT logical_tu_key) + count(DISTINCT logical_tu_key) FILTER (j < 2) FROM so)",
    "tu_canonical_parsed": "(SELECT count(DISTINCT logical_tu_key) FILTER (j < 2) + (SELECT count(*) FROM res WHERE sigs = 1) FROM so)",
    "grid_nodes": f"(SELECT {_NODES_OF} FROM so)",
    "node_metrics": f"(SELECT {_NODES_OF} + {_NODES_OF} FILTER (j < 2) FROM so)",
    "node_metrics_v2": f"(SELECT {_NODES_OF} + {_NODES_OF} FILTER (j < 2) FROM so)",
    "current_node_metrics_v2": f"(SELECT {_NODES_OF} FROM so)",
}


def declared(spark, d) -> str:
    """A database of its own over the store of both runs."""
    database = f"registry_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for _ in range(2):  # a second call changes nothing
        store.create_tables(spark, updated(spark, d)[0].path, database)
    return database


@query(f", {_RESOLVED} " + " UNION ALL ".join(f"SELECT '{k}' AS name, CAST({v} AS BIGINT) AS n" for k, v in _ROWS.items()), records="observed")
def ddl_apply(spark, d):
    """The rows of all tables, and of the view, as the catalogue has them."""
    database = declared(spark, d)
    try:
        return spark.createDataFrame([(n, spark.table(f"{database}.{n}").count()) for n in (*store.TABLES, store.VIEW)], "name string, n bigint")
    finally:
        with contextlib.suppress(Exception):
            spark.sql(f"DROP DATABASE {database} CASCADE")


@query(ORACLE["stored_metrics_v2"], records=False)
def current_metrics(spark, d):
    """The view of the latest successful run's metrics; folders of other runs are not read."""
    rows = spark.table(f"{declared(spark, d)}.{store.VIEW}")
    return rows.select("canonical_node_id", *_NODE_FIELDS, "ambiguous_tu_count", F.col("ambiguous_capacity_min_mw").alias("low"))


_BUCKET = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 64"


@query(
    f"""WITH b AS (SELECT *, {_BUCKET} AS bucket, o_orderkey % 1000 = 7 AS changed FROM orders)
    SELECT CAST(bucket AS INTEGER) AS bucket, count(*) AS rows, CASE WHEN bool_or(changed) THEN 2 ELSE 1 END AS version, count(*) FILTER (changed) AS changed,
    CAST(sum(CAST(CASE WHEN changed THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(28,2))) AS DOUBLE) AS total, CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE) AS before FROM b GROUP BY 1""",
    records=False,
)
def bucketed_upsert(spark, d):
    """Which version wrote each bucket of a table after an upsert of a thousandth of its rows, and what a reader of the version before still sees."""
    table = buckets.Table(spark, _folder(spark, "orders"), fewest=64)
    orders = adapter.table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(28,2)").alias("price"), F.lit(0).alias("changed"))
    table.upsert(orders, ["o_orderkey"])
    before = table.read()
    table.upsert(orders.where("o_orderkey % 1000 = 7").withColumns({"price": (F.col("price") + 1).cast("decimal(28,2)"), "changed": F.lit(1)}), ["o_orderkey"])
    bucket = (buckets.key_hash(["o_orderkey"]) % 64).cast("int").alias("bucket")
    now = table.read().groupBy(bucket).agg(F.sum("changed").cast("bigint").alias("changed"), F.sum("price").cast("double").alias("total"))
    old = before.groupBy(bucket).agg(F.sum("price").cast("double").alias("before"))
    found = table.manifest()
    versions = {m.write: m.number for m in table.history()}
    written = spark.createDataFrame([(int(b), found.rows[b], versions[f.split("/")[0]]) for b, f in found.folders.items()], "bucket int, rows bigint, version int")  # a row a bucket
    return written.join(now, "bucket").join(old, "bucket").select("bucket", "rows", "version", "changed", "total", "before")


#: Of each reference, the rows whose names are spoilt below, and the child's rows, in SQL.
_FIRST = "substr({c}, 1, 1) = '0'"
_CHILDREN = {
    ("tu_parsed", "record_key"): ("SELECT DISTINCT record_key AS v FROM so", _FIRST),
    ("tu_observations", "row_fingerprint"): ("SELECT row_fingerprint AS v FROM so", _FIRST),
    ("tu_snapshot_resolution", "representative_fingerprint"): ("SELECT CASE WHEN sigs = 1 THEN fp END AS v FROM res", _FIRST),
    ("tu_canonical_parsed", "row_fingerprint"): ("SELECT fp AS v FROM res WHERE sigs = 1", _FIRST),
    ("node_metrics", "canonical_node_id"): ("SELECT DISTINCT canonical_node_id AS v FROM so WHERE canonical_node_id IS NOT NULL", "{c} LIKE '%7'"),
    ("node_metrics_v2", "canonical_node_id"): ("SELECT DISTINCT canonical_node_id AS v FROM so WHERE canonical_node_id IS NOT NULL", "{c} LIKE '%7'"),
}


def _reference(table: str, column: str):
    rows, spoilt = _CHILDREN[table, column]
    parent, key = store.REFERENCES[table][column]

    @query(f", {_RESOLVED}, c AS ({rows}) SELECT count(*) FILTER ({spoilt.format(c='v')}) > 0 AS refused, count(*) FILTER ({spoilt.format(c='v')}) AS orphans, count(*) AS rows, 0::BIGINT AS spoilt_rows FROM c", records="observed")
    def held(spark, d):
        kept, _ = updated(spark, d)
        by_run = store.TABLES[table][1] == "run_id"
        place = table if table != "node_metrics" else f"{table}/snapshot_date={DAYS[1]}"
        own = kept.read_run(table, 2) if by_run else kept.read(place)
        bad = F.expr(spoilt.format(c=column))
        broken = own.withColumn(column, F.when(bad, F.concat(F.lit("no "), column)).otherwise(F.col(column)))
        refused = False
        try:
            if by_run:
                kept.write_run(table, 2, broken)
            else:
                kept.upsert(place, broken, [own.columns[0]])
        except Exception as e:  # the task's error, as the driver shows it
            refused = f"{column} names no row" in str(e)
        orphans = store.orphans(broken.where(F.col(column).isNotNull()), kept.read(parent), column, key).count()
        now = kept.read_run(table, 2) if by_run else kept.read(place)
        counts = now.agg(F.count("*").alias("rows"), F.count_if(F.col(column).startswith("no ")).alias("spoilt_rows"))
        return counts.select(F.lit(refused).alias("refused"), F.lit(orphans).cast("bigint").alias("orphans"), "rows", "spoilt_rows")

    return held


for _table, _column in _CHILDREN:
    _name = f"held_{_table}_{_column}"
    _query = _reference(_table, _column)
    QUERIES[_name], ORACLE[_name] = QUERIES.pop("held"), ORACLE.pop("held")

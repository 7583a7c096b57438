"""Registry tables: what they hold, what must be true of them, and a store of them under one folder.

Tables that are keyed by records are bucketed copy-on-write tables (buckets.py).
Tables that are keyed by run are folders by run_id, moved into place when they are
whole and seen only if the run log, the store's commit point, calls the run a
success. Every write is held to the table's constraints in its own plan: a row
that breaks one ends the write before anything is committed.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridlode.functions.schemas import AMBIGUITY_METRICS, METRICS, PARSED, RAW
from gridlode.operators.identity import with_identities
from gridlode.sources.buckets import BUCKET, RETENTION, CommitConflict, Files, Table, merged  # noqa: F401  (merged is offered here too)

RUNS = "id long, source string, status string, started_at timestamp, finished_at timestamp, counts map<string,long>, error string"

_SEEN = "first_seen_at timestamp, last_seen_at timestamp"
_METRICS = ", ".join(f"{c} {'int' if c.endswith(('_count', '_pressure')) else 'double'}" for c in METRICS)
#: Columns of each table, and the column that parts it.
TABLES = {
    "pipeline_runs": (RUNS, None),
    "tu_raw": (f"record_key string, {RAW}, {_SEEN}", None),
    "tu_parsed": (f"record_key string, {PARSED}", None),
    "tu_row_versions": (f"row_fingerprint string, record_key string, logical_tu_key string, {RAW}, {_SEEN}", None),
    "tu_observations": ("observation_key string, row_fingerprint string, source_page int, source_row_index int, fetched_at timestamp, run_id long", "run_id"),
    "tu_snapshot_resolution": (
        "logical_tu_key string, status string, representative_fingerprint string, observation_count long, row_version_count long, material_signature_count long, "
        "conflict_fields array<string>, ambiguous_capacity_min_kw double, ambiguous_capacity_max_kw double, run_id long",
        "run_id",
    ),
    "tu_canonical_parsed": (f"{PARSED}, logical_tu_key string, row_fingerprint string, record_key string, run_id long", "run_id"),
    "grid_nodes": (f"canonical_node_id string, object_type string, number string, name string, voltage_levels_kv array<double>, {_SEEN}", None),
    "node_metrics": (f"canonical_node_id string, {_METRICS}, snapshot_date date", "snapshot_date"),
    "node_metrics_v2": (f"canonical_node_id string, snapshot_date date, {_METRICS}, " + ", ".join(f"{c} {'int' if c.endswith('_count') else 'double'}" for c in AMBIGUITY_METRICS) + ", run_id long", "run_id"),
}

_KNOWN_METRICS = tuple(c for c in METRICS if c != "generation_load_ratio")  # there is no ratio without load
#: Columns that are never null, the key's first.
REQUIRED = {
    "tu_raw": ("record_key", "source", "source_url", "source_page", "fetched_at", "first_seen_at", "last_seen_at"),
    "tu_parsed": ("record_key", "activity_type", "parent_voltage_levels_kv", "confidence", "needs_review", "flags"),
    "tu_row_versions": ("row_fingerprint", "logical_tu_key", "source", "first_seen_at", "last_seen_at"),
    "tu_observations": ("observation_key", "row_fingerprint", "source_page", "source_row_index", "fetched_at"),
    "tu_snapshot_resolution": ("logical_tu_key", "status", "observation_count", "row_version_count", "material_signature_count", "conflict_fields"),
    "tu_canonical_parsed": ("logical_tu_key", "row_fingerprint", "activity_type", "parent_voltage_levels_kv", "confidence", "needs_review", "flags"),
    "grid_nodes": ("canonical_node_id", "voltage_levels_kv", "first_seen_at", "last_seen_at"),
    "node_metrics": ("canonical_node_id", "snapshot_date", *_KNOWN_METRICS),
    "node_metrics_v2": ("canonical_node_id", "snapshot_date", *_KNOWN_METRICS, AMBIGUITY_METRICS[0]),
}
#: What a row breaks, by the constraint's name.
BROKEN = {
    "pipeline_runs": {"run_status": "status NOT IN ('running', 'success', 'failed')"},
    "tu_snapshot_resolution": {
        "status": "status NOT IN ('canonical', 'ambiguous')",
        "counts": "observation_count < 1 OR row_version_count < 1 OR material_signature_count < 1",
        "range": "ambiguous_capacity_min_kw > ambiguous_capacity_max_kw",
        "representative": "(status = 'canonical') <> (representative_fingerprint IS NOT NULL)",
    },
}
#: Columns that name a row of another table, and that table's key.
REFERENCES = {
    "tu_parsed": {"record_key": ("tu_raw", "record_key")},
    "tu_observations": {"run_id": ("pipeline_runs", "id"), "row_fingerprint": ("tu_row_versions", "row_fingerprint")},
    "tu_snapshot_resolution": {"run_id": ("pipeline_runs", "id"), "representative_fingerprint": ("tu_row_versions", "row_fingerprint")},
    "tu_canonical_parsed": {"run_id": ("pipeline_runs", "id"), "row_fingerprint": ("tu_row_versions", "row_fingerprint")},
    "node_metrics": {"canonical_node_id": ("grid_nodes", "canonical_node_id")},
    "node_metrics_v2": {"run_id": ("pipeline_runs", "id"), "canonical_node_id": ("grid_nodes", "canonical_node_id")},
}


def broken(table: str) -> Column:
    """The name of the first constraint within a row that it breaks, else null."""
    missing = [F.when(F.col(c).isNull(), f"{c} is missing") for c in REQUIRED.get(table, ())]
    checks = [F.when(F.expr(rule), name) for name, rule in BROKEN.get(table, {}).items()]
    return F.coalesce(F.lit(None).cast("string"), *missing, *checks)


def held(table: str, df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """df, whose run fails at the first row that breaks a constraint of the table.

    parents: the rows that the columns of REFERENCES may name, by column. The checks
    sit in the first column's projection: a filter could be moved to where rows that
    are not written still pass.
    """
    found = [broken(table)]
    rows = df
    for n, (column, (_, key)) in enumerate((c, r) for c, r in REFERENCES.get(table, {}).items() if c in parents):
        there = parents[column].select(F.col(key).alias(f"_key{n}"), F.lit(True).alias(f"_there{n}"))
        rows = rows.join(there, F.col(column) == F.col(f"_key{n}"), "left")
        found.append(F.when(F.col(column).isNotNull() & F.col(f"_there{n}").isNull(), f"{column} names no row"))
    first = df.columns[0]
    name = F.coalesce(*found)
    message = F.concat(F.lit(f"{table}: "), name, F.lit(" in the row of "), F.coalesce(F.col(first).cast("string"), F.lit("no key")))
    return rows.select(F.when(name.isNull(), F.col(first)).otherwise(F.raise_error(message)).alias(first), *df.columns[1:])


def last_wins(df: DataFrame, key: list[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*key, "r.*") if rest else df.distinct()


def first_wins(df: DataFrame, key: list[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*key, "r.*") if rest else df.distinct()


def inserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of new whose key old lacks."""
    return new.join(old.select(*key), key, "left_anti")


def first_of_points(ided: DataFrame, order: Column) -> DataFrame:
    """The first record of each point and voltage, which settle node and confidence: best_by_node() needs no other.

    Those are few, and the rest is left out before any row is dealt out.
    """
    alike = ["connection_point_raw", "voltage_raw"]
    raw = [c for c in ided.columns if c not in (*alike, "record_key", "row_fingerprint", "logical_tu_key")]
    first = ided.groupBy(*alike).agg(F.min_by(F.struct(*raw), order).alias("r")).select(*alike, "r.*")
    return with_identities(first)


def best_by_node(parsed: DataFrame, order: Column) -> DataFrame:
    """The record of the highest confidence of each node, the first of equals."""
    rows = parsed.where(F.nullif(F.col("canonical_node_id"), F.lit("")).isNotNull()).withColumn("_o", order)
    rest = [c for c in parsed.columns if c != "canonical_node_id"]
    best = F.min_by(F.struct(*rest), F.struct(-F.coalesce("confidence", F.lit(0.0)), "_o"))
    return rows.groupBy("canonical_node_id").agg(best.alias("r")).select("canonical_node_id", "r.*")


class Store:
    """Tables under a path that Spark's file systems reach. Replaced versions stay for `retention` seconds."""

    def __init__(self, spark: SparkSession, path: str, retention: float = RETENTION) -> None:
        self.spark, self.path, self.retention = spark, path.rstrip("/"), retention
        self.files = Files(spark, self.path)

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.path}/{name}", self.retention)

    def read(self, table: str, schema: str | None = None) -> DataFrame | None:
        found = self.table(table).read()
        return self.spark.createDataFrame([], schema) if found is None and schema else found

    def _held(self, table: str, df: DataFrame) -> DataFrame:
        """df under its table's constraints. The run that it's written for is checked by itself."""
        parents = {c: (parent, key) for c, (parent, key) in REFERENCES.get(table, {}).items() if c != "run_id"}
        return held(table, df, {c: self.read(parent, TABLES[parent][0]) for c, (parent, _) in parents.items()})

    def replace(self, table: str, df: DataFrame) -> int:
        return self.table(table).replace(self._held(table, df))

    def upsert(self, table: str, new: DataFrame, key: list[str], rules: dict[str, str] | None = None) -> int:
        """new has a row for each key. Returns how many rows it had, counted as they are staged."""
        return self.table(table).upsert(self._held(table.split("/")[0], new), key, rules)

    def parts(self, table: str) -> list[str]:
        """The folders name=value of a table that is written part by part."""
        return sorted(n for n, _ in self.files.names(f"{self.path}/{table}") if "=" in n)

    def read_parts(self, table: str) -> DataFrame:
        """All parts of a table that is upserted part by part (as table/name=value); parts hold their own value."""
        return reduce(DataFrame.unionByName, (self.read(f"{table}/{name}") for name in self.parts(table)))

    def write_run(self, table: str, run_id: int, df: DataFrame, **counters: Column) -> dict:
        """A run's part of a table; written again, it is replaced once it is whole.

        counters: aggregates to be observed on the rows as they are written; their values are returned.
        """
        if table in REFERENCES and self.runs().where(F.col("id") == run_id).isEmpty():
            raise ValueError(f"{table}: run {run_id} is not in the run log")
        rows, seen = self._held(table, df), Observation()
        if counters:
            rows = rows.observe(seen, *(c.alias(name) for name, c in counters.items()))
        beside, place = f"{self.path}/{table}/_{uuid.uuid4().hex}", f"{self.path}/{table}/run_id={run_id}"
        try:
            rows.write.parquet(beside)
            found = seen.get if counters else {}
            self.files.delete(place)
            self.files.move(beside, place)
        finally:
            self.files.delete(beside)
        return found

    def read_run(self, table: str, run_id: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}/run_id={run_id}")

    def read_runs(self, table: str) -> DataFrame:
        """All successful runs' parts, with run_id."""
        good = self.runs().where("status = 'success'").select(F.col("id").alias("run_id"))
        return self.spark.read.option("basePath", f"{self.path}/{table}").parquet(f"{self.path}/{table}/run_id=*").join(F.broadcast(good), "run_id", "left_semi")

    def runs(self) -> DataFrame:
        return self.read("pipeline_runs", RUNS)

    def start_run(self, source: str) -> int:
        """The next number; of writers that start at once, all but one try again."""
        while True:
            runs = self.runs()
            run_id = (runs.agg(F.max("id")).first()[0] or 0) + 1
            row = self.spark.range(1).select(
                F.lit(run_id).cast("long").alias("id"), F.lit(source).alias("source"), F.lit("running").alias("status"), F.current_timestamp().alias("started_at"),
                F.lit(None).cast("timestamp").alias("finished_at"), F.lit(None).cast("map<string,long>").alias("counts"), F.lit(None).cast("string").alias("error"),
            )
            try:
                self.replace("pipeline_runs", runs.unionByName(row).coalesce(1))
            except CommitConflict:
                continue
            return run_id

    def finish_run(self, run_id: int, status: str, counts: dict[str, int], error: str | None = None) -> None:
        if status not in ("success", "failed"):
            raise ValueError(f"status must be success or failed, not {status}")
        mine = F.col("id") == run_id
        pairs = [F.lit(v) for k, n in counts.items() for v in (k, int(n))]
        while True:
            done = self.runs().select(
                "id", "source", F.when(mine, status).otherwise(F.col("status")).alias("status"), "started_at",
                F.when(mine, F.current_timestamp()).otherwise(F.col("finished_at")).alias("finished_at"),
                F.when(mine, F.create_map(*pairs).cast("map<string,long>") if pairs else F.lit(None).cast("map<string,long>")).otherwise(F.col("counts")).alias("counts"),
                F.when(mine, F.substring(F.lit(error).cast("string"), 1, 4000)).otherwise(F.col("error")).alias("error"),
            )
            try:
                self.replace("pipeline_runs", done.coalesce(1))
            except CommitConflict:
                continue
            return


def current_view(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """Metrics of the latest successful run of each source."""
    latest = runs.where(F.col("status") == "success").groupBy("source").agg(F.max("id").alias("run_id")).select("run_id")
    return metrics.join(F.broadcast(latest), "run_id", "left_semi")  # a row for each source


VIEW = "current_node_metrics_v2"


def create_tables(spark: SparkSession, path: str, database: str = "default") -> list[str]:
    """The registry's tables in the session's catalogue, over the folders of a store, and the view of current metrics.

    The folders of a table's current version, or of its runs, are the partitions of
    the catalogue's; called again after a run, they are those of the new version. Tables in
    buckets show the bucket as a last column. Returns the names of tables and view.
    """
    store = Store(spark, path)
    for name, (columns, by) in TABLES.items():
        parted = [f"{by} {'date' if by == 'snapshot_date' else 'long'}"] if by else []
        places = {}
        if by == "run_id":
            places = {(part.split("=")[1],): f"{name}/{part}" for part in store.parts(name)}
        else:
            for part in store.parts(name) if by else [""]:
                found = store.table(f"{name}/{part}".rstrip("/")).manifest()
                folders = found.folders if found else {}
                places |= {(*part.split("=")[1:], bucket): f"{name}/{part}/data/{folder}".replace("//", "/") for bucket, folder in folders.items()}
            parted.append(f"{BUCKET} int")
        own = ", ".join(c for c in columns.split(", ") if not (by and c.split()[0] == by))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({own}, {', '.join(parted)}) USING parquet PARTITIONED BY ({', '.join(p.split()[0] for p in parted)}) LOCATION '{store.path}/{name}'")
        spec = lambda values: "PARTITION (" + ", ".join(f"{p.split()[0]} = '{v}'" for p, v in zip(parted, values)) + ")"
        stale = [tuple(x.split("=")[1] for x in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {database}.{name}").collect()]
        if stale:
            spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS " + ", ".join(spec(v) for v in stale))
        if places:
            spark.sql(f"ALTER TABLE {database}.{name} ADD " + " ".join(f"{spec(v)} LOCATION '{store.path}/{at}'" for v, at in places.items()))
        spark.sql(f"REFRESH TABLE {database}.{name}")
    # the runs are few and known only when the view is read: the partitions of other runs are left out then
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{VIEW} AS SELECT /*+ BROADCAST(r) */ m.* FROM {database}.node_metrics_v2 m "
        f"JOIN (SELECT max(id) AS id FROM {database}.pipeline_runs WHERE status = 'success' GROUP BY source) r ON m.run_id = r.id"
    )
    return [*TABLES, VIEW]


def violations(resolutions: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows that break a table's constraints, with the constraint's name."""
    rules = BROKEN["tu_snapshot_resolution"]
    names = F.array_compact(F.array(*(F.when(F.expr(rule), name) for name, rule in rules.items())))
    found = resolutions.select("logical_tu_key", F.explode(names).alias("constraint"))
    bad = F.expr(BROKEN["pipeline_runs"]["run_status"])
    return found.unionByName(runs.where(bad).select(F.col("id").cast("string").alias("logical_tu_key"), F.lit("run_status").alias("constraint")))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of child whose key parent lacks."""
    return child.join(parent.select(F.col(parent_key or key).alias(key)), key, "left_anti")

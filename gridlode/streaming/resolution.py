"""Snapshot resolution as observations arrive: keyed state instead of a pass over all history.

For each logical record the state holds the observations that it has counted, its
versions, and a summary of each material signature. A micro-batch reads and
writes the state of the records it brings alone and gives out their resolution
as it now is. The order of observations plays no part: counts and smallest
fingerprints are all that is kept. An observation that comes again, in a repeated
batch or a later one, is known by its key and counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gridlode.functions.schemas import MATERIAL_FIELDS
from gridlode.functions.values import json_hash
from gridlode.sources.buckets import Table

KEY = "logical_tu_key"
_FIELDS = ", ".join(f"{c} {'double' if c == 'requested_power_kw' else 'string'}" for c in MATERIAL_FIELDS)
RESOLVED = (
    f"{KEY} string, status string, representative_fingerprint string, observation_count long, row_version_count long, material_signature_count long, "
    "conflict_fields array<string>, ambiguous_capacity_min_kw double, ambiguous_capacity_max_kw double"
)
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def observation() -> Column:
    """What makes an observation one: its place, its content and when it was fetched."""
    at = F.coalesce(F.col("fetched_at").cast("string"), F.lit(""))
    return json_hash((F.col("source"), "string"), (F.col("source_page"), "int"), (F.col("source_row_index"), "int"), (F.col("row_fingerprint"), "string"), (at, "string"))


def resolution(key: str, signatures: list[tuple]) -> Row:
    """The row of one logical record from (observations, versions, smallest fingerprint, material fields...) of each signature."""
    clear = len(signatures) == 1
    fields = list(zip(*(s[3:] for s in signatures)))
    power = [p for p in fields[MATERIAL_FIELDS.index("requested_power_kw")] if p is not None and not clear]
    return Row(
        logical_tu_key=key,
        status="canonical" if clear else "ambiguous",
        representative_fingerprint=signatures[0][2] if clear else None,
        observation_count=sum(s[0] for s in signatures),
        row_version_count=sum(s[1] for s in signatures),
        material_signature_count=len(signatures),
        conflict_fields=[name for name, values in zip(MATERIAL_FIELDS, fields) if len(set(values)) > 1],
        ambiguous_capacity_min_kw=min(power, default=None),
        ambiguous_capacity_max_kw=max(power, default=None),
    )


class Resolver(StatefulProcessor):
    """State by logical key: observations seen, versions seen, and signatures with their counts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "observation string", "known boolean")
        self.versions = handle.getMapState("versions", "fingerprint string", "known boolean")
        self.signatures = handle.getMapState("signatures", "signature string", f"observations long, versions long, first string, {_FIELDS}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        changed: dict[str, list] = {}
        for row in rows:
            if self.seen.containsKey((row["observation"],)):
                continue
            self.seen.updateValue((row["observation"],), (True,))
            of = row["signature"]
            if of not in changed:
                changed[of] = list(self.signatures.getValue((of,)) or (0, 0, row["row_fingerprint"], *(row[c] for c in MATERIAL_FIELDS)))
            changed[of][0] += 1
            if not self.versions.containsKey((row["row_fingerprint"],)):
                self.versions.updateValue((row["row_fingerprint"],), (True,))
                changed[of][1] += 1
                changed[of][2] = min(changed[of][2], row["row_fingerprint"])
        for of, summary in changed.items():
            self.signatures.updateValue((of,), tuple(summary))
        if changed:
            yield resolution(key[0], [tuple(v) for v in self.signatures.values()])

    def close(self) -> None:
        pass


def resolutions(ided: DataFrame) -> DataFrame:
    """The resolution of each logical record that a micro-batch of identified records changes, as it is after the batch."""
    parts = [(F.col(c), "double" if c == "requested_power_kw" else "string") for c in MATERIAL_FIELDS]
    narrow = ided.select(KEY, "row_fingerprint", *MATERIAL_FIELDS, observation().alias("observation"), json_hash(*parts).alias("signature"))
    return narrow.groupBy(KEY).transformWithState(Resolver(), RESOLVED, "Update", "None")


def resolution_stream(spark: SparkSession, ided: DataFrame, table: Table, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep a table's rows at the resolution of all records of a stream. A batch that runs again writes the same rows."""

    def store(batch: DataFrame, _: int) -> None:
        table.upsert(batch, [KEY])

    name, provider = STATE_STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)  # a query takes the session's setting with it when it starts
    try:
        return resolutions(ided).writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)

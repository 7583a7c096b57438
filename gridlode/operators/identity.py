"""The four identities of a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.functions.schemas import SOURCE_FIELDS
from gridlode.functions.text import filled
from gridlode.functions.values import general_text, json_hash


def _part(name: str) -> tuple[Column, str]:
    return F.col(name), "double" if name == "requested_power_kw" else "string"


def record_key() -> Column:
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("source", "tu_number", "tu_date", "connection_point_raw")]
    return F.sha2(F.concat_ws("\u001f", *parts, F.coalesce(general_text(F.col("requested_power_kw")), F.lit(""))), 256)


def row_fingerprint() -> Column:
    return json_hash(*map(_part, ("source", *SOURCE_FIELDS)))


_OTHER = ("tu_date", "contract_number", "connection_point_raw", "requested_power_kw")


def logical_key() -> Column:
    numbered = json_hash(*map(_part, ("source", "tu_number")))
    other = json_hash(*map(_part, ("source", *_OTHER)))
    return F.when(filled(F.col("tu_number")).isNotNull(), numbered).otherwise(other)


def key_parts() -> dict[str, Column]:
    """What logical_key() is made of, by name: equal for equal keys. The parts are shorter than the key, and unlike its digits they compress."""
    number = filled(F.col("tu_number"))
    other = {f"_k_{c}": F.when(number.isNull(), F.col(c).cast("string")) for c in _OTHER}  # -0.0 is another text than 0.0
    return {"_k_source": F.col("source"), "_k_tu_number": number} | other


def key_of_parts() -> Column:
    """logical_key() of the columns of key_parts()."""
    parts = {c.removeprefix("_k_"): F.col(c) for c in key_parts()}
    parts["requested_power_kw"] = parts["requested_power_kw"].cast("double")
    text = lambda *names: json_hash(*((parts[c], _part(c)[1]) for c in names))
    return F.when(parts["tu_number"].isNotNull(), text("source", "tu_number")).otherwise(text("source", *_OTHER))


def observation_key(run_id: Column) -> Column:
    return json_hash(_part("source"), (run_id, "bigint"), (F.col("source_page"), "int"), (F.col("source_row_index"), "int"))


def with_identities(raw: DataFrame) -> DataFrame:
    return raw.select("*", record_key().alias("record_key"), row_fingerprint().alias("row_fingerprint"), logical_key().alias("logical_tu_key"))


def order() -> Column:
    """Collection order: page, row, then content, so that "first" is the same at every layout."""
    return F.struct("source_page", "source_row_index", "row_fingerprint")

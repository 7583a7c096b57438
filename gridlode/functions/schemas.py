"""Column lists and schemas of the registry's records."""

from __future__ import annotations

# Fields of a record, in the order that keys and tables use.
SOURCE_FIELDS = (
    "tu_number", "tu_date", "contract_number", "contract_date", "installation_type", "commissioning_stages",
    "connection_point_raw", "voltage_raw", "requested_power_kw", "connection_type", "rem", "payment_date",
)
MATERIAL_FIELDS = ("tu_date", "installation_type", "connection_point_raw", "voltage_raw", "requested_power_kw", "connection_type")

RAW = (
    "source string, source_url string, source_page int, source_row_index int, fetched_at timestamp, tu_number string, tu_date string, "
    "installation_type string, connection_point_raw string, voltage_raw string, requested_power_kw double, connection_type string, rem string, "
    "contract_number string, contract_date string, commissioning_stages string, payment_date string"
)
POINT = (
    "connection_object_type string, connection_voltage_kv double, connection_object_number string, connection_object_name string, feeder_id string, "
    "parent_object_type string, parent_number string, parent_name string, parent_voltage_levels_kv array<double>, canonical_node_id string, "
    "confidence double, needs_review boolean, flags array<string>"
)
POINT_FIELDS = tuple(c.split()[0] for c in POINT.split(", "))
PARSED = (
    "source string, source_url string, source_page int, fetched_at timestamp, tu_number string, tu_date string, installation_type string, "
    "activity_type string, requested_power_kw double, connection_type string, rem string, connection_point_raw string, voltage_raw string, "
    f"{POINT}, parse_error string"
)
PARSED_FIELDS = tuple(c.split()[0] for c in PARSED.split(", "))

FAMILIES = ("generation", "load", "bess")
_CAPACITY = tuple(f"{f}_mw" for f in (*FAMILIES, "other"))
_COUNTS = tuple(f"{f}_tu_count" for f in (*FAMILIES, "other"))
_WINDOWS = tuple(f"{f}_{m}m_mw" for f in FAMILIES for m in (3, 6, 12))
_WINDOW_COUNTS = tuple(f"{f}_tu_{m}m_count" for m in (3, 12) for f in FAMILIES)
_REST = (
    *(f"{f}_tu_velocity_{m}m_per_month" for m in (3, 12) for f in FAMILIES),
    "generation_load_ratio", "net_tu_imbalance_mw", "bess_share", "review_count", "data_confidence",
    *(f"{f}_pressure" for f in FAMILIES),
)
METRICS = (*_CAPACITY, *_COUNTS, *_WINDOWS, *_REST)
AMBIGUITY_METRICS = ("ambiguous_tu_count", "ambiguous_capacity_min_mw", "ambiguous_capacity_max_mw")
EXPORT_METRICS = (*_CAPACITY, *_COUNTS, *_WINDOWS, *_WINDOW_COUNTS, *_REST, *AMBIGUITY_METRICS)

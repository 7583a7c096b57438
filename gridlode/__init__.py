"""gridlode: registry analytics expressed as Spark DataFrame plans."""

import importlib
import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What the package offers, and where it lives; loaded when it is asked for.
_HOMES = {
    "RAW": "functions.schemas",
    "PARSED": "functions.schemas",
    "Store": "sources.store",
    "CollectError": "sources.pages",
    "collect_pages": "sources.pages",
    "parse_points": "operators.points",
    "parse_records": "operators.points",
    "parse_records_with": "operators.points",
    "with_identities": "operators.identity",
    "Snapshot": "operators.snapshot",
    "aggregate_nodes": "operators.metrics",
    "run_update": "plans.update",
}
__all__ = sorted(_HOMES)


def __getattr__(name: str):
    if name not in _HOMES:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(importlib.import_module(f"{__name__}.{_HOMES[name]}"), name)

"""Named queries: importing this package registers every query module."""

from importlib import import_module

from .registry import ORACLE, QUERIES, query

_MODULES = [
    "q_text",
    "q_rows",
    "q_relational",
    "q_io",
    "q_udfs",
    "q_streams",
    "q_graph",
    "q_features",
    "q_models",
]

for _m in _MODULES:
    import_module(f"{__name__}.{_m}")

__all__ = ["QUERIES", "ORACLE", "query"]

"""Registered queries over the civic tables."""

from importlib import import_module

from . import registry

_MODULES = ["detector_queries", "profile_queries", "compliance_queries", "entity_queries", "health_queries", "streaming_queries", "facts_queries", "remaining_queries", "people_queries", "repair_queries", "stream_state_queries", "version_queries", "payload_queries", "audit_queries", "whole_queries"]


def _load() -> None:
    for name in _MODULES:
        import_module(f"{__name__}.{name}")


def queries() -> dict:
    _load()
    return registry.QUERIES


def oracle_sql() -> dict:
    _load()
    return registry.ORACLES

"""Incremental landing of the JSON inputs (Structured Streaming, availableNow).

The source model is batch only; streaming here serves one purpose: parse each
session file once and keep a Parquet copy up to date as files arrive."""

from .landing import Landed, current_deliveries, land_events, land_lineups, read_deliveries, read_landed
from .profiles import Updated, entity_profiles, land, read_entities, update_entities

__all__ = [
    "Landed",
    "Updated",
    "current_deliveries",
    "entity_profiles",
    "land",
    "land_events",
    "land_lineups",
    "read_deliveries",
    "read_entities",
    "read_landed",
    "update_entities",
]

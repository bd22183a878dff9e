from .bucketed import open_bucketed, write_bucketed
from .json_sources import (
    accepted,
    explode_path,
    explode_segments,
    flatten,
    flatten_events,
    json_input,
    load_events,
    load_lineups,
    load_rejected,
    load_sessions,
    missing_sessions,
    optional_field,
    path_key,
    rejected,
    session_dimension,
    session_keys,
    variant_fields,
)
from .published import parts_of, publish, read_published
from .sinks import drop_vectors, write_parquet

__all__ = [
    "accepted",
    "drop_vectors",
    "explode_path",
    "explode_segments",
    "flatten",
    "flatten_events",
    "json_input",
    "load_events",
    "load_lineups",
    "load_rejected",
    "load_sessions",
    "missing_sessions",
    "open_bucketed",
    "optional_field",
    "parts_of",
    "path_key",
    "publish",
    "read_published",
    "rejected",
    "session_dimension",
    "session_keys",
    "variant_fields",
    "write_bucketed",
    "write_parquet",
]

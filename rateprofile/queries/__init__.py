"""Registry of the test-table queries: ``QUERIES[name](spark, sf_dir)`` returns a
DataFrame, ``ORACLE[name]`` is the equivalent DuckDB SQL over the same tables.

Queries without an ORACLE entry are model fits (K-Means, Gaussian mixture, k
sweeps) whose results depend on seeded random initialisation; they are checked
by row count here and by invariants in ``tests/``.
"""

from . import em, ev, lo, src

QUERIES = {**src.QUERIES, **ev.QUERIES, **lo.QUERIES, **em.QUERIES}
ORACLE = {**src.ORACLE, **ev.ORACLE, **lo.ORACLE, **em.ORACLE}

FLAGSHIP = "entity_features"

__all__ = ["QUERIES", "ORACLE", "FLAGSHIP"]

"""rateprofile: exposure-normalised entity profiles and their clusterings on Spark.

Every operator takes DataFrames (plus column names as parameters) and returns
DataFrames; nothing is collected to the driver except bounded model state
(k centroids, a k-sweep table, per-family sizes).

Sub-packages
------------
sources    explicit-schema JSON scans, path keys, nested flattening, variants, array files by
           byte ranges, sinks, published and bucketed tables
functions  column expressions (clock parsing, safe ratios, label rules, event predicates)
operators  exposure, conditional counts, entity features, scaling, K-Means sweeps, mixtures,
           saved models, labellings, deliveries, assessment
plans      the two end-to-end pipelines (global and per-family profiles)
streaming  incremental JSON -> Parquet landing with Structured Streaming, entity tables that follow it
queries    adapters from the test tables to the operators, plus DuckDB oracle SQL
cli        ``python -m rateprofile {global,families,apply,land}``

See README.md for the operator inventory and the scale design, docs/PLANS.md for
the physical plans and docs/ADAPTERS.md for the test-table bindings.
"""

__version__ = "0.1.0"

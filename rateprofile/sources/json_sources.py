"""Scans of the nested JSON inputs.

Each input file is one JSON array (events or lineups of one session; matches of
one cohort), so files are read with ``multiLine`` and an explicit schema. A
multi-line JSON file is not splittable: one task per file. For repeated
analysis land the JSON once as Parquet (``streaming.landing``) and run the
operators on the Parquet copy, which adds column pruning and predicate
pushdown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from .schemas import EVENT_SCHEMA, LINEUP_SCHEMA, MATCH_SCHEMA

# --- Fixed values: file naming ----------------------------------------------------
SESSION_KEY_PATTERN = r"(\d+)\.json$"
COHORT_PATH_PATTERN = r"(\d+)/(\d+)\.json$"
CORRUPT = "_corrupt_record"
# --- end of fixed values ------------------------------------------------------------


def path_key(pattern: str = SESSION_KEY_PATTERN, group: int = 1, cast: str | None = "long") -> Column:
    """Key extracted from the source file path of each row.

    Uses the ``_metadata.file_path`` column of file sources (per row, pushed
    into the scan); a path that does not match gives NULL, never an error.
    """
    raw = F.regexp_extract(F.col("_metadata.file_path"), pattern, group)
    key = F.when(raw != "", raw)
    return key.try_cast(cast) if cast else key


def read_json_arrays(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = True, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Files holding one JSON array each (``multi_line=True``, one task per file:
    such a file cannot be split) or JSON Lines (``multi_line=False``, one record
    per line, split across tasks like any text file).

    What cannot be parsed (a truncated file, a value of the wrong type) is kept as
    a row with its text in ``_corrupt_record``; ``accepted`` and ``rejected`` tell the two
    kinds apart. ``mode="FAILFAST"`` stops the job instead."""
    return spark.read.schema(with_corrupt(schema)).option("multiLine", multi_line).option("mode", mode).json(path)


def with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def _read_along(raw: DataFrame) -> Column:
    """Always true; a scan must read a data column beside the corrupt record."""
    return F.coalesce(F.length(F.col(raw.columns[0]).cast("string")), F.lit(0)) >= 0


def accepted(raw: DataFrame) -> DataFrame:
    """The records that were parsed."""
    return raw.filter(F.col(CORRUPT).isNull() & _read_along(raw)).drop(CORRUPT)


def rejected(raw: DataFrame) -> DataFrame:
    """(source_file, record): what could not be parsed, e.g. to write it to a reject
    table and count it."""
    return raw.filter(F.col(CORRUPT).isNotNull() & _read_along(raw)).select(
        F.col("_metadata.file_path").alias("source_file"), F.col(CORRUPT).alias("record")
    )


def optional_field(df: DataFrame, path: str, dtype: DataType | str, alias: str | None = None) -> Column:
    """``path`` if the (possibly nested) field exists in ``df``'s schema, else a
    typed NULL (S4). For schema-on-read inputs whose shape varies."""
    current: DataType = df.schema
    for part in path.split("."):
        if not isinstance(current, StructType) or part not in current.fieldNames():
            out = F.lit(None).cast(dtype)
            return out.alias(alias or path.split(".")[-1])
        current = current[part].dataType
    return F.col(path).alias(alias or path.split(".")[-1])


def variant_fields(df: DataFrame, json_col: str, fields: dict[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from JSON text whose shape varies from row to row (S3, S4): ``fields`` is name -> (path, type), paths
    as ``$.a.b[0]``. The text is parsed once, into a variant; a path that a row does not have, or whose value there does not
    fit the type, is NULL in that row, and so is everything of a text that is no JSON. The type
    ``"shape"`` gives the type of the value as it is in that row."""
    parsed = df.select(*keep, F.try_parse_json(F.col(json_col)).alias("_v"))

    def field(path: str, dtype: str) -> Column:
        if dtype != "shape":
            return F.try_variant_get("_v", path, dtype)
        return F.schema_of_variant(F.try_variant_get("_v", path, "variant"))

    return parsed.select(*keep, *[field(path, dtype).alias(name) for name, (path, dtype) in fields.items()])


def flatten(df: DataFrame, plain: Sequence[str] = ()) -> DataFrame:
    """Nested records -> flat columns (S3): every struct is walked down to its
    leaves, and a leaf is named by its path, joined with ``_``. The parts of a path listed in
    ``plain`` leave no trace in the names. Arrays stay arrays (see ``explode_path``)."""
    out: list[Column] = []
    names: set[str] = set()

    def walk(path: tuple[str, ...], dtype: DataType) -> None:
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk((*path, f.name), f.dataType)
            return
        name = "_".join(part for part in path if part not in plain)
        if name in names:
            raise ValueError(f"two fields would be named {name!r}")
        names.add(name)
        out.append(F.col(".".join(f"`{part}`" for part in path)).alias(name))

    for field in df.schema.fields:
        walk((field.name,), field.dataType)
    return df.select(*out)


def explode_path(df: DataFrame, path: str, keep_empty: bool = False) -> DataFrame:
    """One row per element of the array at ``path`` (a dot path, S5). The element takes the place of
    the array, as a column named by the last part of the path; ``keep_empty`` keeps a row with a NULL
    element for an empty or NULL array."""
    parent, _, last = path.rpartition(".")
    element = (F.explode_outer if keep_empty else F.explode)(F.col(path))
    if not parent:
        return df.select(*[c for c in df.columns if c != last], element.alias(last))
    exploded = df.select("*", element.alias(f"_{last}"))
    top, _, inner = path.partition(".")
    return exploded.withColumn(top, F.col(top).dropFields(inner)).withColumnRenamed(f"_{last}", last)


def flatten_events(raw: DataFrame) -> DataFrame:
    """Event records as flat rows."""
    return flatten(raw)


def explode_segments(teams: DataFrame) -> DataFrame:
    """Lineup records -> one row per presence segment of an entity; an entity
    without segments keeps one row with NULL segment fields."""
    players = explode_path(teams, "lineup")
    return flatten(explode_path(players, "lineup.positions", keep_empty=True), plain=("lineup",))


def load_events(
    spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA, multi_line: bool = True, mode: str = "PERMISSIVE"
) -> DataFrame:
    """All event files under ``path`` (a folder or glob) as flat events (S1). Records that
    cannot be parsed are left out; ``load_rejected`` lists them."""
    raw = accepted(read_json_arrays(spark, path, schema, multi_line, mode))
    return flatten_events(raw.withColumn("match_id", path_key()))


def load_lineups(spark: SparkSession, path: str, multi_line: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """All lineup files under ``path`` as flat presence segments."""
    raw = accepted(read_json_arrays(spark, path, LINEUP_SCHEMA, multi_line, mode))
    return explode_segments(raw.withColumn("match_id", path_key()))


def load_rejected(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """(source_file, record) of what cannot be parsed under ``path``."""
    return rejected(read_json_arrays(spark, path, schema, multi_line))


@contextmanager
def json_input(
    spark: SparkSession, path: str, schema: StructType, flat: Callable[[DataFrame], DataFrame], keys: dict[str, Column] | None = None
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(rows, rejected) of the files under ``path``, both from one parse that is kept for the time of the ``with``
    block: rows as ``flat`` makes them, rejected as (source_file, record). ``keys``: columns taken
    from the path of each file (default: ``match_id``)."""
    read = read_json_arrays(spark, path, schema)
    read = read.withColumns({**({"match_id": path_key()} if keys is None else keys), "_source_file": F.col("_metadata.file_path")})
    read = read.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bad = read.filter(F.col(CORRUPT).isNotNull()).select(F.col("_source_file").alias("source_file"), F.col(CORRUPT).alias("record"))
        yield flat(read.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_source_file")), bad
    finally:
        read.unpersist()


def session_keys() -> dict[str, Column]:
    return {"competition_id": path_key(COHORT_PATH_PATTERN, 1), "season_id": path_key(COHORT_PATH_PATTERN, 2)}


def session_dimension(raw: DataFrame, cohort_names: DataFrame | None = None) -> DataFrame:
    """Match records with their cohort -> match_id, competition_id, season_id, season_year (NULL for an unreadable
    date) and, when a (competition_id, season_id, competition_name) table is given, the name."""
    dim = raw.select("match_id", "competition_id", "season_id", F.year(F.col("match_date").try_cast("date")).alias("season_year"))
    return dim if cohort_names is None else dim.join(cohort_names, ["competition_id", "season_id"], "left")


def load_sessions(spark: SparkSession, path: str, cohort_names: DataFrame | None = None) -> DataFrame:
    """Session -> cohort dimension from ``{cohort_id}/{season_id}.json`` match files (S6), as ``session_dimension``
    has it. A match file that cannot be parsed is left out; ``load_rejected`` with ``MATCH_SCHEMA`` lists it."""
    raw = read_json_arrays(spark, path, MATCH_SCHEMA).withColumns(session_keys())
    return session_dimension(accepted(raw), cohort_names)


def missing_sessions(manifest: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Sessions listed in ``manifest`` with no landed rows (S10): an anti join
    against the distinct landed keys (deduplicated with partial aggregation, so
    a session with many rows is one row per map task before the shuffle)."""
    return manifest.join(landed.select(key).distinct(), key, "left_anti")

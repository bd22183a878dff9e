"""Source-level queries on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from ..sources.json_sources import optional_field, path_key, variant_fields
from .common import finish, table

# --- Fixed values -----------------------------------------------------------------------
EVENTS_TABLE_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
PROPS_SCHEMA = "k long"
TABLE_NAME_PATTERN = r"/([a-z_]+)\.parquet"
KEYED_TABLES = ("region", "nation", "supplier")
# --- end of fixed values -----------------------------------------------------------------


def q_event_scan(spark, sf_dir):
    ev = spark.read.schema(EVENTS_TABLE_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    out = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"))
    return finish(out)


def q_file_key(spark, sf_dir):
    parts = [
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").select(
            path_key(TABLE_NAME_PATTERN, 1, cast=None).alias("file_key")
        )
        for t in KEYED_TABLES
    ]
    keyed = parts[0]
    for p in parts[1:]:
        keyed = keyed.unionByName(p)
    return keyed.groupBy("file_key").agg(F.count(F.lit(1)).alias("n_rows"))


def q_flatten_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events", ["event_id", "props"])
    return ev.select("event_id", F.from_json("props", PROPS_SCHEMA).getField("k").alias("k"))


def q_optional_field(spark, sf_dir):
    parsed = table(spark, sf_dir, "events", ["event_id", "props"]).select(
        "event_id", F.from_json("props", PROPS_SCHEMA).alias("p")
    )
    return parsed.select(
        "event_id",
        optional_field(parsed, "p.k", "long", "k"),
        optional_field(parsed, "p.missing", "long", "missing"),
    )


def q_variant_fields(spark, sf_dir):
    """S3 / S4 over texts of five shapes, by event_id: the number as it is, as text, inside an array, not there, and no JSON."""
    ev = table(spark, sf_dir, "events", ["event_id", "props"])
    k = F.get_json_object("props", "$.k")
    shape = F.pmod("event_id", F.lit(5))
    text = (
        F.when(shape == 0, F.concat(F.lit('{"k": '), k, F.lit(', "deep": {"a": ['), k, F.lit(", 7]}}")))
        .when(shape == 1, F.concat(F.lit('{"k": "t'), k, F.lit('"}')))
        .when(shape == 2, F.concat(F.lit('{"k": ['), k, F.lit("]}")))
        .when(shape == 3, F.lit('{"other": null}'))
        .otherwise(F.concat(F.lit('{"k": '), k))
    )
    fields = {"number": ("$.k", "long"), "text": ("$.k", "string"), "first": ("$.k[0]", "int"), "deep": ("$.deep.a[1]", "long"), "shape": ("$.k", "shape")}
    return variant_fields(ev.withColumn("text_", text), "text_", fields, ["event_id"])


ORACLE = {
    "variant_fields": """
with e as (select event_id, event_id % 5 as s, cast(json_extract_string(props, '$.k') as bigint) as k from events)
select event_id, case when s = 0 then k end as number,
       case s when 0 then cast(k as varchar) when 1 then 't' || k when 2 then '[' || k || ']' end as text,
       cast(case when s = 2 then k end as integer) as first, case when s = 0 then 7::bigint end as deep,
       case s when 0 then 'BIGINT' when 1 then 'STRING' when 2 then 'ARRAY<BIGINT>' end as shape
from e""",
    "event_scan": """
select event_type, count(*) as n_events, round(sum(value), 6) as value_sum from events group by event_type""",
    "file_key": " union all ".join(f"select '{t}' as file_key, count(*) as n_rows from {t}" for t in KEYED_TABLES),
    "flatten_props": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "optional_field": """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, cast(null as bigint) as missing
from events""",
}

QUERIES = {
    "variant_fields": q_variant_fields,
    "event_scan": q_event_scan,
    "file_key": q_file_key,
    "flatten_props": q_flatten_props,
    "optional_field": q_optional_field,
}

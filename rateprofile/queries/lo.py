"""Queries on ``lineitem`` and ``orders`` (adapter LO), plus ``customer`` (CU).

LO mapping: session = ``l_orderkey``, entity = ``l_suppkey``, role =
``l_returnflag``, segment weight = ``l_quantity``, cohort = ``o_orderpriority``
with the year of ``o_orderdate``. ``(l_orderkey, l_linenumber)`` is not unique
in the test data, so no query uses it as a key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import LabelRule, label_family
from ..operators import assess, exposure, families
from ..sources.json_sources import explode_path, flatten, missing_sessions
from .common import finish, table

# --- Fixed values of the adapter -----------------------------------------------------
TRAIN_COHORTS = (("1-URGENT", 1995), ("1-URGENT", 1996), ("2-HIGH", 1995), ("2-HIGH", 1996))
TEST_COHORTS = (("3-MEDIUM", 1997), ("5-LOW", 1997), ("5-LOW", 1998))
SPOT_NAMES = ("000000042", "00000013")
RETURNED = "R"
SPOT_NAMES_ANY_CASE = ("CUSTOMER#0000001", "customer#00000077")
SEGMENT_FAMILY_RULES = (
    LabelRule("VEHICLE", equals=("AUTOMOBILE",)),
    LabelRule("HOME", contains=("HOUSE", "FURNI")),
    LabelRule("INDUSTRY", contains=("MACHIN", "BUILD")),
)
# --- end of fixed values ---------------------------------------------------------------

LINE_COLS = ["l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity"]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem", LINE_COLS)


def _orders(spark, sf_dir, cols=("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")):
    return table(spark, sf_dir, "orders", list(cols))


def split_keys(spark, sf_dir):
    """Order -> split by membership of its (priority, year) cohort key in the
    train or test list: a two-column join with a keys table whose size is the
    length of those parameter lists."""
    keys = spark.createDataFrame(
        [(p, y, "train") for p, y in TRAIN_COHORTS] + [(p, y, "test") for p, y in TEST_COHORTS],
        "o_orderpriority string, year long, split string",
    )
    orders = _orders(spark, sf_dir).withColumn("year", F.year("o_orderdate").cast("long"))
    return orders.join(F.broadcast(keys), ["o_orderpriority", "year"], "inner").select("o_orderkey", "split")


def q_segments_explode(spark, sf_dir):
    """Orders with their lines; an order without lines keeps one row with NULL line columns."""
    lines = _lines(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    flat = _orders(spark, sf_dir, ("o_orderkey", "o_custkey")).join(lines, "o_orderkey", "left")
    return finish(flat)


def q_drop_null_segments(spark, sf_dir):
    flat = q_segments_explode(spark, sf_dir)
    return flat.filter(F.col("l_linenumber").isNotNull())


def q_nested_explode(spark, sf_dir):
    """S5 over data that nests: documents hold lines, lines hold words. A line without words keeps a row
    with a NULL word, as an entity without segments does."""
    words = lambda line: F.filter(F.split(line, " "), lambda w: w != "")
    text = F.coalesce("text", F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("number"), words(line).alias("words")))
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", lines.alias("lines"))
    flat = flatten(explode_path(explode_path(docs, "lines"), "lines.words", keep_empty=True), plain=("lines",))
    return flat.groupBy("doc_id", "number").agg(
        F.count("words").alias("n_words"), F.count(F.lit(1)).alias("n_rows"), F.max("words").alias("last_word")
    ).withColumn("number", F.col("number").cast("long"))


def q_missing_sessions(spark, sf_dir):
    return missing_sessions(
        _orders(spark, sf_dir, ("o_orderkey", "o_orderpriority")),
        _lines(spark, sf_dir).select(F.col("l_orderkey").alias("o_orderkey")),
        "o_orderkey",
    )


def q_cohort_dim(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "o_orderkey", F.col("o_orderpriority").alias("cohort"), F.year("o_orderdate").cast("long").alias("year")
    )


def q_role_totals(spark, sf_dir):
    out = exposure.role_time(_lines(spark, sf_dir), ["l_orderkey", "l_suppkey"], "l_returnflag", F.col("l_quantity"))
    return finish(out)


def q_dominant_role(spark, sf_dir):
    return exposure.dominant_role(_lines(spark, sf_dir), ["l_orderkey", "l_suppkey"], "l_returnflag", F.col("l_quantity"))


def q_cross_tab(spark, sf_dir):
    # Lines are counted per (order, flag) before the join with orders: a hot
    # order reaches the join as one row per flag.
    lines = _lines(spark, sf_dir).groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("_n"))
    orders = _orders(spark, sf_dir, ("o_orderkey", "o_orderpriority"))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")
    return joined.groupBy("l_returnflag", "o_orderpriority").agg(F.sum("_n").alias("n"))


def q_cohort_intensity_per_year(spark, sf_dir):
    """Returned lines per 90 units of quantity per (priority, year), with the
    per-period denominator: a priority spans several years, so this differs from
    the per-cohort denominator."""
    lines = _lines(spark, sf_dir)
    sessions = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderpriority").alias("cohort"),
        F.year("o_orderdate").cast("long").alias("year"),
    )
    out = assess.cohort_intensity(
        lines.filter(F.col("l_returnflag") == RETURNED),
        lines,
        sessions,
        "l_orderkey",
        "cohort",
        "year",
        exposure_col="l_quantity",
        per_period_denominator=True,
    )
    return finish(out)


def q_split_keys(spark, sf_dir):
    return split_keys(spark, sf_dir)


def q_split_filter(spark, sf_dir):
    train = split_keys(spark, sf_dir).filter(F.col("split") == "train").select(F.col("o_orderkey").alias("l_orderkey"))
    return finish(_lines(spark, sf_dir).join(train, "l_orderkey", "left_semi"))


def q_spot_check(spark, sf_dir):
    cu = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return assess.spot_check(cu, "c_name", SPOT_NAMES)


def q_spot_check_ignore_case(spark, sf_dir):
    cu = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return assess.spot_check(cu, "c_name", SPOT_NAMES_ANY_CASE, ignore_case=True)


def _segment_families(spark, sf_dir):
    cu = table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return cu.withColumn("family", label_family("c_mktsegment", SEGMENT_FAMILY_RULES))


def q_label_family(spark, sf_dir):
    return _segment_families(spark, sf_dir)


def q_family_k_range(spark, sf_dir):
    return families.family_k_ranges(_segment_families(spark, sf_dir), "family").withColumn(
        "k_min", F.col("k_min").cast("long")
    ).withColumn("k_max", F.col("k_max").cast("long"))


# ------------------------------------------------------------------------- oracle SQL
def _in_list(pairs) -> str:
    return ", ".join(f"('{p}', {y})" for p, y in pairs)


def _segment_case(col: str) -> str:
    parts = []
    for rule in SEGMENT_FAMILY_RULES:
        conds = [f"{col} = '{v}'" for v in rule.equals] + [f"contains({col}, '{v}')" for v in rule.contains]
        parts.append(f"when {' or '.join(conds)} then '{rule.family}'")
    return "case " + " ".join(parts) + " else 'OTHER' end"


_SPLIT_SQL = f"""
keys as (select p, y, 'train' as split from (values {_in_list(TRAIN_COHORTS)}) t(p, y)
         union all
         select p, y, 'test' as split from (values {_in_list(TEST_COHORTS)}) t(p, y)),
sk as (select o_orderkey, keys.split from orders
       join keys on orders.o_orderpriority = keys.p and year(orders.o_orderdate) = keys.y)
"""

ORACLE = {
    "segments_explode": """
select o_orderkey, o_custkey, l_linenumber, l_suppkey, l_returnflag, round(l_quantity, 6) as l_quantity
from orders left join lineitem on o_orderkey = l_orderkey""",
    "drop_null_segments": """
select o_orderkey, o_custkey, l_linenumber, l_suppkey, l_returnflag, round(l_quantity, 6) as l_quantity
from orders join lineitem on o_orderkey = l_orderkey""",
    "nested_explode": """
with l as (select doc_id, i - 1 as number, list_filter(string_split(s[i], ' '), lambda w: w <> '') as w
           from (select doc_id, string_split(coalesce(text, ''), chr(10)) as s from documents), lateral (select unnest(range(1, len(s) + 1)) as i))
select doc_id, number, cast(len(w) as bigint) as n_words, cast(greatest(len(w), 1) as bigint) as n_rows, list_max(w) as last_word from l""",
    "missing_sessions": """
select o_orderkey, o_orderpriority from orders
where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "cohort_dim": """
select o_orderkey, o_orderpriority as cohort, cast(year(o_orderdate) as bigint) as year from orders""",
    "role_totals": """
select l_orderkey, l_suppkey, l_returnflag, round(sum(l_quantity), 6) as role_time
from lineitem group by l_orderkey, l_suppkey, l_returnflag""",
    "dominant_role": """
select l_orderkey, l_suppkey, primary_role from (
  select l_orderkey, l_suppkey, l_returnflag as primary_role,
         row_number() over (partition by l_orderkey, l_suppkey
                            order by sum(l_quantity) desc, l_returnflag asc nulls last) as rn
  from lineitem group by l_orderkey, l_suppkey, l_returnflag) t
where rn = 1""",
    "cross_tab": """
select l_returnflag, o_orderpriority, count(*) as n
from lineitem join orders on l_orderkey = o_orderkey group by l_returnflag, o_orderpriority""",
    "cohort_intensity_per_year": f"""
with ss as (select o_orderkey as k, o_orderpriority as cohort, cast(year(o_orderdate) as bigint) as year from orders),
nn as (select cohort, year, count(*) as n_events from lineitem join ss on l_orderkey = k
       where l_returnflag = '{RETURNED}' group by cohort, year),
dd as (select cohort, year, sum(l_quantity) as total_exposure from lineitem join ss on l_orderkey = k
       group by cohort, year)
select cohort, year, n_events, round(total_exposure, 6) as total_exposure,
       round(n_events / total_exposure * 90.0, 6) as events_per_90
from nn join dd using (cohort, year)""",
    "split_keys": f"""
with {_SPLIT_SQL}
select o_orderkey, split from sk""",
    "split_filter": f"""
with {_SPLIT_SQL}
select l_orderkey, l_suppkey, l_linenumber, l_returnflag, round(l_quantity, 6) as l_quantity
from lineitem where l_orderkey in (select o_orderkey from sk where split = 'train')""",
    "spot_check": f"""
select c_custkey, c_name, c_mktsegment from customer
where {" or ".join(f"contains(c_name, '{s}')" for s in SPOT_NAMES)}""",
    "spot_check_ignore_case": f"""
select c_custkey, c_name, c_mktsegment from customer
where {" or ".join(f"contains(lower(c_name), '{s.lower()}')" for s in SPOT_NAMES_ANY_CASE)}""",
    "label_family": f"""
select c_custkey, c_mktsegment, {_segment_case('c_mktsegment')} as family from customer""",
    "family_k_range": f"""
with s as (select {_segment_case('c_mktsegment')} as family, count(*) as n from customer group by 1)
select family, n, cast(2 as bigint) as k_min,
       cast(greatest(2, least(6, floor(n / 12))) as bigint) as k_max,
       n >= 24 as eligible
from s""",
}

QUERIES = {
    "segments_explode": q_segments_explode,
    "drop_null_segments": q_drop_null_segments,
    "nested_explode": q_nested_explode,
    "missing_sessions": q_missing_sessions,
    "cohort_dim": q_cohort_dim,
    "role_totals": q_role_totals,
    "dominant_role": q_dominant_role,
    "cross_tab": q_cross_tab,
    "cohort_intensity_per_year": q_cohort_intensity_per_year,
    "split_keys": q_split_keys,
    "split_filter": q_split_filter,
    "spot_check": q_spot_check,
    "spot_check_ignore_case": q_spot_check_ignore_case,
    "label_family": q_label_family,
    "family_k_range": q_family_k_range,
}

"""Queries on the ``events`` table (adapter EV).

Mapping onto the profile model: session = calendar day of ``ts``, entity =
``user_id``, role and event kind = ``event_type``, clock = minute of the day
(``hour*60 + minute``) plus seconds. Each event is also a presence segment
starting at its clock time and lasting ``value`` seconds; a segment with
``value >= 200`` has no recorded end and stays open until the session ends.
Cohorts are the two halves of the month (A before 2024-01-16, B from then on);
cohort intensity measures ``error`` events.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import LabelRule, label_family, minutes_to_clock, clock_to_minutes, safe_ratio
from ..functions.predicates import event_counters
from ..operators import assess, clustering, counts, deliveries, exposure, families, features, scaling, sweep
from ..operators.features import Rate, Ratio
from ..plans.family_profiles import SAMPLE_N as FAMILY_SAMPLE_N
from ..plans.family_profiles import SEED, family_cross_tab, family_samples, features_used
from ..plans.global_profiles import K_RANGE, cluster_and_assess
from ..session import cut_lineage
from ..sources.bucketed import write_bucketed
from ..sources.published import publish, read_published
from .common import finish, shared_folder, table
from .em import FIT_PARTITIONS
from .kmeans_sql import chosen_sql, grid_sql, kmeans_sql

# --- Fixed values of the adapter -----------------------------------------------------
SPLIT_DATE = "2024-01-16"
EVENT_TYPES = ("click", "view", "purchase", "error", "signup")
OPEN_MIN_VALUE = 200.0
INTENSITY_TYPE = "error"
HIGH_VALUE = 80.0
MIN_EXPOSURE = 270.0
EV_FAMILY_RULES = (
    LabelRule("ACQUIRE", equals=("signup",)),
    LabelRule("CONVERT", contains=("purchase",)),
    LabelRule("BROWSE", contains=("click", "view")),
)
EV_OVERRIDES = {"BROWSE": 3}
EV_BUCKETS = 8
# --- end of fixed values ---------------------------------------------------------------

EV_OUTPUTS = [
    Rate("click"),
    Rate("view"),
    Rate("purchase"),
    Rate("error"),
    Rate("signup"),
    Rate("high_value"),
    Ratio("purchase_per_click", "purchase", "click"),
    Ratio("error_share", "error", "total_events"),
]
EV_FEATURES = [o.name for o in EV_OUTPUTS]


def ev_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day"),
        (F.hour("ts") * 60 + F.minute("ts")).alias("minute"),
        F.second("ts").alias("second"),
    )


def _segment_times() -> list:
    start = F.col("minute") + F.col("second") / 60.0
    end = F.when(F.col("value") >= OPEN_MIN_VALUE, F.lit(None).cast("double")).otherwise(start + F.col("value") / 60.0)
    return [start.alias("from_min"), end.alias("to_min")]


def ev_segments(ev: DataFrame) -> DataFrame:
    return ev.select("event_id", "day", "user_id", F.col("event_type").alias("role"), *_segment_times())


def ev_session_end(ev: DataFrame, mode: str = "reference") -> DataFrame:
    return exposure.session_end(ev, "day", "minute", "second", mode=mode)


def ev_exposure(ev: DataFrame) -> DataFrame:
    return exposure.exposure(ev_segments(ev), "day", "user_id", ends=ev_session_end(ev))


def ev_counters() -> dict:
    c = {t: F.col("event_type") == t for t in EVENT_TYPES}
    c["high_value"] = F.col("value") >= HIGH_VALUE
    c["high_value_purchase"] = (F.col("event_type") == "purchase") & (F.col("value") >= HIGH_VALUE)
    return c


def ev_counts(ev: DataFrame) -> DataFrame:
    return counts.conditional_counts(ev, ["day", "user_id"], ev_counters())


def _split(df: DataFrame) -> DataFrame:
    return df.withColumn("split", F.when(F.col("day") < SPLIT_DATE, "A").otherwise("B"))


def summarise(ev: DataFrame) -> DataFrame:
    """One row per (day, user, event type): counts, the segment summary of the role and the clock maxima."""
    rows = ev.select("*", *_segment_times())
    return rows.groupBy("day", "user_id", "event_type").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("value") >= HIGH_VALUE).alias("high_value"),
        F.max("minute").alias("last_minute"),
        F.max("second").alias("last_second"),
        *exposure.segment_summary("from_min", "to_min"),
    )


def ev_summary(ev: DataFrame) -> DataFrame:
    """The materialised summary: whatever is derived from it reads the events once."""
    return cut_lineage(summarise(ev))


def summary_counts(summary: DataFrame) -> DataFrame:
    """The counters of ``ev_counters`` from the summary."""
    is_type = lambda t: F.col("event_type") == t
    aggs = [F.sum(F.when(is_type(t), F.col("total_events")).otherwise(0)).alias(t) for t in EVENT_TYPES]
    purchases = F.sum(F.when(is_type("purchase"), F.col("high_value")).otherwise(0))
    return summary.groupBy("day", "user_id").agg(
        F.sum("total_events").alias("total_events"), *aggs, F.sum("high_value").alias("high_value"), purchases.alias("high_value_purchase")
    )


def summary_exposure(summary: DataFrame) -> DataFrame:
    ends = exposure.session_end(summary, "day", "last_minute", "last_second")
    roles = summary.withColumnRenamed("event_type", "role").filter(F.col("role").isNotNull())
    return exposure.exposure_of_summary(roles, ends, "day", "user_id", "role")


def ev_features(spark: SparkSession, sf_dir: str, by_split: bool = False) -> DataFrame:
    summary = ev_summary(ev_events(spark, sf_dir))
    cnt, expo = summary_counts(summary), summary_exposure(summary)
    by = ()
    if by_split:
        cnt, expo, by = _split(cnt), _split(expo), ("split",)
    return features.entity_features(
        cnt,
        expo,
        "user_id",
        EV_OUTPUTS,
        by=by,
        min_exposure=MIN_EXPOSURE,
        label_out="label",
        exposure_out="exposure_min",
        sessions_out="days_seen",
    )


# ----------------------------------------------------------------------------- queries
def q_entity_features(spark, sf_dir):
    return finish(ev_features(spark, sf_dir))


def q_clock_parse(spark, sf_dir):
    ev = ev_events(spark, sf_dir).select("event_id", minutes_to_clock("minute", "second").alias("clock"))
    return finish(ev.select("event_id", "clock", clock_to_minutes("clock").alias("clock_min")))


def q_session_end(spark, sf_dir):
    return finish(exposure.session_ends(ev_events(spark, sf_dir), "day", "minute", "second"))


def q_open_end_fill(spark, sf_dir):
    ev = ev_events(spark, sf_dir)
    filled = exposure.fill_open_ends(ev_segments(ev), ev_session_end(ev), "day")
    return finish(filled.select("event_id", "day", "from_min", "to_min"))


def q_exposure_span(spark, sf_dir):
    ev = ev_events(spark, sf_dir)
    expo = exposure.exposure(ev_segments(ev), "day", "user_id", role=None, ends=ev_session_end(ev))
    return finish(expo)


def q_exposure_sum_segments(spark, sf_dir):
    ev = ev_events(spark, sf_dir)
    expo = exposure.exposure(
        ev_segments(ev), "day", "user_id", role=None, ends=ev_session_end(ev), mode="sum_segments"
    )
    return finish(expo)


def q_exposure_with_role(spark, sf_dir):
    return finish(ev_exposure(ev_events(spark, sf_dir)))


def q_session_entity_counts(spark, sf_dir):
    return ev_counts(ev_events(spark, sf_dir))


def _bucketed(spark, df, key):
    path = f"{shared_folder(spark)}/bucketed-{uuid.uuid4().hex}"
    return write_bucketed(df, path, [key], EV_BUCKETS)


def bucketed_exposure(spark, sf_dir):
    """Exposure from segments and session ends that are both landed bucketed on the session (J1, J2): no shuffle."""
    ev = ev_events(spark, sf_dir)
    segments, clocks = _bucketed(spark, ev_segments(ev), "day"), _bucketed(spark, ev.select("day", "minute", "second"), "day")
    return exposure.exposure(segments, "day", "user_id", ends=ev_session_end(clocks))


def q_bucketed_exposure(spark, sf_dir):
    return finish(bucketed_exposure(spark, sf_dir))


def bucketed_features(spark, sf_dir):
    """Features from session counts and exposure that are both landed bucketed on the entity (J4, J5): no shuffle."""
    summary = ev_summary(ev_events(spark, sf_dir))
    cnt, expo = _bucketed(spark, summary_counts(summary), "user_id"), _bucketed(spark, summary_exposure(summary), "user_id")
    return features.entity_features(
        cnt, expo, "user_id", EV_OUTPUTS, min_exposure=MIN_EXPOSURE, label_out="label", exposure_out="exposure_min", sessions_out="days_seen"
    )


def q_bucketed_features(spark, sf_dir):
    return finish(bucketed_features(spark, sf_dir))


def q_last_delivery(spark, sf_dir):
    """Every day is delivered once, even days a second time with other values, and days divisible by three once more, late,
    with an older stamp; the rows of the last delivery count."""
    ev = ev_events(spark, sf_dir).select("event_id", "day", "user_id", "value")
    day = F.dayofmonth(F.to_date("day"))
    copies = [(1, 2, F.lit(True), F.lit(0.0)), (2, 3, day % 2 == 0, F.lit(1.0)), (3, 1, day % 3 == 0, F.lit(5.0))]
    rows_ = None
    for delivery, stamp, has, plus in copies:
        part = ev.filter(has).withColumns({"value": F.col("value") + plus, "delivery": F.lit(delivery), "stamp": F.lit(stamp)})
        rows_ = part if rows_ is None else rows_.unionByName(part)
    files = rows_.select("day", "delivery", "stamp").distinct()
    current = deliveries.current_rows(rows_, deliveries.last_deliveries(files, "day", ["stamp"]), ["day", "delivery"])
    return finish(current.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"), F.max("delivery").cast("long").alias("delivery")))


def q_incremental_totals(spark, sf_dir):
    """A4 - A6 kept up to date: the days before the split are merged first, then the others as a second batch, from whose
    partial aggregates only the users who occur in it are rebuilt; published in parts, and read back."""
    ev = _split(ev_events(spark, sf_dir))
    summary = cut_lineage(ev.groupBy("split", "day", "user_id").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"), F.max("minute").alias("last_minute")))
    build = lambda partials: deliveries.merged_partials(partials, ["user_id"], ["n_events", "value_sum"], ["last_minute"])
    path = f"{shared_folder(spark)}/totals-{uuid.uuid4().hex}"
    part = F.pmod(F.col("user_id"), F.lit(8)).cast("string")
    publish(build(summary.filter("split = 'A'")).withColumn("part", part).withColumnRenamed("part", "bucket"), path, "bucket")
    touched = summary.filter("split = 'B' and user_id % 3 <> 0").select("user_id").distinct()
    rebuilt = build(summary.join(touched, "user_id", "left_semi")).withColumn("bucket", part)
    parts = [r["bucket"] for r in rebuilt.select("bucket").distinct().collect()]
    publish(deliveries.refresh(read_published(spark, path, rebuilt.schema, parts), touched, rebuilt, ["user_id"]), path, "bucket", parts)
    return finish(read_published(spark, path).drop("bucket"))


def q_entity_totals(spark, sf_dir):
    cnt = ev_counts(ev_events(spark, sf_dir))
    cols = ["total_events", *EVENT_TYPES, "high_value", "high_value_purchase"]
    return features.entity_totals(cnt, ["user_id"], cols)


def q_entity_exposure(spark, sf_dir):
    expo = ev_exposure(ev_events(spark, sf_dir))
    return finish(features.entity_exposure(expo, ["user_id"], out="exposure_min", sessions_out="days_seen"))


def q_majority_label(spark, sf_dir):
    expo = ev_exposure(ev_events(spark, sf_dir))
    return features.majority_label(expo, ["user_id"], "primary_role", "label")


def q_min_exposure(spark, sf_dir):
    expo = ev_exposure(ev_events(spark, sf_dir))
    tot = features.entity_exposure(expo, ["user_id"], out="exposure_min", sessions_out="days_seen")
    return finish(tot.filter(F.col("exposure_min") >= MIN_EXPOSURE).select("user_id", "exposure_min"))


def q_safe_ratio(spark, sf_dir):
    cnt = ev_counts(ev_events(spark, sf_dir))
    return finish(cnt.select("day", "user_id", safe_ratio("purchase", "click").alias("purchase_per_click")))


def q_fill_numeric(spark, sf_dir):
    ev = ev_events(spark, sf_dir)
    cnt = ev_counts(ev).join(ev_exposure(ev).select("day", "user_id", "primary_role"), ["day", "user_id"], "left")
    ratios = cnt.select(
        "day",
        "user_id",
        "primary_role",
        safe_ratio("purchase", "click").alias("purchase_per_click"),
        safe_ratio("high_value_purchase", "purchase").alias("high_value_share"),
    )
    return finish(ratios.na.fill(0.0))


def q_cohort_intensity(spark, sf_dir):
    summary = ev_summary(ev_events(spark, sf_dir))
    sessions = summary.select("day").distinct().select(
        "day",
        F.when(F.col("day") < SPLIT_DATE, "A").otherwise("B").alias("cohort"),
        F.year(F.to_date("day")).cast("long").alias("year"),
    )
    errors = summary.filter(F.col("event_type") == INTENSITY_TYPE)
    out = assess.cohort_intensity(
        errors, summary_exposure(summary), sessions, "day", "cohort", "year", count_col="total_events"
    )
    return finish(out)


def q_profile_drift(spark, sf_dir):
    feats = ev_features(spark, sf_dir, by_split=True)
    return finish(assess.split_drift(feats, "label", "split", EV_FEATURES, "A", "B"))


def ev_family_features(spark, sf_dir):
    return ev_features(spark, sf_dir).withColumn("family", label_family("label", EV_FAMILY_RULES))


def q_family_sizes(spark, sf_dir):
    return ev_family_features(spark, sf_dir).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


def q_family_standardise(spark, sf_dir):
    z = scaling.grouped_standardise(ev_family_features(spark, sf_dir), "family", EV_FEATURES)
    return finish(z.select("user_id", "family", *[f"z_{c}" for c in EV_FEATURES]))


def _global(spark, sf_dir):
    feats = ev_features(spark, sf_dir, by_split=True)
    return feats, cluster_and_assess(feats, EV_FEATURES, "user_id", None, "label", train_value="A", test_value="B", partitions=FIT_PARTITIONS)


def q_global_clusters(spark, sf_dir):
    """Pipeline L1's model half on the events table: fit on the first half of the
    month (A) with the full k sweep, transfer to the second (B): the entities of both with their
    K-Means cluster, and the Gaussian-mixture cluster of the train entities."""
    _, res = _global(spark, sf_dir)
    train = res["train_clusters"].select("user_id", F.lit("A").alias("split"), "cluster_kmeans", "cluster_gmm", "gmm_max_prob")
    test = res["test_clusters"].select("user_id", F.lit("B").alias("split"), "cluster_kmeans")
    return finish(train.unionByName(test, allowMissingColumns=True))


def q_global_fit_check(spark, sf_dir):
    """What must hold for the real fit of L1, per split: the entities clustered and, for the train
    split, the total sum of squares of the scaled features as the sum of its within and between
    parts (a partition of it by the fitted clusters)."""
    feats, res = _global(spark, sf_dir)
    scaled, _ = scaling.standardise(feats.filter(F.col("split") == "A"), EV_FEATURES)
    labelled = scaled.select("user_id", "features").join(res["train_clusters"].select("user_id", "cluster_kmeans"), "user_id")
    parts = clustering.sum_of_squares(labelled, "cluster_kmeans")
    n = res["train_clusters"].select(F.lit("A").alias("split")).unionByName(res["test_clusters"].select(F.lit("B").alias("split")))
    counts_ = n.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    total = parts.select(F.lit("A").alias("split"), F.round(F.col("within") + F.col("between"), 4).alias("total_ss"))
    both = counts_.unionByName(total, allowMissingColumns=True)
    return both.groupBy("split").agg(F.max("n").alias("n"), F.max("total_ss").alias("total_ss"))


def _family_result(spark, sf_dir):
    return families.cluster_families(
        ev_family_features(spark, sf_dir), "user_id", "family", {}, EV_FEATURES, overrides=EV_OVERRIDES
    )


def q_family_clusters(spark, sf_dir):
    return _family_result(spark, sf_dir)["assignments"].select("user_id", "family", "cluster")


def q_family_choice(spark, sf_dir):
    """The k of each family (M9-M12): the best of its sweep, or the override that passes the guard."""
    return finish(_family_result(spark, sf_dir)["choice"])


def q_family_sweep(spark, sf_dir):
    """Cost and silhouette of every k of every family (M9)."""
    return finish(_family_result(spark, sf_dir)["sweep"])


def q_family_report(spark, sf_dir):
    """The family report (S9) over the clustered entities: clusters by label (rank NULL) and the first members
    of each cluster (n NULL)."""
    clustered = _family_result(spark, sf_dir)["assignments"]
    cross = family_cross_tab(clustered, "label").select("family", "cluster", "label", "n")
    first = family_samples(clustered, "user_id", FAMILY_SAMPLE_N).select("family", "cluster", F.col("rank").cast("long").alias("rank"), "user_id", "label")
    return cross.unionByName(first, allowMissingColumns=True)


def q_family_features_used(spark, sf_dir):
    """The feature list each clustered family is fitted on (M16), where one family has its own."""
    own = {"ACQUIRE": EV_FEATURES[:2]}
    feats = ev_family_features(spark, sf_dir)
    res = families.cluster_families(feats, "user_id", "family", own, EV_FEATURES, max_steps=0)
    return res["choice"].select("family", "n", features_used(own, EV_FEATURES).alias("features_used"))


def q_global_transfer(spark, sf_dir):
    """L1's K-Means half: the chosen k, and the cluster of every entity of both halves of the month from the fit on the first."""
    _, res = _global(spark, sf_dir)
    both = [res[t].select("user_id", F.lit(s).alias("split"), "cluster_kmeans") for t, s in (("train_clusters", "A"), ("test_clusters", "B"))]
    chosen = res["sweep"].filter("chosen").select(F.col("k").alias("chosen_k"))
    return both[0].unionByName(both[1]).withColumn("chosen_k", chosen.scalar())


def q_global_profile(spark, sf_dir):
    """L1's ordered training profile (G1): the clusters in their order, with the position of each."""
    _, res = _global(spark, sf_dir)
    # k rows: their order as they are read
    ordered = res["train_profile"].withColumn("position", (F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) - 1).cast("long"))
    return finish(ordered.select("position", "cluster_kmeans", "n", *[f"mean_{c}" for c in EV_FEATURES]))


def q_family_fit_check(spark, sf_dir):
    """The entities that L2 clusters: all of the families with at least 24, each once, in clusters 0 to k - 1."""
    res = _family_result(spark, sf_dir)
    k = res["choice"].select("family", "chosen_k")
    own = res["assignments"].select("user_id", "family", "cluster").join(F.broadcast(k), "family")
    return own.groupBy("family").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("user_id").alias("n_entities"),
        F.count_if(F.col("cluster").between(0, F.col("chosen_k") - 1)).alias("n_valid"),
    )


# The flat event shape of the football model, filled from the events table: kinds and outcomes follow
# from the number k in props, coordinates from value.
KINDS = ("Pass", "Shot", "Dribble", "Duel", "Interception", "Pressure", "Goal Keeper")
KEEPER_KINDS = ("Shot Faced", "Shot Saved", "Shot Saved to Post", "Shot Saved Off Target", "Collected", "Punch", "Keeper Sweeper")
DUEL_OUTCOMES = ("Won", "Success", "Success In Play", "Success Out", "Lost")


def ev_flat_events(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events", ["event_id", "user_id", "value", "props"])
    k = F.get_json_object("props", "$.k").try_cast("int")
    ev = ev.withColumn("k", k).withColumn("m", F.pmod(F.floor(F.col("value")).cast("int"), F.lit(100)))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.pmod("k", F.lit(7)) + 1)
    k, m = F.col("k"), F.col("m")
    none = F.lit(None)
    return ev.select(
        "event_id",
        F.when(F.pmod(k, F.lit(11)) != 0, F.col("user_id")).alias("player_id"),
        kind.alias("type_name"),
        F.when(F.pmod(k, F.lit(13)) != 0, F.array(F.col("value"), F.lit(40.0))).alias("location"),
        F.array(F.col("value") + F.pmod(k, F.lit(30)) - 10.0, F.lit(40.0)).alias("pass_end_location"),
        F.when(F.pmod(m, F.lit(3)) == 0, "Incomplete").alias("pass_outcome_name"),
        F.when(F.pmod(m, F.lit(5)) == 0, True).alias("pass_shot_assist"),
        F.when(F.pmod(m, F.lit(4)) == 0, F.pmod(m, F.lit(8)) == 0).alias("pass_goal_assist"),
        F.when(F.pmod(m, F.lit(4)) == 1, "Goal").otherwise("Saved").alias("shot_outcome_name"),
        F.when(F.pmod(m, F.lit(2)) == 0, "Complete").otherwise("Incomplete").alias("dribble_outcome_name"),
        F.when(F.pmod(m, F.lit(6)) < 4, "Tackle").otherwise("Aerial Lost").alias("duel_type_name"),
        F.element_at(F.array(*map(F.lit, DUEL_OUTCOMES)), F.pmod(m, F.lit(5)) + 1).alias("duel_outcome_name"),
        F.when(F.pmod(m, F.lit(17)) == 0, True).alias("pass_aerial_won"),
        F.when(F.pmod(m, F.lit(19)) == 0, True).alias("shot_aerial_won"),
        (F.pmod(m, F.lit(23)) == 0).alias("clearance_aerial_won"),
        none.cast("boolean").alias("miscontrol_aerial_won"),
        F.when(kind == "Goal Keeper", F.element_at(F.array(*map(F.lit, KEEPER_KINDS)), F.pmod(m, F.lit(7)) + 1)).alias("goalkeeper_type_name"),
    )


def q_event_counters(spark, sf_dir):
    """The 17 counters of the football model (E1-E17) as they are, per player."""
    return counts.conditional_counts(ev_flat_events(spark, sf_dir), ["player_id"], event_counters(), require_not_null=["player_id"])


# ------------------------------------------------------------------------- oracle SQL
_EV_CTES = f"""
e as (select event_id, user_id, event_type, value,
             strftime(ts, '%Y-%m-%d') as day,
             hour(ts) * 60 + minute(ts) as mi, second(ts) as se
      from events),
ends as (select day, max(mi) + max(se) / 60.0 as session_end from e group by day),
seg as (select e.event_id, e.day, e.user_id, e.event_type as role,
               e.mi + e.se / 60.0 as from_min,
               coalesce(case when e.value >= {OPEN_MIN_VALUE} then null
                             else e.mi + e.se / 60.0 + e.value / 60.0 end, ends.session_end) as to_min
        from e left join ends on e.day = ends.day),
ex as (select day, user_id, greatest(max(to_min) - min(from_min), 0) as exposure
       from seg group by day, user_id),
rt as (select day, user_id, role, sum(to_min - from_min) as role_time from seg group by day, user_id, role),
pr as (select day, user_id, role as primary_role from (
         select *, row_number() over (partition by day, user_id order by role_time desc, role asc nulls last) as rn
         from rt) t where rn = 1),
exr as (select ex.day, ex.user_id, ex.exposure, pr.primary_role
        from ex left join pr on ex.day = pr.day and ex.user_id = pr.user_id),
cnt as (select day, user_id, count(*) as total_events,
               {", ".join(f"count(*) filter (where event_type = '{t}') as {t}" for t in EVENT_TYPES)},
               count(*) filter (where value >= {HIGH_VALUE}) as high_value,
               count(*) filter (where event_type = 'purchase' and value >= {HIGH_VALUE}) as high_value_purchase
        from e group by day, user_id)
"""


def _features_sql(split: bool) -> str:
    sk = "split, " if split else ""
    sp = "case when day < '{d}' then 'A' else 'B' end as split, ".format(d=SPLIT_DATE) if split else ""
    rates = ",\n       ".join(
        f"{o.counter}::double / exposure_min * 90.0 as {o.name}" for o in EV_OUTPUTS if isinstance(o, Rate)
    )
    ratios = ",\n       ".join(
        f"coalesce({o.numerator}::double / case when {o.denominator} > 0 then {o.denominator} end, 0.0) as {o.name}"
        for o in EV_OUTPUTS
        if isinstance(o, Ratio)
    )
    return f"""
with {_EV_CTES},
exs as (select {sp}* from exr),
cns as (select {sp}* from cnt),
te as (select {sk}user_id, sum(exposure) as exposure_min, count(*) as days_seen from exs group by {sk}user_id),
tt as (select {sk}user_id, sum(total_events) as total_events,
              {", ".join(f"sum({t}) as {t}" for t in EVENT_TYPES)}, sum(high_value) as high_value
       from cns group by {sk}user_id),
vv as (select {sk}user_id, primary_role, count(*) as votes from exs group by {sk}user_id, primary_role),
lb as (select {sk}user_id, primary_role as label from (
         select *, row_number() over (partition by {sk}user_id order by votes desc, primary_role asc nulls last) as rn
         from vv) t where rn = 1),
f as (select te.*, {", ".join(f"tt.{c}" for c in ["total_events", *EVENT_TYPES, "high_value"])}, lb.label
      from te join tt using ({sk}user_id) left join lb using ({sk}user_id)
      where te.exposure_min >= {MIN_EXPOSURE})
select {sk}user_id, label, days_seen, exposure_min,
       {rates},
       {ratios}
from f
"""


def _round_select(inner: str, cols: list[str], digits: int = 6) -> str:
    return "select " + ", ".join(f"round({c}, {digits}) as {c}" for c in cols) + f" from ({inner}) r"


def _flagship_sql() -> str:
    inner = _features_sql(split=False)
    keep = ["user_id", "label", "days_seen", "round(exposure_min, 6) as exposure_min"]
    return (
        "select " + ", ".join(keep) + ", "
        + ", ".join(f"round({c}, 6) as {c}" for c in EV_FEATURES)
        + f" from ({inner}) r"
    )


def _family_case(col: str) -> str:
    parts = []
    for rule in EV_FAMILY_RULES:
        conds = [f"{col} = '{v}'" for v in rule.equals] + [f"contains({col}, '{v}')" for v in rule.contains]
        parts.append(f"when {' or '.join(conds)} then '{rule.family}'")
    return "case " + " ".join(parts) + " else 'OTHER' end"


def _profile_drift_sql() -> str:
    inner = _features_sql(split=True)
    means_a = ", ".join(f"avg({c}) as {c}" for c in EV_FEATURES)
    diffs = ", ".join(f"round(abs(a.{c} - b.{c}), 6) as diff_{c}" for c in EV_FEATURES)
    return f"""
with ff as ({inner}),
a as (select label, count(*) as n, {means_a} from ff where split = 'A' group by label),
b as (select label, count(*) as n, {means_a} from ff where split = 'B' group by label)
select coalesce(a.label, b.label) as label, coalesce(a.n, 0) as n_a, coalesce(b.n, 0) as n_b, {diffs}
from a full join b on a.label is not distinct from b.label
"""


def _family_standardise_sql() -> str:
    inner = _features_sql(split=False)
    zs = ", ".join(
        f"round(case when stddev_samp({c}) over w > 0 then ({c} - avg({c}) over w) / stddev_samp({c}) over w else 0.0 end, 6) as z_{c}"
        for c in EV_FEATURES
    )
    return f"""
with ff as (select *, {_family_case('label')} as family from ({inner}) r)
select user_id, family, {zs}
from ff window w as (partition by family)
"""


def _event_counters_sql() -> str:
    name = lambda xs, i: "case " + " ".join(f"when {i} = {n} then '{x}'" for n, x in enumerate(xs)) + " end"
    return f"""
with b as (select user_id, value, cast(json_extract_string(props, '$.k') as integer) as k, cast(floor(value) as integer) % 100 as m from events),
f as (select *, {name(KINDS, 'k % 7')} as kind, case when k % 13 <> 0 then value end as x,
             value + k % 30 - 10.0 as ex, m % 3 <> 0 as done, {name(DUEL_OUTCOMES, 'm % 5')} as duel,
             case when k % 7 = 6 then {name(KEEPER_KINDS, 'm % 7')} end as gk
      from b where k % 11 <> 0)
select user_id as player_id, count(*) as total_events,
  count(*) filter (where kind = 'Pass') as passes_attempted,
  count(*) filter (where kind = 'Pass' and done) as passes_completed,
  count(*) filter (where kind = 'Pass' and done and ex - x >= 10) as progressive_passes,
  count(*) filter (where kind = 'Pass' and (m % 5 = 0 or m % 8 = 0)) as key_passes,
  count(*) filter (where kind = 'Shot') as shots,
  count(*) filter (where kind = 'Shot' and m % 4 = 1) as goals,
  count(*) filter (where kind = 'Dribble') as dribble_attempts,
  count(*) filter (where kind = 'Dribble' and m % 2 = 0) as dribbles_completed,
  count(*) filter (where kind = 'Duel' and m % 6 < 4 and duel <> 'Lost') as tackles_won,
  count(*) filter (where kind = 'Interception') as interceptions,
  count(*) filter (where m % 17 = 0 or m % 19 = 0 or m % 23 = 0) as aerial_duels_won,
  count(*) filter (where kind = 'Pressure') as pressures,
  count(*) filter (where x >= 80) as attacking_third_touches,
  count(*) filter (where gk = 'Shot Faced') as gk_shots_faced,
  count(*) filter (where gk in ('Shot Saved', 'Shot Saved to Post', 'Shot Saved Off Target')) as gk_shots_saved,
  count(*) filter (where gk in ('Collected', 'Punch')) as gk_claims,
  count(*) filter (where gk = 'Keeper Sweeper') as gk_sweeper_actions
from f where user_id is not null group by user_id"""


def _global_check_sql() -> str:
    ss = " + ".join(f"coalesce((count({c}) - 1) * case when var_samp({c}) > 0 then 1 end, 0)" for c in EV_FEATURES)
    return f"""
with ff as ({_features_sql(split=True)})
select split, count(*) as n, case when split = 'A' then round(cast({ss} as double), 4) end as total_ss
from ff group by split"""


def _family_check_sql() -> str:
    return f"""
with ff as (select {_family_case('label')} as family from ({_features_sql(False)}) r),
s as (select family, count(*) as n from ff group by family)
select family, n, n as n_entities, n as n_valid from s where n >= 24"""


def _zgrid(c: str, mean: str, sd: str) -> str:
    return grid_sql(f"case when {sd} > 0 then ({c} - {mean}) / {sd} else 0 end")


def _family_kmeans_sql(steps: int = sweep.MAX_STEPS, own: str = "") -> str:
    """The families' sweep and choice on top of the feature table: ``choice`` and ``assigned``."""
    st = ", ".join(f"avg({c}) as mu_{c}, stddev_samp({c}) as sd_{c}" for c in EV_FEATURES)
    xs = ", ".join(_zgrid(c, f"mu_{c}", f"sd_{c}") for c in EV_FEATURES)
    overrides = " ".join(f"when '{f}' then {k}" for f, k in EV_OVERRIDES.items())
    return f"""
with ff as materialized (select *, {_family_case('label')} as family from ({_features_sql(False)}) r),
sz as materialized (select family, count(*) as n, greatest({families.K_MIN}, least({families.K_CAP}, count(*) // {families.MIN_PER_CLUSTER})) as k_max,
              case family {overrides} end as override_k
       from ff group by family having count(*) >= {2 * families.MIN_PER_CLUSTER}),
ks as (select family, cast(unnest(range({families.K_MIN}, k_max + 1)) as integer) as k from sz union select family, override_k from sz where override_k is not null),
fs as (select family, {st} from ff group by family),
pts as materialized (select ff.family, cast(user_id as varchar) as id, [{xs}] as x from ff join fs using (family) join sz using (family)),
{kmeans_sql(families.K_CAP, steps, SEED)},
swept as (select f.* from fitted f join sz using (family) where f.k between {families.K_MIN} and sz.k_max),
pick as materialized (select sz.family, sz.n, b.k as silhouette_k, sz.override_k, case when sz.override_k <> b.k then o.min_size end as override_min_size,
  case when sz.override_k <> b.k and o.min_size >= {families.MIN_PER_CLUSTER} then sz.override_k else b.k end as chosen_k
  from sz join {chosen_sql('swept')} b using (family) left join fitted o on o.family = sz.family and o.k = sz.override_k),
choice as (select p.family, p.n, p.silhouette_k, p.override_k, p.override_min_size, p.chosen_k, round(f.silhouette, 6) as chosen_silhouette, p.chosen_k <> p.silhouette_k as overridden
  from pick p join fitted f on f.family = p.family and f.k = p.chosen_k),
assigned as (select cast(m.id as bigint) as user_id, m.family, cast(m.c as integer) as cluster from members m join pick p on p.family = m.family and p.chosen_k = m.k)
"""


def _family_report_sql() -> str:
    return f"""{_family_kmeans_sql()},
al as materialized (select a.*, ff.label from assigned a join ff using (user_id)),
fm as (select family, cluster, user_id, label, row_number() over (partition by family, cluster order by user_id) as rank from al)
select family, cluster, label, count(*) as n, cast(null as bigint) as rank, cast(null as bigint) as user_id from al group by family, cluster, label
union all select family, cluster, label, null, rank, user_id from fm where rank <= {FAMILY_SAMPLE_N}"""


def _global_kmeans_sql() -> str:
    """L1's sweep on the first half of the month, its chosen k, and the clusters of both halves."""
    st = ", ".join(f"avg({c}) as mu_{c}, stddev_samp({c}) as sd_{c}" for c in EV_FEATURES)
    xs = ", ".join(_zgrid(c, f"mu_{c}", f"sd_{c}") for c in EV_FEATURES)
    return f"""
with ff as materialized ({_features_sql(True)}),
fs as (select {st} from ff where split = 'A'),
gr as materialized (select split, user_id, [{xs}] as x from ff, fs),
pts as materialized (select '' as family, cast(user_id as varchar) as id, x from gr where split = 'A'),
ks as (select '' as family, cast(k as integer) as k from range({K_RANGE[0]}, {K_RANGE[-1] + 1}) r(k)),
{kmeans_sql(K_RANGE[-1], sweep.MAX_STEPS, SEED)},
best as (select k from {chosen_sql()} b),
di as (select split, user_id, c, list_inner_product(x, x) - 2 * list_inner_product(x, v) + list_inner_product(v, v) as d
       from gr, centres where k = (select k from best)),
assigned as materialized (select split, user_id, cast(c as integer) as cluster_kmeans from (
  select *, row_number() over (partition by split, user_id order by d, c) as r from di) t where r = 1)
"""


ORACLE = {
    "last_delivery": f"""
with {_EV_CTES},
d as (select day, day(cast(day as date)) % 2 = 0 as again, count(*) as n, sum(value) as v from e group by day)
select day, n, round(v + case when again then n else 0 end, 6) as value_sum, cast(case when again then 2 else 1 end as bigint) as delivery from d""",
    "incremental_totals": f"""
with {_EV_CTES},
s as (select *, day < '{SPLIT_DATE}' as first from e),
t as (select distinct user_id from s where not first and user_id % 3 <> 0)
select user_id, count(*) as n_events, round(sum(value), 6) as value_sum, cast(max(mi) as integer) as last_minute
from s where first or user_id in (select user_id from t) group by user_id""",
    "family_clusters": _family_kmeans_sql() + "select * from assigned",
    "family_choice": _family_kmeans_sql() + "select * from choice",
    "family_sweep": _family_kmeans_sql() + "select family, k, round(training_cost, 6) as training_cost, round(silhouette, 6) as silhouette from swept",
    "family_report": _family_report_sql(),
    "family_features_used": f"""
with ff as (select {_family_case('label')} as family from ({_features_sql(False)}) r)
select family, count(*) as n, case family when 'ACQUIRE' then '{", ".join(EV_FEATURES[:2])}' else '{", ".join(EV_FEATURES)}' end as features_used
from ff group by family having count(*) >= {2 * families.MIN_PER_CLUSTER}""",
    "global_transfer": _global_kmeans_sql() + "select user_id, split, cluster_kmeans, (select k from best) as chosen_k from assigned",
    "global_profile": _global_kmeans_sql()
    + "select cast(row_number() over (order by cluster_kmeans) - 1 as bigint) as position, cluster_kmeans, count(*) as n, "
    + ", ".join(f"round(avg({c}), 6) as mean_{c}" for c in EV_FEATURES)
    + " from assigned join ff using (split, user_id) where split = 'A' group by cluster_kmeans",
    "event_counters": _event_counters_sql(),
    "global_fit_check": _global_check_sql(),
    "family_fit_check": _family_check_sql(),
    "entity_features": _flagship_sql(),
    "clock_parse": """
select event_id, printf('%d:%02d', hour(ts) * 60 + minute(ts), second(ts)) as clock,
       round(hour(ts) * 60 + minute(ts) + second(ts) / 60.0, 6) as clock_min
from events""",
    "session_end": f"""
with {_EV_CTES}
select day, round(max(mi) + max(se) / 60.0, 6) as session_end,
       round(max(mi + se / 60.0), 6) as session_end_exact
from e group by day""",
    "open_end_fill": f"""
with {_EV_CTES}
select event_id, day, round(from_min, 6) as from_min, round(to_min, 6) as to_min from seg""",
    "exposure_span": f"""
with {_EV_CTES}
select day, user_id, round(exposure, 6) as exposure from ex""",
    "exposure_sum_segments": f"""
with {_EV_CTES}
select day, user_id, round(sum(greatest(to_min - from_min, 0)), 6) as exposure from seg group by day, user_id""",
    "exposure_with_role": f"""
with {_EV_CTES}
select day, user_id, round(exposure, 6) as exposure, primary_role from exr""",
    "session_entity_counts": f"""
with {_EV_CTES}
select * from cnt""",
    "entity_totals": f"""
with {_EV_CTES}
select user_id, {", ".join(f"cast(sum({c}) as bigint) as {c}" for c in ["total_events", *EVENT_TYPES, "high_value", "high_value_purchase"])}
from cnt group by user_id""",
    "entity_exposure": f"""
with {_EV_CTES}
select user_id, round(sum(exposure), 6) as exposure_min, count(*) as days_seen from exr group by user_id""",
    "majority_label": f"""
with {_EV_CTES},
vv as (select user_id, primary_role, count(*) as votes from exr group by user_id, primary_role)
select user_id, label from (
  select user_id, primary_role as label,
         row_number() over (partition by user_id order by votes desc, primary_role asc nulls last) as rn
  from vv) t where rn = 1""",
    "min_exposure": f"""
with {_EV_CTES}
select user_id, round(sum(exposure), 6) as exposure_min from exr group by user_id
having sum(exposure) >= {MIN_EXPOSURE}""",
    "safe_ratio": f"""
with {_EV_CTES}
select day, user_id,
       round(purchase::double / case when click > 0 then click end, 6) as purchase_per_click
from cnt""",
    "fill_numeric": f"""
with {_EV_CTES}
select cnt.day, cnt.user_id, exr.primary_role,
       round(coalesce(purchase::double / case when click > 0 then click end, 0.0), 6) as purchase_per_click,
       round(coalesce(high_value_purchase::double / case when purchase > 0 then purchase end, 0.0), 6) as high_value_share
from cnt left join exr on cnt.day = exr.day and cnt.user_id = exr.user_id""",
    "cohort_intensity": f"""
with {_EV_CTES},
ss as (select distinct day, case when day < '{SPLIT_DATE}' then 'A' else 'B' end as cohort,
              cast(year(cast(day as date)) as bigint) as year from e),
nn as (select cohort, year, count(*) as n_events from e join ss using (day)
       where e.event_type = '{INTENSITY_TYPE}' group by cohort, year),
dd as (select cohort, sum(exposure) as total_exposure from exr join ss using (day) group by cohort)
select cohort, year, n_events, round(total_exposure, 6) as total_exposure,
       round(n_events / total_exposure * 90.0, 6) as events_per_90
from nn join dd using (cohort)""",
    "profile_drift": _profile_drift_sql(),
    "family_sizes": f"""
with ff as (select {_family_case('label')} as family from ({_features_sql(False)}) r)
select family, count(*) as n from ff group by family""",
    "family_standardise": _family_standardise_sql(),
}

ORACLE["bucketed_exposure"] = ORACLE["exposure_with_role"]
ORACLE["bucketed_features"] = ORACLE["entity_features"]

QUERIES = {
    "entity_features": q_entity_features,
    "clock_parse": q_clock_parse,
    "session_end": q_session_end,
    "open_end_fill": q_open_end_fill,
    "exposure_span": q_exposure_span,
    "exposure_sum_segments": q_exposure_sum_segments,
    "exposure_with_role": q_exposure_with_role,
    "session_entity_counts": q_session_entity_counts,
    "entity_totals": q_entity_totals,
    "entity_exposure": q_entity_exposure,
    "majority_label": q_majority_label,
    "min_exposure": q_min_exposure,
    "safe_ratio": q_safe_ratio,
    "fill_numeric": q_fill_numeric,
    "cohort_intensity": q_cohort_intensity,
    "profile_drift": q_profile_drift,
    "family_sizes": q_family_sizes,
    "family_standardise": q_family_standardise,
    "family_clusters": q_family_clusters,
    "last_delivery": q_last_delivery,
    "incremental_totals": q_incremental_totals,
    "bucketed_exposure": q_bucketed_exposure,
    "bucketed_features": q_bucketed_features,
    "family_choice": q_family_choice,
    "family_sweep": q_family_sweep,
    "family_report": q_family_report,
    "family_features_used": q_family_features_used,
    "global_transfer": q_global_transfer,
    "global_profile": q_global_profile,
    "global_clusters": q_global_clusters,
    "global_fit_check": q_global_fit_check,
    "family_fit_check": q_family_fit_check,
    "event_counters": q_event_counters,
}

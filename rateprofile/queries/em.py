"""Queries on ``embeddings`` (adapter EM): entity = ``vec_id``, feature vector =
``embedding`` (64 floats), label = ``label``. The held-out cohort for transfer
checks is the rows with label >= 5 (fit on labels 0-4), a split by an entity
attribute, as the source model splits by competition.

Exact checks compare long-form vectors: ``posexplode`` in Spark (position from
0) against ``generate_subscripts(...) - 1`` with ``unnest`` in DuckDB.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.columns import array_head, contains_any
from ..operators import assess, clustering, families, labellings, models, scaling, sweep
from ..session import cut_lineage
from ..sources.published import publish, read_published
from ..sources.sinks import drop_vectors, write_parquet
from .common import finish, shared_folder, table
from .kmeans_sql import chosen_sql, grid_sql, kmeans_sql

# --- Fixed values of the adapter -----------------------------------------------------
DIM = 64
HOLDOUT_MIN_LABEL = 5
K = 5
SWEEP_KS = tuple(range(3, 11))
SAMPLE_N = 8
BLENDED_N = 15
SEED = 42
GUARD_FLOOR = 12
#: Layout of the fits on the test tables (a parameter; the default suits larger tables).
FIT_PARTITIONS = 8
#: Substrings of the many-names check, and their number.
MANY = 2000
MANY_NAMES = tuple(f"{7 * i}-" if i % 2 == 0 else f"v{i}1" for i in range(MANY))
# --- end of fixed values ---------------------------------------------------------------

FEATS = [f"f{i}" for i in range(DIM)]


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])


def _scaled(spark, sf_dir):
    scaled, model = scaling.standardise(_emb(spark, sf_dir), "embedding")
    return scaled, model


@contextmanager
def _fit_input(spark, sf_dir):
    scaled, _ = _scaled(spark, sf_dir)
    with clustering.fitting(scaled.select("vec_id", "label", "features"), "vec_id", FIT_PARTITIONS) as laid:
        yield laid


def q_vec_head(spark, sf_dir):
    return finish(_emb(spark, sf_dir).select("vec_id", array_head("embedding", 0).cast("double").alias("x0")))


def q_max_component(spark, sf_dir):
    return finish(_emb(spark, sf_dir).select("vec_id", F.array_max("embedding").cast("double").alias("max_component")))


def q_standardise(spark, sf_dir):
    scaled, _ = _scaled(spark, sf_dir)
    return finish(scaling.vector_long(scaled, ["vec_id"], "features"))


def q_holdout_standardise(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    _, model = scaling.standardise(emb.filter(F.col("label") < HOLDOUT_MIN_LABEL), "embedding")
    test = scaling.apply_scaler(emb.filter(F.col("label") >= HOLDOUT_MIN_LABEL), "embedding", model)
    return finish(scaling.vector_long(test, ["vec_id"], "features"))


def q_silhouette_by_label(spark, sf_dir):
    scaled, _ = _scaled(spark, sf_dir)
    value = clustering.silhouette(scaled, "label", "features")
    return finish(spark.createDataFrame([(value,)], "silhouette double"))


def q_cluster_profile(spark, sf_dir):
    return finish(assess.vector_profile(scaling.assemble(_emb(spark, sf_dir), "embedding", "v"), "label", "v", FEATS))


def q_nearest_centroid(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    cents = clustering.label_centroids(scaling.assemble(emb, "embedding", "v"), "label", "v")
    out = clustering.nearest_centroid(emb, "embedding", cents, "cluster", "distance")
    return finish(out.select("vec_id", F.col("cluster").cast("long").alias("cluster"), "distance"))


def q_most_blended(spark, sf_dir):
    emb = _emb(spark, sf_dir).select("vec_id", "label", F.array_max("embedding").cast("double").alias("max_component"))
    return finish(assess.lowest(emb, ["max_component", "vec_id"], BLENDED_N))


def q_cluster_samples(spark, sf_dir):
    out = assess.first_members(_emb(spark, sf_dir).select("vec_id", "label"), "label", "vec_id", SAMPLE_N)
    return out.withColumn("rank", F.col("rank").cast("long"))


def q_min_group_size(spark, sf_dir):
    return assess.cluster_sizes(_emb(spark, sf_dir), "label")


def q_kmeans_assign(spark, sf_dir):
    scaled, _ = _scaled(spark, sf_dir)
    fit = sweep.sweep_kmeans(scaled, "vec_id", [K], seed=SEED)[""][0]
    return sweep.assign(scaled, [fit]).select("vec_id", "cluster")


def q_gmm_assign(spark, sf_dir):
    with _fit_input(spark, sf_dir) as data:
        _, preds = clustering.fit_gmm(data, K, SEED)
    return finish(preds.select("vec_id", "cluster", "max_prob"))


def _both_models(data):
    km, _ = clustering.fit_kmeans(data, K, SEED, prediction_col="cluster_kmeans")
    gm, _ = clustering.fit_gmm(data, K, SEED, prediction_col="cluster_gmm")
    # One pass over the rows: both fitted models applied in a chain, no join.
    both = gm.transform(km.transform(data)).withColumn("gmm_max_prob", F.array_max(vector_to_array("probability")))
    return km, both


def q_models_side_by_side(spark, sf_dir):
    with _fit_input(spark, sf_dir) as data:
        _, both = _both_models(data)
    return finish(both.select("vec_id", "cluster_kmeans", "cluster_gmm", "gmm_max_prob"))


def q_model_fit_check(spark, sf_dir):
    """What must hold for real fits (M3, M4, J8): rows clustered; rows whose cluster has the nearest
    centre; rows whose mixture component is the most likely one, with probabilities that sum to 1; and
    the total sum of squares as within plus between the fitted clusters."""
    with _fit_input(spark, sf_dir) as data:
        km, both = _both_models(data)
        centres = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(km.clusterCenters())], "id int, centroid array<double>")
        x = both.withColumn("x", vector_to_array("features"))
        # centres a rounding apart are equally near
        near = clustering.nearest_centroid(x, "x", centres, "nearest", "distance")
        own = F.aggregate(F.zip_with("x", "centroid", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v)
        near = near.join(F.broadcast(centres.withColumnRenamed("id", "cluster_kmeans")), "cluster_kmeans")
        p = vector_to_array("probability")
        rows = near.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.abs(own - F.col("distance")) < 1e-6).alias("n_nearest"),
            F.count_if(F.get(p, F.col("cluster_gmm")) == F.array_max(p)).alias("n_likeliest"),
            F.count_if(F.abs(F.aggregate(p, F.lit(0.0), lambda a, v: a + v) - 1.0) < 1e-6).alias("n_proper"),
        )
        ss = clustering.sum_of_squares(both, "cluster_kmeans").select("n", F.round(F.col("within") + F.col("between"), 4).alias("total_ss"))
        return cut_lineage(rows.join(ss, "n"))


def q_k_sweep(spark, sf_dir):
    scaled, _ = _scaled(spark, sf_dir)
    rows = [clustering.score_row(t) for t in sweep.sweep_kmeans(scaled, "vec_id", SWEEP_KS, seed=SEED)[""]]
    return finish(clustering.sweep_table(spark, rows, clustering.choose_k(rows)))


def _scaled_once(spark, sf_dir):
    """The scaled vectors, materialised: embeddings are read for the scaler and for this table."""
    return cut_lineage(_scaled(spark, sf_dir)[0].select("vec_id", "label", "features"))


def q_k_scores(spark, sf_dir):
    """The scoring half of the sweep (M2, M6) on given labellings, vec_id mod k: cost, silhouette, chosen k."""
    by_k = {str(k): F.pmod("vec_id", F.lit(k)) for k in SWEEP_KS}
    scores = labellings.score_labellings(_scaled_once(spark, sf_dir), by_k)
    rows = [{"k": int(r["labelling"]), "training_cost": r["training_cost"], "silhouette": r["silhouette"]} for r in scores.collect()]
    rows.sort(key=lambda r: r["k"])
    return finish(clustering.sweep_table(spark, rows, clustering.choose_k(rows)))


def q_model_compare(spark, sf_dir):
    with _fit_input(spark, sf_dir) as data:
        _, kp = clustering.fit_kmeans(data, K, SEED)
        _, gp = clustering.fit_gmm(data, K, SEED)
        rows = [
            ("kmeans", K, clustering.silhouette(kp, "cluster")),
            ("gmm", K, clustering.silhouette(gp, "cluster")),
        ]
    return finish(spark.createDataFrame(rows, "model string, k int, silhouette double"))


def q_label_compare(spark, sf_dir):
    """The comparison of two labellings by silhouette (M13): label, and vec_id mod K."""
    both = {"label": F.col("label"), "modulo": F.pmod("vec_id", F.lit(K))}
    return finish(labellings.score_labellings(_scaled_once(spark, sf_dir), both).select(F.col("labelling").alias("model"), "silhouette"))


def _transfer(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    train, scaler = scaling.standardise(emb.filter(F.col("label") < HOLDOUT_MIN_LABEL), "embedding")
    return train, scaling.apply_scaler(emb.filter(F.col("label") >= HOLDOUT_MIN_LABEL), "embedding", scaler)


def _holdout_model(spark, sf_dir, gmm: bool = False):
    emb = _emb(spark, sf_dir)
    train, scaler = scaling.standardise(emb.filter(F.col("label") < HOLDOUT_MIN_LABEL), "embedding")
    fit = sweep.sweep_kmeans(train, "vec_id", [K], seed=SEED)[""][0]
    mixture = None
    if gmm:
        with clustering.fitting(train.select("vec_id", "features"), "vec_id", FIT_PARTITIONS) as data:
            mixture, _ = clustering.fit_gmm(data, K, SEED, prediction_col=models.GMM_COL)
    model = models.profile_model(scaler, fit, mixture, settings={"k": K, "seed": SEED})
    return model, scaling.assemble(emb.filter(F.col("label") >= HOLDOUT_MIN_LABEL), "embedding")


def q_holdout_assign(spark, sf_dir):
    """Transfer to held-out rows (M7): scaler and K-Means fitted on labels below 5, applied to the others."""
    model, test = _holdout_model(spark, sf_dir)
    return model.apply(test).select("vec_id", "label", F.col(models.KMEANS_COL).alias("cluster"))


def q_saved_model_assign(spark, sf_dir):
    """The same through a model on storage (M7): fitted, saved to the shared folder, loaded and applied."""
    model, test = _holdout_model(spark, sf_dir)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    models.save_model(model, path)
    loaded = models.load_model(spark, path)
    return loaded.apply(test).select("vec_id", F.col(models.KMEANS_COL).alias("cluster"), F.lit(loaded.settings["k"]).alias("k"))


def q_saved_mixture_assign(spark, sf_dir):
    """A saved model with a mixture: every held-out row gets both clusters; the probability of the likeliest component."""
    model, test = _holdout_model(spark, sf_dir, gmm=True)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    models.save_model(model, path)
    got = models.load_model(spark, path).apply(test)
    return finish(got.select("vec_id", models.KMEANS_COL, models.GMM_COL, models.MAX_PROB_COL))


def q_holdout_nearest(spark, sf_dir):
    """Transfer to held-out rows (M7) with given centres: the scaled means of the train labels."""
    train, test = _transfer(spark, sf_dir)
    x = test.withColumn("x", vector_to_array("features"))
    out = clustering.nearest_centroid(x, "x", clustering.label_centroids(train, "label"))
    return finish(out.select("vec_id", F.col("cluster").cast("long").alias("cluster"), "distance"))


def q_override_guard(spark, sf_dir):
    """The guard on a proposed k (M12) over given memberships: a proposal that splits each label by
    vec_id mod 2 (accepted where both halves reach the floor), and one that splits off a few rows (rejected)."""
    emb = _emb(spark, sf_dir).select("vec_id", "label")
    halves = emb.select(F.concat(F.lit("halves "), "label").alias("family"), F.pmod("vec_id", F.lit(2)).alias("cluster"))
    few = emb.select(F.concat(F.lit("few "), "label").alias("family"), (F.pmod("vec_id", F.lit(97)) == 0).cast("long").alias("cluster"))
    return families.override_guard(halves.unionByName(few), "family", "cluster", GUARD_FLOOR)


def q_written_clusters(spark, sf_dir):
    """An entity table with vectors, written without them and read back."""
    scaled, _ = _scaled(spark, sf_dir)
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    write_parquet(drop_vectors(scaled.withColumn("x0", array_head("embedding", 0).cast("double"))), path)
    return finish(spark.read.parquet(path).select("vec_id", "label", "x0"))


def q_written_families(spark, sf_dir):
    """Written once, a folder per family, and read back."""
    path = f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"
    write_parquet(_emb(spark, sf_dir).select("vec_id", F.concat(F.lit("L"), "label").alias("family")), path, partition_by=("family",))
    return spark.read.parquet(path).select("vec_id", "family")


def q_published_families(spark, sf_dir):
    """S8 behind a manifest: all families are published, one is run again with its even ids alone, one is emptied, and
    the table is read back."""
    path = f"{shared_folder(spark)}/published-{uuid.uuid4().hex}"
    all_ = _emb(spark, sf_dir).select("vec_id", F.concat(F.lit("L"), "label").alias("family"))
    publish(all_, path, "family")
    publish(all_.filter("family = 'L3' and vec_id % 2 = 0"), path, "family", replace=["L3", "L7"])
    return read_published(spark, path)


def q_spot_check_many(spark, sf_dir):
    """P12 with as many substrings as there are labels and numbers: rows whose id, as text, holds one of them."""
    text = _emb(spark, sf_dir).select("vec_id", F.concat(F.lit("v"), F.col("vec_id"), F.lit("-"), F.col("label")).alias("name"))
    return text.filter(contains_any("name", MANY_NAMES)).select("vec_id", "name")


# ------------------------------------------------------------------------- oracle SQL
_LONG = """q as (select vec_id, label, generate_subscripts(embedding, 1) - 1 as pos,
                 unnest(embedding)::double as x from embeddings)"""


def _z_sql(stats_filter: str, out_filter: str) -> str:
    return f"""
with {_LONG},
st as (select pos, avg(x) as mu, stddev_samp(x) as sd from q {stats_filter} group by pos)
select vec_id, pos::bigint as pos,
       round(case when sd = 0 then 0.0 else (x - mu) / sd end, 6) as z
from q join st using (pos) {out_filter}"""


_SILHOUETTE_SQL = f"""
with {_LONG},
st as (select pos, avg(x) as mu, stddev_samp(x) as sd from q group by pos),
z as (select vec_id, label, q.pos, case when sd = 0 then 0 else (x - mu) / sd end as x from q join st using (pos)),
pt as (select vec_id, label, sum(x * x) as xi from z group by vec_id, label),
cl as (select label as kc, count(*) as n, sum(xi) as psi from pt group by label),
cy as (select label as kc, pos, sum(x) as sx from z group by label, pos),
dt as (select vec_id, label, kc, sum(x * sx) as dot from z join cy using (pos) group by vec_id, label, kc),
d as (select dt.vec_id, dt.label, kc,
             case when dt.label = kc then n / (n - 1) else 1 end * (xi + psi / n - 2 * dot / n) as d
      from dt join pt using (vec_id) join cl using (kc)),
ab as (select vec_id, min(d) filter (where label = kc) as a, min(d) filter (where label <> kc) as b
       from d group by vec_id)
select round(avg((b - a) / greatest(a, b)), 6) as silhouette from ab"""

_NEAREST_SQL = f"""
with {_LONG},
ce as (select label as k, pos, avg(x) as cx from q group by label, pos),
d as (select vec_id, k, round(sum((x - cx) * (x - cx)), 9) as d from q join ce using (pos) group by vec_id, k)
select vec_id, k::bigint as cluster, round(d, 6) as distance from (
  select *, row_number() over (partition by vec_id order by d, k) as rn from d) t where rn = 1"""

_Z = f"""{_LONG},
st as (select pos, avg(x) as mu, stddev_samp(x) as sd from q group by pos),
z as (select vec_id, label, q.pos, case when sd = 0 then 0 else (x - mu) / sd end as x from q join st using (pos))"""


def _scores_sql(labels: str) -> str:
    """Cost and silhouette per labelling g of ``labels``: rows (g, vec_id, c)."""
    return f"""
with {_Z},
lab as ({labels}),
zz as (select lab.g, lab.c, z.vec_id, z.pos, z.x from z join lab using (vec_id)),
pt as (select g, vec_id, c, sum(x * x) as xi from zz group by g, vec_id, c),
cl as (select g, c as kc, count(*) as n, sum(xi) as psi from pt group by g, c),
cy as (select g, c as kc, pos, sum(x) as sx from zz group by g, c, pos),
co as (select cl.g, sum(psi - sq / n) as cost from cl join (select g, kc, sum(sx * sx) as sq from cy group by g, kc) using (g, kc) group by cl.g),
dt as (select zz.g, vec_id, zz.c, kc, sum(x * sx) as dot from zz join cy on zz.g = cy.g and zz.pos = cy.pos group by zz.g, vec_id, zz.c, kc),
d as (select dt.g, dt.vec_id, dt.c, dt.kc, case when dt.c = dt.kc then n / (n - 1) else 1 end * (xi + psi / n - 2 * dot / n) as d
      from dt join pt on dt.g = pt.g and dt.vec_id = pt.vec_id join cl on dt.g = cl.g and dt.kc = cl.kc),
ab as (select g, vec_id, min(d) filter (where c = kc) as a, min(d) filter (where c <> kc) as b from d group by g, vec_id),
si as (select g, avg((b - a) / greatest(a, b)) as silhouette from ab group by g)
"""


_SWEEP_LABELS = f"select k as g, vec_id, vec_id % k as c from embeddings, range({SWEEP_KS[0]}, {SWEEP_KS[-1] + 1}) r(k)"
_COMPARE_LABELS = f"select 'label' as g, vec_id, label as c from embeddings union all select 'modulo', vec_id, vec_id % {K} from embeddings"

#: More than any fit on the test tables takes to come to rest; the queries use the operator's own bound.
_STEPS = sweep.MAX_STEPS


def _points_sql(stats_filter: str = "", out_filter: str = "") -> str:
    return f"""{_LONG},
st as (select pos, avg(x) as mu, stddev_samp(x) as sd from q {stats_filter} group by pos),
gr as materialized (select vec_id, label, list({grid_sql("case when sd = 0 then 0 else (x - mu) / sd end")} order by q.pos) as x
       from q join st using (pos) group by vec_id, label),
pts as materialized (select '' as family, cast(vec_id as varchar) as id, x from gr {out_filter})"""


_TRAIN = f"where label < {HOLDOUT_MIN_LABEL}"
_HOLDOUT_SQL = f"""
with {_points_sql(_TRAIN, _TRAIN)},
ks as (select '' as family, {K} as k),
{kmeans_sql(K, _STEPS, SEED)},
d as (select vec_id, label, c, list_inner_product(x, x) - 2 * list_inner_product(x, v) + list_inner_product(v, v) as d
      from gr, centres where label >= {HOLDOUT_MIN_LABEL}),
a as (select vec_id, label, cast(c as integer) as cluster from (select *, row_number() over (partition by vec_id order by d, c) as r from d) t where r = 1)
"""

ORACLE = {
    "published_families": """
select vec_id, 'L' || label as family from embeddings where label not in (3, 7) or (label = 3 and vec_id % 2 = 0)""",
    "spot_check_many": f"""
with t as (select vec_id, 'v' || vec_id || '-' || label as name from embeddings),
n as (select range as i from range({MANY}))
select distinct vec_id, name from t join n on contains(name, case when i % 2 = 0 then cast(7 * i as varchar) || '-' else 'v' || i || '1' end)""",
    "kmeans_assign": f"""
with {_points_sql()},
ks as (select '' as family, {K} as k),
{kmeans_sql(K, _STEPS, SEED)}
select cast(id as bigint) as vec_id, cast(c as integer) as cluster from members""",
    "k_sweep": f"""
with {_points_sql()},
ks as (select '' as family, cast(k as integer) as k from range({SWEEP_KS[0]}, {SWEEP_KS[-1] + 1}) r(k)),
{kmeans_sql(SWEEP_KS[-1], _STEPS, SEED)}
select k, round(training_cost, 6) as training_cost, round(silhouette, 6) as silhouette, k = (select k from {chosen_sql()}) as chosen from fitted""",
    "holdout_assign": _HOLDOUT_SQL + "select * from a",
    "saved_model_assign": _HOLDOUT_SQL + f"select vec_id, cluster, {K} as k from a",
    "k_scores": _scores_sql(_SWEEP_LABELS)
    + """select cast(g as integer) as k, round(cost, 6) as training_cost, round(silhouette, 6) as silhouette,
       g = (select min(g) from si where silhouette = (select max(silhouette) from si)) as chosen
from co join si using (g)""",
    "label_compare": _scores_sql(_COMPARE_LABELS) + "select g as model, round(silhouette, 6) as silhouette from si",
    "model_fit_check": f"""
with {_Z}
select count(distinct vec_id) as n, count(distinct vec_id) as n_nearest, count(distinct vec_id) as n_likeliest,
       count(distinct vec_id) as n_proper, round(sum(x * x), 4) as total_ss from z""",
    "holdout_nearest": f"""
with {_LONG},
st as (select pos, avg(x) as mu, stddev_samp(x) as sd from q where label < {HOLDOUT_MIN_LABEL} group by pos),
z as (select vec_id, label, q.pos, case when sd = 0 then 0 else (x - mu) / sd end as x from q join st using (pos)),
ce as (select label as k, pos, avg(x) as cx from z where label < {HOLDOUT_MIN_LABEL} group by label, pos),
d as (select vec_id, k, round(sum((x - cx) * (x - cx)), 9) as d from z join ce using (pos)
      where label >= {HOLDOUT_MIN_LABEL} group by vec_id, k)
select vec_id, k::bigint as cluster, round(d, 6) as distance from (
  select *, row_number() over (partition by vec_id order by d, k) as rn from d) t where rn = 1""",
    "override_guard": f"""
with m as (select 'halves ' || label as family, vec_id % 2 as cluster from embeddings
           union all select 'few ' || label, cast(vec_id % 97 = 0 as bigint) from embeddings),
s as (select family, cluster, count(*) as n from m group by family, cluster)
select family, min(n) as min_size, min(n) >= {GUARD_FLOOR} as accepted from s group by family""",
    "written_clusters": "select vec_id, label, round(embedding[1]::double, 6) as x0 from embeddings",
    "written_families": "select vec_id, 'L' || label as family from embeddings",
    "vec_head": "select vec_id, round(embedding[1]::double, 6) as x0 from embeddings",
    "max_component": "select vec_id, round(list_max(embedding)::double, 6) as max_component from embeddings",
    "standardise": _z_sql("", ""),
    "holdout_standardise": _z_sql(f"where label < {HOLDOUT_MIN_LABEL}", f"where label >= {HOLDOUT_MIN_LABEL}"),
    "silhouette_by_label": _SILHOUETTE_SQL,
    "cluster_profile": "select label, count(*) as n, "
    + ", ".join(f"round(avg(embedding[{i + 1}]::double), 6) as mean_{f}" for i, f in enumerate(FEATS))
    + " from embeddings group by label",
    "nearest_centroid": _NEAREST_SQL,
    "most_blended": f"""
select vec_id, label, round(list_max(embedding)::double, 6) as max_component from embeddings
order by list_max(embedding)::double, vec_id limit {BLENDED_N}""",
    "cluster_samples": f"""
select label, vec_id, rank from (
  select vec_id, label, row_number() over (partition by label order by vec_id) as rank from embeddings) t
where rank <= {SAMPLE_N}""",
    "min_group_size": """
select label, count(*) as n, min(count(*)) over () as min_size from embeddings group by label""",
}

QUERIES = {
    "vec_head": q_vec_head,
    "max_component": q_max_component,
    "standardise": q_standardise,
    "holdout_standardise": q_holdout_standardise,
    "silhouette_by_label": q_silhouette_by_label,
    "cluster_profile": q_cluster_profile,
    "nearest_centroid": q_nearest_centroid,
    "most_blended": q_most_blended,
    "cluster_samples": q_cluster_samples,
    "min_group_size": q_min_group_size,
    "kmeans_assign": q_kmeans_assign,
    "gmm_assign": q_gmm_assign,
    "models_side_by_side": q_models_side_by_side,
    "k_sweep": q_k_sweep,
    "model_compare": q_model_compare,
    "holdout_assign": q_holdout_assign,
    "saved_model_assign": q_saved_model_assign,
    "saved_mixture_assign": q_saved_mixture_assign,
    "k_scores": q_k_scores,
    "label_compare": q_label_compare,
    "model_fit_check": q_model_fit_check,
    "holdout_nearest": q_holdout_nearest,
    "override_guard": q_override_guard,
    "written_clusters": q_written_clusters,
    "written_families": q_written_families,
    "published_families": q_published_families,
    "spot_check_many": q_spot_check_many,
}

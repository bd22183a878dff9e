"""The registered queries of this subpackage: each applies its operator, with
production parameters, to the whole of its table and returns the columns of its
contract. ``ORACLE`` has the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, divergence, langid, mining, mixing, pii, quality, repeats, secrets, simhash, topk, warc
from .common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return f

    return register


@_query(
    "op1_decontaminate",
    r"""
with doc_words as materialized (
  select doc_id, rowid_ as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select *, row_number() over () as rowid_ from documents)),
item_words as (
  select cast(item_id as varchar) as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null),
windows as (
  select distinct item, array_to_string(w[i:i + 9], ' ') as win, least(len(w), 10) as k
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item_words where len(w) > 0)),
lengths as (select distinct k from windows),
starts as (
  select d.r, l.k, i, array_to_string(d.w[i:i + l.k - 1], ' ') as win
  from (select r, w, unnest(range(1, len(w) + 1)) as i from doc_words) d, lengths l
  where i + l.k - 1 <= len(d.w)),
hits as (select s.r, s.i, s.k, x.item from starts s join windows x on s.win = x.win and s.k = x.k),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + k)) as p from (select distinct r, i, k from hits)) group by r),
items as (select r, count(*) as n, string_agg(item, ',' order by item) as list from (select distinct r, item from hits) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(w.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(t.n, 0) as bigint) as n_items, sha256(coalesce(t.list, '')) as items_sha256,
       coalesce(w.n_hit, 0) > 0 as contaminated
from doc_words d left join words w using (r) left join items t using (r)
""",
)
def _decontaminate(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = decontaminate.hit_words()
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@_query("op2_mix_sources")
def _mix(spark, sf_dir):
    return mixing.Mix(table(spark, sf_dir, "documents")).taken().select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@_query("op4_simhash")
def _simhash(spark, sf_dir):
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@_query("op3_pii_surrogates")
def _pii(spark, sf_dir):
    got = pii.anonymise(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return got.select(F.col("row.doc_id").alias("doc_id"), F.size("entities").cast("long").alias("n_entities"), "entities", "text")


@_query(
    "op5_top_k",
    """
with v as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scores as (
  select q.r, q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from v q join v c on q.r <> c.r and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0),
ranked as (select *, row_number() over (partition by r order by score desc, vec_id nulls last) as rank from scores)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10
""",
)
def _top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@_query("op6_secret_scan")
def _secrets(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    spans, base = F.col("spans"), secrets.base_only(F.col("spans"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[secrets.count_of(spans, k[0]).alias(f"n_{k[0]}") for k in secrets.KINDS],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )


@_query("op7_suffix_dedup")
def _repeats(spark, sf_dir):
    got = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return got.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query("op8_language_id")
def _language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    got = langid.predict(docs.withColumn("held_out", langid.held_out()), model, keep=["doc_id", "held_out"])
    return got.select(F.col("row.doc_id").alias("doc_id"), F.col("row.held_out").alias("held_out"), "lang_pred", "score", "rejected")


@_query(
    "op9_preference_format",
    """
with t as (
  select cast(floor(conv_id / 2) as bigint) as pair_id, conv_id % 2 = 0 as c, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
g as (select *, row_number() over (partition by pair_id, c order by turn nulls last, role, text) - 1 as position from t),
n as (select pair_id, count(*) filter (where c) as n from g group by pair_id),
k as (select pair_id, case when n > 1 then 1 + pair_id % (n - 1) else 0 end as k from n),
p as (
  select pair_id, c, position, role, text from g where c
  union all select pair_id, false, position, role, text from g join k using (pair_id) where c and position < k
  union all select pair_id, false, position, role, text from g join k using (pair_id) where not c and position >= k),
s as (
  select pair_id, min(position) as split from (
    select coalesce(a.pair_id, b.pair_id) as pair_id, coalesce(a.position, b.position) as position
    from (select * from p where c) a full join (select * from p where not c) b on a.pair_id = b.pair_id and a.position = b.position
    where a.role is null or b.role is null or a.role <> b.role or a.text <> b.text)
  group by pair_id),
r as (
  select p.*, coalesce(position < split, true) as in_prompt, '<|im_start|>' || role || chr(10) as head,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as rendered
  from p left join s using (pair_id)),
o as (select *, coalesce(sum(length(rendered)) over (partition by pair_id, c order by position rows between unbounded preceding and 1 preceding), 0) as start from r)
select pair_id, case when in_prompt then 'prompt' when c then 'chosen' else 'rejected' end as part, position, role, rendered,
       cast(start as bigint) as start, cast(start + length(rendered) as bigint) as "end",
       case when not in_prompt and role = 'assistant' then cast(start + length(head) as bigint) end as loss_start,
       case when not in_prompt and role = 'assistant' then cast(start + length(rendered) - 1 as bigint) end as loss_end
from o where c or not in_prompt
""",
)
def _preferences(spark, sf_dir):
    pairs = chat.answered_by_others(table(spark, sf_dir, "conversations"))
    return chat.format_pairs(pairs, F.col("pair_id"), F.col("chosen"))


@_query(
    "op10_warc",
    """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select *, sha1(h) as s, max(page_id) over (partition by h) as last from p)
select page_id, cast(octet_length(encode(h)) as bigint) as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((((
         instr('0123456789abcdef', substr(s, (5 * i) // 4 + 1, 1)) - 1) * 16
         + greatest(instr('0123456789abcdef', substr(s || '0', (5 * i) // 4 + 2, 1)) - 1, 0)) >> (3 - (5 * i) % 4)) & 31) as bigint), 1)), '') as payload_digest,
       case when page_id is distinct from last then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from last then last end as refers_to
from d
""",
)
def _warc(spark, sf_dir):
    index = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query(
    "op11_hard_negatives",
    """
with v as materialized (
  select vec_id, row_number() over () as r, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scores as materialized (
  select a.r, a.vec_id as anchor_id, b.r as other, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
  from v a join v b on a.r <> b.r and len(a.v) = len(b.v)
  where a.vec_id % 100 = 0),
positives as (select * from (select *, row_number() over (partition by r order by score desc, vec_id nulls last) as k from scores where same) where k <= 5),
negatives as (
  select p.anchor_id, p.vec_id as positive_id, row_number() over (partition by p.r, p.other order by n.score desc, n.vec_id nulls last) as rank,
         n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
  from positives p join scores n on p.r = n.r and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from negatives where rank <= 10
""",
)
def _hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("id") % 100 == 0)


@_query("op12_quality")
def _quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(~quality.held_out()))
    got = quality.score(docs, model, ["doc_id"])
    return got.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@_query(
    "op13_source_divergence",
    r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
           from documents),
o as materialized (select r, lang, source, term, count(*) as n from (select r, lang, source, unnest(w) as term from d) group by all),
kept as materialized (select lang, term, cast(sum(n) as hugeint) as n from o group by lang, term having count(*) >= 3),
c as materialized (select lang, source, term, cast(sum(o.n) as hugeint) as n from o join kept using (lang, term) group by all),
g as materialized (select lang, source, cast(coalesce(s.n, 0) + coalesce(v.v, 0) as hugeint) as t
      from (select distinct lang, source from d) left join (select lang, source, sum(n) as n from c group by all) s using (lang, source)
      left join (select lang, count(*) as v from kept group by lang) v using (lang)),
l as (select lang, cast(sum(n) + count(*) as hugeint) as t from kept group by lang),
p as materialized (select g.lang, g.source, k.term, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // g.t as p, coalesce(c.n, 0) as n
      from g join kept k on g.lang = k.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
q as (select k.lang, k.term, 1 + (1000000000 * (k.n + 1)) // l.t as q from kept k join l using (lang)),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source, y.source as item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) as value
             from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // q as value from p join q using (lang, term) where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 200
""",
)
def _divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))

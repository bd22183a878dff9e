"""DuckDB SQL of the keyed K-Means sweep (``operators.sweep``), step by step."""

from __future__ import annotations

from ..operators.sweep import GRID


def grid_sql(z: str) -> str:
    return f"floor({z} * {GRID} + 0.5)"


def _dist(a: str, b: str) -> str:
    return f"(list_inner_product({a}, {a}) - 2 * list_inner_product({a}, {b}) + list_inner_product({b}, {b}))"


def kmeans_sql(k_max: int, steps: int, seed: int) -> str:
    """CTEs that follow ``pts(family, id, x)`` (text id, grid values as double[]) and ``ks(family, k)``: the last ones are
    ``centres(family, k, c, v)``, ``members(family, k, id, x, c, d)`` and ``fitted(family, k, training_cost, silhouette, min_size)``."""
    u = lambda j: f"((cast('0x' || substr(md5('{seed}:{j}:' || id), 1, 13) as bigint) + 0.5) / 4503599627370496.0)"
    out = [
        f"""chosen_0 as materialized (select family, x as v from (
  select *, row_number() over (partition by family order by md5('{seed}:0:' || id), id) as r from pts) t where r = 1)""",
        f"near_0 as materialized (select p.family, p.id, p.x, {_dist('p.x', 'c.v')} as d from pts p join chosen_0 c using (family))",
    ]
    for j in range(1, k_max):
        out.append(
            f"""chosen_{j} as materialized (select family, x as v from (
  select *, row_number() over (partition by family order by -ln({u(j)}) / d, md5('{seed}:0:' || id), id) as r from near_{j - 1} where d > 0) t where r = 1)"""
        )
        out.append(
            f"""near_{j} as materialized (select p.family, p.id, p.x, case when c.v is null then p.d else least(p.d, {_dist('p.x', 'c.v')}) end as d
  from near_{j - 1} p left join chosen_{j} c using (family))"""
        )
    union = " union all ".join(f"select family, {j} as c, v from chosen_{j}" for j in range(k_max))
    out.append(f"starts as materialized ({union})")
    out.append("centres_0 as materialized (select ks.family, ks.k, s.c, s.v from ks join starts s on ks.family = s.family and s.c < ks.k)")
    for i in range(steps + 1):
        out.append(
            f"""members_{i} as materialized (select family, k, id, x, c, d from (
  select *, row_number() over (partition by family, k, id order by d, c) as r from (
    select p.family, p.id, p.x, c.k, c.c, {_dist('p.x', 'c.v')} as d from pts p join centres_{i} c using (family)) e) t where r = 1)"""
        )
        if i < steps:
            out.append(
                f"""centres_{i + 1} as materialized (select c.family, c.k, c.c, coalesce(m.v, c.v) as v from centres_{i} c left join (
  select family, k, c, list(floor((2.0 * s + n) / (2.0 * n)) order by pos) as v from (
    select family, k, c, pos, sum(e) as s, count(*) as n from (
      select family, k, c, unnest(x) as e, unnest(range(len(x))) as pos from members_{i}) f group by family, k, c, pos) g
  group by family, k, c) m using (family, k, c))"""
            )
    out.append(f"centres as (select * from centres_{steps})")
    out.append(f"members as (select * from members_{steps})")
    out.append(
        f"""cl as materialized (select family, k, c, count(*) as n, sum(list_inner_product(x, x)) as q, sum(d) as cost from members group by family, k, c),
cs as materialized (select family, k, c, list(s order by pos) as s from (
  select family, k, c, pos, sum(e) as s from (select family, k, c, unnest(x) as e, unnest(range(len(x))) as pos from members) f group by family, k, c, pos) g group by family, k, c),
dd as materialized (select m.family, m.k, m.id, m.c as own, cl.c, cl.n, (list_inner_product(m.x, m.x) + cl.q / cl.n - 2 * list_inner_product(m.x, cs.s) / cl.n) as d
  from members m join cl on m.family = cl.family and m.k = cl.k join cs on cs.family = cl.family and cs.k = cl.k and cs.c = cl.c),
ab as (select family, k, id, max(case when c = own then n end) as n, max(case when c = own then d end) as a, min(case when c <> own then d end) as b from dd group by family, k, id),
si as (select family, k, avg(case when n > 1 and greatest(a * n / (n - 1), b) > 0 then (b - a * n / (n - 1)) / greatest(a * n / (n - 1), b) else 0 end) as silhouette
  from (select family, k, id, cast(n as double) as n, a, b from ab) t group by family, k),
fitted as materialized (select family, k, sum(cost) / {float(GRID) ** 2} as training_cost,
       case when count(*) > 1 then round(any_value(silhouette), 9) end as silhouette, min(n) as min_size, sum(n) as n
  from cl join si using (family, k) group by family, k)"""
    )
    return ",\n".join(out)


def chosen_sql(fitted: str = "fitted") -> str:
    """(family, k): the largest silhouette, the smaller k on ties; the smallest k where there is none."""
    return f"(select family, k from (select family, k, row_number() over (partition by family order by silhouette desc nulls last, k) as r from {fitted}) t where r = 1)"

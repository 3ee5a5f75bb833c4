"""The queries that SQL can express, as DuckDB runs them over whole tables."""

from __future__ import annotations

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_COMPONENTS = """both_ways as (select a as x, b as y from links union all select b, a from links),
walk(id, here) as (select x, x from both_ways union select id, y from walk join both_ways on x = here),
reached as (select id, min(here) as component_id from walk group by id)"""


def _clusters(k: int, rounds: int) -> str:
    """Assignment and new centroids, round by round."""
    steps = ["""vectors as (select vec_id, row_number() over () as n, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
    from embeddings where len(embedding) = 64 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x::double))))""",
             f"""c0 as (select (row_number() over (order by sha256('1:' || vec_id), v) - 1)::int as c, v as m from vectors
    where vec_id is not null order by c limit {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""d{i} as (select vec_id, n, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from vectors, c{i}),
a{i} as (select vec_id, n, v, c, d from d{i} qualify row_number() over (partition by n order by d, c) = 1)""")
        if i < rounds:
            steps.append(f"""s{i} as (select c, p, sum(x) as s, count(*) as m from (select c, unnest(v) as x, generate_subscripts(v, 1) as p from a{i}) group by c, p),
n{i} as (select c, list(((s - ((s % m) + m) % m) // m)::bigint order by p) as m from s{i} group by c),
c{i + 1} as (select c, coalesce(n{i}.m, c{i}.m) as m from c{i} left join n{i} using (c))""")
    return f"""with {", ".join(steps)}
select vec_id, c as cluster, d as distance, (sum(d) over (partition by c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
       sha256(array_to_string(c{rounds}.m, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (c)"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_suffix_dedup": """
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
parts as (select doc_id, h, unnest(range(0, len(h) // 2 - 99, 500)) as p from texts),
shorter as (select doc_id, p, substr(h, 2 * p + 1, 1198) as s from parts),
starts as (select doc_id, p, s, unnest(range(0, len(s) // 2 - 99)) as j from shorter),
windows as (select doc_id, p + j as i, row_number() over (partition by md5_number(substr(s, 2 * j + 1, 200)) order by doc_id, p + j) as n from starts),
repeated as (select doc_id, i, case when i > lag(i) over (partition by doc_id order by i) + 100 then 1 else 0 end as fresh
             from windows where n > 1),
numbered as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as island from repeated),
islands as (select doc_id, island, min(i) as low, max(i) + 100 as high from numbered group by doc_id, island),
edges as (select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low), 0) as before from islands),
cut as (select doc_id, sum(high - low)::bigint as n_removed, count(*) as n_spans, max(high) as high,
               string_agg(substr(h, 2 * before + 1, 2 * (low - before)), '' order by low) as kept
        from edges join texts using (doc_id) group by doc_id)
select doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(high, 0) + 1))) as kept_sha256
from texts left join cut using (doc_id)""",

        "op4_ngram_join": f"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s from words),
members as (select doc_id, unnest(s) as x from sets),
shared as (select l.doc_id as a, r.doc_id as b, count(*) as n from members l join members r on l.x = r.x and l.doc_id < r.doc_id group by all),
links as (select a, b from shared join sets l on l.doc_id = a join sets r on r.doc_id = b where 100 * n >= 85 * (len(l.s) + len(r.s) - n)),
{_COMPONENTS}
select doc_id, len(s) as n_shingles, coalesce(component_id, doc_id) as component_id from sets left join reached on id = doc_id""",

        "op10_near_vectors": f"""
with recursive vectors as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
lengths as (select vec_id, e, sqrt(list_inner_product(e, e)) as l from vectors),
links as (select p.vec_id as a, q.vec_id as b from lengths p join lengths q on p.vec_id < q.vec_id
          where list_inner_product(p.e, q.e) / (p.l * q.l) >= 0.9),
{_COMPONENTS},
counted as (select x, count(*) as n_links from both_ways group by x)
select vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, vec_id) as component_id,
       coalesce(component_id, vec_id) = vec_id as kept
from embeddings left join counted on x = vec_id left join reached on id = vec_id""",

        "op12_centroids": _clusters(16, 3),
    }

"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

OP4 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, length(hex(encode(coalesce(text, '')))) // 2 as n from documents),
x as (select doc_id, n, o, substr(h, cast(2 * o + 1 as bigint), 910) as part from (select doc_id, h, n, unnest(range(0, greatest(n - 199, 0), 256)) as o from d)),
w as (select doc_id, o + j as s, md5(substr(part, cast(2 * j + 1 as bigint), 400)) as k from (select doc_id, o, part, unnest(range(0, least(256, n - 199 - o))) as j from x)),
r as (select doc_id, s from w where k in (select k from w group by k having count(*) > 1)),
i as (select doc_id, s, case when s - lag(s) over (partition by doc_id order by s) <= 200 then 0 else 1 end as opens from r),
g as (select doc_id, s, sum(opens) over (partition by doc_id order by s) as span from i),
p as (select doc_id, min(s) as a, max(s) + 200 as z from g group by doc_id, span),
q as (select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as before from p),
t as (select doc_id, cast(sum(z - a) as bigint) as n_removed, count(*) as n_spans, string_agg(substr(h, cast(2 * before + 1 as bigint), cast(2 * (a - before) as bigint)), '' order by a) || substr(any_value(h), cast(2 * max(z) + 1 as bigint)) as kept from q join d using (doc_id) group by doc_id)
select d.doc_id, cast(d.n as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, d.h))) as kept_sha256
from d left join t on t.doc_id = d.doc_id
"""

OP5 = """
with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join l on l.a = r.b),
least as (select a, min(b) as component_id from reach group by a)
select v.vec_id, (select count(*) from l where l.a = v.vec_id) as n_links, component_id, v.vec_id = component_id as kept
from v join least on least.a = v.vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_suffix_dedup": OP4, "op5_embedding_dedup": OP5}

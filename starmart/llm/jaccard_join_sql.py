"""The query of ``jaccard_join`` as SQL: all pairs that share a shingle, and what they reach."""

SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as s
    from words
),
sizes as (select doc_id, cast(len(s) as bigint) as n from sets),
held as (select doc_id, unnest(s) as shingle from sets),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n_shared
    from held a join held b on a.shingle = b.shingle and a.doc_id < b.doc_id
    group by 1, 2
),
links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * n_shared >= 90 * (x.n + y.n - n_shared)
),
both_ways as (select a, b from links union select b, a from links),
reached as (
    select doc_id, doc_id as other from sizes
    union
    select r.doc_id, l.b from reached r join both_ways l on l.a = r.other
)
select s.doc_id, s.n as n_shingles, min(r.other) as component_id
from sizes s join reached r using (doc_id)
group by s.doc_id, s.n
"""

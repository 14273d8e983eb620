"""The query of ``turn_repair`` as SQL: a recursive walk that carries the best cost and edits of every state."""

from __future__ import annotations

# CRC-32 bit by bit, as DuckDB has none; 3988292384 is its reversed polynomial.
CRC32 = """xor(list_reduce(list_transform(string_split(k, ''), lambda c: cast(ascii(c) as bigint)),
    lambda acc, c: list_reduce(range(8), lambda a, b: xor(a >> 1, 3988292384 * (a & 1)), xor(acc, c)),
    cast(4294967295 as bigint)), 4294967295)"""

# A best way into each state is {c: cost, e: edits}; least compares the cost, then the edits.
SQL = f"""
with recursive keyed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k
    from conversations
),
coded as (select *, {CRC32} % 20 as code from keyed),
after_damage as (
    select conv_id, turn, case code when 4 then 'user' else role end as role,
           case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from (select *, unnest(case code when 3 then [0, 1] else [0] end) as copy from coded where code <> 0)
),
numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from after_damage
),
marked as (
    select *, case
        when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
        when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
        when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 'truncated' else 'none' end as fault,
        lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
    from numbered
),
counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated,
           count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal, count(*) as n
    from marked group by conv_id
),
step as (
    select conv_id, cast(0 as bigint) as i, struct_pack(c := 0, e := '') as z, struct_pack(c := 1000000, e := '') as s,
           struct_pack(c := 2, e := 'I') as u, struct_pack(c := 4, e := 'II') as a
    from counts
    union all
    select conv_id, i, z, s, u, least(a, struct_pack(c := u.c + 2, e := u.e || 'I')) as a
    from (
        select conv_id, i, z, s, least(u, struct_pack(c := z.c + 2, e := z.e || 'I'), struct_pack(c := s.c + 2, e := s.e || 'I'), struct_pack(c := a.c + 2, e := a.e || 'I')) as u, a
        from (
            select w.conv_id, m.i, struct_pack(c := w.z.c + 3, e := w.z.e || 'D') as z,
                   least(struct_pack(c := w.s.c + 3, e := w.s.e || 'D'), struct_pack(c := case when r = 's' then w.z.c + t else 1000000 end, e := w.z.e || 'K')) as s,
                   least(struct_pack(c := w.u.c + 3, e := w.u.e || 'D'),
                         struct_pack(c := case when r = 'u' then w.z.c + t else 1000000 end, e := w.z.e || 'K'),
                         struct_pack(c := case when r = 'u' then w.s.c + t else 1000000 end, e := w.s.e || 'K'),
                         struct_pack(c := case when r = 'u' then w.a.c + t else 1000000 end, e := w.a.e || 'K'),
                         struct_pack(c := case when r = '-' then 1000000 else w.z.c + t + 2 end, e := w.z.e || 'R'),
                         struct_pack(c := case when r = '-' then 1000000 else w.s.c + t + 2 end, e := w.s.e || 'R'),
                         struct_pack(c := case when r = '-' then 1000000 else w.a.c + t + 2 end, e := w.a.e || 'R')) as u,
                   least(struct_pack(c := w.a.c + 3, e := w.a.e || 'D'),
                         struct_pack(c := case when r = 'a' then w.u.c + t else 1000000 end, e := w.u.e || 'K'),
                         struct_pack(c := case when r = '-' then 1000000 else w.u.c + t + 2 end, e := w.u.e || 'R')) as a
            from step w join (
                select *, case when fault in ('blank', 'duplicate') then '-' else left(role, 1) end as r, case fault when 'truncated' then 1 else 0 end as t from marked
            ) m on m.conv_id is not distinct from w.conv_id and m.i = w.i + 1
        )
    )
),
best as (
    select w.conv_id, least(z, a).c as cost, least(z, a).e as audit
    from step w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.i
),
edits as (
    select conv_id, p, audit[p] as edit, audit from (select *, unnest(range(1, length(audit) + 1)) as p from best)
),
kept as (
    -- the roles of what is kept follow from the place among what is kept and from a system turn in front
    select conv_id, p, edit, length(replace(audit[1:p], 'I', '')) as i, length(replace(audit[1:p], 'D', '')) as place
    from edits where edit <> 'D'
),
first_system as (
    select k.conv_id, true as system
    from kept k join marked m on m.conv_id is not distinct from k.conv_id and m.i = k.i
    where k.place = 1 and k.edit = 'K' and left(m.role, 1) = 's'
),
lines as (
    select k.conv_id, k.p, case k.edit when 'K' then m.role else case when (k.place + coalesce(cast(f.system as int), 0)) % 2 = 1 then 'user' else 'assistant' end end
           || ':' || case k.edit when 'I' then '' else m.text end as line
    from kept k left join marked m on m.conv_id is not distinct from k.conv_id and m.i = k.i and k.edit <> 'I'
    left join first_system f on f.conv_id is not distinct from k.conv_id
),
whole as (select conv_id, sha256(string_agg(line, chr(10) order by p)) as sha from lines group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id
left join whole w on w.conv_id is not distinct from o.conv_id
"""

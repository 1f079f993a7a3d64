"""SQL that gives the rows of corpus queries by comparing everything with everything."""

from __future__ import annotations

import string

_LOW = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _words(separators: str) -> str:
    return f"list_filter(regexp_split_to_array({_LOW}, '{separators}'), lambda x: x <> '')"


_PLAIN = _words(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACED = _words(r"[\x20\x09-\x0D]+")

DECONTAMINATION = f"""
    with d as (select doc_id, {_PLAIN} as w from documents),
    i as (select cast(item_id as varchar) as item, {_PLAIN} as w from benchmark),
    sized as (select item, w, least(13, len(w)) as s from i where len(w) > 0),
    iw as (select distinct item, s, w[k : k + s - 1] as win
           from (select item, w, s, unnest(range(1, len(w) - s + 2)) as k from sized)),
    sizes as (select distinct s from iw),
    dw as (select doc_id, k, s, w[k : k + s - 1] as win
           from (select doc_id, w, s, unnest(range(1, len(w) - s + 2)) as k from d, sizes)),
    m as (select doc_id, k, s, item from dw join iw using (s, win)),
    h as (select doc_id, count(distinct p) as hit
          from (select doc_id, unnest(range(k, k + s)) as p from m) group by doc_id),
    f as (select doc_id, count(distinct item) as n, array_to_string(list_sort(list(distinct item)), ',') as items
          from m group by doc_id)
    select doc_id, len(w) as n_words, coalesce(hit, 0) as n_hit, coalesce(n, 0) as n_items,
           sha256(coalesce(items, '')) as items_sha256,
           coalesce(hit, 0) > 0 and 20 * coalesce(hit, 0) >= len(w) as contaminated
    from d left join h using (doc_id) left join f using (doc_id)"""

NEAR_DUPLICATES = f"""
    with recursive d as (select doc_id, {_SPACED} as w from documents),
    s as (select distinct doc_id, w[k : k + least(5, len(w)) - 1] as sh
          from (select doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as k from d where len(w) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    c as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b using (sh)
          where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
    l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b
          where 100 * shared >= 85 * (x.n + y.n - shared)),
    r(a, b) as (select doc_id, doc_id from d union select r.a, l.b from r join l on r.b = l.a),
    g as (select a as doc_id, min(b) as component_id from r group by a)
    select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
    from g left join n using (doc_id)"""

HARD_NEGATIVES = """
    with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                      list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
               from embeddings
               where label is not null and embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
                 cast(list_inner_product(a.v, b.v) as bigint) as score
          from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
    p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
          qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id,
           cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
           vec_id as negative_id, positive_score, score as negative_score
    from p join s using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    qualify rank <= 3"""

_KEY = "coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')"
_BITS = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, (x & 1) * 3988292384))"
_BYTES = f"list_transform(string_split({_KEY}, ''), lambda x: cast(ascii(x) as bigint))"
_CRC32 = f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {_BYTES}), lambda c, b: {_BITS}), 4294967295)"
# Costs at the four places of the role pattern run from the last row to the first, the edits then from the first on.
CONVERSATIONS = f"""
    with recursive d as (
        select coalesce('=' || conv_id, '') as k, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {_CRC32} % 20 as fault
        from conversations),
    r as (
        select k, turn, case when fault = 4 then 'user' else role end as role,
               case when fault = 1 then '' when fault = 2 then translate(text, '.!?', '') else text end as text
        from (select *, unnest(range(case when fault = 3 then 2 else 1 end)) from d where fault <> 0)),
    o as (select *, row_number() over (partition by k order by turn nulls first, role, md5(text)) as i,
                 rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as e from r),
    f as (
        select k, turn, role, text, i, substr(role, 1, 1) as z,
               case when e = '' then 1 when row_number() over (partition by k, role, text order by i) > 1 then 2
                    when right(e, 1) not in ('.', '!', '?') then 3 else 0 end as fault
        from o),
    n as (select k, max(i) as n from f group by k),
    b(k, i, c) as (
        select k, n + 1, [0, 6, 3, 0] from n
        union all
        select k, i, [least(b0, 3 + least(b2, 3 + b3)), least(b1, 3 + least(b2, 3 + b3)), least(b2, 3 + b3), least(b3, 3 + b2)]
        from (select k, i, least(4 + c[1], case when gone then 999999999 when z = 's' then w + c[2] when z = 'u' then w + c[3]
                                            else 3 + w + c[3] end) as b0,
                     least(4 + c[2], case when gone then 999999999 when z = 'u' then w + c[3] else 3 + w + c[3] end) as b1,
                     least(4 + c[3], case when gone then 999999999 when z = 'a' then w + c[4] else 3 + w + c[4] end) as b2,
                     least(4 + c[4], case when gone then 999999999 when z = 'u' then w + c[3] else 3 + w + c[3] end) as b3
              from (select f.k, f.i, z, fault in (1, 2) as gone, case when fault = 3 then 3 else 0 end as w, c
                    from b join f on f.k = b.k and f.i = b.i - 1))),
    s(k, i, p, audit, lines) as (
        select k, cast(1 as bigint), 0, '', cast([] as varchar[]) from n
        union all
        select k, case when op = 'I' then i else i + 1 end,
               case when op = 'D' then p when op = 'K' and z = 's' then 1 else q end,
               audit || op,
               case op when 'D' then lines when 'K' then list_append(lines, role || ':' || text)
                       when 'R' then list_append(lines, case q when 2 then 'user' else 'assistant' end || ':' || text)
                       else list_append(lines, case q when 2 then 'user:' else 'assistant:' end) end
        from (select s.k, s.i, p, q, audit, lines, role, text, z,
                     case when f.i is null then case when p in (1, 2) then 'I' end
                          when here.c[p + 1] = 4 + after.c[p + 1] then 'D'
                          when here.c[p + 1] = 3 + here.c[q + 1] then 'I'
                          when z = 's' and p = 0 and here.c[1] = case when fault = 3 then 3 else 0 end + after.c[2] then 'K'
                          when z = case q when 2 then 'u' else 'a' end then 'K' else 'R' end as op
              from (select *, case p when 2 then 3 else 2 end as q from s) s
              join b here on here.k = s.k and here.i = s.i
              left join b after on after.k = s.k and after.i = s.i + 1
              left join f on f.k = s.k and f.i = s.i)
        where op is not null),
    e as (select s.k, audit, sha256(array_to_string(lines, chr(10))) as sha
          from s join n on n.k = s.k and s.i = n.n + 1 and p in (0, 3)),
    l as (select *, lag(z) over (partition by k order by i) || z as two from f),
    g as (select k, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(fault = 1) as blank,
                 count_if(fault = 2) as duplicate, count_if(fault = 3) as truncated,
                 count_if(two not in ('su', 'ua', 'au')) as illegal
          from l group by k)
    select conv_id, coalesce(gaps, 0) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
           cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
           cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(c[1], 0) as bigint) as cost,
           coalesce(audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
    from (select distinct conv_id, coalesce('=' || conv_id, '') as k from conversations) v
    left join g using (k) left join e using (k) left join (select k, c from b where i = 1) using (k)"""

"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

#: The same windows one after the other, over whole conversations.
OP2 = r"""
with recursive t0 as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t1 as (
  select *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') as escaped,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') as escaped_role
  from t0),
t2 as (select *, '### ' || escaped_role || ': ' || escaped || ' </turn>' || chr(10) as body from t1),
t3 as (
  select *, length(body) as chars, 1 + len(regexp_extract_all(body, '[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]')) as tokens,
    row_number() over (partition by conv_id order by turn nulls first, role, escaped) as place
  from t2),
t4 as (
  select *, sum(tokens) over (partition by conv_id order by place) - tokens as start,
    max(case when place = 1 and role = 'system' then tokens else 0 end) over (partition by conv_id) as s_tokens,
    max(case when place = 1 and role = 'system' then chars else 0 end) over (partition by conv_id) as s_chars,
    count(*) over (partition by conv_id) as n_conv
  from t3),
t5 as (
  select *, greatest(1, 1024 - 128 - s_tokens) as room from t4 where not (place = 1 and role = 'system' and n_conv > 1)),
nx as materialized (
  select i.conv_id, i.place, min(j.place) as next
  from t5 i join t5 j on i.conv_id is not distinct from j.conv_id and j.place > i.place
    and j.start + j.tokens > i.start + i.room
  group by i.conv_id, i.place),
begins(conv_id, place) as (
  select conv_id, min(place) from t5 group by conv_id
  union all
  select nx.conv_id, nx.next from begins b join nx on nx.conv_id is not distinct from b.conv_id and nx.place = b.place),
t6 as (
  select t5.*, (select max(b.place) from begins b where b.conv_id is not distinct from t5.conv_id and b.place <= t5.place) as w
  from t5),
t7 as (select *, max(start + tokens) over (partition by conv_id, w) as w_end from t6),
w as (
  select conv_id, w, max(s_chars) as s_chars,
    sum(case when place = 1 and role = 'system' then 0 else chars end) as own,
    sum(case when place = 1 and role = 'system' then 0 when w_end - start <= 128 then chars else 0 end) as tail
  from t7 group by conv_id, w),
f as (
  select conv_id, sum(own + s_chars + before) as formatted_chars
  from (select *, coalesce(lag(tail) over (partition by conv_id order by w), 0) as before from w) group by conv_id)
select t.conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
  max(f.formatted_chars)::bigint as formatted_chars
from t3 t join f on f.conv_id is not distinct from t.conv_id group by t.conv_id
"""

OP6 = r"""
with rules(host, path, verdict) as (values
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut as (
  select row_number() over () as row, page_id,
    case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
hosts as (select *, regexp_extract(rest, '^[^/?#]*') as raw_host from cut),
parts as (
  select row, page_id,
    translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path
  from hosts),
best as (
  select p.row, r.host || r.path as rule, r.verdict,
    row_number() over (partition by p.row order by length(r.host || r.path) desc, r.verdict desc, r.host || r.path) as n
  from parts p join rules r
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') as verdict
from parts p left join best b on p.row = b.row and b.n = 1
"""

#: A text's distinct runs of five words, A-Z lower-cased; of fewer words, all of them.
_RUNS = r"""
  select id, unnest(list_distinct(case
      when len(words) >= 5 then list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' '))
      when len(words) > 0 then [array_to_string(words, ' ')] else [] end)) as run
  from (select id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
      lambda word: word != '') as words from {table})
"""

_WORDS = r"""
  select id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
      lambda word: word != '') as words from {table}
"""

#: Items of five words and more by their runs of five, shorter ones by all their words in a row.
OP9 = f"""
with d0 as (select doc_id as id, text from documents), i0 as (select item_id as id, text from benchmark),
dw as materialized ({_WORDS.format(table="d0")}), iw as materialized ({_WORDS.format(table="i0")}),
d as (select id, unnest(list_distinct(list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')))) as run
  from dw where len(words) >= 5),
i as (select id, unnest(list_distinct(list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')))) as run
  from iw where len(words) >= 5),
n as (select id, count(*) as n from i group by id),
short as (select id, len(words) as m, array_to_string(words, ' ') as run from iw where len(words) between 1 and 4),
ds as (
  select id, m, unnest(list_distinct(list_transform(range(1, len(words) - m + 2), lambda k: array_to_string(words[k:k + m - 1], ' ')))) as run
  from dw, (select distinct m from short) where len(words) >= m)
select d.id as doc_id, n.id as item_id, count(*) / max(n.n) as containment
from i join d using (run) join n on n.id = i.id
group by d.id, n.id having count(*) >= 0.8 * max(n.n)
union all
select ds.id, short.id, 1.0::double from short join ds using (m, run)
"""

OP5 = f"""
with recursive d0 as (select doc_id as id, text from documents), r as materialized ({_RUNS.format(table="d0")}),
n as (select id, count(*) as n from r group by id),
links as materialized (
  select a.id as a, b.id as b
  from r a join r b on a.run = b.run and a.id != b.id join n na on na.id = a.id join n nb on nb.id = b.id
  group by a.id, b.id having count(*) >= 0.8 * (max(na.n) + max(nb.n) - count(*))),
reach(id, other) as (
  select doc_id, doc_id from documents union select reach.id, links.b from reach join links on links.a = reach.other),
same as (
  select l.a, l.b from links l join n na on na.id = l.a join n nb on nb.id = l.b
  where na.n = nb.n and (select count(*) from r x join r y on x.run = y.run where x.id = l.a and y.id = l.b) = na.n)
select d.doc_id, c.class_id, least(d.doc_id, coalesce(s.low, d.doc_id)) as set_id, coalesce(k.n, 0) as n_links
from documents d
join (select id, min(other) as class_id from reach group by id) c on c.id = d.doc_id
left join (select a, min(b) as low from same group by a) s on s.a = d.doc_id
left join (select a, count(*) as n from links group by a) k on k.a = d.doc_id
"""

_CAPITALS = "".join(map(chr, [*range(0x41, 0x5B), *(c for c in range(0xC0, 0xDF) if c != 0xD7)]))

#: Every pair of a query and a document that share a term; rounded, as sums depend on their order.
OP7 = f"""
with terms as materialized (
  select doc_id, term, count(*) as tf
  from (select doc_id, unnest(regexp_extract_all(
      translate(text, '{_CAPITALS}', '{"".join(chr(ord(c) + 32) for c in _CAPITALS)}'),
      '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) as term from documents)
  group by doc_id, term),
sizes as (select d.doc_id, coalesce(sum(tf), 0) as size from documents d left join terms using (doc_id) group by d.doc_id),
stats as (select count(*) as n, greatest(1, sum(size) / count(*)) as average from sizes),
idf as (select term, ln(1 + (max(n) - count(*) + 0.5) / (count(*) + 0.5)) as idf from terms, stats group by term),
scores as (
  select q.doc_id as query_id, d.doc_id,
    sum(q.tf * idf * d.tf * 2.2::double / (d.tf + 1.2::double * (0.25 + 0.75::double * size / average))) as score
  from terms q join idf using (term) join terms d using (term) join sizes s on s.doc_id = d.doc_id, stats
  where q.doc_id % 20 = 0 group by q.doc_id, d.doc_id)
select query_id, doc_id, round(score, 4) as score,
  (row_number() over (partition by query_id order by round(score, 4) desc, doc_id))::int as rank
from scores qualify rank <= 10
"""

OP11 = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select doc_id, unnest(range(1, len(lines) + 1)) as n, unnest(lines) as line from d),
k as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
r as (select key, min(doc_id) as first from k where length(key) >= 10 group by key having count(distinct doc_id) >= 2),
m as (select k.doc_id, k.n, k.line, r.key is not null and k.doc_id != r.first as gone from k left join r using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""

#: All pairs of an anchor and a row, each product a sum over components.
OP12 = r"""
with v as materialized (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as vector
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as materialized (
  select a.id as a, b.id as b, a.label = b.label as same,
    list_sum(list_transform(list_zip(a.vector, b.vector), lambda z: coalesce(z[1] * z[2], 0)))::bigint as score
  from v a join v b on a.id != b.id where a.id % 50 = 0),
p as (
  select a, b, score, row_number() over (partition by a order by score desc, b) as slot
  from s where same qualify slot <= 5)
select p.a as anchor_id, p.b as positive_id,
  (row_number() over (partition by p.a, p.slot order by n.score desc, n.b))::int as rank,
  n.b as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.a = p.a and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3
"""

ORACLES = {
    "op2_chat": OP2,
    "op5_jaccard": OP5,
    "op6_urls": OP6,
    "op7_topk": OP7,
    "op9_contamination": OP9,
    "op11_lines": OP11,
    "op12_hard_negatives": OP12,
}

"""SQL over the same tables that gives the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

_SQL: dict[str, str] = {}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_SQL["op4_exact_topk"] = """
with c as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from c as q join c on q.vec_id <> c.vec_id
  where q.vec_id % 100 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

# The shortest prefix that fits; longer ones are needed only for rows with equal ids.
_SQL["op5_extendible_shards"] = """
with d as (
  select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 6))::bigint as h
  from documents),
levels as (select d.*, level::int as depth, h >> (24 - level::int) as bucket from d, range(0, 25) r(level)),
sums as (
  select *, (sum(n_bytes) over w)::bigint as shard_bytes, (count(*) over w)::bigint as shard_rows
  from levels window w as (partition by depth, bucket)),
fits as (
  select *, row_number() over (partition by doc_id order by depth) as k
  from sums where shard_bytes <= 1048576 or shard_rows = 1)
select doc_id, n_bytes, case when depth = 0 then '' else lpad(bin(bucket), depth, '0') end as shard, depth,
  shard_bytes, shard_rows, shard_bytes > 1048576 as oversize
from fits where k = 1
"""

_SQL["op6_exact_dedup"] = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
g as (select *, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from d)
select doc_id, keep_id, group_size::bigint as group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from g
"""

_SQL["op7_mix_sources"] = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5('17:' || coalesce(doc_id::varchar, '')) as o
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from s),
c as (
  select *, sum(source_size) over () as total, sum(weight) over () as weights, count(*) over p as before,
    coalesce(sum(3 * source_size) over p, 0) as clamped, coalesce(sum(weight) over p, 0) as closed
  from w window p as (order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
l as (select (total - clamped)::double / (weights - closed) as level from c
  where (total - clamped)::double / (weights - closed) * weight <= 3 * source_size order by before limit 1),
f as (
  select c.*, least(3.0::double * source_size, coalesce((select level from l), 0.0) * weight)::double as target from c),
e as (
  select d.*, f.source_size, f.target, case when source_size > 0 then floor(target)::bigint // source_size else 0 end as whole,
    floor(target)::bigint - case when source_size > 0 then floor(target)::bigint // source_size else 0 end * source_size as missing,
    coalesce(sum(size) over (partition by d.source order by o, size rows between unbounded preceding and 1 preceding), 0) as until
  from d join f on d.source is not distinct from f.source)
select doc_id, size, source_size::bigint as source_size, target,
  (whole * size + greatest(0, least(size, missing - until)))::bigint as taken
from e
"""

_SQL["op8_minhash_near_dedup"] = r"""
with recursive t as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as materialized (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as shingle
  from t, lateral (select unnest(range(1, greatest(1, len(w) - 3) + 1)) as i) where len(w) > 0),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
inter as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from s as a join s as b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by all),
links as materialized (
  select a, b from inter join n as x on x.doc_id = a join n as y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
reach(node, least) as (
  select doc_id, doc_id from documents
  union
  select case when l.a = r.node then l.b else l.a end, r.least from reach r join links l on r.node in (l.a, l.b)),
c as (select node, min(least) as component_id from reach group by node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join c on c.node = d.doc_id left join n on n.doc_id = d.doc_id
"""

_SQL["op2_tool_call_linking"] = """
with recursive t as (select *, coalesce(text, '') as x, length(coalesce(text, '')) as size from conversations),
c as (
  select conv_id, 'call-' || conv_id || '-' || turn as call_id, turn,
    case when role <> 'assistant' then 'configure' else (['search', 'compute', 'write'])[turn % 3 + 1] end as name,
    to_json(x)::varchar as body, size,
    case when role = 'assistant' and turn >= 2
      then list_sort(list_distinct(['call-' || conv_id || '-' || (turn // 2), 'call-' || conv_id || '-' || (turn // 3)]))
      else [] end as needs
  from t where role <> 'user'),
r as (select conv_id, 'call-' || conv_id || '-' || (turn - 1) as call_id, turn as result_turn, to_json(x)::varchar as content
  from t where role = 'user'),
args as (
  select *, case name
      when 'configure' then '{"text":' || body || '}'
      when 'search' then '{"limit":' || size || ',"query":' || body || '}'
      when 'compute' then '{"expression":' || body || ',"precision":' || case when size % 2 = 0 then size::varchar else '"high"' end || '}'
      else '{"body":' || body || case when size % 3 = 0 then '' else ',"path":"notes/"' end || '}' end as arguments,
    case when name = 'configure' then 'tool' when name = 'compute' and size % 2 = 1 then 'type:precision'
      when name = 'write' and size % 3 = 0 then 'missing:path' else '' end as errors
  from c),
edges as (
  select n.conv_id, n.call_id, n.need, k.call_id is not null as known
  from (select conv_id, call_id, unnest(needs) as need from c) n left join c k on k.conv_id = n.conv_id and k.call_id = n.need),
depth(conv_id, call_id, layer) as (
  select conv_id, call_id, 0 from c
  union
  select e.conv_id, e.call_id, d.layer + 1 from depth d join edges e on e.conv_id = d.conv_id and e.need = d.call_id),
layers as (select conv_id, call_id, max(layer)::int as layer from depth group by all),
missing as (select conv_id, call_id, count(*) filter (not known) as n_missing from edges group by all),
j as (
  select coalesce(a.conv_id, r.conv_id) as conv_id, coalesce(a.call_id, r.call_id) as call_id, l.layer, a.turn, r.result_turn,
    case when a.call_id is null then 'orphan' when r.call_id is null then 'unanswered' else 'linked' end as status,
    ((a.call_id is not null)::int + (r.call_id is not null)::int)::bigint as copies,
    case when a.call_id is not null then coalesce(m.n_missing, 0) end as n_missing, a.errors = '' as valid, a.errors,
    '{"arguments":' || coalesce(a.arguments, 'null') || ',"id":"' || coalesce(a.call_id, r.call_id) || '","name":'
      || coalesce('"' || a.name || '"', 'null') || ',"needs":'
      || case when a.call_id is null then 'null' else '[' || array_to_string(list_transform(a.needs, lambda n: '"' || n || '"'), ',') || ']' end
      || ',"result":' || coalesce(r.content, 'null') || '}' as json
  from args a full join r on a.conv_id = r.conv_id and a.call_id = r.call_id
  left join layers l on l.conv_id = a.conv_id and l.call_id = a.call_id
  left join missing m on m.conv_id = a.conv_id and m.call_id = a.call_id)
select conv_id, call_id, (row_number() over (partition by conv_id order by status = 'orphan', coalesce(layer, 2147483647),
    coalesce(turn, result_turn), call_id) - 1)::bigint as position, layer, turn, result_turn, status, copies, n_missing, valid, errors, json
from j
"""


def _rounds_sql(n: int) -> str:
    """CTEs a1, c1, a2, … of ``n`` rounds: assignments and the entries after them."""
    steps = []
    for i in range(n + 1):
        steps.append(f"""
a{i} as materialized (
  select vec_id, row, label, part, x, arg_min(entry, (apart, entry)) as entry, min(apart) as apart
  from (
    select p.*, c.entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as apart
    from p join c{i} c on c.part = p.part)
  group by all)""")
        if i < n:
            steps.append(f"""
s{i} as (
  select part, entry, pos, sum(x[pos])::bigint as s, count(*) as n
  from a{i}, (select unnest(range(1, (select max(len(x)) from p) + 1)) as pos) group by all),
c{i + 1} as materialized (
  select c.part, c.entry, coalesce(m.x, c.x) as x
  from c{i} c left join (
    select part, entry, list((s - ((s % n) + n) % n) // n order by pos) as x from s{i} group by all) m
  on m.part = c.part and m.entry = c.entry)""")
    return ",".join(steps)


_SQL["op13_vector_codes"] = f"""
with v as (
  select vec_id, label, row_number() over () as row, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (
  select vec_id, row, label, part::int as part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] as x from v, range(8) r(part)),
c0 as materialized (
  select part, entry, x
  from (select part, x, row_number() over (partition by part order by vec_id) - 1 as entry from p) where entry < 16),
{_rounds_sql(6).strip()},
book as (select sha256(string_agg(y::varchar, ',' order by part, entry, pos)) as codebooks_sha256
  from (select part, entry, unnest(x) as y, unnest(range(len(x))) as pos from c6)),
found as (
  select vec_id, row, any_value(label) as label, string_agg(printf('%02x', entry), '' order by part) as code, sum(apart)::bigint as error
  from a6 group by vec_id, row)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from found, book
"""


_SQL["op12_phrase_mining"] = r"""
with d as (
  select row_number() over () as doc, coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
sizes as (select lang, sum(len(w))::bigint as n from w group by lang),
grams as (
  select lang, words, unnest(list_transform(range(1, len(w) - words + 2), lambda i: array_to_string(w[i:i + words - 1], ' '))) as phrase
  from w, (select unnest([1, 2, 3]) as words) k),
f as materialized (select lang, words, phrase, count(*) as a from grams group by all having count(*) >= 10),
c as (select *, string_split(phrase, ' ') as w from f where words > 1),
cuts as (
  select c.lang, c.phrase, c.a, k, l.a as l, r.a as r, (1000000::hugeint * c.a * c.a // (l.a::hugeint * r.a))::bigint as score
  from (select *, unnest(range(1, words)) as k from c) c
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:k], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1:], ' ')),
worst as (select *, row_number() over (partition by lang, phrase order by score, k) as nth from cuts),
longer as (
  select lang, phrase, max(a) as a from (
    select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from c where words = 3)
  group by all),
ranked as (
  select w.*, row_number() over (partition by w.lang order by w.score desc, w.a desc, w.phrase) as rank
  from worst w left join longer g on g.lang = w.lang and g.phrase = w.phrase
  where w.nth = 1 and (g.a is null or 100 * g.a < 50 * w.a))
select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang) where rank <= 2000
"""

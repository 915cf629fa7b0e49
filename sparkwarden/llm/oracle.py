"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {}

SQL["op2_decontaminate"] = rf"""
with items as (
  select distinct coalesce(cast(item_id as varchar), 'null') as item, {_WORDS} as w from benchmark
), grams as (
  select item, 10 as size, array_to_string(w[i:i + 9], ' ') as gram
  from (select item, w, unnest(range(1, len(w) - 8)) as i from items where len(w) >= 10)
  union
  select item, len(w), array_to_string(w, ' ') from items where len(w) between 1 and 9
), docs as (select doc_id, {_WORDS} as w from documents),
lengths as (select distinct size from grams),
places as (
  select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as gram
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from docs cross join lengths where len(w) >= size)
), hits as (select doc_id, item, i, p.size from places p join grams g on p.gram = g.gram and p.size = g.size),
words as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + size)) as place from hits) group by 1),
ids as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item from hits) group by 1
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join words using (doc_id) left join ids using (doc_id)
"""

_REST = "case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_HREF = r"""regexp_extract({0}, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', {1})"""


def _href(tag: str) -> str:
    return "(" + " || ".join(_HREF.format(tag, i) for i in (1, 2, 3)) + ")"


def _decoded(text: str) -> str:
    """Character references of an attribute."""
    code = (
        "coalesce(try_cast('0x' || nullif(regexp_extract(p, '^#[xX]0*([0-9a-fA-F]{1,6});?', 1), '') as integer), "
        "try_cast(regexp_extract(p, '^#0*([0-9]{1,7});?', 1) as integer))"
    )
    one = (
        f"case when i = 1 then p when {code} between 1 and 1114111 and {code} not between 55296 and 57343 "
        f"then chr({code}) || regexp_replace(p, '^(?:#[xX][0-9a-fA-F]+|#[0-9]+);?', '') "
        + " ".join(
            f"when starts_with(p, '{name};') then chr({ord(c)}) || substr(p, {len(name) + 2})"
            for name, c in (("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"))
        )
        + " else '&' || p end"
    )
    return f"array_to_string(list_transform(string_split({text}, '&'), lambda p, i: {one}), '')"


def _without_dots(path: str) -> str:
    """RFC 3986, 5.2.4."""
    steps = f"string_split({path} || case when regexp_matches({path}, '/\\.\\.?$') then '/' else '' end, '/')[2:]"
    return (
        f"case when not regexp_matches({path}, '/\\.\\.?(?:/|$)') then {path} else '/' || array_to_string(list_reduce(list_concat("
        f"[[]::varchar[]], list_transform({steps}, lambda x: [x])), lambda held, x: case when x[1] = '..' then held[1:len(held) - 1] "
        f"when x[1] = '.' then held else list_concat(held, x) end), '/') end"
    )


def _resolved(base: str, target: str, keep: str, source: str) -> str:
    """``keep`` of ``source``, and ``full``: what ``target`` names on the page ``base``; RFC 3986, 5.2.2."""
    return rf"""
  select {keep}, case
    when whole != '' then regexp_extract(whole, '^[^/?]*') || {_without_dots("regexp_extract(whole, '^[^/?]*([^?]*)', 1)")} || regexp_extract(whole, '(?s)\?.*')
    when regexp_matches(t, '^[a-zA-Z][a-zA-Z0-9+.-]*:') then null when t = '' then b when path = '' then host || old || query
    when starts_with(path, '/') then host || {_without_dots('path')} || query
    else host || {_without_dots("(regexp_replace(old, '/[^/]*$', '') || '/' || path)")} || query end as "full"
  from (
    select *, regexp_extract(t, '(?s)(?:^[a-zA-Z][a-zA-Z0-9+.-]*:|^)//(.*)', 1) as whole, regexp_extract(t, '^[^?]*') as path,
           regexp_extract(t, '(?s)\?.*') as query, regexp_extract(b, '^[^/?]*') as host, regexp_extract(b, '^[^/?]*([^?]*)', 1) as old
    from (select *, regexp_extract({base}, '(?s)^[^#]*') as b,
                 regexp_extract(regexp_replace({target}, '[\t\n\r]|^ +| +$', '', 'g'), '(?s)^[^#]*') as t from {source}))"""


SQL["op4_url_filter"] = rf"""
with recursive rules(verdict, host, path) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), parts as (
  select page_id, html, {_REST} as rest from pages
), rows as (
  select page_id, html, rest, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
         translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) || regexp_replace(regexp_extract(rest, '^[^#]*'), '^[^/?#]*', '') as place
  from parts
), markup as (
  select place, rest, regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)|<textarea\b.*?(?:</textarea|\z)|<title\b.*?(?:</title|\z)', ' ', 'g') as html
  from rows where place != '' and regexp_matches(html, '(?i)canonical|refresh')
), named as (
  select place, rest, {_decoded(_href("regexp_extract(html, '(?is)<base" + chr(92) + "b[^>]*" + chr(92) + "bhref" + chr(92) + "b[^>]*>')"))} as base_href, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?\s*canonical\b')),
                   lambda t: {_href("t")}),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
                   lambda t: regexp_extract(t, '(?is)\burl\s*=\s*[''"]?([^''">\s]+)', 1)))) as target
  from markup
), based as ({_resolved("rest", "base_href", "place, rest, target", "named")}
), links as (select place, coalesce("full", rest) as base, {_decoded("target")} as target from based where target != ''
), targets as (select place as a, "full" as rest from ({_resolved("base", "target", "place", "links")}) where "full" is not null
), edges as (
  select a, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) || regexp_replace(regexp_extract(rest, '^[^#]*'), '^[^/?#]*', '') as b from targets
), pairs as (select a, b from edges union select b, a from edges),
reach(a, b) as (select a, a from pairs union select r.a, e.b from reach r join pairs e on r.b = e.a),
judged as (
  select n.place, arg_max(r.verdict, length(r.host || r.path)) as own, arg_max(r.host || r.path, length(r.host || r.path)) as rule
  from (select distinct place from rows union select a from pairs) n join rules r
    on (regexp_extract(n.place, '^[^/?#]*') = r.host or ends_with(regexp_extract(n.place, '^[^/?#]*'), '.' || r.host))
   and starts_with(regexp_extract(n.place, '^[^/?#]*([^?#]*)', 1), r.path)
  group by 1
), blocked as (select distinct a as place from reach join judged j on j.place = reach.b and j.own = 'block')
select page_id, host, path, rule,
       coalesce(j.own, case when b.place is not null then 'block' end, 'allow') as verdict
from rows left join judged j using (place) left join blocked b using (place)
"""

SQL["op10_chat_format"] = r"""
with turns as (
  select conv_id, turn, case when coalesce(role, '') = '' then 'unknown' else role end as speaker, coalesce(text, '') as said
  from conversations
), views as (select distinct conv_id, speaker as perspective from turns where speaker != 'system'),
views_of as (
  select t.*, perspective, speaker = perspective as own,
         case when speaker = perspective then 'assistant' when speaker = 'system' then 'system' else 'user' end as role,
         regexp_replace(speaker, '[\s<>|]+', '_', 'g') as label
  from turns t join views v on t.conv_id is not distinct from v.conv_id
), rendered as (
  select *, '<|im_start|>' || role || case when role = 'user' then ' name=' || label else '' end || chr(10) as head,
         replace(said, '<|', '< |') || '<|im_end|>' || chr(10) as body
  from views_of
), placed as (
  select *, row_number() over w as n, sum(length(head || body)) over (w rows unbounded preceding) as up_to
  from rendered window w as (partition by conv_id, perspective order by turn nulls first, speaker, said)
)
select conv_id, perspective, (n - 1)::bigint as seq, turn, role, case when role = 'user' then label end as name, head || body as piece,
       (up_to - length(head || body))::bigint as start, up_to::bigint as "end",
       case when own then (up_to - length(body))::bigint end as mask_start, case when own then (up_to - 1)::bigint end as mask_end
from placed
"""

SQL["op11_target_sampling"] = rf"""
with recursive bits(i, n, x) as (
  select i, 0, i::ubigint from range(256) r(i)
  union all select i, n + 1, case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end from bits where n < 8
), crc as (select list(x order by i) as t from bits where n = 8),
docs as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
items as (select {_WORDS} as w from benchmark),
named as (
  select r, unnest(w) as f from docs
  union all select r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from docs
), wanted as (
  select unnest(w) as f from items
  union all select unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from items
), buckets as (
  select f, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(0, len(h) // 2),
           lambda i: (instr('0123456789ABCDEF', substr(h, (2 * i + 1)::int, 1)) * 16 + instr('0123456789ABCDEF', substr(h, (2 * i + 2)::int, 1)) - 17)::ubigint)),
           lambda a, x: xor(a >> 8, t[(xor(a, x) & 255)::bigint + 1])), 4294967295::ubigint) % 10000 as b
  from (select f, hex(encode(f)) as h from (select f from named union select f from wanted)), crc
), s as (select b, count(*) as n from named join buckets using (f) group by 1),
t as (select b, count(*) as n from wanted join buckets using (f) group by 1),
gain as (
  select b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (coalesce((select sum(n) from s), 0) + 10000)::double
                            / ((coalesce(s.n, 0) + 1)::double * (coalesce((select sum(n) from t), 0) + 10000)::double))) as g
  from (select distinct b from buckets) left join s using (b) left join t using (b)
), weights as (
  select r, count(*) as n_features, floor(sum(g) / count(*))::bigint as weight
  from named join buckets using (f) join gain using (b) group by 1
), scores as (
  select r, doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double))))::bigint as score
  from docs left join weights using (r)
), places as (select r, row_number() over (order by score desc, doc_id) as place from scores where n_words >= 20)
select doc_id, n_features, weight, score,
       case when place <= 25 * (select count(*) from places) // 100 then place end::bigint as rank
from scores left join places using (r)
"""


def _centroids() -> str:
    """The rounds of ``op12_centroid_search``, one after the other."""
    far = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    rounds = ""
    for i in range(4):
        rounds += f""",
a{i} as (
  select r, vec_id, v, k, d from (
    select r, vec_id, v, k, {far} as d, row_number() over (partition by r order by {far}, k) as place from kept cross join c{i})
  where place = 1
)"""
        if i < 3:
            rounds += f""",
m{i} as (
  select k, list(mean order by place) as moved from (
    select k, place, floor(sum(x)::double / count(*))::bigint as mean from (select k, unnest(v) as x, unnest(range(64)) as place from a{i}) group by k, place)
  group by k
), c{i + 1} as (select k, coalesce(moved, c) as c from c{i} left join m{i} using (k))"""
    return f"""
with kept as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), c0 as (
  select row_number() over (order by sha256('1:' || vec_id), v) - 1 as k, v as c from kept
  qualify row_number() over (order by sha256('1:' || vec_id), v) <= 16
){rounds}
select vec_id, k::int as cluster, d::bigint as distance, (sum(d) over (partition by k))::bigint as cluster_inertia,
       (sum(d) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a3 join c3 using (k)
"""


SQL["op12_centroid_search"] = _centroids()

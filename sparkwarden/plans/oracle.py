"""The registered queries once more, as plain SQL over the shared tables, for comparison.

The texts share a prelude of common table expressions; a query that does not use one does not pay for it.
"""

from __future__ import annotations

import re

from sparkwarden.plans.adapter import LINE_FORMS
from sparkwarden.plans.queries import TACTICS

GAP = 21600
FLAGS = ["ind_lfi_etc_passwd", "ind_path_traversal", "ind_sql_injection", "ind_cmd_injection", "ind_wp_probe"]

_MESSY = "'{line}'"
for _number, _text in LINE_FORMS.items():
    _MESSY = f"case when event_id % 31 = {_number} then '{_text.replace(chr(39), chr(39) * 2)}' else {_MESSY} end"

_SUMS = ", ".join(f"cast(sum(cast({c} as bigint)) as bigint) as {c}" for c in FLAGS)

PRELUDE = rf"""
with base as (
  select event_id, cast(floor(epoch(ts)) as bigint) as es, user_id from events
), placed as (
  select event_id,
    1704067200 + case when user_id % 10 = 0 then (es - 1704067200) // 200000 else es - 1704067200 end as ts_s,
    case when user_id % 10 = 0 then '10.0.0.0'
         else concat('10.0.', cast(user_id // 256 as varchar), '.', cast(user_id % 256 as varchar)) end as src_ip,
    cast(1024 + (event_id * 7919) % 64000 as bigint) as src_port,
    case user_id % 10 when 0 then 'gobuster/3.1' when 1 then 'DirBuster-1.0' when 2 then 'curl/8.4.0'
      when 3 then 'python-requests/2.31' when 4 then 'sqlmap/1.7' when 5 then null else 'Mozilla/5.0 (X11)' end
      as user_agent,
    case event_id % 41 when 0 then '/etc/passwd' when 1 then '../../app.ini' when 2 then 'q=1 UNION all'
      when 3 then 'x|id' when 4 then '/wp-login.php' when 5 then 'x||id' else '/index.html' end as action2
  from base
), timed as (
  select *, strftime(make_timestamp(ts_s * 1000000), '%Y-%m-%d %H:%M:%S') as time_text from placed
), ev as (
  select *, replace(time_text, ' ', 'T') || 'Z' as ts,
    cast(to_json([null, action2, time_text, src_ip, cast(src_port as varchar), user_agent]) as varchar) as raw_line
  from timed
), enr as (
  select *,
    case when user_agent is null or user_agent = '' then 'browser/unknown'
      when regexp_matches(user_agent, 'dirbuster', 'i') then 'dirbuster'
      when regexp_matches(user_agent, 'gobuster', 'i') then 'gobuster'
      when regexp_matches(user_agent, 'nikto', 'i') then 'nikto'
      when regexp_matches(user_agent, 'sqlmap', 'i') then 'sqlmap'
      when regexp_matches(user_agent, '\bcurl/', 'i') then 'curl'
      when regexp_matches(user_agent, '\bwget/', 'i') then 'wget'
      when regexp_matches(user_agent, 'python-requests', 'i') then 'python-requests'
      when regexp_matches(user_agent, 'go-http-client', 'i') then 'go-http-client'
      else 'browser/unknown' end as tool,
    regexp_matches(txt, '/etc/passwd', 'i') as ind_lfi_etc_passwd,
    regexp_matches(txt, '(?:\.\./|%2e%2e%2f|%2e%2e/|\.\.%2f|\.\.\\|%5c)', 'i') as ind_path_traversal,
    regexp_matches(txt, '(\bunion\b|\bselect\b|\bdrop\b|\bor\b\s+1=1|%27|%22)', 'i') as ind_sql_injection,
    regexp_matches(txt, '(;|\|\||\|`|`|\$\(|%3b|%7c)', 'i') as ind_cmd_injection,
    regexp_matches(txt, '(wp-admin|wp-login\.php|xmlrpc\.php)', 'i') as ind_wp_probe
  from (select *, raw_line || ' ' || '' || ' ' || action2 as txt from ev)
), counted as (
  select *, cast({' + '.join(f'cast({c} as bigint)' for c in FLAGS)} as bigint) as indicator_count from enr
), marked as (
  select *, case when ts_s - lag(ts_s) over w > {GAP} or lag(ts_s) over w is null then 1 else 0 end as opens
  from counted window w as (partition by src_ip, tool order by ts_s, event_id)
), numbered as (
  select *, cast(sum(opens) over (partition by src_ip, tool order by ts_s, event_id
                                  rows between unbounded preceding and current row) as bigint) as session_idx
  from marked
), digested as (
  select *, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8')
                 || encode(concat(src_ip, '|', tool, '|', cast(session_idx as varchar)))) as h
  from numbered
), named as (
  select *, concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-',
      translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab'), substr(h, 18, 3), '-', substr(h, 21, 12))
      as session_id,
    cast(count(*) over (partition by src_ip, tool, session_idx) as bigint) as session_size
  from digested
), kept as (
  select * from named where session_size >= 2
), summed as (
  select session_id, min(src_ip) as src_ip, min(tool) as tool, min(ts_s) as start_ts, max(ts_s) as end_ts,
    cast(count(*) as bigint) as event_count, cast(count(distinct src_port) as bigint) as unique_ports,
    cast(sum(indicator_count) as bigint) as indicator_hits, {_SUMS}
  from kept group by session_id
), ses as (
  select *, cast(end_ts - start_ts as double) as duration_s,
    event_count / (case when end_ts = start_ts then 1e0 else cast(end_ts - start_ts as double) end) as rps
  from summed
), ruled as (
  select *, least(greatest(0e0
      + case when tool in ('gobuster', 'dirbuster') then 0.85e0 else 0e0 end
      + case when tool in ('go-http-client', 'python-requests', 'curl', 'wget') then 0.2e0 else 0e0 end
      + case when ind_lfi_etc_passwd > 0 then 0.9e0 else 0e0 end
      + case when ind_path_traversal > 0 then 0.7e0 else 0e0 end
      + case when ind_sql_injection > 0 then 0.7e0 else 0e0 end
      + case when ind_cmd_injection > 0 then 0.7e0 else 0e0 end
      + case when ind_wp_probe > 0 then 0.4e0 else 0e0 end
      + case when rps >= 3.0e0 then 0.35e0 else 0e0 end
      + case when event_count >= 300 then 0.35e0 else 0e0 end
      + case when unique_ports >= 20 then 0.25e0 else 0e0 end, 0e0), 1e0) as rule_score,
    list_filter([
      case when tool in ('gobuster', 'dirbuster') then 'tool_fingerprint:dir_enum' end,
      case when tool in ('go-http-client', 'python-requests', 'curl', 'wget') then 'tool_fingerprint:automation' end,
      case when ind_lfi_etc_passwd > 0 then 'indicator:/etc/passwd' end,
      case when ind_path_traversal > 0 then 'indicator:path_traversal' end,
      case when ind_sql_injection > 0 then 'indicator:sql_injection' end,
      case when ind_cmd_injection > 0 then 'indicator:cmd_injection' end,
      case when ind_wp_probe > 0 then 'indicator:wp_probe' end,
      case when rps >= 3.0e0 then 'behavior:burst_rps>=3' end,
      case when event_count >= 300 then 'behavior:high_volume>=300' end,
      case when unique_ports >= 20 then 'behavior:many_ports' end], lambda x: x is not null) as rule_reasons
  from ses
), modelled as (
  select *, ((event_count * 37 + unique_ports * 17 + indicator_hits * 5) % 101) / 100e0 as ml_score from ruled
), fused as (
  select *, least(greatest(0.65e0 * rule_score + 0.35e0 * ml_score, 0e0), 1e0) as suspicious_score from modelled
), scored as (
  select *, case when suspicious_score >= 0.7e0 then 'attack_like' when suspicious_score >= 0.4e0 then 'suspicious'
      else 'benign' end as label,
    case when ml_score >= 0.8e0 then list_append(rule_reasons, 'ml_anomaly:high') else rule_reasons end as reasons
  from fused
), truth as (
  select *, case
      when ind_lfi_etc_passwd > 0 or ind_path_traversal > 0 or ind_sql_injection > 0 or ind_cmd_injection >= 3
        or (tool in ('gobuster', 'dirbuster') and event_count >= 30) then 'attack_like'
      when indicator_hits > 0 or rps >= 3e0 or unique_ports >= 20 then 'suspicious'
      when indicator_hits = 0 and tool = 'browser/unknown' and rps < 0.5e0 and event_count <= 5 and unique_ports <= 3
        then 'benign'
      else 'unknown' end as proxy_true
  from scored
)
"""

_LABELS = "(values ('benign'), ('suspicious'), ('attack_like')) as l(label)"


def _joined(name: str, sep: str = ",") -> str:
    return f"coalesce(array_to_string({name}, '{sep}'), '') as {name}"


def _r(expr: str, name: str | None = None) -> str:
    return f"round({expr}, 6) as {name or expr}"


_SESSION_COLUMNS = (
    "session_id, src_ip, tool, start_ts, end_ts, event_count, unique_ports, indicator_hits, "
    + ", ".join(FLAGS)
    + ", "
    + _r("duration_s")
    + ", "
    + _r("rps")
)
_EVENT_COLUMNS = (
    "session_id, ts, ts_s as ts_dt_utc, src_ip, src_port, tool, user_agent, cast(null as varchar) as action1, action2, "
    "cast(null as varchar) as extra, indicator_count, " + ", ".join(FLAGS) + ", raw_line"
)

_LINES = rf""", messy as (
  select event_id, replace(replace(replace(replace(replace({_MESSY}, '{{line}}', raw_line),
      '{{head}}', 'null,"' || action2 || '","' || time_text || '","' || src_ip || '"'),
      '{{agent}}', coalesce('"' || user_agent || '"', 'null')), '{{ip}}', src_ip), '{{time}}', time_text) as value
  from ev
), cleaned as (
  select event_id, trim(value, ' ' || chr(9) || chr(10) || chr(13)) as raw_line from messy
), typed as (
  select *, case when json_valid(raw_line) and not regexp_matches(raw_line, ',\s*\]$') then cast(raw_line as json) end as j
  from cleaned
), arrays as (
  select *, coalesce(json_type(j) = 'ARRAY' and json_array_length(j) >= 6, false) as enough from typed
), shaped as (
  select *, coalesce(enough and json_type(j, '$[2]') = 'VARCHAR'
      and regexp_full_match(json_extract_string(j, '$[2]'), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}'),
      false) as good
  from arrays
)
"""


def _slot(i: int) -> str:
    return f"case when json_type(j, '$[{i}]') = 'VARCHAR' then json_extract_string(j, '$[{i}]') end"


_PORT = r"""case
    when json_type(j, '$[4]') in ('BIGINT', 'UBIGINT') then try_cast(json_extract_string(j, '$[4]') as bigint)
    when json_type(j, '$[4]') = 'DOUBLE' then try_cast(trunc(cast(json_extract_string(j, '$[4]') as double)) as bigint)
    when json_type(j, '$[4]') = 'BOOLEAN' then case json_extract_string(j, '$[4]') when 'true' then 1 else 0 end
    when json_type(j, '$[4]') = 'VARCHAR' and regexp_full_match(json_extract_string(j, '$[4]'), '\s*[+-]?[0-9]+(_[0-9]+)*\s*')
      then try_cast(regexp_replace(json_extract_string(j, '$[4]'), '[_\s]', '', 'g') as bigint) end"""


def _sessions_of(source: str) -> str:
    """The prelude's steps from enrichment to sessions once more, over parsed lines, as ``ses_raw``."""
    steps = PRELUDE[PRELUDE.index("enr as (") : PRELUDE.index("), ruled as (")] + ")"
    for name in "enr counted marked numbered digested named kept summed ses".split():
        steps = re.sub(rf"\b{name}\b", f"{name}_raw", steps)
    whole = "raw_line || ' ' || coalesce(action1, '') || ' ' || coalesce(action2, '') as txt from " + source
    return steps.replace("raw_line || ' ' || '' || ' ' || action2 as txt from ev", whole)


def _metrics(pairs: str, extra: str) -> str:
    """Long-form metrics from a query of (truth, pred) and a query of one row of further numbers."""
    return f""", pairs as ({pairs}), cls as (
  select label, count(*) filter (where truth = label and pred = label) as hit,
    count(*) filter (where pred = label and truth in ('benign', 'suspicious', 'attack_like')) as predicted,
    count(*) filter (where truth = label and pred in ('benign', 'suspicious', 'attack_like')) as support
  from {_LABELS} cross join pairs group by label
), rates as (
  select label, case when predicted > 0 then cast(hit as double) / predicted else 0e0 end as precision,
    case when support > 0 then cast(hit as double) / support else 0e0 end as recall,
    case when predicted + support > 0 then 2e0 * hit / (predicted + support) else 0e0 end as f1,
    cast(support as double) as support
  from cls
), long as (
  select label || '.precision' as metric, precision as value from rates
  union all select label || '.recall', recall from rates
  union all select label || '.f1', f1 from rates
  union all select label || '.support', support from rates
  union all select 'macro_f1', avg(f1) from rates
  union all select 'weighted_f1', sum(f1 * support) / sum(support) from rates
  {extra}
) select metric, round(value, 6) as value from long"""


_DOC_LABELS = ", truth_rows as (select 'doc-' || doc_id as session_id, case when toxic = 1 then 'attack_like' when quality = 0 then 'suspicious' else 'benign' end as truth from labels), doc_rows as (select 'doc-' || doc_id as session_id, case n_chars % 5 when 0 then 'attack_like' when 1 then 'suspicious' else 'benign' end as pred from documents)"
_LABELED = (
    PRELUDE
    + _DOC_LABELS
    + _metrics(
        "select truth, pred from truth_rows join doc_rows using (session_id)",
        "union all select 'n_evaluated', cast(count(*) as double) from pairs "
        "union all select 'coverage', cast((select count(*) from pairs) as double) / greatest(count(*), 1) from labels",
    )
)


def _histogram(rows: str, column: str) -> str:
    edge = "case when {i} = 40 then hi else lo + {i} * ((hi - lo) / 40) end"
    return f""", x as (select cast({column} as double) as x from {rows}), b as (select min(x) as lo, max(x) as hi from x),
rough as (select x, lo, hi, least(greatest(cast(floor((x - lo) * (40e0 / (hi - lo))) as bigint), 0), 39) as bin from x, b),
placed2 as (select case when x < {edge.format(i='bin')} then bin - 1
    when x >= {edge.format(i='(bin + 1)')} and bin < 39 then bin + 1 else bin end as bin from rough),
grid as (select lo, hi, cast(i as bigint) as bin from b, range(40) as r(i))
select grid.bin as bin, round({edge.format(i='grid.bin')}, 6) as low, round({edge.format(i='(grid.bin + 1)')}, 6) as high,
  cast(coalesce(n, 0) as bigint) as count
from grid left join (select bin, count(*) as n from placed2 group by bin) c on c.bin = grid.bin"""


_SIM = "round(list_cosine_similarity(cast(q.embedding as double[]), cast(p.embedding as double[])), 9)"
_TOPK = f"""select query_id, rank, point_id, round(score, 6) as score from (
  select *, row_number() over (partition by query_id order by score desc, point_id) as rank from (
    select q.vec_id as query_id, p.vec_id as point_id, {_SIM} as score from embeddings q, embeddings p)) where rank <= 10"""

_LOF = """, sims as (
  select q.id as id, p.id as nb, 1e0 - round(list_cosine_similarity(q.v, p.v), 9) as d, p.tie as tie, q.tie = p.tie as same
  from pts q join pts p on q.id <> p.id
), near as (
  select * from (select *, row_number() over (partition by id order by not same, d, tie, nb) as rn from sims) where rn <= 35
), kd as (select id, max(d) as kd from near group by id
), lrd as (select near.id, 1e0 / (sum(greatest(d, kd)) / 35 + 1e-10) as lrd from near join kd on kd.id = near.nb group by near.id
), f as (select near.id, sum(b.lrd) / 35 / min(a.lrd) as lof from near join lrd a on a.id = near.id join lrd b on b.id = near.nb
  group by near.id)
"""
_LOF_SCORE = "round((lof - min(lof) over ()) / (max(lof) over () - min(lof) over () + 1e-9), 6) as ml_score from f"

_TACTIC_LIST = "[" + ", ".join(f"'{t}'" for t in TACTICS) + "]"
_MAPPING = f""", total as (select count(*) as n from embeddings), keyed as (
  select s.*, (event_count * 7919 + start_ts) % n as one, (unique_ports * 104729 + end_ts + 1) % n as two
  from scored s, total where label in ('attack_like', 'suspicious')
), vectors as (
  select keyed.*, list_transform(list_zip(cast(a.embedding as double[]), cast(b.embedding as double[])), lambda z: z[1] + z[2]) as v
  from keyed join embeddings a on a.vec_id = one join embeddings b on b.vec_id = two
), techs as (
  select vec_id, 'T' || (vec_id + 1000) as technique_id, 'technique ' || vec_id as name, cast(embedding as double[]) as e,
    case when vec_id % 3 = 0 then [tac[label % 10 + 1]] else [tac[label % 10 + 1], tac[(label * 3 + 1) % 10 + 1]] end as tactics
  from (select *, {_TACTIC_LIST} as tac from embeddings)
), ranked as (
  select * from (select *, row_number() over (partition by session_id order by sim desc, vec_id) as rank from (
    select session_id, vec_id, technique_id, name, tactics, round(list_cosine_similarity(v, e), 9) as sim from vectors, techs
  )) where rank <= 3
), lists as (
  select session_id, list(technique_id order by rank) as mapped_techniques, list(name order by rank) as mapped_names,
    list(tactics order by rank) as mapped_tactics, max(sim) as sim
  from ranked group by session_id
), boosted as (
  select *, {{boost}} as boost from vectors
), mapped as (
  select boosted.*, mapped_techniques, mapped_names, mapped_tactics, rule_reasons as why,
    least(greatest(0.85e0 * least(greatest(sim, 0e0), 1e0) + 0.15e0 * (boost / 0.35e0), 0e0), 1e0) as confidence
  from boosted join lists using (session_id)
)
"""


def _boost(passwd: str = "0e0") -> str:
    reason = (
        "case r when 'indicator:cmd_injection' then 0.15e0 when 'indicator:sql_injection' then 0.15e0 "
        "when 'indicator:path_traversal' then 0.15e0 when 'behavior:burst_rps>=3' then 0.1e0 "
        f"when 'behavior:many_ports' then 0.1e0 when 'indicator:/etc/passwd' then {passwd} else 0e0 end"
    )
    used = "case when len(rule_reasons) > 0 then rule_reasons else reasons end"
    tool = "case when tool in ('gobuster', 'dirbuster') then 0.15e0 else 0e0 end"
    return f"least({tool} + coalesce(list_sum(list_transform({used}, lambda r: {reason})), 0e0), 0.35e0)"


_MAPPED = PRELUDE + _MAPPING.replace("{boost}", _boost())

_LABEL_CELLS = """, cells as (
  select session_id, start_ts, 'T' || (one + 1000) as a, 'T' || (two + 1001) as b from keyed
), label_rows as (
  select session_id, case start_ts % 10 when 0 then b when 1 then b || ' | ' || a when 2 then a || ',,' || b
      when 3 then '["' || b || '", " ' || a || ' "]' when 4 then '  ' when 6 then '[''' || b || ''', ''' || a || ''']'
      when 7 then '["' || b || '"] ["' || a || '"]' when 8 then chr(9) || b || chr(9) || '|' || chr(160) || a || ' ' || chr(9)
      when 9 then chr(9) || '["' || b || '", true, null, 5, false]' else '[not json |' || a || ']' end as true_technique_ids,
    case start_ts % 10 when 0 then [b] when 1 then [b, a] when 2 then [a, b] when 3 then [b, a] when 4 then []
      when 6 then ['[''' || b || '''', '''' || a || ''']'] when 7 then ['["' || b || '"] ["' || a || '"]'] when 8 then [b, a]
      when 9 then [b, 'True', 'None', '5', 'False'] else ['[not json', a || ']'] end as items
  from cells
)
"""

_EXPECTED = """case when len(t) > 0 then t else ['discovery'] end"""
_EXPECTED_ROWS = """list_filter([
    case when contains(w, 'dir_enum') or contains(w, 'many_ports') or contains(w, 'high_volume') or contains(w, 'wp_probe')
      then 'discovery' end,
    case when contains(w, 'cmd_injection') then 'execution' end,
    case when contains(w, 'path_traversal') or contains(w, '/etc/passwd') or contains(w, 'sql_injection')
      then 'initial-access' end], lambda x: x is not null)"""
_ALIGNMENT = f""", aligned as (
  select confidence, flatten(mapped_tactics) as pred, {_EXPECTED} as want from (
    select *, {_EXPECTED_ROWS} as t from (select *, lower(array_to_string(why, ' ')) as w from mapped))
), alignment as (
  select cast(count(*) as bigint) as n_evaluated, avg(cast(list_has_any(pred[1:1], want) as int)) as top1,
    avg(cast(list_has_any(pred[1:3], want) as int)) as top3, avg(confidence) as conf
  from aligned
)
"""

_FEATURES = """, features as (
  select *, cast(len(mapped_techniques) as bigint) as n_mapped_techniques,
    cast(len(flatten(mapped_tactics)) as bigint) as n_mapped_tactics, start_ts // 3600 % 24 as hour_utc
  from mapped
)
"""

_KNOWLEDGE = """with parts as (
  select p_partkey as pos, 'attack-pattern--' || p_partkey as stix_id,
    case when p_size % 10 <> 0 then 'T' || (p_partkey // 2 + 1000) end as technique_id, p_name as name,
    p_brand || '/' || p_type as description, list_sort([lower(p_type), 'p' || (p_size % 5)]) as tactics,
    case when p_size % 3 <> 0 then p_size % 2 = 0 else false end as is_subtechnique,
    case when p_size % 4 <> 0 then [p_brand, 'Linux'] else [] end as platforms
  from part
), rels as (
  select (l_orderkey * 8 + l_linenumber) * 33554432 + l_partkey * 1009 + l_suppkey + 2000000000 as ord, *
  from lineitem
), mits as (
  select technique_id, ord, 'course-of-action--' || s_suppkey as stix_id, s_name as name,
    cast(s_nationkey as varchar) as description
  from rels join parts on l_partkey = pos join supplier on s_suppkey = l_suppkey
  where l_returnflag <> 'A' and technique_id is not null
), numbered_mits as (
  select *, row_number() over (partition by technique_id order by ord) as n from mits
), listed as (
  select technique_id, list(name order by n) as names from numbered_mits where n <= 20 group by technique_id
)
"""
_TECH_COLUMNS = (
    "stix_id, technique_id, name, description, array_to_string(tactics, ',') as tactics, is_subtechnique, "
    "coalesce(array_to_string(platforms, ','), '') as platforms"
)
_NAMES = "coalesce(names, [])"


def _build() -> dict[str, str]:
    p = PRELUDE
    q: dict[str, str] = {}

    text_slots = {"src_ip": 3, "user_agent": 5, "lang": 6, "action1": 0, "action2": 1, "extra": 7}
    slots = ", ".join(f"{_slot(i)} as {name}" for name, i in text_slots.items())
    q["parse_log_lines"] = (
        p + _LINES + f"select replace(json_extract_string(j, '$[2]'), ' ', 'T') || 'Z' as ts, {_PORT} as src_port, "
        f"{slots}, raw_line from shaped where good"
    )
    q["rejected_lines"] = (
        p + _LINES + "select raw_line, case when raw_line = '' then 'blank' when not enough then 'not_an_array_of_six' "
        "else 'bad_time' end as reason from shaped where not good"
    )
    q["streamed_events"], q["streamed_rejects"] = q["parse_log_lines"], q["rejected_lines"]
    null = "cast(null as varchar)"
    q["conform_events"] = (
        p + "select ts, src_ip, case when event_id % 3 = 1 then src_port end as src_port, user_agent, "
        f"{null} as lang, {null} as action1, action2, {null} as extra, raw_line from ev"
    )
    q["enrich_events"] = p + f"select event_id, tool, {', '.join(FLAGS)}, indicator_count from counted"

    q["sessionize_gap"] = p + f"select {_SESSION_COLUMNS} from ses"
    q["sessionize_hot_source"] = q["sessions_written"] = q["streamed_sessions"] = q["session_rollup"] = q["sessionize_gap"]
    q["session_ids"] = p + "select distinct session_id, src_ip, tool, session_idx, session_size from named"
    q["session_events_kept"] = p + f"select {_EVENT_COLUMNS} from kept"
    q["session_events_hot_source"] = q["session_events_kept"]

    q["rule_scores"] = p + f"select session_id, {_r('rule_score')}, {_joined('rule_reasons')} from ruled"
    q["score_labels"] = (
        p + f"select session_id, {_r('ml_score')}, {_r('suspicious_score')}, label, {_joined('reasons')} from scored"
    )
    q["riskiest_sessions"] = (
        p + f"select session_id, src_ip, tool, event_count, {_r('rps')}, indicator_hits, {_r('rule_score')}, "
        f"{_joined('rule_reasons')} from ruled order by ruled.rule_score desc, session_id limit 10"
    )
    q["top_sessions"] = (
        p + f"select session_id, src_ip, tool, event_count, {_r('duration_s')}, {_r('rps')}, indicator_hits from ses "
        "order by event_count desc, session_id limit 10"
    )
    q["top_indicator_sessions"] = (
        p + f"select src_ip, tool, indicator_hits, {', '.join(FLAGS)} from ses where indicator_hits > 0 "
        "order by indicator_hits desc, session_id limit 10"
    )
    q["top_suspicious"] = (
        p + f"select src_ip, tool, event_count, {_r('rps')}, indicator_hits, {_r('suspicious_score')}, label, "
        f"{_joined('reasons')} from scored order by scored.suspicious_score desc, session_id limit 10"
    )
    q["top_attack_tools"] = (
        p + "select tool, count(*) as count from scored where label = 'attack_like' group by tool "
        "order by count desc, tool limit 10"
    )
    q["label_counts"] = (
        p + "select d.label, n as count from (values ('benign'), ('suspicious'), ('attack_like'), ('unheard_of')) "
        "as d(label) left join (select label, count(*) as n from scored group by label) c on c.label = d.label"
    )
    q["tool_counts"] = p + "select tool, count(*) as count from ses group by tool"
    q["indicator_totals"] = p + " union all ".join(
        f"select '{c}' as indicator, cast(sum({c}) as bigint) as total from scored where label = 'attack_like'"
        for c in FLAGS
    )
    parsed = (
        f", pev as (select event_id, raw_line, {_slot(0)} as action1, {_slot(1)} as action2, {_slot(3)} as src_ip, {_PORT} as src_port, "
        f"{_slot(5)} as user_agent, cast(epoch(try_strptime({_slot(2)}, '%Y-%m-%d %H:%M:%S')) as bigint) as ts_s from shaped where good"
        "), pgood as (select * from pev where ts_s is not null and src_ip is not null), "
    )
    q["ingested_sessions"] = p + _LINES + parsed + _sessions_of("pgood") + f" select {_SESSION_COLUMNS} from ses_raw"
    fixed = lambda c, n: f"printf('%.{n}f', {c} + 1.3e-8)"
    listed = lambda c: f"'[' || coalesce(array_to_string(list_transform({c}, lambda r: chr(39) || r || chr(39)), ' '), '') || ']'"
    q["session_texts"] = p + (
        f"""select session_id, concat('tool=', tool, '; events=', event_count, '; duration_s=', {fixed("duration_s", 1)}, '; rps=',
  {fixed("rps", 3)}, '; unique_ports=', unique_ports, '; indicator_hits=', indicator_hits, '; etc_passwd=', ind_lfi_etc_passwd,
  '; traversal=', ind_path_traversal, '; sqli=', ind_sql_injection, '; cmdi=', ind_cmd_injection, '; wp=', ind_wp_probe) as model,
concat('Session from ', src_ip, ' tool=', tool, ' label=', label, ' score=', {fixed("suspicious_score", 2)}, '. events=', event_count,
  ' duration_s=', {fixed("duration_s", 1)}, ' rps=', {fixed("rps", 3)}, '. indicators: hits=', indicator_hits, ', etc_passwd=',
  ind_lfi_etc_passwd, ', traversal=', ind_path_traversal, ', sqli=', ind_sql_injection, ', cmdi=', ind_cmd_injection,
  ', wp_probe=', ind_wp_probe, '. reasons=', {listed("reasons")}) as stored,
concat('tool=', tool, ' label=', label, ' src_ip=', src_ip, ' event_count=', event_count, ' rps=', {fixed("rps", 6)}, ' unique_ports=',
  unique_ports, ' indicator_hits=', indicator_hits, ' reasons=', {listed("rule_reasons")}) as summary,
concat('/src_ip=', src_ip, ' tool=', tool, ' label=', label, '/event_count=', event_count, ' rps=', {fixed("rps", 6)},
  ' indicator_hits=', indicator_hits, '/reasons=', {listed("rule_reasons")}, '/') as query from scored"""
    )
    q["first_suspicious_sessions"] = (
        p + "select session_id, label from scored where label in ('attack_like', 'suspicious') order by session_id limit 25"
    )
    q["score_histogram"] = p + _histogram("scored", "suspicious_score")
    q["value_histogram"] = p + _histogram("lineitem", "l_extendedprice")

    counts = ", ".join(
        f"cast(count(*) filter (where label = '{lab}') as bigint) as {lab}"
        for lab in ("benign", "suspicious", "attack_like")
    )
    minute = (
        p + ", minutes as (select kept.ts_s - kept.ts_s % 60 as minute, label, suspicious_score "
        "from kept left join scored using (session_id)) "
    )
    q["timeline_minute"] = minute + f"select minute, {counts} from minutes where label is not null group by minute"
    q["timeline_intensity"] = (
        minute + "select minute, round(sum(coalesce(suspicious_score, 0e0)), 6) as weight from minutes group by minute"
    )
    q["timeline_5min"] = (
        minute + f", five as (select minute - minute % 300 as bucket, {counts} from minutes group by 1), "
        "grid as (select unnest(range((select min(bucket) from five), (select max(bucket) from five) + 1, 300)) as bucket) "
        "select grid.bucket as bucket, coalesce(benign, 0) as benign, coalesce(suspicious, 0) as suspicious, "
        "coalesce(attack_like, 0) as attack_like from grid left join five on five.bucket = grid.bucket"
    )
    q["streamed_timeline"] = q["timeline_5min"]
    q["event_peek"] = (
        p + "select session_id, ts, src_ip, tool, indicator_count from kept order by session_id, ts, raw_line limit 5"
    )
    q["rule_vs_model"] = p + "select label, round(rule_score, 6) as x, round(ml_score, 6) as y from scored"
    q["price_scaling"] = (
        "select l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_extendedprice - lo) / (hi - lo + 1e-9), 6) as scaled "
        "from lineitem, (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem)"
    )

    q["detection_eval_labeled"] = q["detection_eval_csv"] = _LABELED
    q["invalid_labels"] = """select value, count(*) as count from (
  select trim(lower(case doc_id % 4 when 0 then lang when 1 then source when 2 then 'benign' else '' end)) as value from documents)
where value not in ('benign', 'suspicious', 'attack_like') group by 1"""
    q["detection_eval_proxy"] = p + _metrics(
        "select proxy_true as truth, label as pred from truth where proxy_true <> 'unknown'",
        "union all select 'n_evaluated', cast(count(*) as double) from pairs "
        "union all select 'coverage', cast((select count(*) from pairs) as double) / greatest(count(*), 1) from scored",
    )
    order = "(values (0, 'benign'), (1, 'suspicious'), (2, 'attack_like'))"
    q["proxy_confusion"] = (
        p + f"select cast(t.i as bigint) as row, cast(c.i as bigint) as col, t.label as true_label, c.label as pred_label, "
        f"cast((select count(*) from truth x where x.proxy_true = t.label and x.label = c.label) as bigint) as count "
        f"from {order} as t(i, label), {order} as c(i, label)"
    )
    q["proxy_truth"] = p + "select session_id, proxy_true from truth"
    q["detection_template"] = (
        p + f"select session_id, label as pred_label, {_r('suspicious_score')}, tool, src_ip, "
        "cast(to_json(rule_reasons) as varchar) as rule_reasons, '' as true_label from scored order by session_id limit 1000"
    )

    q["vector_topk"] = q["vector_topk_scan"] = q["vector_topk_cells"] = _TOPK
    q["vector_topk_filtered"] = f"""select query_id, rank, point_id, round(score, 6) as score, label, tool from (
  select *, row_number() over (partition by query_id order by score desc, point_id) as rank from (
    select q.vec_id as query_id, p.vec_id as point_id, cast(p.label as varchar) as label, 'tool-' || (p.vec_id % 7) as tool,
      {_SIM} as score
    from embeddings q, embeddings p where p.label = 3 and p.vec_id % 7 = 2)) where rank <= 10"""
    q["index_recall"] = """with n as (select count(*) as n, count(case when vec_id % 20 = 0 then 1 end) as q from embeddings)
select 'queries' as metric, cast(q as double) as value from n union all select 'indexed', n from n
union all select 'pairs', q * n from n union all select 'recall_reached', 1 union all select 'fewer_codes', 1
union all select 'fewer_vectors', 1"""
    q["graph_recall"] = """with n as (select count(*) as n, count(case when vec_id % 20 = 0 then 1 end) as q from embeddings)
select 'queries' as metric, cast(q as double) as value from n union all select 'nodes', n from n
union all select 'edges', n * least(35, n - 1) from n union all select 'wrong_scores', 0 union all select 'recall_reached', 1"""
    q["points_upsert"] = """with changed as (
  select case when label = 4 then vec_id else vec_id + (select max(vec_id) from embeddings) + 1 end as point_id,
    'new' as label, 'tool-' || (vec_id % 7) as tool, list_reverse(embedding) as v
  from embeddings where label in (4, 5)
), merged as (
  select * from changed union all
  select vec_id, cast(label as varchar), 'tool-' || (vec_id % 7), embedding from embeddings
  where vec_id not in (select point_id from changed)
) select point_id, label, tool, round(cast(v[1] as double), 6) as first from merged"""
    q["collection_versions"] = f"""select 1::bigint as version, vec_id as point_id, cast(label as varchar) as label,
  'tool-' || (vec_id % 7) as tool, round(cast(embedding[1] as double), 6) as first from embeddings
union all select 2, * from ({q["points_upsert"]})"""
    q["collection_info"] = (
        "select count(*) as points, min(len(embedding)) as min_dim, max(len(embedding)) as dim from embeddings"
    )
    q["points_scroll"] = (
        "select vec_id as point_id, cast(label as varchar) as label, len(embedding) as dim from embeddings "
        "order by vec_id limit 500"
    )
    q["points_retrieve"] = (
        "select vec_id as point_id, cast(label as varchar) as label, 'tool-' || (vec_id % 7) as tool "
        "from embeddings where vec_id in (select l_suppkey from lineitem)"
    )
    q["dense_numbers"] = p + "select row_number() over (order by session_id) - 1 as point_id, session_id from ses"
    iso = "strftime(make_timestamp({c} * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' as {c}"
    q["session_point_payloads"] = (
        p + "select row_number() over (order by session_id) - 1 as point_id, cast(256 as bigint) as dim, session_id, src_ip, "
        f"tool, label, {_r('suspicious_score')}, event_count, {_r('rps')}, indicator_hits, "
        f"{iso.format(c='start_ts')}, {iso.format(c='end_ts')} from scored"
    )
    q["lof_scores"] = (
        "with pts as (select vec_id as id, vec_id as tie, cast(embedding as double[]) as v from embeddings)"
        + _LOF
        + "select id as point_id, "
        + _LOF_SCORE
    )
    # Copies share one list of similarities; each row then sees every copy of every vector but itself.
    q["lof_duplicates"] = (
        """with v as (select vec_id, cast(embedding as double[]) as e from embeddings
), pairs as (
  select a.vec_id as a, b.vec_id as b, case when a.vec_id = b.vec_id then 0e0
    else 1e0 - round(list_cosine_similarity(a.e, b.e), 9) end as d from v a, v b
), copies as (
  select vec_id, vec_id * 100 + c as id from (select vec_id, unnest(range(case when vec_id % 2 = 0 then vec_id % 61 else 0 end + 1)) as c from v)
), counts as (
  select vec_id, count(*) as w from copies group by vec_id
), ordered as (
  select a, b, d, case when a = b then w - 1 else w end as w,
    sum(case when a = b then w - 1 else w end) over (partition by a order by a <> b, d, b
      rows between unbounded preceding and current row) as upto
  from pairs join counts on counts.vec_id = b
), near as (
  select a, b, d, least(w, 35 - (upto - w)) as w from ordered where upto - w < 35 and w > 0
), kd as (select a, max(d) as kd from near group by a
), lrd as (select near.a, 1e0 / (sum(greatest(d, kd) * w) / 35 + 1e-10) as lrd from near join kd on kd.a = near.b group by near.a
), f as (select near.a, sum(y.lrd * w) / 35 / min(x.lrd) as lof from near join lrd x on x.a = near.a join lrd y on y.a = near.b
  group by near.a)
select id as row_id, round((lof - lo) / (hi - lo + 1e-9), 6) as ml_score
from copies join f on f.a = vec_id, (select min(lof) as lo, max(lof) as hi from f)"""
    )

    tactic_text = "array_to_string(list_transform(mapped_tactics, lambda t: array_to_string(t, '+')), ',') as mapped_tactics"
    q["session_technique_mapping"] = (
        _MAPPED + f"select session_id, src_ip, label, tool, {_r('suspicious_score')}, start_ts, "
        f"{_joined('mapped_techniques')}, {_joined('mapped_names')}, {tactic_text}, {_r('confidence')}, {_joined('why')} from mapped"
    )
    q["session_technique_mapping_join"] = q["session_technique_mapping"]
    sim = "((event_count * 13 + unique_ports) % 151) / 100e0 - 0.2e0"
    sure = "least(greatest(0.85e0 * least(greatest({sim}, 0e0), 1e0) + 0.15e0 * ({boost} / 0.35e0), 0e0), 1e0)"
    q["boost_confidence"] = (
        p + f"select session_id, {_r(_boost(), 'boost')}, {_r(_boost('0.2e0'), 'boost_fixed')}, "
        f"{_r(sure.format(sim=sim, boost=_boost()), 'confidence')} from scored"
    )
    sim = "((event_count * 7 + indicator_hits) % 31) / 30e0"
    q["ranked_candidates"] = (
        p + f", cand as (select src_ip as session_id, session_id as point_id, {sim} as sim, "
        f"round({sure.format(sim=sim, boost=_boost())}, 9) as confidence from scored) "
        "select session_id, point_id, rank, round(sim, 6) as sim, round(confidence, 6) as confidence from (select *, "
        "row_number() over (partition by session_id order by confidence desc, sim desc, point_id) as rank from cand) where rank <= 3"
    )
    items = "coalesce(array_to_string(items, '/'), '') as items"
    q["array_cells"] = _MAPPED + _LABEL_CELLS + f"select session_id, true_technique_ids, {items} from label_rows"
    q["mapping_labels_csv"] = _MAPPED + _LABEL_CELLS + f"select session_id, {items} from label_rows"
    hit = "avg(cast(list_has_any(mapped_techniques[1:{k}], items) as int))"
    q["mapping_eval_labeled"] = (
        _MAPPED + _LABEL_CELLS + f"select count(*) as n_evaluated, {_r(hit.format(k=1), 'top1_accuracy')}, "
        f"{_r(hit.format(k=3), 'top3_accuracy')}, {_r(hit.format(k=10), 'recall_at_k')} "
        "from label_rows join mapped using (session_id) where len(items) > 0 and len(mapped_techniques) > 0"
    )
    q["mapping_eval_proxy"] = (
        _MAPPED + _ALIGNMENT + "select n_evaluated, round(top1, 6) as tactic_alignment_top1, "
        "round(top3, 6) as tactic_alignment_top3, round(conf, 6) as avg_confidence from alignment"
    )
    q["mapping_coverage"] = (
        f"with m as materialized ({q['mapping_eval_labeled']}), c as materialized ({q['array_cells']}) "
        "select 'n_evaluated' as metric, cast(n_evaluated as double) as value from m "
        "union all select 'coverage_vs_labels', round(n_evaluated / (select count(*) from c), 6) from m "
        "union all select 'top1_accuracy', top1_accuracy from m union all select 'top3_accuracy', top3_accuracy from m "
        "union all select 'recall_at_10', recall_at_k from m"
    )
    q["eval_report_proxy"] = (
        f"with d as materialized ({q['detection_eval_proxy']}), m as materialized ({q['mapping_eval_proxy']}) "
        "select 'detection' as section, case when contains(metric, '.') then 'per_class.' || metric "
        "when metric = 'coverage' then 'coverage_vs_sessions' else metric end as metric, value from d "
        "union all select 'mapping', 'n_evaluated', cast(n_evaluated as double) from m "
        "union all select 'mapping', 'tactic_alignment_top1', tactic_alignment_top1 from m "
        "union all select 'mapping', 'tactic_alignment_top3', tactic_alignment_top3 from m "
        "union all select 'mapping', 'avg_confidence', avg_confidence from m"
    )
    q["eval_report_labeled"] = (
        f"with d as materialized ({q['detection_eval_labeled']}), m as materialized ({q['mapping_eval_labeled']}), "
        f"c as materialized ({q['array_cells']}) "
        "select 'detection' as section, case when contains(metric, '.') then 'per_class.' || metric "
        "when metric = 'coverage' then 'coverage_vs_labels' else metric end as metric, value from d "
        "union all select 'mapping', 'n_evaluated', cast(n_evaluated as double) from m "
        "union all select 'mapping', 'coverage_vs_labels', round(n_evaluated / (select count(*) from c), 6) from m "
        "union all select 'mapping', 'top1_accuracy', top1_accuracy from m union all select 'mapping', 'top3_accuracy', top3_accuracy from m "
        "union all select 'mapping', 'retrieval_recall_at_k.k', 10 from m "
        "union all select 'mapping', 'retrieval_recall_at_k.value', recall_at_k from m"
    )
    q["vector_covariance"] = """with cells as (
  select a.i - 1 as i, b.j - 1 as j, cast(embedding[a.i] as double) as x, cast(embedding[b.j] as double) as y
  from embeddings, (select unnest(range(1, 65)) as i) a, (select unnest(range(1, 65)) as j) b where a.i <= b.j)
select i, j, round(covar_samp(x, y), 6) as covariance from cells group by i, j"""
    q["forest_stored"] = """select 'rows' as metric, cast(count(*) as double) as value from embeddings
union all select 'versions', 2 union all select 'differ', 0 union all select 'differ_from_batch', 0"""
    q["forest_properties"] = (
        "select 'rows' as metric, cast(count(*) + 1 as double) as value from embeddings union all select 'least', 0e0 "
        "union all select 'greatest', 1e0 union all select 'outlier_first', 1e0"
    )
    q["pca_properties"] = (
        "select 'rows' as metric, cast(count(*) as double) as value from embeddings union all select 'covariance', 0e0 "
        "union all select 'in_order', 1e0 union all select 'mean', 0e0"
    )
    q["mapping_score_bars"] = (
        _MAPPED + _ALIGNMENT + "select 'tactic_top1' as metric, round(top1, 6) as value from alignment union all "
        "select 'tactic_top3', round(top3, 6) from alignment union all select 'avg_conf', round(conf, 6) from alignment"
    )
    q["expected_tactics"] = (
        p + f"select session_id, array_to_string({_EXPECTED}, ',') as tactics from (select *, {_EXPECTED_ROWS} as t "
        "from (select *, lower(array_to_string(rule_reasons, ' ')) as w from ruled))"
    )
    q["technique_counts"] = (
        _MAPPED + "select technique_id, count(*) as count from (select unnest(mapped_techniques) as technique_id from mapped) "
        "group by technique_id order by count desc, technique_id limit 15"
    )
    q["tactic_counts"] = (
        _MAPPED + "select tactic, count(*) as count from (select unnest(flatten(mapped_tactics)) as tactic from mapped) "
        "group by tactic order by count desc, tactic limit 15"
    )
    q["mapping_features"] = (
        _MAPPED + _FEATURES + f"select session_id, label, {_r('suspicious_score')}, {_r('confidence')}, "
        "n_mapped_techniques, n_mapped_tactics, hour_utc from features"
    )
    q["score_vs_confidence"] = (
        _MAPPED + _FEATURES + "select label, round(suspicious_score, 6) as x, round(confidence, 6) as y, "
        "n_mapped_techniques as z from features"
    )
    q["hour_vs_confidence"] = (
        _MAPPED + _FEATURES + "select label, hour_utc as x, round(confidence, 6) as y, round(suspicious_score, 6) as z "
        "from features"
    )
    q["mapping_template"] = (
        _MAPPED + "select session_id, cast(to_json(mapped_techniques) as varchar) as pred_mapped_techniques, "
        f"cast(to_json(mapped_names) as varchar) as pred_mapped_names, {_r('confidence', 'pred_confidence')}, "
        "cast(to_json(why) as varchar) as pred_why, '' as true_technique_ids from mapped order by session_id limit 1000"
    )

    k = _KNOWLEDGE
    q["stix_techniques"] = k + f"select {_TECH_COLUMNS} from parts"
    q["bundle_techniques"] = q["stix_techniques"]
    q["bundle_mitigations"] = (
        k + "select technique_id, stix_id, name, description, count(*) as times from mits group by 1, 2, 3, 4"
    )
    q["stix_techniques_by_id"] = (
        k + f"select {_TECH_COLUMNS} from (select *, row_number() over (partition by technique_id order by pos desc) as rn "
        "from parts where technique_id is not null) where rn = 1"
    )
    q["stix_objects_by_id"] = (
        k + "select stix_id as id, cast(null as varchar) as target_ref from parts union all "
        "select 'course-of-action--' || s_suppkey, null from supplier union all "
        "select 'relationship--' || l_orderkey || '-' || l_linenumber, 'attack-pattern--' || max_by(l_partkey, ord) "
        "from rels group by l_orderkey, l_linenumber"
    )
    q["technique_mitigations"] = k + "select technique_id, ord, stix_id, name, description from mits"
    q["technique_texts"] = (
        k + f"select stix_id, technique_id || ' ' || name || '. Tactics: ' || array_to_string(tactics, ', ') || "
        f"'. Description: ' || replace(description, '/', ' ') || ' Mitigations: ' || "
        f"coalesce(array_to_string({_NAMES}[1:8], '; '), '') as text, "
        f"coalesce(array_to_string({_NAMES}, ','), '') as mitigations "
        "from parts left join listed using (technique_id) where technique_id is not null"
    )
    q["knowledge_counts"] = (
        k + "select count(*) as techniques, (select count(distinct technique_id) from mits) as with_mitigations from parts"
    )
    q["knowledge_sample"] = k + f"select {_TECH_COLUMNS} from parts where technique_id is not null order by pos limit 10"
    q["technique_point_payloads"] = (
        k + "select row_number() over (order by pos) - 1 as point_id, cast(256 as bigint) as dim, technique_id, name, "
        "array_to_string(tactics, ',') as tactics, is_subtechnique, coalesce(array_to_string(platforms, ','), '') as platforms, "
        f"coalesce(array_to_string({_NAMES}, ','), '') as mitigations "
        "from parts left join listed using (technique_id) where technique_id is not null"
    )
    return q


SQL: dict[str, str] = _build()

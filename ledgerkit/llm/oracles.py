"""SQL counterparts of the registered queries, where SQL can express them."""

from __future__ import annotations

LINE_DEDUP = """
with docs as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as n from docs
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), judged as (
  select k.*, r.key is not null and k.doc_id <> r.keeper as gone from keyed k left join repeated r using (key)
)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (gone))::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

URL_RULES = """
with rules(rule_host, rule_path, rule_verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rests as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), cut as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw_host from rests
), parsed as (
  select row_number() over () as n, page_id,
    translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path
  from cut
), fits as (
  select p.*, r.rule_host || r.rule_path as rule, r.rule_verdict,
    row_number() over (partition by n order by length(r.rule_host || r.rule_path) desc nulls last) as place
  from parsed p left join rules r
    on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)
)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict from fits where place = 1
"""

LEXICAL = r"""
with terms as (
  select doc_id, row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) as term
  from (select doc_id, text, row_number() over () as row from documents)
), sizes as (
  select row, count(*)::bigint as n from terms group by row
), totals as (
  select count(*)::bigint as docs, sum(n)::bigint as words from sizes
), tfs as (
  select row, doc_id, term, count(*)::bigint as tf from terms group by row, doc_id, term
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tfs, totals group by term, docs
), asked as (
  select item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) as term
  from benchmark
), scored as (
  select item_id, row, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))))::bigint as score
  from asked join tfs using (term) join weights using (term) join sizes using (row), totals
  group by item_id, row, doc_id
), ranked as (
  select item_id, doc_id, score,
    row_number() over (partition by item_id order by score desc, doc_id nulls first)::integer as rank
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

ORACLES: dict[str, str] = {"op6_url_rules": URL_RULES, "op7_line_dedup": LINE_DEDUP, "op13_lexical": LEXICAL}

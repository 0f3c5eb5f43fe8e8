"""SQL that the queries must agree with."""

from __future__ import annotations

# Fences: quartiles of log-linear sketches, 3 quartile distances and a slack beyond them, and a
# little that is free in texts of any length,
# per language and source, or per language or over all documents where there are fewer than 200.
QUALITY_SQL = r"""
with words as (
  select doc_id, lang, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents
),
grams as (
  select doc_id, i, array_to_string(ws[i : i + 7], ' ') as gram
  from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from words)
),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as n from grams) where n > 1
),
repeats as (
  select doc_id, count(distinct i + j) as n_repeat_words
  from twice, (select unnest(range(8)) as j) group by doc_id
),
counts as (
  select doc_id, lang, source, len(ws)::bigint as n_words,
         length(array_to_string(ws, ''))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         len(ls)::bigint as n_lines,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from words left join repeats using (doc_id)
),
judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counts
),
measured as (
  select lang, source, 'symbols' as m, n_symbols * 1000 // greatest(n_words, 1) as v, 50 as slack
  from judged where not base_failed
  union all select lang, source, 'dup_lines', n_dup_lines * 1000 // greatest(n_lines, 1), 100
  from judged where not base_failed
  union all select lang, source, 'repeats', n_repeat_words * 1000 // greatest(n_words, 1), 50
  from judged where not base_failed
  union all select lang, source, 'word_length', word_chars * 100 // greatest(n_words, 1), 50
  from judged where not base_failed
),
sketched as (
  select lang, source, m, slack, (v >> s) << s as b
  from (select *, greatest(length(bin(v)) - 6, 0)::bigint as s from measured)
),
levels as (
  select 'pair' as level, lang, source, m, slack, b from sketched
  union all select 'lang', lang, null, m, slack, b from sketched
  union all select 'all', null, null, m, slack, b from sketched
),
ranked as (
  select *, row_number() over (partition by level, lang, source, m order by b) as r,
         count(*) over (partition by level, lang, source, m) as n
  from levels
),
quartiles as (
  select level, lang, source, m, slack, n, min(b) filter (where r * 4 >= n) as q1,
         min(b) filter (where r * 4 >= 3 * n) as q3
  from ranked group by all
),
fences as (
  select level, lang, source, m, n, q3 + 3 * (q3 - q1) + slack as high, q1 - 3 * (q3 - q1) - slack as low
  from quartiles
),
wide as (
  select level, lang, source, max(n) as n,
         max(high) filter (where m = 'symbols') as sym, max(high) filter (where m = 'dup_lines') as dup,
         max(high) filter (where m = 'repeats') as rep, max(high) filter (where m = 'word_length') as long,
         max(low) filter (where m = 'word_length') as short
  from fences group by level, lang, source
),
chosen as (
  select p.lang, p.source,
         case when p.n >= 200 then p else case when l.n >= 200 then l else a end end as f
  from (select * from wide where level = 'pair') p
  join (select * from wide where level = 'lang') l on p.lang is not distinct from l.lang
  join (select * from wide where level = 'all') a on true
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(
         n_symbols * 1000 <= f.sym * n_words + 3000 and n_dup_lines * 1000 <= f.dup * n_lines + 2000
         and n_repeat_words * 1000 <= f.rep * n_words + 32000
         and word_chars * 100 between f.short * n_words - 2500 and f.long * n_words + 2500, false) as kept
from judged j left join chosen c
  on j.lang is not distinct from c.lang and j.source is not distinct from c.source
"""

PREFERENCE_SQL = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
  from conversations where conv_id is not null
),
sizes as (
  select conv_id, count(*) as n, row_number() over (order by conv_id) as number, count(*) over () as convs
  from turns group by conv_id
),
cuts as (
  select a.conv_id, b.conv_id as next, a.number % a.n as cut
  from sizes a join sizes b on b.number = a.number % a.convs + 1
),
other as (
  select conv_id, pos, role, text from turns join cuts using (conv_id) where pos < cut
  union all
  select c.conv_id, t.pos, t.role, t.text from cuts c join turns t on t.conv_id = c.next where t.pos >= c.cut
),
aligned as (
  select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.pos, r.pos) as pos,
         coalesce(c.role = r.role and c.text = r.text, false) as same
  from turns c full join other r on c.conv_id = r.conv_id and c.pos = r.pos
),
prefix as (
  select conv_id, coalesce(min(pos) filter (where not same), count(*)) as shared from aligned group by conv_id
),
rendered as (
  select side, conv_id, pos, shared, role = 'assistant' as learnt, length(role) + 5 as head,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as line
  from (select 'c' as side, * from turns union all select 'r', conv_id, role, text, pos from other) join prefix using (conv_id)
),
placed as (
  select *, coalesce(sum(length(line)) over (partition by side, conv_id order by pos
                                            rows between unbounded preceding and 1 preceding), 0) as begins
  from rendered where pos >= shared
),
tails as (
  select conv_id,
         string_agg(line, '' order by pos) filter (where side = 'c') as chosen,
         string_agg(line, '' order by pos) filter (where side = 'r') as rejected,
         string_agg((begins + head) || '-' || (begins + length(line)), ',' order by pos) filter (where side = 'c' and learnt) as chosen_mask,
         string_agg((begins + head) || '-' || (begins + length(line)), ',' order by pos) filter (where side = 'r' and learnt) as rejected_mask
  from placed group by conv_id
),
prompts as (
  select conv_id, string_agg(line, '' order by pos) as prompt from rendered where side = 'c' and pos < shared group by conv_id
)
select conv_id, shared::int as prompt_turns, coalesce(prompt, '') as prompt, coalesce(chosen, '') as chosen,
       coalesce(rejected, '') as rejected, coalesce(chosen_mask, '') as chosen_mask, coalesce(rejected_mask, '') as rejected_mask
from prefix left join prompts using (conv_id) left join tails using (conv_id)
where conv_id in (select conv_id from other)
"""

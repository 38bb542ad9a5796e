"""The same results in DuckDB's SQL, written apart from the Spark plans."""

from __future__ import annotations

from contactloom.llm.licences import TEMPLATES, bigrams_of


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP3 = r"""
with split as (select doc_id, lang, source, coalesce(text, '') as t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
lines as (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from split),
triples as (select doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as g, unnest(range(1, len(w) - 1)) as pos from split where len(w) > 2),
again as (select doc_id, pos from triples qualify count(*) over (partition by doc_id, g) > 1),
covered as (select doc_id, count(distinct p) as n from (select doc_id, pos + unnest([0, 1, 2]) as p from again) x group by doc_id),
counts as (select doc_id, lang, source, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars, cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
  cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(len(ls) as bigint) as n_lines, cast(coalesce(c.n, 0) as bigint) as n_repeat_words from lines left join covered c using (doc_id)),
shares as (select *, n_symbols / greatest(word_chars, 1)::double as symbols, n_dup_lines / greatest(n_lines, 1)::double as dups, n_repeat_words / greatest(n_words, 1)::double as repeats, word_chars / greatest(n_words, 1)::double as wlen from counts),
long as (unpivot (select doc_id, lang, source, symbols, dups, repeats, wlen, word_chars::double as chars, n_lines::double as nl, n_words::double as nw from shares)
  on symbols, dups, repeats, wlen, chars, nl, nw into name metric value x),
-- bins of 1 % relative error: powers of 1.01 / 0.99, read at 0.99 of their upper end
bins as (select lang, source, metric, case when x > 0 then ceil(ln(x) / ln(1.01::double / 0.99)) end as bin, count(*) as n from long group by all),
levels as (select 'own' as lvl, lang, source, metric, bin, n from bins
  union all select 'lang', lang, null, metric, bin, sum(n) from bins group by all
  union all select 'all', null, null, metric, bin, sum(n) from bins group by all),
running as (select *, sum(n) over (partition by lvl, lang, source, metric order by bin nulls first rows unbounded preceding) as upto, sum(n) over (partition by lvl, lang, source, metric) as size,
  case when bin is null then 0.0::double else pow(1.01::double / 0.99, bin) * (2 / (1.01::double / 0.99 + 1)) end as v from levels),
q as (select lvl, lang, source, metric, max(size)::double as size, min(v) filter (upto >= 0.1 * size) as q10, min(v) filter (upto >= 0.5 * size) as q50, min(v) filter (upto >= 0.9 * size) as q90 from running group by all),
own as (select q.lvl, q.lang, q.source, q.metric, q.size, q.q50 as mid, 7 * (q.q90 - q.q50) + case when z.q50 is null then 0.0 else (case q.metric when 'repeats' then 9.0 else 3.0 end)::double / greatest(z.q50, 1) end as up, 7 * (q.q50 - q.q10) as down
  from q left join q z on z.lvl = q.lvl and z.lang is not distinct from q.lang and z.source is not distinct from q.source and z.metric = case q.metric when 'symbols' then 'chars' when 'dups' then 'nl' when 'repeats' then 'nw' end
  where q.metric in ('symbols', 'dups', 'repeats', 'wlen')),
langs as (select o.lang, o.metric, (o.size * o.mid + 50 * a.mid) / (o.size + 50) as mid, (o.size * least(o.up, 4 * a.up + 2 * o.mid) + 50 * a.up) / (o.size + 50) as up, (o.size * least(o.down, 4 * a.down + 2 * o.mid) + 50 * a.down) / (o.size + 50) as down
  from own o join own a on a.lvl = 'all' and a.metric = o.metric where o.lvl = 'lang'),
ends as (select o.lang, o.source, o.metric, (o.size * o.mid + 50 * a.mid) / (o.size + 50) as mid, (o.size * least(o.up, 4 * a.up + 2 * o.mid) + 50 * a.up) / (o.size + 50) as up, (o.size * least(o.down, 4 * a.down + 2 * o.mid) + 50 * a.down) / (o.size + 50) as down
  from own o join langs a on a.metric = o.metric and a.lang is not distinct from o.lang where o.lvl = 'own'),
beyond as (select doc_id, bool_or(x > mid + up or l.metric = 'wlen' and x < mid - down) as far from long l join ends e on e.metric = l.metric and e.lang is not distinct from l.lang and e.source is not distinct from l.source group by doc_id),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not far as kept from judged join beyond using (doc_id)
"""


OP4 = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""

OP5 = r"""
with said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (select *, length(replace(replace(replace(role, '&', '&amp;'), chr(10), '&#10;'), '<', '&lt;')) + 9 + length(regexp_replace(text, '(\\*)(</?s>|\[/?INST\]|<</?SYS>>)', '\\\1\2', 'g')) as chars,
  row_number() over (partition by conv_id order by turn, role, text) as ord from said),
counted as (select *, cast(ceil(chars / 4.0) as bigint) as tokens from sized),
opening as (select conv_id, tokens as sys, chars as sys_chars from counted where ord = 1 and role = 'system'),
laid as (select c.conv_id, chars, tokens, cast(sum(tokens) over (partition by c.conv_id order by ord) - tokens as bigint) as s, greatest(768 - coalesce(sys, 0), 256) as room
  from counted c left join opening l using (conv_id) where not (ord = 1 and role = 'system')),
cut as (select *, s // room as ws, (s + tokens - 1) // room as we, least(256, room) as reach from laid),
spans as (select conv_id, ws, we, min(s) as p, sum(chars) as fresh from cut group by all),
past as (select x.conv_id, x.ws, x.we, sum(h.chars) as old from spans x join cut h on h.conv_id = x.conv_id and h.tokens <= h.reach and h.s + h.tokens <= x.p and h.s >= x.p - h.reach group by all),
windows as (select conv_id, cast(sum(fresh + coalesce(old, 0) + coalesce(sys_chars, 0)) as bigint) as chars from spans left join past using (conv_id, ws, we) left join opening using (conv_id) group by conv_id),
talks as (select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by ord)) as turns_sha256, coalesce(string_agg(text, '' order by ord) filter (role = 'assistant'), '') as loss from counted group by conv_id)
select conv_id, n_turns, turns_sha256, cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256, cast(coalesce(chars, sys_chars) as bigint) as formatted_chars
from talks left join windows using (conv_id) left join opening using (conv_id)
"""


def op6() -> str:
    rows = ", ".join(f"({_quoted(n)}, [{', '.join(map(_quoted, bigrams_of(t)))}])" for n, ts in TEMPLATES.items() for t in ts)
    return f"""
with templates(licence, tb) as (values {rows}),
texts as (select doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as l, unnest(range(len(ls))) as line from texts),
words as (select doc_id, line, list_filter(string_split(l, ' '), lambda x: x <> '') as w from lines),
grams as (select doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b from words where len(w) > 1),
scored as (select doc_id, line, licence, (2000 * len(list_intersect(b, tb))) // (len(b) + len(tb)) as permille from grams, templates),
best as (select doc_id, line, licence, permille from scored where permille >= 800
         qualify row_number() over (partition by doc_id, line order by permille desc, licence) = 1),
found as (select doc_id, count(*) as n, string_agg(distinct licence, ',' order by licence) as licences, max(permille) as best, string_agg(cast(line as varchar), ',' order by line) as lines
          from best group by doc_id)
select d.doc_id, coalesce(n, 0) as n_licence_lines, coalesce(licences, '') as licences, cast(coalesce(best, 0) as bigint) as best_permille, coalesce(lines, '') as lines
from documents d left join found using (doc_id)
"""


OP7 = r"""
with recursive split as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
shingles as (select doc_id, unnest(case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from split),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
reached as (select doc_id as d, doc_id as r from documents union select l.b, r from reached join links l on l.a = d),
components as (select d as doc_id, min(r) as component_id from reached group by d)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from components left join sizes using (doc_id)
"""


OP11 = r"""
with docs as (select doc_id, coalesce(source, '') as source, source is null as no_source, coalesce(text, '') as t, md5('806:' || coalesce(doc_id::varchar, '-') || ':' || coalesce(text, '')) as h from documents),
lines as (select *, string_split(t, chr(10)) as ls from docs),
sized as (select doc_id, source, no_source, cast(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as bigint) as size,
  greatest(length(regexp_replace(t, '\P{L}+', '', 'g'))::double / greatest(length(t), 1) * (len(list_distinct(ls))::double / len(ls)), 0.01::double) as worth,
  -ln((('0x' || substr(h, 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double) as drawn from lines),
totals as (select no_source, source, sum(size)::bigint as source_size from sized group by all),
sources as (select *, 1 + (row_number() over (order by no_source, source) - 1) % 3 as weight from totals),
-- the sources that fill up first are at their bound; the others share what these leave
filling as (select *, coalesce(sum(3 * source_size) over before, 0)::bigint as taken, sum(weight) over (order by 3 * source_size / weight::double, no_source, source rows between current row and unbounded following)::bigint as rest, sum(source_size) over ()::bigint as total,
  row_number() over (order by 3 * source_size / weight::double, no_source, source) as k from sources window before as (order by 3 * source_size / weight::double, no_source, source rows between unbounded preceding and 1 preceding)),
level as (select total - taken as left_over, rest, k from filling where 3 * source_size >= (total - taken)::double * weight / rest::double order by k limit 1),
targets as (select f.no_source, f.source, f.source_size, case when f.k < l.k then (3 * f.source_size)::double else l.left_over::double * f.weight / l.rest::double end as target from filling f, level l),
budgets as (select *, round(target)::bigint as budget, case when source_size > 0 then round(target)::bigint // source_size else 0 end as epochs from targets),
sums as (select *, coalesce(sum(size) over (partition by no_source, source order by drawn / worth, doc_id nulls first rows between unbounded preceding and 1 preceding), 0)::bigint as upto from sized)
select doc_id, case when not no_source then source end as source, size, source_size, target, epochs * size + greatest(0, least(size, budget - epochs * source_size - upto)) as taken from sums join budgets using (no_source, source)
"""


OP12 = """
with usable as (select vec_id, row_number() over () as r, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
anchors as (select * from usable where vec_id % 50 = 0),
scored as (select a.r as ar, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score from anchors a join usable b on a.r <> b.r),
positives as (select * from scored where same qualify row_number() over (partition by ar order by score desc, vec_id nulls last, r) <= 5),
ranked as (select p.anchor_id, p.vec_id as positive_id, row_number() over (partition by p.ar, p.r order by n.score desc, n.vec_id nulls last, n.r) as rank, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
  from positives p join scored n on n.ar = p.ar and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 3
"""


OP13 = r"""
with recursive crcs as (select *, doc_id::varchar as i, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295::bigint) as crc from documents),
fields as (select doc_id, lang, crc, n_chars, [case when f is null then '-' else strlen(f) || ':' || f end for f in [i, source, lang, n_chars::varchar, (n_chars::hugeint + 1)::varchar, text]] as f from crcs),
leaves as (select doc_id, lang, sha256(f[1] || f[2] || f[3] || f[4] || f[6]) as leaf, sha256(f[1] || f[2] || f[3] || case when crc % 7 = 0 then f[5] else f[4] end || f[6]) as found from fields),
rows as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n, dense_rank() over (order by lang nulls first) - 1 as tree from leaves),
nodes as (select tree, n, 0 as level, idx, leaf as digest from rows
  union all select tree, (n + 1) // 2, level + 1, idx // 2, sha256(string_agg(digest, '' order by idx)) from nodes where n > 1 group by tree, n, level, idx // 2),
subroots as (select tree as idx, digest, count(*) over () as n from nodes where n = 1),
upper_nodes as (select n, 0 as level, idx, digest from subroots
  union all select (n + 1) // 2, level + 1, idx // 2, sha256(string_agg(digest, '' order by idx)) from upper_nodes where n > 1 group by n, level, idx // 2),
steps as (select r.tree, r.idx, k.level, case when s.digest is null then 'n' when s.idx < r.idx >> k.level then 'l' else 'r' end || coalesce(s.digest, '') as step
  from rows r join (select distinct tree, level from nodes where n > 1) k using (tree) left join nodes s on s.tree = r.tree and s.level = k.level and s.idx = xor(r.idx >> k.level, 1::bigint)),
upper_steps as (select r.idx as tree, k.level, case when s.digest is null then 'n' when s.idx < r.idx >> k.level then 'l' else 'r' end || coalesce(s.digest, '') as step
  from subroots r cross join (select distinct level from upper_nodes where n > 1) k left join upper_nodes s on s.level = k.level and s.idx = xor(r.idx >> k.level, 1::bigint)),
lower_lists as (select tree, idx, list(step order by level) as steps from steps group by all),
upper_lists as (select tree, list(step order by level) as steps from upper_steps group by all),
paths as (select r.*, sr.digest as subroot, list_concat(coalesce(l.steps, []), coalesce(u.steps, [])) as steps from rows r join subroots sr on sr.idx = r.tree left join lower_lists l on l.tree = r.tree and l.idx = r.idx left join upper_lists u on u.tree = r.tree),
top as (select digest as root from upper_nodes where n = 1)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) as proof_sha256, len(steps) as n_steps,
  list_reduce(list_prepend(found, steps), lambda acc, s: sha256(case s[1] when 'l' then s[2:] || acc when 'r' then acc || s[2:] else acc end)) as folded_root, folded_root = root as verified from paths, top
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": OP3, "op4_exact_dedup": OP4, "op5_chat_windows": OP5, "op6_licence_scan": op6(), "op7_minhash_near_dedup": OP7, "op11_mix_sources": OP11, "op12_hard_negatives": OP12, "op13_merkle_manifest": OP13}

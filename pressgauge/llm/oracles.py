"""DuckDB SQL of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from pressgauge.llm.license_join import NOTICES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_RUNS = "unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' ')))))"


def _crc_of_byte(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


_CRC = [_crc_of_byte(b) for b in range(256)]
_NOTICES = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(NOTICES))

SQL: dict[str, str] = {}

SQL["op2_license_scan"] = f"""
with d as (select row_number() over () as rid, doc_id, text, {_WORDS} as w from documents),
pos as (select rid, w, unnest(range(1, len(w) + 1)) as i from d where list_contains(w, 'license')),
hit as (
  select rid, label, start from (
    select rid, 'mit' as label, i - 2 as start from pos where w[i] = 'license' and i > 1 and w[i - 1] = 'mit'
    union all
    select rid, 'apache', i - 2 from pos where w[i] = 'license' and i > 1 and w[i - 1] = 'apache'
    union all
    select rid, 'gpl', i - 3 from pos where w[i] = 'license' and i > 2 and w[i - 1] = 'public' and w[i - 2] = 'general')),
base as (select rid, count(*) as n_base, min(start) as first_word, max(start) as last_word,
         list_sort(list_distinct(list(label))) as labels from hit group by rid),
n as (select number, label, {_WORDS.replace("'[^", "'[^").replace("coalesce(text, '')", "text")} as tokens
      from (values {_NOTICES}) as t(number, label, text)),
nt as (select number, label, len(list_distinct(tokens)) as size, unnest(list_distinct(tokens)) as token from n),
lines as (select rid, unnest(string_split(coalesce(text, ''), chr(10))) as text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as line from d),
lt as (select rid, line, unnest(list_distinct({_WORDS})) as token from lines),
met as (select rid, line, number, label, size, count(*) as common from lt join nt using (token)
        group by all having count(*) >= ceil(0.8 * size - 1e-9)),
found as (select rid, list_sort(list_distinct(list(label))) as labels, max(common / size) as best, count(distinct line) as n_blocks
          from met group by rid)
select d.doc_id, len(d.w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(array_to_string(base.labels, ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') as labels,
  case when n_base > 0 then 1.0::double else coalesce(best, 0.0)::double end as score,
  coalesce(n_blocks, 0) as n_notice_blocks
from d left join base using (rid) left join found using (rid)
"""

SQL["op7_winnowing"] = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
it as (select item_id, {_WORDS} as w from benchmark),
ib as (select item_id, w, least(10, len(w)) as size from it where len(w) > 0),
iw as (select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as win
       from (select *, unnest(range(1, len(w) - size + 2)) as i from ib)),
sizes as (select distinct size from ib),
dw as (select rid, size, i, array_to_string(w[i:i + size - 1], ' ') as win
       from (select *, unnest(range(1, len(w) - size + 2)) as i from d, sizes where len(w) >= size)),
hits as (select rid, i, size, item_id from dw join iw using (size, win)),
places as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + size)) as p from hits) group by rid),
named as (select rid, list_sort(list_distinct(list(item_id::varchar))) as names from hits group by rid)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(names), 0) as n_items,
  sha256(coalesce(array_to_string(names, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (rid) left join named using (rid)
"""

SQL["op11_quadtree_divergence"] = f"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
   {_TERMS} as w from documents),
tok as (select rid, lang, source, unnest(w) as term from d),
kept as (select lang, term, count(*)::hugeint as c from tok group by all having count(distinct rid) >= 3),
v as (select lang, count(*)::hugeint as v, sum(c)::hugeint as n from kept group by all),
grp as (select distinct lang, source from d),
gc as (select lang, source, term, count(*)::hugeint as c from tok semi join kept using (lang, term) group by all),
gn as (select lang, source, sum(c)::hugeint as n from gc group by all),
cell as (select lang, source, term, coalesce(gc.c, 0) as c,
   1 + (1000000000::hugeint * (coalesce(gc.c, 0) + 1)) // (coalesce(gn.n, 0) + v.v) as p,
   1 + (1000000000::hugeint * (kept.c + 1)) // (v.n + v.v) as q
 from grp join kept using (lang) join v using (lang) left join gn using (lang, source) left join gc using (lang, source, term)),
pv as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
 from cell a join cell b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select lang, g.source, 'pair' as part, h.source as item, coalesce(pv.value, 0)::bigint as value
 from grp g join grp h using (lang) left join pv on pv.lang = lang and pv.source = g.source and pv.item = h.source where g.source <> h.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value from cell where c > 0 and p > q),
ranked as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
 from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200
"""

SQL["op12_median_resample"] = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
b as (select {_WORDS} as w from benchmark),
df as (select rid, {_RUNS} as f from d),
bf as (select {_RUNS} as f from b),
dc as (select rid, f, count(*) as n from df group by all),
names as (select distinct f from (select f from dc union all select f from bf)),
crc as (select f, xor(list_reduce(list_transform(range(0, octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::bigint),
   lambda c, x: xor(c >> 8, ({_CRC}::bigint[])[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 10000 as bucket from names),
s as (select bucket, sum(n) as s from dc join crc using (f) group by all),
t as (select bucket, count(*) as t from bf join crc using (f) group by all),
tot as (select (select coalesce(sum(s), 0) from s)::double as sa, (select coalesce(sum(t), 0) from t)::double as ta),
gain as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::double) * (sa + 10000) / ((s + 1.0::double) * (ta + 10000))))::bigint as g from s left join t using (bucket), tot),
w as (select rid, sum(n)::bigint as n_features, sum(n * g)::bigint as weight from dc join crc using (f) join gain using (bucket) group by all),
scored as (select rid, doc_id, len(d.w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
   ('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h from d left join w using (rid)),
final as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from scored),
ranked as (select rid, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from final where n_words >= 20)
select doc_id, n_features, weight, score, case when r <= 5 * n // 100 then r end as rank, n_words from final left join ranked using (rid)
"""

"""DuckDB SQL of the results that SQL can express."""

WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP7 = f"""
with d as (select doc_id, coalesce(text, '') as text, {WORDS} as w from documents),
win as (select doc_id, unnest(generate_series(1, len(w) - 2)) as i, w from d where len(w) >= 3),
win2 as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s from win),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as c from win2) where c > 1),
cov as (select doc_id, count(distinct i + j) as n from rep, (values (0), (1), (2)) o(j) group by doc_id),
lines as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from d),
stops as (select distinct s from (select unnest(string_split('{{stop}}', ' ')) as s)),
stop as (select doc_id, count(*) as n from (select doc_id, lower(unnest(w)) as x from d) where x in (select s from stops) group by doc_id),
f as (
  select d.doc_id, len(w)::bigint as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(cov.n, 0)::bigint as n_repeat_words, len(l)::bigint as n_lines,
    len(list_filter(l, lambda x: regexp_matches(trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '^[-*•]|(\\.\\.\\.|…)$')))::bigint as n_mark_lines,
    coalesce(stop.n, 0)::bigint as n_stop_words
  from d join lines using (doc_id) left join cov using (doc_id) left join stop using (doc_id)),
g as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, greatest(n_words, 1) as k, greatest(n_lines, 1) as m from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars / k between 2 and 12 and n_symbols / k <= 0.3 and n_stop_words / k >= 0.05 and n_dup_lines / m <= 0.5
    and n_mark_lines / m <= 0.9 as kept, n_lines, n_mark_lines, n_stop_words
from g
"""

LETTERS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

OP3 = f"""
with d as (select doc_id, {LETTERS} as w from documents),
b as (select coalesce(item_id::varchar, 'null') as item, {LETTERS} as w from benchmark),
bw as (select distinct item, least(len(w), 13) as m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as s
  from (select item, w, unnest(generate_series(1, greatest(len(w) - 13, 0) + 1)) as i from b where len(w) > 0)),
dw as (select doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') as s
  from (select doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) as i from d, (select distinct m from bw) where len(w) >= m)),
hit as (select doc_id, i, m, item from dw join bw using (m, s)),
words as (select doc_id, count(*) as n from (select distinct doc_id, unnest(generate_series(i, i + m - 1)) as p from hit) group by 1),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as s from (select distinct doc_id, item from hit) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(words.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items, sha256(coalesce(items.s, '')) as items_sha256,
  coalesce(words.n, 0) > 0 and 20 * coalesce(words.n, 0) >= len(w) as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

OP8 = f"""
with d as (select doc_id, {WORDS} as w from documents),
win as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as s from (select doc_id, w, unnest(generate_series(1, len(w) - 49)) as i from d where len(w) >= 50)),
hit as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by s) as least from win) where least < doc_id),
gone as (select doc_id, list(distinct p) as p from (select doc_id, unnest(generate_series(i, i + 49)) as p from hit) group by 1),
runs as (select doc_id, count(*) filter (before is null or i > before + 50) as n from (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from hit) group by 1),
left_ as (select doc_id, list(x order by i) as kept from (select doc_id, unnest(w) as x, unnest(generate_series(1, len(w))) as i from d) anti join
  (select doc_id, unnest(p) as i from gone) using (doc_id, i) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(len(p), 0)::bigint as n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256, coalesce(runs.n, 0)::bigint as n_spans
from d left join gone using (doc_id) left join runs using (doc_id) left join left_ using (doc_id)
"""

OP9 = f"""
with d as (select doc_id, {LETTERS} as w from documents),
-- base: the words of a phrase, one after the other
p as (select label, {LETTERS} as w from (values {{phrases}}) v(label, text)),
place as (select doc_id, label, unnest(list_filter(generate_series(1, len(d.w) - len(p.w) + 1), lambda i: d.w[i:i + len(p.w) - 1] = p.w)) - 1 as i
  from d, p where len(d.w) >= len(p.w) and list_has_all(d.w, p.w)),
base as (select doc_id, count(*) as n_base, min(i) as first_word, max(i) as last_word, string_agg(distinct label, ',' order by label) as base_labels, list(distinct label) as l from place group by 1),
-- spans: three words in a row that a notice has as well, on diagonals at most three apart
t as (select tid, label, {LETTERS} as w from (values {{templates}}) v(tid, label, text)),
tg as (select tid, label, len(w) - 2 as m, unnest(generate_series(0, len(w) - 3)) as t, w from t),
tn as (select tid, label, m, t, w[t + 1:t + 3] as g, exists (select 1 from (values {{needed}}) n(label, g) where n.label = tg.label and n.g = array_to_string(w[t + 1:t + 3], ' ')) as need from tg),
dg as (select doc_id, i, w[i + 1:i + 3] as g from (select doc_id, w, unnest(generate_series(0, len(w) - 3)) as i from d where len(w) > 2)),
hit as (select doc_id, tid, label, m, i, t, i - t as d, need from dg join tn using (g)),
diagonal as (select *, d - lag(d) over (partition by doc_id, tid order by d) > 3 as cut from (select distinct doc_id, tid, d from hit)),
part as (select doc_id, tid, d, count(*) filter (cut) over (partition by doc_id, tid order by d) as part from diagonal),
span as (select doc_id, tid, label, m, part, list({{'i': i, 't': t}} order by i, t) as h, min(i) as a, max(i) + 3 as b, count(distinct t) filter (need) as met from hit join part using (doc_id, tid, d) group by all),
-- the longest chain that ascends in both, hit by hit
chain as (select *, list_max(list_reduce(list_transform(range(1, len(h) + 1), lambda k: [k]), lambda best, e: list_append(best,
  1 + coalesce(list_max(list_transform(list_filter(range(1, e[1]), lambda j: h[j].i < h[e[1]].i and h[j].t < h[e[1]].t), lambda j: best[j])), 0)), []::bigint[])) / m as cover from span),
sure as (select * from chain where cover >= 0.6 and met = (select count(*) from tn where tn.tid = chain.tid and need)),
good as (select * from sure x where not exists (select 1 from sure y where y.doc_id is not distinct from x.doc_id and y.tid <> x.tid and y.a < x.b and x.a < y.b
  and (y.cover > x.cover or y.cover = x.cover and (y.m > x.m or y.m = x.m and y.tid < x.tid)))),
labelled as (select doc_id, list(distinct label) as l, count(*) as n_spans from good group by 1),
best as (select doc_id, max(cover) as cover from chain group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(labelled.l, [])))), ',') as labels,
  (case when n_base > 0 then 1 else coalesce(cover, 0) end)::double as score, coalesce(n_spans, 0)::bigint as n_spans
from d left join base using (doc_id) left join labelled using (doc_id) left join best using (doc_id)
"""


def op9(phrases: dict[str, str], templates: list[tuple[str, str]], needed: dict[str, tuple[str, ...]]) -> str:
    quoted = lambda *x: "(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in x) + ")"
    parts = {
        "{phrases}": [quoted(label, text) for text, label in phrases.items()], "{templates}": [quoted(i + len(phrases), *x) for i, x in enumerate(templates)],
        "{needed}": [quoted(label, g) for label, own in needed.items() for g in own],
    }
    out = OP9
    for name, rows in parts.items():
        out = out.replace(name, ", ".join(rows))
    return out

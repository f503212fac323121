"""SQL of the queries of this package that DuckDB can express."""

from __future__ import annotations

UNIFORM = "cast(('0x' || substr(md5({}), 1, 13))::bigint as double) / 4503599627370496.0"

MIX = f"""
with counts as (select source, count(*) as n from documents group by source),
whole as (select sum(pow(n, 0.5)) as all_weight, sum(n) as all_n from counts),
rates as (select source, pow(n, 0.5) / all_weight * all_n / n as rate from counts, whole),
parts as (select source, rate, greatest(1, ceil(rate / 32.0))::int as parts from rates),
logs as (select k, coalesce(sum(ln(k)) over (order by k rows between unbounded preceding and current row), 0) as lf
         from (select unnest(generate_series(1, 128)) as k)),
terms as (select source, 0 as k, exp(-rate / parts) as term from parts
          union all select source, k, exp(-rate / parts + k * ln(rate / parts) - lf) from parts, logs),
cdf as (select source, k, sum(term) over (partition by source order by k) as p from terms),
draws as (select doc_id, source, {UNIFORM.format("'7:' || doc_id || ':' || j")} as u
          from (select d.doc_id, d.source, unnest(generate_series(1, p.parts)) as j
                from documents d join parts p on d.source is not distinct from p.source)),
counted as (select doc_id, source, sum((select count(*) from cdf c
                                        where c.source is not distinct from d.source and c.p <= d.u)) as n
            from draws d group by doc_id, source),
copies as (select doc_id, source, unnest(generate_series(1, n::bigint)) as copy from counted)
select c.doc_id, c.source, cast(c.copy as int) as copy,
       ('0x' || substr(md5('7:order:' || c.doc_id || ':' || c.copy), 1, 13))::bigint as shuffle_key,
       md5(d.text) as text_md5
from copies c join documents d using (doc_id)
"""


def _shingles(table: str, key: str) -> str:
    return f"""(with words as (select {key}, list_filter(regexp_split_to_array(
        lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
        from {table})
      select distinct {key}, s from (select {key}, unnest(case when len(w) >= 5
        then list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
        when len(w) > 0 then [array_to_string(w, ' ') || ' (short)'] else [] end) as s from words))"""


CONTAINED = f"""
with d as materialized {_shingles("documents", "doc_id")},
b as materialized {_shingles("benchmark", "item_id")},
q as (select item_id, count(*) as n_item from b group by item_id)
select doc_id, item_id, count(*) as n_shared, any_value(n_item)::int as n_item
from d join b using (s) join q using (item_id)
group by doc_id, item_id having count(*) * 100 >= any_value(n_item) * 75
"""

URLS = """
with captures as (select page_id, url, (date '2020-01-01' + (page_id * 7919 % 1461)::int)::date as fetched_on from pages),
sites as (select distinct regexp_extract(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '([^.]+[.][^.]+[.][^.]+)$', 1) as site from pages),
hashed as (select site, ('0x' || substr(md5(site), 1, 6))::int as h from sites where site <> ''),
listed as (select *, (date '2019-12-01' + h % 997)::date as since from hashed where h % 3 = 0 or regexp_matches(site, '(spam|adult|bets)')),
entries as (select site as pattern, since as listed_on, 'block' as verdict from listed
    union all select site, (since + 90 + h % 300)::date, 'allow' from listed where h % 2 = 0
    union all select site, (since + 500 + h % 300)::date, 'block' from listed where h % 4 = 0
    union all select site || '/en', (since + 30)::date, 'allow' from listed where h % 5 < 2
    union all select site || '/de', (since - 60)::date, 'block' from listed where h % 7 < 3),
daily as (select pattern, listed_on, max(verdict) as verdict from entries group by all),
spans as (select *, lead(listed_on) over (partition by pattern order by listed_on) as until from daily),
parsed as (select *, string_split(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)', 1)),
        '^.*@|:[0-9]*$', '', 'g'), '.') as h,
    list_filter(string_split(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)', 2)), '/'), lambda x: x <> '') as s from captures),
looked as (select page_id, url, fetched_on, unnest(list_concat(
        list_transform(generate_series(1, len(h)), lambda i: array_to_string(h[i:], '.')),
        list_transform(generate_series(1, len(s)), lambda j: array_to_string(h, '.') || '/' || array_to_string(s[1:j], '/')))) as pattern from parsed),
met as (select l.*, p.listed_on, p.verdict, row_number() over (partition by page_id
        order by contains(pattern, '/') desc, length(pattern) desc, pattern desc) as place
    from looked l join spans p using (pattern) where p.listed_on <= fetched_on and (until is null or fetched_on < until))
select c.page_id, c.url, c.fetched_on::varchar as fetched_on, m.verdict, m.pattern, m.listed_on::varchar as listed_on
from captures c left join met m on c.page_id = m.page_id and m.place = 1
"""

RESAMPLE = r"""
with recursive bits as (select b::bigint as b, b::bigint as v, 0 as k from range(256) t(b)
    union all select b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from bits where k < 8),
one as materialized (select b, v from bits where k = 8),
texts as (select 'd' as side, doc_id, text from documents union all select 'b', null, text from benchmark),
worded as (select side, doc_id, case when text is null then [] else regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') end as w from texts),
listed as (select side, doc_id, len(w) as n_words, list_concat(w, list_transform(
        generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) as f from worded),
counted as materialized (select side, doc_id, f, count(*) as n from (select side, doc_id, unnest(f) as f from listed) group by all),
spans as materialized (select f, octet_length(encode(f)) as size, hex(encode(f)) as h from (select distinct f from counted)),
shares as (select 0 as d, b, v from one
    union all select s.d + 1, s.b, xor(s.v >> 8, o.v) from shares s join one o on o.b = s.v & 255 where s.d + 1 < (select max(size) from spans)),
zeros as (select 0 as size, 4294967295::bigint as v
    union all select z.size + 1, xor(z.v >> 8, o.v) from zeros z join one o on o.b = z.v & 255 where z.size < (select max(size) from spans)),
bytes as (select f, size, i, ('0x' || substr(h, 2 * i + 1, 2))::bigint as b from (select *, unnest(generate_series(0, size - 1)) as i from spans)),
raw as (select f, any_value(y.size) as size, bit_xor(s.v) as v from bytes y join shares s on s.d = y.size - 1 - y.i and s.b = y.b group by f),
hashed as materialized (select f, xor(xor(raw.v, z.v), 4294967295) % 10000 as bucket from raw join zeros z on z.size = raw.size),
met as materialized (select c.side, c.doc_id, c.n, h.bucket from counted c join hashed h using (f)),
sums as (select bucket, sum(n) filter (where side = 'd') as s, sum(n) filter (where side = 'b') as t from met group by bucket),
whole as (select coalesce(sum(s), 0) as s, coalesce(sum(t), 0) as t from sums),
gain as (select bucket, floor(1000 * ln((coalesce(sums.t, 0) + 1)::double * (whole.s + 10000)::double
        / ((coalesce(sums.s, 0) + 1)::double * (whole.t + 10000)::double)))::bigint as g from sums, whole),
weights as (select doc_id, floor(sum(n * g)::double / sum(n))::bigint as weight from met join gain using (bucket) where side = 'd' group by doc_id),
scored as (select l.doc_id, l.n_words, len(l.f)::bigint as n_features, coalesce(w.weight, 0) as weight, coalesce(w.weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('7:' || l.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
    from listed l left join weights w on w.doc_id = l.doc_id where l.side = 'd'),
ranked as (select *, case when n_words >= 20 then row_number() over (partition by n_words >= 20 order by score desc, doc_id) end as r,
        count(*) filter (where n_words >= 20) over () * 25 // 100 as drawn from scored)
select doc_id, n_features, weight, score, case when r <= drawn then r end as rank from ranked
"""

REPEATS = """
with d as materialized (select doc_id, encode(coalesce(text, '')) as b, octet_length(encode(coalesce(text, ''))) as n from documents),
w as materialized (select doc_id, i, b[i + 1:i + 50] as s from (select *, unnest(generate_series(0, n - 50)) as i from d where n >= 50)),
least as (select s, min(doc_id) as first_doc from w group by s),
hit as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) as step from w join least using (s) where first_doc < doc_id),
runs as (select doc_id, min(i) as a, max(i) + 50 as z from (select *, sum(case when step <= 50 then 0 else 1 end) over (
    partition by doc_id order by i) as run from hit) group by doc_id, run),
edges as (select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as before from runs),
parts as (select e.doc_id, e.a, hex(b[e.before + 1:e.a]) as h from edges e join d using (doc_id)
    union all select d.doc_id, n, hex(b[coalesce(z, 0) + 1:n]) from d left join (select doc_id, max(z) as z from runs group by doc_id) using (doc_id)),
kept as (select doc_id, string_agg(h, '' order by a) as h from parts group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(h)) as kept_sha256
from d join kept using (doc_id) left join (select doc_id, sum(z - a) as n_removed, count(*) as n_spans from runs group by doc_id) using (doc_id)
"""

SQL = {"op13_column_suffixes": REPEATS, "op11_position_crc": RESAMPLE, "op9_temporal_lists": URLS, "op4_poisson_mix": MIX, "op10_containment": CONTAINED}

"""DuckDB statements of the registered queries that SQL can express."""

from __future__ import annotations

# Windows are compared as word lists; hits are counted from the distinct places that they cover.
DECONTAMINATION = r"""
with w as (
  select doc_id, row_number() over () r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
i as (
  select coalesce(cast(item_id as varchar), '') item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark),
win as (
  select distinct item, array_to_string(ws[p:p + 9], ' ') k, least(10, len(ws)) n
  from (select item, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) p from i where len(ws) > 0)),
sizes as (select distinct n from win),
places as (
  select r, p, n, array_to_string(ws[p:p + n - 1], ' ') k
  from (select r, ws, n, unnest(generate_series(1, len(ws) - n + 1)) p from w, sizes where len(ws) >= n)),
hits as (select r, p, win.n, item from places join win on places.k = win.k and places.n = win.n),
covered as (select r, count(distinct q) n_hit from (select r, unnest(generate_series(p, p + n - 1)) q from hits) group by r),
items as (select r, count(distinct item) n_items, string_agg(distinct item, ',' order by item) l from hits group by r)
select doc_id, cast(len(ws) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from w left join covered using (r) left join items using (r)
"""


# Base32 reads the 40 hex digits in eight groups of five, each four letters of five bits.
WARC = """
with p as (
  select page_id, strlen(coalesce(html, '')) payload_bytes, sha1(coalesce(html, '')) h from pages),
d as (
  select page_id, payload_bytes, array_to_string(list_transform(generate_series(0, 31), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      cast(1 + ((cast('0x' || substr(h, cast(5 * (i // 4) + 1 as bigint), 5) as bigint) >> cast(15 - 5 * (i % 4) as int)) & 31) as bigint),
      1)), '') payload_digest
  from p),
m as (select *, max(page_id) over (partition by payload_digest, payload_bytes) head from d)
select page_id, payload_bytes, payload_digest,
  case when page_id = head then 'response' else 'revisit' end record_type,
  case when page_id = head then null else head end refers_to
from m
"""


def _mixing(sweeps: int = 12) -> str:
    steps, last = [], "goals"
    for sweep in range(sweeps):
        for d in ("source", "lang", "topic"):
            name = f"s{sweep}_{d}"
            steps.append(
                f"{name} as materialized (select * replace (case when sum(weight) over (partition by {d}) > 0 "
                f"then weight * goal_{d} / sum(weight) over (partition by {d}) else 0 end as weight) from {last})"
            )
            last = name
    margin = lambda d, t: f"pow(sum(tokens) over (partition by {d}), {t})"
    return rf"""
with recursive d as (
  select doc_id, source, lang,
    case when contains(text, ' | ') then 'table' when contains(lower(text), 'licen') then 'notice'
      when length(text) >= 4000 then 'long prose' when length(text) >= 800 then 'prose' else 'short' end topic,
    cast(coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) as bigint) n_tokens
  from documents),
cells as materialized (
  select source, lang, topic, cast(sum(n_tokens) as double) tokens from d group by all having sum(n_tokens) > 0),
raised as materialized (
  select *, {margin("source", 0.5)} rs, {margin("lang", 0.7)} rl, {margin("topic", 0.7)} rt,
    count(*) over (partition by source) cs, count(*) over (partition by lang) cl,
    count(*) over (partition by topic) ct, sum(tokens) over () total from cells),
goals as materialized (
  select source, lang, topic, tokens, tokens weight, rs / sum(rs / cs) over () * total goal_source,
    rl / sum(rl / cl) over () * total goal_lang, rt / sum(rt / ct) over () * total goal_topic from raised),
{", ".join(steps)},
chances as (select *, weight / tokens / max(weight / tokens) over () chance from {last}),
drawn as (
  select d.*, case when n_tokens > 0 then coalesce(chance, 0) else 0 end probability
  from d left join chances c on d.source is not distinct from c.source and d.lang is not distinct from c.lang
    and d.topic is not distinct from c.topic)
select doc_id, source, lang, topic, n_tokens, round(probability, 6) probability,
  cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '/mix-1'), 1, 12) as bigint) / 281474976710656.0
    < probability kept
from drawn
"""


# crc32 in SQL: a table of 256 remainders, then one step for each byte.
CRC_TABLE = """
crc_table as materialized (
  select list(v order by x) remainders from (
    select x, list_reduce([x::ubigint] || list_transform(generate_series(1, 8), lambda i: i::ubigint),
      lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) v
    from range(256) r(x)))"""


def _crc(text: str) -> str:
    """crc32 of a text column, beside crc_table."""
    octets = (
        f"list_transform(generate_series(1, strlen({text})), "
        f"lambda i: ('0x' || substr(hex({text}), cast(2 * i - 1 as bigint), 2))::ubigint)"
    )
    return (
        f"xor(list_reduce([4294967295::ubigint] || {octets}, "
        f"lambda c, b: xor(c >> 8, remainders[cast(xor(c, b) % 256 as bigint) + 1])), 4294967295::ubigint)"
    )


IMPORTANCE = rf"""
with {CRC_TABLE},
d as (
  select doc_id, row_number() over () r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
b as (
  select unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) w from benchmark),
dw as materialized (select r, w, count(*) n from (select r, unnest(ws) w from d) group by all),
words as (select w, sum(s) s, sum(t) t from (
  select w, n s, 0 t from dw union all select w, 0, 1 from b) group by w),
hashed as materialized (select w, s, t, cast({_crc("w")} as bigint) % 10000 bucket from words, crc_table),
sums as (select bucket, sum(s)::double s, sum(t)::double t from hashed group by bucket),
whole as (select sum(s)::double s, sum(t)::double t from hashed),
gains as (
  select bucket, cast(floor(1000 * ln((sums.t + 1) * (whole.s + 10000) / ((sums.s + 1) * (whole.t + 10000)))) as bigint) gain
  from sums, whole),
sum_of as (select r, sum(n * gain) g from dw join hashed using (w) join gains using (bucket) group by r),
weighed as (
  select doc_id, cast(len(ws) as bigint) n_features,
    case when len(ws) = 0 then 0 else (cast(g as bigint) - ((cast(g as bigint) % len(ws)) + len(ws)) % len(ws)) // len(ws) end weight,
    ('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8))::bigint h
  from d left join sum_of using (r)),
scored as (
  select doc_id, n_features, cast(weight as bigint) weight,
    cast(weight as bigint) + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0))) as bigint) score from weighed),
ranked as (
  select *, row_number() over (order by n_features >= 20 desc, score desc, doc_id nulls last, n_features, weight) k,
    count(*) filter (n_features >= 20) over () fit from scored)
select doc_id, n_features, weight, score, case when n_features >= 20 and k <= 10 * fit // 100 then k end "rank"
from ranked
"""


# Places where a word is the one p words on are grouped to stretches; one of n places is n + p words long.
PERIODIC = rf"""
with {CRC_TABLE},
d as (select doc_id, row_number() over () r, coalesce(cast(doc_id as varchar), '') k,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
hashed as materialized (select doc_id, r, ws, len(ws) n, case when k = '' then 0 else cast({_crc("k")} as bigint) end h from d, crc_table),
places as (select *, (h // 10) % n a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) p from hashed where n > 0),
edited as (select r, n, case when h % 10 = 0
  then list_transform(generate_series(0, n - 1), lambda i: ws[cast(1 + case when i < a then i else a + (i - a) % p end as bigint)])
  else ws end ws from places),
words as materialized (select r, n, unnest(generate_series(0, n - 1)) i, unnest(ws) w from edited),
same as (
  select x.r, y.i - x.i p, x.i from words x join words y on x.r = y.r and x.w = y.w and y.i > x.i and 4 * (y.i - x.i) <= x.n),
stretches as (
  select r, p, min(i) start, count(*) + p length
  from (select r, p, i, i - row_number() over (partition by r, p order by i) g from same) group by r, p, g),
runs as materialized (
  select r, start, length, min(p) period from stretches where length >= greatest(6, 4 * p) group by all),
lists as (
  select r, count(*) n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) l
  from runs group by r),
best as (
  select r, start, length, period, 1000 * length // period exponent_milli from runs
  qualify row_number() over (partition by r order by length / period desc, start, period) = 1),
gone as (select distinct r, unnest(generate_series(start + period, start + length - 1)) i from runs),
kept as (select r, string_agg(w, ' ' order by i) t from words anti join gone using (r, i) group by r)
select doc_id, coalesce(n_runs, 0) n_runs, start, length, period, cast(exponent_milli as bigint) exponent_milli,
  sha256(coalesce(l, '')) runs_sha256, sha256(coalesce(t, '')) collapsed_sha256
from d left join lists using (r) left join best using (r) left join kept using (r)
"""


ORACLES: dict[str, str] = {
    "op6_target_mixing": _mixing(),
    "op9_warc_normaliser": WARC,
    "op8_benchmark_decontamination": DECONTAMINATION,
    "op11_periodic_runs": PERIODIC,
    "op13_importance_resampling": IMPORTANCE,
}

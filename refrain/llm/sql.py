"""DuckDB twins of the queries that SQL can state."""

from __future__ import annotations

from refrain.llm.quality_rules import MIN_WORDS, STOP_WORDS, THRESHOLDS

ORACLE: dict[str, str] = {}

ORACLE["op1_url_filters"] = r"""
with parts as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
judged as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
    when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
    when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
  from parts)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
from judged
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_BOUNDS = " and ".join(
    f"100 * {t.part} {'>=' if side == 'least' else '<='} {bound} * {t.whole}"
    for t in THRESHOLDS
    for side, bound in (("least", t.least), ("most", t.most))
    if bound is not None
)

ORACLE["op6_quality_rules"] = rf"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, {_WORDS} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from base)),
twice as (select r, g from windows group by r, g having count(*) > 1),
covered as (
  select r, count(distinct p) as n
  from (select r, unnest([i, i + 1, i + 2]) as p from windows join twice using (r, g)) group by r),
counts as (
  select doc_id, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(length(text) - length(replace(text, '!', '')) as bigint) as n_marks,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(len(l) as bigint) as n_lines,
         cast(len(list_filter(w, lambda x: x in ({_STOP}))) as bigint) as n_stop_words,
         cast(coalesce(n, 0) as bigint) as n_repeat_words
  from base left join covered using (r))
select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words) and {_BOUNDS} as kept
from counts
"""

ORACLE["op3_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, sha256(html) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes < 100 or page_id is not distinct from first then 'response' else 'revisit' end as record_type,
       case when payload_bytes < 100 or page_id is not distinct from first then null else first end as refers_to,
       true as complete
from f
"""


# Words, pieces and phrases by windows over unnested words; scores in 128-bit integers.
ORACLE["op11_collocations"] = r"""
with texts as (
  select row_number() over () as row_no, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
pieces as (
  select row_no, lang, unnest(p) as piece, unnest(range(len(p))) as piece_no
  from (select row_no, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') as p from texts)),
words as (
  select row_no, lang, piece_no, unnest(w) as w1, unnest(range(len(w))) as pos
  from (select row_no, lang, piece_no, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces)),
placed as (
  select lang, w1, lead(w1, 1) over one as w2, lead(w1, 2) over one as w3
  from words window one as (partition by row_no, piece_no order by pos)),
f1 as (select lang, w1, count(*) as f from placed group by all),
f2 as (select lang, w1, w2, count(*) as f from placed where w2 is not null group by all having count(*) >= 10),
f3 as (select lang, w1, w2, w3, count(*) as f from placed where w3 is not null group by all having count(*) >= 10),
longer as (
  select lang, w1, w2, max(f) as f
  from (select lang, w1, w2, f from f3 union all select lang, w2, w3, f from f3) group by all),
cuts as (
  select p.lang, p.w1 || ' ' || p.w2 as phrase, p.f as a, a.f as l, b.f as r, 1 as k
  from f2 p join f1 a on a.lang = p.lang and a.w1 = p.w1 join f1 b on b.lang = p.lang and b.w1 = p.w2
  left join longer x on x.lang = p.lang and x.w1 = p.w1 and x.w2 = p.w2
  where x.f is null or 100 * x.f < 50 * p.f
  union all
  select p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, a.f, b.f, 1
  from f3 p join f1 a on a.lang = p.lang and a.w1 = p.w1 join f2 b on b.lang = p.lang and b.w1 = p.w2 and b.w2 = p.w3
  union all
  select p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, a.f, b.f, 2
  from f3 p join f2 a on a.lang = p.lang and a.w1 = p.w1 and a.w2 = p.w2 join f1 b on b.lang = p.lang and b.w1 = p.w3),
scored as (select *, ((1000000::hugeint * a * a) // (l::hugeint * r))::bigint as score from cuts),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best),
totals as (select lang, sum(f)::bigint as n from f1 group by all)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""


def _periodic_runs_sql(classes: int = 14) -> str:
    """Lag classes as window functions over hashed grams; they cover lags below ``2 ** classes``.

    Places whose gram recurs one lag further lie in a row along a run, so that islands of them are its stretches.
    """
    grams, pairs, size = [], [], 6
    for k in range(classes):
        low = 1 << k
        if k == 0:
            grams.append("g0 as materialized (select row_no, pos, hash(h, lead(h, 2) over w) as h, 5 as size, lead(h, 2) over w is not null as whole from three window w as (partition by row_no order by pos))")
        else:
            before, ahead = ("three", 3) if k == 1 else (f"g{k - 1}x", size // 2)
            name = f"g{k}x"
            grams.append(
                f"{name} as materialized (select row_no, pos, hash(h, lead(h, {ahead}) over w) as h, "
                f"whole and coalesce(lead(whole, {ahead}) over w, false) as whole from {before} window w as (partition by row_no order by pos))"
            )
            grams.append(f"g{k} as (select row_no, pos, h, {size} as size, whole from {name})")
            size *= 2
        pairs.append(
            f"select row_no, pos, size, lag from (select *, lead(pos) over (partition by row_no, h order by pos) - pos as lag "
            f"from g{k} where whole) where lag >= {low} and lag < {2 * low}"
        )
    return rf"""
with hashed as (
  select row_number() over () as row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint),
             lambda c, b: list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(c, b)),
             4294967295::bigint), 4294967295::bigint) as h
  from documents),
shaped as (
  select *, len(w) as n, h // 10 as g, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from hashed),
planted as (
  select row_no, doc_id, case when a is null then w else
           list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) end as w
  from shaped),
tokens as materialized (select row_no, unnest(w) as word, unnest(range(len(w))) as pos from planted),
three as materialized (
  select row_no, pos, hash(word, lead(word, 1) over w, lead(word, 2) over w) as h, lead(word, 2) over w is not null as whole
  from tokens window w as (partition by row_no order by pos)),
{", ".join(grams)},
seeds as ({" union all ".join(pairs)}),
islands as (select *, pos - row_number() over (partition by row_no, lag order by pos) as island from seeds),
runs as materialized (
  select row_no, min(pos) as start, max(pos) + any_value(size) + lag - min(pos) as length, lag as period
  from islands group by row_no, lag, island having max(pos) + any_value(size) + lag - min(pos) >= greatest(6, 4 * lag)),
dropped as (select distinct row_no, unnest(range(start + period, start + length)) as pos from runs),
collapsed as (
  select row_no, string_agg(word, ' ' order by pos) as text from tokens anti join dropped using (row_no, pos) group by row_no),
listed as (
  select row_no, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
         arg_min(struct_pack(s := start, l := length, p := period), struct_pack(l := -length, s := start, p := period)) as best
  from runs group by row_no)
select doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, best.l as length, best.p as period,
       (1000 * best.l) // best.p as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
       sha256(coalesce(collapsed.text, '')) as collapsed_sha256
from planted left join listed using (row_no) left join collapsed using (row_no)
"""


ORACLE["op12_periodic_runs"] = _periodic_runs_sql()

"""English stems in SQL: the steps of the algorithm as regular expressions over the distinct words.

Written apart from the library's function, so that each checks the other.
"""

from __future__ import annotations

from refrain.functions import stemming

REGION = "'^[^aeiouy]*[aeiouy]+[^aeiouy]'"
SHORT = "'([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$'"


def _any(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _case(of: str, pairs, default: str) -> str:
    return f"case {of} " + " ".join(f"when '{a}' then '{b}'" for a, b in pairs) + f" else {default} end"


def stems(words: str) -> str:
    """``(word, stem)`` of a relation with a column ``word``."""
    first = "|".join(s for s, *_ in stemming.SUFFIXES)
    second = "|".join(s for s, _ in stemming.SECOND_SUFFIXES)
    last = "|".join(stemming.LAST_SUFFIXES)
    after = " or ".join(
        f"(e = '{s}' and left(w, length(w) - length(e)) not similar to '.*[{letters}]')" for s, _, letters in stemming.SUFFIXES if letters
    )
    starts = "|".join(stemming.REGION_STARTS)
    return f"""
      with w0 as (select distinct word from ({words})),
      w1 as (select word, regexp_replace(regexp_replace(regexp_replace(regexp_replace(word, '^''', ''), '^y', 'Y'),
                '([aeiouy])y', '\\1Y', 'g'), '([aeiouy])y', '\\1Y', 'g') as w from w0),
      w2 as (select *, case when regexp_matches(w, '^({starts})') then length(regexp_extract(w, '^({starts})'))
                       when regexp_matches(w, {REGION}) then length(regexp_extract(w, {REGION})) else length(w) end as r1 from w1),
      w3 as (select *, case when regexp_matches(substr(w, r1 + 1), {REGION})
                       then r1 + length(regexp_extract(substr(w, r1 + 1), {REGION})) else length(w) end as r2 from w2),
      w4 as (select * replace (regexp_replace(w, '(''s''|''s|'')$', '') as w) from w3),
      w5 as (select * replace (case when w like '%sses' then left(w, -2)
                when w like '%ied' or w like '%ies' then left(w, case when length(w) > 4 then -2 else -1 end)
                when w like '%s' and not (w like '%us' or w like '%ss') and regexp_matches(left(w, -2), '[aeiouy]') then left(w, -1)
                else w end as w) from w4),
      w6 as (select *, w in ({_any(stemming.KEPT_AFTER_PLURAL)}) as kept, regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$') as e from w5),
      w7 as (select *, left(w, length(w) - length(e)) as rest from w6),
      w8 as (select * replace (case when kept or e = '' then w
                when e like 'eed%' then case when length(rest) >= r1 then rest || 'ee' else w end
                when not regexp_matches(rest, '[aeiouy]') then w
                when regexp_matches(rest, '(at|bl|iz)$') then rest || 'e'
                when right(rest, 2) in ({_any(stemming.DOUBLES)}) then left(rest, -1)
                when r1 >= length(rest) and regexp_matches(rest, {SHORT}) then rest || 'e' else rest end as w) from w7),
      w9 as (select * replace (case when not kept and regexp_matches(w, '^.+[^aeiouy][yY]$') then left(w, -1) || 'i' else w end as w) from w8),
      w10 as (select * replace (regexp_extract(w, '({first})$') as e) from w9),
      w11 as (select * replace (case when kept or e = '' or length(w) - length(e) < r1 or {after} then w
                else left(w, length(w) - length(e)) || {_case("e", [(a, b) for a, b, _ in stemming.SUFFIXES], "e")} end as w) from w10),
      w12 as (select * replace (regexp_extract(w, '({second})$') as e) from w11),
      w13 as (select * replace (case when kept or e = '' or length(w) - length(e) < (case when e = 'ative' then r2 else r1 end) then w
                else left(w, length(w) - length(e)) || {_case("e", stemming.SECOND_SUFFIXES, "e")} end as w) from w12),
      w14 as (select * replace (regexp_extract(w, '({last})$') as e) from w13),
      w15 as (select * replace (case when kept or e = '' or length(w) - length(e) < r2
                or (e = 'ion' and not regexp_matches(w, '[st]ion$')) then w else left(w, length(w) - length(e)) end as w) from w14),
      w16 as (select * replace (case when kept then w
                when w like '%e' and (length(w) > r2 or (length(w) > r1 and not regexp_matches(left(w, -1), {SHORT}))) then left(w, -1)
                when w like '%ll' and length(w) > r2 then left(w, -1) else w end as w) from w15)
      select word, case when length(word) <= 2 then word else {_case("word", stemming.EXCEPTIONS.items(), "replace(w, 'Y', 'y')")} end as stem
      from w16"""

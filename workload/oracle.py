"""The SQL twin of each query, for DuckDB on the same tables."""

from __future__ import annotations

import re

from refrain import fixed
from refrain.functions.text import TOKEN
from workload.stems_sql import stems
from workload.views import BETWEEN, GENRE_OF_DIGIT, STOP


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def _words(col: str) -> str:
    return f"regexp_extract_all(lower(replace({col}, '’', '''')), {_q(TOKEN)})"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _flag(name: str, pattern: str | None, written: str | None, needle: str) -> str:
    text = "genre" if pattern is None else f"regexp_replace(genre, {_q(pattern)}, {_q(written)}, 'g')"
    return f"cast(coalesce(regexp_matches({text}, {_q(needle)}), false) as int) as {name}"


def _chain(col: str, steps) -> str:
    for pattern, replacement in steps:
        col = f"regexp_replace({col}, {_q(pattern)}, {_q(replacement)}, 'g')"
    return col


def _aliased(col: str, aliases) -> str:
    return _chain(col, aliases)


def _key(col: str) -> str:
    return f"lower(regexp_replace({col}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"


def _replaced(col: str, aliases) -> str:
    for text, replacement in aliases:
        col = f"replace({col}, {_q(text)}, {_q(replacement)})"
    return col


def _picked(values, number: str) -> str:
    return f"list_extract([{', '.join(_q(v) for v in values)}], cast({number} % {len(values)} as int) + 1)"


def _artist(col: str, branches=tuple(fixed.ARTIST_BRANCHES)) -> str:
    branches = " ".join(
        f"when regexp_matches({col}, {_q(test)}) then {_key(f'regexp_replace({col}, {_q(cut)}, {_q(str())}, {_q(chr(103))})')}"
        for test, cut in branches
    )
    return f"translate(case {branches} else lower({col}) end, {_q(fixed.ARTIST_STRIP)}, '')"


# The escapes of the test pages.
ENTITIES = [("&quot;?", '"'), ("&#x27;?", "'"), ("&lt;?", "<"), ("&gt;?", ">"), ("&amp;?", "&")]

DECADE = (
    "case "
    + " ".join(f"when year between {a} and {b} then '{n}'" for n, a, b in fixed.DECADES)
    + f" else '{fixed.DECADE_ELSE}' end"
)
GENRE_CASE = (
    "case cast(doc_id % 10 as int) "
    + " ".join(f"when {i} then '{g}'" for i, g in enumerate(GENRE_OF_DIGIT[:-1]))
    + f" else '{GENRE_OF_DIGIT[-1]}' end"
)
FLAGS = ", ".join(fixed.GENRES)
FLAGS_ALL = FLAGS + ", others"


def _long(source: str, flags: list[str], name: str) -> str:
    """Unpivot flags with UNION ALL."""
    return " union all ".join(f"select *, '{f}' as {name} from {source} where {f} = 1" for f in flags)


# Views used by the queries; each may read the ones before it.
VIEWS = {
    "stop": f"select unnest([{', '.join(_q(w) for w in STOP)}]) as word",
    "songs": f"""
        select doc_id as lyrics_id, cast(1968 + doc_id % 50 as int) as year,
               cast(1 + (doc_id // 50) % 100 as int) as rank, source as singer, lang,
               array_to_string(words[1:3], ' ') as song_name, text as lyrics, {GENRE_CASE} as genre, words
        from (select *, {_words("text")} as words from documents)""",
    "dated": f"select *, {DECADE} as decade from songs",
    "flag20": f"select *, {', '.join(_flag(*rule) for rule in fixed.GENRE_RULES)} from dated",
    "flagged": f"select *, case when {' + '.join(fixed.GENRES)} <= 0 then 1 else 0 end as others from flag20",
    "tok": "select lyrics_id, unnest(words) as word from songs",
    "bench_words": f"select distinct unnest({_words('text')}) as word from benchmark",
    "lex": "select word, cast(length(word) % 11 as int) - 5 as score from bench_words",
    "bing": "select word, case when score > 0 then 'positive' else 'negative' end as sentiment from lex where score <> 0",
    "nrc": """
        select word, 'emotion' || cast(length(word) % 10 as varchar) as sentiment from bench_words
        union all select word, 'emotion' || cast((length(word) + 3) % 10 as varchar) from bench_words""",
    "lens": "select lyrics_id, count(*) as lyrics_length from tok group by 1",
    "sent": """
        select s.*, l.lyrics_length, cast(s.sentiment as double) / cast(l.lyrics_length as double) as ave_sentiment
        from (select lyrics_id, cast(sum(score) as bigint) as sentiment from tok join lex using (word) group by 1) s
        left join lens l using (lyrics_id)""",
    "sent_songs": "select sent.*, rank, year, decade, song_name, singer, lyrics from sent left join dated using (lyrics_id)",
    "tidy": " union all ".join(
        f"select lyrics_id, sentiment, lyrics_length, ave_sentiment, rank, decade, year, '{g}' as genre_tidy"
        f" from sent left join flagged using (lyrics_id) where {g} = 1"
        for g in fixed.GENRES
    ),
    "sentences": """
        select doc_id, generate_subscripts(parts, 1) - 1 as sentence_id, unnest(parts) as s
        from (select doc_id, regexp_split_to_array(lower(text), '[.!?\\n]+') as parts from documents)""",
    "sentence_words": f"""
        select doc_id, sentence_id, generate_subscripts(w, 1) - 1 as token_id, unnest(w) as word
        from (select doc_id, sentence_id, {_words("s")} as w from sentences)""",
    "ann": """
        select 'doc' || cast(doc_id as varchar) as doc_id, cast(0 as bigint) as paragraph_id,
               cast(sentence_id as bigint) as sentence_id, cast(token_id as bigint) as token_id,
               word as token, word as lemma,
               case when length(word) % 5 in (0, 3) then 'NOUN' when length(word) % 5 = 1 then 'ADJ'
                    when length(word) % 5 = 2 then 'VERB' else 'PUNCT' end as upos,
               cast(token_id + 1 as bigint) as head_token_id,
               case when length(word) % 5 in (0, 3) then 'nsubj' else 'obj' end as dep_rel
        from sentence_words""",
    "prepared": """
        select *, cast(replace(doc_id, 'doc', '') as bigint) as lyrics_id from ann where upos <> 'PUNCT'""",
    "dict": """
        select word, list_sum(cast(embedding as double[])) as vec_sum
        from (select word, cast('0x' || substr(md5(word), 1, 15) as bigint) % (select count(*) from embeddings) as vec_id
              from bench_words) join embeddings using (vec_id)""",
    "filled": """
        select rank, song_name, singer, year, max(md5(lyrics)) as lyrics, false as added
        from songs where lyrics_id % 4 <> 0 group by all
        union all
        select distinct a.rank, a.song_name, a.singer, a.year, b.found, true
        from songs a join (select song_name, singer, max(md5(lyrics)) as found from songs where lyrics_id % 8 = 0 group by 1, 2) b
          on a.song_name = b.song_name and a.singer = b.singer
        where not exists (select 1 from songs s where s.lyrics_id % 4 <> 0 and a.rank = s.rank and a.year = s.year
                          and a.song_name = s.song_name and a.singer = s.singer)""",
    "named": f"""
        select lyrics_id,
               case when lyrics_id % 3 = 0 then concat({_picked([p for p, _ in fixed.TITLE_ALIASES], "(lyrics_id // 3)")}, ' ', song_name)
                    else song_name end as title,
               case when lyrics_id % 4 = 0 then {_picked([p for p, _ in fixed.ARTIST_ALIASES], "(lyrics_id // 4)")}
                    when lyrics_id % 16 = 1 then singer
                    else concat(singer, {_picked(BETWEEN, "lyrics_id")}, 'other') end as artist
        from songs""",
    "chart_raw": """
        select lyrics_id, year, case when lyrics_id % 7 = 3 then 'Tie' else cast(rank as varchar) end as rank,
               song_name, singer from songs""",
    "search": """
        select lyrics_id, year, rank, song_name, singer, genre as g, singer as dash,
               case cast(lyrics_id % 4 as int)
                 when 0 then concat('(x) ', singer, ' Genre: ', genre, ' Length: 3:20')
                 when 1 then concat('-', singer, '-foo-Genres-', genre)
                 when 2 then concat('other Genre ', genre)
                 else concat('page about ', singer) end as raw
        from songs""",
    "cooc": """
        select prev as term1, lemma as term2, count(*) as cooc
        from (select lemma, upos, lag(lemma) over w as prev, lag(upos) over w as prev_upos from prepared
              window w as (partition by doc_id order by paragraph_id, sentence_id, token_id))
        where upos in ('NOUN', 'ADJ') and prev_upos in ('NOUN', 'ADJ') group by 1, 2""",
    "runs": """
        select list(token order by token_id) as words from (
          select *, token_id - row_number() over (
            partition by doc_id, paragraph_id, sentence_id order by token_id) as island
          from prepared where upos in ('NOUN', 'ADJ'))
        group by doc_id, paragraph_id, sentence_id, island having count(*) <= 4""",
    "phrases": "select words, len(words) as ngram, count(*) as freq from runs group by words",
    "word_scores": """
        select word, cast(sum(freq * ngram) as double) / cast(sum(freq) as double) as score
        from (select unnest(words) as word, freq, ngram from phrases) group by 1""",
    "rake": """
        select keyword, cast(ngram as int) as ngram, freq, sum(score) as rake from (
          select array_to_string(words, ' ') as keyword, ngram, freq, unnest(words) as word
          from phrases where freq > 50) join word_scores using (word)
        group by 1, 2, 3""",
    "plain": f"""
        select lyrics_id, list_filter(string_split(
            regexp_replace(lower(regexp_replace(lyrics, '[\\p{{P}}\\p{{S}}]+', '', 'g')), '\\s+', ' ', 'g'), ' '),
            lambda w: length(w) >= 3 and w not in {_in(STOP)}) as terms
        from songs""",
    "dt_all": "select lyrics_id, term, count(*) as n from (select lyrics_id, unnest(terms) as term from plain) group by 1, 2",
    "vocab": """
        select term from dt_all group by 1
        having count(*) >= 0.01 * (select count(*) from plain) and count(*) <= 0.9 * (select count(*) from plain)""",
    "dt": "select * from dt_all where term in (select term from vocab)",
    "labelled": "select lyrics_id, toxic as flag, words from songs join labels on doc_id = lyrics_id",
    "ltok": f"""
        select lyrics_id, flag, word from (select lyrics_id, flag, unnest(words) as word from labelled)
        where word not in (select word from stop)""",
    "hashed": "select *, md5(concat(cast(lyrics_id as varchar), '-123')) as h from labelled",
}


def sql(body: str) -> str:
    """Prefix a query with the views it needs, in their order."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        text = queue.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                queue.append(VIEWS[name])
    ctes = [f"{name} as ({VIEWS[name]})" for name in VIEWS if name in needed]
    own = body.strip()
    if own.startswith("with ") and ctes:
        own = f", {own[5:]}"
    return (f"with {', '.join(ctes)} " if ctes else "") + own


def tf_idf(counts: str, group: str) -> str:
    """TF-IDF of a ``(group, word, n)`` relation as a sub-select."""
    return f"""(
        select c.{group}, c.word, c.n, cast(n as double) / cast(total as double) as tf,
               ln(cast(groups as double) / cast(df as double)) as idf,
               cast(n as double) / cast(total as double) * ln(cast(groups as double) / cast(df as double)) as tf_idf
        from {counts} c
        join (select {group}, sum(n) as total from {counts} group by 1) t on c.{group} = t.{group}
        join (select word, count(*) as df from {counts} group by 1) d on c.word = d.word
        cross join (select count(distinct {group}) as groups from {counts}) g)"""


def vectors(long_rows: str) -> str:
    """Places and rounded values of the indexed words of each document."""
    return f"""
        with long_rows as ({long_rows}),
        numbered as (select word, row_number() over (order by word) - 1 as place from long_rows group by word
                     having count(*) >= 0.01 * (select count(*) from labelled))
        select lyrics_id, cast(flag as double) as label, cast((select count(*) from numbered) as int) as size,
               coalesce(string_agg(cast(place as varchar), ' ' order by place), '') as places,
               coalesce(string_agg(case when place is not null then cast(cast(round(value * 1000) as bigint) as varchar) end,
                                   ' ' order by place), '') as "values"
        from long_rows left join numbered using (word) group by 1, 2"""


def top_tf_idf(counts: str, group: str, k: int, where: str = "true") -> str:
    """The top ``k`` per group with the reverse plotting index."""
    return f"""
        select {group}, word, n, round(tf_idf, 9) as tf_idf,
               row_number() over (order by {group} desc, raw, word desc) as x
        from (select {group}, word, n, tf_idf, tf_idf as raw,
                     row_number() over (partition by {group} order by tf_idf desc, word) as place
              from {tf_idf(counts, group)}) where place <= {k} and {where}"""


def counts(source: str, group: str, extra: str = "") -> str:
    return f"(select {group}, word, count(*) as n from (select {group}, unnest(words) as word from {source}) {extra} group by 1, 2)"


def top_words(source: str, where: str = "true") -> str:
    return f"""select word, count(*) as n from (select unnest(words) as word from {source} where {where})
               where word not in (select word from stop) group by 1 order by n desc, word limit 25"""


def top_lemmas(source: str, group: str, upos: str) -> str:
    return f"""
        select {group}, lemma, n, row_number() over (order by {group} desc, n, lemma desc) as x from (
          select *, row_number() over (partition by {group} order by n desc, lemma) as place from (
            select {group}, lemma, count(*) as n from {source} where upos = '{upos}' group by 1, 2))
        where place <= 30"""


BY_DECADE = "(select lemma, upos, decade from prepared left join dated using (lyrics_id))"
BY_GENRE = (
    "(select lemma, upos, genre_tidy from prepared join ("
    + " union all ".join(f"select lyrics_id, '{g}' as genre_tidy from flagged where {g} = 1" for g in fixed.REPORT_GENRES)
    + ") using (lyrics_id))"
)
GENRE_WORDS = "(" + " union all ".join(
    f"select words, '{g}' as genre_tidy from flagged where {g} = 1" for g in [*fixed.GENRES, "others"]
) + ")"
RICH = "(select {cols}, cast(count(distinct word) as double) / cast(count(*) as double) as richness from (select {cols}, lyrics_id, unnest(words) as word from {source}) where word not in (select word from stop) group by {cols}, lyrics_id)"
EXTRACT = """(
    select lyrics_id, case
      when contains(raw, 'Genre') and contains(raw, 'Length') then regexp_replace(raw, '^.*Genre|Length.*$', '', 'g')
      when contains(raw, 'Genre') and regexp_matches(raw, concat('(?i)-*', dash, '.*-*,*-*Genre[s]*-*'))
        then regexp_replace(raw, concat('(?i)-*', dash, '.*-*,*-*Genre[s]*-*'), '', 'g')
      when contains(raw, 'Genre') then 'Extraction failed' else 'No genre detected' end as genre
    from search)"""
CLEAN_EXTRACT = f"""(
    select lyrics_id, case
      when contains(raw, 'Genre') and contains(raw, 'Length') then regexp_replace(raw, '^.*Genre|Length.*$', '', 'g')
      when contains(raw, 'Genre') and regexp_matches(raw, concat('(?i)-*', dash, '.*-*,*-*Genre[s]*-*'))
        then regexp_replace(raw, concat('(?i)-*', dash, '.*-*,*-*Genre[s]*-*'), '', 'g')
      when contains(raw, 'Genre') then 'Extraction failed' else 'No genre detected' end as genre
    from (select lyrics_id, {_chain("raw", fixed.GENRE_CLEAN)} as raw, {_chain("dash", fixed.GENRE_CLEAN)} as dash
          from search))"""
DASH = "translate(replace(translate(replace({col}, '\"', ''), ',&', ''), '  ', ' '), ' ', '-')"
DENSITY = """
    select {group}, {x} as x, round(avg(exp(-(({x}) - ave_sentiment) * (({x}) - ave_sentiment) / (2 * {bw} * {bw}))
           / ({bw} * sqrt(2 * pi()))), 9) as density
    from sent_songs, range(0, 21) where {where} group by 1, 2"""
BINNED_DENSITY = """
    select {group}, {x} as x, round(sum(weight * exp(-(({x}) - cell * size) * (({x}) - cell * size) / (2 * size * size * 400)))
           / (sum(weight) * any_value(size) * 20 * sqrt(2 * pi())), 9) as density
    from (select {group}, size, cell, sum(weight) as weight from (
            select {group}, size, floor(place) as cell, 1 - (place - floor(place)) as weight from {{placed}}
            union all select {group}, size, floor(place) + 1, place - floor(place) from {{placed}}) group by 1, 2, 3),
         range(0, 21) group by 1, 2"""
PLACED = "(select *, ave_sentiment / size as place from (select *, {bw} / 20 as size from sent_songs where {where}))"


def binned_density(group: str, x: str, bw: str, where: str = "true") -> str:
    """Kernel densities of linearly binned values."""
    return BINNED_DENSITY.format(group=group, x=x).replace("{placed}", PLACED.format(bw=bw, where=where))


BANDWIDTH = """(select 0.9 * least(stddev_samp(ave_sentiment),
    (quantile_disc(ave_sentiment, 0.75) - quantile_disc(ave_sentiment, 0.25)) / 1.34) * pow(count(*), -0.2) from sent_songs)"""
MEAN = "select {g}, round(avg(ave_sentiment), 9) as mean_sent from sent_songs group by 1"

ORACLE_BODIES = {
    "scan_songs": "select lyrics_id, year, rank, singer, lang, song_name, lyrics, genre from songs",
    "html_tables": """
        select concat(cast(year as varchar), '-', cast(lyrics_id // 5000 as varchar)) as page,
               cast(row_number() over (partition by year, lyrics_id // 5000 order by lyrics_id) as int) as row_no,
               concat(rank, '|"', song_name, '"|', singer) as cells
        from chart_raw""",
    "html_text": f"""
        select page_id, cast(1 as int) as pos,
               {_chain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)", ENTITIES)} as text from pages""",
    "clean_scraped": """
        select doc_id, regexp_replace(translate(text, chr(10) || chr(13) || '"', ' '), '^\\s+|\\s+$', '', 'g') as cleaned
        from documents""",
    "collect_by_year": """
        select cast(1968 as int) as year, doc_id as id, cast(length(text) as int) as size, lang, null::varchar as role from documents
        union all select 1969, item_id, cast(length(text) as int), null, null from benchmark
        union all select 1970, conv_id, cast(length(text) as int), null, role from conversations""",
    "parse_status": """
        select lyrics_id, rank as raw, try_cast(rank as int) as rank,
               case when try_cast(rank as int) is null then 'Error!' when try_cast(rank as int) > 90 then 'Warning!'
                    else 'ok' end as status
        from chart_raw""",
    "embedding_sum": "select vec_id as word, round(list_sum(cast(embedding as double[])), 6) as vec_sum from embeddings",
    "scan_annotated": "select * from ann",
    "lyric_url": f"""
        select lyrics_id, song_name, singer, concat('https://www.azlyrics.com/lyrics/', {_artist("singer")}, '/',
               {_key("song_name")}, '.html') as lyrics_url from songs""",
    "decade_bucket": "select lyrics_id, year, decade from dated",
    "dense_index": "select lyrics_id, year, rank, row_number() over (order by year, rank, lyrics_id) as idx from songs",
    "rank_tie_fill": """
        select lyrics_id, year, try_cast(case when rank = 'Tie' then lag(rank) over
          (partition by year order by lyrics_id) else rank end as int) as rank from chart_raw""",
    "rank_tie_runs": """
        with tied as (select lyrics_id, year, case when lyrics_id % 7 < 3 then 'Tie' else cast(rank as varchar) end as r from songs)
        select lyrics_id, year, 'prev' as way, try_cast(case when r = 'Tie' then lag(r) over w else r end as int) as rank
        from tied window w as (partition by year order by lyrics_id)
        union all
        select lyrics_id, year, 'run', try_cast(last_value(case when r <> 'Tie' then r end ignore nulls) over w as int)
        from tied window w as (partition by year order by lyrics_id rows between unbounded preceding and current row)""",
    "title_dash": f"select doc_id, {DASH.format(col='text')} as dash from documents",
    "chart_clean": f"""
        select year, cast(lyrics_id // 5000 as int) as page_no,
               cast(row_number() over (partition by year, lyrics_id // 5000 order by lyrics_id) as int) as row_no,
               try_cast(case when rank = 'Tie' then lag(rank) over (partition by year order by lyrics_id) else rank end
                 as int) as rank, song_name, singer, {DASH.format(col='song_name')} as song_name_dash
        from chart_raw""",
    "canon_title": f"select lyrics_id, {_key(_aliased('lyrics', fixed.TITLE_ALIASES))} as title_key from songs",
    "canon_artist": f"""
        select lyrics_id, {_artist("a")} as artist_key
        from (select lyrics_id, {_aliased("lyrics", fixed.ARTIST_ALIASES)} as a from songs)""",
    "genre_search_url": f"""
        select lyrics_id, concat('https://www.google.com/search?q=', lower({DASH.format(col="title")}), '+',
               lower({DASH.format(col="artist")}), '+genre') as search_url from named""",
    "parse_messages": """
        select lyrics_id, r as rank, case when r <> 'Tie' then r end as value,
               case when r is null then 'missing' when r = 'Tie' then 'Error!' when cast(r as int) > 90 then 'Warning!' else 'ok' end as status,
               case when r = 'Tie' then 'no rank: Tie' when cast(r as int) > 90 then 'low rank: ' || r end as message
        from (select lyrics_id, case when lyrics_id % 11 <> 5 then rank end as r from chart_raw)""",
    "name_keys": f"""
        select lyrics_id, title, artist, {_key(_replaced("title", fixed.TITLE_ALIASES))} as title_key,
               {_artist("a", (*fixed.ARTIST_BRANCHES[:-1], fixed.ARTIST_PLUS_LITERAL))} as artist_key
        from (select *, {_replaced("artist", fixed.ARTIST_ALIASES)} as a from named)""",
    "genre_clean": f"select doc_id, {_chain('text', fixed.GENRE_CLEAN)} as cleaned from documents",
    "genre_extract": f"""
        select lyrics_id, genre, case when genre in ('Extraction failed', 'No genre detected', 'Wiki page 404')
               then genre else 'ok' end as genre_status from {EXTRACT}""",
    "genre_failures": f"""
        select genre, count(*) as n from {EXTRACT}
        where genre in ('Extraction failed', 'No genre detected') group by 1""",
    "genre_fallback": """
        with cited as (
          select lyrics_id, url as page_url,
                 case when lyrics_id % 3 = 0 then concat('page about ', singer)
                      else concat('wiki Wikipedia', coalesce(url, concat('http://missing.example/',
                           cast(lyrics_id as varchar))), 'Cached copy') end as genre_raw
          from songs left join pages on page_id = lyrics_id),
        lines as (
          select url, generate_subscripts(parts, 1) as pos, unnest(parts) as text
          from (select url, string_split(html, '<p>') as parts from pages)),
        found as (
          select url, string_agg(case when contains(text, 'the')
                 then regexp_replace(replace(text, chr(10), ''), '^.*thes*', '') end, ' ' order by pos) as hit
          from lines group by 1)
        select lyrics_id, genre_raw,
               case when not contains(genre_raw, 'wiki') then 'No genre detected'
                    when page_url is null then 'Wiki page 404'
                    else coalesce(hit, 'No genre detected') end as genre
        from cited left join found on page_url = url""",
    "genre_flags": f"select lyrics_id, {FLAGS} from flagged",
    "genre_others": "select lyrics_id, others from flagged",
    "genre_long": " union all ".join(
        f"select lyrics_id, year, '{g}' as genre_tidy from flagged where {g} = 1" for g in [*fixed.GENRES, "others"]
    ),
    "genre_pipeline": f"""
        select *, case when {' + '.join(fixed.GENRES)} <= 0 then 1 else 0 end as others
        from (select lyrics_id, genre, {', '.join(_flag(*r) for r in fixed.GENRE_RULES)} from {CLEAN_EXTRACT})""",
    "join_chart_lyrics": """
        select rank, song_name, singer, year, found as lyrics
        from songs join (select distinct song_name, singer, md5(lyrics) as found from songs) using (song_name, singer)""",
    "join_genre": """
        select a.rank, a.year, a.song_name, a.singer, md5(a.lyrics) as lyrics, concat('raw ', b.genre) as genre_raw,
               case when b.genre = 'Extraction failed' then concat('raw ', b.genre) else b.genre end as genre
        from songs a join songs b using (rank, year, song_name, singer) where b.lyrics_id % 10 <> 8""",
    "missing_lyrics": """
        select lyrics_id, rank, year, song_name, singer from songs a where not exists (
          select 1 from songs b where b.lyrics_id % 4 <> 0 and a.rank = b.rank and a.year = b.year
            and a.song_name = b.song_name and a.singer = b.singer)""",
    "lyrics_fill": """
        with stored as (select distinct rank, song_name, singer, year, md5(lyrics) as lyrics
                        from songs where lyrics_id % 4 <> 0)
        select * from stored union all
        select a.rank, a.song_name, a.singer, a.year, b.found
        from songs a join (select distinct song_name, singer, md5(lyrics) as found from songs where lyrics_id % 8 = 0) b
          on a.song_name = b.song_name and a.singer = b.singer
        where not exists (select 1 from stored s where a.rank = s.rank and a.year = s.year
                          and a.song_name = s.song_name and a.singer = s.singer)""",
    "lyrics_store": """
        select year, count(*) as "rows", count(*) filter (added and year < 1990) as added,
               count(*) filter (added and year < 1990) = 0 as same_files
        from filled where not added or year < 1990 group by 1""",
    "tokenize": """
        select lyrics_id, cast(generate_subscripts(words, 1) - 1 as int) as pos, unnest(words) as word from songs""",
    "stopword_anti": "select lyrics_id, word from tok where word not in (select word from stop)",
    "word_freq": top_words("songs"),
    "wordcloud_freq": f"""
        select word, count(*) as freq from tok where word not in (select word from stop)
        and word not in {_in(fixed.CLOUD_DROP)} group by 1""",
    "word_freq_by_decade": f"""
        select decade, word, n, row_number() over (order by decade desc, n, word desc) as x from (
          select *, row_number() over (partition by decade order by n desc, word) as place
          from {counts("dated", "decade", "where word not in (select word from stop)")}) where place <= 25""",
    "word_freq_pop": top_words("flagged", "pop = 1"),
    "word_freq_singer": top_words("songs", "singer = 'src3'"),
    "top_artists": "select singer, count(*) as num from songs group by 1 order by num desc, singer limit 10",
    "tfidf_by_song": f"""
        select lyrics_id, song_name, word, n, round(tf, 9) as tf, round(idf, 9) as idf, round(tf_idf, 9) as tf_idf
        from (select *, row_number() over (partition by lyrics_id order by tf_idf desc, word) as place
              from {tf_idf(counts("songs", "lyrics_id"), "lyrics_id")}) join songs using (lyrics_id)
        where place <= 10""",
    "tfidf_by_decade": top_tf_idf(counts("dated", "decade"), "decade", 20),
    "tfidf_by_genre": top_tf_idf(
        counts(GENRE_WORDS, "genre_tidy"), "genre_tidy", 20, f"genre_tidy in {_in(fixed.TFIDF_GENRES)}"
    ),
    "tfidf_by_singer": f"""
        select singer, word, n, tf_idf from ({top_tf_idf(counts("songs", "singer"), "singer", 20)})""",
    "top_artist_tfidf": top_tf_idf(
        counts("songs", "singer"), "singer", 20,
        "singer in (select singer from songs group by 1 order by count(*) desc, singer limit 10)",
    ),
    "lexical_richness": """
        select lyrics_id, round(cast(count(distinct word) as double) / cast(count(*) as double), 9) as richness
        from tok where word not in (select word from stop) group by 1""",
    "richness_by_decade": f"""
        select decade, round(avg(richness), 9) as avg_richness
        from {RICH.format(cols="decade", source="dated")} group by 1""",
    "richness_by_genre_decade": " union all ".join(
        f"""select '{g}' as genre_tidy, decade, round(avg(richness), 9) as avg_richness
            from {RICH.format(cols="decade", source=f"(select * from flagged where {g} = 1)")} group by 2"""
        for g in fixed.REPORT_GENRES
    ),
    "sentiment_bing": """
        select lyrics_id, negative, positive, positive - negative as sentiment from (
          select lyrics_id, cast(sum(case when sentiment = 'negative' then 1 end) as bigint) as negative,
                 cast(sum(case when sentiment = 'positive' then 1 end) as bigint) as positive
          from tok join bing using (word) group by 1)""",
    "sentiment_afinn": "select lyrics_id, sentiment from sent",
    "sentiment_normalised": """
        select lyrics_id, sentiment, cast(lyrics_length as int) as lyrics_length,
               round(ave_sentiment, 9) as ave_sentiment from sent""",
    "sentiment_nrc": """
        with words as (select g.genre_tidy as genre, unnest(s.words) as word
                       from tidy g join songs s on g.lyrics_id = s.lyrics_id),
        totals as (select genre, count(*) as n_group from words group by 1)
        select genre, sentiment, total, n_group,
               round(cast(total as double) / cast(n_group as double), 9) as relative_sentiment
        from (select genre, sentiment, count(*) as total from words join nrc using (word) group by 1, 2)
        join totals using (genre)""",
    "mean_sentiment_by_rank": MEAN.format(g="rank"),
    "mean_sentiment_by_year": MEAN.format(g="year"),
    "mean_sentiment_by_decade": MEAN.format(g="decade"),
    "mean_sentiment_by_genre": """
        select genre_tidy, round(m, 9) as mean_sent, cast(row_number() over (order by round(m, 9) desc, genre_tidy) as int) as ord
        from (select genre_tidy, avg(ave_sentiment) as m from tidy group by 1)""",
    "genre_tidy": """
        select lyrics_id, sentiment, cast(lyrics_length as int) as lyrics_length,
               round(ave_sentiment, 9) as ave_sentiment, rank, decade, year, genre_tidy from tidy""",
    "genre_share_by_decade": """
        select decade, genre_tidy, n as n_genre_occ,
               round(cast(n as double) / cast(sum(n) over (partition by decade) as double), 9) as perc
        from (select decade, genre_tidy, count(*) as n from tidy group by 1, 2)""",
    "extreme_sentiment": """
        select lyrics_id, song_name, singer, rank, year, decade, sentiment, round(ave_sentiment, 9) as ave_sentiment,
               md5(lyrics) as lyrics_md5
        from sent_songs
        where (decade = '1970s' and ave_sentiment > 0.35) or (decade = '2010s' and ave_sentiment < -0.35)""",
    "sentiment_density": DENSITY.format(group="decade", x="-5 + 0.5::double * range", bw="0.3::double", where="true"),
    "sentiment_density_default": binned_density("decade", "-5 + 0.5::double * range", BANDWIDTH),
    "mean_sentiments": " union all ".join(
        f"select '{g}' as by, cast({g} as varchar) as \"group\", round(avg(ave_sentiment), 9) as mean_sent from sent_songs group by {g}"
        for g in ("rank", "year", "decade")),
    "sentiment_density_by_rank": f"""
        select case when rank <= 20 then 'top' else 'bottom' end as band, rank, round(x, 9) as x, density from ({
        DENSITY.format(group="rank", x="-0.2::double + 0.05::double * range", bw="0.1::double",
                       where="ave_sentiment between -0.2 and 0.8 and (rank <= 20 or rank > 80)")})""",
    "sentiment_histogram": """
        select decade, cast(case when ave_sentiment < -1 then 0 when ave_sentiment >= 1 then 21
                            else floor(20 * (ave_sentiment + 1.0) / 2.0) + 1 end as int) as bin, count(*) as n
        from sent_songs group by 1, 2""",
    "prepared_annotated": "",
    "top_nouns": """
        select lemma, count(*) as n from prepared where upos = 'NOUN' group by 1 order by n desc, lemma limit 20""",
    "top_nouns_by_decade": top_lemmas(BY_DECADE, "decade", "NOUN"),
    "top_adj_by_decade": top_lemmas(BY_DECADE, "decade", "ADJ"),
    "top_nouns_by_genre": top_lemmas(BY_GENRE, "genre_tidy", "NOUN"),
    "top_adj_by_genre": top_lemmas(BY_GENRE, "genre_tidy", "ADJ"),
    "dependency_pairs": """
        select concat(h.lemma, ' ', c.lemma) as term, count(*) as n
        from prepared c join prepared h on c.doc_id = h.doc_id and c.paragraph_id = h.paragraph_id
          and c.sentence_id = h.sentence_id and c.head_token_id = h.token_id
        where c.dep_rel = 'nsubj' and c.upos = 'NOUN' and h.upos = 'ADJ' group by 1""",
    "dependency_top": """
        select concat(h.lemma, ' ', c.lemma) as term, count(*) as n
        from prepared c join prepared h on c.doc_id = h.doc_id and c.paragraph_id = h.paragraph_id
          and c.sentence_id = h.sentence_id and c.head_token_id = h.token_id
        where c.dep_rel = 'nsubj' and c.upos = 'NOUN' and h.upos = 'ADJ' group by 1 order by n desc, term limit 40""",
    "cooccurrence": "select * from cooc",
    "word_network": """
        with edges as (select * from cooc order by cooc desc, term1, term2 limit 150)
        select term1, term2, cooc, 'edge' as kind from edges
        union all select name, '', 0, 'node' from (select term1 as name from edges union select term2 from edges)""",
    "rake_keywords": "select keyword, ngram, freq, round(rake, 9) as rake from rake",
    "rake_top": """
        select keyword, ngram, freq, round(rake, 9) as rake,
               cast(row_number() over (order by ngram desc, freq, keyword desc) as int) as x
        from (select *, row_number() over (partition by ngram order by freq desc, keyword) as place
              from rake where ngram in (1, 2)) where place <= 20""",
    "normalise_text": """
        select lyrics_id, regexp_replace(lower(regexp_replace(lyrics, '[\\p{P}\\p{S}]+', '', 'g')), '\\s+', ' ', 'g')
          as text from songs""",
    "doc_term_bounds": "select lyrics_id, term, n from dt",
    "nonempty_docs": "select distinct lyrics_id from dt",
    "dtm_summary": """
        select docs, terms, non_zero, round(1 - non_zero / (cast(docs as double) * terms), 9) as sparsity
        from (select (select count(*) from plain) as docs, count(distinct term) as terms, count(*) as non_zero from dt)""",
    "top_terms": """
        select topic, term, round(beta, 9) as beta,
               cast(row_number() over (partition by topic order by beta, term desc) as int) as "order"
        from (select *, rank() over (partition by topic order by beta desc) as place from (
          select topic, term, cast(n as double) / cast(sum(n) over (partition by topic) as double) as beta
          from (select year % 10 as topic, term, count(*) as n
                from (select year, unnest(words) as term from songs) group by 1, 2)))
        where place <= 10""",
    "class_balance": """
        select lyrics_id, flag, cast(1.0 as double) as label from labelled where flag = 1
        union all
        select lyrics_id, flag, cast(0.0 as double) from (
          select *, row_number() over (order by h, lyrics_id) as place from hashed where flag = 0)
        where place <= (select count(*) from labelled where flag = 1)""",
    "train_test_split": """
        select doc_id, source, case when row_number() over (order by md5(concat(cast(doc_id as varchar), '-123')), doc_id)
          <= floor(0.75 * count(*) over ()) then 'train' else 'test' end as part from documents""",
    "features_count": "select lyrics_id, flag, word, count(*) as n from ltok group by 1, 2, 3",
    "features_binary": "select distinct lyrics_id, flag, word, cast(1 as int) as present from ltok",
    "features_embedding": """
        select distinct lyrics_id, flag, word, round(vec_sum, 6) as value from ltok join dict using (word)""",
    "stem_tokens": f"select lyrics_id, word, stem from tok join ({stems('select word from tok')}) using (word)",
    "word_index": """
        select word, docs, cast(row_number() over (order by word) - 1 as int) as place
        from (select word, count(*) as docs from (select distinct lyrics_id, word from ltok) group by 1
              having count(*) >= 0.01 * (select count(*) from labelled))""",
    "vectors_count": vectors("select lyrics_id, flag, word, count(*) as value from ltok group by 1, 2, 3"),
    "vectors_binary": vectors("select distinct lyrics_id, flag, word, 1 as value from ltok"),
    "vectors_embedding": vectors(
        "select distinct lyrics_id, flag, word, vec_sum as value from ltok join dict using (word)"),
    "cv_folds": """
        select "repeat", fold, label, count(*) as "rows", cast(sum(lyrics_id) as bigint) as id_sum
        from (select r.n as "repeat", lyrics_id, flag as label, cast((row_number() over (
                partition by r.n order by flag, md5(concat(cast(lyrics_id as varchar), '-123-fold-', cast(r.n as varchar))), lyrics_id) - 1) % 10 as int) as fold
              from labelled, (select cast(unnest(range(1, 4)) as int) as n) r) group by 1, 2, 3""",
    "split_by_label": """
        select lyrics_id, flag as label, row_number() over (
                 partition by flag order by md5(concat(cast(lyrics_id as varchar), '-123-split')), lyrics_id)
               <= floor(0.75 * count(*) over (partition by flag)) as is_train from labelled""",
    "topic_facts": """
        select cast(topic as int) as topic, (select count(distinct term) from dt_all) as terms,
               (select count(distinct term) from dt_all) as names, cast(1.0 as double) as beta_sum,
               (select count(distinct lyrics_id) from dt_all) as docs
        from (select unnest(range(1, 11)) as topic)""",
    "features_sumvec": """
        select lyrics_id, flag, round(sum(vec_sum), 5) as sum_vec
        from (select distinct lyrics_id, flag, word, vec_sum from ltok join dict using (word)) group by 1, 2""",
    "confusion_matrix": """
        select tp, fp, fn, tn, round(acc, 9) as accuracy, round((acc - e) / (1 - e), 9) as kappa,
               round(tp::double / (tp + fn), 9) as sensitivity, round(tn::double / (tn + fp), 9) as specificity
        from (select *, (tp + tn)::double / n as acc,
                     ((tp + fp)::double * (tp + fn) + (fn + tn)::double * (fp + tn)) / (n::double * n) as e
              from (select count(*) filter (quality = 0 and toxic = 1) as tp,
                           count(*) filter (quality = 1 and toxic = 1) as fp,
                           count(*) filter (quality = 0 and toxic = 0) as fn,
                           count(*) filter (quality = 1 and toxic = 0) as tn, count(*) as n from labels))""",
}
del ORACLE_BODIES["prepared_annotated"]
ORACLE_BODIES["prepare_annotated"] = """
    select lyrics_id, doc_id, paragraph_id, sentence_id, token_id, token, lemma, upos, head_token_id, dep_rel,
           song_name, year, rank, singer
    from prepared left join songs using (lyrics_id)"""

ORACLE = {name: sql(body) for name, body in ORACLE_BODIES.items()}

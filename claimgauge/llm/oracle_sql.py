"""SQL for the corpus queries that SQL can express, written for DuckDB."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: everything that a node reaches, given links both ways as pairs(a, b)
_REACH = """
reach(a, b) as (select a, b from pairs union select r.a, p.b from reach r join pairs p on r.b = p.a),
lowest as (select a, min(b) as low from reach group by a)"""

NEAR_DOCUMENTS = rf"""
with recursive texts as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as words
    from documents
),
shingles as (
    select distinct doc_id, array_to_string(words[i : i + 4], ' ') as shingle
    from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from texts where len(words) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as n
    from shingles x join shingles y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by all
),
pairs as (
    select a, b from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b
    where 100 * s.n >= 75 * (x.n + y.n - s.n)
),
{_REACH}
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id,
    doc_id <= coalesce(low, doc_id) as kept
from documents left join sizes using (doc_id) left join lowest on a = doc_id"""

NEAR_VECTORS = f"""
with recursive known as (
    select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
pairs as (
    select x.vec_id as a, y.vec_id as b from known x join known y on x.vec_id <> y.vec_id and len(x.v) = len(y.v)
    where list_cosine_similarity(x.v, y.v) >= 0.9
),
{_REACH},
counts as (select a as vec_id, count(*) as n from pairs group by a)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id,
    vec_id <= coalesce(low, vec_id) as kept
from embeddings left join counts using (vec_id) left join lowest on a = vec_id"""

QUALITY_RULES = rf"""
with texts as (
    select doc_id, source, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '{_WORD}') as words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines
    from documents
),
windows as (
    select doc_id, i, count(*) over (partition by doc_id, array_to_string(words[i : i + 7], ' ')) as n
    from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from texts where len(words) >= 8)
),
repeats as (
    select doc_id, count(distinct i + k) as n_repeat_words
    from windows, (select unnest(range(8)) as k) where n > 1 group by doc_id
),
measures as (
    select doc_id, source, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
        len(regexp_extract_all(body, '[#*$%&|<>]')) as n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
    from texts left join repeats using (doc_id)
),
checked as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measures),
hosts as (
    select source, count(*)::double as n, count(*) filter (base_failed)::double as failed
    from checked where source is not null group by source
),
totals as (
    select sum(failed) / sum(n) as mean, sum(n) as docs, count(*) as hosts, sum(failed * failed / n) as squares from hosts
),
fitted as (
    select mean, mean * (1 - mean) as within,
        (squares - docs * mean * mean - mean * (1 - mean) * (hosts - 1)) / docs as spread from totals
),
prior as (
    select mean, case when within / 1e6 >= spread then 1e6 else least(1e6, greatest(1.0, within / spread - 1)) end as weight
    from fitted
),
rejected as (
    select source, true as host_rejected from hosts, prior where (failed + mean * weight) / (n + weight) > 0.5
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and host_rejected is null as kept
from checked left join rejected using (source)"""

COLLOCATIONS = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\x20\x09]+') as words
    from (
        select lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece
        from documents
    )
),
totals as (select lang, sum(len(words))::bigint as n from pieces group by lang),
counted as (
    select lang, k, phrase, count(*) as f
    from (
        select lang, k, array_to_string(words[i : i + k - 1], ' ') as phrase
        from (select lang, k, words, unnest(range(1, len(words) - k + 2)) as i
              from pieces cross join (values (1), (2), (3)) as lengths(k) where len(words) >= k)
    )
    group by all
),
candidates as (select lang, k, phrase, string_split(phrase, ' ') as words, f as a from counted where k >= 2 and f >= 10),
cuts as (
    select c.lang, c.phrase, c.a, cut, l.f as l, r.f as r,
        (1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f) as score
    from (select *, unnest(range(1, k)) as cut from candidates) c
    join counted l on l.lang = c.lang and l.k = cut and l.phrase = array_to_string(c.words[1 : cut], ' ')
    join counted r on r.lang = c.lang and r.k = c.k - cut and r.phrase = array_to_string(c.words[cut + 1 :], ' ')
),
weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
covered as (
    select x.lang, x.phrase from candidates x join candidates y
        on x.lang = y.lang and y.k = 3 and x.k = 2 and 100 * y.a >= 50 * x.a
        and (x.words = y.words[1:2] or x.words = y.words[2:3])
),
ranked as (
    select w.*, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from weakest w where not exists (select 1 from covered c where c.lang = w.lang and c.phrase = w.phrase)
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""

"""SQL twins of the text queries that SQL can express, for DuckDB."""

from __future__ import annotations

import string

from tillstar.llm import licenses


def _templates() -> str:
    """The templates as a VALUES list: template, label, exact, words of a gram, words."""
    listed = [*((label, text, True) for text, label in licenses.PHRASES), *((label, text, False) for label, text in licenses.TEXTS)]
    rows = []
    for number, (label, text, exact) in enumerate(listed):
        words = licenses.template_words(text)
        quoted = ", ".join(f"'{w}'" for w in words)
        rows.append(f"({number}, '{label}', {str(exact).lower()}, {licenses.gram_size(words, exact)}, [{quoted}])")
    return ",\n".join(rows)


# Phrases by comparing every stretch of words. A text's spans by their aligned words: where a
# gram of the template stands, all its words are compared at the same distance; alignments at
# nearly the same distance are one span; of overlapping spans the best label stays.
LICENSES = f"""
with templates(template, label, exact, k, words) as (values {_templates()}),
docs as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{licenses.WORD}') as w
    from documents
),
places as (select doc_id, w, unnest(range(len(w))) as p from docs),
firsts as (select *, words[1] as word from templates where exact),
phrases as (
    select doc_id, label, p as start from (select *, w[p + 1] as word from places) join firsts using (word) where w[p + 1 : p + len(words)] = words
),
grams as (select template, k, t as place, words[t + 1 : t + k] as gram from templates, unnest(range(len(words) - k + 1)) as g(t) where not exact),
stretches as (
    select doc_id, p, w[p + 1 : p + {licenses.SHORT}] as gram from places
    union all
    select doc_id, p, w[p + 1 : p + {licenses.LONG}] from places
),
aligned as (select distinct doc_id, template, p - place as distance from stretches join grams using (gram)),
meets as (
    select a.doc_id, a.template, a.distance, t.label, len(t.words) as length, i as word
    from aligned a join docs using (doc_id) join templates t using (template), unnest(range(len(t.words))) as r(i)
    where a.distance + i >= 0 and (
        w[a.distance + i + 1] = t.words[i + 1]
        or regexp_full_match(t.words[i + 1], '[0-9]+') and regexp_full_match(w[a.distance + i + 1], '[0-9]+'))
),
begun as (
    select *, coalesce(distance - lag(distance) over line > {licenses.NEIGHBOURS}, true)::int as begins
    from aligned window line as (partition by doc_id, template order by distance)
),
numbered as (select *, sum(begins) over (partition by doc_id, template order by distance) as span from begun),
spans as (
    select doc_id, template, span, label, length, least(count(distinct word), count(distinct distance + word)) as covered, min(distance + word) as first, max(distance + word) as last
    from meets join numbered using (doc_id, template, distance) group by all
),
good as (
    select *, 2 * covered / (length + last - first + 1)::double as common from spans
    where covered / length::double >= {licenses.COVERAGE} and last - first + 1 <= {licenses.STRETCH} * length
),
labelled as (
    select doc_id, label, covered / length::double as coverage from good g
    where not exists (
        from good o where o.doc_id = g.doc_id and o.label <> g.label and o.first <= g.last and g.first <= o.last
        and (o.common > g.common or o.common = g.common and (o.covered > g.covered or o.covered = g.covered and o.label < g.label)))
),
found as (
    select doc_id, label, start, 1.0::double as coverage from phrases
    union all
    select doc_id, label, null, coverage from labelled
),
each_doc as (
    select doc_id, count(start) as n_base, min(start) as first_word, max(start) as last_word,
        coalesce(string_agg(distinct label, ',' order by label) filter (start is not null), '') as base_labels,
        string_agg(distinct label, ',' order by label) as labels, max(coverage) as score
    from found group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
    -- as numbers with a null show on the other side
    first_word::double as first_word, last_word::double as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from docs left join each_doc using (doc_id)
"""

EMBEDDINGS = """
with recursive v as (
    select vec_id, label, embedding::double[] as e
    from embeddings
    where label is not null and len(embedding) > 0
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
      and len([x for x in embedding if x <> 0]) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b
    from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.98
),
reach as (
    select vec_id, vec_id as other from embeddings
    union
    select r.vec_id, l.b from reach r join links l on r.other = l.a
),
named as (select vec_id, min(other) as component_id from reach group by vec_id),
counted as (select a, count(*) as n from links group by a)
select n.vec_id, coalesce(c.n, 0)::bigint as n_links, n.component_id, n.vec_id = n.component_id as kept
from named n left join counted c on c.a = n.vec_id
"""

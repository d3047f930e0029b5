"""SQL twins of the operator queries that SQL can express, for DuckDB."""

from __future__ import annotations

from threadmill.llm import sanitise
from threadmill.llm.mixing import POOL

def mix_sql(weights: dict[str, int], block_rows: int) -> str:
    """The schedule slot by slot: each step places the released block with the earliest deadline."""
    shares = {s: w for s, w in weights.items() if s != POOL} | {POOL: weights.get(POOL, 1)}
    listed = ", ".join(f"({i}, '{s}', {w}::BIGINT)" for i, (s, w) in enumerate(shares.items()))
    return f"""
WITH RECURSIVE shares(i, name, share) AS (VALUES {listed}),
named AS (
  SELECT d.doc_id, d.source, coalesce(s.name, '{POOL}') AS mix_source
  FROM documents d LEFT JOIN shares s ON s.name = d.source AND s.name <> '{POOL}'
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY mix_source
    ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST) - 1 AS rank
  FROM named
),
sizes AS (
  SELECT i, name, share, count(*) AS n_rows, CAST(ceil(count(*) / {block_rows}.0) AS BIGINT) AS blocks
  FROM placed JOIN shares ON name = mix_source GROUP BY ALL
),
-- state: per source its blocks used in all and since the last time a source ran out
steps AS (
  SELECT -1::BIGINT AS slot, 0::BIGINT AS since, -1 AS pick,
    (SELECT list({{'i': i, 'share': share, 'blocks': blocks, 'used': 0::BIGINT, 'now': 0::BIGINT}} ORDER BY i) FROM sizes) AS state
  UNION ALL
  SELECT slot + 1, CASE WHEN ended THEN slot + 2 ELSE since END, pick,
    list_transform(moved, lambda x: {{'i': x.i, 'share': x.share, 'blocks': x.blocks, 'used': x.used,
                                      'now': CASE WHEN ended THEN 0 ELSE x.now END}})
  FROM (
    SELECT *, len(list_filter(moved, lambda x: x.i = pick AND x.used = x.blocks)) > 0 AS ended
    FROM (
      SELECT *, list_transform(state, lambda x: {{'i': x.i, 'share': x.share, 'blocks': x.blocks,
          'used': x.used + CASE WHEN x.i = pick THEN 1 ELSE 0 END, 'now': x.now + CASE WHEN x.i = pick THEN 1 ELSE 0 END}}) AS moved
      FROM (
        SELECT *, list_min(list_transform(list_filter(state,
            lambda x: x.used < x.blocks AND (x.now * total) // x.share <= slot + 1 - since),
            lambda x: {{'due': ((x.now + 1) * total + x.share - 1) // x.share, 'i': x.i}})).i AS pick
        FROM (SELECT slot, since, state, CAST(list_sum(list_transform(list_filter(state, lambda x: x.used < x.blocks), lambda x: x.share)) AS BIGINT) AS total FROM steps)
        WHERE total IS NOT NULL
      )
    )
  )
),
turns AS (
  SELECT slot, name, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS block
  FROM steps JOIN sizes ON i = pick
),
final AS (
  SELECT doc_id, source, mix_source, rank // {block_rows} AS block, slot, rank
  FROM placed JOIN turns ON name = mix_source AND turns.block = rank // {block_rows}
)
SELECT doc_id, source, mix_source, block, slot,
  CAST(row_number() OVER (ORDER BY slot, rank) - 1 AS BIGINT) AS position
FROM final
"""



#: Query blocks and trees change nothing in the result: every query against every other row.
TOP_SQL = """
WITH whole AS (
  SELECT vec_id, min(embedding) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
),
vectors AS (
  SELECT vec_id, list_transform(v, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM whole
  WHERE len(v) = (SELECT len(v) FROM whole GROUP BY len(v) ORDER BY count(*) DESC, len(v) DESC LIMIT 1)
),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


#: Shingles as texts, every pair of documents that share one, and the reach of each document.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.m = b.m AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
"""

_FINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _matches_sql(text: str, pattern: str) -> str:
    """Matches of a pattern in order, with their code point places, from the gaps between them."""
    both = f"(?s)(.*?)({pattern})"
    return f"""list_transform([{{'g': regexp_extract_all({text}, '{both}', 1), 'h': regexp_extract_all({text}, '{both}', 2)}}],
      lambda m: list_transform(range(1, len(m.h) + 1), lambda i: {{
        'a': CAST(list_sum(list_transform(m.g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m.h[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
        'h': m.h[i]}}))[1]"""


def pii_sql() -> str:
    """Patterns as they are given, and the disclosure of the words around their matches."""
    digits = "regexp_replace(x.h, '[^0-9]', '', 'g')"
    luhn = f"""list_sum(list_transform(range(1, length({digits}) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN CAST(reverse({digits})[i] AS INT)
        ELSE 2 * CAST(reverse({digits})[i] AS INT) - 9 * CAST(reverse({digits})[i] >= '5' AS INT) END)) % 10 = 0"""
    tests = {
        "email": "true",
        "ip": "len(list_filter(string_split(x.h, '.'), lambda p: CAST(p AS DOUBLE) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 14 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
    }
    found = " || ".join(
        f"""list_transform(list_filter({_matches_sql('t', pattern)}, lambda x: {tests[kind]}),
      lambda x: {{'a': x.a, 'k': {n}, 'b': x.a + length(x.h)}})""" for n, (kind, pattern) in enumerate(_FINDS.items())
    )
    word = r"[\p{L}\p{N}]+"
    names = "['email', 'ip', 'card', 'phone', 'term']"
    listed = f"array_to_string(list_transform(%s, lambda x: concat({names}[x.k + 1], ':', x.a, ':', x.b)), ',')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
based AS (SELECT r, doc_id, t, list_sort({found}) AS base FROM docs),
blanks AS (
  SELECT r, base, CASE WHEN len(base) = 0 THEN t ELSE array_to_string(list_transform(string_split(t, ''),
    lambda c, i: CASE WHEN len(list_filter(base, lambda y: i > y.a AND i <= y.b)) > 0 THEN ' ' ELSE c END), '') END AS t
  FROM based
),
kinds AS (SELECT k, count(*) AS n_kind FROM (SELECT DISTINCT r, s.k AS k FROM (SELECT r, unnest(base) AS s FROM based)) GROUP BY k),
has AS (SELECT DISTINCT r, s.k AS k FROM (SELECT r, unnest(base) AS s FROM based)),
words AS (SELECT DISTINCT r, lower(w) AS term FROM (SELECT r, unnest(regexp_extract_all(t, '{word}')) AS w FROM blanks)),
terms AS (SELECT term, count(*) AS n_term FROM words GROUP BY term),
both_ AS (SELECT term, k, count(*) AS n_both FROM words JOIN has USING (r) GROUP BY term, k),
tested AS (SELECT greatest(count(*), 1) AS n_tested FROM terms),
told AS (
  SELECT term, k FROM (
    SELECT *, log2(n_both * n / (n_term * n_kind)) AS lift, n_term - n_both AS apart
    FROM both_ JOIN terms USING (term) JOIN kinds USING (k), tested, (SELECT CAST(count(*) AS DOUBLE) AS n FROM docs)
    WHERE n_kind < n
  )
  WHERE round(lift / log2(n / n_kind), 9) >= {sanitise.GENERALISE}
    AND round(n_both * lift + CASE WHEN apart > 0 THEN apart * log2(apart * n / (n_term * (n - n_kind))) ELSE 0 END, 9) >= round(log2(n_tested), 9)
),
-- gaps and words in turn: their lengths add up to places
placed AS (
  SELECT r, lower(h) AS term, sum(length(g) + length(h)) OVER (PARTITION BY r ORDER BY i) - length(h) AS a, length(h) AS size
  FROM (SELECT r, generate_subscripts(regexp_extract_all(t, '(?s)(.*?)({word})', 1), 1) AS i,
          unnest(regexp_extract_all(t, '(?s)(.*?)({word})', 1)) AS g, unnest(regexp_extract_all(t, '(?s)(.*?)({word})', 2)) AS h
        FROM blanks WHERE len(base) > 0)
),
hits AS (
  SELECT r, list(DISTINCT {{'a': CAST(a AS BIGINT), 'k': 4, 'b': CAST(a + size AS BIGINT)}}) AS spans
  FROM placed JOIN told USING (term) JOIN has USING (r, k) GROUP BY r
)
SELECT doc_id,
  {', '.join(f"CAST(len(list_filter(base, lambda x: x.k = {n})) AS BIGINT) AS n_{kind}" for n, kind in enumerate(_FINDS))},
  sha256({listed % 'base'}) AS base_sha256,
  {listed % 'list_sort(base || coalesce(spans, []))'} AS spans,
  CAST(coalesce(len(spans), 0) AS BIGINT) AS n_terms
FROM based LEFT JOIN hits USING (r)
"""


_LOWERED = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _terms_sql(text: str) -> str:
    return rf"regexp_extract_all({_LOWERED % text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


#: Every document scored for every item, without bounds.
LEXICAL_SQL = f"""
WITH words AS (SELECT doc_id, {_terms_sql('text')} AS w FROM documents WHERE text IS NOT NULL),
docs AS (SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n FROM words WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM docs),
asked AS (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT q, item_id, unnest({_terms_sql('text')}) AS term FROM (SELECT row_number() OVER () AS q, * FROM benchmark))
  GROUP BY ALL
),
held AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, n, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, totals GROUP BY term, docs
),
scored AS (
  SELECT q, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 AND doc_id IS NOT NULL QUALIFY rank <= 10
"""

#: CRC-32 of each distinct word byte by byte; one sort of all rows in place of the bisection.
RESAMPLE_SQL = f"""
WITH words AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, {_terms_sql("coalesce(text, '')")} AS w FROM documents
  UNION ALL
  SELECT 't', row_number() OVER (), NULL, {_terms_sql("coalesce(text, '')")} FROM benchmark
),
steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), [CAST(0 AS BIGINT) FOR x IN range(8)]),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab
),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i:
      CAST(16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT))),
    lambda c, b: xor(c // 256, tab[CAST(xor(c % 256, b) AS INTEGER) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word, hex(word) AS h FROM (SELECT DISTINCT unnest(w) AS word FROM words)), steps
),
features AS (SELECT side, r, bucket FROM (SELECT side, r, unnest(w) AS word FROM words) JOIN hashed USING (word)),
sizes AS (SELECT count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM features),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((count(*) FILTER (side = 't') + 1)::DOUBLE * (any_value(s) + 10000)
    / ((count(*) FILTER (side = 'd') + 1)::DOUBLE * (any_value(t) + 10000)))) AS BIGINT) AS gain
  FROM features, sizes GROUP BY bucket
),
weights AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM features JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', substr(sha256(concat('2024:', doc_id)), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (r) WHERE side = 'd'
),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC) AS place,
    10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS wanted
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= wanted THEN place END AS rank FROM drawn
"""

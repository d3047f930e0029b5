"""The queries once more as plain SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from .fixtures import DAY, JOB_WORDS, JOBS_NOW, START

_A, _B = START + 4 * DAY, START + 19 * DAY
_ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"

_POSTS = rf"""
fx_posts_raw AS (
  SELECT CASE WHEN doc_id % 3 = 0 OR doc_id % 47 = 0 THEN concat('t3_', doc_id) ELSE CAST(doc_id AS VARCHAR) END AS id,
    CASE WHEN doc_id % 6 > 0 THEN concat('https://example.org/', doc_id) END AS url,
    concat('/r/', source, '/comments/', doc_id) AS permalink,
    CASE WHEN doc_id % 43 > 0 THEN doc_id % 12 END AS num_comments,
    CASE WHEN doc_id % 5 = 0 THEN concat(' ', upper(source)) ELSE source END AS subreddit,
    CASE WHEN doc_id % 17 = 0 THEN '[deleted]' WHEN doc_id % 29 = 0 THEN '' ELSE concat('u', doc_id % 97) END AS author,
    substr(text, 1, 60) AS title,
    text AS selftext,
    CASE WHEN doc_id % 31 = 0 THEN '5.7' WHEN doc_id % 37 = 0 THEN NULL ELSE CAST(doc_id % 201 - 50 AS VARCHAR) END AS score,
    CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN concat({START} + doc_id * 60, '.9')
      ELSE CAST({START} + doc_id * 60 AS VARCHAR) END AS created_utc,
    doc_id % 11 = 0 AS over_18
  FROM documents),
posts AS (
  SELECT regexp_replace(id, '^t._', '') AS id, lower(trim(subreddit)) AS subreddit,
    CASE WHEN author NOT IN ('[deleted]', '[removed]', '') THEN author END AS author,
    title, selftext, url, permalink, num_comments,
    CASE WHEN regexp_full_match(score, '[+-]?[0-9]+') THEN CAST(score AS BIGINT) END AS score,
    CAST(floor(CAST(created_utc AS DOUBLE)) AS BIGINT) AS created_epoch,
    strftime(make_timestamp(CAST(floor(CAST(created_utc AS DOUBLE)) AS BIGINT) * 1000000), {_ISO}) AS created_utc,
    author IN ('[deleted]', '[removed]', '') OR selftext IN ('[deleted]', '[removed]') AS is_deleted,
    over_18,
    concat_ws(chr(32) || chr(10) || chr(32), nullif(title, ''), nullif(selftext, '')) AS body_text
  FROM fx_posts_raw)
"""

# The same with a marker for the text of every 23rd post.
_REMOVED = _POSTS.replace("text AS selftext", "CASE WHEN doc_id % 23 = 0 THEN '[removed]' ELSE text END AS selftext")

_COMMENTS = rf"""
comments AS (
  SELECT concat('c', conv_id, '_', turn) AS id, CAST(conv_id AS VARCHAR) AS post_id,
    CASE WHEN conv_id % 19 = 7 AND turn = 0 THEN concat('t1_c', conv_id, '_1')
      WHEN turn = 0 THEN concat('t3_', conv_id)
      WHEN conv_id % 13 = 5 AND turn = 2 THEN 't1_missing'
      WHEN turn % 4 = 3 THEN concat('t1_c', conv_id, '_', turn - 2)
      ELSE concat('t1_c', conv_id, '_', turn - 1) END AS parent_id,
    concat('src', conv_id % 20) AS subreddit,
    CASE WHEN role <> 'system' THEN concat(role, conv_id % 10) END AS author,
    text AS body, turn * 3 - conv_id % 5 AS score,
    strftime(make_timestamp(({START} + conv_id * 3600 + turn * 60) * 1000000), {_ISO}) AS created_utc,
    {START} + conv_id * 3600 + turn * 60 AS created_epoch,
    role = 'system' OR text IN ('[deleted]', '[removed]') AS is_deleted
  FROM conversations)
"""

_FOREST = """
walk(id, depth, root_id) AS (
  SELECT a.id, 0, a.id FROM comments a LEFT JOIN comments p ON a.parent_id = concat('t1_', p.id) WHERE p.id IS NULL
  UNION ALL
  SELECT k.id, walk.depth + 1, walk.root_id FROM walk JOIN comments k ON k.parent_id = concat('t1_', walk.id)),
forest AS (SELECT c.id, walk.depth, walk.root_id FROM comments c LEFT JOIN walk USING (id))
"""

_WALKS = """
walks AS (
  SELECT concat('e', event_id) AS id, concat('src', user_id % 20) AS subreddit,
    CASE WHEN event_type IN ('view', 'click') THEN 'posts' ELSE 'comments' END AS kind,
    event_type, CAST(floor(epoch(ts)) AS BIGINT) AS created_epoch
  FROM events)
"""

_HALF_WAY = f"""
half_way AS (
  SELECT subreddit, 'arctic_shift' AS backend, kind, CAST({_A} AS BIGINT) AS window_start_epoch,
    CAST({_B} AS BIGINT) AS window_end_epoch, max(created_epoch) AS cursor_epoch,
    CASE WHEN CAST(substr(subreddit, 4) AS INT) % 2 = 0 THEN 'complete' ELSE 'in_progress' END AS status,
    count(*) AS items_fetched
  FROM walks WHERE created_epoch >= {_A} AND created_epoch < {_A + 5 * DAY} GROUP BY subreddit, kind)
"""

_SUMMARY = f"""
asked AS (SELECT concat('src', n_nationkey) AS subreddit, kind FROM nation, (VALUES ('posts'), ('comments')) v(kind)),
summary AS (
  SELECT a.subreddit, 'arctic_shift' AS backend, a.kind, CAST({_A} AS BIGINT) AS window_start_epoch,
    CAST({_B} AS BIGINT) AS window_end_epoch, CAST(coalesce(max(created_epoch), {_B}) AS BIGINT) AS cursor_epoch,
    CASE WHEN count(w.id) = 0 THEN 'complete' ELSE 'in_progress' END AS status, count(w.id) AS items_fetched
  FROM asked a LEFT JOIN walks w ON w.subreddit = a.subreddit AND w.kind = a.kind
    AND created_epoch >= {_A} AND created_epoch < {_B} GROUP BY a.subreddit, a.kind)
"""

_SNAPSHOTS = """
snaps AS (
  SELECT concat('u', user_id) AS id, concat('src', user_id % 20) AS subreddit, event_type AS kind,
    event_id, CAST(floor(epoch(ts)) AS BIGINT) AS created_epoch, CAST(floor(value) AS BIGINT) AS score,
    props AS raw
  FROM events)
"""


def _word(text: str, word: str) -> str:
    return rf"regexp_matches({text}, '(^|[^\p{{L}}\p{{N}}_]){word}($|[^\p{{L}}\p{{N}}_])', 'i')"


def _terms(text: str, keywords: list[str], regexes: dict[str, str]) -> str:
    parts = [f"CASE WHEN contains(lower({text}), '{k}') THEN '{k}' END" for k in keywords]
    parts += [f"CASE WHEN regexp_matches({text}, '{p}', 'i') THEN '{w}' END" for w, p in regexes.items()]
    return f"list_sort(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL))"


_KEYWORDS = ["the", "ation", "été", "ich", "stupid"]
_REGEXES = {
    r"\bof\s+the\b": r"(^|[^\p{L}\p{N}\p{M}_])of\s+the($|[^\p{L}\p{N}\p{M}_])",
    r"(?P<first>[aeiou])ng\b": r"[aeiou]ng($|[^\p{L}\p{N}\p{M}_])",
    r"[0-9]{3,}": r"[0-9]{3,}",
}


def _flag_sql(keywords: list[str], regexes: dict[str, str]) -> str:
    return f"""
WITH {_POSTS}, {_COMMENTS},
found AS (
  SELECT 'post' AS type, id, {_terms('body_text', keywords, regexes)} AS terms FROM posts
  UNION ALL
  SELECT 'comment', id, {_terms('body', keywords, regexes)} FROM comments)
SELECT type, id, 'keyword-match' AS flag_reason, array_to_string(terms, ', ') AS matched_terms
FROM found WHERE len(terms) > 0
"""


_TWO_BATCHES = """
marked AS (SELECT *, CASE WHEN event_id % 2 = 0 AND score >= 40 THEN TRUE END AS flagged FROM snaps),
ranked AS (
  SELECT *, event_id % 2 AS batch,
    row_number() OVER (PARTITION BY id, event_id % 2 ORDER BY created_epoch DESC, event_id DESC) AS r,
    min(created_epoch) OVER (PARTITION BY id, event_id % 2) AS first_epoch,
    bool_or(flagged) OVER (PARTITION BY id, event_id % 2) AS any_flag
  FROM marked),
o AS (SELECT * FROM ranked WHERE batch = 0 AND r = 1),
n AS (SELECT * FROM ranked WHERE batch = 1 AND r = 1)
SELECT coalesce(n.subreddit, o.subreddit) AS subreddit, id, coalesce(n.kind, o.kind) AS kind,
  CASE WHEN n.event_id IS NOT NULL THEN n.score ELSE o.score END AS score,
  coalesce(n.event_id, o.event_id) AS event_id,
  coalesce(o.any_flag, n.any_flag) AS flagged,
  coalesce(o.first_epoch, n.first_epoch) AS fetched,
  coalesce(n.created_epoch, o.created_epoch) AS updated
FROM o FULL OUTER JOIN n USING (id)
"""


_UPSERT = f"WITH {_SNAPSHOTS}, {_TWO_BATCHES}"

_JOB_FACTS = """
facts AS (
  SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS job_id, c_nationkey AS n,
    c_custkey % 12 AS t, c_custkey % 7 AS w FROM customer),
named AS (
  SELECT *,
    CASE WHEN t IN (0, 1, 2, 3, 11) THEN concat('src', n)
      WHEN t = 4 THEN concat('src', n, ',src', n + 1)
      WHEN t = 5 THEN concat('src', n, ',src', n + 2)
      WHEN t = 9 THEN 'src1' ELSE '' END AS subreddits,
    CASE WHEN t IN (6, 10) THEN 'target is required' WHEN t IN (7, 8) THEN 'target is not a subreddit name'
      WHEN t = 9 THEN 'target entries must be text' END AS target_error,
    CASE w WHEN 1 THEN 1735689600 WHEN 2 THEN 1704164645 WHEN 3 THEN 1735689600 WHEN 4 THEN 1738281600 END AS start_epoch,
    CASE w WHEN 1 THEN 1738281600 WHEN 2 THEN 1704844800 WHEN 4 THEN 1735689600 WHEN 5 THEN 1738368000 END AS end_day,
    CASE w WHEN 3 THEN 'endDate is required when startDate is set' WHEN 4 THEN 'startDate must not be after endDate'
      WHEN 5 THEN 'startDate is not a date'
      WHEN 6 THEN CASE WHEN k % 70 = 13 THEN 'lastDays is too large' WHEN k % 70 <> 6 AND k % 5 = 0 THEN 'lastDays must be greater than 0' END END AS date_error,
    CASE WHEN k % 13 = 0 THEN 'unknown backend' END AS backend_error,
    CASE WHEN k % 70 = 6 THEN 30000 WHEN k % 70 = 13 THEN 3000000000 WHEN w = 6 AND k % 5 > 0 THEN k % 5 END AS last_days
  FROM facts),
specs AS (SELECT *, coalesce(target_error, date_error, backend_error) AS error FROM named)
"""

_MATCHED = rf"""
jobs AS (
  SELECT concat('n', n_nationkey) AS job_id, n_nationkey AS n,
    CASE n_nationkey % 3 WHEN 0 THEN {START} WHEN 1 THEN {START} ELSE {JOBS_NOW - 20 * DAY} END AS after_epoch,
    CASE n_nationkey % 3 WHEN 0 THEN {START + 5 * DAY - 1} WHEN 1 THEN 1735689600 - 1 ELSE {JOBS_NOW} END AS before_epoch
  FROM nation),
targets AS (
  SELECT *, concat('src', n % 20) AS target FROM jobs
  UNION ALL SELECT *, concat('src', (n + 7) % 20) FROM jobs),
records AS (
  SELECT 'post' AS type, id, subreddit, created_epoch, created_utc, body_text AS txt FROM posts
  UNION ALL SELECT 'comment', id, subreddit, created_epoch, created_utc, body FROM comments),
matched AS (
  SELECT job_id, target, type, id, subreddit, created_epoch, created_utc
  FROM targets JOIN records ON subreddit = target AND created_epoch >= after_epoch AND created_epoch < before_epoch
  WHERE (type = 'post' OR n % 4 <> 3) AND CASE n % 5
    WHEN 0 THEN {_word('txt', 'the')} OR {_word('txt', 'und')}
    WHEN 1 THEN {_word('txt', 'of')} AND {_word('txt', 'the')} AND NOT {_word('txt', 'und')}
    WHEN 2 THEN contains(lower(txt), 'of the')
    WHEN 3 THEN txt <> '' AND NOT {_word('txt', 'the')} AND NOT {_word('txt', 'è')}
    ELSE TRUE END)
"""



def _job_word(number: str) -> str:
    return f"[{', '.join(repr(w) for w in JOB_WORDS)}][({number}) % {len(JOB_WORDS)} + 1]"


# A job per customer, decided on the lists of a record's words.
_MANY = rf"""
jobs AS (
  SELECT c_custkey AS k, concat('c', c_custkey) AS job_id, concat('src', c_custkey % 20) AS target,
    {START} + (c_custkey % 9) * {DAY} AS after_epoch, {START} + (c_custkey % 10 + 10) * {DAY} - 1 AS before_epoch,
    CASE WHEN c_custkey % 4 < 2 THEN [{_job_word('c_custkey')}, {_job_word('c_custkey + 1')}] ELSE [] END AS all_words,
    CASE WHEN c_custkey % 3 = 0 THEN [{_job_word('c_custkey * 7')}, {_job_word('c_custkey * 3 + 5')}] ELSE [] END AS any_words,
    CASE WHEN c_custkey % 5 = 1 THEN [{_job_word('c_custkey * 11 + 2')}] ELSE [] END AS none_words
  FROM customer),
records AS (
  SELECT 'post' AS type, id, subreddit, created_epoch, body_text AS t FROM posts
  UNION ALL SELECT 'comment', id, subreddit, created_epoch, coalesce(body, '') FROM comments),
worded AS (SELECT *, list_transform(regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+'), lambda x: lower(x)) AS w FROM records),
pairs AS (
  SELECT j.*, r.*, row_number() OVER (PARTITION BY k, type ORDER BY created_epoch, id) AS place
  FROM jobs j JOIN worded r ON r.subreddit = j.target AND created_epoch >= after_epoch AND created_epoch < before_epoch)
SELECT job_id, type, id, subreddit, created_epoch FROM pairs
WHERE (k % 7 > 0 OR place <= 10)
  AND (len(all_words) + len(any_words) + len(none_words) = 0 OR (t <> '' AND list_has_all(w, all_words)
    AND (len(any_words) = 0 OR list_has_any(w, any_words)) AND NOT list_has_any(w, none_words)))
"""


_LEDGER = f"""
numbered AS (SELECT *, CAST(substr(id, 2) AS BIGINT) AS number, created_epoch // 3600 AS slice FROM walks),
cells AS (
  SELECT subreddit, kind, slice, greatest(slice * 3600, {_A + 1000}) AS slice_start, least(slice * 3600 + 3600, {_B}) AS slice_end
  FROM (SELECT DISTINCT subreddit, kind FROM numbered), range({(_A + 1000) // 3600}, {(_B - 1) // 3600 + 1}) r(slice)),
broken AS (
  SELECT c.subreddit, c.kind, c.slice, bool_or(number % 3 = 0) AS no_dump, bool_or(number % 4 = 1) AS no_mirror
  FROM cells c JOIN numbered n ON n.subreddit = c.subreddit AND n.kind = c.kind AND event_type = 'signup'
    AND created_epoch < slice_end AND created_epoch + 60 > slice_start
  GROUP BY ALL),
asked AS (
  SELECT c.*, coalesce(no_dump, false) AS no_dump, coalesce(no_mirror, false) AS no_mirror,
    CAST(regexp_extract(c.subreddit, '([0-9]+)', 1) AS INT) % 2 = 1 AS odd
  FROM cells c LEFT JOIN broken b ON b.subreddit = c.subreddit AND b.kind = c.kind AND b.slice = c.slice),
chosen AS (
  SELECT *, CASE WHEN no_dump AND no_mirror THEN NULL WHEN no_dump THEN 'mirror' WHEN no_mirror THEN 'dump' WHEN odd THEN 'mirror' ELSE 'dump' END AS source,
    CASE WHEN no_dump AND no_mirror THEN CASE WHEN odd THEN 'mirror, dump' ELSE 'dump, mirror' END
      WHEN no_dump THEN 'dump' WHEN no_mirror THEN 'mirror' ELSE '' END AS failed
  FROM asked),
served AS (
  SELECT c.subreddit, c.kind, c.slice_start, c.slice_end, %s AS source, failed,
    count(n.id) FILTER (%s = 'mirror' OR (%s = 'dump' AND number %% 10 > 0)) AS records
  FROM chosen c LEFT JOIN numbered n ON n.subreddit = c.subreddit AND n.kind = c.kind AND created_epoch >= slice_start AND created_epoch < slice_end
  GROUP BY ALL)
"""
_AGAIN = "(CASE WHEN source IS NULL AND slice_start % 7200 = 0 THEN 'mirror' ELSE source END)"


def _paged(matched: str) -> str:
    """The same matches where a job with an even number sees its first 5 to 15 records only."""
    head, tail = matched.split("  FROM targets JOIN records", 1)
    join, where = tail.split("  WHERE ", 1)
    return f"""{head}  FROM (SELECT * FROM targets JOIN records{join}
    QUALIFY n % 2 = 1 OR row_number() OVER (PARTITION BY job_id, target, type ORDER BY created_epoch, id) <= 5 * (n % 3 + 1))
  WHERE {where}"""


_JOB_STATS = f"""
WITH {_POSTS}, {_COMMENTS}, {_MATCHED}
SELECT t.job_id, t.target, 'subreddit' AS target_type, count(m.id) AS records,
  strftime(make_timestamp(min(m.created_epoch) * 1000000), '%Y-%m-%dT%H:%M:%S') AS oldest_post_date
FROM targets t LEFT JOIN matched m ON m.job_id = t.job_id AND m.target = t.target
GROUP BY t.job_id, t.target
"""

ORACLE = {
    "norm_posts": f"WITH {_REMOVED} SELECT * EXCLUDE (body_text) FROM posts",
    "norm_comments": f"WITH {_COMMENTS} SELECT * FROM comments",
    "rejected_records": """
SELECT CASE WHEN conv_id % 22 = 0 THEN 'no id' ELSE 'no post' END AS reason, count(*) AS records
FROM conversations WHERE conv_id % 22 = 0 OR turn = 3 OR conv_id % 9 = 0 GROUP BY 1""",
    "deleted_share_by_subreddit": f"""
WITH {_REMOVED} SELECT subreddit, count(*) AS posts, count(*) FILTER (is_deleted) AS deleted
FROM posts GROUP BY subreddit""",
    "raw_json_props": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.missing') AS missing FROM events""",
    "target_names": """
SELECT doc_id, concat(lower(source), ' ', lang) AS target,
  concat('_r_', lower(source), '_', lang) AS folder FROM documents""",
    "filter_all_any_none": f"""
WITH {_POSTS} SELECT id FROM posts
WHERE {_word('body_text', 'of')} AND {_word('body_text', 'the')}
  AND ({_word('body_text', 'by')} OR {_word('body_text', 'with')} OR {_word('body_text', 'été')})
  AND NOT {_word('body_text', 'und')} AND NOT {_word('body_text', 'stupid')}""",
    "filter_none_only": f"""
WITH {_POSTS} SELECT id FROM posts
WHERE body_text <> '' AND NOT {_word('body_text', 'the')} AND NOT {_word('body_text', 'è')}""",
    "filter_phrase": f"WITH {_POSTS} SELECT id FROM posts WHERE contains(lower(body_text), 'of the')",
    "filter_comments": f"""
WITH {_COMMENTS} SELECT id, subreddit FROM comments
WHERE ({_word('body', 'the')} OR {_word('body', 'la')} OR {_word('body', 'die')}) AND NOT {_word('body', 'of')}""",
    "window_slice": f"""
WITH {_WALKS} SELECT id, subreddit, kind, created_epoch FROM walks
WHERE subreddit IN ('src1', 'src4', 'src7') AND created_epoch >= {_A} AND created_epoch < {_B}""",
    "flag_keywords": _flag_sql(_KEYWORDS, {}),
    "flag_many_keywords": rf"""
WITH {_POSTS}, {_COMMENTS},
words AS (SELECT unnest(regexp_split_to_array(text, '\s+')) AS w FROM benchmark),
terms AS (
  SELECT DISTINCT lower(w) AS term FROM (SELECT w FROM words UNION ALL SELECT substr(w, 2, 2) FROM words
    UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part) WHERE trim(w) <> ''),
records AS (SELECT 'post' AS type, id, lower(body_text) AS t FROM posts UNION ALL SELECT 'comment', id, lower(body) FROM comments)
SELECT type, id, 'keyword-match' AS flag_reason, array_to_string(list_sort(list(term)), ', ') AS matched_terms
FROM records JOIN terms ON contains(t, term) GROUP BY type, id""",
    "flag_regex": _flag_sql([], _REGEXES),
    "flag_counts": f"""
WITH {_POSTS}, {_COMMENTS}
SELECT 'posts' AS kind, count(*) FILTER (len({_terms('body_text', _KEYWORDS, _REGEXES)}) > 0) AS matches FROM posts
UNION ALL
SELECT 'comments', count(*) FILTER (len({_terms('body', _KEYWORDS, _REGEXES)}) > 0) FROM comments""",
    "flagged_posts_report": f"""
WITH {_POSTS}, found AS (SELECT *, {_terms('body_text', _KEYWORDS, _REGEXES)} AS terms FROM posts)
SELECT id, subreddit, author, title, selftext, score, created_utc, permalink,
  array_to_string(terms, ', ') AS matched_terms FROM found WHERE len(terms) > 0 ORDER BY created_utc, subreddit, id""",
    "flagged_comments_context": f"""
WITH {_POSTS}, {_COMMENTS}, found AS (SELECT *, {_terms('body', _KEYWORDS, _REGEXES)} AS terms FROM comments)
SELECT f.id, f.post_id, coalesce(p.subreddit, f.subreddit) AS subreddit, f.author, f.body, f.score, f.created_utc,
  array_to_string(terms, ', ') AS matched_terms, p.title AS post_title
FROM found f LEFT JOIN posts p ON p.id = f.post_id WHERE len(terms) > 0""",
    "filter_run_report": f"""
WITH RECURSIVE {_POSTS}, {_COMMENTS}, {_FOREST},
kept AS (SELECT *, {_terms('body_text', _KEYWORDS, _REGEXES)} AS terms FROM posts WHERE created_epoch IS NOT NULL),
said AS (SELECT *, {_terms('body', _KEYWORDS, _REGEXES)} AS terms FROM comments)
SELECT 'post' AS type, id, subreddit, score, CAST(NULL AS INT) AS depth, created_utc, array_to_string(terms, ', ') AS matched_terms, FALSE AS titled
FROM kept WHERE len(terms) > 0
UNION ALL
SELECT 'comment', s.id, s.subreddit, s.score, f.depth, s.created_utc, array_to_string(s.terms, ', '), k.id IS NOT NULL
FROM said s JOIN forest f USING (id) LEFT JOIN kept k ON k.id = s.post_id AND k.subreddit = s.subreddit
WHERE len(s.terms) > 0""",
    "lines_compaction": f"""
WITH RECURSIVE {_COMMENTS}, {_FOREST}, t AS (SELECT *, CAST(regexp_extract(id, '_([0-9]+)$', 1) AS INT) % 2 = 0 AS even FROM comments)
SELECT id, parent_id, body, score + CASE WHEN even THEN 100 ELSE 0 END AS score, depth, CASE WHEN even THEN 2 ELSE 1 END AS day,
  (SELECT count(*) + count(*) FILTER (even) FROM t) AS lines
FROM t JOIN forest USING (id)""",
    "comment_depth": f"WITH RECURSIVE {_COMMENTS}, {_FOREST} SELECT id, depth FROM forest",
    "comments_with_depth": f"""
WITH RECURSIVE {_COMMENTS}, {_FOREST} SELECT id, depth, author, score, body FROM forest JOIN comments USING (id)""",
    "late_parent_depth": f"""
WITH RECURSIVE {_COMMENTS}, {_FOREST}
SELECT id, CASE WHEN parent_id LIKE 't1#_%' ESCAPE '#' THEN substr(parent_id, 4) END AS parent, depth, root_id
FROM comments JOIN forest USING (id)""",
    "depth_histogram": f"""
WITH RECURSIVE {_COMMENTS}, {_FOREST}
SELECT coalesce(depth, -1) AS depth, count(*) AS comments FROM forest GROUP BY 1""",
    "thread_roots": f"""
WITH RECURSIVE {_COMMENTS}, {_FOREST}
SELECT root_id, count(*) AS comments, max(depth) AS max_depth FROM forest WHERE root_id IS NOT NULL GROUP BY root_id""",
    "orphans": f"""
WITH {_COMMENTS} SELECT id, parent_id FROM comments
WHERE parent_id LIKE 't1#_%' ESCAPE '#' AND substr(parent_id, 4) NOT IN (SELECT id FROM comments)""",
    "child_edges": f"""
WITH {_COMMENTS} SELECT substr(parent_id, 4) AS parent, id AS child, created_epoch AS epoch FROM comments
WHERE parent_id LIKE 't1#_%' ESCAPE '#'""",
    "children_per_comment": f"""
WITH {_COMMENTS} SELECT subreddit, substr(parent_id, 4) AS parent, count(*) AS children,
  arg_min(id, created_epoch) AS first_child, arg_max(id, created_epoch) AS last_child
FROM comments WHERE parent_id LIKE 't1#_%' ESCAPE '#' GROUP BY 1, 2""",
    "thread_preview": f"""
WITH RECURSIVE {_COMMENTS},
paths(id, depth, path) AS (
  SELECT a.id, 0, [(a.created_epoch, a.id)] FROM comments a LEFT JOIN comments p ON a.parent_id = concat('t1_', p.id) WHERE p.id IS NULL
  UNION ALL
  SELECT k.id, paths.depth + 1, list_append(paths.path, (k.created_epoch, k.id)) FROM paths JOIN comments k ON k.parent_id = concat('t1_', paths.id)),
flat AS (
  SELECT path, concat(repeat('  ', depth), '- (', coalesce(author, '[deleted]'), ') ',
    CASE WHEN length(body) > 70 THEN concat(substr(replace(body, chr(10), ' '), 1, 67), '...') ELSE replace(body, chr(10), ' ') END) AS line
  FROM paths JOIN comments USING (id)),
first AS (SELECT CAST(row_number() OVER (ORDER BY path) AS INT) AS line_no, line FROM flat ORDER BY path LIMIT 40)
SELECT line_no, line FROM first UNION ALL SELECT 41, '  ...' WHERE (SELECT count(*) FROM first) >= 40""",
    "dry_run_counts": f"""
WITH {_COMMENTS}, s AS (SELECT * FROM comments ORDER BY created_epoch, id LIMIT 2000)
SELECT count(*) AS comments, count(*) FILTER (
  parent_id NOT LIKE 't1#_%' ESCAPE '#' OR substr(parent_id, 4) NOT IN (SELECT id FROM s)) AS roots FROM s""",
    "nested_threads": f"""
WITH RECURSIVE {_COMMENTS},
paths(id, root_id, depth, path) AS (
  SELECT a.id, a.id, 0, [(a.created_epoch, a.id)] FROM comments a LEFT JOIN comments p ON a.parent_id = concat('t1_', p.id) WHERE p.id IS NULL
  UNION ALL
  SELECT k.id, paths.root_id, paths.depth + 1, list_append(paths.path, (k.created_epoch, k.id)) FROM paths JOIN comments k ON k.parent_id = concat('t1_', paths.id)),
shape AS (
  SELECT *, coalesce(lead(depth) OVER (PARTITION BY root_id ORDER BY path), -1) AS next_depth,
    lag(depth) OVER (PARTITION BY root_id ORDER BY path) AS prev_depth FROM paths),
closing AS (SELECT *, CASE WHEN next_depth > depth THEN 0 WHEN next_depth < 0 THEN depth + 1 ELSE depth - next_depth + 1 END AS closes FROM shape)
SELECT root_id, id, depth, closes,
  concat(CASE WHEN prev_depth >= depth THEN ',' ELSE '' END,
    '{{"id":"', id, '","parent_id":"', parent_id, '","author":', CASE WHEN author IS NULL THEN 'null' ELSE concat('"', author, '"') END,
    ',"score":', score, ',"created_epoch":', created_epoch, ',"is_deleted":', is_deleted, ',"replies":[', repeat(']}}', closes)) AS fragment
FROM closing JOIN comments USING (id)""",
    "flatten_tree": """
WITH lines AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM conversations)
SELECT conv_id, turn, CAST(line_no AS INT) AS level, line_no, line FROM lines""",
    "flatten_deep": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS word,
    generate_subscripts(regexp_split_to_array(text, '\s+'), 1) - 1 AS word_no FROM documents WHERE doc_id % 10 > 0)
SELECT doc_id, CAST(word_no AS INT) AS level, word_no, word, word_no AS note FROM words""",
    "flatten_unreadable": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS word,
    generate_subscripts(regexp_split_to_array(text, '\s+'), 1) - 1 AS i FROM documents WHERE doc_id % 10 = 0)
SELECT doc_id,
  CAST(9 + sum(31 + 2 * length(CAST(i AS VARCHAR)) + length(CAST(to_json(word) AS VARCHAR)) + [14, 23, 28][i % 3 + 1]) AS BIGINT) AS characters,
  'too deep or not JSON' AS reason
FROM words GROUP BY doc_id""",
    "timeline": f"""
WITH {_POSTS}, {_COMMENTS}
SELECT 'post' AS type, id, CAST(NULL AS VARCHAR) AS post_id, CAST(NULL AS VARCHAR) AS parent_id, subreddit, author, title,
  CAST(NULL AS VARCHAR) AS body, score, created_utc, created_epoch, is_deleted, over_18 FROM posts
UNION ALL
SELECT 'comment', id, post_id, parent_id, subreddit, author, NULL, body, score, created_utc, created_epoch, is_deleted, NULL FROM comments
ORDER BY coalesce(created_epoch, 0), id, type DESC""",
    "count_by_type": """
SELECT (SELECT count(*) FROM documents) AS post, (SELECT count(*) FROM conversations) AS comment""",
    "merge_counts": f"""
WITH {_POSTS}, {_COMMENTS}, u AS (
  SELECT subreddit, 1 AS p, 0 AS c FROM posts UNION ALL SELECT subreddit, 0, 1 FROM comments)
SELECT subreddit, CAST(sum(p) AS BIGINT) AS post, CAST(sum(c) AS BIGINT) AS comment, count(*) AS records
FROM u GROUP BY subreddit""",
    "first_n_per_subreddit": f"""
WITH {_POSTS} SELECT id, subreddit, created_epoch FROM posts
QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY coalesce(created_epoch, 0), id) <= 10""",
    "dry_run_slice": f"""
WITH {_WALKS} SELECT id, subreddit, created_epoch FROM walks
WHERE subreddit = 'src3' AND created_epoch >= {START + 6 * DAY} AND created_epoch < {START + 9 * DAY}
ORDER BY created_epoch, id LIMIT 40""",
    "dedup_last_wins": f"""
WITH {_SNAPSHOTS} SELECT * FROM snaps
QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_epoch DESC, event_id DESC) = 1""",
    "first_seen": f"WITH {_SNAPSHOTS} SELECT id, min(created_epoch) AS first_seen_epoch FROM snaps GROUP BY id",
    "upsert_merge": _UPSERT,
    "upsert_small_batch": _UPSERT,
    "upsert_in_buckets": _UPSERT,
    "upsert_by_versions": f"""
WITH {_SNAPSHOTS}
SELECT subreddit, id, kind, score, event_id,
  CASE WHEN bool_or(score >= 40) OVER (PARTITION BY id) THEN TRUE END AS flagged,
  min(created_epoch) OVER (PARTITION BY id) AS fetched, created_epoch AS updated
FROM snaps QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_epoch DESC, event_id DESC) = 1""",
    "score_refresh": f"""
WITH {_SNAPSHOTS}, last AS (
  SELECT * FROM snaps WHERE kind IN ('purchase', 'error')
  QUALIFY row_number() OVER (PARTITION BY id, kind ORDER BY created_epoch DESC, event_id DESC) = 1)
SELECT p.id, p.kind, CASE WHEN e.id IS NULL THEN p.score ELSE e.score END AS score, p.event_id
FROM (SELECT * FROM last WHERE kind = 'purchase') p LEFT JOIN (SELECT * FROM last WHERE kind = 'error') e ON e.id = p.id""",
    "subreddit_upsert": """
WITH o AS (SELECT lower(source) AS name, concat('{"lang":"', arg_max(lang, doc_id), '"}') AS raw FROM documents GROUP BY 1),
n AS (SELECT DISTINCT concat('src', conv_id % 25) AS name FROM conversations)
SELECT name, CAST(CASE WHEN o.raw IS NULL THEN 1706832000 ELSE 1706745600 END AS BIGINT) AS first_seen, o.raw AS raw,
  CAST(CASE WHEN n.name IS NULL THEN 1706745600 ELSE 1706832000 END AS BIGINT) AS updated
FROM o FULL OUTER JOIN n USING (name)""",
    "target_stats": f"""
WITH {_POSTS}, {_COMMENTS},
records AS (SELECT subreddit, created_epoch FROM posts UNION ALL SELECT subreddit, created_epoch FROM comments),
listed AS (SELECT concat('r/Src', n_nationkey + 5) AS target, concat('src', n_nationkey + 5) AS name FROM nation)
SELECT coalesce(l.target, r.subreddit) AS target, 'subreddit' AS target_type, count(r.subreddit) AS records,
  strftime(make_timestamp(min(r.created_epoch) * 1000000), '%Y-%m-%dT%H:%M:%S') AS oldest_post_date
FROM listed l FULL OUTER JOIN records r ON r.subreddit = l.name GROUP BY 1""",
    "checkpoint_summary": f"WITH {_WALKS}, {_SUMMARY} SELECT * FROM summary",
    "progress_fraction": f"""
WITH {_WALKS}, {_HALF_WAY}, f AS (SELECT *, (cursor_epoch - {_A}) / ({_B} - {_A}) AS done FROM half_way)
SELECT subreddit, kind, strftime(make_timestamp(cursor_epoch * 1000000), '%Y-%m-%d %H:%M') AS reached,
  CAST(floor(done * 10000 + 0.5) AS BIGINT) AS fraction_bp,
  CASE WHEN done > 0.01 THEN CAST(floor(600.0 * (1 - done) / done + 0.5) AS BIGINT) END AS eta FROM f""",
    "resume_skip": f"""
WITH {_WALKS}, {_HALF_WAY}
SELECT w.id, w.subreddit, w.kind, w.created_epoch FROM walks w LEFT JOIN half_way h
  ON h.subreddit = w.subreddit AND h.kind = w.kind
WHERE coalesce(h.status, '') <> 'complete' AND w.created_epoch >= coalesce(h.cursor_epoch, {_A}) AND w.created_epoch < {_B}""",
    "progress_merge": f"""
WITH {_WALKS}, {_HALF_WAY}, {_SUMMARY}, later AS (SELECT * FROM summary WHERE kind = 'posts')
SELECT * FROM later UNION ALL
SELECT * FROM half_way h WHERE NOT EXISTS (SELECT 1 FROM later l WHERE l.subreddit = h.subreddit AND l.kind = h.kind)""",
    "source_fallback": f"""
WITH {_WALKS}, s AS (
  SELECT *, created_epoch // 3600 AS hour,
    list_position(['click', 'error', 'signup', 'view', 'purchase'], event_type) AS rank
  FROM walks)
SELECT id, subreddit, event_type, created_epoch FROM s
QUALIFY rank = min(rank) OVER (PARTITION BY subreddit, hour)""",
    "slice_ledger": f"WITH {_WALKS}, {_LEDGER.replace('%%', '%').replace('%s', 'source')} SELECT * FROM served",
    "slice_resume": f"""
WITH {_WALKS}, {_LEDGER.replace('%%', '%').replace('%s', _AGAIN)}
SELECT subreddit, kind, CAST(coalesce(min(slice_start) FILTER (source IS NULL), max(slice_end)) AS BIGINT) AS cursor_epoch,
  CASE WHEN count(*) FILTER (source IS NULL) = 0 THEN 'complete' ELSE 'in_progress' END AS status,
  CAST(sum(records) AS BIGINT) AS items_fetched, count(*) FILTER (source IS NULL) AS open_slices
FROM served GROUP BY subreddit, kind""",
    "page_cursor": f"""
SELECT event_id AS page, CAST(CASE event_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 3 THEN NULL WHEN 5 THEN 1 ELSE 0 END AS BIGINT) AS items,
  CASE event_id % 6 WHEN 0 THEN {START} + user_id WHEN 1 THEN {START} + event_id END AS next_cursor,
  event_id % 6 IN (2, 4) AS exhausted, event_id % 6 = 3 AS unreadable FROM events""",
    "deep_page_cursor": f"""
SELECT doc_id AS page, CASE WHEN doc_id % 10 > 0 THEN CAST(3 AS BIGINT) END AS items,
  CASE WHEN doc_id % 10 > 0 THEN {START} + 2 * doc_id END AS next_cursor, FALSE AS exhausted, doc_id % 10 = 0 AS unreadable FROM documents""",
    "unreadable_inputs": """
SELECT event_id AS page, CAST(8 AS BIGINT) AS characters, 'not JSON' AS reason FROM events WHERE event_id % 6 = 3""",
    "page_items": """
WITH p AS (SELECT event_id, props, event_id % 6 AS f FROM events)
SELECT event_id AS page, CAST(i AS INT) AS place, CASE WHEN f = 5 THEN NULL ELSE ['a', 'b', 'c'][i + 1] END AS id,
  CASE WHEN f = 5 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM p, range(3) r(i) WHERE i < CASE f WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 5 THEN 1 ELSE 0 END""",
    "id_map_records": "SELECT concat(conv_id, '_', turn) AS key, role, text FROM conversations",
    "map_files": """
SELECT conv_id // 10 AS folder, concat(conv_id, '_', turn) AS key, role, text FROM conversations WHERE conv_id // 10 % 7 <> 3""",
    "map_files_broken": "SELECT DISTINCT conv_id // 10 AS folder FROM conversations WHERE conv_id // 10 % 7 = 3",
    "job_specs": f"""
WITH {_JOB_FACTS}
SELECT job_id, error,
  concat_ws('; ', CASE WHEN k % 4 = 3 THEN 'unknown fields: lastdays, oops' END,
    CASE WHEN k % 4 = 3 THEN 'language is ignored' END) AS warnings,
  subreddits, CAST(start_epoch AS BIGINT) AS start_epoch, CAST(end_day + 86399 AS BIGINT) AS end_epoch, CAST(last_days AS BIGINT) AS last_days,
  CASE WHEN k % 3 = 0 THEN 'blue,red' ELSE '' END AS all_words,
  CASE WHEN k % 3 = 0 THEN 'green,grey,red,7' ELSE '' END AS any_words,
  CASE WHEN k % 3 = 1 THEN 'Rain' ELSE '' END AS none_words,
  CASE WHEN k % 3 = 1 THEN 'open water' END AS exact_phrase,
  TRUE AS fetch_posts, k % 4 NOT IN (0, 1) AS fetch_comments,
  CASE WHEN k % 13 = 0 THEN 'nope' WHEN k % 4 = 2 THEN 'pullpush,arctic_shift' ELSE '' END AS backends,
  CASE WHEN k % 4 = 2 THEN CAST(3 AS BIGINT) END AS max_pages
FROM specs""",
    "job_windows": f"""
WITH {_JOB_FACTS}, w2 AS (
  SELECT *, CASE WHEN w IN (1, 2) THEN start_epoch WHEN last_days IS NOT NULL THEN {JOBS_NOW} - last_days * 86400
      ELSE {JOBS_NOW} - 365 * 86400 END AS after_epoch,
    CASE WHEN w IN (1, 2) THEN end_day + 86399 ELSE {JOBS_NOW} END AS before_epoch
  FROM specs WHERE error IS NULL)
SELECT job_id, CAST(after_epoch AS BIGINT) AS after_epoch, CAST(before_epoch AS BIGINT) AS before_epoch,
  concat('reddit_', job_id, '_', CASE WHEN contains(subreddits, ',') THEN '2subs' ELSE subreddits END, '_',
    CASE WHEN w IN (1, 2) THEN concat(after_epoch, '_', before_epoch) ELSE 'any_any' END, '_', {JOBS_NOW}) AS job_key
FROM w2""",
    "job_matches": f"""
WITH {_POSTS}, {_COMMENTS}, {_MATCHED} SELECT job_id, type, id, subreddit, created_epoch FROM matched""",
    "job_matches_many": f"WITH {_POSTS}, {_COMMENTS}, {_MANY}",
    "job_target_stats": _JOB_STATS,
    "job_first_pages": f"""
WITH {_POSTS}, {_COMMENTS}, {_paged(_MATCHED)} SELECT job_id, type, id, subreddit, created_epoch FROM matched""",
    "job_run_report": f"""
WITH {_POSTS}, {_COMMENTS}, {_MATCHED}, {_JOB_FACTS},
counts AS (SELECT job_id, count(*) FILTER (type = 'post') AS posts, count(*) FILTER (type = 'comment') AS comments FROM matched GROUP BY job_id)
SELECT concat('n', n_nationkey) AS job_id, 'success' AS status, CAST(NULL AS VARCHAR) AS error,
  concat('reddit_n', n_nationkey, '_2subs_', CASE n_nationkey % 3 WHEN 0 THEN '{START}_{START + 5 * DAY - 1}' WHEN 1 THEN '{START}_{1735689600 - 1}' ELSE 'any_any' END, '_{JOBS_NOW}') AS job_key,
  coalesce(posts, 0) AS posts, coalesce(comments, 0) AS comments
FROM nation LEFT JOIN counts ON job_id = concat('n', n_nationkey)
UNION ALL
SELECT job_id, 'error', error, NULL, NULL, NULL FROM specs WHERE k % 12 BETWEEN 6 AND 10""",
    "job_counts": f"""
WITH {_POSTS}, {_COMMENTS}, {_MATCHED}
SELECT job_id, count(*) FILTER (type = 'post') AS post, count(*) FILTER (type = 'comment') AS comment,
  count(*) AS records FROM matched GROUP BY job_id""",
    "job_stats_payload": f"""
WITH s AS ({_JOB_STATS})
SELECT job_id, target, concat('{{"container_entity_id":"container-1","scraping_arg_id":"', job_id,
  '","platform":"REDDIT","scraping_content":"REDDIT_POSTS","target":"', target, '","target_type":"subreddit","records":',
  records, ',"oldest_post_date":', coalesce('"' || oldest_post_date || '"', 'null'), '}}') AS payload FROM s""",
    "page_source": f"""
WITH {_WALKS}
SELECT id, concat('p', created_epoch % 50) AS post_id, subreddit, event_type AS body, created_epoch,
  subreddit = 'src3' AND created_epoch >= {_A} AND created_epoch < {_B} AS in_window
FROM walks""",
    "stream_upsert": f"""
WITH RECURSIVE {_COMMENTS}, {_FOREST}
SELECT id, post_id, parent_id, subreddit, author, body, score, created_epoch, is_deleted, depth
FROM comments JOIN forest USING (id)""",
}

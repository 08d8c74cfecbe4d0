"""The queries that SQL can express, in DuckDB's."""

from __future__ import annotations

from platework.llm import leaks, lines, near, substrings, suffix_arrays

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce({0}, '')"))

WARC = """
WITH d AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, min(page_id) AS page FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN page < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page < page_id THEN page END AS refers_to
FROM d LEFT JOIN first ON d.digest = first.digest"""

LINES = rf"""
WITH l AS (SELECT doc_id, k AS pos, string_split(text, chr(10))[k] AS raw FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(k)),
t AS (SELECT doc_id, pos, list_transform(regexp_split_to_array(trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[ \t\x0B\f\r]+'),
    lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{lines.VARIABLE}' ELSE x END) AS tokens
  FROM l WHERE trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
cut AS (SELECT *, len(tokens) || ' ' || array_to_string(tokens[1:{lines.DEPTH}], ' ') AS lead,
  'trailing ' || len(tokens) || ' ' || array_to_string(tokens[-{lines.DEPTH}:], ' ') AS trail FROM t),
leads AS (SELECT lead, sum(n) AS lead_docs FROM (SELECT lead, tokens, count(DISTINCT doc_id) AS n FROM cut GROUP BY ALL) GROUP BY lead),
keyed AS (SELECT doc_id, pos, tokens, CASE WHEN lead_docs >= {lines.MIN_DOCS} THEN cut.lead ELSE trail END AS leaf FROM cut JOIN leads ON cut.lead = leads.lead),
counted AS (SELECT leaf, tokens, count(DISTINCT doc_id) AS n_docs FROM keyed GROUP BY ALL),
busy AS (SELECT leaf, sum(n_docs) AS all_docs FROM counted GROUP BY leaf HAVING sum(n_docs) >= {lines.MIN_DOCS}),
known AS (SELECT c.*, all_docs FROM counted c JOIN busy b ON c.leaf = b.leaf),
each AS (SELECT leaf, tokens, all_docs, n_docs, unnest(range(1, len(tokens) + 1)) AS place, unnest(tokens) AS token FROM known),
constant AS (SELECT leaf, place, token FROM each GROUP BY ALL HAVING sum(n_docs) >= {lines.MIN_DOCS} AND sum(n_docs) >= {lines.MIN_SHARE} * any_value(all_docs)),
masked AS (SELECT e.leaf, e.tokens, count(c.token) AS places,
    string_agg(CASE WHEN c.token IS NULL THEN 'x' ELSE '=' || c.token END, ' ' ORDER BY e.place) AS mask
  FROM each e LEFT JOIN constant c ON e.leaf = c.leaf AND e.place = c.place AND e.token = c.token GROUP BY 1, 2),
of AS (SELECT leaf, tokens, CASE WHEN places >= {lines.MIN_CONSTANT} * len(tokens) THEN mask ELSE 'line ' || array_to_string(tokens, ' ') END AS template FROM masked),
named AS (SELECT doc_id, pos, x.leaf, template FROM keyed x JOIN of ON x.leaf = of.leaf AND x.tokens = of.tokens),
recurring AS (SELECT leaf, template, min((doc_id, pos)) AS first FROM named GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}),
gone AS (SELECT doc_id, pos FROM named n JOIN recurring r ON n.leaf = r.leaf AND n.template = r.template WHERE (doc_id, pos) <> first),
kept AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY l.pos) AS text FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
dropped AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines,
  coalesce(n, 0) AS n_dropped, CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN dropped ON d.doc_id = dropped.doc_id"""

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(words[k : k + {near.SHINGLE - 1}], ' ')) AS x
  FROM w, unnest(range(1, greatest(len(words) - {near.SHINGLE - 1}, least(len(words), 1)) + 1)) AS u(k)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * both_n >= {near.PERCENT} * (x.n + y.n - both_n)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, low AS component_id, low = d.doc_id AS kept
FROM documents d LEFT JOIN sizes ON d.doc_id = sizes.doc_id JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = d.doc_id"""

_W = suffix_arrays.WINDOW
BYTES = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
starts AS (SELECT doc_id, k, md5(substr(h, 2 * k + 1, {2 * _W})) AS x FROM d, unnest(range(0, n - {_W - 1})) AS u(k)),
first AS (SELECT x, min((doc_id, k)) AS low FROM starts GROUP BY x),
later AS (SELECT doc_id, k FROM starts JOIN first ON starts.x = first.x WHERE (doc_id, k) > low),
edges AS (SELECT doc_id, k, k - coalesce(lag(k) OVER (PARTITION BY doc_id ORDER BY k), -{_W + 1}) AS gap FROM later),
spans AS (SELECT doc_id, min(k) AS a, max(k) + {_W} AS b FROM (SELECT *, sum(CASE WHEN gap > {_W} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM edges) GROUP BY doc_id, g),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT c.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h,
    count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed FROM cuts c JOIN d ON c.doc_id = d.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

_K = leaks.WINDOW
LEAKS = f"""
WITH i AS (SELECT item_id, {_ITEM_WORDS.format("text")} AS w FROM benchmark),
shapes AS (SELECT DISTINCT item_id, least(len(w), {_K}) AS n, array_to_string(w[k : k + least(len(w), {_K}) - 1], ' ') AS x
  FROM i, unnest(range(1, len(w) - least(len(w), {_K}) + 2)) AS u(k) WHERE len(w) > 0),
d AS (SELECT doc_id, {_ITEM_WORDS.format("text")} AS w FROM documents),
places AS (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS x FROM d, (SELECT DISTINCT n FROM shapes) AS z, unnest(range(1, len(w) - n + 2)) AS u(k)),
found AS (SELECT p.doc_id, k, p.n, item_id FROM places p JOIN shapes s ON p.n = s.n AND p.x = s.x),
hits AS (SELECT doc_id, count(DISTINCT k + o) AS n_hit FROM found, unnest(range(0, n)) AS u(o) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

_N = substrings.WINDOW
WORDS = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
starts AS (SELECT doc_id, k, md5(array_to_string(w[k : k + {_N - 1}], ' ')) AS x FROM d, unnest(range(1, len(w) - {_N - 2})) AS u(k)),
first AS (SELECT x, min(doc_id) AS low FROM starts GROUP BY x),
gone AS (SELECT DISTINCT doc_id, k + o AS k FROM starts JOIN first ON starts.x = first.x, unnest(range(0, {_N})) AS u(o) WHERE low < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM d)
  ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN removed ON d.doc_id = removed.doc_id"""

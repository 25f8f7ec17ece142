"""SQL counterparts of the queries that SQL can express on whole tables.

Written from the rules, not from the Spark code. Token ids, suffix arrays, Markov models and packing have
none; their queries are tested against libraries and brute force.
"""

from __future__ import annotations

from tillwatch.llm.quality_rules import GRID

WORD = r"[^\x20\x09-\x0D]+"

# Nodes of a graph and the smallest node each one reaches.
REACH = """
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a)
"""

EMBEDDINGS = f"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q
    ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
   AND list_cosine_similarity(p.v, q.v) >= 0.98
),
{REACH},
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN degrees ON vec_id = degrees.a LEFT JOIN least ON vec_id = least.a
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest
"""

MINHASH = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n
  FROM s p JOIN s q ON p.shingle = q.shingle AND p.doc_id <> q.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
),
{REACH}
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id,
       w.doc_id = coalesce(component, w.doc_id) AS kept
FROM w LEFT JOIN sizes ON w.doc_id = sizes.doc_id LEFT JOIN least ON w.doc_id = least.a
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, n, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)
),
f AS (
  SELECT *, length('### ' ||
         CASE WHEN regexp_full_match(role, '[a-z]+') THEN upper(role[1]) || role[2:]
              ELSE '=' || url_encode(role) END || ': ' ||
         regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || ' </turn>' || chr(10)) AS n
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

SCORES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "long_words": "word_chars / greatest(n_words, 1)",
    "short_text": "1 / greatest(n_words, 1)",
}
_SCORED = " UNION ALL ".join(
    f"SELECT doc_id, stratum, '{rule}' AS rule, {score} AS score FROM good" for rule, score in SCORES.items()
)
_TESTS = ", ".join(f"('{rule}', {cut}::DOUBLE)" for rule, cuts in GRID.items() for cut in cuts)
_WITHIN = " AND ".join(
    f"""coalesce({score} <= (SELECT cut FROM cutoffs c WHERE c.stratum = m.stratum AND rule = '{rule}'), true)"""
    for rule, score in SCORES.items()
)

QUALITY = f"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 8)
),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(0, 8) r(j) GROUP BY doc_id),
m AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM (
    SELECT w.doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words,
           CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id)
),
good AS (
  SELECT * FROM m WHERE NOT base_failed
    AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1)
),
scored AS ({_SCORED}),
tests(rule, cut) AS (VALUES {_TESTS}),
counts AS (
  SELECT stratum, scored.rule, cut, count(*) AS n, count(*) FILTER (score > cut) AS k
  FROM scored JOIN tests ON scored.rule = tests.rule GROUP BY 1, 2, 3
),
tails AS (
  SELECT stratum, rule, cut, CASE WHEN k >= n * 0.01 THEN 1.0 ELSE (
           SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))
           FROM range(0, k + 1) r(i)) END AS p
  FROM counts
),
cutoffs AS (
  SELECT stratum, rule, min(cut) AS cut FROM tails
  WHERE p <= 0.05 / ((SELECT count(DISTINCT stratum) FROM good) * (SELECT count(*) FROM tests)) GROUP BY 1, 2
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_WITHIN} AS kept
FROM m
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COLLOCATIONS = rf"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM p),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) r(k) WHERE len(ws) >= k)
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, k, f AS a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS first,
         array_to_string(string_split(phrase, ' ')[c + 1:k], ' ') AS rest
  FROM f, range(1, 5) r(c) WHERE c < k
),
cut_scores AS (
  SELECT cuts.*, x.f AS l, y.f AS r, n,
         CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN totals USING (lang) JOIN f x ON x.lang = cuts.lang AND x.phrase = first
  JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
),
best AS (
  SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score
  FROM best WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = best.lang AND f.k > best.k AND 100 * f.f >= 100 * best.a
      AND contains(' ' || f.phrase || ' ', ' ' || best.phrase || ' '))
)
SELECT * FROM ranked WHERE rank <= 2000
"""

# The nearest by brute force. The graphs find all of them on small tables, most on large ones.
NEAREST = """
WITH ok AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM ok q JOIN ok c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM near
)
SELECT * FROM ranked WHERE rank <= 10
"""

FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
),
u AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS UBIGINT)) AS u
  FROM d
),
c AS (
  SELECT doc_id, t, n, least(u[1] % (n + 1), u[2] % (n + 1)) AS a, greatest(u[1] % (n + 1), u[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR u[3] % 100 >= 90
              THEN 'plain' WHEN u[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
),
x AS (SELECT *, t[:a] AS prefix, t[a + 1:b] AS middle, t[b + 1:] AS suffix FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM x
"""

ORACLES: dict[str, str] = {
    "op1_embedding_neardup": EMBEDDINGS,
    "op4_warc": WARC,
    "op5_minhash_neardup": MINHASH,
    "op7_chat_formatting": CHAT,
    "op8_quality_rules": QUALITY,
    "op11_phrase_collocations": COLLOCATIONS,
    "op12_nearest_neighbours": NEAREST,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}

"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from tidegate.llm.decontamination import WINDOW
from tidegate.llm.license_scan import CONTAINMENT, PHRASES, TEMPLATES, template_tokens
from tidegate.llm.line_dedup import PASSAGE_WORDS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(ws) >= 4
         THEN [array_to_string(ws[i : i + 3], ' ') FOR i IN range(1, len(ws) - 2)]
         WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""

OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item, size, unnest(
    [array_to_string(ws[i : i + size - 1], ' ') FOR i IN range(1, len(ws) - size + 2)]) AS g
  FROM (SELECT *, least(len(ws), {WINDOW}) AS size FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT doc_id, size, unnest(range(0, len(ws) - size + 1)) AS pos,
    unnest([array_to_string(ws[i : i + size - 1], ' ') FOR i IN range(1, len(ws) - size + 2)]) AS g
  FROM d, (SELECT DISTINCT size FROM bw) WHERE len(ws) >= size
), h AS (
  SELECT doc_id, pos, size, item FROM dw JOIN bw USING (size, g)
), c AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM h) GROUP BY doc_id
), i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""


def _op8() -> str:
    phrases = ", ".join(f"('{phrase}', {len(phrase.split())}, '{label}')" for phrase, label in PHRASES)
    rows = []
    for number, (label, text) in enumerate(TEMPLATES):
        tokens = template_tokens(text)
        need = -(-CONTAINMENT[0] * len(tokens) // CONTAINMENT[1])
        rows += [f"({number}, '{label}', {len(tokens)}, {need}, '{token}')" for token in tokens]
    return rf"""
WITH d AS (SELECT doc_id, {_LOWER} AS t, {_WORDS} AS ws FROM documents),
p(phrase, size, label) AS (VALUES {phrases}),
t(template, label, n, need, token) AS (VALUES {", ".join(rows)}),
hit AS (
  SELECT doc_id, label, pos FROM (
    SELECT doc_id, label, phrase, unnest(range(0, len(ws) - size + 1)) AS pos,
      unnest([array_to_string(ws[i : i + size - 1], ' ') FOR i IN range(1, len(ws) - size + 2)]) AS g
    FROM d, p WHERE len(ws) >= size
  ) WHERE g = phrase
), base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
    list(DISTINCT label) AS labels FROM hit GROUP BY doc_id
), token AS (
  SELECT DISTINCT doc_id, line, unnest(regexp_extract_all(part, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS token
  FROM (SELECT doc_id, unnest(range(0, len(string_split(t, chr(10))))) AS line,
               unnest(string_split(t, chr(10))) AS part FROM d)
), met AS (
  SELECT doc_id, label, count(*) / n AS share
  FROM token JOIN t USING (token) GROUP BY doc_id, line, template, label, n, need HAVING count(*) >= need
), more AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


_OP10_LINES = r"""
line AS (
  SELECT doc_id, no, part, len(regexp_extract_all(part, '[^\x20\x09-\x0D]+')) AS k,
    trim(part, ' ' || chr(9) || chr(13)) AS body
  FROM (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS no,
               unnest(string_split(text, chr(10))) AS part FROM documents WHERE text IS NOT NULL)
), placed AS (
  SELECT *, sum(k) OVER (PARTITION BY doc_id ORDER BY no) AS stop,
    sum(k) OVER (PARTITION BY doc_id ORDER BY no) - k AS start
  FROM line WHERE k > 0
)"""

OP10 = f"""
WITH {_OP10_LINES}, run AS (
  SELECT * FROM (
    SELECT doc_id, min(no) OVER w AS first, max(no) OVER w AS last,
      max(stop) OVER w - min(start) OVER w AS total, list(body) OVER w AS content
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND {PASSAGE_WORDS - 1} FOLLOWING)
    UNION
    SELECT doc_id, min(no) OVER w, max(no) OVER w, max(stop) OVER w - min(start) OVER w, list(body) OVER w
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN {PASSAGE_WORDS - 1} PRECEDING AND CURRENT ROW)
  ) WHERE total >= {PASSAGE_WORDS}
), origin AS (
  SELECT content, min((doc_id, first, last)) AS o FROM run GROUP BY content
), later AS (
  SELECT DISTINCT doc_id, first, last FROM run JOIN origin USING (content)
  WHERE doc_id <> o[1] OR first > o[3]
), dead AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS no FROM later
), kept AS (
  SELECT doc_id, count(*) FILTER (k > 0) AS n_lines,
    count(*) FILTER (k > 0 AND dead.no IS NOT NULL) AS n_deleted,
    string_agg(part, chr(10) ORDER BY no) FILTER (dead.no IS NULL) AS text
  FROM line LEFT JOIN dead USING (doc_id, no) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN kept USING (doc_id)
"""

OP5 = """
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < latest THEN latest END AS refers_to, true AS complete
FROM (
  SELECT page_id, coalesce(html, '') AS body, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS latest
  FROM pages)
"""

OP9 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
    ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

ORACLES = {
    "op1_ngram_join": OP1,
    "op3_decontamination": OP3,
    "op5_warc": OP5,
    "op8_license_scan": _op8(),
    "op9_embedding_dedup": OP9,
    "op10_line_dedup": OP10,
}

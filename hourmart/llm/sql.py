"""DuckDB SQL of the operators' queries, written from their definitions (no candidate search in it)."""

from __future__ import annotations

from hourmart.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, needed

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array({low}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _words(low: str) -> str:
    return _WORDS.format(low=low)


OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOW}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
n AS (SELECT doc_id, len(s) AS n FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM n
  UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.r = ways.a)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id, n.doc_id = min(r) AS kept
FROM n JOIN reach ON n.doc_id = reach.doc_id GROUP BY n.doc_id, n.n
"""

_NOTICES = ", ".join(
    f"('{label}', {len(set(t.split()))}, {needed(len(set(t.split())), THRESHOLD)}, "
    f"[{', '.join(repr(w) for w in sorted(set(t.split())))}])" for label, t in TEMPLATES)


def _places(phrase: str) -> str:
    parts = phrase.split(" ")
    match = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
    return f"list_filter(range(0, len(w) - {len(parts) - 1}), lambda i: {match})"


OP4 = rf"""
WITH w AS (SELECT doc_id, {_LOW} AS low, {_words(_LOW)} AS w FROM documents),
places AS (SELECT doc_id, low, len(w) AS n_words, {', '.join(f"{_places(p)} AS p{i}" for i, (p, _) in enumerate(PHRASES))} FROM w),
b AS (
  SELECT *, {' || '.join(f"p{i}" for i in range(len(PHRASES)))} AS every,
    list_filter([{', '.join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, (_, label) in enumerate(PHRASES))}],
                lambda x: x IS NOT NULL) AS base FROM places),
line AS (SELECT DISTINCT doc_id, unnest(string_split(low, chr(10))) AS line FROM b),
bag AS (SELECT doc_id, {_words('line')} AS bag FROM line),
t(label, m, need, tokens) AS (VALUES {_NOTICES}),
met AS (
  SELECT doc_id, label, len(list_filter(tokens, lambda x: list_contains(bag, x))) AS c, m, need FROM bag CROSS JOIN t),
best AS (
  SELECT doc_id, list(DISTINCT label) AS found, max(CAST(c AS DOUBLE) / CAST(m AS DOUBLE)) AS best
  FROM met WHERE c >= need GROUP BY doc_id)
SELECT b.doc_id, n_words, len(every) AS n_base, list_min(every) AS first_word, list_max(every) AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(found, CAST([] AS VARCHAR[])))), ',') AS labels,
  CASE WHEN len(every) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM b LEFT JOIN best ON b.doc_id = best.doc_id
"""

OP6 = rf"""
WITH d AS (SELECT doc_id, {_words(_LOW)} AS w FROM documents),
i AS (SELECT item_id, {_words(_LOW)} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda k: w[k:k + 9])
    ELSE [w] END) AS win FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) AS size FROM win),
spots AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d JOIN sizes ON len(w) >= size),
hit AS (
  SELECT doc_id, item_id, k, size FROM (SELECT doc_id, size, k, w[k:k + size - 1] AS run FROM spots) s JOIN win ON run = win),
word AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT doc_id, k, size FROM hit)) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN word ON d.doc_id = word.doc_id LEFT JOIN item ON d.doc_id = item.doc_id
"""

OP7 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, max(page_id) AS owner FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN owner IS NULL OR owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM p LEFT JOIN o ON p.payload_digest = o.payload_digest
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT vec_id, vec_id AS r FROM v
  UNION SELECT reach.vec_id, ways.b FROM reach JOIN ways ON reach.r = ways.a),
n AS (SELECT a, count(*) AS n FROM ways GROUP BY a),
c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT c.vec_id, coalesce(n, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.vec_id
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_words(_LOW)} AS w FROM documents),
i AS (SELECT item_id, {_words(_LOW)} AS w FROM benchmark),
total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM i) GROUP BY item_id, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, n_docs),
m AS (SELECT row, doc_id, 100 - 25 + ((25 * CAST(len(w) AS BIGINT) * n_docs) // l) AS m FROM d, total WHERE len(w) > 0),
score AS (
  SELECT item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (row) GROUP BY item_id, row, doc_id),
best AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank,
    doc_id, score FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 20
"""

SQL: dict[str, str] = {"op1_minhash": OP1, "op4_licenses": OP4, "op6_decontaminate": OP6, "op7_warc": OP7,
                       "op10_embeddings": OP10, "op13_search": OP13}

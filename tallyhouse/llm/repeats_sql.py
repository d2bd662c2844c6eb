"""DuckDB SQL of the repeated-windows query: windows as joined words, grouped as they stand."""

from __future__ import annotations


def repeats_sql(width: int = 13) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
),
word AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
win AS (
  SELECT doc_id, p, array_to_string(w[p:p + {width - 1}], ' ') AS k FROM word WHERE p + {width - 1} <= len(w)
),
firsts AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
hit AS (SELECT doc_id, p FROM win JOIN firsts USING (k) WHERE first_id < doc_id),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM hit, range({width}) AS offsets(o)),
kept AS (
  SELECT word.doc_id, string_agg(w[word.p], ' ' ORDER BY word.p) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY word.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

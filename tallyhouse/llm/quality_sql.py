"""DuckDB SQL of the quality query, written from its definition: counts, rates, sketches, fences, verdict."""

from __future__ import annotations

from tallyhouse.llm import quality_rules as Q

_WORD = r"[^\x09-\x0D\x20]+"


def quality_sql() -> str:
    rates = {r: sql.replace(" DIV ", " // ") for r, (sql, _, _) in Q.RATES.items()}
    rate_columns = ",\n       ".join(f"CASE WHEN n_words > 0 THEN {sql} ELSE 0 END AS {r}" for r, sql in rates.items())
    long = "\n  UNION ALL ".join(f"SELECT lang, source, '{r}' AS rate, {r} AS v FROM rated WHERE NOT base_failed" for r in rates)
    fences, inside = [], ["NOT base_failed"]
    for r, (_, least, sides) in Q.RATES.items():
        spread = f"{Q.FENCE} * greatest(q3 - q1, {least})"
        fences.append(f"max(q3 + {spread}) FILTER (WHERE rate = '{r}') AS {r}_high")
        inside.append(f"coalesce({r} <= {r}_high, true)")
        if sides == "both":
            fences.append(f"max(q1 - {spread}) FILTER (WHERE rate = '{r}') AS {r}_low")
            inside.append(f"coalesce({r} >= {r}_low, true)")

    def quartiles(name: str, source: str, group: str) -> str:
        keys = f"{group}, rate" if group else "rate"
        return f"""{name} AS (
  SELECT {keys}, max(total) AS n,
         min(bucket) FILTER (WHERE 4 * seen >= total) AS q1, min(bucket) FILTER (WHERE 4 * seen >= 3 * total) AS q3
  FROM (SELECT {keys}, bucket, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS seen,
               sum(n) OVER (PARTITION BY {keys}) AS total
        FROM (SELECT {keys}, bucket, sum(n) AS n FROM {source} GROUP BY {keys}, bucket))
  GROUP BY {keys})"""

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i + unnest([0, 1, 2]) AS p FROM rep) GROUP BY r),
base AS (
  SELECT w.r, doc_id, lang, source, len(ws) AS n_words,
         length(regexp_replace(t, '[\\x09-\\x0D\\x20]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
         coalesce(cov.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
  FROM w LEFT JOIN cov ON w.r = cov.r),
rated AS (
  SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
       {rate_columns}
  FROM base),
long AS ({long}),
sketch AS (
  SELECT lang, source, rate, (v >> cut) << cut AS bucket, count(*) AS n
  FROM (SELECT *, greatest(length(bin(v)) - {Q.SKETCH_BITS}, 0) AS cut FROM long) GROUP BY ALL),
{quartiles("own", "sketch", "lang, source")},
{quartiles("by_lang", "sketch", "lang")},
{quartiles("overall", "sketch", "")},
picked AS (
  SELECT own.lang, own.source, own.rate,
         CASE WHEN own.n >= {Q.LEAST_ROWS} THEN own.q1 WHEN l.n >= {Q.LEAST_ROWS} THEN l.q1 ELSE a.q1 END AS q1,
         CASE WHEN own.n >= {Q.LEAST_ROWS} THEN own.q3 WHEN l.n >= {Q.LEAST_ROWS} THEN l.q3 ELSE a.q3 END AS q3
  FROM own JOIN by_lang l ON own.lang IS NOT DISTINCT FROM l.lang AND own.rate = l.rate
           JOIN overall a ON own.rate = a.rate),
limits AS (SELECT lang, source, {", ".join(fences)} FROM picked GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       {" AND ".join(inside)} AS kept
FROM rated LEFT JOIN limits
  ON rated.lang IS NOT DISTINCT FROM limits.lang AND rated.source IS NOT DISTINCT FROM limits.source
"""

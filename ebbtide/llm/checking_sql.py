"""SQL of the rules and of the join, which enumerates what the operators hash. Meant for small tables."""

from __future__ import annotations

from .jaccard_join import PERCENT, SHINGLE
from .period_runs import SHORTEST, TIMES
from .quality_rules import LIMITS

_WORDS = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _covered(size: int) -> str:
    """Places of words inside windows of that many words that a text has twice or more."""
    return f"""grams_{size} AS (SELECT rid, i, list_slice(ws, i, i + {size - 1}) AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM base)),
again_{size} AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams_{size}) WHERE n > 1),
covered_{size} AS (SELECT DISTINCT rid, i + k AS i FROM (SELECT rid, i, unnest(range({size})) AS k FROM again_{size})),
sums_{size} AS (SELECT rid, count(*) AS n, sum(length(ws[i])) AS chars FROM covered_{size} JOIN base USING (rid) GROUP BY rid)"""


def rules() -> str:
    sizes = (LIMITS.base_window, *LIMITS.coverage)
    shares = {f"share_{k}_grams": f"coalesce(s{k}.chars, 0) / greatest(word_chars, 1)" for k in LIMITS.coverage}
    shares["share_line_chars"] = "coalesce(dup_chars, 0) / greatest(word_chars, 1)"
    most = {**{f"share_{k}_grams": v for k, v in LIMITS.coverage.items()}, "share_line_chars": LIMITS.line_characters}
    return rf"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws FROM documents),
lines AS (SELECT rid, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    row_number() OVER (PARTITION BY rid, line) AS nth
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM base)),
dup_lines AS (SELECT rid, count(*) AS n, sum(chars) AS dup_chars FROM lines WHERE chars > 0 AND nth > 1 GROUP BY rid),
{", ".join(_covered(k) for k in sizes)},
counted AS (SELECT rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM base),
measured AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(dup_lines.n, 0) AS n_dup_lines,
    coalesce(s{LIMITS.base_window}.n, 0) AS n_repeat_words, {", ".join(f"{v} AS {k}" for k, v in shares.items())}
  FROM counted LEFT JOIN dup_lines USING (rid) {" ".join(f"LEFT JOIN sums_{k} s{k} USING (rid)" for k in sizes)}),
judged AS (SELECT *, n_words < {LIMITS.min_words} OR 100 * n_repeat_words > {LIMITS.max_base_percent} * n_words AS base_failed
  FROM measured)
SELECT *, NOT base_failed AND {" AND ".join(f"{k} <= {v}" for k, v in most.items())} AS kept FROM judged
"""


def join() -> str:
    return rf"""
WITH RECURSIVE base AS (SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORDS}') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + {SHINGLE - 1}) AS shingle FROM (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {SHINGLE - 1}, least(len(ws), 1)) + 1)) AS i FROM base)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.shingle = y.shingle
  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
linked AS (SELECT a, b FROM common c JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * c.n >= {PERCENT} * (s.n + t.n - c.n)),
reach AS (SELECT doc_id AS id, doc_id AS root FROM base UNION SELECT b, root FROM reach JOIN linked ON a = id),
component AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT base.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM base JOIN component ON id = base.doc_id LEFT JOIN sizes ON sizes.doc_id = base.doc_id
"""


def crc32(number: str) -> str:
    """The unsigned CRC-32 of a whole number's decimal digits; null for null."""
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {bit}, xor(crc, d))"
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))"
    return f"xor(list_reduce({digits}, lambda crc, d: {byte}, CAST(4294967295 AS BIGINT)), 4294967295)"


def periodic_runs() -> str:
    """Every pair of equal words of a text; maximal stretches of pairs with one distance are runs. The texts are planted as
    ``period_runs.planted`` does it."""
    run = "length / period DESC, start, period"
    return rf"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws,
    {crc32("doc_id")} AS h FROM documents),
sized AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a, 3 + (h // 10) % 8 AS times FROM base),
words AS (SELECT rid, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN ws[a + (i - a) % (1 + (n - a) // times) + 1] ELSE ws[i + 1] END AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM sized)),
pairs AS (SELECT x.rid, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.rid = y.rid AND x.w = y.w AND y.i > x.i
  WHERE {TIMES} * (y.i - x.i) <= x.n),
stretches AS (SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs)
  GROUP BY rid, q, island HAVING count(*) + q >= greatest({SHORTEST}, {TIMES} * q)),
runs AS (SELECT rid, start, length, min(q) AS period FROM stretches GROUP BY rid, start, length),
told AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said
  FROM runs GROUP BY rid),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY {run}) = 1),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM base LEFT JOIN told USING (rid) LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
"""

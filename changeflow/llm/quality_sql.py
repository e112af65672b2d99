"""The quality rules as DuckDB SQL."""

from __future__ import annotations

from changeflow.llm.quality_rules import CHARS_FAR, CHARS_NOISE, CLASSES, COMMON, MIN_WORDS, \
    REPEATED, STEPS, WORDS_FAR, WORDS_FROM

_GAP = r"[\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, {_quoted(pattern)}, '', 'g'))"


_CLASS_ROWS = " UNION ALL ".join(
    f"SELECT doc_id, {at} AS bin, {_class(p)} AS n FROM d" for at, p in enumerate(CLASSES))
_COMMON_ROWS = ", ".join(f"({at}, {_quoted(f)})" for at, w in enumerate(COMMON)
                         for f in (w, w.capitalize()))


def _distance(counts: str, reference: str) -> str:
    """The Jensen-Shannon distance of each text's histogram from its language's."""
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / (p + q)) ELSE 0 END"
    return f"""
      SELECT doc_id, sqrt(greatest(sum({part.format('p')} + {part.format('q')}) / 2, 0)) AS far
      FROM (SELECT c.doc_id, c.bin,
              c.n / sum(c.n) OVER (PARTITION BY c.doc_id) AS p,
              r.n / sum(r.n) OVER (PARTITION BY c.doc_id) AS q
            FROM {counts} c JOIN base b USING (doc_id)
            JOIN {reference} r ON r.bin = c.bin AND r.lang IS NOT DISTINCT FROM b.lang
            WHERE NOT base_failed)
      GROUP BY doc_id"""


ORACLE = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
repeats AS (
  SELECT doc_id, count(DISTINCT bin) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS bin FROM windows WHERE times > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, lang, len(w) AS n_words, length(t) AS chars,
    length(regexp_replace(t, '{_GAP}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(w) < {MIN_WORDS} OR 100 * coalesce(r.n, 0) > {REPEATED} * len(w) AS base_failed
  FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
known AS ({_CLASS_ROWS}),
classes AS (
  SELECT * FROM known UNION ALL
  SELECT doc_id, {len(CLASSES)}, any_value(chars) - sum(n) FROM known JOIN base USING (doc_id)
  GROUP BY doc_id),
common(bin, form) AS (VALUES {_COMMON_ROWS}),
found AS (
  SELECT doc_id, bin, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS form FROM d) JOIN common USING (form) GROUP BY doc_id, bin),
bins AS (
  SELECT doc_id, bin, coalesce(n, 0) AS n
  FROM d CROSS JOIN (SELECT unnest(range({len(COMMON)})) AS bin) LEFT JOIN found USING (doc_id, bin)),
words AS (
  SELECT * FROM bins UNION ALL
  SELECT doc_id, {len(COMMON)}, any_value(n_words) - sum(n) FROM bins JOIN base USING (doc_id)
  GROUP BY doc_id),
class_reference AS (
  SELECT lang, bin, quantile_disc(n * {STEPS} // chars, 0.5) AS n
  FROM classes JOIN base USING (doc_id) WHERE NOT base_failed GROUP BY lang, bin),
word_reference AS (
  SELECT lang, bin, sum(n) AS n
  FROM words JOIN base USING (doc_id) WHERE NOT base_failed GROUP BY lang, bin),
chars_far AS ({_distance("classes", "class_reference")}),
words_far AS ({_distance("words", "word_reference")})
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(c.far > {CHARS_FAR} + {CHARS_NOISE} / sqrt(n_words), false)
    AND NOT (n_words >= {WORDS_FROM} AND coalesce(w.far > {WORDS_FAR}, false)) AS kept
FROM base b LEFT JOIN chars_far c USING (doc_id) LEFT JOIN words_far w USING (doc_id)
"""

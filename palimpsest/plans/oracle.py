"""Building blocks of the DuckDB oracle SQL (correctness checks only).

The oracle recomputes every registered query independently in DuckDB over the
same parquet tables. Two engine differences are bridged here:

* DuckDB's ``levenshtein`` counts UTF-8 bytes, Spark's counts code points.
  Each non-ASCII character that occurs in the test corpus is mapped to a
  distinct control character that never occurs in it, which makes the
  DuckDB byte distance equal to the code-point distance.
* Spark writes ``char(10)``, DuckDB ``chr(10)``.
"""

from __future__ import annotations

from palimpsest.sources.snapshots import LATEST_SQL, PREV_SQL

# --- fixed values: non-ASCII characters of the test corpus ------------------
CORPUS_NON_ASCII = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
# Control characters absent from the corpus (tab, newline, CR are skipped).
_SPARE = [c for c in range(1, 32) if c not in (9, 10, 13)][: len(CORPUS_NON_ASCII)]
# --- end of fixed values ----------------------------------------------------
_DST = "||".join(f"chr({c})" for c in _SPARE)


def cp(expr: str) -> str:
    """Map corpus non-ASCII characters to single bytes (code-point safe)."""
    return f"translate({expr}, '{CORPUS_NON_ASCII}', {_DST})"


def lev(a: str, b: str) -> str:
    """Code-point Levenshtein distance in DuckDB."""
    return f"levenshtein({cp(a)}, {cp(b)})"


def _duck(sql: str) -> str:
    return sql.replace("char(10)", "chr(10)").replace("AS string", "AS VARCHAR").strip()


SNAPSHOT_CTES = f"""
prev AS (SELECT doc_id, chapter, manual, split_part(text, chr(10), 1) AS title, text
         FROM ({_duck(PREV_SQL)}) s0),
latest AS (SELECT doc_id, chapter, manual, split_part(text, chr(10), 1) AS title, text
           FROM ({_duck(LATEST_SQL)}) s1)"""

PARAGRAPH_CTES = SNAPSHOT_CTES + """,
pp AS (SELECT s.doc_id, s.chapter, s.manual, CAST(u.pos - 1 AS INTEGER) AS pos,
              regexp_replace(u.t, '\\s$', '') AS text
       FROM prev s, unnest(string_split(s.text, chr(10))) WITH ORDINALITY AS u(t, pos)),
lp AS (SELECT s.doc_id, s.chapter, s.manual, CAST(u.pos - 1 AS INTEGER) AS pos,
              regexp_replace(u.t, '\\s$', '') AS text
       FROM latest s, unnest(string_split(s.text, chr(10))) WITH ORDINALITY AS u(t, pos)),
pairs AS (SELECT coalesce(pp.doc_id, lp.doc_id) AS doc_id, coalesce(pp.pos, lp.pos) AS pos,
                 pp.text AS prev_text, lp.text AS curr_text,
                 CASE WHEN pp.text IS NULL THEN 'inserted' WHEN lp.text IS NULL THEN 'deleted'
                      WHEN pp.text = lp.text THEN 'same' ELSE 'changed' END AS status
          FROM pp FULL OUTER JOIN lp ON pp.doc_id = lp.doc_id AND pp.pos = lp.pos)"""

# Paragraph logs (F4 + W3): kept paragraphs numbered k = 0, 1, ... per document.
_KEPT = """(SELECT s.doc_id, s.chapter, s.manual, s.title, CAST(u.pos - 1 AS INTEGER) AS pos, u.t AS para
           FROM {side} s, unnest(string_split(s.text, chr(10))) WITH ORDINALITY AS u(t, pos)
           WHERE length(u.t) > 1 AND NOT contains(u.t, ']>') AND NOT contains(u.t, 'Previous page')
             AND NOT contains(u.t, 'Next page'))"""
LOG_CTES = SNAPSHOT_CTES + f""",
plog AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS k,
                chapter || '_' || CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS VARCHAR) AS key
         FROM {_KEPT.format(side='prev')} a),
llog AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS k,
                chapter || '_' || CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS VARCHAR) AS key
         FROM {_KEPT.format(side='latest')} b)"""


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"

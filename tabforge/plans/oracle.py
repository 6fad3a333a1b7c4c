"""DuckDB SQL twins of the bindings and scalar functions, for oracle checks.

Each helper renders the SQL text of one rule; the query catalog composes them.
"""

from __future__ import annotations

from tabforge.config import NA_TOKENS

_DECIMAL = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
_TS_FORMATS = ["%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%Y/%m/%d",
               "%Y%m%d", "%m/%d/%Y %H:%M", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%m.%d.%Y", "%d.%m.%Y", "%m/%d/%y",
               "%d %b %Y", "%d-%b-%Y", "%b %d %Y", "%B %d %Y", "%b-%Y", "%Y"]
# Layouts of the dirty view's dates besides the two main ones: (Spark pattern, DuckDB pattern).
DATE_LAYOUTS = [("yyyy-MM-dd '10:11'", "%Y-%m-%d 10:11"), ("yyyy-MM-dd'T10:11:12'", "%Y-%m-%dT10:11:12"), ("yyyy-MM-dd '10:11:12.5'", "%Y-%m-%d 10:11:12.5"),
                ("yyyy/MM/dd", "%Y/%m/%d"), ("yyyy-M-d", "%Y-%-m-%-d"), ("MM-dd-yyyy", "%m-%d-%Y"), ("d MMM yyyy", "%-d %b %Y"), ("d-MMM-yyyy", "%-d-%b-%Y"),
                ("MMMM d yyyy", "%B %-d %Y"), ("MMM-yyyy", "%b-%Y"), ("M/d/yyyy '10:00'", "%-m/%-d/%Y 10:00"), ("MM/dd/yy", "%m/%d/%y"), ("' 'yyyy-MM-dd' '", " %Y-%m-%d ")]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def na(x: str) -> str:
    return f"CASE WHEN {x} IN ({', '.join(q(t) for t in NA_TOKENS)}) THEN NULL ELSE {x} END"


def dbl(x: str) -> str:
    d = f"TRY_CAST(NULLIF(regexp_extract({x}, {q(_DECIMAL)}, 1), '') AS DOUBLE)"
    return f"(CASE WHEN isinf({d}) THEN NULL ELSE {d} END)"


def lng(x: str) -> str:
    d = dbl(x)
    return f"(CASE WHEN regexp_full_match({x}, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim({x}, ' \t\n') AS BIGINT) WHEN {d} = floor({d}) AND abs({d}) < 9.223372036854775e18 THEN CAST({d} AS BIGINT) END)"


def ts(x: str) -> str:
    # DuckDB's %Y also takes two digits, so formats with it are for texts with a four-digit run only.
    full = ", ".join(f"try_strptime(trim({x}), {q(f)})" for f in _TS_FORMATS if "%Y" in f)
    short = ", ".join(f"try_strptime(trim({x}), {q(f)})" for f in _TS_FORMATS if "%y" in f)
    return f"(CASE WHEN regexp_matches({x}, '[0-9]{{4}}') THEN coalesce({full}) ELSE coalesce({short}) END)"


def boolean(x: str) -> str:
    return f"(CASE WHEN {x} IS NOT NULL THEN lower({x}) IN ('true', 'yes', '1') END)"


def valid(x: str) -> str:
    return f"({x} IS NULL OR ({x} <> '?' AND regexp_matches({x}, '[^\\x09-\\x0d\\x1c-\\x20]')))"


def fold(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g')"


def strip(x: str) -> str:
    return f"translate({x}, ';,@', '')"


def when_chain(pairs: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


DIRTY_COLUMNS = ["id_raw", "status_raw", "treat_raw", "amount_raw", "date_raw", "flag_raw", "opt_raw", "note_raw"]
TEXT_AFTER_ID = ["status_raw", "treat_raw", "amount_raw", "date_raw", "flag_raw", "opt_raw", "note_raw"]


def dirty_cte() -> str:
    """``dirty_raw`` and ``dirty`` (NA tokens → null) as CTE text."""
    k = "o_orderkey"
    key = f"CAST({k} AS VARCHAR)"
    cents = "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)"
    cols = {
        "id_raw": when_chain([(f"{k} % 67 = 0", f"CAST(9007199254740993 + {k} AS VARCHAR)"), (f"{k} % 50 = 0", f"'x' || {key}"), (f"{k} % 31 = 0", f"{key} || '.0'"),
                              (f"{k} % 37 = 0", f"{key} || '.5'"), (f"{k} % 41 = 0", f"' ' || {key} || ' '")], key),
        "status_raw": when_chain([(f"{k} % 11 = 0", "'?'"), (f"{k} % 13 = 0", "' '"), (f"{k} % 17 = 0", "NULL"),
                                  (f"{k} % 61 = 0", "chr(9)")], "o_orderstatus"),
        "treat_raw": when_chain([(f"{k} % 7 = 0", "'0'"), (f"{k} % 43 = 0", "' 0'")], "o_orderpriority"),
        "amount_raw": when_chain([(f"{k} % 19 = 0", "'abc'"), (f"{k} % 29 = 0", "'NA'"),
                                  (f"{k} % 10 = 5", f"substr({cents}, 1, 1) || ',' || substr({cents}, 2)"),
                                  (f"{k} % 10 = 0", f"substr({cents}, 1, 1) || ';' || substr({cents}, 2)")], cents),
        "date_raw": when_chain([(f"{k} % 23 = 0", "'n.d.'"), (f"{k} % 47 = 0", "''"),
                                *[(f"{k} % 6 = 1 AND ({k} // 6) % 13 = {i}", f"strftime(o_orderdate, {q(f)})") for i, (_, f) in enumerate(DATE_LAYOUTS)],
                                (f"{k} % 3 = 0", "strftime(o_orderdate, '%m/%d/%Y')")],
                               "strftime(o_orderdate, '%Y-%m-%d')"),
        "flag_raw": when_chain([(f"{k} % 3 = 0", "'R'"), (f"{k} % 3 = 1", "'NR'")], "'r'"),
        "opt_raw": when_chain([(f"{k} % 5 = 0", "'Yes'"), (f"{k} % 5 = 1", "'true'"), (f"{k} % 5 = 2", "'1'"),
                               (f"{k} % 5 = 3", "'no'")], "'N/A'"),
        "note_raw": when_chain([(f"{k} % 53 = 0", "'ñ'"), (f"{k} % 9 = 0", "'café ' || o_orderpriority"),
                                (f"{k} % 59 = 0", "'NULL'")], "o_orderstatus || '@' || o_orderpriority"),
    }
    raw = ",\n  ".join(f"{v} AS {n}" for n, v in cols.items())
    named = ",\n  ".join(f"{na(c)} AS {c}" for c in DIRTY_COLUMNS)
    return (f"dirty_raw AS (SELECT\n  {raw}\nFROM orders),\n"
            f"dirty AS (SELECT\n  {named}\nFROM dirty_raw)")


def clean_cte() -> str:
    """The cleaning chain over ``dirty`` as CTEs, ending in ``cleaned``."""
    text = ",\n  ".join(f"{strip(fold(c))} AS {c}" for c in TEXT_AFTER_ID)
    valid_all = " AND ".join(valid(c) for c in TEXT_AFTER_ID)
    return f"""{dirty_cte()},
c1 AS (SELECT * FROM dirty WHERE id_raw IS NOT NULL AND status_raw IS NOT NULL
       AND treat_raw IS NOT NULL AND flag_raw IS NOT NULL),
c2 AS (SELECT * REPLACE ({lng('id_raw')} AS id_raw) FROM c1),
c3 AS (SELECT * FROM c2 WHERE id_raw IS NOT NULL),
c4 AS (SELECT * FROM c3 WHERE treat_raw IS DISTINCT FROM '0'),
c5 AS (SELECT id_raw,
  {text}
FROM c4),
c6 AS (SELECT * FROM c5 WHERE {valid_all}),
cleaned AS (SELECT
  id_raw,
  CASE WHEN status_raw IN ('F', 'O') THEN status_raw END AS status_raw,
  treat_raw,
  {dbl('amount_raw')} AS amount_raw,
  {ts('date_raw')} AS date_raw,
  flag_raw,
  {boolean('opt_raw')} AS opt_raw,
  note_raw,
  CASE WHEN flag_raw = 'R' THEN 'yes' ELSE 'no' END AS response
FROM c6)"""


def iqr_step(src: str, dst: str, col: str, factor: float = 1.5) -> str:
    """One trimming step from CTE ``src`` into CTE ``dst`` (exact quartiles)."""
    return (f"{dst} AS (SELECT s.* FROM {src} s, (SELECT quantile_disc({col}, 0.25) AS q1, "
            f"quantile_disc({col}, 0.75) AS q3 FROM {src}) b WHERE s.{col} BETWEEN "
            f"b.q1 - CAST({factor} AS DOUBLE) * (b.q3 - b.q1) AND b.q3 + CAST({factor} AS DOUBLE) * (b.q3 - b.q1))")


def doc_frame_cte() -> str:
    return """docf AS (SELECT d.doc_id,
  CAST(d.n_chars AS DOUBLE) AS n_chars,
  CAST(length(d.text) - length(replace(d.text, ' ', '')) + 1 AS DOUBLE) AS n_words,
  CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS DOUBLE) AS n_lines,
  d.source, d.lang,
  CASE WHEN l.quality = 1 THEN 'yes' ELSE 'no' END AS response
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

"""SQL of the queries p1 to p6 for a check by another engine.

p4 has none: names of units in free text are beyond it (tested against brute force instead). Fills of
p3 and the classifier of p6 have none either; p3_found and p6_found do.
"""

from __future__ import annotations

from tallymark.operators.rowparse import TYPED

SQL: dict[str, str] = {}

SQL["p1_found"] = """
WITH m AS (
  SELECT id, CAST(primaryValue AS DOUBLE) AS pv, CASE WHEN isnan(netWgt) THEN NULL ELSE netWgt END AS nw,
         TRY_CAST(NULLIF(TRIM(REPLACE(qty, ',', '')), '') AS DOUBLE) AS q, matched_id AS mid
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY synced_at DESC, primaryValue DESC NULLS LAST, CASE WHEN isnan(netWgt) THEN NULL ELSE netWgt END DESC NULLS LAST,
          TRY_CAST(NULLIF(TRIM(REPLACE(qty, ',', '')), '') AS DOUBLE) DESC NULLS LAST, matched_id DESC NULLS LAST) AS rn FROM decl_mirror) x
  WHERE rn = 1
), d AS (
  SELECT id, CASE WHEN isnan(primaryValue) THEN NULL ELSE primaryValue END AS pv, CASE WHEN isnan(netWgt) THEN NULL ELSE netWgt END AS nw,
         CASE WHEN isnan(qty) THEN NULL ELSE qty END AS q, matched_id AS mid
  FROM declarations
), j AS (
  SELECT d.id, d.pv AS a1, m.pv AS b1, d.nw AS a2, m.nw AS b2, d.q AS a3, m.q AS b3, d.mid AS a4, m.mid AS b4 FROM d JOIN m ON d.id = m.id
)
SELECT id, 'only_declarations' AS difference FROM d WHERE id NOT IN (SELECT id FROM m)
UNION ALL SELECT id, 'only_mirror' FROM m WHERE id NOT IN (SELECT id FROM d)
UNION ALL SELECT id, 'primaryValue' FROM j WHERE (a1 IS NULL) <> (b1 IS NULL) OR ABS(a1 - b1) > 0.005 + 1e-9
UNION ALL SELECT id, 'netWgt' FROM j WHERE (a2 IS NULL) <> (b2 IS NULL) OR ABS(a2 - b2) > 0.005 + 1e-9
UNION ALL SELECT id, 'qty' FROM j WHERE (a3 IS NULL) <> (b3 IS NULL) OR ABS(a3 - b3) > 0.00005 + 1e-9
UNION ALL SELECT id, 'matched_id' FROM j WHERE a4 IS DISTINCT FROM b4
"""

SQL["p2_found"] = """
SELECT 'reporterCode' AS field, CAST(reporterCode AS BIGINT) AS key_value FROM declarations WHERE reporterCode IS NOT NULL
GROUP BY reporterCode HAVING COUNT(*) >= 0.04 * (SELECT COUNT(*) FROM declarations)
UNION ALL
SELECT 'matched_id', matched_id FROM declarations WHERE matched_id IS NOT NULL
GROUP BY matched_id HAVING COUNT(*) >= 0.01 * (SELECT COUNT(*) FROM declarations)
"""

SQL["p2_totals"] = """
SELECT field, key_value, COUNT(*) AS n, CAST(SUM(m) AS DOUBLE) AS total, COUNT(*) FILTER (WHERE x IS NOT NULL AND m IS NULL) AS unsummed FROM (
  SELECT 'reporterCode' AS field, CAST(reporterCode AS BIGINT) AS key_value, primaryValue AS x, TRY_CAST(CASE WHEN abs(primaryValue) < 1e24 THEN primaryValue END AS DECIMAL(30, 6)) AS m FROM declarations
  UNION ALL
  SELECT 'matched_id', matched_id, primaryValue, TRY_CAST(CASE WHEN abs(primaryValue) < 1e24 THEN primaryValue END AS DECIMAL(30, 6)) FROM declarations
) z GROUP BY field, key_value
"""

SQL["p4_coded"] = """
SELECT id, trim(u.code) AS code, dimension, CASE WHEN isnan(qty) THEN NULL ELSE qty END * factor_to_base AS qty_base
FROM declarations d JOIN qty_unit_conversion u ON regexp_replace(d.qtyUnitCode, '^\\s+|\\s+$', '', 'g') = trim(u.code) WHERE dimension IS NOT NULL AND factor_to_base IS NOT NULL
"""

SQL["p3_found"] = """
SELECT id, 'netWgt' AS field FROM declarations WHERE netWgt IS NULL OR isnan(netWgt) OR NOT (netWgt > 0) OR isinf(netWgt)
UNION ALL
SELECT id, 'isNetWgtEstimated' FROM declarations
WHERE isNetWgtEstimated IS NULL OR LOWER(TRIM(isNetWgtEstimated)) NOT IN ('1', 'true', 'yes', 't', 'y', '0', 'false', 'no', 'f', 'n')
"""


_NO_WEIGHT = "(netWgt IS NULL OR isnan(netWgt) OR NOT (netWgt > 0) OR isinf(netWgt))"
_NO_FLAG = "(isNetWgtEstimated IS NULL OR LOWER(TRIM(isNetWgtEstimated)) NOT IN ('1', 'true', 'yes', 't', 'y', '0', 'false', 'no', 'f', 'n'))"
SQL["p3_marks"] = f"""
SELECT id, CASE WHEN NOT {_NO_WEIGHT} THEN netWgt END AS netWgt, CASE WHEN NOT {_NO_FLAG} THEN isNetWgtEstimated END AS isNetWgtEstimated,
  {_NO_WEIGHT} AS "netWgt_filled", {_NO_FLAG} AS "isNetWgtEstimated_filled", TRUE AS whole FROM declarations
"""


def _p5(sep: str, name: str) -> str:
    """Records of the files with one separator: r(raw_id, quoted_ok, f, h)."""
    field = f'("(?:[^"]|"")*"|[^"{sep}]*)'
    return f"""{name} AS (
  SELECT raw_id, file_name, line_no, regexp_full_match(line, '(?s){field}(?:{sep}{field})*') AS ok,
         regexp_extract_all(line || '{sep}', '(?s){field}{sep}', 1) AS f, regexp_extract_all(header || '{sep}', '(?s){field}{sep}', 1) AS h
  FROM lines WHERE (strpos(header, chr(9)) > 0) = {"TRUE" if sep == chr(9) else "FALSE"}
)"""


_P5 = f"""
WITH heads AS (SELECT file_name, arg_min(line, raw_id) AS header FROM raw_lines WHERE line_no = 1 GROUP BY file_name),
lines AS (SELECT r.raw_id, r.file_name, r.line_no, COALESCE(r.line, '') AS line, heads.header FROM raw_lines r JOIN heads USING (file_name) WHERE r.line_no <> 1),
{_p5(chr(9), "tabs")}, {_p5(",", "commas")},
r AS (SELECT * FROM tabs UNION ALL SELECT * FROM commas),
n AS (
  SELECT raw_id, file_name, line_no, ok, len(f) AS n, len(h) AS columns, [lower(trim(x, ' "')) FOR x IN h] AS names,
         [CASE WHEN starts_with(x, '"') THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END FOR x IN f] AS f
  FROM r
),
v AS (
  SELECT raw_id, CASE WHEN list_contains(names, 'cmdcode') THEN trim(f[list_position(names, 'cmdcode')]) END AS cmd,
         CASE WHEN list_contains(names, 'refyear') THEN trim(f[list_position(names, 'refyear')]) END AS yr,
         CASE WHEN list_contains(names, 'flowcode') THEN trim(f[list_position(names, 'flowcode')]) END AS flow
  FROM n WHERE ok AND n = columns
), found AS (
SELECT raw_id, 'quoting' AS reason FROM n WHERE NOT ok
UNION ALL SELECT raw_id, 'column_count' FROM n WHERE ok AND n <> columns
UNION ALL SELECT raw_id, 'invalid_cmdCode' FROM v WHERE cmd IS NOT NULL AND NOT (cmd = 'TOTAL' OR (regexp_full_match(cmd, '[0-9]{{1,6}}') AND regexp_matches(cmd, '[1-9]')))
UNION ALL SELECT raw_id, 'invalid_refYear' FROM v WHERE yr IS NOT NULL AND NOT (CASE WHEN regexp_full_match(yr, '[0-9]{{4}}') THEN CAST(yr AS INTEGER) BETWEEN 1962 AND 2030 ELSE FALSE END)
UNION ALL SELECT raw_id, 'invalid_flowCode' FROM v WHERE flow IS NOT NULL AND NOT regexp_full_match(flow, '[XM]|[RD][XM]|[xm]|[rRdD][xXmM]')
)
"""
SQL["p5_found"] = _P5 + "SELECT * FROM found"


def _typed(key: str, name: str, kind: str) -> str:
    text = f"NULLIF(trim(CASE WHEN list_contains(names, '{key}') THEN f[list_position(names, '{key}')] END, ' '), '')"
    return f"upper({text}) AS flowCode" if name == "flowCode" else f"{text} AS {name}" if kind == "string" else f"TRY_CAST({text} AS {kind}) AS {name}"


_OTHER = ", ".join(f"'{k}'" for k in TYPED)
SQL["p5_rows"] = (
    _P5
    + f"""SELECT raw_id, file_name, line_no, {', '.join(_typed(k, *v) for k, v in TYPED.items())},
  array_to_string(list_sort([x FOR x IN [CASE WHEN names[i] NOT IN ({_OTHER}) THEN names[i] || '=' || f[i] END FOR i IN range(1, columns + 1)] IF x IS NOT NULL]), chr(10)) AS other
FROM n WHERE ok AND n = columns AND raw_id NOT IN (SELECT raw_id FROM found)"""
)

#: Columns of declarations that a null rate is given for.
COLUMNS = (
    "id matched_id loaded_at typeCode freqCode refYear classificationSearchCode reporterCode partnerCode partner2Code flowCode classificationCode cmdCode customsCode mosCode motCode "
    "qtyUnitCode qty qtyText altQtyUnitCode altQty netWgt grossWgt CIFValue FOBValue primaryValue isQtyEstimated isAltQtyEstimated isNetWgtEstimated isGrossWgtEstimated isReported "
    "isAggregate isOriginalClassification legacyEstimationFlag"
).split()

_NULLS = " UNION ALL ".join(f"SELECT load_no, '{c}' AS column_name, 1.0 - COUNT({c}) / CAST(COUNT(*) AS DOUBLE) AS x FROM declarations GROUP BY load_no" for c in COLUMNS)
_VALUES = " UNION ALL ".join(
    f"""SELECT load_no, '{c}' AS column_name, COUNT(DISTINCT {c}) AS d, COUNT({c}) AS n, MEDIAN({c}) AS med,
  COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({c} > 0 AND {c} <= 1e11)) AS bad FROM declarations GROUP BY load_no"""
    for c in ("CIFValue", "FOBValue")
)
SQL["p6_found"] = f"""
WITH nulls AS ({_NULLS}),
nmid AS (SELECT column_name, MEDIAN(x) AS mid FROM nulls GROUP BY column_name),
vals AS (SELECT * FROM ({_VALUES}) y WHERE n > 0),
vmid AS (SELECT column_name, MEDIAN(d / CAST(n AS DOUBLE)) AS dmid, MEDIAN(med) AS mmid FROM vals GROUP BY column_name),
known AS (SELECT DISTINCT motCode FROM cif_fob_factor WHERE motCode IS NOT NULL),
have AS (SELECT load_no, CAST(COUNT(motCode) AS DOUBLE) AS n, COUNT(*) FILTER (WHERE motCode IN (SELECT motCode FROM known)) AS hit FROM declarations GROUP BY load_no HAVING COUNT(motCode) > 0),
hits AS (SELECT load_no, motCode, COUNT(*) AS c FROM declarations GROUP BY load_no, motCode),
share AS (SELECT have.load_no, known.motCode, COALESCE(hits.c, 0) / have.n AS x FROM have CROSS JOIN known LEFT JOIN hits ON hits.load_no = have.load_no AND hits.motCode = known.motCode),
smid AS (SELECT motCode, MEDIAN(x) AS mid FROM share GROUP BY motCode)
SELECT load_no, column_name, 'null_rate' AS finding FROM nulls JOIN nmid USING (column_name) WHERE ABS(x - mid) > 0.2
UNION ALL SELECT load_no, column_name, 'distinct' FROM vals JOIN vmid USING (column_name) WHERE d / CAST(n AS DOUBLE) < dmid / 2
UNION ALL SELECT load_no, column_name, 'range' FROM vals WHERE bad / CAST(n AS DOUBLE) > 0.05
UNION ALL SELECT load_no, column_name, 'shift' FROM vals JOIN vmid USING (column_name) WHERE med > 4 * mmid OR med < mmid / 4
UNION ALL SELECT load_no, 'motCode', 'pattern' FROM have WHERE 1 - hit / n > 0.05
UNION ALL SELECT DISTINCT load_no, 'motCode', 'shift' FROM share JOIN smid USING (motCode) WHERE ABS(x - mid) > 0.2
"""

SQL["p6_values"] = " UNION ALL ".join(
    f"SELECT load_no, '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS n, COUNT(DISTINCT {c}) AS distinct_n, MEDIAN({c}) AS median FROM declarations GROUP BY load_no HAVING COUNT({c}) > 0"
    for c in ("CIFValue", "FOBValue")
)

_TEXT = {"cmdCode": "TOTAL|[0-9]{1,6}", "refYear": "[0-9]{4}", "flowCode": "X|M|RX|RM|DX|DM", "classificationCode": "H[0-9]"}
_NUMBERS = ("id", "matched_id", "reporterCode", "partnerCode", "partner2Code", "qty", "altQty", "netWgt", "grossWgt", "CIFValue", "FOBValue", "primaryValue")
_BAD = {c: f"NOT regexp_full_match({c}, '{p}')" for c, p in _TEXT.items()} | {c: f"NOT ({c} > 0 AND {c} <= 1e11)" for c in ("CIFValue", "FOBValue", "primaryValue")}
_BAD["motCode"] = "motCode NOT IN (SELECT motCode FROM cif_fob_factor WHERE motCode IS NOT NULL)"


def _column(c: str) -> str:
    d = f"CAST({c} AS DOUBLE)"
    low, high = (f"{f}({d}) FILTER (WHERE isfinite({d}))" if c in _NUMBERS else "CAST(NULL AS DOUBLE)" for f in ("MIN", "MAX"))
    bad = f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {_BAD[c]})" if c in _BAD else "CAST(NULL AS BIGINT)"
    return f"""SELECT load_no, '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, (COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) AS null_rate,
  COUNT(DISTINCT {c}) AS distinct_n, {low} AS low, {high} AS high, {bad} AS violations FROM declarations GROUP BY load_no"""


SQL["p6_profile"] = " UNION ALL ".join(_column(c) for c in COLUMNS)

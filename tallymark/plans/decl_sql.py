"""The declaration queries as SQL for another engine, built from shared common table expressions."""

from __future__ import annotations

from tallymark.operators.residual import ATTRIBUTES, FLAGS, METRICS
from tallymark.schema import KEEP

YES = "('1', 'true', 'yes', 't', 'y')"
NO = "('0', 'false', 'no', 'f', 'n', '')"
NARROW = "('true', '1', 't', 'yes')"


def level(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR length(trim({c})) = 0 THEN 'Unknown' WHEN length(trim({c})) <= 2 THEN 'HS2' WHEN length(trim({c})) <= 4 THEN 'HS4' ELSE 'HS6' END"


def padded(c: str) -> str:
    t = f"trim({c})"
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]{{1,2}}') THEN lpad({t}, 2, '0') WHEN regexp_full_match({t}, '[0-9]{{3,4}}') THEN lpad({t}, 4, '0') "
        f"WHEN regexp_full_match({t}, '[0-9]{{5,6}}') THEN lpad({t}, 6, '0') END"
    )


def reason(hs6: bool = True, prefixes: tuple[str, ...] = ()) -> str:
    narrow = " AND ".join(f"COALESCE(lower(trim({c})) IN {NARROW}, FALSE)" for c in ("isQtyEstimated", "isAltQtyEstimated", "isNetWgtEstimated", "isGrossWgtEstimated"))
    code = f"COALESCE({padded('cmdCode')}, trim(cmdCode))"
    starts = " OR ".join(f"starts_with({code}, '{p}')" for p in prefixes)
    return f"""CASE
  WHEN upper(trim(typeCode)) IS DISTINCT FROM 'C' THEN 'typeCode'
  WHEN upper(trim(freqCode)) IS DISTINCT FROM 'A' THEN 'freqCode'
  WHEN NOT COALESCE(trim(refYear) IN ('2021', '2022'), FALSE) THEN 'refYear'
  WHEN upper(trim(classificationSearchCode)) IS DISTINCT FROM 'HS' THEN 'classificationSearchCode'
  WHEN COALESCE(partnerCode = 0 AND partner2Code = 0, FALSE) THEN 'partner_zero'
  WHEN COALESCE(TRY_CAST(trim(cmdCode) AS DOUBLE) = 0, TRUE) THEN 'cmdCode'
  {f"WHEN {level('cmdCode')} <> 'HS6' THEN 'hs_level'" if hs6 else ""}
  {f"WHEN NOT COALESCE({starts}, FALSE) THEN 'commodity_filter'" if prefixes else ""}
  WHEN COALESCE(reporterCode = 0, TRUE) THEN 'reporterCode'
  WHEN NOT COALESCE(upper(trim(flowCode)) IN ('X', 'M'), FALSE) THEN 'flowCode'
  WHEN COALESCE(reporterCode = partnerCode, FALSE) THEN 'self_trade'
  WHEN upper(trim(customsCode)) IS DISTINCT FROM 'C00' THEN 'customsCode'
  WHEN {narrow} THEN 'all_estimated' END"""


def amount(c: str) -> str:
    return f"TRY_CAST(CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS DECIMAL(24, 4))"


NUMBERS = ("qty", "altQty", "netWgt", "grossWgt", "CIFValue", "FOBValue", "primaryValue")
SHIPMENT = "refYear, reporterCode, partnerCode, partner2Code, flowCode, cmdCode"
_X = "flowCode = 'X'"
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "r": ((), f"SELECT *, {reason()} AS reject_reason FROM declarations"),
    "passed": (
        ("r",),
        f"""SELECT * EXCLUDE (flowCode, reject_reason, matched_id) REPLACE ({', '.join(f'CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}' for c in NUMBERS)}), upper(trim(flowCode)) AS flowCode
  FROM r WHERE reject_reason IS NULL""",
    ),
    "s": (("passed",), f"SELECT MIN(id) AS id, load_no, refYear, {', '.join(KEEP)} FROM passed GROUP BY ALL"),
    "codes": ((), f"SELECT DISTINCT {padded('cmdCode')} AS code FROM declarations WHERE length({padded('cmdCode')}) = 6"),
    "steps": (("codes",), "SELECT code, CAST(code AS INTEGER) AS c, k FROM codes, (VALUES (3), (4), (5)) v(k) WHERE NOT (k = 4 AND CAST(code AS INTEGER) % 11 = 0)"),
    "edges": (
        ("steps",),
        """SELECT 'H' || k AS from_rev, code AS from_code, 'H' || (k + 1) AS to_rev, code AS to_code, CAST(1 AS DOUBLE) AS weight FROM steps
  UNION ALL SELECT 'H' || k, code, 'H' || (k + 1), lpad(CAST(c + 10 AS VARCHAR), 6, '0'), CAST((k - 2) * 0.5 AS DOUBLE) FROM steps WHERE c % 7 = 0 AND c < 999990""",
    ),
    "w": (("edges",), "SELECT from_rev, from_code, to_rev, to_code, weight / CASE WHEN t = 0 THEN 1 ELSE t END AS weight FROM (SELECT *, SUM(weight) OVER (PARTITION BY from_rev, from_code, to_rev) AS t FROM edges) e"),
    "nodes": (("edges",), "SELECT DISTINCT from_rev AS rev, from_code AS code FROM edges UNION SELECT DISTINCT to_rev, to_code FROM edges"),
    "h5": (("w", "nodes"), "SELECT n.rev AS f, n.code AS c, w.to_code AS here, SUM(w.weight) AS weight FROM nodes n JOIN w ON w.from_rev = 'H5' AND w.from_code = n.code WHERE n.rev = 'H5' GROUP BY ALL"),
    "h4a": (("w", "nodes"), "SELECT n.rev AS f, n.code AS c, w.to_code AS here, SUM(w.weight) AS weight FROM nodes n JOIN w ON w.from_rev = 'H4' AND w.from_code = n.code WHERE n.rev = 'H4' GROUP BY ALL"),
    "h4": (("h4a",), "SELECT f, c, w.to_code AS here, SUM(h4a.weight * w.weight) AS weight FROM h4a JOIN w ON w.from_rev = 'H5' AND w.from_code = h4a.here GROUP BY ALL"),
    "h3a": (("w", "nodes"), "SELECT n.rev AS f, n.code AS c, w.to_code AS here, SUM(w.weight) AS weight FROM nodes n JOIN w ON w.from_rev = 'H3' AND w.from_code = n.code WHERE n.rev = 'H3' GROUP BY ALL"),
    "h3b": (("h3a",), "SELECT f, c, w.to_code AS here, SUM(h3a.weight * w.weight) AS weight FROM h3a JOIN w ON w.from_rev = 'H4' AND w.from_code = h3a.here GROUP BY ALL"),
    "h3": (("h3b",), "SELECT f, c, w.to_code AS here, SUM(h3b.weight * w.weight) AS weight FROM h3b JOIN w ON w.from_rev = 'H5' AND w.from_code = h3b.here GROUP BY ALL"),
    "reached": (("h5", "h4", "h3"), "SELECT * FROM h5 UNION ALL SELECT * FROM h4 UNION ALL SELECT * FROM h3"),
    "conc": (
        ("reached", "nodes"),
        """SELECT f AS from_revision, c AS from_code, 'H6' AS to_revision, here AS to_code, round(weight, 9) AS weight, '' AS note FROM reached
  UNION ALL SELECT rev, code, 'H6', code, CAST(1 AS DOUBLE), 'identity' FROM nodes WHERE rev = 'H6' OR (rev, code) NOT IN (SELECT f, c FROM reached)""",
    ),
    "best": (("conc",), "SELECT from_revision, from_code, arg_min(to_code, (-weight, to_code)) AS to_code FROM conc GROUP BY ALL"),
    "k0": (("s",), f"SELECT *, {padded('cmdCode')} AS cmd_norm FROM s"),
    "k1": (("k0",), "SELECT *, length(cmd_norm) = 6 AND classificationCode IS DISTINCT FROM 'H6' AS in_scope FROM k0"),
    "k": (
        ("k1", "best"),
        """SELECT k1.*, CASE WHEN in_scope THEN COALESCE(to_code, cmd_norm) ELSE cmd_norm END AS canonical_cmd,
  CASE WHEN NOT COALESCE(in_scope, FALSE) THEN 'none' WHEN to_code IS NULL THEN 'unmapped' ELSE 'applied' END AS concord
  FROM k1 LEFT JOIN best ON from_revision = classificationCode AND from_code = cmd_norm""",
    ),
    "m0": (("k",), "SELECT *, COALESCE(reporterCode, -1) AS r, COALESCE(partnerCode, -1) AS p, COALESCE(partner2Code, -1) AS p2 FROM k WHERE canonical_cmd IS NOT NULL"),
    "m": (
        ("m0",),
        f"""SELECT *, trim(refYear) AS year, CASE WHEN p2 = 0 THEN 'D' ELSE 'T' END AS bucket, CASE WHEN {_X} THEN r ELSE p END AS exporter,
  CASE WHEN {_X} THEN CASE WHEN p2 = 0 THEN p ELSE p2 END ELSE r END AS importer, CASE WHEN p2 = 0 THEN 0 WHEN {_X} THEN p ELSE p2 END AS hub, canonical_cmd AS cmd FROM m0""",
    ),
    "g": (
        ("m",),
        f"""SELECT year, bucket, exporter, importer, hub, cmd, COUNT(*) FILTER (WHERE {_X}) AS n_x, COUNT(*) FILTER (WHERE NOT {_X}) AS n_m, MIN(CASE WHEN {_X} THEN id END) AS first_x
  FROM m GROUP BY ALL""",
    ),
    "ids": (("g",), "SELECT *, ROW_NUMBER() OVER (ORDER BY first_x) AS matched_id FROM g WHERE n_x > 0 AND n_m > 0"),
    "a": (("m", "ids"), "SELECT m.*, ids.matched_id FROM m LEFT JOIN ids USING (year, bucket, exporter, importer, hub, cmd)"),
    "t": (("a",), "SELECT * FROM a WHERE matched_id IS NOT NULL"),
    "dom": (("t",), "SELECT matched_id, flowCode, MIN(id) AS dom_id FROM t WHERE COALESCE(trim(motCode), '') = '0' GROUP BY ALL"),
    "kept": (("dom",), f"SELECT matched_id FROM dom GROUP BY 1 HAVING COUNT(*) FILTER (WHERE {_X}) >= 1 AND COUNT(*) FILTER (WHERE flowCode = 'M') >= 1"),
    "cl": (("t", "dom", "kept"), "SELECT t.* FROM t JOIN dom ON dom.matched_id = t.matched_id AND dom.flowCode = t.flowCode AND dom.dom_id = t.id JOIN kept ON kept.matched_id = t.matched_id"),
    "fac": ((), "SELECT trim(motCode) AS mot, CAST(factor AS DECIMAL(8, 4)) AS factor FROM cif_fob_factor WHERE factor IS NOT NULL AND trim(motCode) <> ''"),
}


def _uplifted(src: str) -> str:
    return f"""SELECT {src}.*, CAST(COALESCE(factor, 0.1) AS DOUBLE) AS uplift, CAST({amount('primaryValue')} * CAST(COALESCE(factor, CAST(0.1 AS DECIMAL(8, 4))) + 1 AS DECIMAL(8, 4)) AS DECIMAL(26, 4)) AS value_cif
  FROM {src} LEFT JOIN fac ON mot = trim(motCode)"""


def _sides(src: str) -> str:
    sums = ", ".join(f"CAST(SUM({amount(m)}) FILTER (WHERE flowCode = '{f}') AS DOUBLE) AS {m}_{f}" for m in METRICS for f in "XM")
    first = lambda c, f, n: f"arg_min({c}, id) FILTER (WHERE flowCode = '{f}' AND {c} IS NOT NULL) AS {n}"
    units = ", ".join(first(u, f, f"{u}_{f}") for u in ("qtyUnitCode", "altQtyUnitCode") for f in "XM")
    imputed = ", ".join(f"bool_or(flowCode = '{f}' AND COALESCE(lower(trim(isNetWgtEstimated)) IN {YES}, FALSE)) AS imputed_{f.lower()}" for f in "XM")
    return f"""SELECT matched_id, {sums}, CAST(SUM(value_cif) FILTER (WHERE {_X}) AS DOUBLE) AS primaryValue_X_CIF, {units}, {first('reporterCode', 'X', 'exporterCode')},
  {first('reporterCode', 'M', 'importerCode')}, {first('cmdCode', 'X', 'cmdCode')}, {imputed} FROM {src} GROUP BY matched_id HAVING bool_or({_X}) AND bool_or(flowCode = 'M')"""


CTE |= {
    "u": (("cl", "fac"), _uplifted("cl")),
    "ut": (("t", "fac"), _uplifted("t")),
    "sd": (("u",), _sides("u")),
    "st": (("ut",), _sides("ut")),
    "un": ((), "SELECT trim(code) AS c, dimension AS dm, factor_to_base AS f FROM qty_unit_conversion WHERE factor_to_base > 0 AND dimension IS NOT NULL"),
    "cv": (
        ("sd", "un"),
        """SELECT sd.*,
  CASE WHEN trim(qtyUnitCode_X) = trim(qtyUnitCode_M) THEN qty_M WHEN qm.dm = qx.dm THEN qty_M * qm.f / qx.f END AS qty_M_in_X_unit,
  CASE WHEN trim(altQtyUnitCode_X) = trim(altQtyUnitCode_M) THEN altQty_M WHEN am.dm = ax.dm THEN altQty_M * am.f / ax.f END AS altQty_M_in_X_unit
  FROM sd LEFT JOIN un qx ON qx.c = trim(qtyUnitCode_X) LEFT JOIN un qm ON qm.c = trim(qtyUnitCode_M) LEFT JOIN un ax ON ax.c = trim(altQtyUnitCode_X) LEFT JOIN un am ON am.c = trim(altQtyUnitCode_M)""",
    ),
    "rs": (
        ("cv",),
        f"""SELECT *, {level('cmdCode')} AS hs_level, qty_X - qty_M_in_X_unit AS qty_MISINVOICING, altQty_X - altQty_M_in_X_unit AS altQty_MISINVOICING, netWgt_X - netWgt_M AS netWgt_MISINVOICING,
  grossWgt_X - grossWgt_M AS grossWgt_MISINVOICING, primaryValue_X_CIF - primaryValue_M AS primaryValue_MISINVOICING FROM cv""",
    ),
    "ef": (("rs",), "SELECT matched_id, CASE WHEN primaryValue_X > 0 THEN primaryValue_X_CIF / primaryValue_X - 1 END AS e FROM rs"),
    "hubs": ((), "SELECT DISTINCT code FROM entrepot_reporters WHERE code IS NOT NULL"),
    "av": (
        ("t",),
        " UNION ALL ".join(
            f"SELECT matched_id, flowCode, '{c}' AS attribute, " + (f"CASE WHEN COALESCE(lower(trim({c})) IN {YES}, FALSE) THEN 'true' ELSE 'false' END" if c in FLAGS else c) + " AS value FROM t" for c in ATTRIBUTES
        ),
    ),
    "rep": (
        (),
        """SELECT CAST(iso_code AS INTEGER) AS iso_code, COALESCE(NULLIF(trim(name), ''), 'Unknown') AS name, COALESCE(NULLIF(trim(full_name), ''), NULLIF(trim(name), ''), 'Unknown') AS full_name,
  COALESCE(NULLIF(trim(continent), ''), 'Unknown') AS continent, COALESCE(NULLIF(trim(status), ''), 'Unknown') AS status FROM reporter_codes WHERE iso_code IS NOT NULL""",
    ),
}


def sql(text: str, *needs: str) -> str:
    """The text after the common table expressions that it needs, in order."""
    order: list[str] = []

    def add(n: str) -> None:
        for x in CTE[n][0]:
            add(x)
        if n not in order:
            order.append(n)

    for n in needs:
        add(n)
    return ("WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order) + "\n" if order else "") + text


_RES = ("qty_M_in_X_unit", "qty_MISINVOICING", "altQty_M_in_X_unit", "altQty_MISINVOICING", "netWgt_MISINVOICING", "grossWgt_MISINVOICING", "primaryValue_MISINVOICING")
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _RES)
_PLAIN = "matched_id, exporterCode, importerCode, cmdCode, hs_level, qtyUnitCode_X, qtyUnitCode_M, qty_X, qty_M, altQtyUnitCode_X, altQtyUnitCode_M, altQty_X, altQty_M, netWgt_X, netWgt_M, grossWgt_X, grossWgt_M, primaryValue_X, primaryValue_X_CIF, primaryValue_M"
_FLAGS = ", ".join(f"COUNT(*) FILTER (WHERE lower(trim({c})) IN {YES}) AS {c}_true, COUNT(*) FILTER (WHERE lower(trim({c})) NOT IN {YES} AND lower(trim({c})) NOT IN {NO}) AS {c}_unknown" for c in FLAGS)
_SAME = {q: f"COALESCE(trim({q}UnitCode_X) = trim({q}UnitCode_M), FALSE)" for q in ("qty", "altQty")}

SQL: dict[str, str] = {
    "decl_scan": "SELECT refYear, COUNT(*) AS n, COUNT(netWgt) AS with_weight, COUNT(DISTINCT reporterCode) AS reporters FROM declarations GROUP BY refYear",
    "decl_reject_reason": sql("SELECT id, reject_reason FROM r", "r"),
    "decl_survivors": sql("SELECT id, reporterCode, partnerCode, partner2Code, flowCode, cmdCode FROM s", "s"),
    "decl_dedup": sql("SELECT id, load_no FROM s", "s"),
    "decl_dedup_shipment": sql(f"SELECT MIN(id) AS id, {SHIPMENT} FROM passed GROUP BY {SHIPMENT}", "passed"),
    "duplicate_counts": sql(
        f"SELECT reporterCode, {level('cmdCode')} AS level, CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS repeats FROM (SELECT {SHIPMENT}, COUNT(*) AS n FROM passed GROUP BY {SHIPMENT}) z GROUP BY ALL",
        "passed",
    ),
    "reject_by_reporter_level": sql(
        f"SELECT reporterCode, COALESCE(reject_reason, 'kept') AS reason, {', '.join(f'COUNT(*) FILTER (WHERE {level('cmdCode')} = {v!r}) AS {v}' for v in ('HS2', 'HS4', 'HS6', 'Unknown'))} FROM r GROUP BY ALL", "r"
    ),
    "reject_counts": sql("SELECT reporterCode, COALESCE(reject_reason, 'kept') AS reason, COUNT(*) AS n FROM r GROUP BY ALL", "r"),
    "reject_by_hs_level": sql(
        f"SELECT COALESCE(reject_reason, 'kept') AS reason, {', '.join(f'COUNT(*) FILTER (WHERE {level('cmdCode')} = {v!r}) AS {v}' for v in ('HS2', 'HS4', 'HS6', 'Unknown'))} FROM r GROUP BY 1", "r"
    ),
    "commodity_prefix": f"SELECT flowCode, COALESCE({reason(False, ('27', '2709', '01', '64'))}, 'kept') AS reason, COUNT(*) AS n FROM declarations GROUP BY ALL",
    "filter_key_normalise": "SELECT upper(trim(typeCode)) AS typeCode, upper(trim(freqCode)) AS freqCode, upper(trim(classificationSearchCode)) AS classificationSearchCode, upper(trim(customsCode)) AS customsCode, COUNT(*) AS n FROM declarations GROUP BY ALL",
    "scope_semijoin": sql("SELECT reporterCode, COUNT(*) AS n FROM declarations WHERE reporterCode IN (SELECT iso_code FROM rep WHERE continent = 'Ilmora') GROUP BY 1", "rep"),
    "scope_missing_anti": sql("SELECT DISTINCT iso_code AS reporterCode FROM rep WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.reporterCode = rep.iso_code)", "rep", "s"),
    "reporters_present": sql("SELECT DISTINCT s.reporterCode, COALESCE(rep.name, 'Unknown') AS name FROM s LEFT JOIN rep ON rep.iso_code = s.reporterCode", "s", "rep"),
    "dim_reporters": sql("SELECT * FROM rep", "rep"),
    "dim_uplift": "SELECT trim(motCode) AS motCode, factor FROM cif_fob_factor WHERE trim(motCode) <> '' AND factor IS NOT NULL",
    "dim_units": "SELECT trim(code) AS code, dimension, factor_to_base FROM qty_unit_conversion WHERE factor_to_base > 0 AND dimension IS NOT NULL",
    "dim_entrepots": sql("SELECT code FROM hubs", "hubs"),
    "hs_level_counts": f"SELECT {level('cmdCode')} AS hs_level, upper(trim(flowCode)) AS flowCode, COUNT(*) AS n FROM declarations GROUP BY ALL",
    "code_pad": f"SELECT cmdCode, {padded('cmdCode')} AS cmd_norm, COUNT(*) AS n FROM declarations GROUP BY ALL",
    "tolerant_bools": f"SELECT {_FLAGS} FROM declarations",
    "weight_normalise": sql("SELECT from_rev, from_code, to_rev, to_code, round(weight, 9) AS weight FROM w", "w"),
    "concordance_compose": sql("SELECT * FROM conc", "conc"),
    "concordance_identity": sql("SELECT from_revision, COUNT(*) AS n FROM conc WHERE note = 'identity' GROUP BY 1", "conc"),
    "concordance_older_target": sql(
        """SELECT f AS from_revision, c AS from_code, 'H4' AS to_revision, here AS to_code, round(weight, 9) AS weight, '' AS note FROM h3a
  UNION ALL SELECT rev, code, 'H4', code, CAST(1 AS DOUBLE), 'identity' FROM nodes WHERE rev >= 'H4' OR (rev, code) NOT IN (SELECT f, c FROM h3a)""",
        "h3a",
        "nodes",
    ),
    "concordance_argmax": sql("SELECT * FROM best", "best"),
    "concordance_apply": sql("SELECT id, cmd_norm, canonical_cmd, concord FROM k", "k"),
    "concordance_diag": sql(
        f"""SELECT {level('cmdCode')} AS level, COUNT(*) FILTER (WHERE concord <> 'none') AS in_scope, COUNT(*) FILTER (WHERE concord = 'applied' AND canonical_cmd <> cmd_norm) AS rewritten,
  COUNT(*) FILTER (WHERE concord = 'unmapped') AS unmapped, COUNT(*) FILTER (WHERE cmd_norm IS NULL) AS dropped_unnormalisable FROM k GROUP BY 1""",
        "k",
    ),
    "mirror_direct": sql("SELECT year, exporter, importer, cmd, n_x, n_m FROM g WHERE n_x > 0 AND n_m > 0 AND bucket = 'D'", "g"),
    "mirror_triangular": sql("SELECT year, exporter, importer, hub, cmd, n_x, n_m FROM g WHERE n_x > 0 AND n_m > 0 AND bucket = 'T'", "g"),
    "match_ids": sql("SELECT id, matched_id FROM t", "t"),
    "match_unmatched": sql("SELECT id, flowCode FROM a WHERE matched_id IS NULL", "a"),
    "match_diag": sql(
        """SELECT bucket, CAST(SUM(n_x) AS BIGINT) AS x_total, COUNT(*) FILTER (WHERE n_x > 0 AND n_m > 0) AS x_matched_groups, CAST(SUM(CASE WHEN n_x > 0 AND n_m > 0 THEN n_x ELSE 0 END) AS BIGINT) AS x_matched_rows,
  CAST(SUM(CASE WHEN n_m = 0 THEN n_x ELSE 0 END) AS BIGINT) AS x_no_m, CAST(SUM(n_m) AS BIGINT) AS m_total, CAST(SUM(CASE WHEN n_x > 0 AND n_m > 0 THEN n_m ELSE 0 END) AS BIGINT) AS m_matched_rows FROM g GROUP BY 1""",
        "g",
    ),
    "match_by_country": sql(f"SELECT reporterCode, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {_X}) AS flow_x, COUNT(*) FILTER (WHERE flowCode = 'M') AS flow_m FROM s GROUP BY 1", "s"),
    "match_totals": sql("SELECT COUNT(*) AS n, COUNT(matched_id) AS rows_matched, MAX(matched_id) AS groups FROM a", "a"),
    "union_reconstitute": sql("SELECT flowCode, COUNT(*) AS n, MIN(id) AS first_id, MAX(id) AS last_id FROM m GROUP BY 1", "m"),
    "row_ids": sql("SELECT id, ROW_NUMBER() OVER (ORDER BY id) AS row_no FROM s", "s"),
    "dominant_row": sql("SELECT * FROM dom", "dom"),
    "kept_pairs": sql("SELECT * FROM kept", "kept"),
    "clean_view": sql("SELECT matched_id, id, reporterCode, flowCode, cmdCode, motCode, qtyUnitCode, qty, netWgt, primaryValue FROM cl", "cl"),
    "clean_coverage": sql(
        f"""SELECT COUNT(*) FILTER (WHERE x = 1 AND y = 1) AS pairs_case_a, COUNT(*) FILTER (WHERE (x = 1) <> (y = 1)) AS pairs_case_b, CAST(0 AS BIGINT) AS pairs_case_c, CAST(0 AS BIGINT) AS rows_summed,
  COUNT(*) FILTER (WHERE x = 1 AND y = 1) AS output_pairs FROM (SELECT matched_id, COUNT(*) FILTER (WHERE {_X}) AS x, COUNT(*) FILTER (WHERE flowCode = 'M') AS y FROM dom GROUP BY 1) z""",
        "dom",
    ),
    "pair_presence": sql(f"SELECT matched_id, bool_or({_X}) AS has_x, bool_or(flowCode = 'M') AS has_m FROM t GROUP BY 1", "t"),
    "uplift_rows": sql("SELECT matched_id, id, uplift, CAST(value_cif AS DOUBLE) AS value_cif FROM u", "u"),
    "side_sums": sql(f"SELECT matched_id, {', '.join(f'{m}_{f}' for m in METRICS for f in 'XM')}, primaryValue_X_CIF FROM sd", "sd"),
    "side_first": sql("SELECT matched_id, qtyUnitCode_X, qtyUnitCode_M, altQtyUnitCode_X, altQtyUnitCode_M, exporterCode, importerCode, cmdCode, imputed_x, imputed_m FROM st", "st"),
    "unit_convert": sql("SELECT matched_id, qtyUnitCode_X, qtyUnitCode_M, round(qty_M_in_X_unit, 6) AS qty_M_in_X_unit, round(altQty_M_in_X_unit, 6) AS altQty_M_in_X_unit FROM cv", "cv"),
    "residuals": sql(f"SELECT {_PLAIN}, {_ROUND} FROM rs", "rs"),
    "effective_uplift": sql("SELECT matched_id, round(e, 9) AS effective_uplift FROM ef", "ef"),
    "uplift_quantiles": sql("SELECT COUNT(e) AS n, round(quantile_cont(e, 0.05), 9) AS p05, round(quantile_cont(e, 0.5), 9) AS p50, round(quantile_cont(e, 0.95), 9) AS p95 FROM ef WHERE e IS NOT NULL", "ef"),
    "discrepancies": sql(
        f"""SELECT attribute, COUNT(*) FILTER (WHERE nx > 0 AND nm > 0 AND n > LEAST(nx, nm)) AS pairs FROM (SELECT attribute, matched_id, COUNT(DISTINCT CASE WHEN {_X} THEN value END) AS nx,
  COUNT(DISTINCT CASE WHEN flowCode = 'M' THEN value END) AS nm, COUNT(DISTINCT value) AS n FROM av WHERE value IS NOT NULL GROUP BY 1, 2) z GROUP BY 1""",
        "av",
    ),
    "entrepot_pairs": sql("SELECT matched_id, COALESCE(exporterCode IN (SELECT code FROM hubs), FALSE) OR COALESCE(importerCode IN (SELECT code FROM hubs), FALSE) AS is_entrepot_pair FROM rs", "rs", "hubs"),
    "mode_counts": sql(f"SELECT trim(motCode) AS motCode, COUNT(*) AS n, COALESCE(trim(motCode) IN (SELECT mot FROM fac), FALSE) AS known FROM t WHERE {_X} GROUP BY 1", "t", "fac"),
    "pair_counters": sql(
        f"""SELECT COUNT(*) AS pairs, COUNT(*) FILTER (WHERE COALESCE(exporterCode IN (SELECT code FROM hubs), FALSE) OR COALESCE(importerCode IN (SELECT code FROM hubs), FALSE)) AS entrepot_pairs,
  COUNT(*) FILTER (WHERE imputed_x OR imputed_m) AS imputed_pairs, COUNT(*) FILTER (WHERE netWgt_MISINVOICING IS NULL) AS netwgt_null,
  COUNT(*) FILTER (WHERE NOT {_SAME['qty']}) AS qty_unit_mismatch, COUNT(*) FILTER (WHERE NOT {_SAME['qty']} AND qty_M_in_X_unit IS NOT NULL) AS qty_unit_converted,
  COUNT(*) FILTER (WHERE NOT {_SAME['altQty']}) AS altqty_unit_mismatch, COUNT(*) FILTER (WHERE NOT {_SAME['altQty']} AND altQty_M_in_X_unit IS NOT NULL) AS altqty_unit_converted FROM rs""",
        "rs",
        "hubs",
    ),
}

"""Scalars, filters, pairing, canonical rows, residuals and concordance on hand-written cases."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallymark.config import Config
from tallymark.functions import codes
from tallymark.operators import canonical, cascade, concordance, pairing, residual
from tallymark.schema import DECLARATION, KEEP

GOOD = dict(
    id=1, typeCode="C", freqCode="A", refYear="2021", classificationSearchCode="HS", reporterCode=1, partnerCode=2, partner2Code=0, flowCode="X", classificationCode="H6", cmdCode="010110", customsCode="C00",
    mosCode="0", motCode="0", qtyUnitCode="41", qty=1.0, altQtyUnitCode=None, altQty=None, netWgt=1.0, grossWgt=None, CIFValue=None, FOBValue=None, primaryValue=10.0, isQtyEstimated="0",
    isAltQtyEstimated="0", isNetWgtEstimated="0", isGrossWgtEstimated="0", isReported="1", isAggregate="0", isOriginalClassification="1", legacyEstimationFlag="0",
)
SCHEMA = "id bigint, typeCode string, freqCode string, refYear string, classificationSearchCode string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DECLARATION)
CFG = Config()


def frame(spark, *rows):
    names = ["id", "typeCode", "freqCode", "refYear", "classificationSearchCode", *KEEP]
    return spark.createDataFrame([tuple({**GOOD, "id": i, **r}[n] for n in names) for i, r in enumerate(rows, 1)], SCHEMA)


def column(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"c {kind}").select(f(F.col("c"))).collect()]


def test_codes(spark):
    texts = ["1", "01", "101", "0101", "10110", "010110", "1234567", "10.5", "TOTAL", "", None, " 7 "]
    assert column(spark, texts, codes.normalise_code) == ["01", "01", "0101", "0101", "010110", "010110", None, None, None, None, None, "07"]
    assert column(spark, texts, codes.hs_level) == ["HS2", "HS2", "HS4", "HS4", "HS6", "HS6", "HS6", "HS4", "HS6", "Unknown", "Unknown", "HS2"]


def test_flags(spark):
    texts = ["1", "True", " yes ", "t", "Y", "0", "no", "", "ture", None]
    assert column(spark, texts, codes.tolerant_bool) == [True] * 5 + [False] * 5
    assert column(spark, texts, codes.unknown_bool) == [False] * 8 + [True, False]
    assert column(spark, texts, codes.narrow_bool) == [True] * 4 + [False] * 6


def test_sql_functions(spark):
    codes.register(spark)
    assert tuple(spark.sql("SELECT hs_level('0101'), normalise_code('7'), tolerant_bool(' Y'), normalise_code('x')").first()) == ("HS4", "07", True, None)


@pytest.mark.parametrize("change,reason", [
    ({}, None), ({"typeCode": None}, "typeCode"), ({"typeCode": " c "}, None), ({"freqCode": "M"}, "freqCode"), ({"refYear": None}, "refYear"), ({"refYear": " 2021 "}, None),
    ({"classificationSearchCode": None}, "classificationSearchCode"), ({"partnerCode": 0, "partner2Code": 0}, "partner_zero"), ({"partnerCode": None, "partner2Code": 0}, None), ({"cmdCode": None}, "cmdCode"),
    ({"cmdCode": "TOTAL"}, "cmdCode"), ({"cmdCode": "000000"}, "cmdCode"), ({"cmdCode": "0101"}, "hs_level"), ({"reporterCode": None}, "reporterCode"), ({"reporterCode": 0}, "reporterCode"),
    ({"flowCode": None}, "flowCode"), ({"flowCode": " m "}, None), ({"flowCode": "RX"}, "flowCode"), ({"partnerCode": 1}, "self_trade"), ({"customsCode": None}, "customsCode"),
    ({"isQtyEstimated": "yes", "isAltQtyEstimated": "T", "isNetWgtEstimated": "1", "isGrossWgtEstimated": "TRUE"}, "all_estimated"),
    ({"isQtyEstimated": "y", "isAltQtyEstimated": "T", "isNetWgtEstimated": "1", "isGrossWgtEstimated": "TRUE"}, None), ({"typeCode": "S", "cmdCode": None}, "typeCode"),
])
def test_reasons(spark, change, reason):
    assert cascade.with_reject_reason(frame(spark, change), CFG).first().reject_reason == reason


def test_absent_columns_and_conservation(spark):
    df = frame(spark, {}, {"typeCode": "S"}, {"cmdCode": None}, {"flowCode": "Q"})
    assert cascade.with_reject_reason(df.drop("typeCode", "isQtyEstimated"), CFG).filter("reject_reason is null").count() == 2
    assert sum(r.n for r in cascade.counts(df, CFG, ["reporterCode"]).collect()) == 4
    assert [r.n for r in cascade.counts(df, Config(prefixes=("02",)), ["reporterCode"]).filter("reason = 'commodity_filter'").collect()] == [2]


def test_duplicates(spark):
    df = frame(spark, {}, {}, {"netWgt": 2.0}, {"netWgt": None}, {"netWgt": None})
    assert sorted(r.id for r in cascade.drop_duplicates(df, []).collect()) == [1, 3, 4]
    assert cascade.drop_duplicates(df, ["refYear"]).count() == 3


def paired(spark, *rows):
    df = frame(spark, *rows).withColumn("canonical_cmd", F.col("cmdCode"))
    return {r.id: r.matched_id for r in pairing.pair(pairing.with_mirror_key(df)).collect()}


M = {"flowCode": "M", "reporterCode": 2, "partnerCode": 1}


def test_pairs(spark):
    assert paired(spark, {}, M) == {1: 1, 2: 1}
    assert paired(spark, {}, {}, M, M, M) == dict.fromkeys(range(1, 6), 1)
    assert paired(spark, {"partnerCode": 3, "partner2Code": 2}, {**M, "partner2Code": 3}) == {1: 1, 2: 1}
    assert paired(spark, {}, {**M, "partner2Code": 3}) == {1: None, 2: None}
    assert paired(spark, {"partnerCode": 0, "partner2Code": 2}, {**M, "partner2Code": 0}) == {1: None, 2: None}
    assert paired(spark, {"partnerCode": None, "partner2Code": 2}, {**M, "partner2Code": None}) == {1: 1, 2: 1}
    assert paired(spark, {"cmdCode": "01"}, {**M, "cmdCode": "0001"}) == {1: None, 2: None}
    assert paired(spark, {"refYear": "2020"}, M) == {1: None, 2: None}
    assert paired(spark, {**M, "reporterCode": 9}, {"partnerCode": 9}, M, {}) == {1: 1, 2: 1, 3: 2, 4: 2}


def greedy(rows):
    """X rows in order look up their mirror rows; all X of one tuple and all M of the bucket share an id."""
    out, seen, n = dict.fromkeys(range(1, len(rows) + 1)), {}, 0
    key = lambda r: tuple(-1 if r[c] is None else r[c] for c in ("reporterCode", "partnerCode", "partner2Code")) + (r["cmdCode"],)
    for i, r in enumerate(rows, 1):
        if r["flowCode"] != "X":
            continue
        k = key(r)
        if k not in seen:
            a, b, c, cmd = k
            want = (b, a, 0, cmd) if c == 0 else (c, a, b, cmd)
            hits = [j for j, m in enumerate(rows, 1) if m["flowCode"] == "M" and key(m) == want and (key(m)[2] == 0) == (c == 0)]
            if hits:
                n += 1
                for j in hits:
                    out[j] = n
            seen[k] = n if hits else None
        out[i] = seen[k]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_pairs_against_the_greedy_loop(spark, seed):
    rnd = random.Random(seed)
    rows = [{"flowCode": rnd.choice("XM"), "reporterCode": rnd.choice([None, 1, 2, 3]), "partnerCode": rnd.choice([None, 0, 1, 2, 3]), "partner2Code": rnd.choice([0, 0, 0, None, 1, 2]), "cmdCode": rnd.choice(["010110", "020220"])} for _ in range(120)]
    assert paired(spark, *rows) == greedy([{**GOOD, **r} for r in rows])


def test_dense_numbers_over_buckets(spark):
    df = spark.range(0, 5000, 7)
    got = [(r.id, r.no) for r in pairing.number(df, "id", "no", bits=8).collect()]
    assert sorted(got) == [(7 * i, i + 1) for i in range(715)]


def matched(spark, *rows):
    ids = [r.pop("matched_id", 1) for r in rows]
    df = frame(spark, *rows)
    return df.join(spark.createDataFrame(list(enumerate(ids, 1)), "id bigint, matched_id bigint"), "id")


def test_canonical_rows(spark):
    df = matched(spark, {"motCode": "1000"}, {"motCode": " 0 "}, {}, M, {**M, "motCode": None}, {"matched_id": 2}, {**M, "matched_id": 2, "motCode": "9"}, {"matched_id": 3, "motCode": "2"}, {**M, "matched_id": 3, "motCode": "2"})
    assert sorted(r.id for r in canonical.clean(df).collect()) == [2, 4]
    c = canonical.coverage(canonical.sides(df)).first()
    assert (c.pairs_case_a, c.pairs_case_b, c.output_pairs) == (1, 1, 1)
    assert canonical.clean_or_passthrough(df.drop("motCode")).count() == df.count()


def factors(spark):
    return spark.createDataFrame([("0", 0.1), ("1000", 0.2)], "motCode string, factor double")


def units(spark):
    return spark.createDataFrame([("41", "mass", 1.0), ("42", "mass", 0.001), ("51", "count", 1.0)], "code string, dimension string, factor_to_base double")


def one(spark, x, m):
    return residual.residuals(residual.with_uplift(matched(spark, x, {**M, **m}), factors(spark)), units(spark)).first()


def test_residuals(spark):
    r = one(spark, {"netWgt": 5.0, "primaryValue": 100.0, "qty": 2.0}, {"netWgt": 3.0, "primaryValue": 120.0, "qty": 500.0, "qtyUnitCode": "42"})
    assert (r.netWgt_MISINVOICING, r.primaryValue_X_CIF, r.primaryValue_MISINVOICING, r.qty_M_in_X_unit, r.qty_MISINVOICING) == (2.0, 110.0, -10.0, 0.5, 1.5)
    assert (r.exporterCode, r.importerCode, r.cmdCode, r.hs_level) == (1, 2, "010110", "HS6")
    assert one(spark, {"netWgt": None}, {}).netWgt_MISINVOICING is None
    assert one(spark, {}, {"qtyUnitCode": "51"}).qty_MISINVOICING is None
    assert one(spark, {"qtyUnitCode": "zz"}, {"qtyUnitCode": "zz"}).qty_MISINVOICING == 0.0
    assert one(spark, {"qtyUnitCode": None}, {"qtyUnitCode": None}).qty_MISINVOICING is None
    for mot, up in (("0", 0.1), ("1000", 0.2), ("9999", 0.1), (None, 0.1)):
        assert one(spark, {"motCode": mot, "primaryValue": 1.0}, {}).primaryValue_X_CIF == pytest.approx(1 + up)


def test_sides_swapped_negate(spark):
    zero = factors(spark).withColumn("factor", F.lit(0.0))
    a, b = {"netWgt": 5.0, "primaryValue": 7.0, "qty": 3.0}, {"netWgt": 2.0, "primaryValue": 9.0, "qty": 8.0}
    f = lambda x, m: residual.residuals(residual.with_uplift(matched(spark, x, {**M, **m}), zero, 0.0), units(spark)).first()
    p, q = f(a, b), f(b, a)
    for c in ("netWgt", "primaryValue", "qty"):
        assert p[f"{c}_MISINVOICING"] == -q[f"{c}_MISINVOICING"]


def test_discrepancies(spark):
    df = matched(spark, {"customsCode": "C00", "mosCode": "1"}, {**M, "customsCode": "C01", "mosCode": None}, {"matched_id": 2, "customsCode": "C00"}, {"matched_id": 2, "customsCode": "C01"}, {**M, "matched_id": 2, "customsCode": "C01"})
    got = {r.attribute: r.pairs for r in residual.discrepancies(df).collect()}
    assert got["customsCode"] == 2 and got["mosCode"] == 0


def test_entrepots_modes_and_effective_uplift(spark):
    df = residual.with_uplift(matched(spark, {}, M, {"matched_id": 2, "motCode": "7"}, {**M, "matched_id": 2}), factors(spark))
    res = residual.residuals(df, units(spark))
    hubs = spark.createDataFrame([("2",), (None,)], "code string")
    assert [r.is_entrepot_pair for r in residual.with_entrepot(res, hubs).collect()] == [True, True]
    assert {(r.motCode, r.n, r.known) for r in residual.mode_counts(df, factors(spark)).collect()} == {("0", 1, True), ("7", 1, False)}
    q = residual.uplift_quantiles(res).first()
    assert q.n == 2 and q.p50 == pytest.approx(0.1)


def edges(spark, *rows):
    return spark.createDataFrame(rows, "from_rev string, from_code string, to_rev string, to_code string, weight double")


def test_compose(spark):
    e = edges(spark, ("H2", "a", "H3", "b", 0.5), ("H2", "a", "H3", "c", 0.5), ("H3", "b", "H4", "d", 1.0), ("H3", "c", "H4", "d", 0.4), ("H3", "c", "H4", "e", 0.6), ("H2", "x", "H3", "y", 1.0), ("H5", "n", "H6", "n", 1.0))
    got = {(r.from_revision, r.from_code): {} for r in concordance.compose(e, "H4").collect()}
    for r in concordance.compose(e, "H4").collect():
        got[r.from_revision, r.from_code][r.to_code] = round(r.weight, 9)
    assert got["H2", "a"] == {"d": 0.7, "e": 0.3}
    assert got["H2", "x"] == {"x": 1.0} and got["H3", "y"] == {"y": 1.0}
    assert got["H4", "d"] == {"d": 1.0} and got["H5", "n"] == {"n": 1.0} and got["H6", "n"] == {"n": 1.0}
    best = {(r.from_revision, r.from_code): r.to_code for r in concordance.best_targets(concordance.compose(e, "H4"), "H4").collect()}
    assert best["H2", "a"] == "d"


def test_weights_ties_and_zero(spark):
    e = concordance.normalise_weights(edges(spark, ("H3", "a", "H4", "b", 1.0), ("H3", "a", "H4", "c", 3.0), ("H3", "z", "H4", "z", 0.0)))
    assert {(r.from_code, r.to_code): r.weight for r in e.collect()} == {("a", "b"): 0.25, ("a", "c"): 0.75, ("z", "z"): 0.0}
    tie = concordance.compose(edges(spark, ("H5", "a", "H6", "c", 0.5), ("H5", "a", "H6", "b", 0.5)), "H6")
    assert concordance.best_targets(tie, "H6").filter("from_code = 'a'").first().to_code == "b"


@pytest.mark.parametrize("stem,pair", [("HS2007_HS2012", ("H3", "H4")), ("hs92-hs96", ("H0", "H1")), ("hs02_hs07", ("H2", "H3")), ("HS2017 HS2022", ("H5", "H6")), ("other", (None, None)), ("HS1999_HS2012", (None, "H4"))])
def test_names(stem, pair):
    assert concordance.pair_from_name(stem) == pair


@pytest.mark.parametrize("columns,want", [
    (["HS 2012", "HS 2017"], (0, 1, None)), (["old hs code", "new hs code"], (0, 1, None)), (["From", "To", "Share"], (0, 1, 2)), (["share_H5", "H5", "H4"], (2, 1, 0)),
    (["HS17", "weight_hs12", "HS12"], (2, 0, 1)), (["source code", "ratio", "target code"], (0, 2, 1)), (["a", "b"], None),
])
def test_columns_of_revision_tables(spark, columns, want):
    df = spark.createDataFrame([("0.1", "0.2", "0.3")[: len(columns)]], columns)
    e = concordance.edges_from_table(df, "H4", "H5")
    if want is None:
        assert e is None
    else:
        r = e.first()
        value = lambda i: 1.0 if i is None else (i + 1) / 10
        assert (float(r.from_code), float(r.to_code), r.weight) == tuple(map(value, want))


def test_build_from_tables(spark):
    a = spark.createDataFrame([(" 1 ", "2", "0.5"), ("1", "3", "x"), ("", "4", "1")], "`Old Code` string, `New Code` string, share string")
    got = concordance.build({"HS2017_HS2022": a, "junk": a}, "H6").filter("from_revision = 'H5'").collect()
    assert {(r.to_code, round(r.weight, 4)) for r in got} == {("2", 0.3333), ("3", 0.6667)}
    with pytest.raises(ValueError):
        concordance.build({"junk": a}, "H6")


def test_canonicalise(spark):
    best = spark.createDataFrame([("H5", "010110", "010111")], "from_revision string, from_code string, to_code string")
    df = frame(spark, {"classificationCode": "H5", "cmdCode": "10110"}, {"classificationCode": "H6"}, {"classificationCode": "H5", "cmdCode": "0101"}, {"classificationCode": "H5", "cmdCode": "999999"}, {"cmdCode": "x"})
    got = {r.id: (r.canonical_cmd, r.concord) for r in concordance.canonicalise(df, best, "H6").collect()}
    assert got == {1: ("010111", "applied"), 2: ("010110", "none"), 3: ("0101", "none"), 4: ("999999", "unmapped"), 5: (None, "none")}


def test_settings():
    assert Config().digest() != Config(hs_level="HS4").digest()
    for bad in ({"hs_level": "HS8"}, {"years": ("21",)}, {"canonical_revision": "H9"}):
        with pytest.raises(ValueError):
            Config(**bad)

import statistics

import numpy as np

import pytest
from pyspark.sql import functions as F

from tallymark.operators import profile as module
from tallymark.operators.profile import _fit, column_profile, discrimination, profile, profile_findings, value_profile
from tallymark.operators.quantiles import exact_quantiles

SCHEMA = "id bigint, load_no int, CIFValue double, FOBValue double, motCode string, column_name string, n int, finding int"


def rows_of(load, n, rng, cif=1.0, nulls=0.0, mot="0", out=0.0, same=False, start=0):
    r = []
    for i in range(n):
        v = None if rng.random() < nulls else -1.0 if rng.random() < out else 5.0 if same else cif * float(np.exp(rng.normal(5, 1)))
        r.append((start + i, load, v, float(np.exp(rng.normal(5, 1))), mot if rng.random() < 0.6 else "2100", "x", 1, 2))
    return r


def findings(spark, rows):
    codes = spark.createDataFrame([("0", 1.0), ("2100", 1.0), (None, 1.0)], "motCode string, factor double")
    return {(r.load_no, r.column_name, r.finding) for r in profile_findings(profile(spark.createDataFrame(rows, SCHEMA), codes)).collect()}


def test_planted_findings(spark):
    rng = np.random.default_rng(0)
    rows = []
    for load, kw in enumerate([{}, {}, {}, {}, {"cif": 6.0}, {"nulls": 0.5}, {"mot": "zz"}, {"out": 0.2}, {"same": True}]):
        rows += rows_of(load, 400, rng, start=load * 1000, **kw)
    got = findings(spark, rows)
    # load 8 holds one value, exp(5) / 5 or so: a thirtieth of the others' median
    assert got == {(4, "CIFValue", "shift"), (5, "CIFValue", "null_rate"), (6, "motCode", "pattern"), (6, "motCode", "shift"), (7, "CIFValue", "range"), (8, "CIFValue", "distinct"), (8, "CIFValue", "shift")}


def test_one_load_nulls_only_and_empty(spark):
    two = findings(spark, [(1, 0, None, None, None, None, None, None), (2, None, None, float("nan"), "0", None, None, None)])
    rates = {(load, c, "null_rate") for load in (0, None) for c in ("FOBValue", "motCode")}  # one of two loads is null: both are half away from the median
    assert two == rates | {(None, "FOBValue", "range")}
    assert findings(spark, []) == set()
    assert findings(spark, [(1, 0, 1.0, 1.0, "0", "", 1, 1)]) == set()


def test_models_find_the_weights_of_levels():
    rng = np.random.default_rng(2)
    x = np.stack([rng.integers(0, 4, 4000), rng.integers(4, 8, 4000)], axis=1)
    y = rng.random(4000) < 1 / (1 + np.exp(-2.0 * (x[:, 0] == 1)))
    beta = _fit(x, 8, y)
    assert beta[1] - beta[[0, 2, 3]].max() > 1.2 and np.ptp(beta[4:8]) < 0.3


def loads_with_a_shift(rng, n=600):
    """Load 3 has other codes; in load 4 CIF and FOB are alike, which no column tells by itself."""
    rows = []
    for load in range(6):
        for i in range(n):
            cif = float(np.exp(rng.normal(5, 2)))
            fob = cif if load == 4 else float(np.exp(rng.normal(5, 2)))
            rows.append((load * n + i, load, cif, fob, "0" if rng.random() < (0.1 if load == 3 else 0.7) else "2100", "x", 1, 2))
    return rows


def test_classifier_tells_a_shifted_column_and_no_other(spark, monkeypatch):
    monkeypatch.setattr(module, "FEW", 100)
    codes = spark.createDataFrame([("0", 1.0), ("2100", 1.0)], "motCode string, factor double")
    got = {(r.load_no, r.column_name): r for r in discrimination(profile(spark.createDataFrame(loads_with_a_shift(np.random.default_rng(0)), SCHEMA), codes)).collect()}
    assert len(got) == 6 * 7
    r = got[3, "motCode"]
    assert r.auc > 0.7 and r.auc_alone > 0.7 and r.auc_lost > 0.15 and r.proposed
    assert abs(got[3, "CIFValue"].auc_lost) < 0.05 and abs(got[1, "motCode"].auc_alone - 0.5) < 0.08


def test_shifts_come_from_the_classifier(spark, monkeypatch):
    """Without its proposals the exact band gives no shift; all other findings stay."""
    rng = np.random.default_rng(0)
    rows = [r for load, kw in enumerate([{}, {}, {}, {"cif": 9.0}, {"mot": "zz"}]) for r in rows_of(load, 300, rng, start=load * 1000, **kw)]
    assert {(3, "CIFValue", "shift"), (4, "motCode", "shift"), (4, "motCode", "pattern")} <= findings(spark, rows)
    real = module.discrimination
    monkeypatch.setattr(module, "discrimination", lambda p: real(p).withColumn("proposed", F.lit(False)))
    assert {f for f in findings(spark, rows)} == {(4, "motCode", "pattern")}


def test_loads_in_blocks_and_a_long_code_table(spark, monkeypatch):
    rows = loads_with_a_shift(np.random.default_rng(1), 200)
    codes = spark.createDataFrame([("0", 1.0), ("2100", 1.0)], "motCode string, factor double")
    of = lambda: sorted((r.load_no, r.column_name, round(r.auc, 9)) for r in discrimination(profile(spark.createDataFrame(rows, SCHEMA), codes)).collect())
    whole = of()
    monkeypatch.setattr(module, "LOADS_AT_ONCE", 2)
    assert of() == whole
    with pytest.raises(ValueError):
        profile(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(str(i), 1.0) for i in range(300)], "motCode string, factor double"))


def test_exact_medians(spark):
    rng = np.random.default_rng(3)
    values = [float(x) for x in rng.lognormal(0, 4, 501)] + [-3.5, -1e9, 0.0, -0.0, 1e300, 5e-324]
    rows = [(i, 0, v, 1.0, "0", "", 0, 0) for i, v in enumerate(values)] + [(9999, 1, 2.0, None, "0", "", 0, 0)]
    got = {(r.load_no, r.column_name): (r.n, r.distinct_n, r.median) for r in value_profile(spark.createDataFrame(rows, SCHEMA), ["CIFValue", "FOBValue"]).collect()}
    assert got[0, "CIFValue"] == (len(values), len(set(values)), statistics.median(values))
    assert got[1, "CIFValue"] == (1, 1, 2.0) and (1, "FOBValue") not in got


def test_exact_quantiles(spark):
    rng = np.random.default_rng(4)
    v = [float(x) for x in rng.normal(0, 100, 777)] + [0.0, 0.0, float("nan")]
    df = spark.createDataFrame([(x, i % 2) for i, x in enumerate(v)] + [(None, 1)], "x double, g int")
    got = exact_quantiles(df, "x", [0.05, 0.5, 0.95, 0.0, 1.0]).first()
    want = np.quantile([x for x in v if x == x], [0.05, 0.5, 0.95, 0.0, 1.0])
    assert got.n == 779 and np.allclose([got.q0, got.q1, got.q2, got.q3, got.q4], want, rtol=0, atol=1e-12)
    assert exact_quantiles(df, "x", [0.5], ["g"]).count() == 2
    assert exact_quantiles(df.limit(0), "x", [0.5]).count() == 0


def test_column_profile(spark):
    rows = [(i, 0, float(i), None, "ab"[i % 2], "x", 1, 1) for i in range(100)] + [(200, None, float("nan"), float("inf"), None, None, None, None)]
    got = {(r.load_no, r.column_name): r for r in column_profile(spark.createDataFrame(rows, SCHEMA)).collect()}
    r = got[0, "CIFValue"]
    assert (r.rows, r.nulls, r.low, r.high, r.distinct_n, r.violations) == (100, 0, 0.0, 99.0, 100, None)
    assert got[0, "FOBValue"].null_rate == 1.0 and got[0, "motCode"].distinct_n == 2 and got[0, "motCode"].low is None
    assert got[None, "CIFValue"].low is None and got[None, "FOBValue"].high is None
    assert len(got) == 2 * 7
    assert column_profile(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shifts_among_nulls_and_in_small_and_null_loads(spark):
    """The exact band alone decides: nulls, a load of one row and a null load_no hide no shift."""
    rng = np.random.default_rng(5)
    rows = []
    for load in range(5):
        rows += [(load * 1000 + i, load, float(np.exp(rng.normal(5, 1))) if i % 10 == 0 else None, 1.0 + i, ("0" if i % 20 else "2100") if i % 10 == 0 else None, "x", 1, 2) for i in range(400)]
    rows += [(9000 + i, None, 5 * float(np.exp(rng.normal(5, 1))) if i % 10 == 0 else None, 1.0 + i, ("0" if i % 40 else "2100") if i % 10 == 0 else None, "x", 1, 2) for i in range(400)]
    rows += [(9900, 7, 1e6, 1e6, None, "x", 1, 2)]
    got = findings(spark, rows)
    assert {(None, "CIFValue", "shift"), (None, "motCode", "shift"), (7, "CIFValue", "shift"), (7, "FOBValue", "shift")} <= got
    assert not {f for f in got if f[2] == "shift" and f[0] in range(5)}


def test_distinct_of_a_null_load(spark):
    rng = np.random.default_rng(6)
    rows = [r for load in (0, 1, 2) for r in rows_of(load, 100, rng, start=load * 1000)] + rows_of(None, 100, rng, same=True, start=5000)
    assert (None, "CIFValue", "distinct") in findings(spark, rows)


def test_distinct_counts_of_all_columns_are_exact(spark):
    rows = [(i, None if i % 3 == 0 else i % 2, float(i % 7919) if i % 2 else None, -0.0 if i % 2 else 0.0, str(i % 4999), "x", None, i) for i in range(30_000)]
    got = {(r.load_no, r.column_name): r.distinct_n for r in column_profile(spark.createDataFrame(rows, SCHEMA)).collect()}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for load in (None, 0, 1):
        for j, name in enumerate(names):
            if name != "load_no":
                assert got[load, name] == len({r[j] for r in rows if r[1] == load and r[j] is not None}), (load, name)

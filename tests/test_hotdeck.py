import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import hotdeck
from tallymark.operators.hotdeck import _distance, _fill, _neighbours, filled, hot_deck
from tests.conftest import DATA

SCHEMA = "id bigint, cmdCode string, flowCode string, reporterCode int, refYear string, primaryValue double, grossWgt double, netWgt double, isNetWgtEstimated string, field string, grp string, block int"


def row(i, net, flag="false", cmd="010110", flow="X", rep=1, year="2020", value=100.0, gross=None):
    return (i, cmd, flow, rep, year, value, gross, net, flag, "x", None, 3)


def fills(spark, rows, **kw):
    return {(r.id, r.field): r for r in hot_deck(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def test_closest_donors_by_value(spark):
    rows = [row(i, float(i), value=float(i)) for i in range(1, 200)] + [row(1000, None, value=50.2)]
    got = fills(spark, rows)
    assert list(got) == [(1000, "netWgt")]
    r = got[1000, "netWgt"]
    assert abs(r.fill - 50) <= 1 and r.donor_id == int(r.fill) and r.level == "block"


def test_gross_weight_tells_more_than_value(spark):
    rows = [row(i, float(i), value=100.0, gross=float(i) * 1.1) for i in range(1, 100)] + [row(1000, None, value=100.0, gross=77.0)]
    assert fills(spark, rows)[1000, "netWgt"].fill == 70.0


def test_missing_is_null_nan_zero_and_unknown_words(spark):
    rows = [row(1, 5.0), row(2, None), row(3, float("nan")), row(4, 0.0), row(5, -1.0), row(6, 6.0, flag=" Y "), row(7, 6.0, flag="maybe"), row(8, 6.0, flag=None), row(9, 1.0, flag="FALSE")]
    got = fills(spark, rows)
    assert set(got) == {(2, "netWgt"), (3, "netWgt"), (4, "netWgt"), (5, "netWgt"), (7, "isNetWgtEstimated"), (8, "isNetWgtEstimated")}
    assert got[8, "isNetWgtEstimated"].fill == 0.0


def test_levels_without_donors_in_the_block(spark):
    rows = [row(1, 5.0, cmd="010110"), row(2, None, cmd="010999"), row(3, None, cmd="999999", flow="M"), row(4, 7.0, cmd=None, flow=None, rep=None, year=None, value=None)]
    got = fills(spark, rows)
    assert (got[2, "netWgt"].fill, got[2, "netWgt"].level) == (5.0, "chapter")
    assert got[3, "netWgt"].level == "table" and got[3, "netWgt"].fill in (5.0, 7.0)


def test_no_donor_at_all_and_empty(spark):
    got = fills(spark, [row(1, None, flag=None)])
    assert {(k, r.fill, r.level) for k, r in got.items()} == {((1, "netWgt"), None, "none"), ((1, "isNetWgtEstimated"), None, "none")}
    assert fills(spark, []) == {}


def test_hot_block_is_split_and_complete(spark):
    rows = [row(i, None if i % 3 == 0 else float(i), value=float(i + 1)) for i in range(3000)]
    got = fills(spark, rows, block_rows=200, chunk_rows=100)
    assert {k[0] for k in got} == {r[0] for r in rows if r[7] is None or r[7] <= 0}
    assert all(r.level == "block" for r in got.values())
    assert np.median([abs(r.fill - i) for (i, _), r in got.items()]) < 40


def test_against_brute_force_neighbours():
    rng = np.random.default_rng(1)
    n = 60
    block = np.repeat([0, 1], n // 2)
    x = rng.normal(size=n)
    value = np.where(rng.random(n) < 0.3, np.nan, rng.integers(1, 50, n).astype(float))
    ids = np.arange(n)
    order = np.lexsort((ids, x, block))
    want, fill, who, dist = _fill(block, ids, [("near", x / 3, 1.0)], [order], value, False, 5, 1)
    for w, f, d in zip(want, fill, who):
        donors = [j for j in range(n) if block[j] == block[w] and not np.isnan(value[j])]
        best = min(donors, key=lambda j: (min(abs(x[j] - x[w]) / 3, 1), j))
        assert f == value[best] and d == best


def test_held_out_weights(spark):
    """Known weights are hidden: the fill must come nearer than the good's median."""
    t = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/declarations.parquet").filter("netWgt > 0 and not isnan(netWgt) and grossWgt is null")
    hidden = t.withColumn("truth", F.col("netWgt")).withColumn("netWgt", F.when(F.pmod(F.xxhash64("id"), F.lit(10)) == 0, None).otherwise(F.col("netWgt")))
    got = hot_deck(hidden).filter("field = 'netWgt'").join(hidden.select("id", "truth", "cmdCode"), "id")
    med = hidden.groupBy("cmdCode").agg(F.median("netWgt").alias("m"))
    e = got.join(med, "cmdCode").agg(F.median(F.abs(F.ln(F.col("fill") / F.col("truth")))).alias("e"), F.median(F.abs(F.ln(F.col("m") / F.col("truth")))).alias("b")).first()
    assert e.e < e.b


def test_filled_marks(spark):
    df = spark.createDataFrame([row(1, 5.0), row(2, None, flag="?")], SCHEMA)
    got = {r.id: r for r in filled(df, hot_deck(df)).collect()}
    assert (got[1].netWgt_filled, got[2].netWgt, got[2].netWgt_filled, got[2].isNetWgtEstimated, got[2].isNetWgtEstimated_filled) == (False, 5.0, True, "false", True)


@pytest.mark.parametrize("seed", range(3))
def test_only_values_of_donors(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [row(int(i), None if rng.random() < 0.3 else float(rng.integers(1, 9)) * 1.5, rep=int(rng.integers(1, 4)), value=float(rng.integers(1, 5))) for i in range(300)]
    donors = {r[0]: r[7] for r in rows if r[7]}
    for r in fills(spark, rows).values():
        assert donors[r.donor_id] == r.fill


@pytest.mark.parametrize("seed", range(4))
def test_all_donors_of_a_block_are_considered(seed):
    """Mixed features with nulls, repeats and ties: the five closest donors are those of a full comparison."""
    rng = np.random.default_rng(seed)
    n = 500
    block, ids = np.sort(rng.integers(0, 3, n)), rng.permutation(n)
    hide = lambda x, share: np.where(rng.random(n) < share, np.nan, x)
    reporter, year = rng.integers(0, 5, n), hide(rng.integers(2015, 2022, n).astype(float), 0.1)
    lv, lg = hide(np.round(rng.normal(5, 3, n), seed % 2), 0.2), hide(rng.normal(5, 3, n), 0.3)
    features = [("same", reporter, 0.5), ("near", year / 10, 0.5), ("near", lv / 3, 2.0), ("near", lg / 3, 4.0)]
    donor = rng.random(n) < 0.7
    want = np.flatnonzero(~donor)
    near, dist = _neighbours(block, ids, features, [np.lexsort((ids, lv, block))], donor, want, 3, 5)
    for w, got, d in zip(want, near, dist):
        def far(j):
            total, weight = 0.5 * (reporter[w] != reporter[j]), 0.5
            for _, c, x in features[1:]:
                if not np.isnan(c[w] - c[j]):
                    total, weight = total + x * min(abs(c[w] - c[j]), 1.0), weight + x
            return total / weight

        best = sorted((far(j), ids[j], j) for j in np.flatnonzero(donor & (block == block[w])))[:5]
        assert list(got) == [j for _, _, j in best] and np.allclose(d, [x for x, _, _ in best], rtol=0, atol=1e-12)


def test_split_blocks_give_what_whole_blocks_give(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [row(i, None if rng.random() < 0.3 else float(rng.integers(1, 10**6)), "zz" if rng.random() < 0.2 else "01"[i % 2], rep=int(rng.integers(1, 4)), year=str(rng.integers(2015, 2022)), value=float(rng.lognormal(5, 3)), gross=None if i % 4 == 0 else float(rng.lognormal(5, 3))) for i in range(1500)]
    rows += [r for r in rows if r[0] % 50 == 0] + [row(i, None, cmd="020220") if i % 2 else row(i, 5.0, cmd="020220") for i in range(2000, 2010)]
    every = lambda **kw: sorted(map(tuple, hot_deck(spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=str)
    whole, split = every(), every(block_rows=100)
    assert len(whole) == len(split) > 500 and whole == split
    monkeypatch.setattr(hotdeck, "ASKED", 30)
    monkeypatch.setattr(hotdeck, "LARGE_BLOCKS", 0)
    assert every(block_rows=60) == whole


def test_split_blocks_of_one_value_and_without_donors(spark):
    """A bin that holds a whole block, and a large block in which nothing is known."""
    rows = [row(i, None if i % 2 else float(i), value=5.0, flag=None) for i in range(500)] + [row(1000 + i, None, cmd="020220", flag=None) for i in range(300)]
    every = lambda **kw: sorted(map(tuple, hot_deck(spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=str)
    whole = every()
    assert len(whole) == 251 + 500 + 600 and every(block_rows=50) == whole


def test_work_a_record_does_not_grow_with_the_block(spark, monkeypatch):
    """A shard of a very large block is narrow in gross weight, which then tells nothing: few of its donors may be looked at."""
    rng = np.random.default_rng(3)
    n = 20_000
    reporter, year = np.where(rng.random(n) < 0.9, 1, rng.integers(2, 50, n)), rng.integers(2012, 2022, n).astype(float)
    _, features = hotdeck._measure(np.zeros(n, int), np.arange(n), reporter, year, rng.normal(5, 0.2, n), rng.uniform(5, 5.003, n))
    orders, _ = hotdeck._measure(np.zeros(n, int), np.arange(n), reporter, year, features[2][1] * 3, features[3][1] * 3)
    pairs, distance = [], hotdeck._distance
    monkeypatch.setattr(hotdeck, "_distance", lambda f, r, d: pairs.append(len(r)) or distance(f, r, d))
    donor = np.arange(n) >= 500
    near, dist = _neighbours(np.zeros(n, int), np.arange(n), features, orders, donor, np.arange(500), 3, 5)
    assert sum(pairs) < 300 * 500
    for w in range(0, 500, 50):
        x = distance(features, np.full(n - 500, w), np.arange(500, n))
        assert np.array_equal(np.sort(x)[:5], dist[w])


def test_few_shards_are_asked(spark, monkeypatch):
    """Records without gross weight ask the shards about their value, not all those in order of gross weight."""
    rng = np.random.default_rng(11)
    value = rng.lognormal(5, 0.5, 8000)
    rows = [row(i, None if i % 10 == 0 else float(v), value=float(v), gross=None if i % 4 == 0 else float(v * rng.lognormal(0, 0.16)), year=str(2015 + i % 3)) for i, v in enumerate(value)]
    asked, search = [], hotdeck._search_shards
    monkeypatch.setattr(hotdeck, "_search_shards", lambda placed, asks, *a: asked.append(asks.count()) or search(placed, asks, *a))
    got = fills(spark, rows, block_rows=200)
    assert len(got) == 800 and asked[0] == 800 and asked[1] < 5 * 800


def test_recall_on_the_tables_is_one(spark):
    """All five closest donors of records of the real table, in shards, against a full comparison."""
    t = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/declarations.parquet").filter("cmdCode is not null")
    top = t.groupBy("cmdCode", "flowCode").count().orderBy(F.desc("count")).first()
    block = t.filter((F.col("cmdCode") == top.cmdCode) & F.col("flowCode").eqNullSafe(top.flowCode))
    got = {r.id: (r.donor_id, r.fill) for r in hot_deck(block, block_rows=20).filter("field = 'netWgt'").collect()}
    pdf = block.toPandas()
    log = lambda c: np.log(np.where(pdf[c].fillna(0) > 0, pdf[c].fillna(0), np.nan)).astype("float32").astype(float)
    features = [("same", pdf.reporterCode.fillna(-1).to_numpy(), 0.5), ("near", pdf.refYear.astype(float).to_numpy() / 10, 0.5), ("near", log("primaryValue") / 3, 2.0), ("near", log("grossWgt") / 3, 4.0)]
    value, ids = pdf.netWgt.where(pdf.netWgt > 0).to_numpy(), pdf.id.to_numpy()
    donors, want = np.flatnonzero(~np.isnan(value)), np.flatnonzero(np.isnan(value))
    assert len(want) > 5 and set(got) == set(ids[want])
    for w in want:
        x = _distance(features, np.full(len(donors), w), donors)
        five = donors[np.lexsort((ids[donors], x))[:5]]
        assert got[ids[w]][0] in set(ids[five]) and got[ids[w]][1] in set(value[five])


def test_table_level_is_the_median_of_the_table(spark):
    weights = {"01": (1.0, 1.0, 1.0), "02": (10.0, 11.0), "03": (20.0, 21.0)}
    rows = [row(int(c) * 10 + i, w, cmd=f"{c}0110") for c, ws in weights.items() for i, w in enumerate(ws)]
    r = fills(spark, [*rows, row(1000, None, cmd="990110")])[1000, "netWgt"]
    assert (r.fill, r.level) == (10.0, "table")

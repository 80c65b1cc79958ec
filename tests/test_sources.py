"""Raw files, manifest, datasets, the pipeline over them, and the file stream."""

import gzip
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tallymark.cli import main
from tallymark.config import Config
from tallymark.plans.pipeline import Pipeline, ordered_phases
from tallymark.schema import FILTER_ONLY, KEEP
from tallymark.sources import dims, ingest, raw, store
from tallymark.sources.manifest import Manifest, fingerprint, quick_hash, read_json, write_json
from tallymark.streaming.incremental import arrivals_by_load, load_new
from tests.conftest import DATA
from tests.test_reconcile import GOOD, M, units, factors

NAMES = [*FILTER_ONLY, *KEEP]


def gz(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def line(sep=",", names=NAMES, **kw):
    r = {**GOOD, **kw}
    return sep.join("" if r[n] is None else str(r[n]) for n in names)


@pytest.fixture
def files(tmp_path):
    root = tmp_path / "raw"
    os.makedirs(root / "2021")
    gz(root / "2021" / "CA12021H6.gz", [",".join(NAMES), line(), line(), line(netWgt=7.5)])
    upper = [n.upper() for n in NAMES if n != "grossWgt"]
    gz(root / "2021" / "CA22021H6.gz", ["\t".join(upper), line("\t", [n for n in NAMES if n != "grossWgt"], **M)])
    gz(root / "CA22021H5.gz", [",".join(NAMES), line(reporterCode=99)])
    gz(root / "CA32020H6.gz", [",".join(NAMES), line(refYear="2020")])
    (root / "2021" / "CA42021H6.gz").write_bytes(b"no gzip")
    return root


def test_discover(files):
    found = raw.discover(str(files), "2021")
    assert [(f.reporter, f.sep, os.path.basename(f.path)) for f in found] == [(1, ",", "CA12021H6.gz"), (2, "\t", "CA22021H6.gz")]
    assert [f.reporter for f in raw.discover(str(files), "2021", {2})] == [2]
    assert len(raw.discover(str(files), "2020")) == 1
    assert raw.NAME.search("CA8422021H6_b1.txt").groups() == ("842", "2021")


def test_validity(files, tmp_path):
    assert not raw.valid_gzip(str(files / "2021" / "CA42021H6.gz")) and not raw.valid_gzip(str(tmp_path / "none.gz"))
    assert [os.path.basename(p) for p in raw.sweep_corrupt(str(files / "2021"))] == ["CA42021H6.gz"]


def test_scan(spark, files):
    df = raw.with_row_ids(raw.scan(spark, raw.discover(str(files), "2021")))
    rows = df.orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4] and [r.netWgt for r in rows] == ["1.0", "1.0", "7.5", "1.0"]
    assert rows[3].flowCode == "M" and rows[3].grossWgt is None and set(NAMES) <= set(df.columns)
    with pytest.raises(FileNotFoundError):
        raw.scan(spark, [])


def test_pipeline(spark, files, tmp_path):
    d = {"factors": factors(spark), "conversion": units(spark), "entrepots": spark.createDataFrame([("2",)], "code string"), "reporters": None}
    p = Pipeline(spark, str(tmp_path), Config(), d)
    assert p.run() == {"aggregate/2021": True, "match/2021": True, "residual/2021": True}
    assert store.read(spark, p.path("aggregate")).count() == 3
    assert store.read(spark, p.path("match")).filter("is_matched = 1").count() == 3
    assert store.read(spark, p.path("clean")).count() == 2
    res = store.read(spark, p.path("residual")).first()
    assert res.netWgt_MISINVOICING == 0.0 and res.primaryValue_MISINVOICING == pytest.approx(1.0)
    stats = json.load(open(tmp_path / "stats" / "residual_2021.json"))
    assert stats["counts"][0]["pairs"] == 1 and stats["counts"][0]["entrepot_pairs"] == 1
    assert not any(p.run().values())
    clean = json.load(open(tmp_path / "stats" / "match_2021.json"))
    assert clean["clean"][0]["output_pairs"] == 1 and sum(x["total_rows"] for x in clean["per_country"]) == 3
    repeats = json.load(open(tmp_path / "stats" / "aggregate_2021.json"))["duplicates"]
    assert sum(x["repeats"] for x in repeats) == sum(x["rows"] for x in repeats) - 3 == 1
    columns = store.read(spark, p.path("match")).columns
    assert columns.index("hs_level") == columns.index("cmdCode") + 1
    assert all(Pipeline(spark, str(tmp_path), Config(canonical_revision="H5"), d).run().values())
    with pytest.raises(ValueError):
        ordered_phases(["nothing"])
    assert ordered_phases(["residual", "match"]) == ["match", "residual"]


def test_steps_follow_their_tables(spark, files, tmp_path):
    """A changed dimension table or concordance makes what was made from it again, and nothing before it."""
    d = {"factors": factors(spark), "conversion": units(spark), "entrepots": spark.createDataFrame([("2",)], "code string"), "reporters": None}
    Pipeline(spark, str(tmp_path), Config(), d).run()
    other = {**d, "conversion": d["conversion"].limit(1)}
    assert list(Pipeline(spark, str(tmp_path), Config(), other).run().values()) == [False, False, True]
    best = spark.createDataFrame([("H9", "010110", "010111")], "from_revision string, from_code string, to_code string")
    assert list(Pipeline(spark, str(tmp_path), Config(), other, best_codes=best).run().values()) == [False, True, True]
    shutil.rmtree(tmp_path / "clean")
    assert Pipeline(spark, str(tmp_path), Config(), d).residual_input("2021").count() == 3  # the matched rows stand in


def test_retrieval_phase(spark, tmp_path):
    def fetch(code, year, folder):
        gz(os.path.join(folder, f"CA{code}{year}H6.gz"), ["a"])

    reporters = spark.createDataFrame([("8", "n", "f", "c", "s"), ("9", "N", "F", "C", "S")], "iso_code string, name string, full_name string, continent string, status string")
    p = Pipeline(spark, str(tmp_path), Config(), {"reporters": reporters}, fetch=fetch)
    assert p.run(["retrieval"]) == {"retrieval/2021": True}
    assert json.load(open(tmp_path / "stats" / "retrieval_2021.json"))["summary"][0]["downloaded"] == 2
    with pytest.raises(ValueError):
        Pipeline(spark, str(tmp_path), Config(), {"reporters": reporters}).run(["retrieval"])


def test_unreadable_and_case(tmp_path):
    (tmp_path / "ca82021h6.GZ").write_bytes(b"\x1f\x8bxx")
    gz(tmp_path / "Ca92021H6.gz", ["a,b"])
    bad = []
    assert [f.reporter for f in raw.discover(str(tmp_path), "2021", unreadable=bad)] == [9]
    assert [os.path.basename(b) for b in bad] == ["ca82021h6.GZ"]


def test_manifest(tmp_path):
    m = Manifest(str(tmp_path / "m.json"))
    m.put("a", {"digest": "d", "inputs": [1]})
    again = Manifest(m.path)
    assert again.fresh("a", "d", [1]) and not again.fresh("a", "e", [1]) and not again.fresh("b", "d", [1])
    again.drop("a")
    assert Manifest(m.path).entries == {}
    write_json(m.path, {"version": -1, "entries": {"x": 1}})
    assert Manifest(m.path).entries == {}
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "left.tmp").write_text("")
    assert read_json(str(tmp_path / "bad.json")) == {} and m.sweep() == 1
    assert fingerprint([m.path])[0][0] == "m.json"


def test_retrieve(spark, tmp_path):
    calls, pauses = [], []

    def fetch(code, year, folder):
        calls.append(code)
        if code == 2 and calls.count(2) < 3:
            raise ConnectionError
        if code == 3:
            raise ValueError
        if code == 4:
            (tmp_path / year / f"CA4{year}H6.gz").write_bytes(b"junk")
            return
        gz(os.path.join(folder, f"CA{code}{year}H6.gz"), ["a"])

    os.makedirs(tmp_path / "2021")
    gz(tmp_path / "2021" / "CA12021H6.gz", ["a"])
    got = ingest.retrieve(spark, fetch, [1, 2, 3, 4], ["2021"], str(tmp_path), Manifest(str(tmp_path / "m.json")), sleep=pauses.append)
    assert {(r.reporterCode, r.status) for r in got.collect()} == {(1, "cached"), (2, "downloaded"), (3, "missing"), (4, "missing")}
    assert tuple(ingest.summary(got).first()) == ("2021", 4, 1, 1, 2, [3, 4])
    assert calls == [2, 2, 2, 3, 4] and pauses == [1.0, 2.0, 0.1, 0.1, 0.1]


def test_datasets(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "k string, v int, w int")
    store.write_year(df, p, "2020", ("k",))
    store.write_year(df, p, "2021", ("k",))
    store.write_year(spark.createDataFrame([("b", 2, 7)], "k string, v int, w int"), p, "2021", ("k",))  # nothing old of that year is left
    assert {(r.year, r.k, r.v) for r in store.read(spark, p).collect()} == {(2020, "a", 1), (2020, "b", 1), (2021, "b", 2)}
    assert store.exists(spark, p) and store.first_existing(spark, [str(tmp_path / "no"), p]) == p
    store.write_text(df, str(tmp_path / "csv"), gzip=True)
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    c = spark.createDataFrame([("H5", "a", "H6", "b", 0.333333, "")], "from_revision string, from_code string, to_revision string, to_code string, weight double, note string")
    store.write_concordance(c, str(tmp_path / "conc"))
    assert spark.read.csv(str(tmp_path / "conc"), header=True).first().weight == "0.3333"
    assert store.merge_documents([{"r": 1, "n": 1}, {"r": 2, "n": 1}], [{"r": 2, "n": 9}], ("r",)) == [{"r": 1, "n": 1}, {"r": 2, "n": 9}]
    with pytest.raises(ValueError):
        store.STATS_ROWS, most = 1, store.STATS_ROWS
        try:
            store.stats_document(df)
        finally:
            store.STATS_ROWS = most


def test_dimensions(spark):
    r = spark.createDataFrame([("8", " ", None, "", "S"), ("x", "n", "f", "c", "s"), ("9", "N", " ", "C", None)], "iso_code string, name string, full_name string, continent string, status string")
    assert {tuple(x) for x in dims.reporters(r).collect()} == {(8, "Unknown", "Unknown", "Unknown", "S"), (9, "N", "N", "C", "Unknown")}
    u = spark.createDataFrame([("1", "m", "2.5"), ("2", None, "1"), ("3", "m", "0"), (None, "m", "1")], "code string, dimension string, factor_to_base string")
    assert [tuple(x) for x in dims.conversions(u).collect()] == [("1", "m", 2.5)]
    named = dims.with_names(spark.createDataFrame([(9,), (5,)], "c int"), dims.reporters(r), "c", "nm")
    assert {tuple(x) for x in named.collect()} == {(9, "N"), (5, "Unknown")}


def test_revision_tables(spark, tmp_path):
    (tmp_path / "HS2017_HS2022.csv").write_text("HS 2017;HS 2022;share\n010110;010111;0.5\n")
    (tmp_path / "HS2012_HS2017.tsv").write_text("from\tto\n1\t2\n")
    t = raw.revision_tables(spark, str(tmp_path))
    assert set(t) == {"HS2017_HS2022", "HS2012_HS2017"} and t["HS2017_HS2022"].columns == ["HS 2017", "HS 2022", "share"]


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    lines = spark.read.parquet(f"{DATA}/raw_lines.parquet").select("raw_id", "file_name", F.col("line_no").cast("int").alias("line_no"), "line")
    lines.coalesce(1).write.parquet(src)
    load_new(spark, src, out, ck)
    first = spark.read.parquet(f"{out}/rows").count()
    load_new(spark, src, out, ck)
    assert spark.read.parquet(f"{out}/rows").count() == first > 0
    assert first + spark.read.parquet(f"{out}/rejected").select("raw_id").distinct().count() == lines.filter("line_no > 1").count()


def test_arrivals_have_a_watermark(spark, tmp_path):
    t = spark.read.parquet(f"{DATA}/declarations.parquet")
    t.select("loaded_at", "load_no").write.parquet(str(tmp_path / "d"))
    s = arrivals_by_load(spark.readStream.schema(t.select("loaded_at", "load_no").schema).parquet(str(tmp_path / "d")))
    q = s.writeStream.format("memory").queryName("arrivals").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("arrivals").agg(F.sum("n")).first()[0] == t.filter("loaded_at is not null").count()


def test_command_line(spark, files, tmp_path):
    out = tmp_path / "conc"
    (tmp_path / "src").mkdir()
    build = ["concordance", "--src", str(tmp_path / "src"), "--target", "H6", "--output", str(out)]
    assert main(build, spark) == 2 and not out.exists()
    (tmp_path / "src" / "HS2017_HS2022.csv").write_text("HS 2017,HS 2022\n010110,010111\n")
    assert main(build, spark) == 0
    assert {(r.from_code, r.to_code, r.weight) for r in spark.read.csv(str(out), header=True).filter("from_revision = 'H5'").collect()} == {("010110", "010111", "1.0000")}
    run = ["run", "--root", str(tmp_path), "--dims", DATA, "--years", "2021", "--phases"]
    assert main([*run, "aggregate", "match", "--concordance", str(out), "--target", "H6"], spark) == 0
    assert main([*run, "retrieval"], spark) == 1
    assert main([*run, "nonsense"], spark) == 1
    assert main([*run, "match", "--reporters", "999999"], spark) == 2


def test_quick_hash(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_bytes(b"x" * 50 + b"y")
    b.write_bytes(b"x" * 50 + b"z")
    assert quick_hash(str(a), 8) != quick_hash(str(b), 8) == quick_hash(str(b), 8)

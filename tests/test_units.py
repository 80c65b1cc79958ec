import pytest

import csv

import duckdb

from tallymark.functions.units import Names
from tallymark.operators.unit_text import convert_units, converted_units
from tests.conftest import DATA

NAMES = Names(duckdb.sql(f"SELECT code, abbr, dimension, factor_to_base, notes FROM '{DATA}/qty_unit_conversion.parquet'").fetchall())


@pytest.mark.parametrize(
    "name,code",
    [("KGS.", "41"), (" Tsd. Stück", "55"), ("'000 pcs", "55"), ("ct..", "46"), ("lb av.", "45"), ("1000 kg", "43"), ("hundred kg", "44"), ("144 pcs", "54"), ("grs (144)", "54"), ("m³", "63"),
     ("1000 l", "63"), ("100 l", "62"), ("thousand kWh", "72"), ("1000 m", "92"), ("'000 m2", "83"), ("metros cúbicos", "63"), ("kg net", "41"), ("Mg", "43"), ("mg", None), ("oz", None), ("net lbs", "45"), ("kg of 12 pcs", None), (" 41 ", "41"), ("pkgs", None), ("cajas", None), ("", None), ("coils", None)],
)
def test_names(name, code):
    assert NAMES.of_field(name) == code


@pytest.mark.parametrize(
    "text,code",
    [
        ("1,021.8864 pound (packed in 33 kg bags)", "45"),
        ("5701.4669metre", "91"),
        ("10 pallets, together 2.182 TSD. STÜCK", "55"),
        ("16 pallets, together 2.1732 x '000 pcs", "55"),
        ("total 0.0769 x 1000 U; see annex 13", "55"),
        ("0.5281 Kilogramm in 27 cartons", "41"),
        ("reported as 4383.4286 LB AV., net", "45"),
        ("cantidad 3.9454 x 144 pcs", "54"),
        ("Menge in Gramm", "42"),
        ("quantity stated in 1000 U", "55"),
        ("UOM=cubic metres", "63"),
        ("10 pallets, together 2,181.8858 lbs", "45"),
        ("unit: ct.", "46"),
        ("unit: kg", "41"),
        ("units = 3 dozen", "53"),
        ("packed in 37 kg bags", None),
        ("cartons of 28 pcs", None),
        ("bottles of 21 ml", None),
        ("drums of 51 l each", None),
        ("in containers of 57 t", None),
        ("value per 100 kg agreed", None),
        ("rolled on cores, 60 m apart", None),
        ("lot 17/B", None),
        ("51 packages, weight not stated", None),
        ("0.0359 coils", None),
        ("see annex 10", None),
        ("", None),
        ("   ", None),
    ],
)
def test_texts(text, code):
    assert NAMES.in_text(text) == code


def test_scale_or_quantity_by_context():
    assert NAMES.in_text("1000 kg", 1000.0) == "41"
    assert NAMES.in_text("1000 kg", 3.5) == "43"
    assert NAMES.in_text("3.5 x 1000 kg", 1000.0) == "43"


def test_longest_match_and_word_limits():
    assert [m[2] for m in NAMES.matches("kg kilograms m m2 tsd. stück")] == ["kg", "kilograms", "m", "m2", "tsd. stück"]
    assert NAMES.matches("cakg kgx m25") == []
    assert NAMES.in_text("x" * 200_000 + " 5 kg") == "41"


def test_automaton_against_brute_force():
    text = "12 kg of 3 tsd. stück at 1000 kg and '000 pcs ; 5ml"
    want = []
    for i in range(len(text)):
        for n in NAMES.alias:
            if text.startswith(n, i) and (i + len(n) == len(text) or not (text[i + len(n)].isalnum() or text[i + len(n)] in "²³")):
                if i and (text[i - 1].isalpha() or (n[0] in "0123456789'") and text[i - 1] in "0123456789.,'"):
                    continue
                want.append((i, i + len(n), n))
    want.sort(key=lambda m: (m[0], -m[1]))
    out, reach = [], 0
    for m in want:
        if m[0] >= reach:
            out.append(m)
            reach = m[1]
    assert [m[:3] for m in NAMES.matches(text)] == out


SCHEMA = "id bigint, qty double, qtyUnitCode string, qtyText string, code string, dimension int, factor string"
ROWS = [
    (1, 2.0, " 43 ", None, "x", 1, "y"), (2, 2.0, "99", "5 kg", None, None, None), (3, 2.0, None, "2 lbs", None, None, None), (4, 2.0, "kilos", "2 lbs", None, None, None),
    (5, None, "43", None, None, None, None), (6, 2.0, "", None, None, None, None), (7, float("nan"), "42", None, None, None, None), (8, 2.0, "coils", "2 coils", None, None, None),
    (3, 2.0, None, "2 lbs", None, None, None), (9, None, None, "2 lbs", None, None, None),
]


def test_conversion_and_cases(spark):
    units = spark.read.parquet(f"{DATA}/qty_unit_conversion.parquet")
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(((r.id, r.code, r.dimension, r.qty_base) for r in convert_units(df, units).collect()), key=str)
    assert len(got) == len(ROWS)
    assert (1, "43", "mass", 2000.0) in got and (4, "41", "mass", 2.0) in got and [r[:3] for r in got].count((3, "45", "mass")) == 2
    assert (2, None, None, None) in got and (6, None, None, None) in got and (8, None, None, None) in got
    assert (7, "42", "mass", None) in got
    assert sorted((r.id, r.code) for r in converted_units(df, units).collect()) == [(1, "43"), (3, "45"), (3, "45"), (7, "42")]
    assert convert_units(df.limit(0), units).count() == 0


def test_names_come_from_the_table():
    """A table of other codes, dimensions and bases: names find its rows, and units it does not have find none."""
    names = Names([("a", "kg", "weight", 1000.0, None), ("b", "g", "weight", 1.0, "base"), ("c", "?", "weight", 1e6, None), ("d", "1000 L", "vol", 1000.0, None), ("e", "l", "vol", 1.0, None), ("z", "nil", None, None, None), (None, "x", "y", 1.0, None)])
    want = {"kilos": "a", "Gramm": "b", "tonnes": "c", "?": "c", "1000 litres": "d", "m3": "d", "ltr": "e", "lbs": None, "pcs": None, "1000 kg": "c", "nil": None, "z": "z"}
    assert {n: names.of_field(n) for n in want} == want
    assert names.in_text("total 3 kilos; 4 litres") == "a"
    assert Names([]).of_field("kg") is None and Names([]).in_text("5 kg") is None


def test_another_public_table():
    rows = [(r["code"], r["abbr"], r["dimension"] or None, float(r["factor_to_base"]) if r["factor_to_base"] else None, r["notes"]) for r in csv.DictReader(open(f"{__file__.rsplit(chr(47), 1)[0]}/units_by_item.csv", encoding="utf-8"))]
    names = Names(rows)
    want = {"kg": "8", "carats": "13", "thousand kWh": "3", "tonnes": "21", "barrels": "19", "pairs": "6", "dozen": "11", "square metres": "2", "1000 litres": ("12", "20"), "terajoule": "18", "grams": "15"}
    for n, code in want.items():
        assert names.of_field(n) in (code if isinstance(code, tuple) else (code,)), n

"""Names of units, and the automaton that finds them in text.

Public names of units are kept by unit: its dimension and its size in a common base. Which code of a
conversion table a unit has is found from that table alone - its rows' abbr (or notes) say what unit
they are, which gives the table's base of each dimension, and every other name goes to the row of its
dimension whose factor_to_base fits. Names of scaled units ("1000 kg", "thousand pcs") are built by
rule from scale words and the names of the unit they scale, where the table has a row of that size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

# Dimension, size in kg, items, litres, kWh, m2 or m, and names of units.
UNITS: list[tuple[str, float, str]] = [
    ("mass", 1.0, "kg|kgs|kilo|kilos|kilogram|kilograms|kilogramm|kilogramme|kilogrammes|kilogramo|kilogramos|quilograma|quilogramas|chilogrammo|chilogrammi|кг|公斤|千克"),
    ("mass", 0.001, "g|gr|gm|gms|gram|grams|gramm|gramme|grammes|gramo|gramos|grama|gramas|grammo|grammi"),
    ("mass", 0.000001, "mg|milligram|milligrams|milligramm|milligramme|milligrammes|miligramo|miligramos"),
    ("mass", 1000.0, "t|mt|to|tonne|tonnes|tonnen|metric ton|metric tons|metric tonne|metric tonnes|tonelada|toneladas|tonnellata|tonnellate|megagram|megagrams|тонна|吨"),
    ("mass", 100.0, "q|dt|quintal|quintals|quintales|quintaux|quintali|dezitonne|dezitonnen|doppelzentner|metric hundredweight"),
    ("mass", 0.45359237, "lb|lbs|lb av|lbs av|pound|pounds|pfund|libra|libras"),
    ("mass", 0.028349523125, "oz|ounce|ounces|unze|unzen|onza|onzas|once|onces|oncia|once av"),
    ("mass", 0.0002, "ct|cts|carat|carats|karat|quilate|quilates|quilat|carato|carati"),
    ("count", 1.0, "u|unit|units|unidad|unidades|unidade|unité|unités|unita|unità|pc|pcs|piece|pieces|pièce|pièces|pieza|piezas|peça|peças|item|items|stück|stueck|stk|einheiten|einheit|штука|штук"),
    ("count", 2.0, "pair|pairs|pr|prs|paar|paire|paires|par|pares|paio|paia"),
    ("count", 12.0, "dozen|dozens|doz|dz|dutzend|docena|docenas|dúzia|dúzias|douzaine|douzaines|dozzina|dozzine"),
    ("count", 144.0, "gross|grosses|gruesa|gruesas|grossa|grosas|grosa|grosse"),
    ("count", 1000.0, "millier|milliers|millar|millares|milheiro|milheiros|mille|mil unidades|tausend"),
    ("volume", 1.0, "l|lt|ltr|ltrs|litre|litres|liter|liters|litro|litros|litri"),
    ("volume", 100.0, "hl|hectolitre|hectolitres|hectoliter|hectoliters|hektoliter|hectolitro|hectolitros"),
    ("volume", 1000.0, "m3|m³|cbm|cu m|cu. m|cubic metre|cubic metres|cubic meter|cubic meters|kubikmeter|metro cúbico|metros cúbicos|mètre cube|mètres cubes"),
    ("volume", 158.987, "bbl|bbls|barrel|barrels|fass|fässer|baril|barils|barril|barriles|barris"),
    ("volume", 0.001, "ml|millilitre|millilitres|milliliter|milliliters|mililitro|mililitros"),
    ("volume", 3.785411784, "gal|gallon|gallons|gallone|gallonen|galón|galones"),
    ("energy", 1.0, "kwh|kilowatt hour|kilowatt hours|kilowatt-hour|kilowatt-hours|kilowattstunde|kilowattstunden|kilovatio hora|kilowattheure|kilowattheures"),
    ("energy", 1000.0, "mwh|megawatt hour|megawatt hours|megawatt-hour|megawatt-hours|megawattstunde|megawattstunden"),
    ("energy", 277.777778, "gj|gigajoule|gigajoules|gigajulio|gigajulios"),
    ("energy", 277777.7778, "tj|terajoule|terajoules|terajulio|terajulios"),
    ("area", 1.0, "m2|m²|sqm|sq m|sq. m|square metre|square metres|square meter|square meters|quadratmeter|metro cuadrado|metros cuadrados|metros quadrados|mètre carré|mètres carrés"),
    ("area", 10000.0, "ha|hectare|hectares|hektar|hectárea|hectáreas"),
    ("length", 1.0, "m|metre|metres|meter|meters|mtr|mtrs|metro|metros|mètre|mètres|metri"),
    ("length", 1000.0, "km|kms|kilometre|kilometres|kilometer|kilometers|kilómetro|kilómetros|quilómetro|quilómetros|kilomètre|kilomètres"),
    ("length", 0.9144, "yd|yds|yard|yards|yarda|yardas"),
    ("length", 0.3048, "ft|foot|feet|fuß|pie|pies"),
]
# Spellings that only case or a size in brackets tells from another unit's.
CASED = {"Mg": ("mass", 1000.0)}
SIZED = {("count", 144.0): "grs|gr"}
# Units whose multiples are named by a scale word, and words of the scales.
SCALABLE = {("mass", 1.0), ("mass", 0.001), ("count", 1.0), ("volume", 1.0), ("volume", 0.001), ("volume", 1000.0), ("energy", 1.0), ("area", 1.0), ("length", 1.0)}
SCALE_WORDS = {1000: "1000 |1,000 |1.000 |1 000 |'000 |000 |thousand |thousands of |thd |tsd. |tsd |tausend |mil |mille |miles de |milliers de ", 144: "144 |gross of ", 100: "100 |hundred |cent ", 12: "12 |dozen ", 2: "2 "}
# Words that leave the named unit what it is.
QUALIFIERS = frozenset("net nett netto neto gross gros brut brutto bruto weight of".split())

# Words after or before a quantity which say that it is packing, a price or a part.
PACKED_BEFORE = re.compile(r"\b(packed|packing|per|price|priced|value|bottles?|drums?|cartons?|containers?|bags?|boxes|box|cases?|pallets?|crates?|sacks?|cores|each|every|tins?|cans?|rolls?|cajas|lots?|parts?)\b")
PACKED_AFTER = re.compile(r"^[\s.]*(bags?|boxes|cartons?|drums?|bottles?|containers?|sacks?|crates?|cases?|each|apart|agreed|per|long|wide|thick|parts?)\b")


#: Limits of clauses; a comma inside a number is none.
_CLAUSE = re.compile(r"[;()]|,(?!\d)")



def normalise(text: str) -> str:
    """Case folded, blanks collapsed, outer blanks removed."""
    return " ".join(text.lower().split())


def _close(a: float, b: float) -> bool:
    return math.isclose(a, b, rel_tol=2e-4)


class Names:
    """Names of the units of one conversion table: rows of (code, abbr, dimension, factor_to_base, notes).

    A name whose unit has no row in the table stands for None: it is a unit, but none of the table."""

    def __init__(self, rows: Iterable[tuple]):
        rows = [(c.strip(), a or "", d, f, n or "") for c, a, d, f, n in rows if c is not None]
        self.codes = {c for c, *_ in rows}
        rows = [r for r in rows if r[2] is not None and r[3] is not None and r[3] > 0]
        size_of = {n: (d, f) for d, f, names in UNITS for n in names.split("|")}
        # The table's own dimension and base, as far as its rows name known units.
        votes: dict[str, Counter] = {}
        for _, abbr, dimension, factor, notes in rows:
            known = size_of.get(normalise(abbr)) or size_of.get(normalise(notes))
            if known:
                votes.setdefault(known[0], Counter())[dimension, float(f"{factor / known[1]:.3g}")] += 1
        base = {d: v.most_common(1)[0][0] for d, v in votes.items()}

        def row_of(dimension: str, size: float) -> str | None:
            if dimension not in base:
                return None
            there, scale = base[dimension]
            return next((c for c, _, d, f, _ in rows if d == there and _close(f, size * scale)), None)

        self.alias: dict[str, str | None] = {}
        for code, abbr, *_ in rows:
            self.alias.setdefault(normalise(abbr), code)
        self.cased = {n: row_of(*u) for n, u in CASED.items()}
        for dimension, size, names in UNITS:
            code = row_of(dimension, size)
            for n in names.split("|"):
                self.alias.setdefault(n, code)
            if size > 1 and code:
                for n in [*names.split("|"), *SIZED.get((dimension, size), "").split("|")]:
                    self.alias.setdefault(f"{n} ({size:g})", code)
            if (dimension, size) in SCALABLE:
                for scale, words in SCALE_WORDS.items():
                    if scaled := row_of(dimension, size * scale):
                        for word in words.split("|"):
                            for n in names.split("|"):
                                self.alias.setdefault(word + n, scaled)
        self.alias.pop("", None)
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for name, code in self.alias.items():
            self.automaton.add_word(name, (name, code))
        if self.alias:
            self.automaton.make_automaton()

    def matches(self, t: str) -> list[tuple[int, int, str, str | None]]:
        """Leftmost longest matches (start, end, alias, code) at word limits of normalised text."""
        found = []
        for last, (name, code) in self.automaton.iter(t) if self.alias else ():
            start, end = last - len(name) + 1, last + 1
            if end < len(t) and (t[end].isalnum() or t[end] in "²³"):
                continue
            if start and (t[start - 1].isalpha() or (name[0].isdigit() or name[0] == "'") and t[start - 1] in "0123456789.,'"):
                continue
            found.append((start, end, name, code))
        found.sort(key=lambda m: (m[0], -m[1]))
        out, reach = [], 0
        for m in found:
            if m[0] >= reach:
                out.append(m)
                reach = m[1]
        return out

    def of_field(self, text: str) -> str | None:
        """Code of the unit that a unit field states: its code, or the one unit it names beside qualifiers."""
        raw = text.strip()
        if raw in self.codes:
            return raw
        if raw.rstrip(" .") in self.cased:
            return self.cased[raw.rstrip(" .")]
        t = normalise(text)
        found = self.matches(t)
        named = [m for m in found if m[2] not in QUALIFIERS] or found
        if len(named) != 1:
            return None
        start, end, _, code = named[0]
        return code if set(re.findall(r"[^\W_]+", t[:start] + " " + t[end:])) <= QUALIFIERS else None

    def of_text(self, text: str) -> tuple[str | None, float | None, str | None]:
        """(code, number, other): the unit that free text states for the quantity, not one of packing, price or
        parts; other instead of code if the quantity is `number`, which then is no part of the unit's name."""
        t = normalise(text)
        depth, inside = 0, []
        for c in t:
            depth += c == "("
            inside.append(depth > 0)
            depth -= c == ")" and depth > 0
        best = None
        for start, end, name, code in self.matches(t):
            if inside[start] or re.match(r"\s*[:=]", t[end:]):  # a label, as in "unit: kg"
                continue
            before = _CLAUSE.split(t[:start])[-1]
            if PACKED_BEFORE.search(before) or PACKED_AFTER.match(t[end:]):
                continue
            number = re.match(r"(\d+) ", name)
            value, other = None, None
            if number and not before.rstrip().endswith(("x", "×")):  # "1000 kg" of a quantity of 1000 is in kg
                value, other = float(number[1]), self.alias.get(name[number.end() :], code)
            near = bool(re.search(r"\d\s*[x×]?\s*$", before)) or bool(number)
            if best is None or near and not best[0]:
                best = (near, (code, value, other))
        return best[1] if best else (None, None, None)

    def in_text(self, text: str, qty: float | None = None) -> str | None:
        code, value, other = self.of_text(text)
        return other if value is not None and qty == value else code

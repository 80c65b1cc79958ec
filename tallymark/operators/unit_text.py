"""Quantities recorded in different units: one base unit for each dimension.

The unit is the one whose code stands in the unit field; if none does, the one named there in words;
if none is, the one that the free text states for the quantity. One scan: Arrow batches go through
the multi-pattern automaton of the table's names (see functions.units), which finds aliases near
numbers and settles overlaps by longest match and context; each different field and text of a batch is
looked at once, and a text only where its field gives no unit. Factors are joined by broadcast: the
conversion table is a reference table, and one of more than UNIT_ROWS rows is an error.

Defined cases: null or NaN quantities come out with null base quantity; code 99, unknown names, units
that the table does not have and rows without any unit have no unit; a text with units of packing only
has none; empty and very long texts are read whole; repeated rows come out as often as they came in;
other columns are never read; an empty conversion table knows no unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.units import Names

#: Most rows that the conversion table may have: its names are held by every task.
UNIT_ROWS = 10_000
#: Fields that a task remembers.
KNOWN = 100_000


def _encoded(c: pa.Array) -> tuple[np.ndarray, list]:
    """(place of each value, different values); null: -1."""
    d = c.dictionary_encode()
    return d.indices.fill_null(-1).to_numpy(zero_copy_only=False), d.dictionary.to_pylist()


def _find(rows: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(rows)
        codes = [None, *sorted(names.codes)]
        place = {c: i for i, c in enumerate(codes)}
        fields: dict[str, tuple[int, bool]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            at, words = _encoded(b.column("word"))
            by_word, closed = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, bool)
            for i, w in enumerate(words):
                if w not in fields:
                    if len(fields) > KNOWN:
                        fields.clear()
                    fields[w] = (place[names.of_field(w)], w.strip() in names.codes)
                by_word[i], closed[i] = fields[w]
            code, closed = by_word[at], closed[at]
            how = np.where(closed, 1, np.where(code > 0, 2, 0))
            ask = np.flatnonzero((code == 0) & ~closed)
            if len(ask):
                at, texts = _encoded(b.column("text").take(pa.array(ask)))
                found = [names.of_text(t) for t in texts] + [(None, None, None)]
                first, other = (np.array([place[f[k]] for f in found]) for k in (0, 2))
                value = np.array([np.nan if f[1] is None else f[1] for f in found])
                qty = b.column("qty").take(pa.array(ask)).to_numpy(zero_copy_only=False)
                code[ask] = np.where(qty == value[at], other[at], first[at])
                how[ask] = np.where(code[ask] > 0, 3, 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("qty"), pa.array(codes, pa.string()).take(pa.array(code)), pa.array([None, "code", "word", "text"], pa.string()).take(pa.array(how))], names=["id", "qty", "code", "stated_by"]
            )

    return run


def convert_units(df: DataFrame, conversion: DataFrame, id_col: str = "id", qty: str = "qty", unit: str = "qtyUnitCode", text: str = "qtyText") -> DataFrame:
    """(id, qty, code, dimension, qty_base, factor, stated_by) of every row; code is null where no unit is known.
    stated_by: code, word or text."""
    blank = r"^\s+|\s+$"
    table = conversion.select(F.regexp_replace("code", blank, "").alias("code"), "abbr", "dimension", F.col("factor_to_base").cast("double").alias("factor"), "notes").filter("code is not null")
    rows = [tuple(r) for r in table.limit(UNIT_ROWS + 1).collect()]
    if len(rows) > UNIT_ROWS:
        raise ValueError(f"the conversion table has more than {UNIT_ROWS} rows")
    asked = df.select(F.col(id_col).alias("id"), F.col(qty).cast("double").alias("qty"), F.col(unit).cast("string").alias("word"), F.when(F.col(text) != "", F.col(text)).alias("text"))
    named = asked.mapInArrow(_find(rows), f"id {asked.schema['id'].dataType.simpleString()}, qty double, code string, stated_by string")
    known = F.broadcast(table.filter("dimension is not null and factor is not null").dropDuplicates(["code"]).select("code", "dimension", "factor"))
    joined = named.join(known, "code", "left")
    value = F.when(~F.isnan("qty"), F.col("qty") * F.col("factor"))
    has = F.col("factor").isNotNull()
    return joined.select("id", "qty", F.when(has, F.col("code")).alias("code"), "dimension", value.alias("qty_base"), "factor", F.when(has, F.col("stated_by")).alias("stated_by"))


def converted_units(df: DataFrame, conversion: DataFrame) -> DataFrame:
    """(id, code) of the rows whose quantity is not recorded in a base unit."""
    return convert_units(df, conversion).filter(F.col("qty").isNotNull() & F.col("code").isNotNull() & (F.col("factor") != 1)).select("id", "code")

"""Rows that fail to parse, apart from the valid rows.

Each record meets the header of its file, is parsed at least cost (see functions.rowgrammar), and
comes out either with typed fields or with the reasons: the edits its cheapest parse needs, or the
values that are impossible. Records that are plain - no quote at all, or every field quoted and no
quote inside - and have as many fields as their header cost nothing and are split in the JVM; all
others go through the programme in Arrow batches.

Headers are one row a file. They are broadcast where their number and size are checked to be small, so
that no record is shuffled; else records meet them by file, and a file of many records is spread over
as many salts as its size asks for.

Defined cases: a null line is an empty record; a file without a line 1 has no columns, so that its
records have the wrong column count; a file with several rows of line 1 uses the lowest raw_id; a
check whose column the file does not have is left out; of columns of one name the last counts; very
long lines are parsed whole (in time that goes with quotes and separators); repeated records come out each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.rowgrammar import repair_many, split
from tallymark.session import materialise, spread

#: Headers that are broadcast: number, and characters in all.
HEAD_ROWS, HEAD_CHARS = 200_000, 20_000_000
#: Records of a file that meet their header in one task, where headers are not broadcast.
FILE_ROWS = 1_000_000
# Codes of flows.
FLOWS = ("X", "M", "RX", "RM", "DX", "DM")
# Columns of the typed rows, by header name in lower case.
TYPED = {
    "typecode": ("typeCode", "string"), "freqcode": ("freqCode", "string"), "refyear": ("refYear", "int"), "reportercode": ("reporterCode", "int"),
    "partnercode": ("partnerCode", "int"), "partner2code": ("partner2Code", "int"), "flowcode": ("flowCode", "string"), "classificationcode": ("classificationCode", "string"),
    "cmdcode": ("cmdCode", "string"), "customscode": ("customsCode", "string"), "motcode": ("motCode", "string"), "qty": ("qty", "double"), "netwgt": ("netWgt", "double"),
    "primaryvalue": ("primaryValue", "double"),
}
#: Stands between the names of a header.
BETWEEN = "\x1f"


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seps, names, many, places = [], [], [], []
        for h in b.column("header").to_pylist():
            sep = "\t" if "\t" in h else ","
            found = [x.strip().lower() for x in split(h, sep) or h.replace('"', "").split(sep)]
            seps.append(sep)
            names.append(BETWEEN.join(found))
            many.append(len(found))
            last = {x: i for i, x in enumerate(found)}
            places.append([last.get(k) for k in TYPED])
        yield pa.RecordBatch.from_arrays([b.column("file_name"), pa.array(seps, pa.string()), pa.array(names, pa.string()), pa.array(many, pa.int32()), pa.array(places, pa.list_(pa.int32()))], names=["file_name", "sep", "names", "columns", "places"])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = b.num_rows
        parts, reason, quotes, delims, edits = [None] * n, [None] * n, [0] * n, [0] * n, [None] * n
        broken: dict[tuple[str, int], list[int]] = {}
        lines, seps, many = (b.column(c).to_pylist() for c in ("line", "sep", "columns"))
        for i, line in enumerate(lines):
            if line is None:  # split before
                continue
            fields = split(line, seps[i])
            if fields is not None and len(fields) == many[i]:
                parts[i] = fields
            else:
                broken.setdefault((seps[i], many[i]), []).append(i)
        for (sep, columns), at in broken.items():
            for i, (q, d, e) in zip(at, repair_many([lines[i] for i in at], sep, columns)):
                reason[i], quotes[i], delims[i], edits[i] = "quoting" if q else "column_count", q, d, e
        text = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in ("raw_id", "file_name", "line_no", "names", "places", "plain")], pa.array(parts, text), pa.array(reason, pa.string()), pa.array(quotes, pa.int32()), pa.array(delims, pa.int32()), pa.array(edits, text)],
            names=["raw_id", "file_name", "line_no", "names", "places", "plain", "parts", "broken", "quote_edits", "delimiter_edits", "edits"],
        )


PARSED = "raw_id bigint, file_name string, line_no int, names string, places array<int>, plain array<string>, parts array<string>, broken string, quote_edits int, delimiter_edits int, edits array<string>"


def _value(name: str) -> Column:
    """The field of a header name; null where the file has no such column."""
    return F.get("parts", F.get("places", list(TYPED).index(name)))


def value_reasons(cmd: Column, year: Column, flow: Column) -> Column:
    """Array of the reasons of impossible values; null values are not checked."""
    outer = lambda pattern: rf"(?U)^\s*(?:{pattern})\s*\z"
    good_cmd = cmd.rlike(outer("(?=[0-9]*[1-9])[0-9]{1,6}|TOTAL"))
    good_year = year.rlike(outer("19(?:6[2-9]|[7-9][0-9])|20(?:[0-2][0-9]|30)"))
    good_flow = flow.rlike(outer("|".join("".join(f"[{c}{c.lower()}]" for c in f) for f in FLOWS)))
    found = F.array(*[F.when(~good, F.lit(name)) for good, name in ((good_cmd, "invalid_cmdCode"), (good_year, "invalid_refYear"), (good_flow, "invalid_flowCode"))])
    return F.filter(found, lambda x: x.isNotNull())


def _with_headers(lines: DataFrame) -> DataFrame:
    heads = lines.filter(F.col("line_no") == 1).groupBy("file_name").agg(F.min_by("line", "raw_id").alias("header"))
    heads = materialise(heads.mapInArrow(_headers, "file_name string, sep string, names string, columns int, places array<int>"))
    records = lines.filter(~F.col("line_no").eqNullSafe(F.lit(1)))
    many, chars = heads.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("names")), F.lit(0))).first()
    if many <= HEAD_ROWS and chars <= HEAD_CHARS:
        return records.join(F.broadcast(heads), "file_name", "left")
    sizes = records.groupBy("file_name").agg(F.ceil(F.count(F.lit(1)) / FILE_ROWS).cast("int").alias("salts"))
    large = materialise(sizes.filter("salts > 1"))  # at most a row for every FILE_ROWS records
    salted = records.join(large, "file_name", "left").withColumn("salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("raw_id"), F.col("salts")).cast("int")).otherwise(0)).drop("salts")
    copies = heads.join(large, "file_name", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return salted.join(copies, ["file_name", "salt"], "left").drop("salt")


def parse_rows(raw: DataFrame) -> DataFrame:
    """(raw_id, file_name, line_no, names, places, parts, reasons, quote_edits, delimiter_edits, edits) of every record:
    reasons is empty for valid rows, whose fields are parts; edits are those of the cheapest parse of the others."""
    lines = spread(raw.select("raw_id", "file_name", F.col("line_no").cast("int").alias("line_no"), F.coalesce("line", F.lit("")).alias("line")))
    met = _with_headers(lines).withColumns({"sep": F.coalesce("sep", F.lit(",")), "columns": F.coalesce("columns", F.lit(0))})
    line, sep = F.col("line"), F.col("sep")
    bare, inner = F.split(line, sep, -1), F.split(F.substring(line, F.lit(2), F.length(line) - 2), F.concat(F.lit('"'), sep, F.lit('"')), -1)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    quoted = line.startswith('"') & line.endswith('"') & (F.length(line) >= 2) & (quotes == 2 * F.size(inner))
    fields = F.when(quotes == 0, bare).when(quoted, inner)
    plain = met.withColumn("plain", F.when(F.size(fields) == F.col("columns"), fields))
    asked = plain.select("raw_id", "file_name", "line_no", "names", "places", "plain", "sep", "columns", F.when(F.col("plain").isNull(), line).alias("line"))
    parsed = asked.mapInArrow(_parse, PARSED).withColumn("parts", F.coalesce("plain", "parts"))
    reasons = F.when(F.col("broken").isNotNull(), F.array("broken")).otherwise(value_reasons(_value("cmdcode"), _value("refyear"), _value("flowcode")))
    return parsed.select("raw_id", "file_name", "line_no", "names", "places", "parts", reasons.alias("reasons"), "quote_edits", "delimiter_edits", "edits")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """(raw_id, reason)."""
    return parsed.select("raw_id", F.explode("reasons").alias("reason"))


def repairs(parsed: DataFrame) -> DataFrame:
    """(raw_id, quote_edits, delimiter_edits, edits) of the records that are not in the grammar or have too few or many fields."""
    return parsed.filter("edits is not null").select("raw_id", "quote_edits", "delimiter_edits", "edits")


def typed_rows(parsed: DataFrame) -> DataFrame:
    """The valid rows with typed columns; an unreadable number of a column that is not checked is null.
    other: the fields of the file's remaining columns by header name in lower case, as they stand."""
    blank = lambda k: F.nullif(F.trim(_value(k)), F.lit(""))
    typed = [(F.upper(blank(k)) if name == "flowCode" else blank(k).try_cast(kind)).alias(name) for k, (name, kind) in TYPED.items()]
    entries = F.filter(F.arrays_zip(F.split("names", BETWEEN).alias("name"), F.col("parts").alias("value")), lambda e: ~e["name"].isin(*TYPED))
    other = F.aggregate(entries, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["name"]), F.create_map(e["name"], e["value"])))
    return parsed.filter(F.size("reasons") == 0).select("raw_id", "file_name", "line_no", *typed, other.alias("other"))

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.functions.rowgrammar import reason_of, repair, repair_many, split
from tallymark.operators import rowparse
from tallymark.operators.rowparse import parse_rows, rejected_rows, repairs, typed_rows


@pytest.mark.parametrize(
    "line,sep,columns,reason",
    [
        ("a,b,c", ",", 3, None), ('"a,b",c', ",", 2, None), ('"a""b",c', ",", 2, None), ("a,b", ",", 3, "column_count"), ("", ",", 1, None), ("", ",", 2, "column_count"),
        ('"a,b', ",", 2, "quoting"), ('a"b,c', ",", 2, "quoting"), ('"a"b,c', ",", 2, "quoting"), ('"a" "b"\tc', "\t", 2, "quoting"), ('"a\nb",c', ",", 2, None), ('""', ",", 1, None), ('"""', ",", 1, "quoting"),
        ('X"\tb', "\t", 2, "quoting"), (' "a",b', ",", 2, "quoting"),
    ],
)
def test_reasons(line, sep, columns, reason):
    assert reason_of(line, sep, columns) == reason
    fields = split(line, sep)
    assert (fields is not None and len(fields) == columns) == (reason is None)


@settings(max_examples=300, deadline=None)
@given(st.text('a",\n', max_size=9), st.integers(1, 4))
def test_dynamic_programme_agrees_with_the_grammar(line, columns):
    fields = split(line, ",")
    quotes, delimiters = repair(line, ",", columns)
    assert (quotes == 0) == (fields is not None)
    if fields is not None:
        assert delimiters == abs(len(fields) - columns)


def edits(line):
    for i in range(len(line) + 1):
        yield line[:i] + '"' + line[i:]
    for i, c in enumerate(line):
        if c == '"':
            yield line[:i] + line[i + 1 :]


@settings(max_examples=60, deadline=None)
@given(st.text('a",', max_size=6))
def test_cost_is_the_least_number_of_quote_edits(line):
    """Breadth-first search over all strings that quote edits reach."""
    seen, front = {line}, {line}
    for n in itertools.count():
        if any(split(x, ",") is not None for x in front):
            break
        front = {y for x in front for y in edits(x)} - seen
        seen |= front
    assert repair(line, ",", 1)[0] == n


RAW = "raw_id bigint, file_name string, line_no int, line string, header string, salt int"


def test_operator(spark):
    h = 'cmdCode,"refYear",FLOWCODE,netWgt'
    rows = [
        (1, "f", 1, h), (2, "f", 2, "010110,2020,x,1.5"), (3, "f", 3, "0,2020,x,1"), (4, "f", 4, "1234567,1961,XX,"), (5, "f", 5, "TOTAL,2030, m ,abc"), (6, "f", 6, "１,2020,X,1"),
        (7, "f", 7, None), (8, "g", 2, "a,b"), (9, "t", 1, "refYear\tother"), (10, "t", 2, "2020\t\"a\tb\""), (11, "t", 3, "20x0\tz"), (12, "f", 8, '010110,2020,X,"' + "q" * 50_000), (3, "f", 3, "0,2020,x,1"),
    ]
    parsed = parse_rows(spark.createDataFrame([(*r, "clash", 5) for r in rows], RAW))
    got = sorted((r.raw_id, r.reason) for r in rejected_rows(parsed).collect())
    assert got == [(3, "invalid_cmdCode"), (3, "invalid_cmdCode"), (4, "invalid_cmdCode"), (4, "invalid_flowCode"), (4, "invalid_refYear"), (6, "invalid_cmdCode"), (7, "column_count"), (8, "column_count"), (11, "invalid_refYear"), (12, "quoting")]
    good = {r.raw_id: r for r in typed_rows(parsed).collect()}
    assert set(good) == {2, 5, 10}
    assert (good[2].cmdCode, good[2].refYear, good[2].flowCode, good[2].netWgt) == ("010110", 2020, "X", 1.5)
    assert good[5].netWgt is None and good[5].flowCode == "M" and good[10].cmdCode is None


def test_empty(spark):
    parsed = parse_rows(spark.createDataFrame([], RAW))
    assert rejected_rows(parsed).count() == 0 and typed_rows(parsed).count() == 0


def test_very_long_broken_record_takes_linear_time():
    assert reason_of('a,"b' + ",c" * 200_000, ",", 3) == "quoting"
    assert reason_of("a,b" * 50_000, ",", 3) == "column_count"


def test_columns_without_a_type_are_kept(spark):
    lines = ["cmdCode,Remark,refYear,note 2", '10110,"late, again",2020,', "10110,,2021, x "]
    raw = spark.createDataFrame([(i, "f", i, line) for i, line in enumerate(lines, 1)], "raw_id bigint, file_name string, line_no int, line string")
    got = {r.raw_id: (r.refYear, r.other) for r in typed_rows(parse_rows(raw)).collect()}
    assert got == {2: (2020, {"remark": "late, again", "note 2": ""}), 3: (2021, {"remark": "", "note 2": " x "})}


def applied(line, sep, edits):
    """The record after its quote edits and inserted delimiters; deleted delimiters are left out of the count."""
    shift, gone = 0, 0
    for e in edits:
        what, at = e.rsplit(" at ", 1)
        at = int(at) + shift
        if what == "delete delimiter":
            gone += 1
        elif what.startswith("insert"):
            line, shift = line[:at] + ('"' if what == "insert quote" else sep) + line[at:], shift + 1
        else:
            line, shift = line[:at] + line[at + 1 :], shift - 1
    return line, gone


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text('ab",\n', max_size=9), min_size=1, max_size=5), st.integers(1, 4))
def test_edits_give_a_record_of_the_grammar(lines, columns):
    got = repair_many(lines, ",", columns)
    for line, (quotes, delimiters, edits) in zip(lines, got):
        assert len(edits) == quotes + delimiters and (quotes, delimiters) == repair(line, ",", columns)
        fixed, gone = applied(line, ",", edits)
        fields = split(fixed, ",")
        assert fields is not None and len(fields) - gone == columns


def test_counts_do_not_saturate():
    assert repair(",".join("x" * 201), ",", 3) == (0, 198)
    assert repair("x", ",", 300) == (0, 299)
    assert repair_many(["a,b", ""], ",", 0) == [(0, 2, ["delete delimiter at 1", "delete field at 0"]), (0, 1, ["delete field at 0"])]


def test_edits_are_the_reason(spark):
    rows = [(1, "f", 1, "a,b"), (2, "f", 2, '"x,y'), (3, "f", 3, "x,y,z"), (4, "f", 4, "x"), (5, "f", 5, 'x,"y"')]
    raw = spark.createDataFrame(rows, "raw_id bigint, file_name string, line_no int, line string")
    got = {r.raw_id: (r.quote_edits, r.delimiter_edits, r.edits) for r in repairs(parse_rows(raw)).collect()}
    assert got == {2: (1, 0, ["delete quote at 0"]), 3: (0, 1, got[3][2]), 4: (0, 1, ["insert delimiter at 1"])} and got[3][2][0].startswith("delete delimiter")


def test_headers_that_are_not_broadcast_give_the_same(spark, monkeypatch):
    rows = [(f * 100 + i, f"f{f}", i, "refYear,flowCode" if i == 1 else f"20{i:02},X" if i % 3 else "2020,Q,1") for f in range(4) for i in range(1, 30 * (f == 0) + 5)]
    raw = spark.createDataFrame([*rows, (9000, "none", 2, "a,b")], "raw_id bigint, file_name string, line_no int, line string")
    every = lambda: (sorted(map(str, rejected_rows(parse_rows(raw)).collect())), sorted(map(str, typed_rows(parse_rows(raw)).collect())))
    want = every()
    monkeypatch.setattr(rowparse, "HEAD_ROWS", 0)
    monkeypatch.setattr(rowparse, "FILE_ROWS", 7)
    assert every() == want

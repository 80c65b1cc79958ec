"""Delimited records: the strict grammar, and the cheapest edits that bring a record into it.

Grammar: a field is either quoted - a double quote, any text with quotes doubled, a double quote
right before the separator or the end - or plain text without any quote.

`repair_many` is a dynamic programme over the signs of records, many at a time. It keeps, inserts or
deletes quotes and delimiters until a record has as many fields as its header. A quote edit costs more
than all delimiter edits together, so the cheapest parse has quote edits exactly if the quoting is
broken, and else only as many delimiter edits as the field count is off. Where a delimiter is deleted, the field after it goes with the
one before, in a quoting of its own. A parse of cost zero is the
record itself; of any other, the edits are given in order.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np


@lru_cache(maxsize=8)
def _field(sep: str) -> re.Pattern:
    s = re.escape(sep)
    return re.compile(rf'(?:"((?:[^"]|"")*+)"|([^"{s}]*+))({s}|\Z)', re.S)


def split(line: str, sep: str) -> list[str] | None:
    """Fields of a record that is in the grammar, else None."""
    if '"' not in line:
        return line.split(sep)
    out, at, pattern = [], 0, _field(sep)
    while m := pattern.match(line, at):
        out.append(m[1].replace('""', '"') if m[1] is not None else m[2])
        at = m.end()
        if not m[3]:
            return out
    return None


#: States: at a field's start, in plain text, in quoted text, after a quote in quoted text.
START, PLAIN, QUOTED, AFTER = range(4)
#: Signs: quote, delimiter, a run of anything else, nothing (beyond the end of a shorter record).
QUOTE, DELIMITER, TEXT, NOTHING = range(4)
#: Costs. A quote edit outweighs the delimiter edits of any record below 2^40 signs.
EDIT, BIG = 1 << 40, 1 << 60
#: Edits of a step, in the order they are made; the place of the sign is added.
OPS = (None, "insert quote", "delete quote", "delete delimiter")
# (sign, from, to, further delimiter, cost, edit)
_MOVES = [
    (QUOTE, START, QUOTED, 0, 0, 0), (QUOTE, AFTER, QUOTED, 0, 0, 0), (QUOTE, QUOTED, AFTER, 0, 0, 0),
    (QUOTE, QUOTED, QUOTED, 0, EDIT, 1), (QUOTE, START, AFTER, 0, EDIT, 1),
    *[(QUOTE, s, s, 0, EDIT, 2) for s in (START, PLAIN, QUOTED, AFTER)],
    *[(DELIMITER, s, START, 1, 0, 0) for s in (START, PLAIN, AFTER)], (DELIMITER, QUOTED, QUOTED, 0, 0, 0),
    (DELIMITER, QUOTED, START, 1, EDIT, 1), (DELIMITER, START, QUOTED, 0, EDIT, 1), (DELIMITER, AFTER, QUOTED, 0, EDIT, 1),
    *[(DELIMITER, s, START, 0, 1, 3) for s in (START, PLAIN, AFTER)],
    (TEXT, START, PLAIN, 0, 0, 0), (TEXT, PLAIN, PLAIN, 0, 0, 0), (TEXT, QUOTED, QUOTED, 0, 0, 0), (TEXT, START, QUOTED, 0, EDIT, 1), (TEXT, AFTER, QUOTED, 0, EDIT, 1),
    *[(NOTHING, s, s, 0, 0, 0) for s in (START, PLAIN, QUOTED, AFTER)],
]
#: Cells of a table of back pointers that are held at a time.
CELLS = 1 << 26


def _signs(line: str, sep: str) -> tuple[np.ndarray, np.ndarray]:
    """(signs, their places): a run of ordinary characters is one sign, which changes no state twice."""
    kind, place = [], []
    for m in re.finditer(rf'"|{re.escape(sep)}|[^"{re.escape(sep)}]+', line):
        kind.append(QUOTE if m[0] == '"' else DELIMITER if m[0] == sep else TEXT)
        place.append(m.start())
    return np.array(kind, np.int8), np.array(place, np.int64)


def _programme(signs: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(cost of each record, move of each record and step or -1) for signs as records x steps."""
    many, steps = signs.shape
    cost = np.full((many, 4, columns), BIG, np.int64)
    cost[:, START, 0] = 0
    back = np.empty((steps, many, 4, columns), np.int8)
    moves = [[(i, *m[1:5]) for i, m in enumerate(_MOVES) if m[0] == k] for k in range(4)]
    for t in range(steps):
        new, how = np.full_like(cost, BIG), np.full(cost.shape, -1, np.int8)
        for k in range(4):
            rows = np.flatnonzero(signs[:, t] == k)
            if not len(rows):
                continue
            old, out, by = cost[rows], np.full((len(rows), 4, columns), BIG, np.int64), np.full((len(rows), 4, columns), -1, np.int8)
            for i, s, to, more, price in moves[k]:
                c = old[:, s] + price
                if more:
                    c = np.concatenate([np.full((len(rows), 1), BIG), c[:, :-1]], axis=1)
                better = c < out[:, to]
                out[:, to][better] = c[better]
                by[:, to][better] = i
            new[rows], how[rows] = out, by
        cost, back[t] = np.minimum(new, BIG), how
    # at the end: a closing quote, and the delimiters that are still wanted
    end = cost + np.array([0, 0, EDIT, 0])[None, :, None] + np.arange(columns - 1, -1, -1)[None, None, :]
    flat = end.reshape(many, -1)
    last = flat.argmin(1)
    best = flat[np.arange(many), last]
    path = np.full((many, steps + 2), -1, np.int64)
    state, n = last // columns, last % columns
    path[:, steps], path[:, steps + 1] = state, n
    source = np.array([m[1] for m in _MOVES])
    further = np.array([m[3] for m in _MOVES])
    r = np.arange(many)
    for t in range(steps - 1, -1, -1):
        move = back[t, r, state, n]
        path[:, t] = move
        state, n = source[move], n - further[move]
    return best, path


def repair_many(lines: list[str], sep: str, columns: int) -> list[tuple[int, int, list[str]]]:
    """(quote edits, delimiter edits, edits) of a cheapest parse of each record into `columns` fields. Time goes with
    signs times columns. No columns: every delimiter is deleted, and one more edit is counted for the field itself."""
    wide = max(columns, 1)
    read = [_signs(x, sep) for x in lines]
    order = sorted(range(len(lines)), key=lambda i: len(read[i][0]))
    out: list = [None] * len(lines)
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * (len(read[order[stop]][0]) + 1) * 4 * wide <= CELLS and len(read[order[stop]][0]) <= 2 * len(read[order[start]][0]) + 16:
            stop += 1
        part = order[start:stop]
        steps = len(read[part[-1]][0])
        signs = np.full((len(part), steps), NOTHING, np.int8)
        for r, i in enumerate(part):
            signs[r, : len(read[i][0])] = read[i][0]
        best, path = _programme(signs, wide)
        for r, i in enumerate(part):
            place = read[i][1]
            edits = [f"{op} at {place[t]}" for t, m in enumerate(path[r, : len(place)].tolist()) if (op := OPS[_MOVES[m][5]])]
            if path[r, steps] == QUOTED:
                edits.append(f"insert quote at {len(lines[i])}")
            edits += [f"insert delimiter at {len(lines[i])}"] * (wide - 1 - int(path[r, steps + 1])) + (["delete field at 0"] if columns < 1 else [])
            out[i] = int(best[r] // EDIT), int(best[r] % EDIT) + (columns < 1), edits
        start = stop
    return out


def repair(line: str, sep: str, columns: int) -> tuple[int, int]:
    """(quote edits, delimiter edits) of a cheapest parse into `columns` fields."""
    return repair_many([line], sep, columns)[0][:2]


def reason_of(line: str, sep: str, columns: int) -> str | None:
    """None for a record in the grammar with as many fields as there are columns, else the kind of
    edits that its cheapest parse needs."""
    quotes, delimiters = repair(line, sep, columns)
    return "quoting" if quotes else "column_count" if delimiters else None

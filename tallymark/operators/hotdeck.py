"""Filling missing values from similar records: a blocked nearest-neighbour hot-deck.

1. Records are hash-blocked on observed features (by default good and flow). A block of up to
   `block_rows` records is searched in one task.
2. Inside a block, the `neighbours` closest donors by the mixed (Gower) distance over the features
   observed on both records are kept. The k donors on each side in several orders (reporter-year-value,
   value, gross weight, reporter-gross weight) give a first bound; then every donor is looked at that
   is not farther than the bound by one feature alone - the one by which donors differ most - so the
   search is exact. Donors of the same reporter and year go first, which leaves few of the others.
3. The donors of a larger block are cut into shards of about `block_rows`, once for each kind of record
   that asks (gross weight, value, both or neither observed), in an order that such records have too:
   gross weight, or value; donors that differ by reporter and year only are reduced to the first ids.
   Each shard is described by a box (range of every feature, reporters). A missing value first meets the
   shard in whose order it stands; the distance of the last donor kept there is a bound, and it then
   meets exactly the shards whose boxes are not farther, and in them the donors that are not farther. So
   a search sees all donors that matter, and few shards, whatever the size of the block.
4. A numeric field gets the weighted median of the donors' values - always the value of one of
   them, whose id is given; a categorical field gets the weighted majority.
5. A record whose block has no donor gets the median or majority of its chapter and flow, else of
   the whole table (`level` says which; those levels have no single donor).

All sizes are fixed numbers, none depends on the size of the table. Memory of a task is bounded by one
shard's donors and a batch of records to fill, which are streamed; records that ask one shard are split
into salts of `ASKED`. The table of large blocks is broadcast under a checked size.

Defined cases: every missing value comes out, with null as the fill if no row of the table has a
value; null features are left out of the distance; ties go to the lower donor id; repeated rows are
donors each; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.quantiles import exact_quantiles
from tallymark.session import materialise

TRUE_WORDS = ("1", "true", "yes", "t", "y")
FALSE_WORDS = ("0", "false", "no", "f", "n")
#: Pairs of records compared at a time.
PAIRS = 1_000_000
#: Groups of records stand this far apart on the axis of a search; REACH spans a group (logarithms) and no further.
SPACING, REACH = 2048.0, 900.0
#: Added to bounds, far above the rounding of such sums: only exact distances decide.
SLACK = 1e-4
#: Records that ask one shard in one task.
ASKED = 200_000
#: Large blocks up to which their table is broadcast (two numbers each).
LARGE_BLOCKS = 500_000
#: Bins of the order of donors per unit of its axis.
AXIS_BINS = 1024
#: Kinds of donors in large blocks; of those from NEITHER on no weight or value is compared.
WEIGHED, VALUED, BOTH, NEITHER, UNWEIGHED, UNVALUED, ALL = range(7)
#: Features of this many values at most are met value by value.
STEPS = 64
RESULT = "id bigint, grp int, field tinyint, fill double, donor_id bigint, distance double"


def positive_number(c: Column) -> Column:
    """The value if it is a finite number above zero, else null."""
    return F.when((c > 0) & ~F.isnan(c) & (c < float("inf")), c)


def flag_value(c: Column) -> Column:
    """1.0, 0.0 or null by the spelling of the flag, case and outer blanks aside."""
    t = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(t.isin(*TRUE_WORDS), 1.0).when(t.isin(*FALSE_WORDS), 0.0)


def _nearest(order: np.ndarray, donor: np.ndarray, want: np.ndarray, k: int) -> np.ndarray:
    """Candidates (rows of want x 2k): the k donors before and after each wanted row in `order`; -1: none."""
    n = len(order)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    in_order = donor[order]
    donors = order[in_order]
    if not len(donors):
        return np.full((len(want), 2 * k), -1, np.int64)
    before = np.cumsum(in_order)[rank[want]]
    at = before[:, None] + np.arange(-k, k)[None, :]
    ok = (at >= 0) & (at < len(donors))
    return np.where(ok, donors[np.clip(at, 0, len(donors) - 1)], -1)


def _distance(features, r: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Mixed distance of the rows r from the rows d, over the features observed on both."""
    total = weight = 0.0
    for kind, column, w in features:
        a, b = column[r], column[d]
        if kind == "same":
            total = total + w * (a != b)
            weight = weight + w
        else:
            x = np.abs(a - b)
            seen = ~np.isnan(x)
            total = total + w * np.minimum(np.where(seen, x, 0.0), 1.0)
            weight = weight + w * seen
    return total / np.maximum(weight, 1e-12)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Number of the run of equal values (nulls are equal) that each row of sorted columns is in."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= (c[1:] != c[:-1]) & ~((c[1:] != c[1:]) & (c[:-1] != c[:-1]))
    return np.cumsum(new)


def _merge(near: np.ndarray, dist: np.ndarray, ids: np.ndarray, r: np.ndarray, d: np.ndarray, x: np.ndarray) -> None:
    """Take the donors d at distances x into the lists of the recipients r: by distance, then id, each donor once."""
    rows = np.unique(r)
    held = near[rows]
    at, col = np.nonzero(held >= 0)
    r, d, x = np.r_[rows[at], r], np.r_[held[at, col], d], np.r_[dist[rows][at, col], x]
    by = np.lexsort((d, ids[d], x, r))
    r, d, x = r[by], d[by], x[by]
    once = np.r_[True, (r[1:] != r[:-1]) | (d[1:] != d[:-1])]
    r, d, x = r[once], d[once], x[once]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    top = place < near.shape[1]
    near[r[top], place[top]], dist[r[top], place[top]] = d[top], x[top]


def _search(group, features, ids, donors, want, near, dist, apart: float, stepped=None) -> None:
    """Take into near and dist every donor of the same group that belongs there.

    Donors and recipients meet by what is observed on them, so that the weights of a meeting are
    known. Donors stand in order of the feature by which they differ most; only those are looked at whose
    distance by it alone, with `apart` as the weight that is lost anyway, is below the last kept.
    stepped: (near feature that makes no order, weight lost by it where it is observed on both)."""
    near_by = [(c, w) for kind, c, w in features if kind == "near"]
    same_by = [(c, w) for kind, c, w in features if kind == "same"]
    names = np.unique(group[np.r_[donors, want]])
    mask = sum((~np.isnan(c)).astype(np.int64) << j for j, (c, _) in enumerate(near_by)) + np.zeros(len(ids), np.int64)
    for dp in np.unique(mask[donors]):
        for rp in np.unique(mask[want]):
            at_both = [j for j in range(len(near_by)) if (dp & rp) >> j & 1]
            seen = [near_by[j] for j in at_both]
            r = np.flatnonzero(mask[want] == rp)
            weight = sum(w for _, w in same_by) + sum(w for _, w in seen)
            by_step = stepped and at_both == [stepped[0]]  # its distance is then that of the order
            lost = apart + (stepped[1] if stepped and stepped[0] in at_both and not by_step else 0.0)
            left = dist[r, -1] * max(weight, 1e-12) - lost + SLACK
            r, left = r[left >= 0], left[left >= 0]
            if not len(r):
                continue
            d = donors[mask[donors] == dp]
            spread = lambda j: near_by[j][1] * np.subtract(*np.quantile(near_by[j][0][d], (0.95, 0.05)))  # noqa: E731, B023
            best = max((j for j in at_both if not stepped or j != stepped[0]), key=spread, default=at_both[0] if at_both else None)
            axis, w = near_by[best] if seen else (np.zeros(len(ids)), 0.0)
            d = d[np.lexsort((ids[d], *[c[d] for c, _ in seen], *[c[d] for c, _ in same_by], axis[d], group[d]))]
            # of donors that are alike in all that counts here, only the first ids can be kept
            run = _runs(group[d], axis[d], *[c[d] for c, _ in same_by], *[c[d] for c, _ in seen])
            d = d[np.arange(len(d)) - np.searchsorted(run, run) < near.shape[1]]
            half = np.where(left < w, left / max(w, 1e-12), REACH)  # a feature counts 1 at most: from w on it tells nothing
            key = np.searchsorted(names, group[d]) * SPACING + axis[d]
            at = np.searchsorted(names, group[want[r]]) * SPACING + axis[want[r]]
            lo, hi = np.searchsorted(key, at - half - SLACK), np.searchsorted(key, at + half + SLACK, side="right")
            ends = np.cumsum(hi - lo)
            start = 0
            while start < len(r):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, side="right")))
                n = (hi - lo)[start:stop]
                which = np.repeat(np.arange(start, stop), n)
                pick = d[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]]
                to = r[which]
                x = _distance(features, want[to], pick)
                good = x <= dist[to, -1]
                if good.any():
                    _merge(near, dist, ids, to[good], pick[good], x[good])
                start = stop


def _stepped(features):
    """(which near feature, weight that two different values of it lose at least) of one of few values, or None."""
    near_by = [(c, w) for kind, c, w in features if kind == "near"]
    for j, (c, w) in enumerate(near_by):
        values = np.unique(c[~np.isnan(c)])
        if len(values) <= STEPS:
            return j, w * min(float(np.diff(values).min(initial=1.0)), 1.0)
    return None


def _neighbours(block, ids, features, orders, donor, want, k, neighbours, bound=None):
    """The closest donors of the same block of each wanted row, all donors considered: (rows or -1, distances).
    bound: distances beyond which no donor is asked for; places without a donor have them."""
    near = np.full((len(want), neighbours), -1, np.int64)
    dist = np.full((len(want), neighbours), np.inf) if bound is None else np.repeat(bound[:, None], neighbours, axis=1)
    donors = np.flatnonzero(donor)
    if not len(donors) or not len(want):
        return near, dist
    for o in orders:  # a first bound
        cand = _nearest(o, donor, want, k)
        at, col = np.nonzero((cand >= 0) & (block[cand] == block[want][:, None]))
        if len(at):
            x = _distance(features, want[at], cand[at, col])
            at, col, x = (c[x <= dist[at, -1]] for c in (at, col, x))
            if len(at):
                _merge(near, dist, ids, at, cand[at, col], x)
    same = next(((c, w) for kind, c, w in features if kind == "same"), None)
    stepped = _stepped(features)
    step = next(c for j, c in enumerate(c for kind, c, _ in features if kind == "near") if j == stepped[0]) if stepped else None

    def groups(*columns):
        by = np.lexsort((*columns[::-1], block))
        out = np.empty(len(block), np.int64)
        out[by] = _runs(block[by], *(c[by] for c in columns))
        return out

    # first those that are alike, which leaves little to be looked at among the others
    for lost, alike in ((0.0, [same[0]] if same else None), (same[1] if same else 0.0, [])):
        if alike is not None:
            if stepped:
                _search(groups(*alike, step), features, ids, donors, want, near, dist, lost, (stepped[0], 0.0))
            _search(groups(*alike), features, ids, donors, want, near, dist, lost, stepped)
    return near, dist


def _fill(block, ids, features, orders, value, categorical, k, neighbours):
    """Rows of one set of whole blocks: (index of recipient, fill, donor id, distance)."""
    donor = ~np.isnan(value)
    want = np.flatnonzero(~donor)
    if not len(want):
        return want, np.empty(0), np.empty(0, np.int64), np.empty(0)
    cand, dist = _neighbours(block, ids, features, orders, donor, want, k, neighbours)
    return want, *_choose(np.where(cand >= 0, value[cand], np.inf), np.where(cand >= 0, ids[cand], -1), dist, categorical)


def _choose(v: np.ndarray, cid: np.ndarray, dist: np.ndarray, categorical: bool):
    """(fill, donor id, distance) from the values, ids and distances of each row's donors, closest first."""
    usable = np.isfinite(dist)
    w = np.where(usable, 1.0 / (np.where(usable, dist, 0) + 0.02), 0.0)
    if categorical:
        yes = (w * (v == 1.0)).sum(1)
        no = (w * (v == 0.0)).sum(1)
        fill = np.where(yes == no, v[:, 0], (yes > no).astype(float))
        pick = np.argmax(v == fill[:, None], axis=1)
    else:
        by = np.argsort(v, axis=1, kind="stable")
        cum = np.cumsum(np.take_along_axis(w, by, 1), axis=1)
        at = np.argmax(cum >= cum[:, -1:] / 2, axis=1)
        pick = np.take_along_axis(by, at[:, None], 1)[:, 0]
        fill = v[np.arange(len(v)), pick]
    r = np.arange(len(v))
    any_donor = usable[:, 0]
    return np.where(any_donor, fill, np.nan), np.where(any_donor, cid[r, pick], -1), np.where(any_donor, dist[r, pick], np.nan)


def _measure(block, ids, reporter, year, logv, logg, ordered=True):
    """Orders of records in which neighbours are likely, if they are asked for, and the features of the distance."""
    lv, lg, ly = (np.nan_to_num(x, nan=-99.0) for x in (logv, logg, year))
    orders = [np.lexsort(o) for o in ((ids, lv, ly, reporter, block), (ids, lg, lv, block), (ids, lv, lg, block), (ids, lv, lg, reporter, block)) if ordered]
    features = [("same", reporter, 0.5), ("near", year / 10, 0.5), ("near", logv / 3, 2.0), ("near", logg / 3, 4.0)]
    return orders, features


def _kernel(k: int, neighbours: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def column(t: pa.Table, name: str, kind=float) -> np.ndarray:
            c = t.column(name).combine_chunks()
            c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
            if kind is float:
                return c.cast(pa.float64()).to_numpy(zero_copy_only=False)
            return c.fill_null(-1).to_numpy(zero_copy_only=False)

        def solve(t: pa.Table) -> pa.RecordBatch:
            key, ids = column(t, "block", int), column(t, "id", int)
            reporter, year = column(t, "reporter", int), column(t, "year")
            logv, logg = column(t, "logv"), column(t, "logg")
            block = np.cumsum(np.r_[0, np.diff(key) != 0])
            orders, features = _measure(block, ids, reporter, year, logv, logg)
            grp = column(t, "grp", int)
            parts = []
            for f, (name, categorical) in enumerate((("num", False), ("cat", True))):
                at, fill, who, d = _fill(block, ids, features, orders, column(t, name), categorical, k, neighbours)
                parts.append((ids[at], grp[at], np.full(len(at), f, np.int8), fill, who, d))
            i, g, f, v, who, d = (np.concatenate(x) for x in zip(*parts))
            none = np.isnan(v)
            return pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(g.astype(np.int32)), pa.array(f), pa.array(v, mask=none), pa.array(who, mask=none), pa.array(d, mask=none)],
                names=["id", "grp", "field", "fill", "donor_id", "distance"],
            )

        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows < chunk:
                continue
            t = pa.Table.from_batches(held)
            key = column(t, "block", int)
            cut = int(np.flatnonzero(np.diff(key) != 0)[-1]) + 1 if key[0] != key[-1] else 0
            if cut:  # the last block may go on in the next batch
                yield solve(t.slice(0, cut))
                held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


FEATURES = ["id", "reporter", "year", "logv", "logg", "grp", "num", "cat"]
CANDIDATES = "row bigint, id bigint, grp int, copies bigint, field tinyint, cand array<struct<distance:double,donor_id:bigint,value:double>>"


def _shard_kernel(k: int, neighbours: int, block_rows: int):
    """The closest donors in a shard of a large block, within its bound, for each record with a missing value that asks it.

    Rows come in order of good, shard, salt and role: the donors of a shard are held, then records stream past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbers(b: pa.RecordBatch) -> dict[str, np.ndarray]:
            whole = ("id", "reporter", "grp", "row", "copies")
            return {n: b.column(n).fill_null(-1).to_numpy(zero_copy_only=False) if n in whole else b.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in (*FEATURES, "row", "copies", "bound")}

        def solve(held: list[dict], asked: list[dict]) -> pa.RecordBatch:
            r = {n: np.concatenate([a[n] for a in asked]) for n in (*FEATURES, "row", "copies", "bound")}
            c = {n: np.concatenate([*[h[n] for h in held], r[n]]) for n in FEATURES}
            n, given = len(c["id"]), sum(len(h["id"]) for h in held)
            bound = np.where(np.isnan(r["bound"]), np.inf, r["bound"])
            block = np.zeros(n, np.int64)
            orders, features = _measure(block, c["id"], c["reporter"], c["year"], c["logv"], c["logg"], not np.isfinite(bound).all())
            parts = []
            for f, name in enumerate(("num", "cat")):
                known = ~np.isnan(c[name])
                want = np.flatnonzero(~known[given:])
                near, dist = _neighbours(block, c["id"], features, orders, known & (np.arange(n) < given), want + given, k, neighbours, bound[want])
                some = (near[:, 0] >= 0) | np.isinf(bound[want])  # records that come with a bound have an entry
                want, near, dist = want[some], near[some], dist[some]
                ok = near >= 0
                parts.append((want, np.full(len(want), f, np.int8), ok.sum(1), dist[ok], c["id"][near[ok]], c[name][near[ok]]))
            at, field, size, dist, who, value = (np.concatenate(x) for x in zip(*parts))
            entries = pa.StructArray.from_arrays([pa.array(dist), pa.array(who), pa.array(value)], names=["distance", "donor_id", "value"])
            cand = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), entries)
            return pa.RecordBatch.from_arrays(
                [pa.array(r["row"][at]), pa.array(r["id"][at]), pa.array(r["grp"][at].astype(np.int32)), pa.array(r["copies"][at]), pa.array(field), cand],
                names=["row", "id", "grp", "copies", "field", "cand"],
            )

        held: list[dict] = []
        asked: list[dict] = []
        shard = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(n).to_numpy(zero_copy_only=False) for n in ("good", "shard", "salt", "role")]
            new = np.zeros(b.num_rows, bool)
            for x in keys:
                new[1:] |= x[1:] != x[:-1]
            cuts = np.r_[0, np.flatnonzero(new), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if (at := (keys[0][lo], keys[1][lo], keys[2][lo])) != shard:
                    if asked:
                        yield solve(held, asked)
                    held, asked, shard = [], [], at
                part = numbers(b.slice(lo, hi - lo))
                if keys[3][lo] == 0:
                    held.append(part)
                    continue
                asked.append(part)
                if sum(len(a["id"]) for a in asked) >= block_rows:
                    yield solve(held, asked)
                    asked = []
        if asked:
            yield solve(held, asked)

    return run


def _chosen(neighbours: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cand, fields = b.column("cand"), b.column("field").to_numpy(zero_copy_only=False)
            size, flat = pc.fill_null(pc.list_value_length(cand), 0).to_numpy(zero_copy_only=False), cand.flatten()
            at = np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            v, x, who = np.full((len(size), neighbours), np.inf), np.full((len(size), neighbours), np.inf), np.full((len(size), neighbours), -1, np.int64)
            for to, name in ((x, "distance"), (who, "donor_id"), (v, "value")):
                to[at] = pc.struct_field(flat, name).to_numpy(zero_copy_only=False)
            fill, donor, far = np.full(len(size), np.nan), np.full(len(size), -1, np.int64), np.full(len(size), np.nan)
            for f in (0, 1):
                at = np.flatnonzero(fields == f)
                if len(at):
                    fill[at], donor[at], far[at] = _choose(v[at], who[at], x[at], f == 1)
            none = np.isnan(fill)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("grp"), b.column("field"), pa.array(fill, mask=none), pa.array(donor, mask=none), pa.array(far, mask=none), b.column("copies")],
                names=["id", "grp", "field", "fill", "donor_id", "distance", "copies"],
            )

    return run


def _by_observed(weighed, valued, both, neither) -> Column:
    """What holds by the observed ones of gross weight and value: only the first, only the second, both, neither."""
    g, v = F.col("logg").isNotNull(), F.col("logv").isNotNull()
    return F.when(g & v, both).when(g, weighed).when(v, valued).otherwise(neither)


def _kinds(donors: DataFrame, neighbours: int) -> DataFrame:
    """donors once for each kind they are of, with what records that ask for this kind can compare, and nothing else.

    Of donors without an order, the first ids of a reporter and year are all that can be kept."""
    array = lambda *k: F.array(*[F.lit(x) for x in k])
    ordered = donors.withColumn("kind", F.explode(_by_observed(array(WEIGHED), array(VALUED), array(WEIGHED, BOTH), F.lit(None).cast("array<int>"))))
    ordered = ordered.withColumn("logg", F.when(F.col("kind") == WEIGHED, F.col("logg")))
    plain = donors.withColumn("kind", F.explode(_by_observed(array(UNVALUED, ALL), array(UNWEIGHED, ALL), array(ALL), array(NEITHER, UNWEIGHED, UNVALUED, ALL))))
    nothing = F.lit(None).cast("float")
    alike = Window.partitionBy("good", "kind", "reporter", "year", F.col("num").isNull(), F.col("cat").isNull()).orderBy("id")
    plain = plain.withColumns({"logv": nothing, "logg": nothing, "nth": F.row_number().over(alike)}).filter(F.col("nth") <= neighbours).drop("nth")
    return ordered.unionByName(materialise(plain))


def _bin() -> Column:
    """The place of a row in the order of its kind."""
    axis = F.when(F.col("kind") == WEIGHED, F.col("logg")).when(F.col("kind") < NEITHER, F.col("logv")).otherwise(0.0)
    return F.floor(axis * AXIS_BINS).cast("bigint")


def _shard(by: Column) -> Column:
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64(by), F.col("parts"))).otherwise(0)
    return (F.shiftleft(F.col("kind").cast("bigint"), 57) + F.shiftleft("first", 16) + part).alias("shard")


def _shards(donors: DataFrame, asking: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """donors with their shard and asking with the shard in whose order it stands. A shard: consecutive bins of
    one kind, of block_rows donors or up to twice as many; a bin that holds more is split by a hash of the id."""
    donors = donors.withColumn("bin", _bin())
    sizes = materialise(donors.groupBy("good", "kind", "bin").agg(F.count(F.lit(1)).alias("n")))
    has = sizes.groupBy("good").agg(F.bit_or(F.expr("shiftleft(1, kind)")).alias("has"))
    first = lambda *kinds: F.coalesce(*[F.when(F.col("has").bitwiseAND(1 << k) != 0, F.lit(k)) for k in kinds])
    home = first(WEIGHED, UNWEIGHED), first(BOTH, VALUED, UNVALUED), first(WEIGHED, VALUED, NEITHER), F.lit(ALL)
    asking = asking.join(has, "good").withColumn("kind", _by_observed(*home)).drop("has").withColumn("bin", _bin())
    every = sizes.unionByName(asking.select("good", "kind", "bin").distinct().withColumn("n", F.lit(0).cast("bigint"))).groupBy("good", "kind", "bin").agg(F.sum("n").alias("n"))
    up = Window.partitionBy("good", "kind").orderBy("bin")
    small = F.when(F.col("n") <= block_rows, F.col("n")).otherwise(0)
    before = F.coalesce(F.sum(small).over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.struct(
        F.when(F.col("n") <= block_rows, F.floor(before / block_rows)).otherwise(F.lit(1 << 40) + F.col("bin")).alias("first"), F.ceil(F.col("n") / block_rows).cast("int").alias("parts")
    )
    # bins without donors belong to the shard before them, or to the first
    own = every.withColumn("own", F.when(F.col("n") > 0, place))
    nearest = F.coalesce(F.last("own", True).over(up.rowsBetween(Window.unboundedPreceding, 0)), F.first("own", True).over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    # a row for each bin of a block: some thousands a block
    table = materialise(own.withColumn("own", nearest).select("good", "kind", "bin", "own.first", "own.parts"))
    of = ["good", "kind", "bin"]
    return donors.join(table, of).select("good", "kind", _shard(F.col("id")), *FEATURES), asking.join(table, of).select("good", _shard(F.col("row")), *FEATURES, "row", "copies")


def _boxes(placed: DataFrame) -> DataFrame:
    """(good, kind, shard, range of each feature that all its donors have, whether any has it, reporters as bits of a hash)."""
    span = lambda c: [F.when(F.count(c) == F.count(F.lit(1)), f(c)).cast("double").alias(f"{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max))]
    some = [(F.count(c) > 0).alias(f"some_{c}") for c in ("year", "logv", "logg")]
    return placed.groupBy("good", "kind", "shard").agg(*span("year"), *span("logv"), *span("logg"), *some, F.bit_or(_bit()).alias("reporters"))


def _bit() -> Column:
    return F.expr("shiftleft(1L, pmod(hash(reporter), 64))")


def _least() -> Column:
    """No donor of the box is closer to the record than this."""
    total, weight = F.when(F.col("reporters").bitwiseAND(_bit()) == 0, 0.5).otherwise(0.0), F.lit(0.5)
    for c, scale, w in (("year", 10.0, 0.5), ("logv", 3.0, 2.0), ("logg", 3.0, 4.0)):
        a = F.col(c).cast("double")
        gap = F.greatest(F.lit(0.0), F.col(f"lo_{c}") - a, a - F.col(f"hi_{c}")) / scale
        known = a.isNotNull() & F.col(f"lo_{c}").isNotNull()
        total = total + F.when(known, F.least(gap, F.lit(1.0)) * w).otherwise(0.0)
        weight = weight + F.when(a.isNotNull() & F.col(f"some_{c}"), w).otherwise(0.0)
    return total / weight


def _search_shards(placed: DataFrame, asks: DataFrame, k: int, neighbours: int, block_rows: int) -> DataFrame:
    """CANDIDATES of the records in asks, each in the shard it asks and within its bound, if it has one."""
    crowded = materialise(asks.groupBy("good", "shard").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("salts")).filter("salts > 1"))  # a row for every ASKED records at most
    donors = placed.join(crowded, ["good", "shard"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    donors = donors.select("good", "shard", "salt", F.lit(0).alias("role"), *FEATURES, F.lit(0).cast("bigint").alias("row"), F.lit(1).cast("bigint").alias("copies"), F.lit(None).cast("double").alias("bound"))
    asking = asks.join(crowded, ["good", "shard"], "left").withColumn("salt", F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1))).cast("int"))
    asking = asking.select("good", "shard", "salt", F.lit(1).alias("role"), *FEATURES, "row", "copies", "bound")
    both = donors.unionByName(asking).repartition("good", "shard", "salt").sortWithinPartitions("good", "shard", "salt", "role")
    return both.mapInArrow(_shard_kernel(k, neighbours, block_rows), CANDIDATES)


def _split_blocks(rows: DataFrame, block_rows: int, k: int, neighbours: int) -> DataFrame:
    """RESULT of the blocks whose donors are cut into shards."""
    asking = materialise(rows.filter("num is null or cat is null").groupBy("good", *FEATURES).agg(F.count(F.lit(1)).alias("copies")).withColumn("row", F.xxhash64("good", *FEATURES)))
    placed, home = map(materialise, _shards(_kinds(rows.filter("num is not null or cat is not null"), neighbours), asking, block_rows))
    boxes = materialise(_boxes(placed))
    first = materialise(_search_shards(placed, home.withColumn("bound", F.lit(None).cast("double")), k, neighbours, block_rows))
    kept = F.when(F.size("cand") >= neighbours, F.element_at("cand", neighbours)["distance"]).otherwise(float("inf"))
    bound = first.groupBy("row").agg(F.max(kept).alias("bound"))
    # Records meet the boxes of their block, not its donors; a block has about two boxes for every block_rows of them.
    bits = [F.lit(sum(1 << k for k in kinds)) for kinds in ((WEIGHED, UNWEIGHED), (BOTH, VALUED, UNVALUED), (WEIGHED, VALUED, NEITHER), (ALL,))]
    asked = home.withColumnRenamed("shard", "home").join(bound, "row").withColumn("kinds", _by_observed(*bits))
    again = asked.join(boxes, "good").filter(F.expr("(kinds & shiftleft(1, kind)) != 0") & (F.col("shard") != F.col("home"))).filter(_least() <= F.col("bound") + 1e-6)
    found = first.unionByName(_search_shards(placed, again.select("good", "shard", *FEATURES, "row", "copies", "bound"), k, neighbours, block_rows))
    best = found.groupBy("row", "id", "grp", "copies", "field").agg(F.slice(F.array_sort(F.flatten(F.collect_list("cand"))), 1, neighbours).alias("cand"))
    out = best.mapInArrow(_chosen(neighbours), f"{RESULT}, copies bigint")
    alone = rows.filter("num is null or cat is null").join(boxes.select("good").distinct(), "good", "left_anti")  # blocks without any donor
    none = F.array(*[F.when(F.col(c).isNull(), F.lit(i).cast("tinyint")) for i, c in enumerate(("num", "cat"))])
    empty = alone.select("id", "grp", F.explode(F.filter(none, lambda x: x.isNotNull())).alias("field"), *[F.lit(None).cast(t).alias(n) for n, t in (("fill", "double"), ("donor_id", "bigint"), ("distance", "double"))])
    return out.withColumn("_", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop("_", "copies").unionByName(empty)


def hot_deck(
    df: DataFrame,
    block_rows: int = 20_000,
    k: int = 3,
    neighbours: int = 5,
    chunk_rows: int = 60_000,
) -> DataFrame:
    """(id, field, fill, donor_id, distance, level) of each missing netWgt and isNetWgtEstimated of
    declarations. fill: a weight, or 1.0 / 0.0 for the flag. level: block, chapter, table or none."""
    code = F.trim("cmdCode")
    padded = F.when(code.rlike(r"^[0-9]{1,6}$"), F.lpad(code, 6, "0")).otherwise(F.upper(code))
    padded = F.when(code.rlike(r"^[0-9]{1,2}$"), F.lpad(code, 2, "0")).when(code.rlike(r"^[0-9]{3,4}$"), F.lpad(code, 4, "0")).otherwise(padded)
    flow = F.upper(F.trim("flowCode"))
    chapter = F.substring(padded, 1, 2).try_cast("int")
    flow_no = F.coalesce(*[F.when(flow == f, F.lit(i)) for i, f in enumerate(("X", "M", "RX", "RM", "DX", "DM"), 1)], F.lit(0))
    rows = df.select(
        F.xxhash64(padded, flow).alias("good"),
        F.col("id").cast("bigint").alias("id"),
        F.col("reporterCode").cast("int").alias("reporter"),
        F.trim(F.col("refYear").cast("string")).try_cast("smallint").alias("year"),
        F.ln(positive_number(F.col("primaryValue"))).cast("float").alias("logv"),
        F.ln(positive_number(F.col("grossWgt"))).cast("float").alias("logg"),
        (F.coalesce(chapter, F.lit(100)) * 8 + flow_no).cast("int").alias("grp"),
        positive_number(F.col("netWgt")).alias("num"),
        flag_value(F.col("isNetWgtEstimated")).cast("float").alias("cat"),
    )
    large = materialise(rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows).select("good"))
    many = large.count()
    known = F.broadcast(large) if many <= LARGE_BLOCKS else large
    near = (
        rows.join(known, "good", "left_anti")
        .select(F.col("good").alias("block"), *FEATURES)
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_kernel(k, neighbours, chunk_rows), RESULT)
    )
    if many:
        near = near.unionByName(_split_blocks(rows.join(known, "good", "left_semi"), block_rows, k, neighbours))
    # Chapters and flows: at most 101 x 7 rows, and one row for the table.
    mean = F.avg("cat") >= 0.5
    chapters = rows.groupBy("grp").agg(
        F.percentile_approx("num", 0.5, 1000).alias("c_num"), F.when(F.count("cat") > 0, mean.cast("double")).alias("c_cat"), F.sum("cat").alias("yes"), F.count("cat").alias("wc")
    )
    # The table's lower median: its largest value that is not above the exact median.
    middle = exact_quantiles(rows, "num", [0.5]).first()
    lower = rows.filter(F.col("num") <= middle.q0).agg(F.max("num")).first()[0] if middle else None
    # At most 707 rows of chapters: flags of the table are counted from them.
    every = Window.partitionBy(F.lit(1))
    coarse = F.broadcast(
        chapters.select(
            "grp",
            "c_num",
            "c_cat",
            F.lit(lower).cast("double").alias("t_num"),
            F.when(F.sum("wc").over(every) > 0, (F.sum("yes").over(every) / F.sum("wc").over(every) >= 0.5).cast("double")).alias("t_cat"),
        )
    )
    by_field = lambda p: F.when(F.col("field") == 0, F.col(f"{p}_num")).otherwise(F.col(f"{p}_cat"))
    return near.join(coarse, "grp", "left").select(
        "id",
        F.when(F.col("field") == 0, "netWgt").otherwise("isNetWgtEstimated").alias("field"),
        F.coalesce("fill", by_field("c"), by_field("t")).alias("fill"),
        "donor_id",
        "distance",
        F.when(F.col("fill").isNotNull(), "block").when(by_field("c").isNotNull(), "chapter").when(by_field("t").isNotNull(), "table").otherwise("none").alias("level"),
    )


def filled(df: DataFrame, fills: DataFrame) -> DataFrame:
    """df with netWgt and isNetWgtEstimated filled and netWgt_filled, isNetWgtEstimated_filled marks."""
    wide = fills.groupBy("id").agg(
        F.max(F.when(F.col("field") == "netWgt", F.struct("fill"))).alias("_n"), F.max(F.when(F.col("field") == "isNetWgtEstimated", F.struct("fill"))).alias("_c")
    )
    return (
        df.join(wide, "id", "left")
        .withColumn("netWgt", F.coalesce("_n.fill", "netWgt"))
        .withColumn("isNetWgtEstimated", F.coalesce(F.when(F.col("_c.fill") == 1.0, "true").when(F.col("_c.fill") == 0.0, "false"), "isNetWgtEstimated"))
        .withColumn("netWgt_filled", F.col("_n").isNotNull())
        .withColumn("isNetWgtEstimated_filled", F.col("_c").isNotNull())
        .drop("_n", "_c")
    )

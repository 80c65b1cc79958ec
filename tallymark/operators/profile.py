"""Column-level data quality profile of every load, and the loads that are out of line.

Every record is put once into a small vector of levels, one a column: null, out of range, half powers
of ten for numbers, codes of the code table, hashed values for all else. Exact base aggregates (null
rates, ranges, patterns, shares of codes) are counts of levels; an exact value histogram (load,
column, value -> count) that is combined map-side gives distinct counts and medians, the median in
two steps through coarse value bins, so that no task ever sorts the values of a whole load.

Distribution changes are identified by a classifier two-sample test over all columns. For each load
a logistic regression tells its records from those of the other loads: it is fitted on a bounded
sample of FIT_ROWS records a load, class and fold, and judged on *all* records of the fold it did not
see - each record counts for its own load, and against one other load that its hash chooses, so the
work goes with the records, not with records times loads. Scores are kept as histograms. `auc` is the
discrimination, `auc_lost` what it loses when the column's term is taken out (ablation), `auc_alone`
that of the column by itself, cross-fitted over the exact counts of its non-null levels.

A load and column is proposed as shifted by the classifier: by auc_alone or by auc_lost, or if it has
too few values to be judged. Proposals become findings if the exact aggregates confirm the stated band.

Defined cases: NaN counts as a value out of range; a load without any value of a column has no
distinct, range, shift or pattern finding for it; with one load only nothing is out of line; a null
load_no is a load of its own; an empty table gives no rows; the time of loading, as any timestamp, tells
nothing but whether it is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.session import materialise

#: Levels of a number: null, out of range, half powers of ten between 1e-2 and 1e11.
BINS = 29
#: Levels of hashed values, null included.
HASHED = 16
#: Codes that are followed one by one; a longer code table is an error, not a cut.
CODE_ROWS = 200
MOST = 1e11
#: Records a load, class and fold that a model is fitted on.
FIT_ROWS = 1500
#: Loads whose models are held by a task at a time.
LOADS_AT_ONCE = 2000
#: Bins of a score's histogram, over SPAN standard deviations on either side.
SCORE_BINS, SPAN = 64, 4.0
#: Discrimination from which the classifier proposes a shift, and values below which it can't tell.
ALONE, LOST, FEW = 0.01, 0.005, 2000
MEDIAN_BINS_PER_DOUBLING = 16
_NO_LOAD = -(2**62)


def value_bin(c: np.ndarray) -> np.ndarray:
    """Level of non-null numbers. 1: not in (0, MOST], else by half powers of ten."""
    good = (c > 0) & (c <= MOST)
    return np.where(good, np.clip(np.floor(np.log10(np.where(good, c, 1.0)) * 2) + 6, 2, BINS - 1), 1)


def _auc(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """Area under the curve of weighted vectors, ties by half."""
    if pos.sum() == 0 or neg.sum() == 0:
        return 0.5
    u, at = np.unique(score, return_inverse=True)
    p, n = np.bincount(at, pos, len(u)), np.bincount(at, neg, len(u))
    below = np.cumsum(n) - n
    return float((p * (below + n / 2)).sum() / (p.sum() * n.sum()))


def _fit(levels: np.ndarray, width: int, y: np.ndarray, rounds: int = 60, ridge: float = 0.02) -> np.ndarray:
    """Weights of a logistic regression over one-hot levels (rows x columns, numbered through), the last one for
    all rows: accelerated gradient steps, preconditioned by the diagonal; both classes weigh one half."""
    n, c = levels.shape
    w = np.where(y, 0.5 / max(y.sum(), 1), 0.5 / max((~y).sum(), 1))
    flat = levels.ravel()
    size = np.bincount(flat, np.repeat(w, c), width)
    step = 1.0 / (0.25 * (c + 1) * size + ridge)
    beta, ahead, bias, t = np.zeros(width), np.zeros(width), 0.0, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(ahead[levels].sum(1) + bias, -30, 30)))
        g = w * (y - p)
        new = ahead + step * (np.bincount(flat, np.repeat(g, c), width) - ridge * ahead * size)
        bias += 4 * g.sum() / (c + 1)
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, beta = new + (was - 1) / t * (new - beta), new
    return np.append(beta, bias)


def _reader(begin: np.ndarray):
    def read(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(load or _NO_LOAD, hash, levels numbered through) of a batch of vectors."""
        load = b.column(0).cast(pa.int64()).fill_null(_NO_LOAD).to_numpy(zero_copy_only=False)
        levels = np.empty((b.num_rows, len(begin)), np.int32)
        for j, first in enumerate(begin):
            levels[:, j] = b.column(j + 2).to_numpy(zero_copy_only=False)
            levels[:, j] += first
        return load, b.column(1).to_numpy(zero_copy_only=False), levels

    return read


class Levels:
    """The vectors of levels of a table: kinds of the columns, and the place of each level in a flat row."""

    def __init__(self, df: DataFrame, numeric: tuple[str, ...], code: str, known: list[str], load: str, key: str):
        self.load, self.known, self.code = load, known, code
        self.columns = [f for f in df.schema.fields if f.name != load]
        self.names = [f.name for f in self.columns]
        kind = lambda f: f.dataType.typeName()
        self.sizes, cols, kinds = [], [], []
        for f in self.columns:
            c = F.col(f"`{f.name}`")
            if f.name in numeric or kind(f) in ("double", "float") or kind(f).startswith("decimal"):
                what, size, c = "number", BINS, c.cast("double")
            elif f.name == code:
                what, size, c = "code", len(known) + 2, c.cast("string")
            elif kind(f).startswith("timestamp"):
                what, size, c = "null", 2, F.when(c.isNotNull(), F.lit(1))
            else:
                value = F.to_json(c) if kind(f) in ("map", "struct", "array") else c
                what, size, c = "hash", HASHED, F.when(c.isNotNull(), F.xxhash64(value))
            self.sizes.append(size)
            kinds.append(what)
            cols.append(c.alias(f"c{len(cols)}"))
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        drawn = F.xxhash64(F.lit("profile"), F.col(f"`{key}`") if key in df.columns else F.hash(*[F.col(f"`{n}`") for n in self.names]))
        raw = df.select(F.col(f"`{load}`").cast("int").alias("load_no"), F.pmod(drawn, F.lit(1 << 31)).cast("int").alias("h"), *cols)
        names, codes = raw.columns, pa.array(known, pa.string())

        def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = [b.column(0), b.column(1)]
                for j, what in enumerate(kinds, 2):
                    c = b.column(j)
                    none = c.is_null().to_numpy(zero_copy_only=False)
                    if what == "code":
                        v = pc.fill_null(pc.index_in(c, codes), -1).to_numpy(zero_copy_only=False) + 2
                    else:
                        v = c.fill_null(1).to_numpy(zero_copy_only=False)
                        v = value_bin(v) if what == "number" else v % (HASHED - 1) + 1 if what == "hash" else v
                    out.append(pa.array(np.where(none, 0, v).astype(np.int16)))
                yield pa.RecordBatch.from_arrays(out, names=names)

        self.vectors = materialise(raw.mapInArrow(level, ", ".join(f"{n} {'int' if i < 2 else 'smallint'}" for i, n in enumerate(names))))
        self.read = _reader(self.begin[:-1].astype(np.int32))

    def counts(self) -> DataFrame:
        """(load_no, fold, level, n): level numbered through all columns. A task ships counts of the loads it met."""
        read, width = self.read, int(self.begin[-1])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[tuple[int, int], np.ndarray] = {}
            for b in batches:
                load, h, levels = read(b)
                who, at = np.unique(load * 2 + (h & 1), return_inverse=True)
                n = np.bincount((at[:, None] * width + levels).ravel(), minlength=len(who) * width).reshape(len(who), width)
                for k, x in zip(who.tolist(), n):
                    seen[k] = seen[k] + x if k in seen else x
            for k, x in seen.items():
                at = np.flatnonzero(x)
                load = pa.array([None if k >> 1 == _NO_LOAD else k >> 1] * len(at), pa.int32())
                yield pa.RecordBatch.from_arrays([load, pa.array(np.full(len(at), k & 1, np.int8)), pa.array(at, pa.int32()), pa.array(x[at], pa.int64())], names=["load_no", "fold", "level", "n"])

        return self.vectors.mapInArrow(run, "load_no int, fold tinyint, level int, n bigint").groupBy("load_no", "fold", "level").agg(F.sum("n").alias("n"))


def _against(load: np.ndarray, h: np.ndarray, many: int) -> np.ndarray:
    """The other load (by place) that a record counts against."""
    return (load + 1 + (h >> 1) % max(many - 1, 1)) % many


def _models(lv: Levels, loads: list[int], sizes: np.ndarray, low: int, high: int) -> np.ndarray:
    """(loads low to high, fold, levels and constant, mean and deviation of the score): fitted without the fold."""
    read, many, width = lv.read, len(loads), int(lv.begin[-1])
    place = np.array(loads)
    rest = (sizes.sum() - sizes) / max(many - 1, 1)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            load, h, levels = read(b)
            own = np.searchsorted(place, load)
            other = _against(own, h, many)
            # another hash than that of the fold and of the other load
            u = ((h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(float) / 2.0**24
            for m, y, have in ((own, True, sizes[own]), (other, False, rest[other])):
                pick = np.flatnonzero((u * have < 2 * FIT_ROWS) & (m >= low) & (m < high) & (many > 1))
                if len(pick):
                    flat = pa.FixedSizeListArray.from_arrays(pa.array(levels[pick].ravel()), levels.shape[1]).cast(pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(m[pick], pa.int32()), pa.array((h[pick] & 1).astype(np.int8)), pa.array([y] * len(pick)), flat], names=["m", "fold", "y", "levels"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, fold = np.stack(pdf.levels), pdf.y.to_numpy(), pdf.fold.to_numpy()
        out = []
        for f in (0, 1):
            a = fold != f
            beta = _fit(x[a], width, y[a]) if y[a].any() and not y[a].all() else np.zeros(width + 1)
            score = beta[x[a]].sum(1) if a.any() else np.zeros(1)
            out.append((int(pdf.m.iloc[0]), f, [*beta.tolist(), float(score.mean()), float(score.std()) or 1.0]))
        return pd.DataFrame(out, columns=["m", "fold", "beta"])

    fitted = lv.vectors.mapInArrow(examples, "m int, fold tinyint, y boolean, levels array<int>").groupBy("m").applyInPandas(fit, "m int, fold int, beta array<double>").collect()  # 2 x LOADS_AT_ONCE rows
    out = np.zeros((high - low, 2, width + 3))
    out[:, :, -1] = 1.0
    for m, f, beta in fitted:
        out[m - low, f] = beta
    return out


def _scored(lv: Levels, loads: list[int], beta: np.ndarray, low: int) -> DataFrame:
    """(m, hist): histograms of the scores of all records, by class, fold, and column left out (the last: none)."""
    read, many, c = lv.read, len(loads), len(lv.names)
    place, shape = np.array(loads), (2, 2, c + 1, SCORE_BINS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for b in batches:
            load, h, levels = read(b)
            own, fold = np.searchsorted(place, load), h & 1
            for y, m in ((1, own), (0, _against(own, h, many))):
                pick = np.flatnonzero((m >= low) & (m < low + len(beta)))
                if not len(pick):
                    continue
                mm, ff = m[pick] - low, fold[pick]
                terms = beta[mm[:, None], ff[:, None], levels[pick]]
                whole = terms.sum(1)
                mean, sd = beta[mm, ff, -2], beta[mm, ff, -1]
                z = np.concatenate([whole[:, None] - terms, whole[:, None]], axis=1)
                bins = np.clip(((z - mean[:, None]) / sd[:, None] + SPAN) * (SCORE_BINS / (2 * SPAN)), 0, SCORE_BINS - 1).astype(np.int64)
                who, at = np.unique(mm, return_inverse=True)
                cell = ((at * 2 + ff)[:, None] * (c + 1) + np.arange(c + 1)) * SCORE_BINS + bins
                n = np.bincount(cell.ravel(), minlength=len(who) * 2 * (c + 1) * SCORE_BINS).reshape(len(who), *shape[1:])
                for k, x in zip((who + low).tolist(), n):
                    kept.setdefault(k, np.zeros(shape, np.int64))[y] += x
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in kept.values()], pa.binary())], names=["m", "hist"])

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, np.ndarray] = {}  # bounded by the loads of a task
        for pdf in batches:
            for m, hist in zip(pdf["m"], pdf["hist"]):
                x = np.frombuffer(hist, "<i8").reshape(shape)
                kept[m] = kept[m] + x if m in kept else x
        place = np.arange(SCORE_BINS, dtype=float)
        for m, x in kept.items():
            auc = np.array([np.mean([_auc(place, x[1, f, j], x[0, f, j]) for f in (0, 1)]) for j in range(c + 1)])
            yield pd.DataFrame({"m": m, "column": np.arange(c), "auc": auc[-1], "auc_lost": auc[-1] - auc[:-1]})

    shipped = lv.vectors.mapInArrow(run, "m int, hist binary")
    return shipped.repartition(min(32, max(1, len(beta))), "m").mapInPandas(judged, "m int, column int, auc double, auc_lost double")


def _alone(lv: Levels, counts: DataFrame) -> DataFrame:
    """(load_no, column, values, auc_alone) from the exact counts of non-null levels: a load against all others."""
    begin, sizes, many = lv.begin, lv.sizes, len(lv.names)
    every = np.zeros((2, int(begin[-1])))
    for fold, level, n in counts.groupBy("fold", "level").agg(F.sum("n")).collect():  # two rows for each level
        every[fold, level] = n

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, np.ndarray] = {}  # the loads of a task
        for pdf in batches:
            load = pdf["load_no"].fillna(_NO_LOAD).astype("int64").to_numpy()
            for x in np.unique(load):
                of = kept.setdefault(int(x), np.zeros_like(every))
                at = load == x
                of[pdf["fold"].to_numpy()[at], pdf["level"].to_numpy()[at]] = pdf["n"].to_numpy()[at]
        for x, whole in kept.items():
            values, auc = np.zeros(many, np.int64), np.full(many, 0.5)
            for j in range(many):
                at = slice(int(begin[j]) + 1, int(begin[j + 1]))
                own, neg, size = whole[:, at], (every - whole)[:, at], sizes[j] - 1
                share = lambda c: np.log((c + 0.5) / (c.sum() + 0.5 * size))
                values[j] = int(min(own.sum(), neg.sum()))
                auc[j] = np.mean([_auc(share(own[1 - f]) - share(neg[1 - f]), own[f], neg[f]) for f in (0, 1)])
            yield pd.DataFrame({"load_no": pd.array([None if x == _NO_LOAD else x] * many, "Int32"), "column": np.arange(many), "values": values, "auc_alone": auc})

    return counts.repartition(32, "load_no").mapInPandas(judge, "load_no int, column int, values bigint, auc_alone double")


def load_discrimination(lv: Levels, counts: DataFrame) -> DataFrame:
    """(load_no, column_name, auc, auc_alone, auc_lost, proposed): how well each load can be told from the others,
    by all columns and by each; proposed: where the classifier asks for a look at the exact figures."""
    spark = counts.sparkSession
    sizes = counts.filter(F.col("level") < int(lv.sizes[0])).groupBy("load_no").agg(F.sum("n").alias("n")).collect() if lv.names else []  # a row for each load
    rows = sorted((_NO_LOAD if r.load_no is None else r.load_no, r.n) for r in sizes)
    loads, have = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    whole = None
    for low in range(0, len(loads), LOADS_AT_ONCE):
        high = min(low + LOADS_AT_ONCE, len(loads))
        part = _scored(lv, loads, _models(lv, loads, have, low, high), low)
        whole = part if whole is None else whole.unionByName(part)
    schema = "load_no int, column_name string, auc double, auc_alone double, auc_lost double, proposed boolean"
    if whole is None:
        return spark.createDataFrame([], schema)
    named = spark.createDataFrame([(i, None if x == _NO_LOAD else int(x)) for i, x in enumerate(loads)], "m int, load_no int")
    columns = spark.createDataFrame(list(enumerate(lv.names)), "column int, column_name string")
    alone = _alone(lv, counts).withColumnRenamed("load_no", "_load").withColumnRenamed("column", "_column")
    # rows of loads times columns from here on
    out = whole.join(F.broadcast(named), "m").join(F.broadcast(columns), "column")
    out = out.join(alone, (F.col("_column") == F.col("column")) & F.col("load_no").eqNullSafe(F.col("_load")), "left")
    by_itself = F.coalesce("auc_alone", F.lit(0.5))
    few = F.coalesce(F.col("values") < FEW, F.lit(True))
    return out.select("load_no", "column_name", "auc", by_itself.alias("auc_alone"), "auc_lost", (few | (F.abs(by_itself - 0.5) >= ALONE) | (F.col("auc_lost") >= LOST)).alias("proposed"))


def value_profile(df: DataFrame, numeric: list[str], load: str = "load_no") -> DataFrame:
    """(load_no, column_name, n, distinct_n, lower median, upper median as `median`), exact, of non-null values."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col(c).cast("double") + F.lit(0.0)).alias("v")) for c in numeric])
    hist = df.select(F.col(load).cast("int").alias("load_no"), F.inline(entries)).filter("v is not null").groupBy("load_no", "column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    key = ["load_no", "column_name"]
    size = F.abs("v")
    mag = F.when(size > 0, F.floor(F.log2(size) * MEDIAN_BINS_PER_DOUBLING)).otherwise(-(10**6)).cast("int")
    # Order of the bins is order of the values: negative ones by falling size, NaN last.
    hist = materialise(hist.withColumn("bin", F.when(F.isnan("v"), 10**8).when(F.col("v") < 0, -mag - 4 * 10**6).otherwise(mag).cast("int")))  # read twice: for the bins, and for the bin that holds the median
    bins = hist.groupBy(*key, "bin").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
    run = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    bins = bins.select(*key, "bin", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"), F.col("n").alias("in_bin"), F.sum("n").over(whole).alias("rows"), F.sum("d").over(whole).alias("distinct_n"))
    lo, hi = F.floor((F.col("rows") - 1) / 2), F.floor(F.col("rows") / 2)
    holds = lambda at: (F.col("before") <= at) & (at < F.col("before") + F.col("in_bin"))
    middle = bins.filter(holds(lo) | holds(hi))
    # One or two bins for each load and column; only their values are looked at again.
    at = middle.select(F.col("load_no").alias("_load"), F.col("column_name").alias("_column"), F.col("bin").alias("_bin"), "before", "in_bin", "rows", "distinct_n")
    same = F.col("load_no").eqNullSafe(F.col("_load")) & (F.col("column_name") == F.col("_column")) & (F.col("bin") == F.col("_bin"))
    inner = hist.join(F.broadcast(at), same).drop("_load", "_column", "_bin")
    upto = Window.partitionBy(*key, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    inner = inner.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn("in_bin", F.col("n"))
    pick = lambda at: F.max(F.when(holds(at), F.col("v")))
    return inner.groupBy(*key, "rows", "distinct_n").agg(((pick(lo) + pick(hi)) / 2).alias("median")).withColumnRenamed("rows", "n")


def profile(df: DataFrame, codes_table: DataFrame, numeric: tuple[str, ...] = ("CIFValue", "FOBValue"), code: str = "motCode", load: str = "load_no", key: str = "id") -> dict:
    """counts: exact counts of levels of all columns; values: exact distinct counts and medians; shift: the classifier's."""
    known = sorted(r[0] for r in codes_table.select(code).filter(F.col(code).isNotNull()).distinct().limit(CODE_ROWS + 1).collect())
    if len(known) > CODE_ROWS:
        raise ValueError(f"more than {CODE_ROWS} codes in the table of {code}")
    lv = Levels(df, numeric, code, known, load, key)
    counts = materialise(lv.counts())  # rows of loads times levels
    return {"levels": lv, "counts": counts, "values": materialise(value_profile(df, list(numeric), load)), "numeric": numeric}


def discrimination(p: dict) -> DataFrame:
    return load_discrimination(p["levels"], p["counts"])


def figures(p: dict) -> DataFrame:
    """(load_no, rows, have_<column>, out_<column>, code_<i>) of each load, exact, from the counts of levels."""
    lv = p["levels"]
    at = dict(zip(lv.names, lv.begin.tolist()))
    total = lambda lo, hi: F.coalesce(F.sum(F.when((F.col("level") >= lo) & (F.col("level") < hi), F.col("n"))), F.lit(0))
    aggs = [total(0, lv.sizes[0]).alias("rows")]
    aggs += [total(at[c] + 1, at[c] + size).alias(f"have_{c}") for c, size in zip(lv.names, lv.sizes)]
    aggs += [total(at[c] + 1, at[c] + 2).alias(f"out_{c}") for c in p["numeric"]]
    aggs += [total(at[lv.code] + 2 + i, at[lv.code] + 3 + i).alias(f"code_{i}") for i in range(len(lv.known))]
    return p["counts"].groupBy("load_no").agg(*aggs)


def profile_findings(p: dict) -> DataFrame:
    """(load_no, column_name, finding). Tables from here on have a few rows for each load."""
    lv = p["levels"]
    known, code, numeric = lv.known, lv.code, p["numeric"]
    base = materialise(figures(p))
    null_rates = base.select("load_no", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), (1 - F.col(f"have_{c}") / F.col("rows")).alias("x")) for c in lv.names])))
    ratio = lambda a, b: F.when(b > 0, a / b)
    ranges = base.select("load_no", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), ratio(F.col(f"out_{c}"), F.col(f"have_{c}")).alias("x")) for c in numeric])))
    hits = F.lit(0)
    for i in range(len(known)):
        hits = hits + F.col(f"code_{i}")
    pattern = base.select("load_no", F.lit(code).alias("column_name"), (1 - ratio(hits, F.col(f"have_{code}"))).alias("x"))

    def median_of(t: DataFrame, keys: list[str]) -> DataFrame:
        return t.join(F.broadcast(t.groupBy(*keys).agg(F.percentile("x", 0.5).alias("mid"))), keys)

    out = median_of(null_rates, ["column_name"]).filter(F.abs(F.col("x") - F.col("mid")) > 0.2).select("load_no", "column_name", F.lit("null_rate").alias("finding"))
    out = out.unionByName(ranges.filter("x > 0.05").select("load_no", "column_name", F.lit("range").alias("finding")))
    out = out.unionByName(pattern.filter("x > 0.05").select("load_no", "column_name", F.lit("pattern").alias("finding")))
    values = p["values"]
    dist = median_of(values.select("load_no", "column_name", (F.col("distinct_n") / F.col("n")).alias("x")), ["column_name"])
    out = out.unionByName(dist.filter("x < mid / 2").select("load_no", "column_name", F.lit("distinct").alias("finding")))
    # Shifts: what the classifier proposes, if the exact band confirms it.
    band = median_of(values.select("load_no", "column_name", F.col("median").alias("x")), ["column_name"]).filter("x > 4 * mid or x < mid / 4").select("load_no", "column_name")
    if known:
        shares = base.select("load_no", F.lit(code).alias("column_name"), F.inline(F.array(*[F.struct(F.lit(m).alias("code"), ratio(F.col(f"code_{i}"), F.col(f"have_{code}")).alias("x")) for i, m in enumerate(known)])))
        band = band.unionByName(median_of(shares, ["column_name", "code"]).filter(F.abs(F.col("x") - F.col("mid")) > 0.2).select("load_no", "column_name"))
    band = F.broadcast(band.distinct().select(F.col("load_no").alias("_load"), F.col("column_name").alias("_column")))  # at most a row for each load and column
    proposed = discrimination(p).filter("proposed").join(band, F.col("load_no").eqNullSafe(F.col("_load")) & (F.col("column_name") == F.col("_column")), "left_semi")
    return out.unionByName(proposed.select("load_no", "column_name", F.lit("shift").alias("finding")))


def distinct_counts(df: DataFrame, columns: list, load: str) -> DataFrame:
    """(load_no, column_name, distinct_n), exact, of non-null values of the given fields.

    Values are counted in histograms combined map-side, one for each kind of value, so that no
    task holds the values of a load and numbers are shuffled as numbers."""
    kinds: dict[str, list] = {"bigint": [], "double": [], "string": []}
    for f in columns:
        t = f.dataType.typeName()
        kinds["bigint" if t in ("byte", "short", "integer", "long", "timestamp") else "double" if t in ("float", "double") else "string"].append(f)
    # Instants as numbers: their spelling in the session's zone need not be unique.
    value = lambda f: F.unix_micros(f"`{f.name}`") if f.dataType.typeName() == "timestamp" else F.col(f"`{f.name}`")
    out = None
    for kind, fields in kinds.items():
        if not fields:
            continue
        entries = F.array(*[F.struct(F.lit(f.name).alias("column_name"), value(f).cast(kind).alias("v")) for f in fields])
        values = df.select(F.col(f"`{load}`").cast("int").alias("load_no"), F.inline(entries)).filter("v is not null").groupBy("load_no", "column_name", "v").agg(F.lit(1).alias("_"))
        counted = values.groupBy("load_no", "column_name").agg(F.count(F.lit(1)).alias("distinct_n"))
        out = counted if out is None else out.unionByName(counted)
    return out


def declaration_patterns(codes_table: DataFrame, code: str = "motCode") -> dict[str, Column]:
    """Columns of declarations -> what their non-null values must be."""
    known = [r[0] for r in codes_table.select(code).filter(F.col(code).isNotNull()).distinct().limit(CODE_ROWS + 1).collect()]
    if len(known) > CODE_ROWS:
        raise ValueError(f"more than {CODE_ROWS} codes in the table of {code}")
    text = {"cmdCode": "^(TOTAL|[0-9]{1,6})$", "refYear": "^[0-9]{4}$", "flowCode": "^(X|M|RX|RM|DX|DM)$", "classificationCode": "^H[0-9]$"}
    amounts = ("CIFValue", "FOBValue", "primaryValue")
    return {c: F.col(c).rlike(p) for c, p in text.items()} | {c: (F.col(c) > 0) & (F.col(c) <= MOST) for c in amounts} | {code: F.col(code).isin(known)}


def column_profile(df: DataFrame, load: str = "load_no", patterns: dict[str, Column] | None = None) -> DataFrame:
    """(load_no, column_name, rows, nulls, null_rate, distinct_n, low, high, violations) of every column of every load.

    One aggregate of fixed-size states, and exact histograms of values for distinct_n; low and high are
    the finite range of numeric columns; violations: non-null values that are not as the column's pattern
    says, null for a column without one."""
    patterns = patterns or {}
    columns = [f for f in df.schema.fields if f.name != load]
    numeric = [f.name for f in columns if f.dataType.typeName() in ("integer", "long", "short", "byte", "double", "float") or f.dataType.typeName().startswith("decimal")]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in columns:
        aggs += [F.count(f"`{f.name}`").alias(f"have_{f.name}")]
    for c in numeric:
        v = F.col(f"`{c}`").cast("double")
        finite = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
        aggs += [F.min(finite).alias(f"low_{c}"), F.max(finite).alias(f"high_{c}")]
    aggs += [F.count_if(F.col(f"`{c}`").isNotNull() & ~F.coalesce(good, F.lit(False))).alias(f"bad_{c}") for c, good in patterns.items()]
    base = df.groupBy(F.col(load).cast("int").alias("load_no")).agg(*aggs)
    none = F.lit(None).cast("double")
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col("rows").alias("n"),
            (F.col("rows") - F.col(f"have_{f.name}")).alias("nulls"),
            (F.col(f"low_{f.name}") if f.name in numeric else none).alias("low"),
            (F.col(f"high_{f.name}") if f.name in numeric else none).alias("high"),
            (F.col(f"bad_{f.name}") if f.name in patterns else F.lit(None).cast("bigint")).alias("violations"),
        )
        for f in columns
    ]
    out = base.select("load_no", F.inline(F.array(*rows)))
    # One row for each load and column on both sides.
    distinct = distinct_counts(df, columns, load).withColumnsRenamed({"load_no": "_load", "column_name": "_column"})
    out = out.join(F.broadcast(distinct), F.col("load_no").eqNullSafe(F.col("_load")) & (F.col("column_name") == F.col("_column")), "left")
    return out.select("load_no", "column_name", F.col("n").alias("rows"), "nulls", (F.col("nulls") / F.col("n")).alias("null_rate"), F.coalesce("distinct_n", F.lit(0)).cast("bigint").alias("distinct_n"), "low", "high", "violations")

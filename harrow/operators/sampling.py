"""Sampling and resampling (SA1-SA5).

Random choices are ordered by ``md5(concat_ws('-', key, seed))`` then the key, so a
run is reproducible and any SQL engine can reproduce it.  Ranks inside strata never
use ``Window.partitionBy(stratum)``: one stratum may hold a third of the rows, so
ranks come from buckets of the hash plus a per-bucket offset.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.operators.joins import attach
from harrow.operators.rank import global_row_number
from harrow.session import freeze

DEFAULT_SEED = 42


def seeded_hash(key: str | Column, seed: int = DEFAULT_SEED, salt: str | None = None) -> Column:
    """Hex md5 of (key, seed[, salt]): a reproducible random order."""
    k = F.col(key) if isinstance(key, str) else key
    parts = [k.cast("string"), F.lit(str(seed))] + ([F.lit(salt)] if salt else [])
    return F.md5(F.concat_ws("-", *parts))


def seeded_uniform(key: str | Column, seed: int = DEFAULT_SEED, salt: str | None = None) -> Column:
    """A uniform number in [0, 1) from the first 8 hex digits of the seeded hash."""
    h = seeded_hash(key, seed, salt)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# Leading hex digits of the seeded hash that bucket a stratum: 4,096 buckets each.
BUCKET_DIGITS = 3


def rank_within(df: DataFrame, strata: Sequence[str], key: str, seed: int = DEFAULT_SEED,
                name: str = "rank", digits: int = BUCKET_DIGITS) -> DataFrame:
    """1-based rank inside each stratum by (seeded hash, key), skew-safe.

    Leading digits of the hash are buckets in the same order and of equal expected size.
    Rows per bucket are counted (at most ``16 ** digits`` per stratum) and summed up; a
    window inside (stratum, bucket) does the rest.  Rows and sums meet on one hash exchange
    by (stratum, bucket), so a stratum with a third of the rows is thousands of groups."""
    h = seeded_hash(key, seed)
    rows = df.withColumns({"__h": h, "__b": F.substring(h, 1, digits),
                           "__k": F.hash(*strata)})
    on = [*strata, "__k", "__b"]
    sizes = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*strata).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"__s_{c}") for c in on],
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    local = F.row_number().over(Window.partitionBy(*on).orderBy("__h", key))
    return (rows.withColumn("__r", local).join(starts, same)
            .withColumn(name, F.col("__start") + F.col("__r"))
            .drop("__h", "__r", "__start", "__k", "__b", *[f"__s_{c}" for c in on]))


# SA1 ------------------------------------------------------------------------
def case_control_match(df: DataFrame, label: str, time_col: str, group_col: str | None,
                       key: str, seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """SA1: 1:1 matched sample and its report.

    Each positive gets one control from the same year and group, else from the same
    year; controls are used once; positives left over are dropped.  Pass 1 pairs
    equal random ranks inside (year, group); pass 2 pairs equal random ranks inside
    the year among what is left.  Per year the matched count is min(H_y, C_y), as in
    the greedy reference; pass 1 is the largest possible, so it can match more on
    both keys than a greedy pass that consumed a control too early.  Null years
    never match.
    """
    g = F.coalesce(F.col(group_col).cast("string"), F.lit("unknown")) if group_col and \
        group_col in df.columns else F.lit("unknown")
    # Only four narrow columns take part in the ranking passes; freezing them once
    # keeps the (possibly expensive) input from being recomputed for every pass.
    base = freeze(df.select(key, label, F.year(F.col(time_col)).alias("__year"),
                            g.alias("__grp")))
    pos = base.filter(F.col(label) == 1)
    neg = base.filter(F.col(label) == 0)
    pos_ok = pos.filter(F.col("__year").isNotNull()).select(key, "__year", "__grp")
    neg_ok = neg.filter(F.col("__year").isNotNull()).select(key, "__year", "__grp")

    p1 = rank_within(pos_ok, ["__year", "__grp"], key, seed, "__rank")
    c1 = rank_within(neg_ok, ["__year", "__grp"], key, seed, "__rank")
    pairs1 = freeze(p1.alias("p").join(c1.alias("c"), ["__year", "__grp", "__rank"]).select(
        F.col(f"p.{key}").alias("__pos"), F.col(f"c.{key}").alias("__ctl")))
    left_p = pos_ok.join(pairs1.select(F.col("__pos").alias(key)), key, "left_anti")
    left_c = neg_ok.join(pairs1.select(F.col("__ctl").alias(key)), key, "left_anti")
    p2 = rank_within(left_p, ["__year"], key, seed, "__rank")
    c2 = rank_within(left_c, ["__year"], key, seed, "__rank")
    pairs2 = p2.alias("p").join(c2.alias("c"), ["__year", "__rank"]).select(
        F.col(f"p.{key}").alias("__pos"), F.col(f"c.{key}").alias("__ctl"))
    # Two keys a row, read by the sample and by the report.
    pairs = freeze(pairs1.withColumn("__pass", F.lit(1))
                   .unionByName(pairs2.withColumn("__pass", F.lit(2))))
    chosen = (pairs.select(F.col("__pos").alias(key))
              .unionByName(pairs.select(F.col("__ctl").alias(key))))
    sample = df.join(chosen, key, "left_semi")

    counts = base.agg(F.count_if(F.col(label) == 1).alias("hits_available"),
                      F.count_if(F.col(label) == 0).alias("controls_available"))
    matched = pairs.agg(F.count_if(F.col("__pass") == 1).alias("matched_year_and_genre"),
                        F.count_if(F.col("__pass") == 2).alias("matched_year_only"))
    report = attach(counts, matched).select(
        "hits_available", "controls_available", "matched_year_and_genre", "matched_year_only",
        (F.col("hits_available") - F.col("matched_year_and_genre") - F.col("matched_year_only"))
        .alias("hits_unmatched"),
        (2 * (F.col("matched_year_and_genre") + F.col("matched_year_only"))).alias("rows_out"),
        F.when(F.col("matched_year_and_genre") + F.col("matched_year_only") > 0, F.lit(0.5))
        .otherwise(F.lit(0.0)).alias("positive_rate"))
    return sample, report


# SA2 ------------------------------------------------------------------------
def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2,
                     seed: int = DEFAULT_SEED, flag: str = "is_test",
                     tiny_in_both: bool = False) -> DataFrame:
    """SA2: per class, rows in random order; the last ``n_c - int((1-test_size) n_c)``
    go to test.

    ``tiny_in_both`` is for very small training sets (as in M15): under 8 rows, or with a
    class under 2, every row is in train and in test, marked by ``flag`` = 2."""
    per = freeze(df.groupBy(label).agg(F.count(F.lit(1)).alias("__n")))  # a row per class
    ranked = rank_within(df, [label], key, seed, "__rank")
    cut = F.floor(F.col("__n") * F.lit(1 - test_size))
    out = (ranked.join(F.broadcast(per), label)
           .withColumn(flag, (F.col("__rank") > cut).cast("int")).drop("__rank", "__n"))
    if tiny_in_both:
        sizes = per.agg(F.sum("__n").alias("n"), F.count("*").alias("k"), F.min("__n").alias("low"))
        out = attach(out, sizes).withColumn(
            flag, F.when((F.col("n") < 8) | (F.col("k") < 2) | (F.col("low") < 2), 2)
            .otherwise(F.col(flag))).drop("n", "k", "low")
    return out


# SA3 ------------------------------------------------------------------------
def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5,
                     seed: int = DEFAULT_SEED, fold: str = "fold") -> DataFrame:
    """SA3: fold = (random rank inside the class - 1) mod k; class sizes per fold
    differ by at most one."""
    ranked = rank_within(df, [label], key, seed, "__rank")
    return ranked.withColumn(fold, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


# SA5 ------------------------------------------------------------------------
def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """SA5: weight n / (2 n_c) per class, and scale_pos_weight = neg / pos (1 if none)."""
    c = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"),
               F.count_if(F.col(label) == 0).alias("neg"))
    return c.select(
        "n", "pos", "neg",
        F.when(F.col("pos") > 0, F.col("n") / (2 * F.col("pos"))).alias("weight_pos"),
        F.when(F.col("neg") > 0, F.col("n") / (2 * F.col("neg"))).alias("weight_neg"),
        F.when(F.col("pos") > 0, F.col("neg") / F.col("pos")).otherwise(F.lit(1.0))
        .alias("scale_pos_weight"))


def with_class_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class (one-row broadcast)."""
    w = balanced_class_weights(df, label)
    j = attach(df, w.select("weight_pos", "weight_neg"))
    return j.withColumn(weight_col, F.when(F.col(label) == 1, F.col("weight_pos"))
                        .otherwise(F.col("weight_neg"))).drop("weight_pos", "weight_neg")


# SA4 ------------------------------------------------------------------------
# Rows of a block, which one task compares with others at a time.
SMOTE_BLOCK_ROWS = 2048
# The index over cells of similar rows: cells at least if rows allow, rows per cell (beyond, cells
# grow with the rows, so that a row is compared with as many others in a table of any size), rows
# per cell in the sample, cells of a group, and numbers (cells x width, sampled rows x width) that
# the driver holds at most.
SMOTE_CELLS = 1024
SMOTE_CELL_ROWS = 1024
SMOTE_SAMPLE = 8192
SMOTE_LEAST = 8
SMOTE_GROUP = 32
SMOTE_NUMBERS = 1 << 22
SMOTE_DEPTH = 400


class CellIndex:
    """Cells of rows by category signature, then by numbers; each with its exact box.

    Columns with two values (one-hot slots) split first, so that a cell holds rows of one
    signature, or of few; columns of many values split a signature at their medians.  The
    squared distance of a row to a cell's box is a bound from below on its distance to any row
    in it: what differs in the signature counts in full."""

    def __init__(self, sample: np.ndarray, cells: int = SMOTE_CELLS, least: int = SMOTE_LEAST):
        low, high = sample.min(axis=0), sample.max(axis=0)
        self.two = np.array([len(np.unique(c)) <= 2 for c in sample.T])
        self.low, self.high = low, high
        # Nodes: column, threshold (above: first child), children; leaves count down from -1.
        self.nodes: list[tuple[int, float, int, int]] = []
        self.leaves = 0
        self.root = self._split(sample, np.arange(len(sample)), cells, least)
        self.table = np.array(self.nodes, dtype=np.float64).reshape(-1, 4)

    def _split(self, x: np.ndarray, rows: np.ndarray, budget: int, least: int, depth: int = 0) -> int:
        spread = x[rows].var(axis=0)
        by = np.where(self.two, spread, -1.0) if (spread[self.two] > 0).any() else spread
        d = int(by.argmax())
        if budget <= 1 or len(rows) <= least or depth >= SMOTE_DEPTH or not spread[d] > 0:
            self.leaves += 1
            return -self.leaves
        at = float(self.low[d] if self.two[d] else np.median(x[rows, d]))
        if not (x[rows, d] > at).any():
            at = float(x[rows, d].min())
        up = x[rows, d] > at
        part = min(max(1, round(budget * up.mean())), budget - 1)
        here = len(self.nodes)
        self.nodes.append((0, 0.0, 0, 0))
        first = self._split(x, rows[up], part, least, depth + 1)
        self.nodes[here] = (d, at, first, self._split(x, rows[~up], budget - part, least, depth + 1))
        return here

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of every row."""
        node = np.full(len(x), self.root)
        going = np.flatnonzero(node >= 0)
        while len(going):
            d, at, first, other = self.table[node[going]].T
            node[going] = np.where(x[going, d.astype(int)] > at, first, other)
            going = going[node[going] >= 0]
        return -node - 1

    def boxed(self, boxes: dict[int, tuple[int, np.ndarray, np.ndarray]], block_rows: int) -> CellIndex:
        """With the exact size and box of every cell; cells are packed into blocks of about
        ``block_rows``, neighbours in the tree together, and a larger cell is several blocks."""
        width = len(self.low)
        self.sizes = np.array([boxes[c][0] if c in boxes else 0 for c in range(self.leaves)])
        self.lo, self.hi = (np.array([boxes[c][side] if c in boxes else np.zeros(width)
                                      for c in range(self.leaves)]) for side in (1, 2))
        self.first, self.count = np.zeros(self.leaves, int), np.ones(self.leaves, int)
        block, filled = 0, 0
        for c, n in enumerate(self.sizes):
            if filled and filled + n > block_rows:
                block, filled = block + 1, 0
            self.first[c], self.count[c] = block, max(1, -(-n // block_rows))
            block += self.count[c] - 1
            filled += n
        return self

    def reach(self, x: np.ndarray, bound: np.ndarray, cells: np.ndarray | None = None) -> np.ndarray:
        """Which cells (of ``cells``) can hold a row within ``bound`` (squared) of each row."""
        lo, hi, sizes = (v if cells is None else v[cells] for v in (self.lo, self.hi, self.sizes))
        return _within(x, lo, hi, bound) & (sizes > 0)[None, :]

    def reached(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``reach`` as pairs (row, cell), sorted: groups of neighbouring cells first, by the box
        around them, then the cells of those that are within the bound."""
        held = np.flatnonzero(self.sizes > 0)
        starts = np.arange(0, len(held), SMOTE_GROUP)
        near = _within(x, np.minimum.reduceat(self.lo[held], starts),
                       np.maximum.reduceat(self.hi[held], starts), bound)
        rows, found = [np.zeros(0, int)], [np.zeros(0, int)]
        for g in np.flatnonzero(near.any(axis=0)):
            who, cells = np.flatnonzero(near[:, g]), held[starts[g]:starts[g] + SMOTE_GROUP]
            r, c = np.nonzero(self.reach(x[who], bound[who], cells))
            rows.append(who[r])
            found.append(cells[c])
        row, cell = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((cell, row))
        return row[order], cell[order]


def _within(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Which boxes lie within ``bound`` (squared) of each row."""
    out = np.zeros((len(x), len(lo)))
    for d in range(x.shape[1]):
        gap = np.maximum(lo[:, d][None, :] - x[:, d][:, None], x[:, d][:, None] - hi[:, d][None, :])
        out += np.maximum(gap, 0.0) ** 2
    return out <= (bound * (1 + 1e-9) + 1e-12)[:, None]


def _nearest(qk, qx, ck, cx, k):
    """The k nearest of ``cx`` for every row of ``qx`` (squared distance, then key; a row is
    not its own neighbour): indices of rows, keys, distances.  A fast product finds who can
    be among them, differences give the distances."""
    if not len(qk) or not len(ck):
        return np.zeros(0, int), ck[:0], np.zeros(0)
    norms, others = (qx ** 2).sum(axis=1), (cx ** 2).sum(axis=1)
    d = norms[:, None] + others[None, :] - 2.0 * qx @ cx.T
    d[qk[:, None] == ck[None, :]] = np.inf
    kth = np.partition(d, min(k, len(ck)) - 1, axis=1)[:, min(k, len(ck)) - 1]
    slack = 1e-9 * (norms + others.max() + 1.0)
    row, col = np.nonzero((d <= (kth + slack)[:, None]) & np.isfinite(d))
    exact = ((qx[row] - cx[col]) ** 2).sum(axis=1)
    order = np.lexsort((ck[col], exact, row))
    row, col, exact = row[order], col[order], exact[order]
    start = np.searchsorted(row, row)
    keep = np.arange(len(row)) - start < k
    return row[keep], ck[col[keep]], exact[keep]


def _vectors(pdf, name):
    rows = [np.asarray(v, dtype=np.float64) for v in pdf[name]]
    return np.array(rows) if rows else np.zeros((0, 0))


def minority_neighbours(minority: DataFrame, features: str, key: str, k: int = 5,
                        block_rows: int = SMOTE_BLOCK_ROWS, cells: int = SMOTE_CELLS) -> DataFrame:
    """Exact k nearest minority neighbours of every minority row: (key, nn_rank,
    neighbour, distance).

    Rows join the cells of an index over their category signatures and numbers, fitted on a
    bounded sample; cells form blocks.  A row's k-th distance inside its own block bounds its
    search: it is sent only to blocks with a cell whose box lies within that bound, and is
    compared only with the rows of such cells.  On one-hot data few cells are left; vectors of
    many independent numbers have no exact index, and there every cell stays within the bound.
    Each visit returns k rows at most, and a ranked window keeps the best k of a row, so no
    list grows with the data."""
    spark = minority.sparkSession
    kt = minority.schema[key].dataType
    rows = freeze(minority.select(F.col(key).alias("q"), F.col(features).alias("v")))
    cand = T.StructType([T.StructField("q", kt), T.StructField("nb", kt),
                         T.StructField("d", T.DoubleType())])
    width = rows.select(F.size("v").alias("n")).first()
    if width is not None:
        most = max(1, SMOTE_NUMBERS // max(1, width["n"]))
        cells = max(1, min(max(cells, -(-rows.count() // SMOTE_CELL_ROWS)), most))
        drawn = min(max(SMOTE_SAMPLE, SMOTE_LEAST * cells), max(SMOTE_SAMPLE, most))
        sample = np.array([r["v"] for r in rows.orderBy(F.md5(F.col("q").cast("string")), "q")
                           .limit(drawn).collect()], dtype=np.float64)
    else:
        return spark.createDataFrame([], cand).select(
            F.col("q").alias(key), F.lit(0).alias("nn_rank"), F.col("nb").alias("neighbour"),
            F.col("d").alias("distance"))
    index = CellIndex(sample, cells)

    @F.pandas_udf("int")
    def cell(v: pd.Series) -> pd.Series:
        x = np.array([np.asarray(i, dtype=np.float64) for i in v]).reshape(len(v), sample.shape[1])
        return pd.Series(index.place(x).astype("int32"))

    def box(batches):
        known = {}
        for pdf in batches:
            x, at = _vectors(pdf, "v"), pdf["c"].to_numpy()
            for c in np.unique(at):
                here = x[at == c]
                n, lo, hi = known.get(c, (0, np.inf, -np.inf))
                known[c] = (n + len(here), np.minimum(lo, here.min(axis=0)),
                            np.maximum(hi, here.max(axis=0)))
        yield pd.DataFrame([(c, n, list(lo), list(hi)) for c, (n, lo, hi) in known.items()],
                           columns=["c", "n", "lo", "hi"])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"c": [pdf["c"].iloc[0]], "n": [pdf["n"].sum()],
                             "lo": [_vectors(pdf, "lo").min(axis=0)],
                             "hi": [_vectors(pdf, "hi").max(axis=0)]})

    placed = freeze(rows.select("q", "v", cell("v").alias("c")))
    box_type = "c int, n long, lo array<double>, hi array<double>"
    # A row per cell, of at most SMOTE_NUMBERS numbers a side in all.
    boxes = placed.mapInPandas(box, box_type).groupBy("c").applyInPandas(joined, box_type).collect()
    index.boxed({r["c"]: (r["n"], np.array(r["lo"]), np.array(r["hi"])) for r in boxes}, block_rows)

    @F.pandas_udf("long")
    def block(c: pd.Series, h: pd.Series) -> pd.Series:
        c = c.to_numpy()
        return pd.Series(index.first[c] + h.to_numpy() % index.count[c])

    placed = placed.withColumn("block", block("c", F.xxhash64("q")))

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        qk, qx = pdf["q"].to_numpy(), _vectors(pdf, "v")
        row, nb, d = _nearest(qk, qx, qk, qx, k)
        bound = np.full(len(qk), np.inf)
        full = np.bincount(row, minlength=len(qk)) >= k
        bound[full] = pd.Series(d).groupby(row).max().reindex(np.flatnonzero(full)).to_numpy()
        tops = [[] for _ in qk]
        for i, n_, d_ in zip(row, nb, d, strict=True):
            tops[i].append({"nb": n_, "d": d_})
        return pd.DataFrame({"q": qk, "v": pdf["v"], "c": pdf["c"], "block": pdf["block"],
                             "bound": bound, "top": tops})

    top_type = T.ArrayType(T.StructType(cand.fields[1:]))
    inside = freeze(placed.groupBy("block").applyInPandas(own, T.StructType([
        *placed.schema.fields, T.StructField("bound", T.DoubleType()),
        T.StructField("top", top_type)])))

    @F.pandas_udf("array<long>")
    def visits(v: pd.Series, bound: pd.Series, block: pd.Series) -> pd.Series:
        out = []
        for i in range(0, len(v), 2048):
            x = np.array([np.asarray(a, dtype=np.float64) for a in v.iloc[i:i + 2048]])
            row, cell = index.reached(x, bound.iloc[i:i + 2048].to_numpy())
            stops = np.searchsorted(row, np.arange(len(x) + 1))
            for a, b, home in zip(stops[:-1], stops[1:], block.iloc[i:i + 2048], strict=True):
                blocks = {t for c in cell[a:b] for t in range(index.first[c], index.first[c] + index.count[c])}
                out.append([int(t) for t in sorted(blocks) if t != home])
        return pd.Series(out)

    sent = inside.select("q", "v", "bound", F.explode(visits("v", "bound", "block")).alias("t"))
    loads = freeze(sent.groupBy("t").agg(F.ceil(F.count("*") / block_rows).alias("n")))
    sent = sent.join(loads, "t").select("q", "v", "bound", "t",
                                        F.pmod(F.xxhash64("q"), "n").alias("part"))
    hosts = (placed.join(loads, F.col("block") == F.col("t"))
             .select("q", "v", "c", "t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
                     .alias("part")))

    def meet(guests: pd.DataFrame, home: pd.DataFrame) -> pd.DataFrame:
        qk, qx = guests["q"].to_numpy(), _vectors(guests, "v")
        hk, hx, at = home["q"].to_numpy(), _vectors(home, "v"), home["c"].to_numpy()
        if not len(qk) or not len(hk):
            return pd.DataFrame({"q": qk[:0], "nb": hk[:0], "d": np.zeros(0)})
        known = np.unique(at)
        reach = index.reach(qx, guests["bound"].to_numpy(), known)
        found = []
        for j, c in enumerate(known):
            who, there = np.flatnonzero(reach[:, j]), at == c
            row, nb, d = _nearest(qk[who], qx[who], hk[there], hx[there], k)
            found.append((who[row], nb, d))
        row, nb, d = (np.concatenate(p) for p in zip(*found, strict=True))
        order = np.lexsort((nb, d, row))
        row, nb, d = row[order], nb[order], d[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        return pd.DataFrame({"q": qk[row[keep]], "nb": nb[keep], "d": d[keep]})

    met = (sent.groupBy("t", "part").cogroup(hosts.groupBy("t", "part"))
           .applyInPandas(meet, cand))
    every = (inside.select("q", F.explode("top").alias("n")).select("q", "n.nb", "n.d")
             .unionByName(met))
    best = Window.partitionBy("q").orderBy("d", "nb")
    return (every.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
            .select(F.col("q").alias(key), (F.col("r") - 1).alias("nn_rank"),
                    F.col("nb").alias("neighbour"), F.col("d").alias("distance")))


def smote(df: DataFrame, label: str, features: str, key: str, k: int = 5,
          seed: int = DEFAULT_SEED) -> DataFrame:
    """SA4: add minority rows until the classes are equal.

    Synthetic row i: base = minority row ``u_b(i) * m``, neighbour = ``u_n(i) * k``-th
    nearest, ``x + u_s(i) * (nn - x)``; the u are seeded hashes of i.  Originals are
    kept; synthetic rows get ``synthetic = 1`` and a negative key.
    """
    spark = df.sparkSession
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
              .collect()}
    if len(counts) < 2:
        return df.withColumn("synthetic", F.lit(0))
    minority_label = min(counts, key=lambda c: (counts[c], c))
    majority_label = max(counts, key=lambda c: (counts[c], -c))
    need = counts[majority_label] - counts[minority_label]
    if need > 0 and counts[minority_label] <= k:
        raise ValueError(f"{k} neighbours need more than {counts[minority_label]} minority rows")
    base = df.withColumn("synthetic", F.lit(0))
    if need <= 0:
        return base
    minority = df.filter(F.col(label) == minority_label)
    m = counts[minority_label]
    idx = global_row_number(minority.select(key, features), [F.col(key)], "__i")
    nn = minority_neighbours(minority, features, key, k)
    gen = spark.range(need).select(F.col("id").alias("__s"))
    gen = gen.select(
        "__s",
        (F.floor(seeded_uniform("__s", seed, "base") * m) + 1).cast("long").alias("__i"),
        F.floor(seeded_uniform("__s", seed, "nn") * k).cast("int")
        .alias("nn_rank"),
        seeded_uniform("__s", seed, "step").alias("__u"))
    with_base = gen.join(idx.select("__i", F.col(key).alias("__bk"),
                                    F.col(features).alias("__x")), "__i")
    with_nn = with_base.join(nn.select(F.col(key).alias("__bk"), "nn_rank",
                                       F.col("neighbour").alias("__nk")), ["__bk", "nn_rank"])
    with_nn = with_nn.join(minority.select(F.col(key).alias("__nk"),
                                           F.col(features).alias("__y")), "__nk")
    synth = with_nn.select(
        (-(F.col("__s") + 1)).cast(df.schema[key].dataType).alias(key),
        F.zip_with("__x", "__y", lambda a, b: a + (b - a) * F.col("__u")).alias(features),
        F.lit(minority_label).cast(df.schema[label].dataType).alias(label),
        F.lit(1).alias("synthetic"))
    keep = [key, features, label]
    return base.select(*keep, "synthetic").unionByName(synth)

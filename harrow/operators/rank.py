"""Exact global ranks and prefix sums without a one-partition window (W1-W7 helpers).

``Window.orderBy(...)`` with no ``partitionBy`` moves every row to one task.  Here
the order is spread over ``repartitionByRange`` partitions instead:

1. range-partition on the (total) order, sort inside each partition;
2. record the partition id and a per-partition position, then *checkpoint* so the
   layout is frozen (range bounds come from sampling and must not be recomputed);
3. per-partition totals (one row per partition, a proven bound) give offsets that
   a broadcast join adds to the local positions / local running sums.

The only shuffle of the data is the range exchange (plus, for running sums, one
hash exchange on the partition id).  Hot values are split across partitions as
long as the order is total, so callers pass a tie-break key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.functions.columns import number
from harrow.session import freeze

_PID, _LOCAL, _OFF = "__pid", "__local", "__off"


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return int(partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _offsets(frozen: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Exclusive prefix over the per-partition totals (one row per partition)."""
    totals = frozen.groupBy(_PID).agg(*[expr.alias(name) for name, expr in sums.items()])
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(_PID, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(
        f"{_OFF}{name}") for name in sums], F.col(next(iter(sums))).alias("__all"))


def _laid_out(df: DataFrame, order: Sequence[str | Column], partitions: int | None) -> DataFrame:
    """The rows in ``order`` over range partitions, frozen, with the partition and the
    position in it."""
    cols = _order_cols(order)
    ranged = (df.repartitionByRange(_partitions(df, partitions), *cols).sortWithinPartitions(*cols)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_LOCAL, F.monotonically_increasing_id()))
    return freeze(ranged).withColumn(
        _LOCAL, F.col(_LOCAL) - F.shiftleft(F.col(_PID).cast("long"), 33))


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_number",
                      partitions: int | None = None, total: str | None = None) -> DataFrame:
    """1-based position of every row in ``order`` (ties broken by layout: pass a total
    order), and the number of rows as ``total`` if asked for: both come from the frozen
    partitions' counts, so the input is read once."""
    frozen = _laid_out(df, order, partitions)
    offsets = _offsets(frozen, {"n": F.count(F.lit(1))})
    if total:
        offsets = offsets.withColumn(total, F.sum("__all").over(Window.partitionBy(F.lit(0))))
    ranked = (frozen.join(F.broadcast(offsets.drop("__all")), _PID)
              .withColumn(name, F.col(f"{_OFF}n") + F.col(_LOCAL) + 1))
    return ranked.drop(_PID, _LOCAL, f"{_OFF}n")


def ordered_cumsum(df: DataFrame, order: Sequence[str | Column], values: Sequence[str],
                   prefix: str = "cum_", partitions: int | None = None,
                   following: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``values`` in ``order`` (order should be unique per row), and
    ``next``: a struct of the ``following`` columns of the row after it (null at the end)."""
    cols = _order_cols(order)
    n = _partitions(df, partitions)
    frozen = freeze(df.repartitionByRange(n, *cols).withColumn(_PID, F.spark_partition_id()))
    running = Window.partitionBy(_PID).orderBy(*cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = frozen.select("*", *[F.sum(v).over(running).alias(f"{_LOCAL}{v}") for v in values])
    offsets = _offsets(frozen, {v: F.sum(v) for v in values})
    if following:
        # Inside a partition by lead; its last row takes the first one of the next partition,
        # which is one row per partition.
        inside = Window.partitionBy(_PID).orderBy(*cols)
        local = local.withColumns({"__n": F.lead(F.struct(*following)).over(inside),
                                   "__r": F.row_number().over(inside)})
        firsts = local.where("__r = 1").select(_PID, F.struct(*following).alias("__f"))
        carried = firsts.select(_PID, F.lead("__f").over(Window.orderBy(_PID)).alias("__c"))
        local = (local.join(F.broadcast(carried), _PID)
                 .withColumn("next", F.coalesce("__n", "__c")).drop("__n", "__c", "__r"))
    out = local.join(F.broadcast(offsets.drop("__all")), _PID)
    out = out.withColumns({f"{prefix}{v}": F.col(f"{_LOCAL}{v}") + F.col(f"{_OFF}{v}")
                           for v in values})
    return out.drop(_PID, *[f"{_LOCAL}{v}" for v in values], *[f"{_OFF}{v}" for v in values])


# Quantiles that bracket the middle; any bracket gives the exact median, a narrow one
# leaves few rows to sort.
_BRACKET = (0.49, 0.51)


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column (mean of the middle two), nulls and NaN skipped.

    Approximate quantiles bracket the middle of every column, one aggregate counts what
    lies below and inside the bracket, and only the distinct values inside are sorted and
    located by running counts.  A column whose middle falls outside its bracket (the
    quantiles are approximate) is located among all its values.  Returns a small frame
    ``(feature, median, n)`` with one row per column that has values."""
    if not columns:
        raise ValueError("exact_medians needs at least one column")
    # Read three times; kept with its lineage, so a lost executor only costs its part again.
    wide = df.select(*[number(c).alias(f"v{i}") for i, c in enumerate(columns)]).persist(
        StorageLevel.MEMORY_AND_DISK)
    found = wide.agg(*[F.percentile_approx(f"v{i}", list(_BRACKET), 10000).alias(f"q{i}")
                       for i in range(len(columns))]).first()
    lo = [q[0] if (q := found[f"q{i}"]) else 0.0 for i in range(len(columns))]
    hi = [q[1] if (q := found[f"q{i}"]) else 0.0 for i in range(len(columns))]
    counts = wide.agg(*[x for i in range(len(columns)) for x in (
        F.count(f"v{i}").alias(f"n{i}"), F.count_if(F.col(f"v{i}") < lo[i]).alias(f"b{i}"),
        F.count_if((F.col(f"v{i}") >= lo[i]) & (F.col(f"v{i}") <= hi[i])).alias(f"m{i}"))]).first()
    entries, meta = [], []
    for i, c in enumerate(columns):
        n, below, inside = (counts[f"{k}{i}"] for k in "nbm")
        if not n:
            continue
        v = F.col(f"v{i}")
        near = (v >= lo[i]) & (v <= hi[i])
        if below > (n - 1) // 2 or below + inside <= n // 2:
            near, below = v.isNotNull(), 0
        meta.append((c, n, below))
        entries.append(F.struct(F.lit(c).alias("feature"), F.when(near, v).alias("v")))
    schema = "feature string, n long, below long"
    sizes = df.sparkSession.createDataFrame(meta, schema)
    if not entries:
        wide.unpersist()
        return sizes.select("feature", F.lit(None).cast("double").alias("median"), "n")
    values = (wide.select(F.explode(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))
                          .alias("p")).groupBy("p.feature", "p.v").agg(F.count("*").alias("c")))
    cum = ordered_cumsum(values, ["feature", "v"], ["c"])
    wide.unpersist()
    start = cum.groupBy("feature").agg(F.min(F.col("cum_c") - F.col("c")).alias("start"))
    located = (cum.join(F.broadcast(start), "feature").join(F.broadcast(sizes), "feature")
               .withColumn("first", F.col("cum_c") - F.col("c") - F.col("start") + F.col("below"))
               .withColumn("last", F.col("first") + F.col("c") - 1)
               .withColumn("lo", F.floor((F.col("n") - 1) / 2))
               .withColumn("hi", F.floor(F.col("n") / 2)))
    has = lambda p: (F.col("first") <= F.col(p)) & (F.col(p) <= F.col("last"))
    picked = located.filter(has("lo") | has("hi"))
    return picked.groupBy("feature").agg(
        ((F.sum(F.when(has("lo"), F.col("v"))) + F.sum(F.when(has("hi"), F.col("v")))) / 2)
        .alias("median"),
        F.first("n").alias("n"))


def median_map(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Fitted medians as driver-side literals (one number per column)."""
    found = {r["feature"]: r["median"] for r in exact_medians(df, columns).collect()}
    return {c: found.get(c) for c in columns}


# ---------------------------------------------------------------------------
# W1-W7
# ---------------------------------------------------------------------------

# Rows that the driver reads in a round of a selection.
SELECT_ROWS = 4096


def _orderable(df: DataFrame, name: str) -> list[Column]:
    """A column as order parts with nulls last; times as whole numbers."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    value = (F.unix_micros(c) if isinstance(kind, T.TimestampType) else
             F.unix_date(c) if isinstance(kind, T.DateType) else c)
    return [c.isNull().cast("int"), value]


def _literal(value: tuple, like: T.StructType) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                      for v, f in zip(value, like.fields, strict=True)])


def select_kth(order: DataFrame, k: int, rows: int = SELECT_ROWS) -> tuple[tuple, int, int]:
    """The ``k``-th (from 1) value of the struct column ``o`` in ascending order, with the
    number of rows below it and equal to it.

    Quickselect over all tasks: a hashed sample of the rows still in question, at most ``rows``
    of them, brackets the place; one aggregate counts below, inside and at the bracket; the
    rows in question shrink by a factor that grows with the square root of ``rows``.  Nothing is
    sorted or exchanged, and equal values, however many, end the search."""
    kind = order.schema["o"].dataType
    left, below = order, 0
    n = order.count()
    if not 1 <= k <= n:
        raise ValueError(f"no {k}-th of {n} rows")
    while True:
        drawn = left.orderBy(F.xxhash64("o", F.monotonically_increasing_id())).limit(rows)
        sample = sorted(tuple(r["o"]) for r in drawn.collect())
        if n <= rows:
            value = sample[k - below - 1]
            return value, below + sum(v < value for v in sample), sum(v == value for v in sample)
        at, slack = (k - below) / n * len(sample), 2.0 * len(sample) ** 0.5
        lo = sample[max(0, int(at - slack))]
        hi = sample[min(len(sample) - 1, int(at + slack))]
        low, high = _literal(lo, kind), _literal(hi, kind)
        c = left.agg(F.count_if(F.col("o") < low).alias("a"), F.count_if(F.col("o") <= low).alias("b"),
                     F.count_if(F.col("o") < high).alias("c"), F.count_if(F.col("o") <= high).alias("d")).first()
        place = k - below
        for value, start, stop in ((lo, c["a"], c["b"]), (hi, c["c"], c["d"])):
            if start < place <= stop:
                return value, below + start, stop - start
        if place <= c["a"]:
            left, n = left.where(F.col("o") < low), c["a"]
        elif place <= c["c"]:
            left, below, n = left.where((F.col("o") > low) & (F.col("o") < high)), below + c["b"], c["c"] - c["b"]
        else:
            left, below, n = left.where(F.col("o") > high), below + c["d"], n - c["d"]


def temporal_split(df: DataFrame, time_col: str, tie_break: Sequence[str],
                   test_size: float = 0.2, flag: str = "is_test") -> DataFrame:
    """By time (nulls last, then ``tie_break``), the first ``int((1-test_size)*n)`` rows are
    train.  Adds ``flag`` (0 train, 1 test) and keeps rows.

    The last training row's (time, tie_break) is found by selection over just these columns,
    which are kept once; the split itself is a comparison with that value, so rows are neither
    sorted nor exchanged.  Rows that tie in all of these across the cut are split by a hash of
    their columns; rows equal in every column stay on one side (train)."""
    parts = [p for c in (time_col, *tie_break) for p in _orderable(df, c)]
    key = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
    order = freeze(df.select(key.alias("o")))
    n = order.count()
    cut = int(float(1 - test_size) * n)
    if cut < 1:
        return df.withColumn(flag, F.lit(1))
    kind = order.schema["o"].dataType
    value, below, equal = select_kth(order, cut)
    at = _literal(value, kind)
    if below + equal == cut:
        return df.withColumn(flag, (key > at).cast("int"))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    tied = freeze(df.where(key == at).select(F.struct(whole.alias("p0")).alias("o")))
    (last,), _, _ = select_kth(tied, cut - below)
    return df.withColumn(flag, ((key > at) | ((key == at) & (whole > last))).cast("int"))


def top_k(df: DataFrame, score: str, k: int = 10, key: str | None = None,
          ascending: bool = False) -> DataFrame:
    """The k best rows (TakeOrderedAndProject: per-task top-k, then a final merge)."""
    order = [F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()]
    if key:
        order.append(F.col(key).asc())
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """First n rows in key order (the order is made explicit)."""
    return df.orderBy(F.col(key).asc()).limit(n)


def best_per_group(df: DataFrame, group: str, metric: str,
                   tie_break: str | None = None) -> DataFrame:
    """The row with the highest metric per group; ties to the smallest tie_break.

    ``min_by`` over (-metric, tie_break) is an aggregate with map-side combine, so a
    group holding a third of the rows is reduced before the shuffle."""
    cols = [c for c in df.columns if c != group]
    order = F.struct((-F.col(metric)).alias("m"),
                     (F.col(tie_break) if tie_break else F.lit(0)).alias("t"))
    best = (df.filter(F.col(metric).isNotNull()).groupBy(group)
            .agg(F.min_by(F.struct(*cols), order).alias("__b")))
    return best.select(group, *[F.col(f"__b.{c}").alias(c) for c in cols])


def thin_indices(n: int, max_points: int = 300) -> list[int]:
    """Positions kept by W5: ``int(linspace(0, n-1, max_points))`` (all when n fits)."""
    if n <= max_points:
        return list(range(n))
    step = (n - 1) / (max_points - 1)
    idx = [int(j * step) for j in range(max_points)]
    idx[-1] = n - 1
    return idx


def thin_curve(df: DataFrame, position: str, max_points: int = 300) -> DataFrame:
    """Keep rows at evenly spaced positions (0-based ``position`` column).

    The kept positions are a closed-form set, so this is a filter, not a join:
    row p is kept when some j has ``int(j*step) == p``.  The set is generated on the
    executors from ``n`` (one count), never listed on the driver.
    """
    n = df.count()
    if n <= max_points:
        return df
    step = (n - 1) / (max_points - 1)
    spark = df.sparkSession
    kept = (spark.range(max_points)
            .select(F.when(F.col("id") == max_points - 1, F.lit(n - 1))
                    .otherwise((F.col("id").cast("double") * F.lit(step)).cast("long"))
                    .alias(position))
            .distinct())
    return df.join(F.broadcast(kept), position, "left_semi")


def thin_position(position: Column, n: Column, max_points: int = 300) -> Column:
    """W5 as a condition on a 0-based position among ``n``: whether some ``int(j * step)`` is
    it, found by trying the three ``j`` around ``position / step``."""
    step = (n - 1).cast("double") / (max_points - 1)
    near = F.ceil(position / step)
    tries = [near + d for d in (-1, 0, 1)]
    hit = F.lit(False)
    for j in tries:
        hit = hit | ((j >= 0) & (j < max_points - 1)
                     & ((j.cast("double") * step).cast("long") == position))
    return (n <= max_points) | (position == n - 1) | hit


def keep_latest(df: DataFrame, ts: str, n: int = 200, key: str | None = None) -> DataFrame:
    """The n most recent entries (a top-k, not a sort of the whole log)."""
    order = [F.col(ts).desc()] + ([F.col(key).desc()] if key else [])
    return df.orderBy(*order).limit(n)


def drop_consecutive_repeats(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                             signature: Sequence[str]) -> DataFrame:
    """Drop a record whose signature equals the previous record's in its partition
    (null-safe).  The previous record is the one before it inside its frozen range
    partition; only each partition's last row is carried over to the next one (one row
    per partition, broadcast), so one busy session is spread over many tasks and the rows
    are not joined to themselves."""
    cols = [*partition, *signature]
    frozen = _laid_out(df, [*partition, *order], None)
    mine = F.struct(*[F.col(c) for c in cols])
    last = frozen.groupBy(_PID).agg(F.max_by(mine, _LOCAL).alias("__s"))
    carried = last.select(_PID, F.lag("__s").over(Window.orderBy(_PID)).alias("__carried"))
    inside = F.lag(mine).over(Window.partitionBy(_PID).orderBy(_LOCAL))
    j = frozen.withColumn("__inside", inside).join(F.broadcast(carried), _PID)
    prev = F.coalesce("__inside", "__carried")
    return j.filter(prev.isNull() | ~mine.eqNullSafe(prev)).drop(
        _PID, _LOCAL, "__inside", "__carried")

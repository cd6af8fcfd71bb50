"""Removal of long repeated byte strings by a hash-compared suffix sort.

A byte goes when a string of ``length`` bytes that covers it also starts earlier (smaller
id, or earlier in the same document).  Sorting every suffix of a corpus in one place does
not scale, so suffixes meet in groups: each string of ``length`` bytes elects one of its
``gram``-byte substrings (the one with the smallest hash) as anchor, so equal strings elect
equal anchors at equal places.  Neighbouring strings with one anchor are one row, a
"stretch".

1. Stretches are range-sorted by anchor, content hash and place; the place is part of the
   range, so a passage that fills a third of the corpus is spread over many tasks.  A
   stretch whose whole content came earlier is settled.  Where an anchor has several
   contents, the first row of each goes on.
2. The bytes of those stretches are fetched and sorted in their anchor's group: suffixes
   from the anchor on, and reversed prefixes before it, by a mergesort that compares with
   prefix polynomial hashes and a binary search for the common extension.  Neighbours in
   the result are compared byte by byte; on a hash collision the batch is sorted by its
   bytes.  The common-prefix arrays cut both orders into classes of equal strings, and all
   but the earliest of a class are settled.
3. Groups above ``hot`` contents are not sorted in one task: their strings are grouped one
   by one by two 64-bit hashes with a minimum that is combined before the shuffle.

Defined cases: null text is empty; texts below ``length`` bytes lose nothing; rows with the
same id and text are one document and get the same result; different texts of one id are
ordered by a hash of the text; null ids come last; empty tables give empty results; other
columns are not read."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.llm.common import id_and_text, small_batches, stored

LENGTH = 100
GRAM = 24
HOT = 50_000
# Bytes of text that are hashed at once; longer texts are worked on in parts.
PIECE = 1 << 20
_SORT_ROWS = 5_000
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_ONE, _SHIFT = np.uint64(1), np.uint64(32)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


class PrefixHash:
    """Prefix polynomial hashes (modulo 2**64) of one byte array: any substring's hash in
    constant time, for arrays of starts and lengths."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int):
        up, down = self._powers(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + _ONE) * down[:len(data)], out=self.sums[1:])
        self.up = up

    @classmethod
    def _powers(cls, base: int, n: int):
        have = cls._tables.get(base)
        if have is None or len(have[0]) < n:
            made = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(1 << max(16, (n - 1).bit_length()), b, np.uint64)
                p[0] = 1
                made.append(np.multiply.accumulate(p))
            have = cls._tables[base] = (made[0], made[1])
        return have

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.up[start]

    def sliding(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.up[:n] if n > 0 else self.sums[:0]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all bits."""
    h = (h ^ (h >> _SHIFT)) * _MIX[0]
    h = (h ^ (h >> _SHIFT)) * _MIX[1]
    return h ^ (h >> _SHIFT)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Anchored stretches of texts that lie one after the other in ``data``: arrays of the
    text's number, anchor hash, content hash, first string, strings, anchor's offset."""
    none = (np.zeros(0, np.int64),) * 6
    if len(data) < length:
        return none
    grams = mixed(PrefixHash(data, _BASES[0]).sliding(gram))
    bits = np.uint64(len(grams).bit_length())
    place = (_ONE << bits) - _ONE
    low = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    span, width = length - gram + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    # low[p] elects the anchor of the string at p; drop those that cross texts.
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[:len(low)]
    at = np.flatnonzero(np.arange(len(low)) + length <= offsets[1:][text])
    if not len(at):
        return none
    anchor = (low[at] & place).astype(np.int64)
    cut = np.r_[True, (anchor[1:] != anchor[:-1]) | (np.diff(at) != 1)]
    first = np.flatnonzero(cut)
    count = np.diff(np.r_[first, len(at)])
    start, anchor = at[first], anchor[first]
    off = anchor - start
    content = PrefixHash(data, _BASES[1]).of(start, count + (length - 1))
    tag = (count * 256 + off + 1).astype(np.uint64) * np.uint64(_BASES[0])
    return (text[start].astype(np.int64), grams[anchor].view(np.int64),
            mixed(content ^ tag).view(np.int64), start - offsets[text[start]], count, off)


def _bytes_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and where each text starts."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


# Stretch number and anchor offset are below 2**14 together with the place above them.
_HALF = 14


def _pieces(offsets: np.ndarray, length: int, most: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of texts (first, past the last) and of bytes to work on at once: neighbours up
    to ``most`` bytes, or a part of one longer text.  Parts overlap by a string less one
    byte; which anchor a string elects does not depend on where a part begins."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        if j == i + 1:
            for at in range(int(offsets[i]), max(int(offsets[j]) - length + 1,
                                                 int(offsets[i]) + 1), most):
                yield i, j, at, min(at + most + length - 1, int(offsets[j]))
        else:
            yield i, j, int(offsets[i]), int(offsets[j])
        i = j


def _find(length: int, gram: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_and_offsets(batch.column("text"))
            for i, j, lo, hi in _pieces(offsets, length, most):
                inner = np.clip(offsets[i:j + 1], lo, hi) - lo
                text, anchor, content, start, count, off = stretches(data[lo:hi], inner, length,
                                                                     gram)
                rows = pa.array(text + i)
                start = start + (lo - offsets[i] if j == i + 1 else 0)
                loc = (start.astype(np.int64) << _HALF) | (count.astype(np.int64) << 7) | off
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(content), batch.column("doc_id").take(rows),
                     batch.column("k").take(rows), pa.array(loc.astype(np.int64))],
                    names=["g", "c", "doc_id", "k", "loc"])
    return run


def _settle_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of anchor, content and place: repeats of a content are settled, firsts
    of anchors with several contents go on.  Anchors that touch an end of a batch may go on
    elsewhere, so their firsts go on as well; that only costs work."""
    prev = None
    for batch in batches:
        if not batch.num_rows:
            continue
        g, c, k, loc = (batch.column(n).to_numpy(zero_copy_only=False)
                        for n in ("g", "c", "k", "loc"))
        ids = batch.column("doc_id")
        blank = ids.is_null().to_numpy(zero_copy_only=False)
        doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
        new_g = np.r_[True, g[1:] != g[:-1]]
        new = new_g | np.r_[True, c[1:] != c[:-1]]
        go_on = prev is not None and prev[0] == g[0] and prev[1] == c[0]
        new[0] = not go_on
        lead = np.maximum.accumulate(np.where(new, np.arange(len(g)), -1))
        # The first place of each row's content; -1: it stands in an earlier batch.
        same = np.ones(len(g), bool)
        for col, old in ((blank, 2), (doc, 3), (k, 4), (loc, 5)):
            mine = col[np.maximum(lead, 0)]
            if go_on:
                mine = np.where(lead < 0, prev[old], mine)
            same &= col == mine
        settled = ~new & ~same
        seg = np.cumsum(new_g) - 1
        several = np.bincount(seg, weights=new) > 1
        several[[0, -1]] = True
        onward = new & several[seg]
        j = lead[-1]
        if j >= 0:
            prev = (g[-1], c[-1], blank[j], doc[j], k[j], loc[j])
        pick = np.flatnonzero(settled | onward)
        yield pa.RecordBatch.from_arrays(
            [pa.array(g[pick]), ids.take(pa.array(pick)), pa.array(k[pick]), pa.array(loc[pick]),
             pa.array(settled[pick])], names=["g", "doc_id", "k", "loc", "settled"])


def _extension(h: PrefixHash, a: np.ndarray, na: np.ndarray, b: np.ndarray,
               nb: np.ndarray) -> np.ndarray:
    """Length of the common prefix of strings at ``a`` and ``b``, by binary search."""
    lo, hi = np.zeros(len(a), np.int64), np.minimum(na, nb)
    while (open_ := lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = h.of(a, mid) == h.of(b, mid)
        lo = np.where(open_ & same, mid, lo)
        hi = np.where(open_ & ~same, mid - 1, hi)
    return lo


def suffix_sort(data: np.ndarray, start: np.ndarray, size: np.ndarray,
                group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort strings (``start`` and ``size`` in ``data``) within contiguous groups.  Returns
    the order and each string's common prefix with the one before (-1: first of a group)."""
    n = len(start)
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[begins, n])
    g_at, g_n = np.repeat(begins, sizes), np.repeat(sizes, sizes)
    h = PrefixHash(data, _BASES[0])
    padded = np.r_[data, np.zeros(1, np.uint8)]

    def before(x, y, or_same):
        """Whether string y stands before string x."""
        ext = _extension(h, start[x], size[x], start[y], size[y])
        ends = ext == np.minimum(size[x], size[y])
        less = np.where(ends, size[y] < size[x], padded[start[y] + ext] < padded[start[x] + ext])
        return less | (or_same & ends & (size[x] == size[y]))

    order, width = np.arange(n), 1
    while n and width < sizes.max():
        at = np.flatnonzero(g_n > width)
        q = at - g_at[at]
        block = g_at[at] + q // (2 * width) * (2 * width)
        second = q // width % 2 == 1
        end = g_at[at] + g_n[at]
        lo = np.minimum(np.where(second, block, block + width), end)
        hi = np.minimum(np.where(second, block + width, block + 2 * width), end)
        base = lo.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            left = before(order[at[open_]], order[mid], second[open_])
            lo[open_] = np.where(left, mid + 1, lo[open_])
            hi[open_] = np.where(left, hi[open_], mid)
        target = block + (q - (block - g_at[at])) % width + (lo - base)
        merged = order.copy()
        merged[target] = order[at]
        order, width = merged, 2 * width
    common, right = _neighbours(padded, start, size, g_at, order)
    if not right:   # a hash collision misled the sort: compare the bytes themselves
        raw = data.tobytes()
        order = np.array(sorted(range(n), key=lambda i: (g_at[i], raw[start[i]:start[i] + size[i]])),
                         np.int64)
        common, _ = _neighbours(padded, start, size, g_at, order)
    return order, common


def _neighbours(padded, start, size, g_at, order) -> tuple[np.ndarray, bool]:
    """Common prefixes of neighbours, byte by byte, and whether the order holds."""
    common = np.full(len(order), -1, np.int64)
    if len(order) < 2:
        return common, True
    inside = np.flatnonzero(g_at[order[1:]] == g_at[order[:-1]]) + 1
    x, y = order[inside - 1], order[inside]
    most = np.minimum(size[x], size[y])
    ext, open_ = np.zeros(len(x), np.int64), np.arange(len(x))
    step = np.arange(16)
    while len(open_):
        a = padded[np.minimum(start[x[open_], None] + ext[open_, None] + step, len(padded) - 1)]
        b = padded[np.minimum(start[y[open_], None] + ext[open_, None] + step, len(padded) - 1)]
        run = np.where((a == b).all(1), 16, (a != b).argmax(1))
        ext[open_] += run
        open_ = open_[(run == 16) & (ext[open_] < most[open_])]
    ext = np.minimum(ext, most)
    common[inside] = ext
    ends = ext == most
    good = np.where(ends, size[x] <= size[y], padded[start[x] + ext] < padded[start[y] + ext])
    return common, bool(good.all())


def settle_group(data: np.ndarray, start: np.ndarray, count: np.ndarray, off: np.ndarray,
                 group: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Strings of contents in contiguous anchor groups that an earlier content also has:
    arrays of row, first string, strings.  ``rank`` orders the places."""
    size = count + (length - 1)
    after, common_after = suffix_sort(data, start + off, size - off, group)
    # Reversed, what lies before an anchor is a suffix too.
    before, common_before = suffix_sort(data[::-1], len(data) - (start + off), off, group)
    by_rank = np.argsort(rank, kind="stable")
    flags = np.zeros((len(start), int(count.max(initial=0)) + 1), bool)
    cls_a, cls_b = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
    for back in range(int(off.max(initial=-1)) + 1):
        first = off - back                     # the string that starts ``back`` before the anchor
        has = (first >= 0) & (first < count)
        rows = by_rank[has[by_rank]]
        if len(rows) < 2:
            continue
        cls_a[after] = np.cumsum(common_after < length - back)
        cls_b[before] = np.cumsum(common_before < back)
        key = cls_a[rows] * np.int64(len(start) + 1) + cls_b[rows]
        at = np.argsort(key, kind="stable")
        new = np.r_[True, key[at][1:] != key[at][:-1]]
        lead = rank[rows[at]][np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        later = rows[at][rank[rows[at]] > lead]
        flags[later, first[later]] = True
    edge = np.diff(np.c_[np.zeros(len(start), bool), flags].astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    return row, begin, end - begin


def _sorted_places(frame: pd.DataFrame) -> np.ndarray:
    """Dense rank of the rows' places: id (null last), text of the id, position."""
    place = np.lexsort((frame["start"], frame["k"], frame["id"], frame["blank"]))
    cols = frame[["blank", "id", "k", "start"]].to_numpy(np.int64)[place]
    new = np.r_[False, (cols[1:] != cols[:-1]).any(1)]
    rank = np.empty(len(frame), np.int64)
    rank[place] = np.cumsum(new)
    return rank


_SPAN = "doc_id long, k int, p long, n int"


def _sort_groups(length: int):
    """Rows in order of the anchor; whole groups are sorted together, a bounded number of
    rows at a time."""
    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame[frame.groupby("g")["g"].transform("size") > 1].reset_index(drop=True)
        if frame.empty:
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("doc_id", "k", "p", "n")})
        size = frame["bytes"].str.len().to_numpy(np.int64)
        data = np.frombuffer(b"".join(frame["bytes"]), np.uint8)
        start = np.cumsum(size) - size
        row, first, n = settle_group(data, start, frame["count"].to_numpy(np.int64),
                                     frame["off"].to_numpy(np.int64), frame["g"].to_numpy(),
                                     _sorted_places(frame), length)
        ids = frame["id"].where(~frame["blank"]).astype("Int64")
        return pd.DataFrame({"doc_id": ids.array.take(row), "k": frame["k"].to_numpy()[row],
                             "p": frame["start"].to_numpy()[row] + first, "n": n})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= _SORT_ROWS:
                frame = pd.concat(held, ignore_index=True)
                open_ = frame["g"] == frame["g"].iloc[-1]
                yield settle(frame[~open_])
                held = [frame[open_]]
                rows = int(open_.sum())
        if held:
            yield settle(pd.concat(held, ignore_index=True))
    return run


def _string_hashes(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["bytes"].str.len().to_numpy(np.int64)
            data = np.frombuffer(b"".join(batch["bytes"]), np.uint8)
            count = batch["count"].to_numpy(np.int64)
            row = np.repeat(np.arange(len(batch)), count)
            j = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            at = (np.cumsum(size) - size)[row] + j
            ids = batch["id"].where(~batch["blank"]).astype("Int64")
            yield pd.DataFrame({
                "h1": mixed(PrefixHash(data, _BASES[0]).of(at, length)).view(np.int64),
                "h2": mixed(PrefixHash(data, _BASES[1]).of(at, length)).view(np.int64),
                "doc_id": ids.array.take(row), "k": batch["k"].to_numpy()[row],
                "p": batch["start"].to_numpy()[row] + j})
    return run


def _hot_spans(contents: DataFrame, length: int) -> DataFrame:
    strings = contents.mapInPandas(_string_hashes(length),
                                   "h1 long, h2 long, doc_id long, k int, p long")
    place = F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "k", "p")
    first = strings.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    return (strings.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
            .select("doc_id", "k", "p", F.lit(1).alias("n")))


def numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, k, text``: k tells different texts of one id apart (0 if there is one)."""
    docs = docs.withColumn("th", F.xxhash64("text"))
    more = (docs.select("doc_id", "th").distinct().groupBy("doc_id")
            .agg(F.sort_array(F.collect_list("th")).alias("all")).where(F.size("all") > 1))
    more = stored(more.select(F.col("doc_id").alias("__i"), F.posexplode("all").alias("k", "__t")),
                  "suffix-texts")
    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("th") == F.col("__t"))
    return docs.join(more, same, "left").select(
        "doc_id", F.coalesce("k", F.lit(0)).alias("k"), "text")


def _free(docs: DataFrame) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps, whose results are
    stored: at scale they are as large as the input."""
    gc.collect()
    docs.sparkSession.sparkContext._jvm.System.gc()


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """``doc_id, k, p, n``: runs of n strings of ``length`` bytes, the first at byte p, that
    start earlier elsewhere; of numbered documents (see ``numbered``)."""
    if not 1 <= gram <= length <= 127:
        raise ValueError("strings have up to 127 bytes and anchors no more than strings")
    spark = docs.sparkSession
    found = docs.mapInArrow(_find(length, gram, PIECE), "g long, c long, doc_id long, k int, loc long")
    order = ["g", "c", F.col("doc_id").asc_nulls_last(), "k", "loc"]
    # The setting holds for the whole plan: texts on one side, narrow rows on the other.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    ranged = found.repartitionByRange(*order).sortWithinPartitions(*order)
    first = stored(ranged.mapInArrow(
        _settle_sorted, "g long, doc_id long, k int, loc long, settled boolean"), "suffix-first")
    del found, ranged
    _free(docs)
    start = F.shiftright("loc", _HALF)
    count = F.shiftright("loc", 7).bitwiseAND(127).cast("int")
    off = F.col("loc").bitwiseAND(127).cast("int")
    done = first.where("settled").select("doc_id", "k", start.alias("p"), count.alias("n"))
    open_ = first.where("not settled")
    wanted = open_.groupBy(F.col("doc_id").alias("__i"), F.col("k").alias("__k")).agg(
        F.collect_set(F.struct("g", start.alias("start"), count.alias("count"), off.alias("off")))
        .alias("want"))
    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("k") == F.col("__k"))
    raw = docs.join(wanted, same).select("doc_id", "k", "want",
                                         F.encode("text", "utf-8").alias("raw"))
    contents = raw.select("doc_id", "k", F.explode(F.transform("want", lambda w: F.struct(
        w["g"].alias("g"), w["start"].alias("start"), w["count"].alias("count"),
        w["off"].alias("off"), F.substring(
            F.col("raw"), (w["start"] + 1).cast("int"), w["count"] + (length - 1)).alias("bytes"))))
        .alias("w"))
    contents = stored(contents.select(
        "w.g", F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"),
        F.col("doc_id").isNull().alias("blank"), "k", "w.start", "w.count", "w.off", "w.bytes"),
        "suffix-contents")
    _free(docs)
    heavy = stored(open_.groupBy("g").count().where(F.col("count") > hot).select("g"),
                   "suffix-hot")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    normal = contents.join(heavy, "g", "left_anti").repartition("g").sortWithinPartitions("g")
    spans = done.unionByName(stored(normal.mapInPandas(_sort_groups(length), _SPAN),
                                    "suffix-sorted"))
    if not heavy.isEmpty():
        spans = spans.unionByName(stored(_hot_spans(contents.join(heavy, "g", "left_semi"),
                                                    length), "suffix-hot-spans"))
    _free(docs)
    return spans


_CUT = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                     T.StructField("kept", T.BinaryType())])


def cut(text: str | None, spans, length: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the bytes that stay."""
    raw = (text or "").encode()
    if spans is None or not len(spans):
        return 0, 0, raw
    edge = np.zeros(len(raw) + 1, np.int64)
    start = np.fromiter((s["p"] for s in spans), np.int64, len(spans))
    end = start + np.fromiter((s["n"] for s in spans), np.int64, len(spans)) + length - 1
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    gone = np.cumsum(edge)[:-1] > 0
    runs = int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]]))
    return int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: a cut
    may fall inside a character)."""
    rows = numbered(id_and_text(docs, id_col, text_col))
    spans = (repeated_spans(rows, length, gram, hot)
             .groupBy(F.col("doc_id").alias("__i"), F.col("k").alias("__k"))
             .agg(F.collect_list(F.struct("p", "n")).alias("spans")))
    small_batches(docs.sparkSession)

    @F.pandas_udf(_CUT)
    def apply(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut(t, s, length) for t, s in zip(texts, spans, strict=True)],
                            columns=["n_removed", "n_spans", "kept"])

    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("k") == F.col("__k"))
    return (rows.join(spans, same, "left")
            .select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
                    .alias("n_bytes"), apply("text", "spans").alias("c"))
            .select("doc_id", "n_bytes", "c.*"))

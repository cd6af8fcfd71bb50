"""SimHash near-duplicates through deletion-variant signatures.

A text's fingerprint is the bitwise majority of its word shingles' XXH64.  Two
fingerprints that differ in at most three of 64 bits differ in at most one bit in one of
two 32-bit segments, so each distinct fingerprint is indexed under the variants of its
segments with one bit made a wildcard (64 keys).  Equal keys bring candidates together;
the full bit distance is then checked.

Only distinct fingerprints are indexed (copies never meet), a bucket emits the links of a
spanning forest and not its pairs, and a bucket of more than ``bucket`` fingerprints is
cut again: its members get variant keys over the bits that the bucket has not fixed yet,
and go to the next round.  Every round halves the free bits, so buckets end up small
whatever the data; no link is lost.

Defined cases: a null or empty text has fingerprint zero and links like any other; fewer
words than a shingle are one shingle; ties of the smallest id do not matter; repeated
rows stay and share a component; null ids come last (a component of null ids only has a
null component id); an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.llm.common import (WORD_RE, big_batches, id_and_text, lower_ascii, small_batches,
                               stored)
from harrow.llm.graph import components

SEED = 42
BUCKET = 2048
_CHUNK = 8192


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit majority fingerprint of one text."""
    words = WORD_RE.findall(lower_ascii(text or ""))
    if not words:
        return 0
    if len(words) < shingle:
        grams = [" ".join(words)]
    else:
        grams = list(map(" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[i:i + _CHUNK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, th`` (a hash that tells rows of one id apart), ``fp`` (signed long)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.fromiter((fingerprint(t, shingle) for t in batch), np.uint64,
                                        len(batch)).view(np.int64))

    return id_and_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("th"), prints("text").alias("fp"))


def _variants(rows: DataFrame, first: bool) -> DataFrame:
    """One-wildcard variants over the free bits ``[lo, lo + width)``, cut in two halves.
    The other half stays free.  ``key`` is a hash; a collision only adds candidates."""
    half = "(width div 2)" if first else "greatest(width div 2, 1)"
    cut = rows.withColumn("v", F.expr("explode(sequence(0, greatest(width, 1) - 1))"))
    cut = (cut.withColumn("s", F.expr(f"v div {half}"))
           .withColumn("size", F.expr(f"if(s = 0, {half}, width - {half})")))
    part = ("shiftrightunsigned(fp, cast(lo + s * " + half + " as int)) & "
            "(shiftleft(1L, cast(size as int)) - 1) & "
            "~shiftleft(1L, cast(v - s * " + half + " as int))")
    return cut.select(F.expr(f"xxhash64(key, v, {part})").alias("key"), "fp",
                      F.expr(f"cast(if(s = 0, lo + {half}, lo) as int)").alias("lo"),
                      F.expr(f"cast(if(s = 0, width - {half}, {half}) as int)").alias("width"))


_OUT = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                     T.StructField("key", T.LongType()), T.StructField("lo", T.IntegerType()),
                     T.StructField("width", T.IntegerType())])


def _forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is within the distance, one fewer than members at most."""
    group = np.arange(len(fp))
    out = []
    for i in range(1, len(fp)):
        near = np.flatnonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= max_bits)
        if len(near):
            names, at = np.unique(group[near], return_index=True)
            out += [(fp[i], fp[near[j]]) for j in at]
            group[:i][np.isin(group[:i], names)] = i
    return out


def _link_buckets(max_bits: int, bucket: int):
    """A pass over rows sorted by key: verified links of the buckets, and the members of
    buckets that are too large, to be cut again.  Holds one batch and ``bucket`` rows."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()),
                        ("lo", pa.int32()), ("width", pa.int32())])

    def again(cols):
        key, fp, lo, width = cols
        return pa.RecordBatch.from_arrays(
            [pa.array(fp), pa.nulls(len(fp), pa.int64()), pa.array(key), pa.array(lo),
             pa.array(width)], schema=schema)

    def links(pairs):
        n = len(pairs)
        a = np.array([p[0] for p in pairs], np.int64)
        b = np.array([p[1] for p in pairs], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
             pa.nulls(n, pa.int32())], schema=schema)

    def run(batches):
        held = None          # rows of the last key seen, which may go on
        large = None         # a key already found to be too large
        for batch in batches:
            cols = [batch.column(n).to_numpy(zero_copy_only=False)
                    for n in ("key", "fp", "lo", "width")]
            if large is not None:
                n = int(np.count_nonzero(cols[0] == large))
                if n:
                    yield again([c[:n] for c in cols])
                    cols = [c[n:] for c in cols]
                if not len(cols[0]):
                    continue
                large = None
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            key = cols[0]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            ends = np.r_[starts[1:], len(key)]
            yield from settle(cols, starts[:-1], ends[:-1])
            held = [c[starts[-1]:] for c in cols]
            if len(held[0]) > bucket:
                yield again(held)
                large, held = held[0][0], None
        if held is not None:
            yield from settle(held, np.array([0]), np.array([len(held[0])]))

    def settle(cols, starts, ends):
        fp, sizes = cols[1], ends - starts
        two = starts[sizes == 2]
        ok = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
        pairs = list(zip(fp[ok], fp[ok + 1], strict=True))
        for s, e in zip(starts[sizes > 2], ends[sizes > 2], strict=True):
            if e - s > bucket:
                yield again([c[s:e] for c in cols])
            else:
                pairs += _forest(fp[s:e], max_bits)
        if pairs:
            yield links(pairs)

    return run


def links(prints: DataFrame, max_bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints (column ``fp``) within
    ``max_bits`` (0 to 3) of each other."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with one wildcard find up to 3 differing bits")
    big_batches(prints.sparkSession)
    # A row becomes 64, so the distinct fingerprints stay spread over all partitions.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = prints.select("fp").distinct().repartition(parts, "fp").select(
        F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("lo"), F.lit(64).alias("width"))
    found, first = None, True
    while True:
        keyed = _variants(todo, first).repartition("key").sortWithinPartitions("key")
        out = stored(keyed.mapInArrow(_link_buckets(max_bits, bucket), _OUT), "simhash-links")
        part = out.where("b is not null").select("a", "b").distinct()
        found = part if found is None else found.union(part)
        todo = out.where("b is null").select("key", F.col("a").alias("fp"), "lo", "width")
        first = False
        if todo.isEmpty():
            return found
        # Free bits are gone: what is left differs in wildcards only, a few per bucket.
        if todo.agg(F.max("width")).first()[0] <= 1:
            bucket = 1 << 20


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                       bucket: int = BUCKET, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, th, fp, root`` (the group's key, a fingerprint)
    and ``component_id`` (the smallest id of the group)."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = components(links(distinct, max_bits, bucket), "simhash-components")
    rooted = (distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "low"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(rooted.join(lowest, "root").select("fp", "root", "component_id"),
                   "simhash-named")
    return rows.join(named, "fp").select("doc_id", "th", "fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of one document of each group (the smallest id), with all their columns.
    A repeated row stays once."""
    groups = simhash_components(docs, shingle, max_bits, id_col=id_col, text_col=text_col)
    kept = (groups.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th")).alias("k"))
            .select(F.col("k.doc_id").alias("__id"), F.col("k.th").alias("__th")))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("__row"), F.col(id_col).cast("long").alias("__i"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("__t"))
    match = F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__th"))
    return (rows.join(kept.hint("merge"), match, "left_semi").dropDuplicates(["__i", "__t"])
            .select("__row.*"))

"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text is its sequence of words.  Every ``gram`` consecutive words are hashed and in each
run of ``window - gram + 1`` grams (``window`` words) the smallest hash is kept, so two
texts that share ``window`` consecutive words share the fingerprint of that window, on
both sides, wherever it stands.  Documents and benchmark are joined on fingerprints; a hit
is extended to the word windows that chose it, and those are compared in full as text.

An item of fewer than ``window`` words is one window of its own length; documents get
plain hashes of that length only when the benchmark has such items (nine lengths at most).

Fingerprints and the hit windows are written to the shared folder: the benchmark's own
tables then have a known size, and the planner broadcasts them only below its threshold
and shuffles (splitting skewed keys) beyond.  A window that many items share is one row
with its items, a common passage in the documents is only as many rows as it has words.

Defined cases: null text has no words and is clean; repeated rows each get their result;
null document ids are kept; items without words hit nothing; items with a null id mark
words but are not counted or listed; an item id given twice counts once; empty tables on
either side give clean rows or no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import id_and_text, lower_ascii_col, stored

WINDOW = 10
GRAM = 5
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_col(text: Column) -> Column:
    """Lower-cased (A-Z) runs of digits, letters and anything beyond ASCII."""
    return F.array_remove(F.split(lower_ascii_col(F.coalesce(text, F.lit(""))), _GAP), "")


def _grams(hashes: Column, n: int, *seed: Column) -> Column:
    """Hashes of every n consecutive entries."""
    usable = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (n - 1), F.lit(0)))
    return F.transform(usable, lambda x, i: F.xxhash64(
        *seed, x, *[F.get(hashes, i + j) for j in range(1, n)]))


def _choices(grams: Column, span: int) -> Column:
    """The smallest of every ``span`` consecutive gram hashes."""
    if span == 1:
        return grams
    usable = F.slice(grams, F.lit(1), F.greatest(F.size(grams) - (span - 1), F.lit(0)))
    return F.transform(usable, lambda x, i: F.least(
        x, *[F.get(grams, i + j) for j in range(1, span)]))


def _starts(choices: Column) -> Column:
    """Where the choice changes: the fingerprint and its first window."""
    return F.filter(
        F.transform(choices, lambda x, i: F.when(
            (i == 0) | (x != F.get(choices, i - 1)),
            F.struct(x.alias("fp"), i.cast("int").alias("first")))),
        lambda s: s.isNotNull())


def _runs(starts: Column, windows: Column, size: int) -> Column:
    """Windows that follow each other with the same fingerprint as one struct: the
    fingerprint, first window, last window, words of a window."""
    return F.transform(starts, lambda s, i: F.struct(
        s["fp"].alias("fp"), s["first"].alias("first"),
        (F.coalesce(F.get(starts, i + 1)["first"], windows) - 1).alias("last"),
        F.lit(size).alias("size")))


def _single_runs(grams: Column, size: int) -> Column:
    """Runs of one window each, for the rare lengths below a whole window."""
    return F.transform(grams, lambda x, i: F.struct(
        x.alias("fp"), i.cast("int").alias("first"), i.cast("int").alias("last"),
        F.lit(size).alias("size")))


def _fingerprinted(rows: DataFrame, window: int, gram: int, short: list[int],
                   keep: list[str]) -> DataFrame:
    """``keep``, ``n_words`` and ``runs`` of rows that have a ``words`` column."""
    step = rows.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    step = step.select(*keep, F.size("words").cast("long").alias("n_words"), "h",
                       _grams(F.col("h"), gram).alias("g"))
    step = step.select(*keep, "n_words", "h", _choices(F.col("g"), window - gram + 1).alias("m"))
    # A column of its own: inside a lambda it would be evaluated for every element.
    step = step.select(*keep, "n_words", "h", F.size("m").alias("c"), _starts(F.col("m")).alias("s"))
    runs = [_runs(F.col("s"), F.col("c"), window)]
    runs += [_single_runs(_grams(F.col("h"), n, F.lit(n)), n) for n in short]
    return step.select(*keep, "n_words", F.concat(*runs).alias("runs"))


def _window_texts(words: Column, runs: Column) -> Column:
    """All windows of the runs: position, words, text."""
    return F.flatten(F.transform(runs, lambda r: F.transform(
        F.sequence(r["first"], r["last"]), lambda p: F.struct(
            p.alias("pos"), r["size"].alias("size"), r["fp"].alias("fp"),
            F.array_join(F.slice(words, p + 1, r["size"]), " ").alias("words")))))


def benchmark_windows(bench: DataFrame, window: int, gram: int, item_col: str,
                      text_col: str) -> tuple[DataFrame, list[int]]:
    """One row per distinct window text: its fingerprint, words and item ids; and the
    lengths below ``window`` that occur."""
    items = (bench.select(F.col(item_col).cast("string").alias("item"),
                          words_col(F.col(text_col).cast("string")).alias("words"))
             .where(F.size("words") > 0))
    short = [r[0] for r in items.where(F.size("words") < window)
             .select(F.size("words")).distinct().orderBy(F.size("words")).collect()]
    prints = _fingerprinted(items, window, gram, short, ["item", "words"])
    own = F.filter("runs", lambda r: r["size"] == F.least(F.col("n_words"), F.lit(window)))
    rows = prints.select("item", F.explode(_window_texts(F.col("words"), own)).alias("w"))
    found = (rows.select("item", "w.*").groupBy("words", "size", "fp")
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    return stored(found, "winnow-benchmark"), short


def find_overlaps(docs: DataFrame, bench: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  bench_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: every document's ``doc_id, th, n_words`` (repeated rows repeat), and
    the verified hits ``doc_id, th, pos, size, items``, one row per hit window."""
    if not 1 <= gram <= window:
        raise ValueError("a gram has between one word and the window's")
    known, short = benchmark_windows(bench, window, gram, item_col, bench_text_col)
    rows = id_and_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    prints = stored(_fingerprinted(rows.withColumn("words", words_col(F.col("text"))),
                                   window, gram, short, ["doc_id", "th"]), "winnow-docs")
    hits = (prints.select("doc_id", "th", F.explode("runs").alias("r"))
            .join(known.select("fp").distinct(), F.col("r.fp") == F.col("fp"), "left_semi")
            .groupBy("doc_id", "th").agg(F.collect_set("r").alias("runs"))
            .select(F.col("doc_id").alias("__i"), F.col("th").alias("__t"), "runs"))
    hits = stored(hits, "winnow-hits")
    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("th") == F.col("__t"))
    # Always by a shuffle: documents with hits grow with the corpus, so a plan that sends
    # them to every executor at small sizes would not tell how it behaves at large ones.
    near = (rows.join(hits.hint("merge"), same).select("doc_id", "th", "runs",
                                         words_col(F.col("text")).alias("words"))
            .select("doc_id", "th", F.explode(_window_texts(F.col("words"), F.col("runs")))
                    .alias("w")).select("doc_id", "th", "w.pos", "w.size", "w.words"))
    full = near.join(known.select("words", "size", "items"), ["words", "size"])
    return (prints.select("doc_id", "th", "n_words"),
            stored(full.select("doc_id", "th", "pos", "size", "items"), "winnow-full"))


def contamination(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit`` (words inside a hit window),
    ``n_items``, ``items`` (sorted ids) and ``contaminated``."""
    base, hits = find_overlaps(docs, bench, **options)
    key = ["doc_id", "th"]
    covered = F.aggregate(
        F.array_sort("at"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda a, w: F.struct(
            (a["n"] + F.greatest(F.lit(0), w["pos"] + w["size"] - F.greatest(a["to"], w["pos"])))
            .alias("n"), F.greatest(a["to"], w["pos"] + w["size"]).alias("to")))
    words = (hits.groupBy(*key).agg(F.collect_set(F.struct("pos", "size")).alias("at"))
             .select(*key, covered["n"].alias("n_hit")))
    items = (hits.select(*key, F.explode("items").alias("item")).distinct()
             .groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items")))
    found = (words.withColumn("items", F.array().cast("array<string>")).unionByName(
        items.withColumn("n_hit", F.lit(0).cast("long")))
        .groupBy(*key).agg(F.max("n_hit").alias("n_hit"),
                           F.flatten(F.collect_list("items")).alias("items"))
        .select(F.col("doc_id").alias("__i"), F.col("th").alias("__t"), "n_hit", "items"))
    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("th") == F.col("__t"))
    return (base.join(found, same, "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    "items", (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **options) -> DataFrame:
    """The rows without a hit window, with all their columns."""
    _, hits = find_overlaps(docs, bench, id_col=id_col, text_col=text_col, **options)
    bad = stored(hits.select(F.col("doc_id").alias("__i"), F.col("th").alias("__t")).distinct(),
                 "winnow-bad")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("__row"), F.col(id_col).cast("long").alias("__id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("__th"))
    same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t"))
    return rows.join(bad.hint("merge"), same, "left_anti").select("__row.*")

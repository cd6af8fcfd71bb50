"""Ranked lexical search by scanning documents with one automaton of all query terms.

Queries (items) are few and known; documents are many and get no index.  The distinct terms of
all items form an Aho-Corasick automaton whose patterns are guarded by a boundary on both
sides, so that only whole terms match.  Every document is scanned once, and the automaton's
outputs are its term frequencies.  From those follow, in Spark, each term's document frequency
and the length statistics, and then the scores of a document for all items that share a term
with it: the frequencies of a batch of documents are spread over the items of each term and
summed up.

Only the best ``k`` documents of an item leave a task, and only those that reach the ``k``-th
best score of a seed of ``SEED_DOCS`` documents: a bound from below on the final ``k``-th score,
so that what is exchanged does not grow with the number of tasks.  The result is exact.

The automaton is broadcast in blocks of ``BLOCK_TERMS`` terms; more terms are more scans with
one automaton each, never a larger broadcast.  Items are scored in blocks of ``BLOCK_ITEMS``,
halved until a block's (item, term) links are no more than ``BLOCK_LINKS`` or it is one item.

Scores are integers: a term's weight is floor(1000 * ln((2N + 2) / (2df + 1))), its share
(10^9 * tf) div (1000 * tf + 20 * m), m = 50 + (50 * n * N) div L.

Defined cases: null texts have no terms, count in no statistic and are never found; items
without terms have no rows; item rows with the same id are one item with the terms of all;
documents with the same id or text are ranked one by one, equal scores by ascending id, a null
id first, and no document twice for one row.  Empty tables give an empty result.  Very long
texts are scanned whole.  Only the named columns are read, whatever others are called."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harrow.llm.common import id_and_text, lower_ascii_col, stored
from harrow.operators.rank import global_row_number

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 200_000
BLOCK_ITEMS = 2_000
SEED_DOCS = 20_000
BLOCK_LINKS = 2_000_000
# Documents times items, and frequencies spread over items, that a task holds at a time.
CELLS = 1 << 21
SPREAD = 1 << 22
# Stands for a null id in a task's arrays, before all others.
NO_ID = -(1 << 63)

# Every byte to its own term byte, or to the boundary: ASCII letters in lower case, digits and
# all bytes of longer characters stay.
_IN_TERM = [chr(b).isalnum() if b < 128 else True for b in range(256)]
_GUARDED = bytes(ord(chr(b).lower()) if b < 128 and _IN_TERM[b] else b if _IN_TERM[b] else 32
                 for b in range(256))


def guarded(text: str) -> str:
    """The text's UTF-8 bytes with a boundary for everything outside terms, one character a
    byte, and a boundary at both ends."""
    return " " + text.encode("utf-8", "replace").translate(_GUARDED).decode("latin-1") + " "


class TermScanner:
    """Term frequencies of a text for the terms of one block."""

    def __init__(self, numbers: list[int], terms: list[str]):
        self.automaton = ahocorasick.Automaton()
        for number, term in zip(numbers, terms, strict=True):
            self.automaton.add_word(f" {term.encode('utf-8', 'replace').decode('latin-1')} ", number)
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, Counter]:
        """All terms of the text, with repeats, and how often each known one occurs."""
        line = guarded(text)
        # An automaton without patterns cannot be asked.
        found = self.automaton.iter(line) if len(self.automaton) else ()
        return len(line.split()), Counter(n for _, n in found)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct ``(item, term)`` pairs, with the terms numbered from 0 and the items too:
    ``terms (number, term)`` and ``links (item_number, item, number)``."""
    pairs = items.select(F.col(f"`{id_col}`").alias("item"), F.explode(F.array_distinct(
        F.regexp_extract_all(lower_ascii_col(F.col(f"`{text_col}`").cast("string")),
                             F.lit(f"({TERM})"), F.lit(1)))).alias("term")).distinct()
    pairs = stored(pairs, "item-terms")
    # Terms of the items only, numbered without a window over all of them.
    terms = stored(global_row_number(pairs.select("term").distinct(), ["term"], "number")
                   .select((F.col("number") - 1).alias("number"), "term"), "terms")
    named = stored(global_row_number(pairs.select("item").distinct(), ["item"], "number")
                   .select((F.col("number") - 1).alias("item_number"), "item"), "items")
    same = F.col("p.item").eqNullSafe(F.col("n.item"))
    links = (pairs.alias("p").join(named.alias("n"), same).join(terms.alias("t"), F.col("p.term")
             == F.col("t.term")).select("item_number", "n.item", "number"))
    return terms, stored(links, "links")


def term_frequencies(docs: DataFrame, terms: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) with a term: ``n`` (its terms), ``block`` and the
    known terms of the block with their frequencies, as two arrays."""
    count = terms.count()
    out = None
    if count > block_terms:
        # Row numbers must be the same in every scan.
        docs = stored(docs, "texts")
    for block, start in enumerate(range(0, max(count, 1), block_terms)):
        chosen = terms.where((F.col("number") >= start) & (F.col("number") < start + block_terms)) \
            .orderBy("number").collect()
        numbers, words = [r["number"] for r in chosen], [r["term"] for r in chosen]
        scan = _scan_with(docs.sparkSession.sparkContext.broadcast((numbers, words)))
        found = docs.select("row", "doc_id", F.lit(block).alias("block"), scan("text").alias("__f")) \
            .select("row", "doc_id", "block", "__f.*").where("n > 0")
        out = found if out is None else out.unionByName(found)
    return out


def _scan_with(known):
    @F.pandas_udf("n long, terms array<int>, tf array<long>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = TermScanner(*known.value)
        for batch in texts:
            rows = []
            for text in batch:
                n, tf = scanner.scan(text) if text is not None else (0, {})
                order = sorted(tf)
                rows.append((n, order, [tf[t] for t in order]))
            yield pd.DataFrame(rows, columns=["n", "terms", "tf"])

    return scan


class Scorer:
    """Scores of batches of documents for a block of items."""

    def __init__(self, terms: np.ndarray, items: np.ndarray, weights: dict[int, int],
                 n_items: int, docs: int, total: int):
        # Links sorted by term: the items of a term are one stretch.
        order = np.argsort(terms, kind="stable")
        self.items = items[order]
        self.terms, starts, counts = np.unique(terms[order], return_index=True, return_counts=True)
        self.starts, self.counts = starts, counts
        self.weights = np.array([weights[int(t)] for t in self.terms], dtype=np.int64)
        self.n_items, self.docs, self.total = n_items, docs, total

    def score(self, lengths: np.ndarray, rows: np.ndarray, terms: np.ndarray,
              tf: np.ndarray) -> np.ndarray:
        """Scores (documents x items): ``rows``, ``terms`` and ``tf`` are the frequencies of
        all documents of the batch, one entry per document and term."""
        out = np.zeros((len(lengths), self.n_items))
        if not len(self.terms) or not len(rows):
            return out.astype(np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        rows, at, tf = rows[known], at[known], tf[known]
        m = 50 + np.array([(50 * int(n) * self.docs) // self.total for n in lengths], dtype=np.int64)
        part = self.weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[rows]))
        reach = self.counts[at]
        # Every entry once for each item of its term.
        entry = np.repeat(np.arange(len(at)), reach)
        offset = np.arange(len(entry)) - np.repeat(np.cumsum(reach) - reach, reach)
        cell = rows[entry] * self.n_items + self.items[self.starts[at[entry]] + offset]
        # Whole numbers far below 2 ** 53: their sums are exact in doubles.
        sums = np.bincount(cell, weights=part[entry], minlength=out.size)
        return sums.astype(np.int64).reshape(out.shape)


def _best(k: int, items, ids, rows, scores):
    """The best ``k`` of each item: highest score, then smallest id, then row."""
    order = np.lexsort((rows, ids, -scores, items))
    items, ids, rows, scores = items[order], ids[order], rows[order], scores[order]
    keep = np.arange(len(items)) - np.searchsorted(items, items) < k
    return items[keep], ids[keep], rows[keep], scores[keep]


def _best_in_tasks(known, k: int):
    """For mapInPandas over stored frequencies: the best of each item in one task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, floor = known.value
        least = np.maximum(floor, 1)
        # No document reaches more cells than there are links.
        step = max(1, min(CELLS // max(scorer.n_items, 1), SPREAD // max(len(scorer.items), 1)))
        best = tuple(np.zeros(0, np.int64) for _ in range(4))
        for pdf in batches:
            for i in range(0, len(pdf), step):
                part = pdf.iloc[i:i + step]
                sizes = part["terms"].map(len).to_numpy(np.int64)
                rows = np.repeat(np.arange(len(part)), sizes)
                scores = scorer.score(part["n"].to_numpy(np.int64), rows,
                                      _flat(part["terms"]), _flat(part["tf"]))
                doc, item = np.nonzero(scores >= least[None, :])
                if not len(doc):
                    continue
                ids = part["doc_id"].fillna(NO_ID).astype("int64").to_numpy()[doc]
                number = part["row"].to_numpy(np.int64)[doc]
                best = _best(k, *(np.concatenate(p) for p in zip(
                    best, (item, ids, number, scores[doc, item]), strict=True)))
                # An item with k documents asks for its k-th score from now on.
                last = np.flatnonzero(np.r_[best[0][1:] != best[0][:-1], True])
                last = last[np.bincount(best[0])[best[0][last]] >= k]
                least[best[0][last]] = np.maximum(least[best[0][last]], best[3][last])
        yield pd.DataFrame({"item_number": best[0], "doc_id": best[1], "row": best[2],
                            "score": best[3]})
    return run


def _flat(arrays: pd.Series) -> np.ndarray:
    parts = [np.asarray(a, dtype=np.int64) for a in arrays if len(a)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


FOUND = "item_number long, doc_id long, row long, score long"


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS,
           seed_docs: int = SEED_DOCS) -> DataFrame:
    """The ``k`` best documents of every item: ``item_col``, ``rank`` (from 1), ``id_col`` and
    ``score``."""
    spark = docs.sparkSession
    terms, links = item_terms(items, item_col, item_text)
    # A row number of its own tells rows with the same id apart.
    rows = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    found = stored(term_frequencies(rows, terms, block_terms), "frequencies")
    # Every block lists all documents with a term: one block is enough for the lengths.
    totals = found.where("block = 0").agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
    if not totals["docs"]:
        return _named(spark.createDataFrame([], FOUND), links, k, id_col, item_col)
    frequencies = found.select(F.explode("terms").alias("number")).groupBy("number").agg(
        F.count("*").alias("df"))
    weighted = stored(links.join(frequencies, "number"), "weights")
    if found.where("block = 1").isEmpty():
        vectors = found
    else:
        # Blocks of one row meet again; its arrays are bounded by the terms of the items.
        vectors = stored(found.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n").alias("n"),
            F.flatten(F.collect_list("terms")).alias("terms"),
            F.flatten(F.collect_list("tf")).alias("tf")), "vectors")
    vectors = vectors.select("doc_id", "row", "n", "terms", "tf")
    share = min(1.0, seed_docs / totals["docs"])
    seed = vectors.where(F.shiftrightunsigned(F.xxhash64("row"), 11) < share * float(1 << 53))
    n_items = (links.agg(F.max("item_number")).first()[0] or 0) + 1
    out, start = None, 0
    while start < n_items:
        size, chosen = _item_block(weighted, start, min(block_items, n_items - start))
        df = chosen["df"].to_numpy(np.float64)
        weight = np.floor(1000 * np.log((2 * totals["docs"] + 2) / (2 * df + 1))).astype(np.int64)
        scorer = Scorer(chosen["number"].to_numpy(np.int64),
                        chosen["item_number"].to_numpy(np.int64) - start,
                        dict(zip(chosen["number"].tolist(), weight.tolist(), strict=True)),
                        size, totals["docs"], totals["total"])

        def best(frame, floor, scorer=scorer):
            known = spark.sparkContext.broadcast((scorer, floor))
            return frame.mapInPandas(_best_in_tasks(known, k), FOUND)

        floor = np.zeros(size, np.int64)
        if share < 1:
            # The k-th score of each item among the seed: a number per item of the block.
            reached = (_top(best(seed, floor), k).where(F.col("rank") == k)
                       .select("item_number", "score").collect())
            for r in reached:
                floor[r["item_number"]] = r["score"]
        part = best(vectors, floor).withColumn("item_number", F.col("item_number") + start)
        out = part if out is None else out.unionByName(part)
        start += size
    return _named(out, links, k, id_col, item_col)


def _item_block(weighted: DataFrame, start: int, size: int) -> tuple[int, pd.DataFrame]:
    """The links of ``size`` items from ``start`` on, or of fewer if they are too many."""
    while True:
        number = F.col("item_number")
        chosen = weighted.where((number >= start) & (number < start + size))
        if size == 1 or chosen.count() <= BLOCK_LINKS:
            return size, chosen.select("item_number", "number", "df").toPandas()
        size //= 2


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_number").orderBy(F.col("score").desc(), "doc_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _named(found: DataFrame, links: DataFrame, k: int, id_col: str, item_col: str) -> DataFrame:
    names = links.select("item_number", "item").distinct()
    doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return _top(found, k).join(names, "item_number").select(
        F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), doc.alias(id_col),
        "score")

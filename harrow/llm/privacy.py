"""Personal data and the terms that give it away.

Pattern spans (email, ip, card, phone) are found first; their normalised values are the
protected entities.  Corpus co-occurrence then says how much a term near an entity tells about
it.  What is left to learn of an entity once a term is known is ``-log2 P(entity | term)`` bits,
and the probability is the lower Wilson bound, over different texts, of the share of the term's
rows that hold the entity: three texts of three say 0.44 (1.19 bits), nine of nine 0.70 (0.51
bits), one of one only 0.21, whatever the size of the corpus.  So a pair needs ``LEAST_TEXTS``
different texts behind it, rarity alone flags nothing, and the same evidence gives the same
verdict in a corpus of any size.  Terms that leave ``REMOVE_BITS`` or less are removed, terms
that leave ``GENERALISE_BITS`` or less are replaced by the class of the word (a number, a name,
a word); both only near that entity, so a text without protected data is never changed.

Near is up to ``near`` words on either side of a span: pairs grow with the spans of a text, not
with spans times words.  All counts cover all documents.  Pattern spans and the words beside
them are found in one pass and kept once, in a narrow table; only entities of ``LEAST_TEXTS``
texts or more, the only ones that can be told, go on to pairs, and only terms of such pairs are
counted over all texts.  Counts are sums combined before the shuffle.  Flagged pairs come back
to the occurrences by a plain join, whose hot entities the planner may split.

Defined cases: null text is empty; repeated rows each get their spans and count as rows (but
as one text); ties need no order, as nothing is ranked; null ids are kept; empty tables give
empty results; very long texts are scanned whole, in linear time; extra columns are not read,
and ``sanitise`` keeps them whatever their names."""

from __future__ import annotations

import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.llm.common import WORD_RE, id_and_text, small_batches, stored

KINDS = ("email", "ip", "card", "phone", "term", "general")
BASE_KINDS = 4
LEAST_TEXTS = 3
NEAR = 64
Z = 1.96
# Bits left to learn of an entity: probabilities of at least 0.65 and 0.4.
REMOVE_BITS = 0.62
GENERALISE_BITS = 1.32
_FLUSH = 200_000
# Terms beside spans that leave a task at a time: those of one text more at most.
NEAR_TERMS = 20_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_EDGES = string.punctuation + "«»“”‘’„…–—¡¿"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address starts at the run of local characters before its ``@``; runs never
    cross another ``@`` or the address before, so the work is linear."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Pattern spans as (start, kind, end), by start and kind; code points."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                      if all(map(_part, m.groups()))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                      if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return sorted(found)


def entity_of(text: str, span: tuple[int, int, int]) -> str:
    """The protected value: kind and normalised text."""
    start, kind, end = span
    value = text[start:end]
    value = value.lower() if kind < 2 else "".join(_DIGIT.findall(value))
    return f"{KINDS[kind]}:{value}"


def _term(word: str) -> tuple[str, int, int] | None:
    core = word.strip(_EDGES)
    if len(core) < 3:
        return None
    at = len(word) - len(word.lstrip(_EDGES))
    return core.lower(), at, at + len(core)


def near_terms(text: str, spans: list[tuple[int, int, int]],
               near: int | None = None) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of up to ``near`` words on either side of every span."""
    words = free_terms(text, spans)
    at = [w[0] for w in words]
    out = set()
    for span in spans:
        entity, i = entity_of(text, span), bisect_left(at, span[0])
        out |= {(entity, term, a, b) for _, term, a, b in words[max(0, i - near):i + near]}
    return sorted(out)


def free_terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, str, int, int]]:
    """(word start, term, start, end) of the words outside the spans; none without spans."""
    if not spans:
        return []
    covered = []
    for s, _, e in spans:
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    starts = [c[0] for c in covered]
    words = []
    for m in WORD_RE.finditer(text):
        i = bisect_left(starts, m.end()) - 1
        if (i < 0 or covered[i][1] <= m.start()) and (term := _term(m.group())):
            words.append((m.start(), term[0], m.start() + term[1], m.start() + term[2]))
    return words


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()),
                      T.StructField("end", T.IntegerType())])
_SCAN = ("doc_id long, th long, base array<struct<start: int, kind: int, end: int>>, "
         "entities array<string>, near array<struct<entity: string, term: string, start: int, end: int>>")


class _Lists:
    """Lists of records, a list a row, kept field by field: a few bytes for a number."""

    def __init__(self, **fields: pa.DataType):
        self.types = fields
        self.values: list[list] = [[] for _ in fields]
        self.ends = [0]

    def add(self, records: Sequence[tuple]) -> None:
        for held, new in zip(self.values, zip(*records, strict=True), strict=False):
            held.extend(new)
        self.ends.append(self.ends[-1] + len(records))

    def array(self) -> pa.ListArray:
        flat = [pa.array(v, t) for v, t in zip(self.values, self.types.values(), strict=True)]
        records = flat[0] if len(flat) == 1 else pa.StructArray.from_arrays(flat, list(self.types))
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), records)


def _scanned(batch: pa.RecordBatch, near: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch with what is found in them, in pieces of about ``NEAR_TERMS``."""
    number, word = pa.int32(), pa.string()
    texts, at = batch.column("text"), 0
    while at < len(texts):
        first = at
        base = _Lists(start=number, kind=number, end=number)
        entities = _Lists(entity=word)
        beside = _Lists(entity=word, term=word, start=number, end=number)
        while at < len(texts) and beside.ends[-1] < NEAR_TERMS:
            text = texts[at].as_py() or ""
            spans = base_spans(text)
            base.add(spans)
            entities.add([(e,) for e in sorted({entity_of(text, s) for s in spans})])
            beside.add(near_terms(text, spans, near))
            at += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).slice(first, at - first) for c in ("doc_id", "th")]
            + [base.array(), entities.array(), beside.array()],
            ["doc_id", "th", "base", "entities", "near"])


def scan(docs: DataFrame, near: int = NEAR) -> DataFrame:
    """``doc_id, th, base, entities, near`` per row, stored: one pass over the texts, few of
    them and of their words in memory at a time."""
    small_batches(docs.sparkSession)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _scanned(batch, near)

    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return stored(rows.mapInArrow(look, _SCAN), "privacy-scan")


def term_counts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``term, n_t`` for the terms of ``asked``: rows of documents that hold a term, summed
    within tasks first."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                words = set(WORD_RE.findall(text or ""))
                held.update({t[0] for w in words if (t := _term(w))})
                if len(held) > _FLUSH:
                    yield pd.DataFrame({"term": list(held), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"term": list(held), "n": list(held.values())})

    return (docs.select("text").mapInPandas(count, "term string, n long")
            .join(asked.select("term").distinct(), "term", "left_semi")
            .groupBy("term").agg(F.sum("n").alias("n_t")))


def shared_entities(scanned: DataFrame, least: int = LEAST_TEXTS) -> DataFrame:
    """The entities that ``least`` different texts or more hold, stored."""
    held = scanned.select("th", F.explode("entities").alias("entity")).distinct()
    return stored(held.groupBy("entity").agg(F.count("*").alias("texts"))
                  .where(F.col("texts") >= least).select("entity"), "privacy-entities")


def occurrences(scanned: DataFrame, shared: DataFrame) -> DataFrame:
    """``doc_id, th, near`` of the rows with a shared entity, ``near`` cut down to those
    entities; stored."""
    known = (scanned.select("doc_id", "th", F.explode("entities").alias("entity"))
             .join(shared, "entity")
             .groupBy(F.col("doc_id").alias("__i"), F.col("th").alias("__t"))
             .agg(F.collect_set("entity").alias("known")))
    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("th") == F.col("__t"))
    kept = F.filter("near", lambda e: F.array_contains(F.col("known"), e["entity"]))
    return stored(scanned.where(F.size("near") > 0).join(known, same)
                  .select("doc_id", "th", kept.alias("near")), "privacy-near")


def lower_share(k, m, z: float = Z):
    """The lower Wilson bound of ``k`` of ``m`` as a column."""
    half = z * F.sqrt(k * (m - k) / m + z * z / 4)
    return (k + z * z / 2 - half) / (m + z * z)


def disclosing(near: DataFrame, docs: DataFrame, least: int = LEAST_TEXTS,
               remove: float = REMOVE_BITS, generalise: float = GENERALISE_BITS) -> DataFrame:
    """``entity, term, kind, bits`` of the pairs that leave few enough bits."""
    pair = F.transform("near", lambda e: F.struct(e["entity"].alias("entity"), e["term"].alias("term")))
    pairs = near.select("th", F.explode(F.array_distinct(pair)).alias("p")).select("th", "p.*")
    per_text = pairs.groupBy("entity", "term", "th").agg(F.count("*").alias("n"))
    known = stored(per_text.groupBy("entity", "term")
                   .agg(F.sum("n").alias("n_ct"), F.count("*").alias("texts"))
                   .where(F.col("texts") >= least), "privacy-known")
    rows = known.join(term_counts(docs, known), "term")
    # Copies weigh alike on both sides: trials are texts, in the proportion of rows.
    trials = F.col("texts") * F.col("n_t") / F.col("n_ct")
    rows = rows.withColumn("bits", -F.log2(lower_share(F.col("texts"), trials)))
    return stored(rows.where(F.col("bits") <= generalise).select(
        "entity", "term", F.when(F.col("bits") <= remove, 4).otherwise(5).alias("kind"), "bits"),
        "privacy-pairs")


def find_spans(docs: DataFrame, near: int = NEAR, least: int = LEAST_TEXTS,
               remove: float = REMOVE_BITS, generalise: float = GENERALISE_BITS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, base, spans`` per row: the pattern spans, and those with the spans of
    disclosing terms, sorted by start and kind."""
    docs = id_and_text(docs, id_col, text_col)
    scanned = scan(docs, near)
    beside = occurrences(scanned, shared_entities(scanned, least))
    flagged = disclosing(beside, docs, least, remove, generalise)
    found = (beside.select("doc_id", "th", F.explode("near").alias("p")).select("doc_id", "th", "p.*")
             .join(flagged, ["entity", "term"])
             .groupBy("doc_id", "th", "start", "end").agg(F.min("kind").alias("kind"))
             .groupBy(F.col("doc_id").alias("__i"), F.col("th").alias("__t"))
             .agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")))
    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("th") == F.col("__t"))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(T.ArrayType(_SPAN)))))
    return scanned.join(found, same, "left").select("doc_id", "th", "base", spans.alias("spans"))


def spans_text(spans: str):
    """``kind:start:end`` of every span, comma-joined, as a column."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def word_class(word: str) -> str:
    """What a generalised word is replaced by."""
    if any(c.isdigit() for c in word):
        return "<NUMBER>"
    return "<NAME>" if word[:1].isupper() else "<WORD>"


def rewrite(text: str, spans) -> str:
    """The text with its spans replaced; of overlapping spans the first names the whole."""
    merged: list[list[int]] = []
    for s in spans:
        if merged and s["start"] < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s["end"])
        else:
            merged.append([s["start"], s["end"], s["kind"]])
    out, at = [], 0
    for start, end, kind in merged:
        name = KINDS[kind]
        out += [text[at:start], "" if name == "term" else word_class(text[start:end])
                if name == "general" else f"<{name.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             **options) -> DataFrame:
    """The rows with their text rewritten; all columns, in order."""
    spans = (find_spans(docs, id_col=id_col, text_col=text_col, **options)
             .where(F.size("spans") > 0)
             .groupBy(F.col("doc_id").alias("__i"), F.col("th").alias("__t"))
             .agg(F.first("spans").alias("__spans")))
    spans = stored(spans, "privacy-spans")

    @F.pandas_udf(T.StringType())
    def change(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else rewrite(t, s)
                          for t, s in zip(texts, spans, strict=True)], dtype=object)

    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("__row"), F.col(id_col).cast("long").alias("__id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("__th"))
    same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t"))
    out = rows.join(spans.hint("merge"), same, "left").withColumn(
        "__text", change(F.col("__row").getField(text_col).cast("string"), F.col("__spans")))
    return out.select(*[F.col("__text").alias(c) if c == text_col else
                        F.col("__row").getField(c).alias(c) for c in docs.columns])

"""Language identification by compression.

Each learned language is a raw-content zstandard dictionary: excerpts of its training texts.
A text is encoded with every dictionary, and the language under which it is smallest is the
answer.  Whole texts are encoded: in pieces of ``PIECE`` bytes, each on its own, so that the
dictionary and not the text's own beginning is what later parts are compared with, and sizes
are summed up.  Texts of up to ``SHORT`` bytes would differ by too few bytes, so for them
the suffixes at every word are encoded and summed up instead.  Equal sizes go to the language
with more training texts, then to the smaller name.

The answer comes with the margin over the runner-up, as a share of the runner-up's size; a
margin under ``min_margin`` is rejected: ``accepted`` is false.

Only the dictionaries are fitted on a bounded sample of labelled rows: of every language
``SAMPLE_TEXTS`` distinct texts at most, those with the smallest hashes, with ``EXCERPT``
characters of each from a place given by its hash.  Counts per language cover all training
rows.  At most ``MAX_LANGUAGES`` languages can be learned, an error beyond; so the model has at
most that many dictionaries of ``SAMPLE_TEXTS * EXCERPT`` characters.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and not accepted,
as is every text when nothing was learned; with one learned language the score of any text is
1.  Training rows without a language, a text or a letter teach nothing; rows whose condition
is null (as for a null id) are not learned from and not held out.  Repeated texts count once
as excerpts.  An empty table gives an empty result.  Very long texts take time in proportion
and memory for one text.  Only the named columns are read, whatever others are called."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_TEXTS = 256
EXCERPT = 512
MAX_LANGUAGES = 512
PIECE = 4096
SHORT = 512
MIN_MARGIN = 0.01
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# Tries of the sample's rate: rows expected per wanted text before the exact cut.
_SPARE = 4


def pieces(text: str) -> list[bytes]:
    """What is encoded of a text: its pieces, or all word suffixes of a short one."""
    data = b" " + text.lower().encode("utf-8", "replace") + b" "
    if len(data) <= SHORT:
        return [data[m.start() - 1:] for m in _WORD.finditer(data)]
    return [data[i:i + PIECE] for i in range(0, len(data), PIECE)]


class Encoders:
    """One encoder per language; languages come in the order that decides ties."""

    def __init__(self, dictionaries: list[tuple[str, str]]):
        # A lazy search for matches of four bytes: words here are short.
        settings = zstandard.ZstdCompressionParameters.from_level(
            3, strategy=zstandard.STRATEGY_LAZY, min_match=4, write_content_size=False,
            write_checksum=False, write_dict_id=False)
        self.languages = [lang for lang, _ in dictionaries]
        self.encoders = []
        for _, content in dictionaries:
            known = zstandard.ZstdCompressionDict(content.encode("utf-8", "replace"),
                                                  dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=settings)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=known,
                                                          compression_params=settings))

    def sizes(self, text: str) -> list[int]:
        parts = pieces(text)
        return [sum(len(e.compress(p)) for p in parts) for e in self.encoders]

    def classify(self, text: str | None) -> tuple[str, float]:
        """The language and the margin over the next one, as a share of the latter's size."""
        if not self.languages or text is None or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = [s for i, s in enumerate(sizes) if i != best]
        return self.languages[best], 1.0 - sizes[best] / min(rest) if rest else 1.0


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """The dictionaries ``(language, content)`` of labelled rows, in the order that decides
    ties; bounded by ``MAX_LANGUAGES``, ``SAMPLE_TEXTS`` and ``EXCERPT``."""
    rows = train.select(F.col(f"`{lang_col}`").cast("string").alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn(
        "h", F.xxhash64("text"))
    # A row per language; one more than allowed tells that there are too many.
    known = (rows.groupBy("lang").agg(F.count("*").alias("n"),
                                      F.approx_count_distinct("h").alias("texts"))
             .limit(MAX_LANGUAGES + 1).collect())
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not known:
        return []
    rates = train.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, _SPARE * SAMPLE_TEXTS / max(r["texts"], 1))) for r in known],
        "lang string, rate double")
    place = F.expr(f"cast(pmod(h, greatest(length(text) - {EXCERPT}, 0) + 1) as int) + 1")
    drawn = (rows.join(F.broadcast(rates), "lang")
             .where(F.shiftrightunsigned("h", 11) < F.col("rate") * float(1 << 53))
             .groupBy("lang", "h").agg(F.first(F.lower(F.substring(
                 F.col("text"), place, F.lit(EXCERPT)))).alias("excerpt")))
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "h")
    kept = (drawn.withColumn("r", F.row_number().over(order)).where(F.col("r") <= SAMPLE_TEXTS)
            .orderBy("lang", "r").collect())
    content: dict[str, list[str]] = {}
    for r in kept:
        content.setdefault(r["lang"], []).append(r["excerpt"])
    ranked = sorted(known, key=lambda r: (-r["n"], r["lang"]))
    return [(r["lang"], "\n".join(content[r["lang"]])) for r in ranked if r["lang"] in content]


def predict(docs: DataFrame, dictionaries: list[tuple[str, str]], text: Column,
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the margin, 0 to 1) and ``accepted``; one pass
    over the text, no shuffle."""

    @F.pandas_udf("lang string, score double")
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = Encoders(dictionaries)
        for batch in texts:
            yield pd.DataFrame([encoders.classify(t) for t in batch], columns=["lang", "score"])

    return (docs.withColumn("__found", classify(text))
            .withColumns({"lang_pred": F.col("__found.lang"), "score": F.col("__found.score"),
                          "accepted": (F.col("__found.lang") != UNDETERMINED)
                          & (F.col("__found.score") >= min_margin)}).drop("__found"))


def held_out(id_col: str = "doc_id", mod: int = 3, rest: int = 1) -> Column:
    """Whether the unsigned CRC-32 of the id as text leaves ``rest`` (null id: null)."""
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % mod == rest


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", min_margin: float = MIN_MARGIN) -> DataFrame:
    """Learn from the rows that are not held out, classify all: the id, ``held_out``,
    ``lang_pred``, ``score`` and ``accepted``."""
    fold = held_out(id_col)
    dictionaries = learn(docs.where(~fold), text_col, lang_col)
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col),
                       F.coalesce(fold, F.lit(False)).alias("held_out"),
                       F.col(f"`{text_col}`").cast("string").alias("__text"))
    return predict(rows, dictionaries, F.col("__text"), min_margin).drop("__text")

"""Token counts by rank-synchronous merging of byte-pair arrays.

The vocabulary file of a word-level BPE tokenizer (JSON) is read by every worker from a
path that is a parameter.  Texts are cut into pre-tokens by the file's own rules; the
distinct pre-tokens of a batch become one ragged pair of numpy arrays (symbol, sequence).
In each round every sequence applies its lowest-ranked pair, at all its places at once,
until no pair is left; what survives is counted.  Counts of pre-tokens are remembered in a
worker up to a bound; texts are never held together beyond one small Arrow batch.

Special token strings inside a text count as one token each, as the tokenizer library has
it by default; no begin or end token is added and nothing is cut.

Defined cases: null text is empty (0 bytes, 0 tokens); repeated rows and null ids are
counted like any other; an empty table gives an empty result; other columns are not read."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.llm.common import id_and_text, small_batches

REMEMBERED = 300_000
_NONE = np.int64(1) << 40
# Beyond the old Latin blocks the library's own character classes decide.
_OLD = "".join(map(chr, range(0x250)))
_LATER = re.compile(r"[^\x00-\u024F]")


def _old_latin(pattern: str) -> str:
    """The pattern with its Unicode classes spelled out for the old Latin blocks, so that
    the plain engine can run it."""
    for name, cls in ((r"\s", r"\p{White_Space}"), (r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}")):
        pattern = pattern.replace(name, "".join(map(re.escape, regex.findall(cls, _OLD))))
    return pattern


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    stands for itself, the others for code points from 256 on, in order."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
           *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class PairMerger:
    """Counts of BPE symbols for many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.size = len(vocab) + 1
        key = left * self.size + right
        # Of a pair given twice the later rule holds, as in a table filled in order.
        order = np.lexsort((-np.arange(len(key)), key))
        first = np.r_[True, key[order][1:] != key[order][:-1]]
        self.key, self.rank = key[order][first], order[first].astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len,
                                                                   reverse=True))))
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.split = re.compile(_old_latin(pattern))
        self.known: dict[str, int] = {}
        self.byte_of = {ord(s): b for b, s in enumerate(symbols)}
        self.path, self.library = path, None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and its number of special tokens."""
        found, special = [], 0
        parts = [text]
        if any(s in text for s in self.special):
            parts = self.cut.split(text)
            special = len(parts) - 1
        for part in parts:
            if part.isascii():
                found += self.split.findall(part.lower())
            elif _LATER.search(part):
                found += self._library_cut(part)
            else:
                found += self.split.findall(unicodedata.normalize("NFC", part).lower())
        return found, special

    def _library_cut(self, part: str) -> list[str]:
        """Pre-tokens as the tokenizer library has them: beyond the old Latin blocks its
        Unicode tables and ours can differ in what is a letter."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        plain = self.library.normalizer.normalize_str(part)
        cut = self.library.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(map(self.byte_of.__getitem__, map(ord, word))).decode()
                for word, _ in cut]

    def _pairs(self, symbol: np.ndarray, seq: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each symbol, or ``_NONE``."""
        out = np.full(len(symbol), _NONE)
        if len(symbol) > 1:
            key = symbol[:-1] * self.size + symbol[1:]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            ok = (self.key[at] == key) & (seq[:-1] == seq[1:])
            out[:-1][ok] = self.rank[at[ok]]
        return out

    def count(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word; words are not empty."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol, ends = self.inner[data], np.cumsum(sizes) - 1
        symbol[ends] = self.last[data[ends]]
        seq = np.repeat(np.arange(len(raw)), sizes)
        done = np.zeros(len(raw), np.int64)
        while len(symbol):
            rank = self._pairs(symbol, seq)
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(seq)])
            going = low < _NONE
            done[seq[starts[~going]]] = sizes[~going]
            stay = np.repeat(going, sizes)
            symbol, seq, rank = symbol[stay], seq[stay], rank[stay]
            if not len(symbol):
                break
            hit = rank == np.repeat(low[going], sizes[going])
            # Of overlapping places (a a a) every other one counts, from the left.
            at = np.flatnonzero(hit)
            run = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[(place % 2 == 0) | (symbol[at] != symbol[np.minimum(at + 1, len(symbol) - 1)])]
            symbol[at] = self.made[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, seq = symbol[keep], seq[keep]
        return done

    def count_texts(self, texts: list[str]) -> list[int]:
        cut = [self.pre_tokens(t) for t in texts]
        distinct = set().union(*(p for p, _ in cut))
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known = {}
        new = [w for w in distinct if w not in self.known]
        if new:
            self.known.update(zip(new, self.count(new).tolist(), strict=True))
        return [sum(map(self.known.__getitem__, p)) + n for p, n in cut]


@lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    return PairMerger(path)


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = merger(vocab_path)
        for batch in texts:
            yield pd.Series(bpe.count_texts([t or "" for t in batch]), dtype="int64")

    rows = id_and_text(docs, id_col, text_col)
    return (rows.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
                        .alias("n_bytes"), tokens("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))

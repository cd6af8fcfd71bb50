"""Mixing documents to target weights by raking, in DataFrame functions only.

Tokens are summed into cells (one per combination of the dimensions that occurs).
Iterative proportional fitting scales the cells until every dimension's token shares meet
its targets; a cell's weight is its raked share over its observed share.  A document is
sampled with probability ``scale * weight``, where the scale is the largest that keeps all
probabilities at most one (or meets a smaller token budget), so the expected mix of the
sample is the raked one exactly.  Draws come from a hash of the id: repeatable, and the
same for repeated rows.

The cell table is as large as the category combinations, never as the documents; its sums
are windows by one dimension each, and the weights go back by a join that the planner
broadcasts only below its size threshold.

Defined cases: a null category is a category of its own; a category without a target gets
none (its documents have probability 0); targets of categories that do not occur are
spread over the others; a null or empty text has no tokens, weighs as its cell does and
can still be drawn; a cell without tokens has probability 0; an empty table gives an
empty result; other columns are carried along untouched."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harrow.llm.common import WORD, stored

SWEEPS = 10
# Sweeps whose plan is run as one before it is written to the shared folder.
_AT_ONCE = 5


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def form_topic(text: Column) -> Column:
    """A topic by the form of a text, for tables that carry none."""
    lines = F.coalesce(F.regexp_count(text, F.lit("\n")), F.lit(0))
    return (F.when(F.coalesce(F.instr(text, " | "), F.lit(0)) > 0, "table")
            .when(lines >= 20, "long").when(lines >= 5, "article").otherwise("note"))


def cells_of(rows: DataFrame, dims: list[str], tokens: str = "n_tokens") -> DataFrame:
    return rows.groupBy(*dims).agg(F.sum(tokens).cast("double").alias("tokens"))


def tempered(cells: DataFrame, dim: str, power: float = 0.7) -> DataFrame:
    """Targets ``value, share`` in proportion to a power of the observed tokens."""
    return cells.groupBy(F.col(dim).alias("value")).agg(
        F.pow(F.sum("tokens"), F.lit(power)).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """The cells with ``mass`` (raked share of tokens) and ``weight``."""
    rows = cells.withColumn("mass", F.col("tokens"))
    for i, (dim, wanted) in enumerate(targets.items()):
        wanted = wanted.select(F.col("value").alias("__v"), F.col("share").alias("__s"))
        rows = (rows.join(wanted, F.col(dim).eqNullSafe(F.col("__v")), "left")
                .drop("__v").withColumn(f"__t{i}", F.coalesce("__s", F.lit(0.0))).drop("__s"))
        # Shares of the categories that have tokens add up to one.
        own = Window.partitionBy(dim)
        lead = F.row_number().over(own.orderBy(F.col("tokens").desc(), *targets)) == 1
        has = F.sum("tokens").over(own) > 0
        rows = rows.withColumn(f"__l{i}", F.when(lead & has, F.col(f"__t{i}")).otherwise(0.0))
    rows = stored(rows, "mixing-cells")
    whole = rows.agg(F.sum("tokens").alias("tokens"),
                     *[F.sum(f"__l{i}").alias(f"s{i}") for i in range(len(targets))]).first()
    for i in range(len(targets)):
        total = whole[f"s{i}"] or 0.0
        rows = rows.withColumn(f"__t{i}", F.col(f"__t{i}") / total if total else F.lit(0.0))
    for sweep in range(sweeps):
        for i, dim in enumerate(targets):
            have = F.sum("mass").over(Window.partitionBy(dim))
            rows = rows.withColumn("mass", F.when(
                have > 0, F.col("mass") * F.col(f"__t{i}") / have).otherwise(0.0))
        if sweep % _AT_ONCE == _AT_ONCE - 1 or sweep == sweeps - 1:
            rows = stored(rows, "mixing-cells")
    total = whole["tokens"] or 0.0
    weight = F.when(F.col("tokens") > 0, F.col("mass") * F.lit(total) / F.col("tokens"))
    return rows.select(*cells.columns, "mass", F.coalesce(weight, F.lit(0.0)).alias("weight"))


def probabilities(weighted: DataFrame, budget: float | None = None) -> DataFrame:
    """The cells with ``probability``: weights times one scale, at most 1 each; the
    expected number of sampled tokens stays within ``budget`` if one is given."""
    top = weighted.agg(F.max("weight").alias("w"),
                       F.sum(F.col("weight") * F.col("tokens")).alias("t")).first()
    scale = 1.0 / top["w"] if top["w"] else 0.0
    if budget is not None and top["t"]:
        scale = min(scale, budget / top["t"])
    return weighted.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))


def draw(row_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the id: the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_weights(rows: DataFrame, dims: list[str], targets: Mapping[str, DataFrame] | None = None,
                 budget: float | None = None, sweeps: int = SWEEPS,
                 tokens: str = "n_tokens") -> DataFrame:
    """The rows with ``weight`` and ``probability`` of their cell.  Targets default to
    tempered shares of every dimension."""
    cells = stored(cells_of(rows, dims, tokens), "mixing-observed")
    goals = targets or {d: tempered(cells, d) for d in dims}
    ready = probabilities(rake(cells, {d: goals[d] for d in dims}, sweeps), budget)
    ready = stored(ready.select(*[F.col(d).alias(f"__{d}") for d in dims], "weight",
                                "probability"), "mixing-weights")
    same = F.lit(True)
    for d in dims:
        same = same & rows[d].eqNullSafe(ready[f"__{d}"])
    return rows.join(ready, same).drop(*[f"__{d}" for d in dims])


def mix(docs: DataFrame, seed: int = 17, budget: float | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
        topic: Column | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """One narrow row per document: ``doc_id, source, lang, topic, n_tokens, weight,
    probability, sampled``."""
    text = F.col(text_col).cast("string")
    rows = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.col(lang_col).alias("lang"),
        (form_topic(text) if topic is None else topic).alias("topic"),
        token_count(text).alias("n_tokens")), "mixing-rows")
    done = with_weights(rows, ["source", "lang", "topic"], budget=budget, sweeps=sweeps)
    return done.withColumn("sampled", draw(F.col("doc_id"), seed) < F.col("probability"))


def sample_mix(docs: DataFrame, seed: int = 17, budget: float | None = None,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               lang_col: str = "lang") -> DataFrame:
    """The sampled rows with all their columns, and ``mix_weight`` and
    ``mix_probability``."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*cols).alias("__row"), F.col(id_col).alias("__id"),
                       F.col(source_col).alias("source"), F.col(lang_col).alias("lang"),
                       form_topic(text).alias("topic"), token_count(text).alias("n_tokens"))
    done = with_weights(rows, ["source", "lang", "topic"], budget=budget)
    own = [F.col("__row").getField(c).alias(c) for c in docs.columns]
    new = {"weight": "mix_weight", "probability": "mix_probability"}
    return (done.where(draw(F.col("__id"), seed) < F.col("probability"))
            .select(*own, *[F.col(a).alias(b) for a, b in new.items() if b not in docs.columns]))

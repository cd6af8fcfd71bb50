"""Merkle manifest of a dataset by bitmap ranks and slot arrays.

Every row is a leaf: the SHA-256 of its columns, each ``-`` if null, else its UTF-8 byte
count, a colon and the value.  Leaves of a source ascend by id; every ``FANOUT`` consecutive
nodes become their hash until one, the subroot, remains; subroots in the order of their
source become the root in the same way.

Leaves are never sorted.  The ids of a source are one compressed bitmap: 64-bit words with a
bit, packed into containers of 4,096 ids that leave empty words out, with a popcount directory
over the words of a container, over containers and over blocks of containers.  The rank of an
id, its leaf's coordinate, is the directory's count before its word plus the set bits before
its own.  Nodes then go to blocks by coordinate, into a slot array of at most ``FANOUT **
STRIDE`` hashes, which a task reduces by up to ``STRIDE`` levels; one exchange does what
``STRIDE`` levels would ask for, and its groups are bounded however large a source is.  Proofs
are read off the stored blocks from the root downwards, so that only one short row per block,
and not a proof per leaf, is exchanged.

Defined cases: a null source is a source of its own, before all others; a null id comes before
all ids; rows of one source with the same id ascend by their leaf hash, and equal rows are as
many leaves; a null in any column is hashed as ``-``; an empty table has no rows; very long
texts are hashed where they are read; further columns are not looked at, whatever their names.
An id whose ``crc32`` is asked for and null is not tampered with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.llm.common import stored
from harrow.operators.rank import global_row_number, ordered_cumsum

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
# Levels that one exchange of nodes reduces: a slot array holds FANOUT ** STRIDE hashes.
STRIDE = 5
SLOTS = FANOUT ** STRIDE
# Bits of an id below its 64-bit word, its container, and the tiers of the directory.
WORD, CONTAINER, TIERS = 6, 12, (12, 24, 40, 56)
# Shifted ids never reach it: the container of null ids, before all others.
NULL_PART = -(1 << 63)
STEP = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
PROOF = T.ArrayType(STEP)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    """The leaf of a row with these values, lowercase hex."""
    return F.sha2(F.concat(*map(_field, values)), 256)


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


# Coordinates ----------------------------------------------------------------------
def _part(shift: int) -> Column:
    return F.coalesce(F.shiftright("id", shift), F.lit(NULL_PART))


def id_bitmaps(rows: DataFrame) -> DataFrame:
    """Per source and container of ids: the non-empty words ``(word, bits, rows, tied)`` in
    order, ``before`` (rows of the source in earlier containers) and ``n`` (rows of the whole
    source).  ``tied`` lists the bits of ids with more than one row.

    Words combine on the map side; a container holds 64 of them at most.  The directory is
    summed up tier by tier, each window over the parts of one part of the tier above: 65,536
    at most, however many ids a source has."""
    ids = rows.groupBy("g", "id").agg(F.sum("copies").alias("rows"))
    bit = F.coalesce(F.col("id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    words = (ids.withColumn("bit", bit)
             .groupBy("g", _part(CONTAINER).alias("part"), _part(WORD).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
                  .alias("bits"), F.sum("rows").alias("rows"),
                  F.array_compact(F.collect_list(F.when(
                      F.col("rows") > 1, F.struct("bit", (F.col("rows") - 1).alias("more")))))
                  .alias("tied")))
    packed = stored(words.groupBy("g", "part").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits", "rows", "tied"))).alias("words"),
        F.sum("rows").alias("rows")), "bitmaps")
    # A container's part number, and those of the tiers above it.
    up = [F.col("part") if t == CONTAINER else F.when(
        F.col("part") == NULL_PART, F.lit(NULL_PART)).otherwise(
        F.shiftright("part", t - CONTAINER)) for t in TIERS]
    tiers = packed.select("g", "rows", *[c.alias(f"t{i}") for i, c in enumerate(up)])
    top = len(TIERS)
    before = None
    for i in range(top):
        above = [f"t{j}" for j in range(i + 1, top)]
        own = tiers.groupBy("g", f"t{i}", *above).agg(F.sum("rows").alias("r"))
        earlier = F.coalesce(F.expr(
            f"sum(r) OVER (PARTITION BY {', '.join(['g', *above])} ORDER BY t{i} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0))
        counted = own.select("g", f"t{i}", *above, earlier.alias(f"b{i}"))
        # Tiers join from the narrowest outwards, on the part numbers they share.
        before = counted if before is None else before.join(counted, ["g", f"t{i}", *above])
    sizes = tiers.groupBy("g").agg(F.sum("rows").alias("n"))
    directory = before.join(sizes, "g").select(
        "g", F.col("t0").alias("part"), sum((F.col(f"b{i}") for i in range(1, top)), F.col("b0"))
        .alias("before"), "n")
    return packed.drop("rows").join(directory, ["g", "part"])


def rank_of(word: Column, bit: Column, words: Column) -> Column:
    """Rows of a container before an id: those of earlier words, then the popcount of the
    bits before its own and what tied ids among those add."""
    def in_word(w: Column) -> Column:
        below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))
        more = F.aggregate(w["tied"], F.lit(0).cast("long"), lambda a, t: a + F.when(
            t["bit"] < bit, t["more"]).otherwise(0))
        return F.bit_count(w["bits"].bitwiseAND(below)).cast("long") + more

    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.when(
        w["word"] < word, w["rows"]).when(w["word"] == word, in_word(w)).otherwise(0))


def with_coordinates(rows: DataFrame) -> DataFrame:
    """Rows ``(g, id, leaf, ..., copies)``, distinct, as one row per leaf with ``pos`` (from 0
    inside ``g``) and ``n`` (leaves of ``g``)."""
    maps = stored(id_bitmaps(rows), "directory")
    # Distinct leaves that share an id: their order by hash, through running sums over a range
    # layout, so that even one id with a third of all rows is spread.
    shared = rows.groupBy("g", "id").agg(F.count("*").alias("k")).where("k > 1")
    tied = rows.alias("r").join(shared.alias("s"), _same("r", "s", ["g", "id"])).select(
        "r.g", "r.id", "r.leaf", "r.copies")
    tied = (tied.groupBy("g", "id", "leaf").agg(F.sum("copies").alias("copies"))
            .withColumn("__null", F.col("id").isNotNull()))
    summed = ordered_cumsum(tied, ["g", "__null", "id", "leaf"], ["copies"])
    first = summed.groupBy("g", "id").agg(F.min(F.col("cum_copies") - F.col("copies")).alias("low"))
    offsets = summed.alias("a").join(first.alias("b"), _same("a", "b", ["g", "id"])).select(
        "a.g", "a.id", "a.leaf", (F.col("cum_copies") - F.col("a.copies") - F.col("low")).alias("off"))
    bit = F.coalesce(F.col("id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    placed = (rows.withColumns({"part": _part(CONTAINER), "word": _part(WORD), "bit": bit})
              .join(maps, ["g", "part"])
              .withColumn("pos", F.col("before") + rank_of(F.col("word"), F.col("bit"),
                                                           F.col("words")))
              .drop("part", "word", "bit", "words", "before"))
    placed = placed.alias("p").join(offsets.alias("o"), _same("p", "o", ["g", "id", "leaf"]), "left")
    placed = placed.withColumn("__at", F.col("pos") + F.coalesce("off", F.lit(0))).select(
        "p.*", "__at").drop("pos")
    # Equal rows are as many leaves, in two steps so that no array is long.
    some = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / 65536))
    blocks = placed.withColumn("__hi", F.explode(some))
    left = F.least(F.col("copies") - F.col("__hi") * 65536, F.lit(65536))
    return (blocks.withColumn("__lo", F.explode(F.sequence(F.lit(0).cast("long"), left - 1)))
            .withColumn("pos", F.col("__at") + F.col("__hi") * 65536 + F.col("__lo"))
            .drop("__hi", "__lo", "__at", "copies"))


# Reduction ------------------------------------------------------------------------
def _levels_of(n: Column) -> Column:
    """Levels that a block of a tree with ``n`` nodes reduces: all up to one node, or
    ``STRIDE`` where more blocks remain."""
    levels = F.lit(STRIDE)
    for h in range(STRIDE - 1, -1, -1):
        levels = F.when(n <= FANOUT ** h, F.lit(h)).otherwise(levels)
    return levels


def _up(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(
        F.slice(nodes, i * FANOUT + 1, FANOUT), ""), 256))


def slot_blocks(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Nodes ``(g, pos, n, hash, ...)`` gathered into slot arrays and reduced: one row per
    block with ``slots`` (the payload), the nodes of every level ``l0 .. l5`` and the block's
    own ``node``."""
    slot = F.struct(F.pmod("pos", F.lit(SLOTS)).cast("int").alias("slot"), "hash", *payload)
    blocks = (nodes.groupBy("g", "n", F.floor(F.col("pos") / SLOTS).alias("block"))
              .agg(F.sort_array(F.collect_list(slot)).alias("slots")))
    blocks = blocks.withColumns({"levels": _levels_of(F.col("n")), "l0": F.col("slots.hash")})
    for i in range(STRIDE):
        blocks = blocks.withColumn(f"l{i + 1}", F.when(F.col("levels") > i, _up(F.col(f"l{i}"))))
    top = F.col("l0")
    for i in range(1, STRIDE + 1):
        top = F.coalesce(F.col(f"l{i}"), top)
    return blocks.withColumn("node", F.get(top, F.lit(0)))


def _proof_inside(slot: Column) -> Column:
    """The steps of a slot up to its block's node: the hashes left and right of it in its run
    on every level."""
    steps = []
    for i in range(STRIDE):
        level, at = F.col(f"l{i}"), F.floor(slot / FANOUT ** i).cast("int")
        start = at - F.pmod(at, F.lit(FANOUT))
        steps.append(F.when(F.col("levels") > i, F.struct(
            F.array_join(F.slice(level, start + 1, at - start), "").alias("left"),
            F.array_join(F.slice(level, at + 2, start + FANOUT - 1 - at), "").alias("right"))))
    return F.array_compact(F.array(*steps))


def reduce_trees(nodes: DataFrame, payload: Sequence[str] = ()) -> list[DataFrame]:
    """The stored blocks of every round, leaves first; a tree with one block left is done."""
    most = nodes.agg(F.max("n")).first()[0]
    rounds = []
    while most is not None:
        blocks = stored(slot_blocks(nodes, () if rounds else payload), f"blocks{len(rounds)}")
        rounds.append(blocks)
        if most <= SLOTS:
            break
        nodes = blocks.where(F.col("n") > SLOTS).select(
            "g", F.col("block").alias("pos"), F.ceil(F.col("n") / SLOTS).alias("n"),
            F.col("node").alias("hash"))
        most = -(-most // SLOTS)
    return rounds


def unfold(rounds: list[DataFrame], tops: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """From ``tops`` (g, ..., proof: steps above the tree's own root) down to the slots of the
    first round: ``(g, ..., payload, proof)`` with all steps, lowest first."""
    known = [c for c in tops.columns if c not in ("g", "proof")]
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for r in range(len(rounds) - 1, -1, -1):
        # Trees that ended in this round start from their top, others from the round above.
        start = above if r == len(rounds) - 1 else above.unionByName(
            tops.join(rounds[r].where(F.col("n") <= SLOTS).select("g"), "g")
            .withColumn("block", F.lit(0).cast("long")))
        mine = payload if r == 0 else ()
        joined = rounds[r].join(start, ["g", "block"])
        steps = joined.withColumn("s", F.explode("slots"))
        above = steps.select(
            "g", *known, *[F.col(f"s.{c}").alias(c) for c in mine],
            F.concat(_proof_inside(F.col("s.slot")), F.col("proof")).alias("proof"),
            (F.col("block") * SLOTS + F.col("s.slot")).alias("block"))
    return above.drop("block")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_hash(proof: Column) -> Column:
    """One hash over all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id",
             group_col: str = "source", check: Column | None = None) -> DataFrame:
    """The manifest: ``id_col``, ``leaf``, ``subroot``, ``root`` and ``proof`` (an array of the
    hashes left and right of the path, lowest level first) of every row; with ``check``, a
    condition and the leaf to verify instead, also ``checked_leaf``.

    ``check`` is a column over the input that gives the hash a verifier found for the row
    (null: as stored)."""
    leaf = leaf_hash([F.col(f"`{c}`") for c in columns])
    source = F.col(f"`{group_col}`").cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("+"), source), F.lit("")).alias("g"),
                       F.col(f"`{id_col}`").cast("long").alias("id"), leaf.alias("leaf"),
                       (F.lit(None).cast("string") if check is None else check).alias("seen"))
    rows = stored(rows.groupBy("g", "id", "leaf", "seen").agg(F.count("*").alias("copies")),
                  "leaves")
    leaves = with_coordinates(rows).withColumnRenamed("leaf", "hash")
    rounds = reduce_trees(leaves, ["id", "seen"])
    if not rounds:
        return docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField(id_col, T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root")],
            T.StructField("proof", PROOF), T.StructField("checked_leaf", T.StringType())]))
    # A tree ends in the round where all its nodes fit one block.
    subroots = None
    for blocks in rounds:
        done = blocks.where(F.col("n") <= SLOTS).select("g", F.col("node").alias("hash"))
        subroots = done if subroots is None else subroots.unionByName(done)
    ordered = global_row_number(subroots, ["g"], "pos", total="n").select(
        F.lit("").alias("g"), (F.col("pos") - 1).alias("pos"), "n", "hash", F.col("g").alias("of"))
    upper = reduce_trees(ordered, ["of"])
    # One hash for the whole dataset.
    root = upper[-1].select("node").first()[0]
    top = docs.sparkSession.createDataFrame([("", [])], T.StructType([
        T.StructField("g", T.StringType()), T.StructField("proof", PROOF)]))
    paths = unfold(upper, top, ["of", "hash"]).select(
        F.col("of").alias("g"), F.col("hash").alias("subroot"), "proof")
    found = unfold(rounds, stored(paths, "subroots"), ["id", "hash", "seen"])
    return found.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot",
                        F.lit(root).alias("root"), "proof",
                        F.coalesce("seen", "hash").alias("checked_leaf"))


def without_line_feeds(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id",
                       text_col: str = "text") -> Column:
    """The leaf of a row whose text lost its line feeds, where 2 divides the unsigned CRC-32
    of the decimal id; null elsewhere and where that changes nothing."""
    text = F.col(f"`{text_col}`")
    tampered = [F.replace(text, F.lit("\n"), F.lit("")) if c == text_col else F.col(f"`{c}`")
                for c in columns]
    hit = F.crc32(F.col(f"`{id_col}`").cast("string")) % 2 == 0
    return F.when(hit & text.contains("\n"), leaf_hash(tampered))


def verified(found: DataFrame) -> DataFrame:
    """A manifest with ``proof_sha256``, ``folded_root`` and ``verified`` in place of the
    proof itself."""
    return (found.withColumns({"proof_sha256": proof_hash(F.col("proof")),
                               "folded_root": fold(F.col("checked_leaf"), F.col("proof"))})
            .withColumn("verified", F.col("folded_root") == F.col("root"))
            .drop("proof", "checked_leaf"))

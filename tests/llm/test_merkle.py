"""The manifest against a plain tree over sorted lists."""

import hashlib
import random
import zlib

from harrow.llm import merkle
from harrow.llm.merkle import manifest, verified, without_line_feeds
from harrow.llm.q_merkle import SQL, op11_merkle_manifest
from tests.oracle import compare, duck

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i:i + 3]) for i in range(0, len(below), 3)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        first = i - i % 3
        yield "".join(level[first:i]), "".join(level[i + 1:first + 3])
        i //= 3


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        members = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((members, levels_of([leaf_of(r) for r in members])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    out = []
    for j, (members, levels) in enumerate(trees):
        for i, row in enumerate(members):
            steps = [*path(levels, i), *path(top, j)]
            seen = row
            if row[0] is not None and row[4] and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                seen = (*row[:4], row[4].replace("\n", ""))
            h = leaf_of(seen)
            for left, right in steps:
                h = sha(left, h, right)
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0],
                        sha(*[a + b for a, b in steps]), h, h == top[-1][0]))
    return sorted(out, key=repr)


def run(df):
    found = verified(manifest(df, check=without_line_feeds(df))).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(map(tuple, found.collect()), key=repr)


def test_odd_rows(spark):
    """Nulls in every column, negative and huge ids, one id for many rows, equal rows, a very
    long text, and columns whose names the operator uses itself."""
    rng = random.Random(3)
    rows = [(None, None, None, None, None), (None, "a", None, 3, "x\ny"), (None, "a", None, 3, "x\ny"),
            (5, "a", "en", 1, ""), (5, "a", "en", 1, "\n"), (5, "a", "en", 1, "\n"),
            (-1, "a", "fr", 2, "é\n"), (-(1 << 63), "", "x", 0, "low"), ((1 << 63) - 1, "", "x", 0, "\n"),
            (63, "ß", None, 9, "long\n" * 60000), (64, "ß", None, 9, "z"), (1 << 40, "ß", None, 9, "z")]
    rows += [(7, "copies", "en", 2, rng.choice(["one\n", "two\n", "three"])) for _ in range(900)]
    rows += [(rng.randrange(-10 ** rng.randrange(1, 18), 10 ** 18), "sparse", None, None, str(i))
             for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as g", "'q' as pos", "3 as leaf")
    assert run(df) == brute(rows)


def test_sizes(spark):
    """Trees around the borders of a slot array, up to three rounds of them."""
    rows = [(i * 3, f"s{n}", "en", i, f"t{i}\n")
            for n in (1, 2, 3, 4, 9, 10, 242, 243, 244, 729, 730, 60000) for i in range(n)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"s{i % 700}", "en", i, "x") for i in range(1500)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert run(df) == []


def test_ranks_without_a_window_over_leaves(spark):
    """The rank query is popcounts: a container's words hold every id once, empty ones left
    out."""
    rows = [("s", i, "h", 1) for i in range(0, 9000, 70)]
    df = spark.createDataFrame(rows, "g string, id long, leaf string, copies long")
    maps = merkle.id_bitmaps(df).collect()
    assert len(maps) == 3 and {m.n for m in maps} == {len(rows)}
    assert sum(bin(w.bits & (2 ** 64 - 1)).count("1") for m in maps for w in m.words) == len(rows)
    got = {r.id: r.pos for r in merkle.with_coordinates(df).collect()}
    assert [got[r[1]] for r in rows] == list(range(len(rows)))


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert not compare(spark, duck(sf), "op11", op11_merkle_manifest, SQL, sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select(*merkle.COLUMNS).collect()]
    got = sorted((tuple(r) for r in op11_merkle_manifest(spark, sf).collect()), key=repr)
    assert got == brute(rows)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)

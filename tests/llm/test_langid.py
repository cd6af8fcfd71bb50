"""Language identification: held-out accuracy, and a plain version of learning and sizes."""

import zlib

import pytest
import zstandard

from harrow.llm import langid
from harrow.llm.langid import Encoders, identify, learn, pieces
from harrow.llm.q_langid import op12_language_id

SCHEMA = "doc_id long, text string, lang string"
EN = "the cat and the dog of the house went to the river with a friend "
DE = "der hund und die katze in dem haus gingen mit einem freund an den fluss "
FR = "le chat et le chien de la maison sont allés à la rivière avec un ami "


def rows_of(n=60):
    out = []
    for i in range(n):
        for j, (text, lang) in enumerate(((EN, "en"), (DE, "de"), (FR, "fr"))):
            words = text.split()
            cut = (i * 7 + j) % len(words)
            out.append((3 * i + j, " ".join(words[cut:] + words[:cut]), lang))
    return out


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op12_language_id(spark, sf).collect()
    assert {r.doc_id for r in got} == set(truth) and len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0.0 <= r.score <= 1.0 for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id].lang and r.lang_pred != "und"]
    right = [r.lang_pred == truth[r.doc_id].lang for r in held]
    assert sum(right) / len(right) > 0.98
    sure = [ok for r, ok in zip(held, right, strict=True) if r.accepted]
    assert sum(sure) / len(sure) >= sum(right) / len(right) and len(sure) > 0.9 * len(right)


def test_sizes_are_those_of_each_dictionary(spark):
    dictionaries = learn(spark.createDataFrame(rows_of(), SCHEMA))
    assert sorted(lang for lang, _ in dictionaries) == ["de", "en", "fr"]
    text = EN * 300
    assert b"".join(pieces(text)) == b" " + text.encode() + b" "
    want = []
    for _, content in dictionaries:
        settings = zstandard.ZstdCompressionParameters.from_level(
            3, strategy=zstandard.STRATEGY_LAZY, min_match=4, write_content_size=False)
        known = zstandard.ZstdCompressionDict(content.encode(), zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=settings)
        data = b" " + text.encode() + b" "
        one = zstandard.ZstdCompressor(dict_data=known, compression_params=settings)
        want.append(sum(len(one.compress(data[i:i + 4096])) for i in range(0, len(data), 4096)))
    encoders = Encoders(dictionaries)
    assert encoders.sizes(text) == want
    best = min(want)
    lang, score = encoders.classify(text)
    assert lang == dictionaries[want.index(best)][0] == "en"
    assert score == pytest.approx(1 - best / sorted(want)[1])


def test_held_out_rows_teach_nothing(spark):
    """Changing the text or language of held-out rows changes no other prediction."""
    rows = rows_of()
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    other = [(i, "zzz qqq xxx" if i in held else t, "zz" if i in held else lang) for i, t, lang in rows]
    a = {r.doc_id: r for r in identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    b = {r.doc_id: r for r in identify(spark.createDataFrame(other, SCHEMA)).collect()}
    assert all(a[i] == b[i] for i in a if i not in held) and "zz" not in {r.lang_pred for r in b.values()}


def test_defined_cases(spark):
    long = DE * 40000
    rows = rows_of() + [(1000, None, "en"), (1001, "", "en"), (1002, "123 !? ½", "de"), (1003, long, None),
                        (1003, long, None), (None, EN, "en"), (1005, "chat", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' as score", "1 as held_out", "2 as lang_pred", "3 as h", "4 as __text")
    got = identify(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by[i].lang_pred, by[i].score, by[i].accepted) == ("und", 0.0, False)
    assert by[1003].lang_pred == "de" and by[None].lang_pred == "en" and by[None].held_out is False
    assert by[1005].lang_pred in ("en", "de", "fr")
    assert sum(r.doc_id == 1003 for r in got) == 2
    assert identify(df.limit(0)).collect() == []


def test_narrow_margins_are_rejected(spark):
    mixed = " ".join(a + " " + b for a, b in zip(EN.split(), DE.split()))
    rows = rows_of() + [(5000, EN, None), (5001, mixed * 20, None)]
    by = {r.doc_id: r for r in identify(spark.createDataFrame(rows, SCHEMA), min_margin=0.15).collect()}
    assert by[5000].accepted and not by[5001].accepted and by[5001].lang_pred in ("en", "de")


def test_one_language_and_none(spark):
    one = spark.createDataFrame([(i, EN, "en") for i in range(9)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in identify(one).collect()} == {("en", 1.0)}
    none = spark.createDataFrame([(i, EN, None) for i in range(9)], SCHEMA)
    assert {(r.lang_pred, r.score, r.accepted) for r in identify(none).collect()} == {("und", 0.0, False)}


def test_sample_is_bounded_and_ignores_copies(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 8)
    rows = [(i, "copied text " * 50, "en") for i in range(300)]
    rows += [(1000 + i, f"{EN} number {i}", "en") for i in range(200)]
    (found,) = learn(spark.createDataFrame(rows, SCHEMA))
    parts = found[1].split("\n")
    assert len(parts) == 8 and len(set(parts)) == 8 and sum("copied" in p for p in parts) <= 1
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError):
        learn(spark.createDataFrame(rows_of(2), SCHEMA))

import random

from pyspark.sql import functions as F

from harrow.llm.chat import escape, format_chats, parse_chats, unescape

MARKS = ["<|start|>", "<|say|>", "<|part|>", "<|end|>\n", "<|end|>", "<|im_end|>", "</s>", "<s>",
         "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "\\\\", "<", "|", "[", "\n", "é", " ok "]


def test_escape_round_trip(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(MARKS, k=rng.randrange(12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", escape(F.col("t")).alias("e"),
                     unescape(escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not any(m in r.e for m in MARKS[:12] if len(m) > 2)


def make():
    rng = random.Random(2)
    rows = []
    for c in range(40):
        for t in range(rng.choice([1, 2, 5, 600 if c == 3 else 9])):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "to\nol", "<|say|>"]),
                         "".join(rng.choices(MARKS, k=rng.randrange(8)))))
    rows += [(None, 1, "user", "x"), (None, None, None, None), (77, 1, "assistant", "b"),
             (77, 1, "assistant", "a"), (77, 1, "assistant", "a"), (78, 0, "assistant", "y" * 100000)]
    return rows


def test_turns_and_loss_read_back(spark):
    rows = make()
    shuffled = random.Random(3).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string")
    df = df.select("*", F.lit(1).alias("turns"), F.lit(2).alias("edges"))
    chats = format_chats(df)
    got = {r.conv_id: r for r in parse_chats(chats).collect()}
    forms = {r.conv_id: r for r in chats.collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None,
                                                        r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert list(got[c].learned) == [x for r, x in turns if r == "assistant"]
        assert got[c].formatted_chars == len(forms[c].formatted)
        blocks = sum(1 for i, t in enumerate(turns) if i == 0 or turns[i - 1][0] != t[0])
        assert forms[c].formatted.count("<|start|>") == blocks
        ends = [(s.start, s.end) for s in forms[c].loss]
        assert all(a <= b for a, b in ends) and ends == sorted(ends)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert parse_chats(format_chats(df)).count() == 0

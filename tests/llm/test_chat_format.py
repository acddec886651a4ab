import hashlib
import random

from pyspark.sql import functions as F

from tessera.llm.chat_format import format_chats, read_loss, read_turns

PIECES = ["<|im_start|>", "<|im_next|>", "<|im_end|>", "\n", "</s>", "<s>", "[INST]", "[/INST]", "&", "amp;", "&amp;", "&lt;", "lt;", "&lsqb;",
          "&NewLine;", "<", "[", "é", "<|endoftext|>", "ok", " ", "user", "", "\\", "$1"]


def test_round_trip_of_any_text(spark):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "a\nb<|im_end|>", None]), rnd.choice([None, "".join(rnd.choices(PIECES, k=rnd.randrange(9)))]), "x")
            for c in list(range(60)) + [None] for t in rnd.sample(range(40), rnd.randrange(1, 12)) + [None, 3, 3]]
    rows += [rows[0], rows[0]]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string"))
    got = out.select("conv_id", "formatted", "segments", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss")).collect()
    by = {}
    for c, t, r, x, _ in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert len(got) == len(by)
    for g in got:
        want = [(r, x) for _, _, r, x in sorted(by[g.conv_id])]
        assert [(t.role, t.text) for t in g.turns] == want
        assert g.loss == "".join(x for r, x in want if r == "assistant")
        assert "".join(s.text for s in g.segments) == g.formatted
        runs = sum(1 for i, (r, _) in enumerate(want) if i == 0 or want[i - 1][0] != r)
        assert g.formatted.count("<|im_start|>") == g.formatted.count("<|im_end|>\n") == runs
        assert g.formatted.count("<|im_next|>") == len(want) - runs and "[INST]" not in g.formatted and "</s>" not in g.formatted


def test_a_plain_conversation(spark):
    out = format_chats(spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b < c")], "conv_id long, turn long, role string, text string"))
    assert out.first().formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<|im_next|>b < c<|im_end|>\n"


def test_many_turns_and_no_turns(spark):
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                      F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.lit("text <s>").alias("text"))
    got = format_chats(rows).select(read_loss(F.col("segments")).alias("l"), F.size(read_turns(F.col("formatted"))).alias("n")).first()
    assert got.n == 20_000 and hashlib.sha256(got.l.encode()).digest() == hashlib.sha256(b"text <s>" * 13_333).digest()
    assert format_chats(rows.limit(0)).count() == 0

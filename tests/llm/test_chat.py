import random
import time

from pyspark.sql import functions as F

from pixelloom.llm import chat

BITS = ["\\", "##", "#", "###", "</turn>", "</turn>\n", "<part/>", "<", "/turn>", ":", ": ", "a", "é", "\n", "$1", "\U0001f600", "### Assistant: "]


def test_round_trip_of_control_strings(spark):
    r = random.Random(2)
    text = lambda: "".join(r.choice(BITS) for _ in range(r.randrange(9)))
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "a:b\\#", None]), r.choice([text(), None]), 0) for c in range(60) for t in range(r.randrange(1, 9))]
    rows += [(900, 1, "user", "b", 0), (900, 1, "user", "a", 0), (900, 1, "user", "a", 0), (None, None, "assistant", "x" * 200_000, 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted int").repartition(3)
    out = chat.format_chats(df).select("conv_id", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(out) == len({x[0] for x in rows})
    for got in out:
        own = sorted(((x[1], x[2] or "", x[3] or "") for x in rows if x[0] == got.conv_id), key=lambda x: (x[0] or 0, *x[1:]))
        assert [tuple(t) for t in got.turns] == [x[1:] for x in own]
        assert got.loss == "".join(x[2] for x in own if x[1] == "assistant")
        assert "".join(got.formatted[s.start : s.start + s.length] for s in got.loss_spans).count("</turn>") == 0
        blocks = sum(a[1] != b[1] for a, b in zip(own, own[1:])) + 1
        assert got.formatted.count("</turn>\n") == blocks
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_roles_and_many_turns(spark):
    """Roles of 100,000 characters, control strings among them, and conversations of thousands of turns, merged and not."""
    roles = ["a" * 100_000, ":" * 100_000, "\\" * 100_000, "\\:" * 50_000, "### x: " * 15_000, "é</turn>" * 12_000]
    rows = [(i, 0, role, "t") for i, role in enumerate(roles)]
    rows += [(100, i, "assistant" if i % 2 else "user", f"t{i}:") for i in range(5_000)] + [(101, i, "assistant", "") for i in range(3_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    began = time.time()
    out = chat.format_chats(df).select("conv_id", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert time.time() - began < 60
    for got in out:
        own = [(x[2], x[3]) for x in rows if x[0] == got.conv_id]
        assert [tuple(t) for t in got.turns] == own
        assert got.loss == "".join(t for r, t in own if r == "assistant")
        bodies = [got.formatted[s.start : s.start + s.length] for s in got.loss_spans]
        assert [b.replace("\\", "") for b in bodies] == [t for r, t in own if r == "assistant"]

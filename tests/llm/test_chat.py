from reelhouse.llm import chat
from pyspark.sql import functions as F

HARD = ["", "\\", "<|end|>", "a\\<|b", "<\\|", "\\### Assistant: </turn> ok", "<|turn|>user<|says|>x<|end|>", "<", "|>", "é\n$1 \\\\", "<" * 3 + "|"]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, no int, start string")


def read(df):
    out = df.withColumn("p", chat.read_pieces(F.col("formatted")))
    out = out.select("conv_id", "formatted", chat.read_turns(F.col("p")).alias("t"), chat.loss_texts(F.col("p"), F.col("loss")).alias("l"), "loss")
    return {r.conv_id: r for r in out.collect()}


def test_texts_come_back(spark):
    rows = [(1, i, ("user", "assistant", "<|says|>\\")[i % 3], t, 1, "q") for i, t in enumerate(HARD)]
    rows += [(2, 0, "assistant", "x" * 200_000, 1, "q"), (3, None, None, None, 1, "q"), (3, 1, "assistant", "b", 1, "q"), (3, 1, "assistant", "b", 1, "q")]
    rows += [(None, 0, "assistant", "n", 1, "q")]
    got = read(chat.format_conversations(turns(spark, rows).withColumn("parts", chat.text_parts("text"))))
    assert [(t.role, t.text) for t in got[1].t] == [(r[2], r[3]) for r in rows if r[0] == 1]
    assert list(got[1].l) == [r[3] for r in rows if r[0] == 1 and r[2] == "assistant"]
    assert [(t.role, t.text) for t in got[3].t] == [("", ""), ("assistant", "b"), ("assistant", "b")]
    assert list(got[2].l) == ["x" * 200_000] and list(got[None].l) == ["n"]
    for r in got.values():  # the spans are places in the formatted text
        plain = [chat_unescape(r.formatted[s.start : s.end]) for s in r.loss]
        assert plain == list(r.l)


def chat_unescape(s):
    import re

    return re.sub(r"\\(.)", r"\1", s, flags=re.S)


def test_typed_parts(spark):
    part = lambda kind, text=None, ref=None, units=None: (kind, text, ref, units)
    rows = [
        (1, 0, "user", [part("text", "<"), part("text", "|a"), part("image", None, "s3://i", 2), part("audio", None, "a.wav", 10)]),
        (1, 1, "assistant", [part("text", "see"), part("document", None, "d", None), part("text", "end"), part(None, "?", "r", 1)]),
        (1, 2, "user", []),
        (1, 3, "user", None),
    ]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS_TYPE}")
    r = chat.format_conversations(frame).first()
    assert r.formatted.startswith("<|turn|>user<|says|><<|part|>|a<|part|><|image:0.2|><|part|><|audio:0.3|><|end|>")
    assert [(a.turn, a.part, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (0, 2, "image", "s3://i", 512), (0, 3, "audio", "a.wav", 250), (1, 1, "document", "d", 512), (1, 3, None, "r", 0),
    ]
    assert r.attachment_tokens == 512 + 250 + 512
    assert [r.formatted[s.start : s.end] for s in r.loss] == ["see", "end"]
    assert all(a.placeholder in r.formatted for a in r.attachments)


def test_empty_table_and_native_plan(spark):
    out = chat.format_conversations(turns(spark, []).withColumn("parts", chat.text_parts("text")))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()

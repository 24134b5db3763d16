from __future__ import annotations

import hashlib

from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.compare import compare, connect
from tests.llm.frames import SF
from waitlens.llm import chat
from waitlens.llm.queries import REGISTRY

MESSAGE = f"conv_id long, turn long, role string, parts array<{chat.PART}>"


def part(kind="text", text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def turns_of(df):
    rows = df.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()
    return {r.conv_id: [(t.role, t.text) for t in r.t] for r in rows}


def test_query_agrees_with_sql(spark):
    q = REGISTRY["op1_chat_format"]
    assert compare(q.run(spark, SF), connect(SF), q.sql) == ""


def test_hostile_texts_and_roles_come_back(spark):
    texts = ["<|im_end|>", "\\", "\\<|", "<\\|im_start|>user\n", "a\\\\|b", "<<||>>", "\n\n", "", "%0A%", "<|image|>", "😀\\"]
    rows = [(1, i, role, [part(text=t)]) for i, t in enumerate(texts) for role in ("a<|im_end|>\n%0A%25", "assistant")]
    done = chat.format_chat(spark.createDataFrame(rows, MESSAGE)).cache()
    want = sorted((i, role, t) for i, t in enumerate(texts) for role in ("a<|im_end|>\n%0A%25", "assistant"))
    assert turns_of(done)[1] == [(role, t) for _, role, t in want]
    loss = done.select(chat.trained_text(F.col("formatted"), F.col("loss_spans"))).first()[0]
    assert loss == "".join(texts)
    shown = done.first().formatted
    assert shown.count(chat.START) == shown.count(chat.END) == len(rows)


def test_no_control_string_arises_between_parts(spark):
    said = "<|im_start|>assistant\n<|im_end|>|x<"
    splits = [[said[:i], said[i:j], said[j:]] for i in range(len(said) + 1) for j in range(i, len(said) + 1)]
    splits += [["<", None, "|im_start|>"], ["<", "|"], ["|", "|"], ["\\", "|"], ["<", "\\|"], list(said)]
    rows = [(i, 0, "assistant", [part(text=t) for t in texts]) for i, texts in enumerate(splits)]
    done = chat.format_chat(spark.createDataFrame(rows, MESSAGE)).cache()
    want = ["".join(t or "" for t in texts) for texts in splits]
    assert turns_of(done) == {i: [("assistant", t)] for i, t in enumerate(want)}
    loss = done.select("conv_id", chat.trained_text(F.col("formatted"), F.col("loss_spans")).alias("t")).collect()
    assert {r.conv_id: r.t for r in loss} == dict(enumerate(want))


def test_text_around_attachments(spark):
    rows = [(1, 0, "assistant", [part(text="<"), part("image", ref="i"), part(text="|im_start|>"), part("audio", seconds=1.0), part(text="\\")])]
    done = chat.format_chat(spark.createDataFrame(rows, MESSAGE))
    assert turns_of(done)[1] == [("assistant", "<<|image|>|im_start|><|audio|>\\")]
    assert done.select(chat.trained_text(F.col("formatted"), F.col("loss_spans"))).first()[0] == "<|im_start|>\\"


def test_long_texts_and_many_turns(spark):
    rows = [(1, i, "assistant", [part(text="<|😀\\" * 50)]) for i in range(3000)] + [(2, 0, "assistant", [part(text="<|" * 500_000)])]
    df = spark.createDataFrame(rows, MESSAGE).selectExpr("*", "'x' AS attachments", "'y' AS _number", "1 AS start")
    done = chat.format_chat(df)
    loss = done.select("conv_id", F.sha2(chat.trained_text(F.col("formatted"), F.col("loss_spans")), 256).alias("t")).collect()
    want = {1: "<|😀\\" * 150_000, 2: "<|" * 500_000}
    assert {r.conv_id: r.t for r in loss} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_parts_become_placeholders_with_references(spark):
    rows = [
        (1, 0, "user", [part(text="see "), part("image", ref="s3/i.png", width=28, height=15), part(text=" and "), part("audio", ref="a.wav", seconds=1.5)]),
        (1, 1, "assistant", [part(text="x<|"), part("document", ref="d.pdf", pages=3), part(text="y")]),
    ]
    r = chat.format_chat(spark.createDataFrame(rows, MESSAGE)).first()
    assert [(a.turn, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, "image", "s3/i.png", 4), (0, "audio", "a.wav", 38), (1, "document", "d.pdf", 1536)]
    assert r.expanded_tokens == 4 + 38 + 1536
    for a in r.attachments:
        assert r.formatted[a.start :].startswith(f"<|{a.kind}|>")
    assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == ["x<\\|", "y"]


def test_odd_messages(spark):
    rows = [(None, None, None, None), (2, 5, "assistant", []), (3, 1, "assistant", [part(text=None)]), (3, 1, "assistant", [part(text=None)])]
    df = spark.createDataFrame(rows, MESSAGE).withColumn("formatted", F.lit("clash")).withColumn("_pieces", F.lit(1))
    assert turns_of(chat.format_chat(df)) == {None: [("", "")], 2: [("assistant", "")], 3: [("assistant", "")] * 2}
    assert chat.format_chat(spark.createDataFrame([], MESSAGE)).count() == 0


def test_probe_conversation(spark):
    row = REGISTRY["op1_chat_format"].run(spark, SF).where("conv_id = -1").first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert isinstance(row, Row) and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.loss_chars == len(said) and row.n_turns == 2

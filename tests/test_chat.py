import pytest
from pyspark.sql import functions as F

from textloom.config import TokenizerConfig
from textloom.functions import chatml
from textloom.operators import bpe_codec, bpe_train, chat, preference

SYSTEM = "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
OPEN = "<|im_start|>assistant\n"
MSGS = "id int, messages array<struct<role:string,content:string>>"
SHAPES = MSGS + ", prompt string, completion string, instruction string, input string, question string, output string, response string, answer string"


def shape(i, **given):
    names = ["messages", "prompt", "completion", "instruction", "input", "question", "output", "response", "answer"]
    return (i, *[given.get(n) for n in names])


def test_normalize_messages(spark):
    rows = [
        shape(1, messages=[("user", "hi"), (None, "x"), ("assistant", ""), ("assistant", None)], prompt="p", completion="c"),
        shape(2, messages=[], instruction="ignored"),
        shape(3, prompt="p", completion=""),
        shape(4, prompt="only", instruction="", input="in", question="q", output=None, response="r"),
        shape(5, question="q", answer="a"),
        shape(6),
    ]
    df = chatml.normalize_messages(spark.createDataFrame(rows, SHAPES))
    got = {r.id: [tuple(m) for m in r.messages] for r in df.collect()}
    assert got == {
        1: [("user", "hi"), ("user", "x")],
        2: [],
        3: [("user", "p"), ("assistant", "")],
        4: [("user", "in"), ("assistant", "r")],
        5: [("user", "q"), ("assistant", "a")],
        6: [("user", ""), ("assistant", "")],
    }


@pytest.fixture(scope="module")
def talks(spark):
    rows = [
        (1, [("user", "  hi \n"), ("assistant", " yes ")]),
        (2, [("system", "S"), ("tool", "t"), ("assistant", "a")]),
        (3, []),
    ]
    return spark.createDataFrame(rows, MSGS)


def test_segments(talks):
    got = {r.id: [tuple(s) for s in r.s] for r in talks.select("id", chatml.segments(F.col("messages")).alias("s")).collect()}
    assert got[1] == [
        (SYSTEM, False),
        ("<|im_start|>user\nhi<|im_end|>\n", False),
        (OPEN, False),
        ("yes<|im_end|>\n", True),
    ]
    assert got[2] == [
        ("<|im_start|>system\nS<|im_end|>\n", False),
        ("<|im_start|>user\nt<|im_end|>\n", False),
        (OPEN, False),
        ("a<|im_end|>\n", True),
    ]
    assert got[3] == [(SYSTEM, False)]


def test_generation_prompt(talks):
    got = {r.id: r.p for r in talks.select("id", chatml.generation_prompt(F.col("messages")).alias("p")).collect()}
    assert got[1] == SYSTEM + "<|im_start|>user\n  hi \n<|im_end|>\n" + OPEN + " yes <|im_end|>\n" + OPEN
    assert got[2] == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nt<|im_end|>\n" + OPEN + "a<|im_end|>\n" + OPEN
    assert got[3] == SYSTEM + OPEN


def test_normalize_pairs_from_text(spark):
    spec = "id int, prompt string, input string, chosen string, accept string, rejected string, rejected_response string"
    rows = [(1, "", "ask", "c", None, None, "rr"), (2, None, None, None, "acc", "", None)]
    got = {r.id: r for r in chatml.normalize_pairs(spark.createDataFrame(rows, spec)).collect()}
    assert got[1].prompt == SYSTEM + "<|im_start|>user\nask<|im_end|>\n" + OPEN
    assert (got[1].chosen, got[1].rejected) == ("c<|im_end|>", "rr<|im_end|>")
    assert got[2].prompt == SYSTEM + "<|im_start|>user\n<|im_end|>\n" + OPEN
    assert (got[2].chosen, got[2].rejected) == ("acc<|im_end|>", "<|im_end|>")


def test_normalize_pairs_from_messages(spark):
    m = "array<struct<role:string,content:string>>"
    spec = f"id int, prompt string, messages {m}, chosen {m}, reject {m}"
    asked = [("critic", " q "), ("assistant", "skipped"), (None, None)]
    rows = [
        (1, "", asked, [("user", "u"), ("assistant", ""), ("assistant", "a")], []),
        (2, "text", asked, [("assistant", "x")], [("assistant", "y")]),
        (3, None, [("system", "S"), ("user", "u")], [], None),
    ]
    got = {r.id: r for r in chatml.normalize_pairs(spark.createDataFrame(rows, spec)).collect()}
    assert got[1].prompt == SYSTEM + "<|im_start|>critic\n q <|im_end|>\n<|im_start|>user\n<|im_end|>\n" + OPEN
    assert (got[1].chosen, got[1].rejected) == ("u\na<|im_end|>", "<|im_end|>")
    assert got[2].prompt == SYSTEM + "<|im_start|>user\ntext<|im_end|>\n" + OPEN
    assert got[3].prompt == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nu<|im_end|>\n" + OPEN


@pytest.fixture(scope="module")
def model(spark, talks):
    seen = talks.select(F.explode(chatml.segments(F.col("messages"))).alias("s")).select("s.text")
    return bpe_train.train(seen, TokenizerConfig(vocab_size=60)).with_special_tokens()


def test_encode_chat_masks_and_truncates(spark, talks, model):
    encode = bpe_codec.piece_encoder(model.vocab, model.merges, model.special, None)

    def by_segment(segments):
        ids, labels = [model.bos_id], [-100]
        for text, trainable in segments:
            row = spark.createDataFrame([(text,)], "t string")
            part = row.select(bpe_codec.encode(F.col("t"), model).alias("i")).first().i
            ids += part
            labels += part if trainable else [-100] * len(part)
        return ids + [model.eos_id], labels + [model.eos_id]

    segments = {r.id: r.s for r in talks.select("id", chatml.segments(F.col("messages")).alias("s")).collect()}
    for limit in (1000, 9):
        for row in chat.encode_chat(talks, model, limit).collect():
            ids, labels = by_segment(segments[row.id])
            assert (row.input_ids, row.labels) == (ids[:limit], labels[:limit])
    assert encode("<|im_end|>") == [model.vocab["<|im_end|>"]]


def test_pad_batches(spark):
    rows = [(1, [5, 6, 7], [-100, 6, 7]), (2, [5], [5]), (3, [9], [9])]
    df = spark.createDataFrame(rows, "id int, input_ids array<int>, labels array<int>")
    out = {r.id: r for r in chat.pad_chat_batches(df, "id", 2, pad_id=3).collect()}
    assert (out[1].input_ids, out[1].labels, out[1].attention_mask) == ([5, 6, 7], [-100, 6, 7], [1, 1, 1])
    assert (out[2].input_ids, out[2].labels, out[2].attention_mask) == ([5, 3, 3], [5, -100, -100], [1, 0, 0])
    assert (out[3].batch_id, out[3].input_ids) == (1, [9])


def test_encode_and_pad_pairs(spark, model):
    df = spark.createDataFrame([(1, "user\n", "yes<|im_end|>", "a"), (2, "hi", "a", "yesyes")], "id int, prompt string, chosen string, rejected string")
    rows = {r.id: r for r in preference.encode_pairs(df, model, 1000).collect()}
    ids = {c: {r.id: r.i for r in df.select("id", bpe_codec.encode(F.col(c), model).alias("i")).collect()} for c in ("prompt", "chosen", "rejected")}
    for i, row in rows.items():
        for side in ("chosen", "rejected"):
            assert row[f"{side}_input_ids"] == ids["prompt"][i] + ids[side][i]
            assert row[f"{side}_labels"] == [-100] * len(ids["prompt"][i]) + ids[side][i]
    assert all(len(r.chosen_labels) == 2 for r in preference.encode_pairs(df, model, 2).collect())
    padded = preference.pad_pair_batches(preference.encode_pairs(df, model, 1000), "id", 2, model.pad_id)
    for side in ("chosen", "rejected"):
        longest = max(len(r[f"{side}_input_ids"]) for r in rows.values())
        for r in padded.collect():
            known = rows[r.id]
            short = longest - len(known[f"{side}_input_ids"])
            assert r[f"{side}_input_ids"] == known[f"{side}_input_ids"] + [model.pad_id] * short
            assert r[f"{side}_labels"] == known[f"{side}_labels"] + [-100] * short

import hashlib

from hypothesis import given, settings, strategies as st

from helpers import CLASHING
from pyspark.sql import functions as F
from textflow.llm import chat_format as cf

PARTS = ["<|turn|>", "<|says|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "\\", "<", "[", "|", "a", "é", "\n", "turn|>", "s>"]


def test_escaping_round_trip(spark):
    import random

    draw = random.Random(4)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 9))) for _ in range(3000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", cf.escape(F.col("t")).alias("e")).collect()
    for r in rows:
        assert cf.unescape(r["e"]) == texts[r["i"]]
        assert not any(mark in r["e"] for mark in ("<|turn|>", "<|says|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<|im_end|>"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=8).map("".join), st.lists(st.sampled_from(PARTS), max_size=8).map("".join))
def test_a_piece_reads_back(role, text):
    import re

    esc = lambda t: re.sub(cf._CONTROL, r"\1\\\2\3", t)
    assert cf.parse_piece(cf.TURN + esc(role) + cf.SAYS + esc(text) + cf.END) == (role, text)


def test_examples_written_out(spark):
    turns = [(1, 0, "system", "be <s> kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "</s> ho \U0001F600"),
             (1, 3, "user", "and?"), (1, 4, "assistant", "end"), (1, 5, "user", "bye"), (2, 0, "user", "alone")]
    formatted = cf.format_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    examples = {(r["conv_id"], r["example"]): r for r in cf.render(formatted).collect()}
    assert set(examples) == {(1, 3), (1, 5)}
    one, two = examples[1, 3], examples[1, 5]
    assert two["text"].startswith(one["text"])
    assert cf.unescape(one["text"][one["loss_start"]:one["loss_stop"]]) == "</s> ho \U0001F600"
    assert two["text"][two["loss_start"]:two["loss_stop"]] == "end"
    # the same examples by ranges: the context is what stands before the turn's own piece
    ranged = {(r["conv_id"], r["example"]): r for r in cf.expand(formatted).collect()}
    assert set(ranged) == set(examples)
    for key, r in ranged.items():
        text = examples[key]["text"]
        assert (r["context_start"], r["stop"], text[r["context_stop"]:]) == (0, len(text), r["piece"])
        assert (r["loss_start"], r["loss_stop"]) == (examples[key]["loss_start"], examples[key]["loss_stop"])
    assert one["text"].count(cf.TURN) == 3 and two["text"].count(cf.TURN) == 5
    read = {r["conv_id"]: r for r in cf.read_back(formatted, cf.expand(formatted)).collect()}
    assert read[1]["formatted_chars"] == len(one["text"]) + len(two["text"]) and read[2]["formatted_chars"] == 0
    assert read[2]["loss_sha256"] == hashlib.sha256(b"").hexdigest() and read[1]["n_turns"] == 6


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a"), (None, None, "assistant", None), (1, 0, None, "x"), (1, 0, None, "x"), (2, 5, "assistant", ""),
            (3, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for k, name in enumerate((*CLASHING, "piece", "stop", "start", "before")):
        df = df.withColumn(name, F.lit(k))
    turns = cf.format_turns(df)
    read = {r["conv_id"]: r for r in cf.read_back(turns, cf.expand(turns)).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in read.items()} == {None: (2, 0), 1: (2, 0), 2: (1, 0), 3: (1, 250_000)}
    assert read[None]["turns_sha256"] == hashlib.sha256(b"assistant\n\nuser\na\n").hexdigest()
    assert read[1]["turns_sha256"] == hashlib.sha256(b"\nx\n\nx\n").hexdigest()
    none = cf.format_turns(df.limit(0))
    assert cf.read_back(none, cf.expand(none)).count() == 0

from pyspark.sql import functions as F

from adlake.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, valid string, segments string"
HARD = ["<|im_end|>", "<\\|im_start|>", "\\", "\\\\<|", "a<", "|b", "<\\", "\n\n", "", "é\U0001f600<|im_start|>user\nhi"]


def rows(*turns):
    return [(*t, "x", "y") for t in turns]


def read(df):
    return df.select(
        "conv_id", "formatted", "valid", "bad_turn",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
    ).collect()


def test_round_trip_of_control_strings(spark):
    given = rows(*[(n, k, role, h) for n, h in enumerate(HARD) for k, role in enumerate(("user", "assistant"))])
    out = {r.conv_id: r for r in read(chat.format_conversations(spark.createDataFrame(given, SCHEMA)))}
    for n, h in enumerate(HARD):
        assert [tuple(t) for t in out[n].turns] == [("user", h), ("assistant", h)]
        assert out[n].loss == h and out[n].valid
        assert out[n].formatted.count("<|im_start|>") == 2


def test_automaton(spark):
    given = rows(
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
        (2, 0, "assistant", "a"),
        (3, 0, "user", "u"),
        (4, 0, "user", "u"), (4, 1, "user", "u"), (4, 2, "assistant", "a"),
        (5, 0, "user", "u"), (5, 1, "wizard\n<|im_end|>", "w"),
    )
    out = {r.conv_id: r for r in read(chat.format_conversations(spark.createDataFrame(given, SCHEMA)))}
    assert {c: (r.valid, r.bad_turn) for c, r in out.items()} == {
        1: (True, None), 2: (False, 1), 3: (False, None), 4: (False, 2), 5: (False, 2)
    }
    assert out[5].turns[1].role == "wizard\n<|im_end|>"
    assert out[1].formatted == (
        "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    )


def test_nulls_ties_repeats_long_and_empty(spark):
    long = "word " * 100_000
    given = rows(
        (None, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
        (1, 1, "assistant", long),
    )
    out = {r.conv_id: r for r in read(chat.format_conversations(spark.createDataFrame(given, SCHEMA)))}
    assert [tuple(t) for t in out[None].turns] == [("", "")]
    assert [t.text for t in out[1].turns] == ["a", "a", "b", long] and out[1].loss == long
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0

from municare.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place int, n int"


def talk(spark, *turns):
    return spark.createDataFrame([(*t, 0, 0) for t in turns], SCHEMA)


def test_prefixes_and_copies_go(spark):
    rows = talk(
        spark,
        (1, 0, "user", "hi"), (1, 1, "assistant", "ho"),
        (2, 0, "user", "hi"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "ho"), (3, 2, "user", "bye"),
        (4, 5, "user", "hi"), (4, 7, "assistant", "ho"), (4, 9, "user", "bye"),
        (5, 0, "user", "hi"), (5, 1, "assistant", "other"),
    )
    got = {r["conv_id"]: r for r in chat.format_chats(rows).collect()}
    assert set(got) == {3, 5}
    assert got[5]["rendered"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"
    assert got[3]["n_turns"] == 3


def test_order_matters_and_nulls_differ_from_empty(spark):
    rows = talk(
        spark,
        (1, 0, "user", "a"), (1, 1, "user", "b"),
        (2, 0, "user", "b"), (2, 1, "user", "a"), (2, 2, "user", "c"),
        (3, 0, "user", ""), (4, 0, "user", None), (None, 0, None, "x"),
        (5, None, "user", "z"), (5, None, "user", "z"), (5, 0, "user", "y"),
    )
    got = {r["conv_id"]: r["rendered"] for r in chat.format_chats(rows).collect()}
    assert set(got) == {1, 2, 3, 4, None, 5}
    assert got[4] == got[3] == "<|im_start|>user\n<|im_end|>\n"
    assert got[5].count("<|im_start|>") == 2 and got[5].index("z") < got[5].index("y")


def test_long_conversations_come_in_parts(spark):
    rows = talk(spark, *[(1, i, "user", f"t{i}") for i in range(25)], *[(2, i, "user", f"t{i}") for i in range(24)])
    got = sorted((r["conv_id"], r["part"], r["rendered"].count("user")) for r in chat.format_chats(rows, 10).collect())
    assert got == [(1, 0, 10), (1, 1, 10), (1, 2, 5)]


def test_no_rows(spark):
    assert chat.format_chats(talk(spark)).count() == 0

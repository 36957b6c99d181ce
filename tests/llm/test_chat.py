import time

from txrisk.llm.chat import chat_format

KINDS = "conv_id long, turn long, role string, text string, h string, chain int"


def logs(spark, conversations):
    rows = [
        (conv, turn, role, text, "x", 1)
        for conv, turns in conversations
        for turn, role, text in turns
    ]
    return spark.createDataFrame(rows, KINDS)


def talk(*texts, start=0):
    return [(start + i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]


def test_snapshots_collapse(spark):
    found = chat_format(logs(spark, [
        (1, talk("a")), (2, talk("a", "b")), (3, talk("a", "b", "c")), (4, talk("a", "x")), (5, talk("a", "b", "c", start=9)),
        (6, talk("b", "c")), (7, talk("ab")),
    ]).repartition(4)).collect()
    assert {(r.conv_id, r.n_turns, r.n_copies) for r in found} == {(3, 3, 2), (4, 2, 1), (6, 2, 1), (7, 1, 1)}
    rendered = {r.conv_id: r.rendered for r in found}
    assert rendered[4] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"


def test_nulls_ties_and_repeats(spark):
    found = chat_format(logs(spark, [
        (1, [(0, "user", "a"), (None, None, None)]), (2, [(0, "user", "a"), (0, "user", "a")]), (None, [(1, "user", "z")]),
        (3, [(5, "", ""), (4, "user", "a")]),
    ])).collect()
    assert {(r.conv_id, r.n_turns, r.n_copies) for r in found} == {(1, 2, 2), (2, 2, 1), (None, 1, 1)}


def test_role_and_text_stay_apart(spark):
    found = chat_format(logs(spark, [(1, [(0, "a", "bc")]), (2, [(0, "ab", "c")])])).collect()
    assert {r.conv_id for r in found} == {1, 2}


def test_long_and_common_conversations(spark):
    long = [(i, "user", str(i)) for i in range(1500)]
    found = chat_format(logs(spark, [(i, talk("hi", "ho")) for i in range(200)] + [(999, long), (998, long[:700])])).collect()
    assert {(r.conv_id, r.n_turns, r.n_copies) for r in found} == {(0, 2, 200), (999, 1500, 1)}


def test_empty(spark):
    assert chat_format(logs(spark, [(1, talk("a"))]).limit(0)).count() == 0


def test_very_long_conversations_are_hashed_in_linear_time(spark):
    def long(conv, n):
        return spark.range(n).selectExpr(
            f"{conv} as conv_id", "id as turn", "'user' as role", "cast(id as string) as text"
        )

    turns = long(1, 300_000).unionByName(long(2, 299_999)).unionByName(long("cast(null as int)", 300_000))
    start = time.perf_counter()
    found = chat_format(turns).select("conv_id", "n_turns", "n_copies").collect()
    assert {tuple(r) for r in found} == {(1, 300_000, 2)}
    assert time.perf_counter() - start < 60

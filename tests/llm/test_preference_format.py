from plateward.llm import preference_format as p

TURN = "struct<role:string,text:string>"


def formatted(spark, chosen, rejected):
    df = spark.createDataFrame([(1, chosen, rejected)], f"k int, chosen array<{TURN}>, rejected array<{TURN}>")
    return p.formatted(df).first()


def test_prompt_completions_and_masks(spark):
    ask, good, bad = ("user", "Wie geht’s? 😀"), ("assistant", "Gut."), ("assistant", "Schlecht.")
    more = ("user", "Warum?")
    row = formatted(spark, [ask, good, more, good], [ask, bad])
    assert row["n_common"] == 1 and row["prompt"] == "<|start|>user\nWie geht’s? 😀<|end|>\n"
    learnt = [row["chosen_text"][a:b] for a, b in row["chosen_spans"]]
    assert learnt == ["Gut.<|end|>\n", "Gut.<|end|>\n"]
    assert [row["rejected_text"][a:b] for a, b in row["rejected_spans"]] == ["Schlecht.<|end|>\n"]
    assert row["usable"]


def test_equal_null_and_empty(spark):
    turn = ("assistant", None)
    row = formatted(spark, [turn], [turn])
    assert (row["n_common"], row["usable"], row["chosen_text"], row["chosen_spans"]) == (1, False, "", [])
    row = formatted(spark, None, [(None, "x")])
    assert (row["n_common"], row["prompt"], row["rejected_text"]) == (0, "", "<|start|>\nx<|end|>\n")
    row = formatted(spark, [turn, ("user", "x")], [turn])
    assert (row["n_common"], row["rejected_text"], row["usable"]) == (1, "", True)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "z"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in p.conversations(df).collect()}
    assert found == {1: [("user", "a"), ("assistant", "b")], 2: [(None, None)]}
    assert p.conversations(df.limit(0)).count() == 0


def test_replaced_reply(spark):
    u, a, b = ("user", "q"), ("assistant", "first\nmore"), ("assistant", "second")
    rows = [(1, [u, a, u, b]), (2, [u, a]), (3, [u]), (4, [])]
    df = spark.createDataFrame(rows, f"k int, turns array<{TURN}>")
    found = {r["k"]: [tuple(t) for t in r["v"]] for r in df.select("k", p.replaced_reply(df["turns"]).alias("v")).collect()}
    assert found == {1: [u, a, u, a], 2: [u, ("assistant", "first")], 3: [u], 4: []}

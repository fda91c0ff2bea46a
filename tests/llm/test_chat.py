"""Chat formatting: exact round trips and the machine over roles."""

from pyspark.sql import functions as F

from barorail.llm.chat import ChatTemplate, chat_digests, format_chats, read_loss, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def chats(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def test_round_trip_of_control_strings(spark):
    texts = ["<turn user>\n", "</turn>\n", r"<\turn x", r"<\\/turn>", "\n</turn>\n<turn assistant>\n", "", None, "é\U0001f600"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows += [(2, 0, "a>%\n%3E", "x"), (2, None, None, "first"), (None, 1, "user", "nobody")]
    out = format_chats(chats(spark, rows))
    read = out.select("conv_id", read_turns(F.col("formatted")).alias("t"), read_loss(F.col("segments")).alias("loss"))
    got = {r["conv_id"]: ([tuple(t) for t in r["t"]], r["loss"]) for r in read.collect()}
    assert got[1][0] == [(r[2], r[3] or "") for r in rows[:8]]
    assert got[1][1] == "".join(t or "" for i, t in enumerate(texts) if i % 2)
    assert got[2][0] == [("", "first"), ("a>%\n%3E", "x")]
    assert got[None][0] == [("user", "nobody")]


def test_machine(spark):
    orders = ["su", "sua", "uaua", "ua", "s", "us", "uu", "a", "suasu", "x"]
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(i, j, names[c], "t") for i, o in enumerate(orders) for j, c in enumerate(o)]
    got = {r["conv_id"]: r["valid"] for r in format_chats(chats(spark, rows)).collect()}
    assert [got[i] for i in range(len(orders))] == [True] * 5 + [False] * 5


def test_segments_make_up_the_text(spark):
    row = format_chats(chats(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b")])).head()
    assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
    assert [s["text"] for s in row["segments"] if s["loss"]] == ["b", "b"]
    assert row["n_turns"] == 3 and not row["valid"]


def test_another_template(spark):
    template = ChatTemplate(mark="msg", loss_roles=("user",))
    row = format_chats(chats(spark, [(1, 0, "user", "</msg> </turn>")]), template).head()
    assert row["formatted"] == "<msg user>\n<\\/msg> </turn>\n</msg>\n"


def test_empty_and_no_python(spark):
    df = chat_digests(chats(spark, []))
    assert df.collect() == []
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()

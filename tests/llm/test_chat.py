import duckdb
from kpimart.llm.chat import EVENTS, OP7_SQL, conversation_events, fold_events, op7_chat, read_back, render

from conftest import SF0001  # noqa: I001


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF0001}/conversations.parquet'")
    want = con.execute(OP7_SQL).df().sort_values("conv_id").reset_index(drop=True)
    got = op7_chat(spark, SF0001).toPandas().sort_values("conv_id").reset_index(drop=True)
    assert got.equals(want[got.columns])


def test_texts_with_control_strings_come_back(spark):
    rows = [(1, 0, "user", "a\\l<b>\\\\<\\"), (1, 1, "assistant", None), (1, 1, "assistant", "x"), (None, 0, None, "q"),
            (2, 0, "a>b<\\g", "</turn>\n<turn x>"), (3, None, "assistant", ""), (4, 0, "user", "same"), (4, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.loss_text)
           for r in read_back(render(fold_events(conversation_events(df)))).collect()}
    assert got == {
        None: ([("", "q")], ""), 1: ([("user", "a\\l<b>\\\\<\\"), ("assistant", ""), ("assistant", "x")], "x"),
        2: ([("a>b<\\g", "</turn>\n<turn x>")], ""), 3: ([("assistant", "")], ""), 4: ([("user", "same")] * 2, "")}


def test_events_fold(spark):
    log = [(1, 1, "message", None, "user", "hi"), (1, 2, "message", None, "assistant", ""), (1, 3, "delta", None, None, "a"),
           (1, 4, "delta", None, None, "b"), (1, 5, "message", None, "user", "bye"), (1, 6, "regenerate", 1, None, None),
           (1, 7, "delta", 1, None, "c"), (1, 8, "edit", 0, None, "ho"), (1, 9, "delta", None, None, "!"),
           (1, 10, "delta", 9, None, "lost"), (2, 1, "delta", None, None, "lost")]
    got = fold_events(spark.createDataFrame(log, EVENTS)).orderBy("conv_id", "number").collect()
    assert [tuple(r) for r in got] == [(1, 0, "user", "ho"), (1, 1, "assistant", "c"), (1, 2, "user", "bye!")]


def test_empty_table_and_further_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert render(fold_events(conversation_events(empty))).count() == 0
    more = spark.createDataFrame([(1, 0, "user", "t", 5, 6)], "conv_id long, turn long, role string, text string, n long, pos long")
    assert fold_events(conversation_events(more)).collect()[0].text == "t"


def test_very_long_texts_and_conversations(spark):
    long = "a<b\\ " * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long[::-1])] + [(2, k, "assistant" if k % 2 else "user", f"<{k}>") for k in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in read_back(render(fold_events(conversation_events(df)))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", long), ("assistant", long[::-1])] and got[1].loss_text == long[::-1]
    assert len(got[2].turns) == 5000 and got[2].loss_text == "".join(f"<{k}>" for k in range(1, 5000, 2))
